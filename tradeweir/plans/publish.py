"""Publish a Silver snapshot to the serving copy: stage, verify, swap.

Two names exist, ``serving`` and ``staging``, each a view on one version table. A publication
writes a new version behind ``staging``, compares it with the pinned source snapshot, and then
exchanges what the two views show. Any failure before the exchange leaves ``serving`` alone. Two
view changes are not one atomic step: ``serving`` is moved first, by a single statement, and no
reader depends on ``staging``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeweir.contracts import (
    MONEY,
    SERVING_PARTITION,
    SERVING_SORT_KEY,
    SILVER_12,
    TableRoles,
    create_table_sql,
)
from tradeweir.errors import ContractError, CopyMismatchError, PublishError
from tradeweir.operators.fingerprint import compare_rows
from tradeweir.operators.metrics import with_event_month
from tradeweir.operators.order import unsorted_files
from tradeweir.operators.profile import (
    SourceProfile,
    require_same_profile,
    rows_per_symbol,
    source_profile,
)
from tradeweir.sources.snapshots import (
    check_snapshot_id,
    current_snapshot,
    point_view,
    read_version,
    version_behind,
    version_table,
    write_version,
)

# The Silver columns of type MONEY, and the decimal of 8 bytes in which they are shuffled where it is exact.
AMOUNTS = ("price", "quantity", "notional")
TRAVEL = "decimal(18,8)"


@dataclass(frozen=True)
class LoadReport:
    source: str
    snapshot_id: int
    source_profile: SourceProfile
    staged_table: str
    staged_rows: int


@dataclass(frozen=True)
class CopyReport:
    snapshot_id: int
    row_count: int
    fingerprint: str


@dataclass(frozen=True)
class ExchangeReport:
    serving_before: int
    staging_before: int
    serving_after: int
    staging_after: int


@dataclass(frozen=True)
class PublishReport:
    load: LoadReport
    copy: CopyReport
    exchange: ExchangeReport


def serving_layout(silver: DataFrame) -> DataFrame:
    """Silver rows clustered for the serving copy (K8): month folders, sorted inside each file.

    Rebalancing lets Spark size the write tasks at run time: small months share a task and a hot
    month is split over many, whatever key makes it hot.
    """
    by_month = with_event_month(SILVER_12.require(silver, "served rows"))
    spread = _unpacked(_packed(by_month).hint("rebalance", SERVING_PARTITION))
    return spread.sortWithinPartitions(SERVING_PARTITION, *SERVING_SORT_KEY)


def _packed(rows: DataFrame) -> DataFrame:
    """Rows as they are shuffled, a quarter smaller: nothing is lost, ``_unpacked`` gives back every value.

    An amount takes 8 bytes where it is exact in ``TRAVEL``, else a column of its own keeps it as it is; the second time is left
    out where the latency gives it.
    """
    columns = {c: F.col(c) for c in rows.columns}
    for name in AMOUNTS:
        narrow = F.col(name).try_cast(TRAVEL)
        columns[name] = narrow
        columns[f"_{name}"] = F.when(~F.coalesce(narrow.cast(MONEY) == F.col(name), F.lit(False)), F.col(name))
    columns["ingested_at"] = F.when(~F.coalesce(_arrival() == F.col("ingested_at"), F.lit(False)), F.col("ingested_at"))
    columns["_arrived"] = F.col("ingested_at").isNotNull()
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def _unpacked(packed: DataFrame) -> DataFrame:
    columns = {c: F.col(c) for c in packed.columns if not c.startswith("_")}
    for name in AMOUNTS:
        columns[name] = F.coalesce(f"_{name}", F.col(name).cast(MONEY))
    columns["ingested_at"] = F.coalesce("ingested_at", F.when(F.col("_arrived"), _arrival()))
    return packed.select(*[value.alias(name) for name, value in columns.items()])


def _arrival() -> Column:
    """The second time of a row by its first time and latency; null where it cannot be told."""
    return F.expr("timestamp_micros(try_add(unix_micros(event_time), try_multiply(latency_ms, 1000L)))")


def ensure_serving(spark: SparkSession, roles: TableRoles, fmt: str = "parquet") -> None:
    """Create the two roles, empty, if they do not exist, then check both (P5)."""
    for name in (roles.serving, roles.staging):
        namespace = name.rpartition(".")[0]
        if namespace:
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        if not spark.catalog.tableExists(name):
            _show_empty(spark, name, fmt)
    check_serving(spark, roles)


def check_serving(spark: SparkSession, roles: TableRoles, *, prove_order: tuple[str, ...] = ()) -> None:
    """Both roles show the 12 columns and rest on tables with the serving layout (P5).

    For the roles in ``prove_order`` the files themselves are read, sort key only, and must be in order.
    """
    for name in (roles.serving, roles.staging):
        SILVER_12.require(spark.table(name), name)
        behind = version_behind(spark, name)
        paged = [c.name for c in spark.catalog.listColumns(behind) if c.isPartition]
        if paged != [SERVING_PARTITION]:
            raise ContractError(f"{behind} is partitioned by {paged}, not by {SERVING_PARTITION}")
        if name in prove_order:
            wrong = unsorted_files(spark.table(behind), SERVING_SORT_KEY)
            example = wrong.first()
            if example:
                raise ContractError(f"{behind} is not sorted by {', '.join(SERVING_SORT_KEY)} in {example.file_path}")


def read_serving(spark: SparkSession, roles: TableRoles) -> DataFrame:
    """The served version with its month column, so that time filters skip partitions (M9)."""
    return spark.table(version_behind(spark, roles.serving))


def load_staging(
    spark: SparkSession,
    source: str,
    roles: TableRoles,
    *,
    fmt: str = "parquet",
    shown_symbols: int | None = None,
) -> LoadReport:
    """Copy the current source snapshot, resolved once, behind ``staging``.

    The source is read once: its nulls are counted while it is written, its rows come from file footers. The new
    version is shown only if it is whole and without nulls; else it is dropped, and both roles are as they were.
    """
    roles.require("silver", source)
    snapshot_id = current_snapshot(spark, source, fmt)
    rows = SILVER_12.require(read_version(spark, source, snapshot_id, fmt), source)
    ensure_serving(spark, roles, fmt)
    return _stage(spark, source, snapshot_id, rows, roles, fmt, shown_symbols)


def checked_source(
    spark: SparkSession,
    source: str,
    roles: TableRoles,
    fmt: str = "parquet",
    shown_symbols: int | None = None,
) -> tuple[int, DataFrame, SourceProfile]:
    """Id, rows and profile of the current source snapshot, which has no nulls."""
    roles.require("silver", source)
    snapshot_id = current_snapshot(spark, source, fmt)
    rows = SILVER_12.require(read_version(spark, source, snapshot_id, fmt), source)
    return snapshot_id, rows, source_profile(rows, shown_symbols).require_no_nulls()


def clear_staging(spark: SparkSession, roles: TableRoles, fmt: str = "parquet") -> None:
    """Show an empty version behind ``staging`` (K9). The serving role cannot be emptied."""
    _show_empty(spark, roles.staging, fmt)


def validate_copy(
    spark: SparkSession, source: str, snapshot_id: int, copy: DataFrame, fmt: str = "parquet"
) -> CopyReport:
    """Insist that ``copy`` equals one given source snapshot, row for row (P3). Read-only.

    The id is never resolved again, so a newer source version does not disturb the comparison. Each side is read
    once; only if the digests differ are both profiled, to say how.
    """
    check_snapshot_id(snapshot_id)
    rows = read_version(spark, source, snapshot_id, fmt)
    for side in (rows, copy):
        SILVER_12.require(side, "compared frame")
    found = compare_rows(rows, copy)
    if found.null_columns or found.left != found.right:
        require_same_profile(rows, copy)
        raise CopyMismatchError(f"row fingerprints differ: {found.left} and {found.right}")
    return CopyReport(snapshot_id, found.left_rows, found.left)


def exchange(spark: SparkSession, roles: TableRoles) -> ExchangeReport:
    """Swap what ``serving`` and ``staging`` show, once; never retried, never rolled back."""
    check_serving(spark, roles, prove_order=(roles.staging,))
    served, staged = (version_behind(spark, n) for n in (roles.serving, roles.staging))
    before = _row_counts(spark, roles)
    point_view(spark, roles.serving, staged, SILVER_12.columns)
    point_view(spark, roles.staging, served, SILVER_12.columns)
    check_serving(spark, roles)
    after = _row_counts(spark, roles)
    if after != before[::-1]:
        raise PublishError(f"row counts {before} did not cross over in the exchange: {after}")
    return ExchangeReport(*before, *after)


def publish(
    spark: SparkSession, source: str, roles: TableRoles, *, fmt: str = "parquet"
) -> PublishReport:
    """Stage, verify and swap (P6). The former serving version stays behind ``staging``; older ones are dropped."""
    load = load_staging(spark, source, roles, fmt=fmt)
    copy = validate_copy(spark, source, load.snapshot_id, spark.table(roles.staging), fmt)
    report = PublishReport(load, copy, exchange(spark, roles))
    release_versions(spark, roles)
    return report


def release_versions(spark: SparkSession, roles: TableRoles) -> list[str]:
    """Drop the versions that neither role shows; returns their names.

    What is left is the served version and the one that an exchange would bring back, whichever way the last exchange
    went. A reader that still reads a version which has left both roles fails, as it would with any table
    that is dropped.
    """
    shown = {version_behind(spark, role).rpartition(".")[2] for role in (roles.serving, roles.staging)}
    kept = shown | {version_table(r, 0).rpartition(".")[2] for r in (roles.serving, roles.staging)}
    namespace, _, name = roles.staging.rpartition(".")
    tables = spark.catalog.listTables(namespace or None, f"{name}__v*")
    old = sorted(t.name for t in tables if t.name not in kept and t.tableType != "VIEW")
    dropped = [f"{namespace}.{t}" if namespace else t for t in old]
    for table in dropped:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return dropped


def _stage(
    spark: SparkSession,
    source: str,
    snapshot_id: int,
    rows: DataFrame,
    roles: TableRoles,
    fmt: str,
    shown_symbols: int | None,
) -> LoadReport:
    seen = Observation()
    counted = rows.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in SILVER_12.columns])
    version = write_version(
        serving_layout(counted), roles.staging, fmt, partition_by=[SERVING_PARTITION]
    )
    staged_table = version_table(roles.staging, version)
    wanted, staged = rows.count(), spark.table(staged_table).count()
    try:
        # Spark observes nothing where it finds that there is nothing to read.
        nulls = seen.get if wanted else dict.fromkeys(SILVER_12.columns, 0)
        profile = _profile(spark.table(staged_table), wanted, nulls, shown_symbols).require_no_nulls()
        if staged != wanted:
            raise PublishError(f"staged {staged} rows of {wanted}; nothing was published")
    except Exception:
        spark.sql(f"DROP TABLE {staged_table}")
        raise
    point_view(spark, roles.staging, staged_table, SILVER_12.columns)
    return LoadReport(source, snapshot_id, profile, staged_table, staged)


def _profile(staged: DataFrame, row_count: int, nulls: dict[str, int], shown: int | None) -> SourceProfile:
    """Profile of what was written: its nulls as counted on the way, its symbols from that one column of the copy."""
    per_symbol = [(r.symbol, r.row_count) for r in rows_per_symbol(staged).collect()]
    first = tuple(per_symbol if shown is None else per_symbol[:shown])
    return SourceProfile(row_count, len(per_symbol), dict(nulls), first, len(per_symbol) - len(first))


def _show_empty(spark: SparkSession, role: str, fmt: str) -> None:
    empty = version_table(role, 0)
    spark.sql(create_table_sql(empty, SILVER_12, fmt, partition=SERVING_PARTITION))
    if spark.table(empty).head(1):
        raise PublishError(f"{empty} has to stay empty but holds rows")
    point_view(spark, role, empty, SILVER_12.columns)


def _row_counts(spark: SparkSession, roles: TableRoles) -> tuple[int, int]:
    return spark.table(roles.serving).count(), spark.table(roles.staging).count()
