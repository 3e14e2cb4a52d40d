from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import bronze_rows, silver_rows
from tradeweir.contracts import BRONZE_13, BRONZE_15, SILVER_12, TableRoles, create_table_sql
from tradeweir.errors import (
    ContractError,
    CopyMismatchError,
    NullsFoundError,
    PipelineError,
    PublishError,
    RoleError,
    SnapshotError,
)
from tradeweir.operators.fingerprint import tree_fingerprint
from tradeweir.plans import publish as publishing
from tradeweir.operators.order import unsorted_files
from tradeweir.plans.compact import _spread, compact, compaction_plan
from tradeweir.plans.inspect import inspect_table, inspection_sql, listed_files, partition_note
from tradeweir.plans.rebuild import rebuild_silver
from tradeweir.sources.snapshots import (
    commit_version,
    current_snapshot,
    history,
    read_version,
    version_behind,
    version_table,
)


@pytest.fixture
def roles(database):
    return TableRoles(
        bronze=f"{database}.bronze",
        silver=f"{database}.silver",
        smoke=f"{database}.smoke",
        serving=f"{database}.serving",
        staging=f"{database}.staging",
    )


def _numbered(spark, *numbers):
    return silver_rows(spark, *[{"trade_id": str(n)} for n in numbers])


def _ids(frame):
    return sorted(r.trade_id for r in frame.select("trade_id").collect())


def test_versions_are_immutable(spark, roles):
    first = commit_version(_numbered(spark, 1, 2), roles.silver)
    second = commit_version(_numbered(spark, 3), roles.silver)
    assert current_snapshot(spark, roles.silver) == second > first
    assert _ids(read_version(spark, roles.silver, first)) == ["1", "2"]
    assert _ids(spark.table(roles.silver)) == ["3"]
    assert history(spark, roles.silver).count() == 2


def test_snapshot_errors(spark, roles):
    with pytest.raises(SnapshotError):
        current_snapshot(spark, roles.silver)
    commit_version(_numbered(spark, 1), roles.silver)
    for bad in (0, -1, True, "1", 12345):
        with pytest.raises(SnapshotError):
            read_version(spark, roles.silver, bad)
    spark.sql(f"CREATE TABLE {roles.smoke}__history AS SELECT 1L AS snapshot_id, "
              "current_timestamp() AS made_current_at, false AS is_current_ancestor")
    with pytest.raises(SnapshotError, match="no current snapshot"):
        current_snapshot(spark, roles.smoke)


def test_newest_ancestor_wins_ties_by_id(spark, roles):
    spark.sql(
        f"CREATE TABLE {roles.smoke}__history AS SELECT * FROM VALUES "
        "(5L, TIMESTAMP '2026-01-02', false), (3L, TIMESTAMP '2026-01-01', true), "
        "(4L, TIMESTAMP '2026-01-01', true), (9L, TIMESTAMP '2025-01-01', true) "
        "AS t(snapshot_id, made_current_at, is_current_ancestor)"
    )
    assert current_snapshot(spark, roles.smoke) == 4


def test_rebuild_replaces(spark, roles):
    spark.sql(create_table_sql(roles.bronze, BRONZE_15))
    bronze_rows(spark, {}, {}, {"is_valid": None}).write.insertInto(roles.bronze)
    reports = [rebuild_silver(spark, roles.bronze, roles.silver, roles) for _ in range(2)]
    assert [r.row_count for r in reports] == [2, 2]
    prints = {
        tree_fingerprint(read_version(spark, roles.silver, r.snapshot_id)).first()[0]
        for r in reports
    }
    assert len(prints) == 1 and spark.table(roles.silver).count() == 2
    for bronze, silver in ((roles.smoke, roles.silver), (roles.bronze, roles.serving)):
        with pytest.raises(RoleError):
            rebuild_silver(spark, bronze, silver, roles)


def test_rebuild_needs_the_full_contract(spark, roles):
    spark.sql(create_table_sql(roles.bronze, BRONZE_13))
    with pytest.raises(ContractError):
        rebuild_silver(spark, roles.bronze, roles.silver, roles)


def test_publish_twice_and_keep_the_former_version(spark, roles):
    commit_version(_numbered(spark, 1, 1, 2), roles.silver)
    first = publishing.publish(spark, roles.silver, roles)
    assert _ids(spark.table(roles.serving)) == ["1", "1", "2"]
    assert (first.load.staged_rows, first.copy.row_count) == (3, 3)
    commit_version(_numbered(spark, *range(25)), roles.silver)
    second = publishing.publish(spark, roles.silver, roles)
    moved = second.exchange
    # Staging was emptied and refilled, so the served version is what crosses over.
    assert (moved.serving_before, moved.staging_before) == (3, 25)
    assert (moved.serving_after, moved.staging_after) == (25, 3)
    assert _ids(spark.table(roles.staging)) == ["1", "1", "2"]
    assert spark.table(roles.serving).columns == SILVER_12.columns
    assert "event_month" in publishing.read_serving(spark, roles).columns


def test_republishing_changes_nothing(spark, roles):
    commit_version(_numbered(spark, 1, 2, 2), roles.silver)
    prints = [publishing.publish(spark, roles.silver, roles).copy.fingerprint for _ in range(2)]
    assert prints[0] == prints[1] and spark.table(roles.serving).count() == 3


def test_bad_source_touches_nothing(spark, roles):
    commit_version(_numbered(spark, 1), roles.silver)
    publishing.publish(spark, roles.silver, roles)
    shown = [version_behind(spark, n) for n in (roles.serving, roles.staging)]
    commit_version(silver_rows(spark, {"price": None}), roles.silver)
    with pytest.raises(NullsFoundError, match="price=1"):
        publishing.publish(spark, roles.silver, roles)
    commit_version(_numbered(spark, 1).drop("symbol"), roles.silver)
    with pytest.raises(ContractError):
        publishing.publish(spark, roles.silver, roles)
    assert [version_behind(spark, n) for n in (roles.serving, roles.staging)] == shown


def test_lost_rows_stop_before_the_swap(spark, roles, monkeypatch):
    commit_version(_numbered(spark, 1), roles.silver)
    publishing.publish(spark, roles.silver, roles)
    served = version_behind(spark, roles.serving)
    commit_version(_numbered(spark, 2, 3), roles.silver)
    whole = publishing.serving_layout
    monkeypatch.setattr(publishing, "serving_layout", lambda f: whole(f).where("trade_id = '2'"))
    with pytest.raises(PublishError, match="staged 1 rows of 2"):
        publishing.publish(spark, roles.silver, roles)
    monkeypatch.setattr(
        publishing, "serving_layout", lambda f: whole(f.replace("2", "9", "trade_id"))
    )
    with pytest.raises(CopyMismatchError, match="fingerprints differ"):
        publishing.publish(spark, roles.silver, roles)
    assert version_behind(spark, roles.serving) == served
    assert _ids(spark.table(roles.serving)) == ["1"]


def test_newer_source_version_does_not_disturb_the_comparison(spark, roles):
    pinned = commit_version(_numbered(spark, 1, 2), roles.silver)
    load = publishing.load_staging(spark, roles.silver, roles)
    commit_version(_numbered(spark, 7), roles.silver)
    copy = spark.table(roles.staging)
    assert load.snapshot_id == pinned
    assert publishing.validate_copy(spark, roles.silver, pinned, copy).row_count == 2
    newer = current_snapshot(spark, roles.silver)
    with pytest.raises(CopyMismatchError):
        publishing.validate_copy(spark, roles.silver, newer, copy)


def test_counts_that_do_not_cross_are_an_error_without_second_swap(spark, roles, monkeypatch):
    commit_version(_numbered(spark, 1), roles.silver)
    publishing.load_staging(spark, roles.silver, roles)
    counts = iter([(0, 1), (5, 5)])
    monkeypatch.setattr(publishing, "_row_counts", lambda *_: next(counts))
    with pytest.raises(PublishError, match="cross over"):
        publishing.exchange(spark, roles)
    assert _ids(spark.table(roles.serving)) == ["1"]  # swapped once, not rolled back


def test_serving_contract(spark, roles):
    publishing.ensure_serving(spark, roles)
    publishing.check_serving(spark, roles)
    spark.sql(f"CREATE TABLE {roles.smoke} AS SELECT * FROM {roles.serving}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {roles.serving} TBLPROPERTIES "
        f"('tradeweir.version' = '{roles.smoke}') AS SELECT * FROM {roles.smoke}"
    )
    with pytest.raises(ContractError, match="partitioned by"):
        publishing.check_serving(spark, roles)


def test_the_layout_shuffles_packed_rows_and_loses_nothing(spark, roles):
    odd = [
        {"price": Decimal("12345678901234567890.000000000000000001"), "quantity": Decimal("0.000000001")},
        {"price": Decimal("1.00000001"), "quantity": Decimal("1.000000005"), "notional": Decimal("-9999999999.99999999")},
        {"price": Decimal("9999999999.999999999"), "quantity": Decimal("10000000000"), "notional": Decimal("0")},
        {"price": None, "quantity": None, "notional": None},
        {"ingested_at": None},
        {"latency_ms": None},
        {"ingested_at": None, "latency_ms": None},
        *[{"latency_ms": n} for n in (2**63 - 1, -(2**63), 2**63 // 1000, 0, -7)],
    ]
    rows = silver_rows(spark, {}, {}, *odd)
    moved = publishing._unpacked(publishing._packed(rows))
    assert moved.schema.simpleString() == rows.schema.simpleString()
    for found in (moved, publishing.serving_layout(rows).drop("event_month")):
        assert found.exceptAll(rows).isEmpty() and found.count() == rows.count() == len(odd) + 2
    usual = silver_rows(spark, {"latency_ms": 5, "event_time": datetime(2026, 1, 1), "ingested_at": datetime(2026, 1, 1, microsecond=5000)})
    travels = publishing._packed(usual).first()
    assert travels.ingested_at is None and (travels._price, travels._quantity, travels._notional) == (None, None, None)
    plan = publishing.serving_layout(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(18,8)" in plan[plan.index("RebalancePartitions"):]


def test_versions_are_written_with_zstd(spark, roles):
    version = commit_version(_numbered(spark, 1, 2), roles.silver)
    files = [r.file_path for r in listed_files(spark, version_table(roles.silver, version)).collect()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_layout_is_sorted_inside_months(spark, tmp_path):
    rows = silver_rows(
        spark, *[{"trade_id": str(n % 7), "symbol": f"S{n % 3}", "kafka_offset": n} for n in range(60)]
    )
    path = str(tmp_path / "layout")
    publishing.serving_layout(rows).coalesce(1).write.partitionBy("event_month").parquet(path)
    stored = spark.read.parquet(path)
    assert {r.event_month for r in stored.select("event_month").distinct().collect()} == {202601}
    plan = publishing.serving_layout(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_inspection(spark, roles):
    commit_version(_numbered(spark, 1, 2), roles.silver)
    sections = inspect_table(spark, roles.silver)
    assert list(sections) == [
        "identity",
        "schema",
        "row_count",
        "snapshots_count",
        "snapshots",
        "history_count",
        "history",
        "files_count",
        "files",
    ]
    assert sections["row_count"].first().row_count == 2
    assert sum(r.row_count for r in sections["files"].collect()) == 2
    assert partition_note(spark, roles.silver) == "unpartitioned"
    publishing.ensure_serving(spark, roles)
    assert partition_note(spark, roles.serving) == "empty"
    publishing.publish(spark, roles.silver, roles)
    assert partition_note(spark, roles.serving) == "partitioned"
    parts = inspect_table(spark, roles.serving, max_rows=1)["partitions"].collect()
    assert parts == [("202601", 2)]


def test_listings_read_no_data(spark, roles):
    commit_version(_numbered(spark, *range(8)).repartition(4), roles.silver)
    stored = version_behind(spark, roles.silver)
    sections = inspect_table(spark, roles.silver, rows_per_file=False)
    plan = sections["files"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan and "FileScan parquet" not in plan
    counted = inspect_table(spark, roles.silver)["files"]
    reads = [x for x in counted._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x]
    assert reads and all("ReadSchema: struct<>" in x for x in reads)
    sizes = {r.file_path: r.file_size for r in listed_files(spark, stored).collect()}
    assert len(sizes) == 4 and all(s > 0 for s in sizes.values())
    assert {r.file_path: r.file_size for r in counted.collect()} == sizes


def test_inspection_statements_only_read():
    statements = inspection_sql("cat.db.t", 7)
    assert len(statements) == 11
    assert all(s.split()[0] in {"DESCRIBE", "SELECT"} for s in statements.values())
    assert statements["history"].endswith("LIMIT 7")
    for table, rows in (("a b", 1), ("t", 0)):
        with pytest.raises(Exception):
            inspection_sql(table, rows)


def test_compaction_keeps_the_rows(spark, roles):
    commit_version(_numbered(spark, *range(30)).repartition(15), roles.silver)
    files = inspect_table(spark, roles.silver)["files_count"].first().row_count
    compact(spark, roles.silver)
    assert inspect_table(spark, roles.silver)["files_count"].first().row_count == 1 < files
    assert _ids(spark.table(roles.silver)) == sorted(str(n) for n in range(30))


def test_compaction_by_size_keeps_folders_and_order(spark, roles):
    rows = silver_rows(spark, *[{"symbol": f"S{n % 3}", "trade_id": f"{n:03d}"} for n in range(90)])
    first = commit_version(rows.repartition(5), roles.silver, partition_by=["symbol"])
    before = compaction_plan(spark, version_table(roles.silver, first)).collect()
    assert {r.folder for r in before} == {"symbol=S0/", "symbol=S1/", "symbol=S2/"}
    assert all(r.small and r.files > 1 and r.target_files == 1 for r in before)
    second = compact(spark, roles.silver, sort_by=["trade_id"])
    after = compaction_plan(spark, version_table(roles.silver, second)).collect()
    assert [(r.files, r.small) for r in after] == [(1, False)] * 3 and second != first
    assert unsorted_files(spark.table(version_table(roles.silver, second)), ["trade_id"]).isEmpty()
    assert compact(spark, roles.silver, sort_by=["trade_id"]) == second
    smallest = min(r.bytes for r in after)
    third = compact(spark, roles.silver, target_bytes=smallest * 2)
    assert third == second
    assert sorted(r.trade_id for r in spark.table(roles.silver).collect()) == [f"{n:03d}" for n in range(90)]
    with pytest.raises(PipelineError):
        compaction_plan(spark, version_table(roles.silver, second), 0)


@pytest.mark.parametrize("by", [["symbol"], []])
def test_compaction_ends_where_nothing_is_left_to_do(spark, roles, by):
    """Each text comes ten times, so that sorted rows take much less space than the files before and need fewer files."""
    texts = spark.range(10_000).select(F.md5((F.col("id") % 1000).cast("string")).alias("trade_id"))
    rows = silver_rows(spark, {"symbol": "S0"}, {"symbol": "S1"}).drop("trade_id").crossJoin(texts).select(*SILVER_12.columns)
    first = commit_version(rows.repartition(6), roles.silver, partition_by=by)
    before = compaction_plan(spark, version_table(roles.silver, first)).collect()
    target = max(r.bytes for r in before) // 3
    second = compact(spark, roles.silver, target_bytes=target, sort_by=["trade_id"])
    assert compact(spark, roles.silver, target_bytes=target, sort_by=["trade_id"]) == second != first
    after = compaction_plan(spark, version_table(roles.silver, second), target).collect()
    assert {r.folder for r in after} == {r.folder for r in before}
    assert all(r.bytes <= target and (r.files, r.target_files, r.small) == (1, 1, False) for r in after)
    assert unsorted_files(spark.table(version_table(roles.silver, second)), [*by, "trade_id"]).isEmpty()
    assert history(spark, roles.silver).count() == 2
    kept = {t.name for t in spark.catalog.listTables(roles.silver.rpartition(".")[0]) if "__v" in t.name}
    assert kept == {version_table("silver", v) for v in (first, second)}
    assert version_behind(spark, roles.silver) == version_table(roles.silver, second)
    written = spark.table(roles.silver).select(*SILVER_12.columns)
    assert written.exceptAll(rows).isEmpty() and written.count() == rows.count()


def test_a_folder_of_many_files_gets_each_in_a_task_of_its_own(spark, roles):
    rows = silver_rows(spark, *[{"symbol": f"S{n % 5}", "trade_id": f"{n:04d}"} for n in range(2000)])
    first = commit_version(rows.repartition(12), roles.silver, partition_by=["symbol"])
    stored = version_table(roles.silver, first)
    target = min(r.bytes for r in compaction_plan(spark, stored).collect()) // 3
    wanted = {r.folder: r.target_files for r in compaction_plan(spark, stored, target).collect()}
    spread = _spread(spark, stored, target, sum(wanted.values()), ["symbol"], ["trade_id"])
    tasks = spread.select(F.spark_partition_id().alias("task"), "symbol").distinct().collect()
    assert len(tasks) == len({r.task for r in tasks}) == sum(wanted.values()) > 10
    assert {f: sum(f == f"symbol={r.symbol}/" for r in tasks) for f in wanted} == wanted


def test_compaction_ends_if_rows_of_files_are_bounded(spark, roles):
    commit_version(_numbered(spark, *range(30)).repartition(15), roles.silver)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        compact(spark, roles.silver)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert inspect_table(spark, roles.silver)["files_count"].first().row_count == 3
    assert _ids(spark.table(roles.silver)) == sorted(str(n) for n in range(30))


def test_unsorted_files_are_found(spark, tmp_path):
    path = str(tmp_path / "order")
    key = ["symbol", "kafka_offset"]
    rows = silver_rows(spark, *[{"symbol": f"S{n % 4}", "kafka_offset": n // 4} for n in range(400)]).select(*key)
    rows.repartition(3).sortWithinPartitions(*key).write.parquet(path)
    assert unsorted_files(spark.read.parquet(path), key).isEmpty()
    rows.repartition(1).sortWithinPartitions("symbol", F.desc("kafka_offset")).write.mode("append").parquet(path)
    found = [r.file_path for r in unsorted_files(spark.read.parquet(path), key).collect()]
    assert len(found) == 1
    assert unsorted_files(spark.read.parquet(path), ["symbol"]).isEmpty()
    nulls = str(tmp_path / "nulls")
    rows.union(spark.createDataFrame([(None, 1), (None, None)], rows.schema)).repartition(1).sortWithinPartitions(*key).write.parquet(nulls)
    assert unsorted_files(spark.read.parquet(nulls), key).isEmpty()
    assert unsorted_files(spark.read.parquet(nulls).limit(0), key).isEmpty()


def test_pieces_of_a_file_are_compared_end_to_end(spark, tmp_path):
    path = str(tmp_path / "split")
    groups = {"parquet.block.size": "20000", "parquet.page.row.count.limit": "200"}
    up, down = (spark.range(s, s + 30_000).repartition(1).sortWithinPartitions("id") for s in (50_000, 0))
    up.union(down).coalesce(1).write.options(**groups).parquet(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        frame = spark.read.parquet(path)
        assert frame.rdd.getNumPartitions() > 2
        assert unsorted_files(frame, ["id"]).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_rewritten_unsorted_file_is_refused(spark, roles):
    commit_version(_numbered(spark, *range(40)), roles.silver)
    load = publishing.load_staging(spark, roles.silver, roles)
    rows = spark.table(load.staged_table)
    kept = spark.createDataFrame(rows.sort(F.desc("trade_id")).collect(), rows.schema).coalesce(1)
    kept.write.mode("overwrite").partitionBy("event_month").saveAsTable(load.staged_table)
    with pytest.raises(ContractError, match="not sorted"):
        publishing.exchange(spark, roles)
    assert spark.table(roles.serving).count() == 0


def test_three_publications_leave_two_versions_and_a_way_back(spark, roles):
    for numbers in ((1,), (1, 2), (1, 2, 3)):
        commit_version(_numbered(spark, *numbers), roles.silver)
        publishing.publish(spark, roles.silver, roles)
    names = {t.name for t in spark.catalog.listTables(roles.staging.rpartition(".")[0])}
    assert len([n for n in names if n.startswith("staging__v") and n != "staging__v0"]) == 2
    assert publishing.release_versions(spark, roles) == []
    publishing.exchange(spark, roles)
    assert _ids(spark.table(roles.serving)) == ["1", "2"]


def test_publication_reads_the_source_twice(spark, roles, monkeypatch):
    commit_version(_numbered(spark, *range(5)), roles.silver)
    reads = []
    whole = publishing.read_version

    def counted(*args):
        reads.append(args)
        return whole(*args)

    monkeypatch.setattr(publishing, "read_version", counted)
    monkeypatch.setattr(publishing, "require_same_profile", lambda *_: pytest.fail("profiled without need"))
    publishing.publish(spark, roles.silver, roles)
    assert len(reads) == 2


def test_nulls_are_reported_by_the_comparison(spark, roles):
    pinned = commit_version(silver_rows(spark, {"price": None}, {}), roles.silver)
    with pytest.raises(NullsFoundError, match="price=1"):
        publishing.validate_copy(spark, roles.silver, pinned, spark.table(roles.silver))
