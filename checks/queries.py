"""Every operator as a query ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from tradeweir.contracts import (
    BRONZE_13,
    BRONZE_15,
    MONEY,
    SERVING_SORT_KEY,
    SILVER_12,
    TableRoles,
    create_table_sql,
)
from tradeweir.functions.money import try_exact_product, unfit_notionals
from tradeweir.operators import audit, fingerprint, metrics, order, producer, profile, quality
from tradeweir.operators.silver import build_silver
from tradeweir.plans import append, compact, inspect, migrate, publish, rebuild
from tradeweir.session import require_runtime, scratch_database, scratch_folder
from tradeweir.sources import feed as feeds
from tradeweir.sources.kafka import file_batch, file_source
from tradeweir.sources.snapshots import commit_version, read_version, version_table
from tradeweir.streaming.bronze import COUNTS, run_bronze_stream
from tradeweir.streaming.dedup import start_dedup
from tradeweir.streaming.minutes import open_minutes, start_minutes
from tradeweir.streaming.progress import batch_counts, observed_totals

Query = Callable[[SparkSession, str], DataFrame]

# The dashboard's time filter: half of the feed's month.
FILTER_SYMBOLS = ["click", "purchase", "view"]
FILTER_START = datetime(2024, 1, 8)
FILTER_END = datetime(2024, 1, 22, 12, 30)
# Streams with late rows: how late is allowed, and where the feed is cut into runs.
LATE_BY = "2 days"
CUTS = ("2024-01-11", "2024-01-21")
FRESH_AT = datetime(2025, 1, 1)


def portable(frame: DataFrame, *as_text: str) -> DataFrame:
    """Decimals, timestamps and arrays as text, so that two engines can be compared exactly.

    ``as_text`` names further columns to convert: numbers and flags that hold nulls.
    """
    columns = []
    for field in frame.schema:
        value = F.col(field.name)
        kind = field.dataType.typeName()
        if kind == "decimal" or field.name in as_text:
            value = value.cast("string")
        elif kind == "timestamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "array":
            value = F.array_join(value, ",")
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def bronze_text(bronze: DataFrame) -> DataFrame:
    return portable(bronze, "event_time_ms", "ingested_at_ms")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed -> Bronze -> Silver -> volume per symbol and minute, as one plan."""
    classified = quality.classify(tables.records(spark, sf_dir))
    return portable(metrics.notional_per_minute(build_silver(classified)))


# Bronze


def bronze_classify(spark, sf_dir):
    return bronze_text(quality.classify(tables.records(spark, sf_dir)))


def bulk_bronze_classify(spark, sf_dir):
    return bronze_text(quality.classify(tables.records(spark, sf_dir, "lineitem")))


def bronze_label_counts(spark, sf_dir):
    return quality.label_counts(quality.classify(tables.records(spark, sf_dir)))


def bulk_label_counts(spark, sf_dir):
    return quality.label_counts(quality.classify(tables.records(spark, sf_dir, "lineitem")))


def bronze_validity_summary(spark, sf_dir):
    """Rows written before the migration (the lineitem feed) are not evaluated."""
    old = quality.as_not_evaluated(_unbroken(spark, sf_dir, feeds.lineitem_trades))
    return quality.validity_summary(tables.bronze(spark, sf_dir).union(old))


def bronze_migrated_mix(spark, sf_dir):
    """A 13-column table with rows, migrated, then appended to with 15-column rows."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "migrated"))
    spark.sql(create_table_sql(roles.bronze, BRONZE_13))
    _unbroken(spark, sf_dir, feeds.event_trades).write.insertInto(roles.bronze)
    migrate.migrate_bronze(spark, roles.bronze, roles)
    tables.bronze(spark, sf_dir, "lineitem").write.insertInto(roles.bronze)
    return portable(spark.table(roles.bronze), "event_time_ms", "ingested_at_ms", "is_valid")


def bronze_classify_faults(spark, sf_dir):
    """Every kind of fault, several at once among them."""
    require_runtime(spark)
    return portable(
        quality.classify(feeds.fault_feed(spark, sf_dir)),
        "event_time_ms",
        "ingested_at_ms",
        "kafka_partition",
        "kafka_offset",
    )


def fault_label_counts(spark, sf_dir):
    """All eighteen labels."""
    require_runtime(spark)
    return quality.label_counts(quality.classify(feeds.fault_feed(spark, sf_dir)))


def trades_parse_strict(spark, sf_dir):
    return portable(_unbroken(spark, sf_dir, feeds.event_trades))


def quality_append(spark, sf_dir):
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "smoke"))
    append.ensure_smoke_table(spark, roles.smoke, roles)
    append.append_classified(
        quality.classify(tables.records(spark, sf_dir)), roles.smoke, roles
    )
    return bronze_text(spark.table(roles.smoke))


# Silver


def silver_trades(spark, sf_dir):
    return portable(build_silver(tables.bronze(spark, sf_dir)))


def bulk_silver_trades(spark, sf_dir):
    return portable(build_silver(tables.bronze(spark, sf_dir, "lineitem")))


def silver_notional_exact(spark, sf_dir):
    return _notional(spark, sf_dir, "exact")


def silver_notional_reference(spark, sf_dir):
    return _notional(spark, sf_dir, "reference")


def wide_notional(spark, sf_dir):
    """Products of operands with up to 20 whole digits or 18 decimals; null where no exact product fits."""
    rows = _wide_bronze(spark, sf_dir)
    product = try_exact_product(F.col("price"), F.col("quantity"))
    return portable(rows.select("trade_id", "price", "quantity", product.alias("notional")))


def wide_silver(spark, sf_dir):
    """Silver, in exact mode, of the wide rows that have an exact product."""
    rows = _wide_bronze(spark, sf_dir)
    unfit = unfit_notionals(rows).select("trade_id")
    return portable(build_silver(rows.join(unfit, "trade_id", "left_anti").select(*BRONZE_15.columns)))


def unfit_rows(spark, sf_dir):
    """The wide rows that a rebuild in exact mode would fail on, and why."""
    return portable(unfit_notionals(_wide_bronze(spark, sf_dir)).select("trade_id", "price", "quantity", "problem"))


def silver_rebuild(spark, sf_dir):
    """Two rebuilds over the same Bronze; the current version is returned."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "rebuild"))
    _bronze_table(spark, sf_dir, roles)
    rebuild.rebuild_silver(spark, roles.bronze, roles.silver, roles)
    rebuild.rebuild_silver(spark, roles.bronze, roles.silver, roles)
    return portable(spark.table(roles.silver))


# Checks


def null_counts(spark, sf_dir):
    return profile.null_counts(tables.bronze(spark, sf_dir), BRONZE_13.columns)


def row_and_symbol_summary(spark, sf_dir):
    return profile.row_and_symbol_counts(tables.silver(spark, sf_dir))


def rows_per_symbol(spark, sf_dir):
    return profile.rows_per_symbol(tables.silver(spark, sf_dir))


def symbol_profile(spark, sf_dir):
    """Rows and nulls per symbol; the blank and the missing symbol of Bronze stay groups."""
    rows = tables.bronze(spark, sf_dir)
    shaped = rows.select(
        *[
            F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
            for c in SILVER_12.columns
        ]
    )
    return profile.symbol_profile(shaped)


def count_diff(spark, sf_dir):
    """Silver against all of Bronze: what classification kept back per symbol."""
    return profile.count_diff(tables.silver(spark, sf_dir), tables.bronze(spark, sf_dir))


def row_hashes(spark, sf_dir):
    both = tables.silver(spark, sf_dir).union(_earliest(spark, sf_dir))
    return fingerprint.row_hash_counts(both)


def multiset_fingerprint(spark, sf_dir):
    return fingerprint.tree_fingerprint(tables.silver(spark, sf_dir))


def stream_fingerprint(spark, sf_dir):
    """The single SHA-256 over all pairs in hash order."""
    digest = fingerprint.stream_fingerprint(tables.silver(spark, sf_dir))
    return spark.range(1).select(F.lit(digest).alias("fingerprint"))


def bulk_fingerprint(spark, sf_dir):
    return fingerprint.tree_fingerprint(tables.silver(spark, sf_dir, "lineitem"))


def multiset_diff(spark, sf_dir):
    """Exact against rounded notional: rows whose product needs more than six decimals differ."""
    return fingerprint.multiset_diff(
        tables.silver(spark, sf_dir), tables.silver(spark, sf_dir, mode="reference")
    )


def except_all_diff(spark, sf_dir):
    diff = fingerprint.except_all_diff(
        tables.silver(spark, sf_dir), tables.silver(spark, sf_dir, mode="reference")
    )
    return portable(diff)


# Metrics


def kpi_row(spark, sf_dir):
    return portable(metrics.kpi_row(tables.silver(spark, sf_dir)))


def bulk_kpi_row(spark, sf_dir):
    return portable(metrics.kpi_row(tables.silver(spark, sf_dir, "lineitem")))


def symbol_kpis(spark, sf_dir):
    return portable(metrics.context_kpis(tables.silver(spark, sf_dir), ["symbol"]))


def bulk_symbol_kpis(spark, sf_dir):
    return portable(metrics.context_kpis(tables.silver(spark, sf_dir, "lineitem"), ["symbol"]))


def latest_price(spark, sf_dir):
    return portable(metrics.symbol_latest_price(tables.silver(spark, sf_dir)))


def trades_per_minute(spark, sf_dir):
    return portable(metrics.trades_per_minute(tables.silver(spark, sf_dir)))


def notional_per_minute(spark, sf_dir):
    return portable(metrics.notional_per_minute(tables.silver(spark, sf_dir)))


def price_over_time(spark, sf_dir):
    return portable(metrics.price_over_time(tables.silver(spark, sf_dir)))


def bulk_price_over_time(spark, sf_dir):
    return portable(metrics.price_over_time(tables.silver(spark, sf_dir, "lineitem")))


def latency_over_time(spark, sf_dir):
    return portable(metrics.latency_over_time(tables.silver(spark, sf_dir)))


def latency_histogram(spark, sf_dir):
    return metrics.latency_histogram(tables.silver(spark, sf_dir), 50)


def symbol_comparison(spark, sf_dir):
    return portable(metrics.symbol_comparison(tables.silver(spark, sf_dir)))


def metrics_filtered(spark, sf_dir):
    chosen = metrics.select_trades(
        tables.silver(spark, sf_dir), symbols=FILTER_SYMBOLS, start=FILTER_START, end=FILTER_END
    )
    return portable(metrics.context_kpis(chosen, ["symbol"]))


# Producer


def exchange_envelope_normalise(spark, sf_dir):
    messages = _envelopes(spark, sf_dir)
    return producer.normalise_envelope(messages, exchange="synth")


def strict_event_validation(spark, sf_dir):
    return portable(producer.check_events(_event_columns(spark, sf_dir)))


def kafka_encode(spark, sf_dir):
    return producer.encode_for_kafka(_event_columns(spark, sf_dir))


def symbol_filter(spark, sf_dir):
    return producer.allow_symbols(_event_columns(spark, sf_dir), FILTER_SYMBOLS)


# Snapshots, serving, streams


def snapshot_pinned_read(spark, sf_dir):
    """A version read after a newer one with other rows was committed."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "pinned"))
    first = commit_version(tables.silver(spark, sf_dir), roles.silver)
    commit_version(tables.silver(spark, sf_dir, "lineitem"), roles.silver)
    return portable(read_version(spark, roles.silver, first))


def serving_layout_counts(spark, sf_dir):
    """Rows per month folder of the serving layout."""
    require_runtime(spark)
    folder = scratch_folder(spark, "layout")
    laid_out = publish.serving_layout(tables.silver(spark, sf_dir, "lineitem"))
    laid_out.write.partitionBy("event_month").parquet(folder)
    stored = spark.read.schema(laid_out.schema).parquet(folder)
    return stored.groupBy("event_month").agg(F.count("*").alias("row_count"))


def publish_cycle(spark, sf_dir):
    """Two publications of different snapshots; the rows served in the end."""
    roles = _published(spark, sf_dir)
    return portable(spark.table(roles.serving))


def published_filter(spark, sf_dir):
    """Dashboard filter on the served version, which skips month folders."""
    roles = _published(spark, sf_dir)
    chosen = metrics.select_trades(
        publish.read_serving(spark, roles), start=datetime(1996, 2, 10), end=datetime(1997, 1, 1)
    )
    return portable(metrics.symbol_comparison(chosen))


def stream_bronze_append(spark, sf_dir):
    require_runtime(spark)
    roles, source, checkpoint = _stream_setup(spark)
    tables.records(spark, sf_dir).write.parquet(source)
    _drain(spark, source, checkpoint, roles)
    return bronze_text(spark.table(roles.bronze))


def stream_restart(spark, sf_dir):
    """A stream that ended, more records, and a restart from the same checkpoint."""
    require_runtime(spark)
    roles, source, checkpoint = _stream_setup(spark)
    tables.records(spark, sf_dir).write.parquet(source)
    _drain(spark, source, checkpoint, roles)
    _drain(spark, source, checkpoint, roles)
    tables.records(spark, sf_dir, "lineitem").write.mode("append").parquet(source)
    _drain(spark, source, checkpoint, roles)
    return bronze_text(spark.table(roles.bronze))


def stream_label_counts(spark, sf_dir):
    """Rows, valid rows and rows with each label, as the stream's own progress counts them."""
    require_runtime(spark)
    roles, source, checkpoint = _stream_setup(spark)
    feeds.fault_feed(spark, sf_dir).write.parquet(source)
    query = _drain(spark, source, checkpoint, roles)
    counts = observed_totals(query, COUNTS)
    return spark.createDataFrame(sorted(counts.items()), "label string, row_count long")


def stream_dedup(spark, sf_dir):
    """First rows of each key from a feed that repeats rows within and beyond the watermark."""
    folder, _ = _dedup_runs(spark, sf_dir)
    return portable(spark.read.schema(SILVER_12.schema).parquet(folder))


def stream_dedup_counts(spark, sf_dir):
    """Per run: rows that came, late ones, repeats, and keys still remembered."""
    _, counts = _dedup_runs(spark, sf_dir)
    return spark.createDataFrame(counts, "run int, rows_in long, late long, repeats long, state_rows long")


def stream_late_minutes(spark, sf_dir):
    """Minutes of a stream whose second run brings rows behind the watermark, final and still open ones."""
    final, still_open, _ = _minute_runs(spark, sf_dir)
    state = lambda frame, name: frame.withColumn("state", F.lit(name))
    return portable(state(final, "final").unionByName(state(still_open, "open")))


def stream_late_counts(spark, sf_dir):
    """Rows that came to that stream, and those that its minutes count; the rest was late."""
    final, still_open, rows_in = _minute_runs(spark, sf_dir)
    counted = final.unionByName(still_open).agg(F.sum("trade_count").alias("counted"))
    return counted.select(F.lit(rows_in).cast("long").alias("rows_in"), "counted", (F.lit(rows_in) - F.col("counted")).cast("long").alias("late"))


def archive_batch(spark, sf_dir):
    """Archived Kafka records read back as a batch."""
    require_runtime(spark)
    folder = scratch_folder(spark, "archive")
    tables.records(spark, sf_dir).write.parquet(folder)
    return bronze_text(quality.classify(file_batch(spark, folder)))


def stream_minute_metrics(spark, sf_dir):
    """Minute metrics by a stream: final minutes from its sink, open ones from its state."""
    require_runtime(spark)
    source, folder = scratch_folder(spark, "silver"), scratch_folder(spark, "minutes")
    tables.silver(spark, sf_dir).write.parquet(source)
    query = _minutes(spark, source, folder, "60 days")
    query.awaitTermination()
    still_open = open_minutes(spark, f"{folder}-checkpoint")
    final = spark.read.schema(still_open.schema).parquet(folder)
    return portable(final.unionByName(still_open))


def table_inspection(spark, sf_dir):
    """What an inspection says of a Silver table with two versions."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "inspected"))
    for feed in ("lineitem", "events"):
        commit_version(tables.silver(spark, sf_dir, feed), roles.silver)
    sections = inspect.inspect_table(spark, roles.silver)
    counted = {name: sections[name] for name in ("row_count", "snapshots_count", "history_count")}
    counted["schema_columns"] = sections["schema"].agg(F.count("*").alias("row_count"))
    parts = [
        frame.select(F.lit(name).alias("section"), "row_count") for name, frame in counted.items()
    ]
    return functools.reduce(DataFrame.union, parts)


def table_files(spark, sf_dir):
    """The listings' own rows: folders with their files and rows, of a table partitioned by symbol."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "listed"))
    version = commit_version(_by_symbol(spark, sf_dir), roles.silver, partition_by=["symbol"])
    sections = inspect.inspect_table(spark, version_table(roles.silver, version))
    files = sections["files"].where("file_size > 0").groupBy("folder").agg(
        F.count("*").alias("files"), F.sum("row_count").alias("row_count")
    )
    parts = sections["partitions"].select(F.concat(F.lit("symbol="), "symbol", F.lit("/")).alias("folder"), F.col("row_count").alias("listed"))
    return files.join(parts, "folder")


def table_versions(spark, sf_dir):
    """Snapshots and history rows of a table with three versions, newest first."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "versions"))
    ids = [commit_version(tables.silver(spark, sf_dir), roles.silver) for _ in range(3)]
    numbers = spark.createDataFrame([(v, i) for i, v in enumerate(ids)], "snapshot_id long, version int")
    sections = inspect.inspect_table(spark, roles.silver)
    listed = sections["history"].join(sections["snapshots"].select("snapshot_id"), "snapshot_id").join(numbers, "snapshot_id")
    return listed.select("version", "is_current_ancestor")


def serving_order(spark, sf_dir):
    """Rows of each month of the serving layout, and files found out of order: none as laid out, all if rewritten."""
    require_runtime(spark)
    folder, other = scratch_folder(spark, "layout"), scratch_folder(spark, "rewritten")
    laid_out = publish.serving_layout(tables.silver_rows(spark, sf_dir, "lineitem"))
    laid_out.write.partitionBy("event_month").parquet(folder)
    stored = spark.read.schema(laid_out.schema).parquet(folder)
    _backwards(stored).write.partitionBy("event_month").parquet(other)
    rewritten = spark.read.schema(laid_out.schema).parquet(other)
    counts = []
    for name, frame in (("laid out", stored), ("rewritten", rewritten)):
        wrong = order.unsorted_files(frame, SERVING_SORT_KEY).withColumnRenamed("file_path", "wrong")
        months = frame.select("event_month", F.col("_metadata.file_path").alias("file")).distinct()
        found = months.join(wrong, F.col("file") == F.col("wrong"), "left").groupBy("event_month").agg(F.max(F.col("wrong").isNotNull()).alias("unsorted"))
        counts.append(found.select(F.lit(name).alias("layout"), "event_month", "unsorted"))
    return counts[0].union(counts[1])


def released_versions(spark, sf_dir):
    """Three publications, then a rollback: versions that are left, and rows served before and after it."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "released"))
    for feed in ("lineitem", "events", "lineitem"):
        commit_version(tables.silver(spark, sf_dir, feed), roles.silver)
        publish.publish(spark, roles.silver, roles)
    namespace = roles.staging.rpartition(".")[0]
    left = [t.name for t in spark.catalog.listTables(namespace) if "__v" in t.name and "staging__v" in t.name and not t.name.endswith("__v0")]
    served = spark.table(roles.serving).count()
    publish.exchange(spark, roles)
    back = spark.table(roles.serving).count()
    return spark.createDataFrame([(len(left), served, back)], "versions long, served long, rolled_back long")


# Extras


def quarantine(spark, sf_dir):
    return bronze_text(audit.quarantine(tables.bronze(spark, sf_dir)))


def dedup_business_key(spark, sf_dir):
    return portable(_earliest(spark, sf_dir))


def offset_gaps(spark, sf_dir):
    """Offsets of invalid records are the gaps of Silver."""
    return audit.offset_gaps(tables.silver(spark, sf_dir))


def newest_event(spark, sf_dir):
    return portable(audit.freshness(tables.silver(spark, sf_dir), FRESH_AT))


def compacted(spark, sf_dir):
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "compacted"))
    commit_version(tables.silver(spark, sf_dir), roles.silver)
    compact.compact(spark, roles.silver)
    return portable(spark.table(roles.silver))


def compacted_files(spark, sf_dir):
    """Files of each folder of a partitioned table before and after compaction, and rows in order after it."""
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "compacted"))
    key = ["event_time", "trade_id"]
    versions = [commit_version(_by_symbol(spark, sf_dir), roles.silver, partition_by=["symbol"])]
    versions.append(compact.compact(spark, roles.silver, sort_by=key))
    versions.append(compact.compact(spark, roles.silver, sort_by=key))  # nothing left to do
    assert versions[1] == versions[2]
    frames = []
    for name, version in zip(("before", "after"), versions, strict=False):
        stored = version_table(roles.silver, version)
        plan = compact.compaction_plan(spark, stored).select("folder", "files", "target_files", "small")
        rows = spark.table(stored).groupBy(F.concat(F.lit("symbol="), "symbol", F.lit("/")).alias("folder")).agg(F.count("*").alias("row_count"))
        frames.append(plan.join(rows, "folder").withColumn("state", F.lit(name)))
    wrong = order.unsorted_files(spark.table(version_table(roles.silver, versions[1])), key).count()
    return frames[0].union(frames[1]).withColumn("out_of_order", F.lit(wrong).cast("long") * F.when(F.col("state") == "after", 1).otherwise(0))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        bronze_classify,
        bulk_bronze_classify,
        bronze_label_counts,
        bulk_label_counts,
        bronze_validity_summary,
        bronze_migrated_mix,
        bronze_classify_faults,
        fault_label_counts,
        trades_parse_strict,
        quality_append,
        silver_trades,
        bulk_silver_trades,
        silver_notional_exact,
        silver_notional_reference,
        wide_notional,
        wide_silver,
        unfit_rows,
        silver_rebuild,
        null_counts,
        row_and_symbol_summary,
        rows_per_symbol,
        symbol_profile,
        count_diff,
        row_hashes,
        multiset_fingerprint,
        stream_fingerprint,
        bulk_fingerprint,
        multiset_diff,
        except_all_diff,
        kpi_row,
        bulk_kpi_row,
        symbol_kpis,
        bulk_symbol_kpis,
        latest_price,
        trades_per_minute,
        notional_per_minute,
        price_over_time,
        bulk_price_over_time,
        latency_over_time,
        latency_histogram,
        symbol_comparison,
        metrics_filtered,
        exchange_envelope_normalise,
        strict_event_validation,
        kafka_encode,
        symbol_filter,
        snapshot_pinned_read,
        serving_layout_counts,
        publish_cycle,
        published_filter,
        stream_bronze_append,
        stream_restart,
        archive_batch,
        stream_label_counts,
        stream_dedup,
        stream_dedup_counts,
        stream_minute_metrics,
        stream_late_minutes,
        stream_late_counts,
        table_inspection,
        table_files,
        table_versions,
        serving_order,
        released_versions,
        quarantine,
        dedup_business_key,
        offset_gaps,
        newest_event,
        compacted,
        compacted_files,
    )
}


def _roles(database: str) -> TableRoles:
    return TableRoles(
        bronze=f"{database}.bronze_trades",
        silver=f"{database}.silver_trades",
        smoke=f"{database}.bronze_trades_quality_smoke",
        serving=f"{database}.serving_trades",
        staging=f"{database}.serving_trades_staging",
    )


def _unbroken(spark, sf_dir, trades) -> DataFrame:
    require_runtime(spark)
    return quality.parse_trades(feeds.as_kafka_records(trades(spark, sf_dir), {}))


def _notional(spark, sf_dir, mode) -> DataFrame:
    return portable(tables.silver(spark, sf_dir, mode=mode))


def _earliest(spark, sf_dir) -> DataFrame:
    return audit.dedup_by_key(tables.silver(spark, sf_dir, "lineitem"))


def _event_columns(spark, sf_dir) -> DataFrame:
    require_runtime(spark)
    return feeds.event_trades(spark, sf_dir).select(
        "exchange",
        "symbol",
        "trade_id",
        "price",
        "quantity",
        "event_time_ms",
        "ingested_at_ms",
    )


def _envelopes(spark, sf_dir) -> DataFrame:
    """The events feed as the exchange would send it."""
    data = F.concat(
        F.lit('{"s":"'),
        "symbol",
        F.lit('","t":'),
        "trade_id",
        F.lit(',"p":"'),
        "price",
        F.lit('","q":"'),
        "quantity",
        F.lit('","T":'),
        F.col("event_time_ms").cast("string"),
        F.lit("}"),
    )
    stream = F.concat(F.lit('{"stream":"'), "symbol", F.lit('@trade","data":'), data, F.lit("}"))
    return _event_columns(spark, sf_dir).select(stream.alias("message"), "ingested_at_ms")


def _bronze_table(spark, sf_dir, roles) -> None:
    spark.sql(create_table_sql(roles.bronze, BRONZE_15))
    tables.bronze(spark, sf_dir).write.insertInto(roles.bronze)


def _published(spark, sf_dir) -> TableRoles:
    require_runtime(spark)
    roles = _roles(scratch_database(spark, "published"))
    for feed in ("events", "lineitem"):
        commit_version(tables.silver_rows(spark, sf_dir, feed), roles.silver)
        publish.publish(spark, roles.silver, roles)
    return roles


def _backwards(stored: DataFrame) -> DataFrame:
    """Rows of the serving layout in falling order. Its files hold a month each, so rows stay where they are scanned."""
    return stored.sortWithinPartitions("event_month", *[F.desc(c) for c in SERVING_SORT_KEY])


def _stream_setup(spark) -> tuple[TableRoles, str, str]:
    roles = _roles(scratch_database(spark, "streamed"))
    spark.sql(create_table_sql(roles.bronze, BRONZE_15))
    return roles, scratch_folder(spark, "records"), scratch_folder(spark, "checkpoint")


def _drain(spark, source, checkpoint, roles):
    query = run_bronze_stream(
        spark,
        file_source(source),
        roles.bronze,
        checkpoint,
        roles,
        fmt="parquet",
        available_now=True,
    )
    query.awaitTermination()
    return query


def _silver_stream(spark, source) -> DataFrame:
    return spark.readStream.schema(SILVER_12.schema).parquet(source)


def _dedup_runs(spark, sf_dir) -> tuple[str, list[tuple]]:
    """Three runs: rows before the first cut; rows up to the second, and the first ones again; the rest, and the
    first ones with event times 15 days on. Returns the sink and each run's counts."""
    require_runtime(spark)
    source, folder = scratch_folder(spark, "silver"), scratch_folder(spark, "unique")
    rows = tables.silver(spark, sf_dir)
    first, second = (F.lit(c).cast("timestamp") for c in CUTS)
    early = rows.where(F.col("event_time") < first)
    later = early.withColumn("event_time", F.expr("event_time + INTERVAL 15 DAYS"))
    runs = (
        early,
        rows.where((F.col("event_time") >= first) & (F.col("event_time") < second)).union(early),
        rows.where(F.col("event_time") >= second).union(later),
    )
    counts = []
    for number, batch in enumerate(runs, 1):
        batch.write.mode("append").parquet(source)
        query = start_dedup(_silver_stream(spark, source), folder, f"{folder}-checkpoint", LATE_BY, available_now=True)
        query.awaitTermination()
        seen = batch_counts(query)
        sums = [sum(getattr(b, name) for b in seen) for name in ("rows_in", "late", "repeats")]
        counts.append((number, *sums, seen[-1].state_rows))
    return folder, counts


def _minutes(spark, source, folder, late_by):
    return start_minutes(_silver_stream(spark, source), folder, f"{folder}-checkpoint", late_by, available_now=True)


def _minute_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame, int]:
    """Two thirds of the rows, then the others. Final minutes, open minutes, and rows that came."""
    require_runtime(spark)
    source, folder = scratch_folder(spark, "silver"), scratch_folder(spark, "minutes")
    rows, rows_in = tables.silver(spark, sf_dir), 0
    other = F.col("trade_id").cast("long") % 3 == 0
    for batch in (rows.where(~other), rows.where(other)):
        batch.write.mode("append").parquet(source)
        query = _minutes(spark, source, folder, LATE_BY)
        query.awaitTermination()
        rows_in += observed_totals(query, "minutes_in")["row_count"]
    still_open = open_minutes(spark, f"{folder}-checkpoint")
    return spark.read.schema(still_open.schema).parquet(folder), still_open, rows_in


def _by_symbol(spark, sf_dir) -> DataFrame:
    """Silver in six files for each symbol."""
    rows = tables.silver(spark, sf_dir)
    return rows.repartition(6).select(*[c for c in rows.columns if c != "symbol"], "symbol")


def _wide_bronze(spark, sf_dir) -> DataFrame:
    """Valid Bronze rows with very large and very finely cut operands, made of the events' own numbers."""
    rows = tables.bronze(spark, sf_dir).where("is_valid AND kafka_offset IS NOT NULL")
    number = F.col("trade_id").cast("long")
    digits = (number * 7919) % 1_000_003 + 1
    other = (number * 104_729) % 999_983 + 1
    shifted = lambda value, by: F.concat(value.cast("string"), F.lit("E"), by.cast("string")).cast(MONEY)
    price = shifted(digits, number % 21 - 8)
    quantity = shifted(other, number % 17 - 12)
    return rows.withColumn("price", price).withColumn("quantity", quantity).select(*BRONZE_15.columns)
