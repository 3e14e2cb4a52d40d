import threading
import time
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from tests.rows import NOON, event_json, kafka_rows, silver_rows
from tradeweir.contracts import BRONZE_13, BRONZE_15, SILVER_12, TableRoles, create_table_sql
from tradeweir.errors import CheckpointEpochError, ContractError, PipelineError, RoleError
from tradeweir.operators.quality import classify, parse_trades
from tradeweir.sources.kafka import (
    file_batch,
    file_source,
    file_stream,
    kafka_options,
    kafka_source,
    static_records,
)
from tradeweir.streaming.bronze import (
    COUNTS,
    check_epoch,
    has_offsets,
    run_bronze_stream,
    run_until,
    start_append,
    start_console,
)
from tradeweir.streaming.dedup import dedup_stream, start_dedup
from tradeweir.streaming.minutes import minute_metrics, open_minutes, start_minutes
from tradeweir.streaming.progress import batch_counts, observed_totals

RETIRED = ("s3a://lake/checkpoints/first", "s3a://lake/checkpoints/second")


@pytest.fixture
def stream(spark, database, tmp_path):
    """A Bronze table, a folder of raw records, and a function that takes up what is there."""
    roles = TableRoles(bronze=f"{database}.bronze")
    spark.sql(create_table_sql(roles.bronze, BRONZE_15))
    source, checkpoint = str(tmp_path / "records"), str(tmp_path / "checkpoint")

    def put(*changes):
        kafka_rows(spark, *changes).coalesce(1).write.mode("append").parquet(source)

    def drain():
        run_bronze_stream(
            spark,
            file_source(source),
            roles.bronze,
            checkpoint,
            roles,
            fmt="parquet",
            available_now=True,
        ).awaitTermination()
        return sorted(r.kafka_offset for r in spark.table(roles.bronze).collect())

    return roles, put, drain, source, checkpoint


def test_restart_appends_new_records_once(stream):
    _, put, drain, _, _ = stream
    put({"offset": 0}, {"offset": 1, "value": "{bad"}, {"offset": 2, "value": None})
    assert drain() == [0, 1, 2]
    assert drain() == [0, 1, 2]
    put({"offset": 3}, {"offset": 4})
    assert drain() == [0, 1, 2, 3, 4]


def test_stream_equals_batch(spark, stream):
    roles, put, drain, source, _ = stream
    put({"offset": 0}, {"offset": 1, "value": event_json(price="0")}, {"offset": 2, "topic": None})
    drain()
    batch = classify(file_batch(spark, source))
    assert spark.table(roles.bronze).exceptAll(batch).isEmpty()
    assert batch.exceptAll(spark.table(roles.bronze)).isEmpty()


def test_gates_run_before_the_source_is_opened(spark, stream, database):
    roles, put, _, _, checkpoint = stream
    put({})

    def never(*_):
        raise AssertionError("the source was opened")

    with pytest.raises(CheckpointEpochError):
        run_bronze_stream(spark, never, roles.bronze, RETIRED[0], roles, retired=RETIRED)
    with pytest.raises(RoleError):
        run_bronze_stream(spark, never, roles.silver, checkpoint, roles)
    legacy = TableRoles(bronze=f"{database}.legacy")
    with pytest.raises(ContractError):
        run_bronze_stream(spark, never, legacy.bronze, checkpoint, legacy)
    spark.sql(create_table_sql(legacy.bronze, BRONZE_13))
    with pytest.raises(ContractError):
        run_bronze_stream(spark, never, legacy.bronze, checkpoint, legacy)
    assert spark.table(legacy.bronze).columns == BRONZE_13.columns
    assert not spark.streams.active


def test_first_start_and_restart_open_the_source_differently(spark, stream):
    roles, put, _, source, checkpoint = stream
    put({"offset": 1}, {"offset": 2, "value": event_json(price="0", symbol=" ")})
    asked, queries = [], []

    def opened(session, starting):
        asked.append(starting)
        return file_stream(session, source)

    for _ in range(2):
        query = run_bronze_stream(spark, opened, roles.bronze, checkpoint, roles, fmt="parquet", available_now=True)
        query.awaitTermination()
        queries.append(query)
    assert asked == ["latest", None] and has_offsets(spark, checkpoint)
    counts = observed_totals(queries[0], COUNTS)
    assert (counts["rows"], counts["valid"]) == (2, 1)
    assert {k for k, v in counts.items() if v} == {"rows", "valid", "MISSING_SYMBOL", "NON_POSITIVE_PRICE"}
    assert not has_offsets(spark, checkpoint + "-other")


def test_epoch_guard_is_exact():
    for path in RETIRED:
        with pytest.raises(CheckpointEpochError):
            check_epoch(path, RETIRED)
        assert check_epoch(path + "-x", RETIRED) == path + "-x"
        assert check_epoch(path) == path
    with pytest.raises(CheckpointEpochError):
        check_epoch("")


def test_append_with_trigger_and_name(spark, stream):
    roles, put, _, source, checkpoint = stream
    put({"offset": 5})
    query = start_append(
        classify(file_stream(spark, source)),
        roles.bronze,
        checkpoint,
        fmt="parquet",
        name="bronze_append",
        processing_time="1 second",
    )
    assert query.name == "bronze_append"
    query.processAllAvailable()
    stop = threading.Event()
    stop.set()
    run_until(query, stop)
    assert not query.isActive and spark.table(roles.bronze).count() == 1


def test_run_until_waits_for_the_stop_event(spark, stream):
    roles, put, _, source, checkpoint = stream
    put({})
    query = start_append(
        classify(file_stream(spark, source)), roles.bronze, checkpoint, fmt="parquet"
    )
    query.processAllAvailable()
    stop = threading.Event()
    threading.Timer(0.5, stop.set).start()
    begun = time.time()
    run_until(query, stop, 0.1)
    assert 0.4 < time.time() - begun < 20 and not query.isActive


def test_run_until_reports_the_first_failure(spark, stream):
    roles, put, _, source, checkpoint = stream
    put({"value": event_json(price="oops")})
    strict = parse_trades(file_stream(spark, source))
    query = strict.writeStream.format("noop").option("checkpointLocation", checkpoint).start()
    with pytest.raises(StreamingQueryException):
        run_until(query, threading.Event(), 0.2)
    assert not query.isActive


def test_run_until_keeps_the_primary_error():
    class Query:
        def awaitTermination(self, seconds):
            raise ValueError("primary")

        def stop(self):
            raise RuntimeError("secondary")

    with pytest.raises(ValueError, match="primary") as caught:
        run_until(Query(), threading.Event())
    assert "secondary" in caught.value.__notes__[0]


def test_console(spark, stream):
    _, put, _, source, _ = stream
    put({"offset": 77})
    query = start_console(file_stream(spark, source), "shown")
    query.processAllAvailable()
    rows = sum(p["numInputRows"] for p in query.recentProgress)
    sink = query.lastProgress["sink"]["description"]
    query.stop()
    assert (query.name, rows) == ("shown", 1)
    assert "onsole" in sink


def test_kafka_options():
    assert kafka_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "subscribe": "t"}
    assert kafka_options("b:1", "t", "latest")["startingOffsets"] == "latest"
    assert callable(kafka_source("b:1", "t"))


def test_static_records(spark):
    frame = static_records(spark, [(b"k", b"{}", "t", 0, 1, NOON)])
    assert classify(frame).first().kafka_offset == 1


def test_minute_metrics_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "silver"), str(tmp_path / "minutes")
    rows = silver_rows(
        spark,
        *[{"symbol": f"S{n % 2}", "kafka_offset": n, "latency_ms": n} for n in range(20)],
    )
    rows.write.parquet(source)
    batch = {tuple(r) for r in minute_metrics(rows).collect()}
    frame = minute_metrics(spark.readStream.schema(SILVER_12.schema).parquet(source))
    writer = frame.writeStream.format("parquet").option("checkpointLocation", out + "-c")
    writer = writer.trigger(availableNow=True)
    writer.start(out).awaitTermination()
    assert spark.read.schema(frame.schema).parquet(out).count() == 0  # minute still open
    late = {"symbol": "late", "event_time": NOON.replace(year=2027)}
    silver_rows(spark, late).write.mode("append").parquet(source)
    writer.start(out).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == batch


def _silver_feed(spark, source):
    return spark.readStream.schema(SILVER_12.schema).parquet(source)


def _at(minutes):
    return NOON + timedelta(minutes=minutes)


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "silver"), str(tmp_path / "unique")

    def run(*changes):
        silver_rows(spark, *changes).coalesce(1).write.mode("append").parquet(source)
        query = start_dedup(_silver_feed(spark, source), out, out + "-c", "10 minutes", available_now=True)
        query.awaitTermination()
        counts = batch_counts(query)
        return sum(c.late for c in counts), sum(c.repeats for c in counts), counts[-1].state_rows

    a = {"trade_id": "a", "event_time": _at(0)}
    b = {"trade_id": "b", "event_time": _at(8)}
    assert run(a, a, b) == (0, 1, 2)  # twice in one batch
    assert run(a, {**a, "event_time": _at(5)}) == (0, 2, 2)  # again, and again with another time
    assert run({"trade_id": "c", "event_time": _at(25)}) == (0, 0, 2)  # the watermark is at 15: a is forgotten
    assert run(a, {**a, "event_time": _at(20)}, {**b, "event_time": _at(17)}) == (1, 1, 3)  # late, new, repeat
    got = sorted((r.trade_id, r.event_time) for r in spark.read.parquet(out).collect())
    local = lambda m: _at(m).replace(tzinfo=None)
    assert got == [("a", local(0)), ("a", local(20)), ("b", local(8)), ("c", local(25))]


def test_dedup_needs_keys_and_a_stream(spark, tmp_path):
    rows = silver_rows(spark, {})
    rows.write.parquet(str(tmp_path / "s"))
    with pytest.raises(PipelineError):
        dedup_stream(rows, "1 minute")
    with pytest.raises(PipelineError):
        dedup_stream(_silver_feed(spark, str(tmp_path / "s")), "1 minute", [])


def test_late_rows_are_left_out_and_open_minutes_can_be_read(spark, tmp_path):
    source, out = str(tmp_path / "silver"), str(tmp_path / "minutes")
    rows_in = 0

    def run(*minutes):
        nonlocal rows_in
        changes = [{"event_time": _at(m), "kafka_offset": i, "price": Decimal(m)} for i, m in enumerate(minutes)]
        silver_rows(spark, *changes).coalesce(1).write.mode("append").parquet(source)
        query = start_minutes(_silver_feed(spark, source), out, out + "-c", "2 minutes", available_now=True)
        query.awaitTermination()
        rows_in += observed_totals(query, "minutes_in")["row_count"]
        final = {(r.minute.minute, r.trade_count, r.latest_price) for r in spark.read.parquet(out).collect()}
        return final, {(r.minute.minute, r.trade_count, r.latest_price) for r in open_minutes(spark, out + "-c").collect()}

    final, still_open = run(0, 1, 5)
    assert final == {(0, 1, 0), (1, 1, 1)} and still_open == {(5, 1, 5)}
    final, still_open = run(1, 2, 4, 5)  # the watermark is at 3: minutes 1 and 2 are over
    assert final == {(0, 1, 0), (1, 1, 1)} and still_open == {(4, 1, 4), (5, 2, 5)}
    assert rows_in - sum(n for _, n, _ in final | still_open) == 2
    final, still_open = run(9)
    assert final == {(0, 1, 0), (1, 1, 1), (4, 1, 4), (5, 2, 5)} and still_open == {(9, 1, 9)}
