import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import EVENT
from tradeweir.contracts import TRADE_EVENT
from tradeweir.errors import PipelineError
from tradeweir.operators.producer import (
    allow_symbols,
    check_events,
    encode_for_kafka,
    normalise_envelope,
    stamp_arrival,
)
from tradeweir.operators.quality import classify

DATA = {"s": "ACMEUR", "t": 7001, "p": "417.25", "q": "2.75", "T": 1718000000250}


def _messages(spark, *texts):
    return spark.createDataFrame([(t, 1718000000700) for t in texts], "message string, ingested_at_ms bigint")


def _envelope(**changes):
    data = {k: v for k, v in {**DATA, **changes}.items() if v is not ...}
    return json.dumps({"stream": "acmeur@trade", "data": data})


def _events(spark, *changes):
    rows = [tuple({**EVENT, **c}[n] for n in TRADE_EVENT.columns) for c in changes]
    return spark.createDataFrame(rows, TRADE_EVENT.ddl)


def test_envelope(spark):
    out = normalise_envelope(_messages(spark, _envelope()), exchange="northex")
    assert out.schema.simpleString() == TRADE_EVENT.schema.simpleString()
    assert out.first().asDict() == EVENT
    with_extra = normalise_envelope(_messages(spark, _envelope(m=True, E=1, t="77")), exchange="northex")
    assert with_extra.first().trade_id == "77"


BROKEN = [
    "{not-json",
    "[]",
    "[" + _envelope() + "]",
    '"text"',
    "null",
    '{"stream":"x"}',
    '{"data":null}',
    '{"data":[1]}',
    '{"data":"x"}',
    *[_envelope(**{k: ...}) for k in DATA],
    _envelope(T=1.5),
]


@pytest.mark.parametrize("text", BROKEN)
def test_strict_envelope_fails(spark, text):
    with pytest.raises(PySparkException, match="not a trade message"):
        normalise_envelope(_messages(spark, text), exchange="northex").collect()


def test_safe_envelope_gives_nulls(spark):
    out = normalise_envelope(_messages(spark, *BROKEN, _envelope()), exchange="northex", strict=False).collect()
    assert len(out) == len(BROKEN) + 1
    assert [r.symbol for r in out[:9]] == [None] * 9
    assert all(None in tuple(r) for r in out[:-1]) and out[-1].asDict() == EVENT


def test_event_model(spark):
    cases = [
        ({}, []),
        ({"exchange": " "}, ["exchange"]),
        ({"symbol": "\t\n"}, ["symbol"]),
        ({"trade_id": None}, ["trade_id"]),
        ({"price": "0", "quantity": "x"}, ["price", "quantity"]),
        ({"event_time_ms": 0, "ingested_at_ms": -1}, ["event_time_ms", "ingested_at_ms"]),
        ({"quantity": None, "event_time_ms": None}, ["quantity", "event_time_ms"]),
    ]
    out = check_events(_events(spark, *[c for c, _ in cases])).collect()
    assert [r.problems for r in out] == [p for _, p in cases]
    padded = check_events(_events(spark, {"symbol": "  ETH  "}), strict=True).first()
    assert padded.symbol == "ETH"
    with pytest.raises(PySparkException, match="price, quantity"):
        check_events(_events(spark, {"price": "0", "quantity": "x"}), strict=True).collect()


def test_encoding(spark):
    row = encode_for_kafka(_events(spark, {})).first()
    assert row.key == "northex:ACMEUR"
    assert row.value == json.dumps(EVENT, separators=(",", ":"))
    typed = _events(spark, {}, {"price": "10", "quantity": "0.5000"}).withColumns(
        {c: F.col(c).cast("decimal(38,18)") for c in ("price", "quantity")}
    )
    first, second = (json.loads(r.value) for r in encode_for_kafka(typed).collect())
    assert (first["price"], first["quantity"]) == ("417.25", "2.75")
    assert (second["price"], second["quantity"]) == ("10", "0.5")


def test_encoded_events_classify_as_valid(spark):
    coded = encode_for_kafka(_events(spark, {}))
    records = coded.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(1).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    assert classify(records).first().is_valid


def test_symbol_list(spark):
    frame = _events(spark, {}, {"symbol": "XRP"})
    assert [r.symbol for r in allow_symbols(frame, ["ACMEUR", "BETAUSD"]).collect()] == ["ACMEUR"]
    with pytest.raises(PipelineError):
        allow_symbols(frame, [])


def test_arrival_stamp_is_one_instant(spark):
    out = stamp_arrival(spark.range(100).repartition(4)).select("ingested_at_ms").distinct()
    assert out.count() == 1 and out.first().ingested_at_ms > 1_700_000_000_000
