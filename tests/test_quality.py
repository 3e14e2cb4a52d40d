import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import EVENT, event_json, kafka_rows
from tradeweir.contracts import BRONZE_13, BRONZE_15, TRADE_EVENT
from tradeweir.operators.quality import (
    Rule,
    as_not_evaluated,
    broken_labels,
    classify,
    label_counts,
    parse_trades,
    validity_summary,
)
from tradeweir.operators.silver import build_silver

NO_VALUE = [
    "MISSING_EXCHANGE",
    "MISSING_SYMBOL",
    "MISSING_TRADE_ID",
    "MISSING_PRICE",
    "MISSING_QUANTITY",
    "MISSING_EVENT_TIME",
    "MISSING_INGESTED_AT",
]

CASES = {
    "clean": ({}, []),
    "null value": ({"value": None}, ["NULL_RAW_JSON"]),
    "not json": ({"value": "{not-json"}, ["MALFORMED_JSON"]),
    "bad price": ({"value": event_json(price="not-a-decimal")}, ["INVALID_PRICE"]),
    "bad quantity": ({"value": event_json(quantity="not-a-decimal")}, ["INVALID_QUANTITY"]),
    "zero price": ({"value": event_json(price="0")}, ["NON_POSITIVE_PRICE"]),
    "negative quantity": ({"value": event_json(quantity="-2.75")}, ["NON_POSITIVE_QUANTITY"]),
    "identity": (
        {"value": event_json(exchange=None, symbol="   ", trade_id=None)},
        ["MISSING_EXCHANGE", "MISSING_SYMBOL", "MISSING_TRADE_ID"],
    ),
    "no numbers": (
        {"value": event_json(price=None, quantity=None)},
        ["MISSING_PRICE", "MISSING_QUANTITY"],
    ),
    "times": (
        {"value": event_json(event_time_ms=None, ingested_at_ms=0)},
        ["MISSING_EVENT_TIME", "NON_POSITIVE_INGESTED_AT"],
    ),
    "more times": (
        {"value": event_json(event_time_ms=-1, ingested_at_ms=None)},
        ["NON_POSITIVE_EVENT_TIME", "MISSING_INGESTED_AT"],
    ),
    "no coordinates": (
        {"topic": None, "partition": None, "offset": None},
        ["MISSING_KAFKA_TOPIC", "MISSING_KAFKA_PARTITION", "MISSING_KAFKA_OFFSET"],
    ),
    "blank topic": ({"topic": " "}, ["MISSING_KAFKA_TOPIC"]),
    "mixed": (
        {"value": event_json(trade_id=None, price="oops", quantity="-1")},
        ["MISSING_TRADE_ID", "INVALID_PRICE", "NON_POSITIVE_QUANTITY"],
    ),
    "extra field": ({"value": event_json(extra="x")}, []),
    "own key": ({"key": b"custom-key"}, []),
    "no key": ({"key": None, "timestamp": None}, []),
    "broken json hides coordinates": ({"value": "{", "topic": None}, ["MALFORMED_JSON"]),
    "null json hides coordinates": ({"value": None, "offset": None}, ["NULL_RAW_JSON"]),
    "empty": ({"value": ""}, ["MALFORMED_JSON"]),
    "blanks": ({"value": "   "}, ["MALFORMED_JSON"]),
    "json null": ({"value": "null"}, ["MALFORMED_JSON"]),
    "empty array": ({"value": "[]"}, ["MALFORMED_JSON"]),
    "array": ({"value": "[1]"}, ["MALFORMED_JSON"]),
    "array of object": ({"value": '[{"symbol":"Z"}]'}, ["MALFORMED_JSON"]),
    "json text": ({"value": '"str"'}, ["MALFORMED_JSON"]),
    "json number": ({"value": "123"}, ["MALFORMED_JSON"]),
    "empty object": ({"value": "{}"}, NO_VALUE),
    "text after object": ({"value": event_json() + " trailing"}, []),
    "leading space": ({"value": " \t\r\n" + event_json()}, []),
    "text time": ({"value": event_json(event_time_ms="12")}, ["MISSING_EVENT_TIME"]),
    "fraction time": ({"value": event_json(event_time_ms=1.5)}, ["MISSING_EVENT_TIME"]),
    "exponent": ({"value": event_json(price="1e3")}, []),
    "padded": ({"value": event_json(price=" 1.5 ")}, []),
    "empty price": ({"value": event_json(price="")}, ["INVALID_PRICE"]),
    "nan": ({"value": event_json(price="NaN")}, ["INVALID_PRICE"]),
    "21 digits": ({"value": event_json(price="1" * 21)}, ["INVALID_PRICE"]),
    "19 decimals": ({"value": event_json(price="1.0000000000000000005")}, []),
    "tab symbol": ({"value": event_json(symbol="\t")}, []),
    "nbsp symbol": ({"value": event_json(symbol=" ")}, []),
    "other case": ({"value": event_json().replace("symbol", "Symbol")}, ["MISSING_SYMBOL"]),
    "reserved name": ({"value": event_json(bad_text="x")}, []),
}


def test_every_label_case(spark):
    names = list(CASES)
    frame = kafka_rows(spark, *[{**CASES[n][0], "key": n.encode()} for n in names])
    out = classify(frame)
    BRONZE_15.require(out)
    found = {r.kafka_key: r for r in out.collect()}
    assert len(found) == len(names)
    for name in names:
        assert found[name].validation_errors == CASES[name][1], name
        assert found[name].is_valid == (CASES[name][1] == []), name


def test_values_and_audit_columns_survive(spark):
    bad, good, price = classify(
        kafka_rows(
            spark,
            {"value": "{bad-json", "offset": 1},
            {"offset": 2, "key": b"custom-key"},
            {"value": event_json(price="1.0000000000000000005"), "offset": 3},
        )
    ).collect()
    assert (bad.raw_json, bad.kafka_offset, bad.symbol, bad.price) == ("{bad-json", 1, None, None)
    assert good.kafka_key == "custom-key" and str(good.price) == "417.250000000000000000"
    assert (good.event_time_ms, good.kafka_topic) == (EVENT["event_time_ms"], "market.trades.raw")
    assert str(price.price) == "1.000000000000000001"


def test_numeric_json_price_reads_as_text(spark):
    row = classify(kafka_rows(spark, {"value": event_json(price=1.50)})).first()
    assert row.is_valid and str(row.price) == "1.500000000000000000"


def _schema_free_rule(records):
    """Well-formedness by its definition: the payload parses as an object of anything."""
    text = F.col("value").cast("string")
    probe = F.from_json(text, "MAP<STRING, STRING>")
    fields = F.from_json(text, TRADE_EVENT.ddl)
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        (text.isNotNull() & probe.isNull()).alias("malformed"),
        *[fields[c].cast("string").alias(c) for c in ("exchange", "symbol", "event_time_ms")],
    )


def test_single_parse_agrees_with_schema_free_parse(spark):
    """The fast path must not change which payloads count as malformed, nor any field."""
    rng = random.Random(7)
    base = [
        event_json(),
        "{}",
        '{"a":{"b":[1,{"c":null}]},"price":{"x":1},"symbol":[1,2]}',
        '{"event_time_ms":"12","ingested_at_ms":1e3,"price":NaN,"x":Infinity}',
        '{"event_time_ms":99999999999999999999,"symbol":"\\u00e9\\n"}',
        '{"symbol":"A","symbol":"B"}',
        '{"symbol":true,"exchange":null,"trade_id":7}',
        '[{"symbol":"Z"}]',
        "// note\n{}",
        "{'symbol':'q'}",
        '{"x":"\\q"}',
        '{"x":"a\tb"}',
        '{"x":01}',
        "﻿{}",
        '{"a":1}{"b":2}',
        '{"a":1},',
    ]
    alphabet = '{}[]",:\\ \t\nn0ae.-+"1' + "'/"
    texts = list(base)
    for _ in range(6000):
        text = list(rng.choice(base))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(text) + 1)
            action = rng.random()
            if action < 0.4 and text:
                del text[min(at, len(text) - 1)]
            elif action < 0.8:
                text.insert(at, rng.choice(alphabet))
            else:
                text = text[:at]
        texts.append("".join(text))
    records = kafka_rows(
        spark, *[{"value": t, "key": str(n).encode()} for n, t in enumerate(texts)]
    )
    slow = {r.kafka_key: r for r in _schema_free_rule(records).collect()}
    malformed = 0
    for row in classify(records).collect():
        want = slow[row.kafka_key]
        text = texts[int(row.kafka_key)]
        assert ("MALFORMED_JSON" in row.validation_errors) == want.malformed, text
        if not want.malformed:
            time = None if row.event_time_ms is None else str(row.event_time_ms)
            assert (row.exchange, row.symbol, time) == (
                want.exchange,
                want.symbol,
                want.event_time_ms,
            ), text
        malformed += want.malformed
    assert 500 < malformed < len(texts) - 500


def test_rows_in_equal_rows_out_and_order_free_counts(spark):
    frame = kafka_rows(spark, {}, {}, {"value": None}, {"value": "x"}, {"topic": None})
    out = classify(frame)
    assert out.count() == 5
    assert {r.label: r.row_count for r in label_counts(out).collect()} == {
        "NULL_RAW_JSON": 1,
        "MALFORMED_JSON": 1,
        "MISSING_KAFKA_TOPIC": 1,
    }


def test_not_evaluated_is_a_third_state(spark):
    old = as_not_evaluated(parse_trades(kafka_rows(spark, {}, {})))
    BRONZE_15.require(old)
    new = classify(kafka_rows(spark, {}, {"value": None}))
    states = {r.state: r.row_count for r in validity_summary(old.union(new)).collect()}
    assert states == {"valid": 1, "invalid": 1, "not_evaluated": 2}
    assert build_silver(old.union(new)).count() == 1


def test_strict_parse_types_and_failure(spark):
    out = parse_trades(kafka_rows(spark, {}))
    BRONZE_13.require(out)
    assert str(out.first().quantity) == "2.750000000000000000"
    with pytest.raises(PySparkException):
        parse_trades(kafka_rows(spark, {"value": event_json(price="oops")})).collect()


def test_rule_engine_serves_other_tables(spark):
    gates = [Rule("GONE", "a IS NULL")]
    rules = [Rule("SMALL", "a < 10"), Rule("ODD", "a % 2 = 1"), Rule("UNKNOWN", "b > 1")]
    frame = spark.sql("SELECT * FROM VALUES (NULL, NULL), (3, NULL), (12, 5), (12, NULL) AS t(a, b)")
    found = [r.e for r in frame.select(broken_labels(gates, rules).alias("e")).collect()]
    assert found == [["GONE"], ["SMALL", "ODD"], ["UNKNOWN"], []]


def test_payload_is_parsed_once(spark):
    """A filter on the result must not pull a second parse below the first."""
    plan = build_silver(classify(kafka_rows(spark, {})))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    struct_parses = text.count("from_json(StructField(exchange")
    assert struct_parses == 1, text
