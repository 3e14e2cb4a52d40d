"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` a comma-separated
choice of queries. Each query is run twice into a sink that discards rows: the first time is
reported under ``cold``, the second under ``queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import tables
from checks.compare import small_session
from checks.queries import QUERIES, flagship
from tradeweir.operators import quality
from tradeweir.operators.silver import build_silver

HEADLINE = (
    "bronze_classify",
    "bulk_bronze_classify",
    "bulk_label_counts",
    "bronze_validity_summary",
    "trades_parse_strict",
    "silver_trades",
    "bulk_silver_trades",
    "silver_notional_reference",
    "null_counts",
    "row_and_symbol_summary",
    "rows_per_symbol",
    "count_diff",
    "row_hashes",
    "multiset_fingerprint",
    "bulk_fingerprint",
    "multiset_diff",
    "except_all_diff",
    "kpi_row",
    "bulk_kpi_row",
    "bulk_symbol_kpis",
    "latest_price",
    "trades_per_minute",
    "notional_per_minute",
    "bulk_price_over_time",
    "latency_over_time",
    "latency_histogram",
    "symbol_comparison",
    "metrics_filtered",
    "exchange_envelope_normalise",
    "strict_event_validation",
    "kafka_encode",
    "serving_layout_counts",
    "stream_bronze_append",
    "publish_cycle",
    "offset_gaps",
    "dedup_business_key",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = small_session("bench", os.environ.get("BENCH_CPUS", "8"))
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for feed in tables.FEEDS:
        for step, build in (("bronze", tables.bronze), ("silver", tables.silver)):
            cold[f"write_{step}_{feed}"] = _seconds(lambda: build(spark, sf_dir, feed))
    todo = {name: QUERIES[name] for name in chosen}
    todo["flagship"] = flagship
    # Raw records already stored, as a stream or an archive holds them: parsing cost alone.
    archive = tables.stored_records(spark, sf_dir, "lineitem")
    todo["classify_archive"] = lambda *_: quality.classify(archive)
    todo["archive_to_silver"] = lambda *_: build_silver(quality.classify(archive))
    for name, query in todo.items():
        for times in (cold, warm):
            times[name] = _seconds(lambda: _drain(query(spark, sf_dir)))
    rows = archive.count()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "classify_rows_per_second": round(rows / warm["classify_archive"]),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


def _drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def _seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
