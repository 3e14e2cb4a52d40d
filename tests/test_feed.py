from pyspark.sql import functions as F

from checks import tables
from checks.queries import QUERIES, _backwards
from tradeweir.contracts import SERVING_SORT_KEY
from tradeweir.operators.order import unsorted_files
from tradeweir.plans.publish import serving_layout
from tradeweir.sources import feed
from tradeweir.sources.tables import filled_splits, scan_parquet

SF_DIR = "/root/testdata/sf0.001"


def _copy(spark, folder, files):
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    rows.repartition(files).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def _dealt(frame):
    return "Repartition" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_only_a_table_of_few_splits_is_dealt_out(spark, tmp_path):
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in sizes:
        spark.conf.set(name, "64k")
    try:
        one, many = _copy(spark, tmp_path / "one", 1), _copy(spark, tmp_path / "many", tables.FILES)
        # A file of several splits but one row group has one split with rows.
        assert filled_splits(scan_parquet(spark, f"{one}/lineitem.parquet")) == 1
        assert filled_splits(scan_parquet(spark, f"{many}/lineitem.parquet")) == tables.FILES
        query = QUERIES["bulk_bronze_classify"]
        assert _dealt(query(spark, one)) and not _dealt(query(spark, many))
        assert query(spark, one).exceptAll(query(spark, many)).count() == 0
        assert query(spark, one).count() == query(spark, many).count() == scan_parquet(spark, f"{SF_DIR}/lineitem.parquet").count()
    finally:
        for name in sizes:
            spark.conf.unset(name)


def test_label_counts_are_the_same_however_rows_are_dealt(spark, tmp_path):
    whole = sorted(map(tuple, QUERIES["bulk_label_counts"](spark, SF_DIR).collect()))
    many = _copy(spark, tmp_path / "many", tables.FILES)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split for each file
    try:
        counts = QUERIES["bulk_label_counts"](spark, many)
        assert "RoundRobin" not in counts._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, counts.collect())) == whole
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_table_that_is_dealt_out_gets_more_parts_as_it_grows(spark, monkeypatch):
    rows = scan_parquet(spark, f"{SF_DIR}/lineitem.parquet").count()
    whole = sorted(map(tuple, QUERIES["bulk_label_counts"](spark, SF_DIR).collect()))
    for part_rows, parts in ((rows, tables.FILES), (rows // 20, 20 + (rows % 20 > 0))):
        monkeypatch.setattr(feed, "PART_ROWS", part_rows, raising=False)
        assert tables.records(spark, SF_DIR, "lineitem").rdd.getNumPartitions() == parts
        assert sorted(map(tuple, QUERIES["bulk_label_counts"](spark, SF_DIR).collect())) == whole


def test_rows_are_dealt_out_evenly_without_a_sort_even_if_all_are_equal(spark, tmp_path):
    one = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(1)
    spark.createDataFrame(one.collect() * 1000, one.schema).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    dealt = feed.lineitem_trades(spark, str(tmp_path), tables.FILES)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "RoundRobin" not in plan and "Sort" not in plan
    counts = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in counts) == [1000 // tables.FILES] * tables.FILES


def test_a_publication_of_computed_rows_stores_neither_bronze_nor_silver_first(spark, tmp_path):
    for table in ("events", "lineitem"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    found = sorted(map(tuple, QUERIES["published_filter"](spark, str(tmp_path)).collect()))
    assert not [key for key in tables._written if str(tmp_path) in key]
    tables.silver(spark, str(tmp_path), "lineitem")  # stored, it is read
    assert found == sorted(map(tuple, QUERIES["published_filter"](spark, str(tmp_path)).collect()))


def test_the_serving_layout_is_rewritten_backwards_without_a_shuffle(spark, tmp_path):
    laid_out = serving_layout(tables.silver(spark, SF_DIR, "lineitem"))
    laid_out.write.partitionBy("event_month").parquet(f"{tmp_path}/layout")
    stored = spark.read.schema(laid_out.schema).parquet(f"{tmp_path}/layout")
    backwards = _backwards(stored)
    assert "Exchange" not in backwards._jdf.queryExecution().executedPlan().toString()
    backwards.write.partitionBy("event_month").parquet(f"{tmp_path}/backwards")
    rewritten = spark.read.schema(laid_out.schema).parquet(f"{tmp_path}/backwards")
    assert rewritten.exceptAll(stored).count() == 0 and rewritten.count() == stored.count()
    files = rewritten.groupBy("_metadata.file_path").count()
    assert unsorted_files(rewritten, SERVING_SORT_KEY).count() == files.where("count > 1").count() > 0
    assert unsorted_files(stored, SERVING_SORT_KEY).count() == 0
