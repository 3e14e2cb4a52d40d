from types import SimpleNamespace

import pytest

from tradeweir.contracts import SILVER_12, TableRoles
from tradeweir.errors import (
    ContractError,
    IdentifierError,
    NullsFoundError,
    PipelineError,
    RoleError,
    SnapshotError,
)
from tradeweir.plans.jdbc_copy import load_jdbc_staging
from tradeweir.session import (
    catalog_conf,
    cluster_conf,
    credentials_from_env,
    object_store_conf,
    require_runtime,
    scratch_folder,
)
from tradeweir.sources.jdbc import (
    append_copy,
    clickhouse_target,
    jdbc_options,
    count_statement,
    equal_ranges,
    partitioned_read_options,
    replace_staging,
)
from tradeweir.sources.snapshots import commit_version
from tests.rows import silver_rows

STORE = {"endpoint": "http://s", "region": "r", "access_key": "a", "secret_key": "b"}


def test_catalog_settings():
    conf = catalog_conf("cat", uri="http://c", warehouse="s3://w", **STORE)
    assert len(conf) == 11
    assert conf["spark.sql.catalog.cat.type"] == "rest"
    assert conf["spark.sql.catalog.cat.s3.path-style-access"] == "true"


def test_object_store_settings():
    conf = object_store_conf(**STORE, path_style=False)
    assert len(conf) == 8
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "false"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_cluster_sizes_follow_the_cores():
    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "32000"


def test_credentials_come_from_the_environment():
    env = {"AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b"}
    assert credentials_from_env(env) == {"access_key": "a", "secret_key": "b"}
    with pytest.raises(PipelineError, match="AWS_SECRET_ACCESS_KEY"):
        credentials_from_env({"AWS_ACCESS_KEY_ID": "a"})


def test_ansi_and_zone_are_pinned(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.ansi.enabled", "false")
    require_runtime(other)
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert other.conf.get("spark.sql.ansi.enabled") == "true"


def test_scratch_follows_the_cluster_setting():
    settings = {"spark.checkpoint.dir": "hdfs://shared/tmp/"}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=settings.get))
    first, second = scratch_folder(cluster, "x"), scratch_folder(cluster, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second


def test_jdbc_options():
    target = clickhouse_target("h", 18123, "market_analytics", "u", "secret")
    assert "secret" not in repr(target)
    options = jdbc_options(target, "market_analytics.silver_trades_staging")
    assert options["url"] == "jdbc:clickhouse://h:18123/market_analytics?session_timezone=UTC"
    assert options["dbtable"] == "market_analytics.silver_trades_staging"
    assert partitioned_read_options(0, 100, 8)["numPartitions"] == "8"
    with pytest.raises(IdentifierError):
        jdbc_options(target, "a; DROP TABLE b")
    with pytest.raises(IdentifierError):
        clickhouse_target("h", 1, "a.b", "u", "p")


def test_jdbc_staging_checks_come_before_any_connection(spark, database):
    roles = TableRoles(silver=f"{database}.silver")
    nowhere = clickhouse_target("h", 1, "d", "u", "p")
    with pytest.raises(RoleError):
        load_jdbc_staging(spark, f"{database}.other", nowhere, roles)
    with pytest.raises(SnapshotError):
        load_jdbc_staging(spark, roles.silver, nowhere, roles)
    commit_version(silver_rows(spark, {"symbol": None}), roles.silver)
    with pytest.raises(NullsFoundError):
        load_jdbc_staging(spark, roles.silver, nowhere, roles)
    with pytest.raises(RoleError):
        replace_staging(silver_rows(spark, {}), nowhere, roles.serving, roles)


def test_jdbc_append_rejects_other_columns_first(spark):
    target = clickhouse_target("h", 1, "d", "u", "p")
    with pytest.raises(ContractError):
        append_copy(silver_rows(spark, {}).select(*reversed(SILVER_12.columns)), target, "t")


def test_jdbc_ranges_are_about_equal_and_hold_every_row_once(spark):
    offsets = [*range(1000), *range(10**9, 10**9 + 3000), *[5] * 500, None]
    rows = silver_rows(spark, *[{"kafka_offset": n} for n in offsets])
    ranges = equal_ranges(rows, "kafka_offset", 6)
    sizes = [rows.where(condition).count() for condition in ranges]
    assert len(sizes) == 6 and sum(sizes) == len(offsets) and max(sizes) < 1.8 * len(offsets) / 6
    assert equal_ranges(rows, "kafka_offset", 1) == ["1 = 1"]
    assert equal_ranges(rows.limit(0), "kafka_offset", 4) == ["1 = 1"]
    one = equal_ranges(rows.where("kafka_offset = 5"), "kafka_offset", 4)
    assert sum(rows.where(condition).count() for condition in one) == len(offsets)
    for column, tasks in (("symbol", 2), ("kafka_offset", 0), ("nothing", 2)):
        with pytest.raises(PipelineError):
            equal_ranges(rows, column, tasks)
    assert count_statement("a.b") == "SELECT COUNT(*) AS row_count FROM a.b"
    with pytest.raises(IdentifierError):
        count_statement("a; DROP TABLE b")
