import pytest
from pyspark.sql.types import StructType

from tests.rows import silver_rows
from tradeweir.contracts import (
    BRONZE_13,
    BRONZE_15,
    SILVER_12,
    BronzeState,
    TableRoles,
    bronze_state,
    check_identifier,
    create_table_sql,
    ensure_table,
    require_table,
)
from tradeweir.errors import ContractError, IdentifierError, RoleError
from tradeweir.operators.quality import classify, parse_trades
from tradeweir.plans.append import append_classified, ensure_smoke_table
from tradeweir.plans.migrate import MigrationResult, migrate_bronze
from tests.rows import kafka_rows


@pytest.mark.parametrize(
    "name",
    ["", "a b", "a;b", "a`b", "a()", "a--", "a.b.c.d", ".a", "a.", "1a", " a", "a\n", "a'b"],
)
def test_unsafe_identifiers(name):
    with pytest.raises(IdentifierError):
        check_identifier(name)


def test_safe_identifiers():
    for name in ("a", "_a1.b", "cat.db.t"):
        assert check_identifier(name) == name
    with pytest.raises(IdentifierError):
        check_identifier("a.b", 1)


def test_silver_contract_is_ordered_names_and_types(spark):
    good = silver_rows(spark, {})
    SILVER_12.require(good)
    for bad in (
        good.drop("symbol"),
        good.selectExpr("*", "1 AS extra"),
        good.withColumnRenamed("price", "cost"),
        good.withColumn("price", good.price.cast("decimal(38,17)")),
        good.withColumn("event_time", good.event_time.cast("string")),
        good.select(*reversed(good.columns)),
    ):
        with pytest.raises(ContractError):
            SILVER_12.require(bad)


def test_bronze_states(spark):
    ddl = BRONZE_15.ddl
    assert bronze_state(BRONZE_13.schema) is BronzeState.LEGACY
    assert bronze_state(BRONZE_15.schema) is BronzeState.QUALITY
    fields = list(BRONZE_15.schema)
    swapped = StructType([*fields[:-2], fields[-1], fields[-2]])
    for schema in (
        StructType(fields[:-1]),
        swapped,
        StructType.fromDDL(f"{ddl}, extra string"),
        StructType([f for f in fields if f.name != "symbol"]),
        StructType.fromDDL(ddl.replace("price decimal(38,18)", "price decimal(20,5)")),
        StructType.fromDDL(ddl.replace("array<string>", "array<int>")),
    ):
        assert bronze_state(schema) is BronzeState.INCOMPATIBLE


def test_roles_reject_foreign_tables():
    roles = TableRoles()
    assert roles.require("bronze", roles.bronze) == roles.bronze
    for role, table in (("bronze", roles.smoke), ("smoke", roles.bronze), ("silver", "db.other")):
        with pytest.raises(RoleError):
            roles.require(role, table)
    with pytest.raises(RoleError):
        TableRoles(bronze="a.b", silver="a.b")


def test_ensure_and_require_table(spark, database):
    table = f"{database}.t"
    with pytest.raises(ContractError):
        require_table(spark, table, BRONZE_15)
    ensure_table(spark, table, BRONZE_15)
    ensure_table(spark, table, BRONZE_15)
    with pytest.raises(ContractError):
        require_table(spark, table, BRONZE_13)
    assert "PARTITIONED BY (m)" in create_table_sql("a.b", SILVER_12, partition="m")


def test_migration_adds_columns_once(spark, database):
    roles = TableRoles(bronze=f"{database}.bronze")
    spark.sql(create_table_sql(roles.bronze, BRONZE_13))
    parse_trades(kafka_rows(spark, {}, {})).write.insertInto(roles.bronze)
    report = migrate_bronze(spark, roles.bronze, roles)
    assert report.result is MigrationResult.MIGRATED
    assert (report.before, report.after) == (BronzeState.LEGACY, BronzeState.QUALITY)
    again = migrate_bronze(spark, roles.bronze, roles)
    assert again.result is MigrationResult.ALREADY_MIGRATED
    classify(kafka_rows(spark, {})).write.insertInto(roles.bronze)
    found = spark.table(roles.bronze).select("is_valid", "validation_errors").collect()
    assert sorted(map(str, found)) == sorted(
        ["Row(is_valid=None, validation_errors=None)"] * 2
        + ["Row(is_valid=True, validation_errors=[])"]
    )


def test_migration_refuses_other_schemas(spark, database):
    roles = TableRoles(bronze=f"{database}.odd")
    spark.sql(f"CREATE TABLE {roles.bronze} (a INT) USING parquet")
    with pytest.raises(ContractError):
        migrate_bronze(spark, roles.bronze, roles)
    assert spark.table(roles.bronze).columns == ["a"]
    with pytest.raises(RoleError):
        migrate_bronze(spark, f"{database}.elsewhere", roles)


def test_smoke_append(spark, database):
    roles = TableRoles(smoke=f"{database}.smoke")
    rows = classify(kafka_rows(spark, {"offset": 1}, {"value": "{bad-json", "offset": 2}))
    with pytest.raises(RoleError):
        append_classified(rows, roles.bronze, roles)
    with pytest.raises(ContractError):
        append_classified(rows, roles.smoke, roles)  # does not exist yet
    ensure_smoke_table(spark, roles.smoke, roles)
    with pytest.raises(ContractError):
        append_classified(rows.drop("is_valid"), roles.smoke, roles)
    append_classified(rows, roles.smoke, roles)
    append_classified(rows, roles.smoke, roles)
    assert spark.table(roles.smoke).count() == 4
