import os

import pytest
from frame_checks import formatted_plan

from evenkeel.operators.filters import KeyFilter
from evenkeel.operators.quality import require_schema, schema_diff, SchemaMismatchError
from evenkeel.operators.reconcile import DuplicateKeyError
from evenkeel.operators.upsert import upsert
from evenkeel.sources import catalog
from evenkeel.sources.files import load_snapshot, read_csv, save_snapshot, write_csv
from evenkeel.sources.jdbc import (
    Partitioning,
    choose_partitioning,
    extract,
    mysql_options,
    probe_bounds,
    read_jdbc,
    snowflake_options,
)
from evenkeel.sources.workspace import shared_folder, workspace, written
from queries.io import _JDBC_QUERY, ORDERS_TABLE, jdbc_orders

AWKWARD = [(1, ""), (2, " pad "), (3, "x\ny"), (4, None), (5, 'say "hi", ok'), (6, "\\"), (7, "a\r\nb"), (8, "\\N"),
           (9, "\\\\N"), (10, "N"), (11, "\\N ")]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "id int, v string")


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0]))


def test_csv_keeps_every_value_and_type(spark, awkward, tmp_path):
    path = str(tmp_path / "t")
    write_csv(awkward, path)
    back = read_csv(spark, path)
    assert back.dtypes == awkward.dtypes and pairs(back) == AWKWARD


def test_csv_overwrites_and_reads_as_text(spark, awkward, tmp_path):
    path = str(tmp_path / "t")
    write_csv(awkward, path)
    write_csv(awkward.filter("id < 3"), path)
    text = read_csv(spark, path, as_text=True)
    assert dict(text.dtypes) == {"id": "string", "v": "string"} and pairs(text) == [("1", ""), ("2", " pad ")]


def test_csv_can_be_split_whatever_its_values_hold(spark, tmp_path):
    path, broken = str(tmp_path / "t"), str(tmp_path / "b")
    text = spark.range(40_000).selectExpr("id", "'value ' || id as v").coalesce(1)
    write_csv(text, path)
    write_csv(text.selectExpr("id", "v || char(10) as v"), broken)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        for at, end in ((path, ""), (broken, "\n")):
            split = load_snapshot(spark, at, "csv")
            assert split.rdd.getNumPartitions() > 2 and split.count() == 40_000
            assert split.filter("id = 7").first().v == f"value 7{end}"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert read_csv(spark, path, multiline=True).count() == 40_000


def test_workspace_is_removed(spark, awkward):
    with workspace(spark) as folder:
        stored = written(awkward, "t")
        assert folder in stored.inputFiles()[0] and stored.count() == len(AWKWARD)
    assert not os.path.exists(folder.removeprefix("file:"))
    assert folder not in written(awkward, "t").inputFiles()[0]


def test_empty_csv_keeps_its_schema(spark, awkward, tmp_path):
    path = str(tmp_path / "t")
    write_csv(awkward.filter("id < 0"), path)
    back = read_csv(spark, path)
    assert back.dtypes == awkward.dtypes and back.count() == 0


def test_csv_without_stored_schema_is_inferred(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "id * 0.5d as half", "'t' as t").write.option("header", True).csv(path)
    assert dict(read_csv(spark, path).dtypes) == {"id": "int", "half": "double", "t": "string"}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_snapshots(spark, awkward, tmp_path, fmt):
    path = str(tmp_path / fmt)
    save_snapshot(awkward, path, fmt)
    assert pairs(load_snapshot(spark, path, fmt)) == AWKWARD


def test_intermediate_tables_go_to_the_configured_folder(spark, awkward):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    stored = written(awkward, "t")
    assert pairs(stored) == AWKWARD and folder in stored.inputFiles()[0]


class _Session:
    """As much of a session as the folder choice looks at."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_folder_without_the_setting():
    local = _Session("local[4]", {})
    assert shared_folder(local) == shared_folder(local) != ""
    assert shared_folder(_Session("spark://host:7077", {"spark.checkpoint.dir": "s3://b/x"})) == "s3://b/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077", {}))


# --- upsert ------------------------------------------------------------------------------------


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    changes = spark.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    assert sorted((tuple(r) for r in upsert(target, changes, "k").collect()), key=repr) == [
        (1, "a"), (2, "B"), (3, "c"), (None, "n")
    ]
    twice = changes.unionByName(changes)
    with pytest.raises(DuplicateKeyError):
        upsert(target, twice, ["k"])
    later = spark.createDataFrame([("old", 2), ("new", 2), ("c", 3)], "v string, k int")
    assert sorted((tuple(r) for r in upsert(target, later, "k", latest_by="v").collect()), key=repr) == [
        (1, "a"), (2, "old"), (3, "c"), (None, "n")
    ]
    assert upsert(target, twice, ["k"], check_unique=False).count() == 6
    with pytest.raises(ValueError):
        upsert(target, changes.drop("v"), "k")


# --- JDBC, on a database inside this process -------------------------------------------------------


@pytest.fixture(scope="module")
def database(spark, sf_dir):
    return jdbc_orders(spark, sf_dir)


def test_scans_return_all_rows(spark, sf_dir, database):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    one = read_jdbc(spark, database, _JDBC_QUERY)
    split = read_jdbc(spark, database, _JDBC_QUERY, Partitioning("O_ORDERKEY", 10, 20, 3))
    assert one.count() == split.count() == rows
    assert (one.rdd.getNumPartitions(), split.rdd.getNumPartitions()) == (1, 3)
    assert probe_bounds(spark, database, ORDERS_TABLE, "O_ORDERKEY") == (0, rows - 1)


def test_filter_runs_in_the_database(spark, database):
    filtered = KeyFilter("pk_range", "o_orderkey", lower=5, upper=9).apply(read_jdbc(spark, database, _JDBC_QUERY))
    plan = formatted_plan(filtered)
    assert "GreaterThanOrEqual(O_ORDERKEY,5)" in plan and "LessThanOrEqual(O_ORDERKEY,9)" in plan
    assert filtered.count() == 5


def test_extract_checks_its_arguments(spark, database):
    sides = {"source": database, "target": database}
    assert extract(spark, sides, "target", _JDBC_QUERY, "O_ORDERKEY", 0, 100, 2).rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        extract(spark, sides, "middle", _JDBC_QUERY)
    with pytest.raises(ValueError, match="2 of 4"):
        extract(spark, sides, "source", _JDBC_QUERY, "O_ORDERKEY", 0)


def test_partition_choice():
    full, key_set = KeyFilter(), KeyFilter("pk_set", "k", values=[1])
    between, above = KeyFilter("pk_range", "k", lower=3, upper=9), KeyFilter("pk_range", "k", lower=3)
    assert choose_partitioning(key_set, "k") == Partitioning("k", 1, 1)
    assert choose_partitioning(KeyFilter("pk_set", "k", values=[9, 2, 5]), "K") == Partitioning("K", 2, 9)
    assert choose_partitioning(key_set, "other") is None
    assert choose_partitioning(between, "k") == Partitioning("k", 3, 9)
    assert choose_partitioning(above, "k") is None
    assert choose_partitioning(above, "k", probe=lambda: (1, 70)) == Partitioning("k", 3, 70)
    assert choose_partitioning(above, "k", probe=lambda: (0, 1)) == Partitioning("k", 3, 3)
    assert choose_partitioning(above, "k", upper=50) == Partitioning("k", 3, 50)
    assert choose_partitioning(full, "k", probe=lambda: (1, 7)) == Partitioning("k", 1, 7)
    assert choose_partitioning(full, "k", probe=lambda: None) is None
    assert choose_partitioning(full, None, lower=1, upper=2) is None


def test_connection_options():
    mysql = mysql_options("h", "3306", "db", "u", "p")
    assert mysql["url"] == "jdbc:mysql://h:3306/db?sslMode=REQUIRED&allowPublicKeyRetrieval=false"
    assert mysql["fetchsize"] == "10000"
    plain = mysql_options("h", "3306", "db", "u", "p", ssl_mode="DISABLED", allow_public_key_retrieval=True)
    assert plain["url"].endswith("?sslMode=DISABLED&allowPublicKeyRetrieval=true")
    flake = snowflake_options("acc", "wh", "db", "sc", "role", "u", "p")
    assert flake["url"] == "jdbc:snowflake://acc.snowflakecomputing.com/?db=db&schema=sc"
    assert (flake["sfWarehouse"], flake["sfRole"]) == ("wh", "role")


# --- catalogs --------------------------------------------------------------------------------------


@pytest.mark.parametrize("declared, mysql, snowflake, postgres", [
    ("int64", "BIGINT", "NUMBER(19,0)", "BIGINT"),
    ("bool", "TINYINT(1)", "BOOLEAN", "BOOLEAN"),
    ("DECIMAL(10,2)", "DECIMAL(10,2)", "NUMBER(10,2)", "NUMERIC(10,2)"),
    ("VARCHAR(20)", "VARCHAR(20)", "VARCHAR(20)", "VARCHAR(20)"),
    ("VARCHAR", "VARCHAR", "VARCHAR(256)", "VARCHAR(255)"),
    ("INT", "INT", "NUMBER(10,0)", "INTEGER"),
    ("TIMESTAMP_NTZ", "DATETIME", "TIMESTAMP_NTZ", "TIMESTAMP_NTZ"),
    ("datetime", "DATETIME", "TIMESTAMP_NTZ", "TIMESTAMP"),
    ("", "VARCHAR(255)", "VARCHAR", "VARCHAR"),
])
def test_type_names(declared, mysql, snowflake, postgres):
    names = [catalog.dialect_type(declared, d) for d in ("mysql", "snowflake", "postgres")]
    assert names == [mysql, snowflake, postgres]


def test_catalog_rows(spark):
    rows = spark.createDataFrame(
        [("b", "number", None, 10, 2, 2), ("a", "TEXT", 50, None, None, 1), ("c", "NUMBER", None, 38, 0, 3),
         ("d", "BOOLEAN", None, None, None, 4)],
        "COLUMN_NAME string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int, NUMERIC_PRECISION int, "
        "NUMERIC_SCALE int, ORDINAL_POSITION int")
    assert [tuple(r) for r in catalog.from_snowflake_rows(rows).collect()] == [
        ("A", "VARCHAR(50)"), ("B", "NUMBER(10,2)"), ("C", "NUMBER(38)"), ("D", "BOOLEAN")
    ]
    rows = spark.createDataFrame([("y", "int", 2), ("x", "varchar(9)", 1)],
                                 "COLUMN_NAME string, COLUMN_TYPE string, ORDINAL_POSITION int")
    assert [tuple(r) for r in catalog.from_mysql_rows(rows).collect()] == [("X", "VARCHAR(9)"), ("Y", "INT")]


def test_catalog_queries_quote_their_names():
    assert "TABLE_NAME = 'o''brien'" in catalog.mysql_catalog_query("s", "o'brien")
    assert "DB.INFORMATION_SCHEMA.COLUMNS" in catalog.snowflake_catalog_query("db", "public", "t")
    with pytest.raises(ValueError):
        catalog.snowflake_catalog_query("db; drop table x", "public", "t")


def test_schema_rules(spark):
    def frame(**types):
        return spark.createDataFrame(list(types.items()), "column_name string, data_type string")

    declared = frame(a="INT", b="NUMBER(10)", c="BOOLEAN", d="DATETIME", e="VARCHAR(5)", f="BIGINT", g="NUMBER(9,2)")
    live = frame(A="integer", B="NUMBER(10,0)", C="tinyint(1)", D="TIMESTAMP_NTZ", E="VARCHAR(6)", H="TEXT", G="NUMBER(9)")
    found = {r.column_name: r.status for r in schema_diff(declared, live).collect()}
    assert found == {"A": "OK", "B": "OK", "C": "OK", "D": "OK", "E": "TYPE_MISMATCH", "F": "MISSING_IN_LIVE",
                     "G": "TYPE_MISMATCH", "H": "EXTRA_IN_LIVE"}
    require_schema(declared, declared)
    with pytest.raises(SchemaMismatchError, match="H: EXTRA_IN_LIVE"):
        require_schema(declared, live)


def test_schema_catalog(spark):
    df = spark.sql("select 1 as i, 2L as l, 'x' as s, true as b, date'2024-01-01' as d, 1.5 as n, now() as t")
    found = {r.column_name: r.data_type for r in catalog.schema_catalog(spark, df.schema).collect()}
    assert found == {"I": "INT", "L": "BIGINT", "S": "TEXT", "B": "TINYINT(1)", "D": "DATE", "N": "DECIMAL(2,1)",
                     "T": "DATETIME"}
    declared = catalog.declared_catalog(spark, {"i": "int32", "v": "DECIMAL(8,1)"}, "snowflake")
    assert {tuple(r) for r in declared.collect()} == {("I", "NUMBER(10,0)"), ("V", "NUMBER(8,1)")}
