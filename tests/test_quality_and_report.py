import pytest
from pyspark.sql import functions as F

from evenkeel.functions.canonical import normalise, precision_map, rounded_double
from evenkeel.operators import quality
from evenkeel.operators.filters import KeyFilter, LoadFilter
from evenkeel.operators.reconcile import DuplicateKeyError, reconcile
from evenkeel.operators.report import check_diff_columns, diff_by_column, diff_by_type, summary_text, write_report
from evenkeel.plans.check import Side, exit_code_of, run, run_spec
from evenkeel.plans.spec import ColumnRule, SourceColumn, SpecError, TableSpec
from evenkeel.sources.catalog import schema_catalog
from evenkeel.sources.files import load_snapshot, read_csv


@pytest.fixture(scope="module")
def pair(spark):
    left = spark.createDataFrame([(i, "a", float(i)) for i in range(1, 9)], "k int, v string, w double")
    right = spark.createDataFrame(
        [(i, "b" if i < 4 else "a", float(i) + (i == 1)) for i in range(1, 8)] + [(20, "a", 1.0)],
        "k int, v string, w double")
    return left, right


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert sorted(rows(quality.null_counts(df, ["a", "b"]))) == [("a", 1, 3), ("b", 2, 3)]
    quality.require_not_null(df.dropna(), ["a", "b"])
    quality.require_not_null(df, [])
    with pytest.raises(quality.NullViolationError, match=r"b \(2 of 3 rows\)"):
        quality.require_not_null(df, ["b"])


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 1)], "a int, b int")
    assert rows(quality.key_uniqueness(df, ["a", "b"])) == [(4, 3, 1, False)]
    assert rows(quality.repeated_keys(df, ["a", "b"])) == [(1, 2, 2)]
    assert rows(quality.key_uniqueness(df.limit(0), ["a"])) == [(0, 0, 0, True)]
    assert sorted(rows(quality.unique_columns(df.filter("b = 1"), ["a", "b"]))) == [
        ("a", 1, 1, True), ("b", 2, 1, False)
    ]


def test_fanout_equals_the_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "r int")
    joined = left.join(right, left.k == right.r, "left").count()
    assert rows(quality.join_fanout(left, right, "k", "r")) == [(5, joined, 2, True)]


def test_audit_columns(spark):
    df = spark.createDataFrame([(1, "t"), (2, None)], "k int, LOAD_TS string")
    assert sorted(rows(quality.audit_columns(df))) == [("batch_id", False, 2, 2, False), ("load_ts", True, 1, 2, False)]
    assert sorted(rows(quality.audit_columns(df.withColumn("batch_id", F.lit(1)).dropna()))) == [
        ("batch_id", True, 0, 1, True), ("load_ts", True, 0, 1, True)
    ]


def test_reports(pair):
    result = reconcile(*pair, "k")
    diff = result.diff
    assert result.cell_diffs == 4
    assert sorted(rows(diff_by_type(diff))) == [("EXTRA_IN_TARGET", 1), ("MISSING_IN_TARGET", 1), ("VALUE_MISMATCH", 3)]
    assert rows(diff_by_column(diff)) == [("v", 3), ("<ENTIRE_ROW>", 2), ("w", 1)]
    with pytest.raises(ValueError, match="diff_type"):
        check_diff_columns(diff.drop("diff_type"))


def test_summary_text(pair):
    text = summary_text(reconcile(*pair, "k"), "/reports/x")
    assert "source rows      8" in text and "v (3)" in text and text.endswith("FAIL") and "/reports/x" in text
    same = summary_text(reconcile(pair[0], pair[0], "k"))
    assert same.endswith("PASS") and "columns          none" in same


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_written_report(spark, pair, tmp_path, fmt):
    result = reconcile(*pair, "k")
    path = str(tmp_path / "report")
    assert write_report(result, path, fmt) == 3
    assert sorted(rows(load_snapshot(spark, path, fmt)), key=repr) == sorted(rows(result.diff), key=repr)
    assert rows(load_snapshot(spark, f"{path}_summary", fmt)) == rows(result.summary)
    assert rows(load_snapshot(spark, f"{path}_duplicates", fmt)) == []


def test_report_of_repeated_keys(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "report")
    assert write_report(reconcile(twice, twice, "k"), path) == 3
    assert rows(read_csv(spark, f"{path}_duplicates")) == [("1", 2, 2, "DUPLICATE_KEY_IN_BOTH")]
    assert read_csv(spark, f"{path}_summary").first().verdict == "FAIL" and read_csv(spark, path).count() == 0


def test_report_of_equal_tables(spark, pair, tmp_path):
    path = str(tmp_path / "report")
    assert write_report(reconcile(pair[0], pair[0], "k"), path) == 0
    assert read_csv(spark, path).columns == reconcile(pair[0], pair[0], "k").diff.columns


def test_run_patterns(spark, pair, tmp_path):
    left, right = pair
    a, b, report = (str(tmp_path / n) for n in ("a", "b", "r"))
    full = run(spark, Side(left, save_to=a), Side(right, save_to=b, fmt="csv"), ["k"], report_path=report)
    want = sorted(rows(full.diff), key=repr)
    assert full.exit_code == 3 and read_csv(spark, report).count() == len(want)
    assert run(spark, Side(left), None) is None and run(spark, None, Side(right)) is None
    for sides in [(Side(a), Side(b, fmt="csv")), (Side(a), Side(right)), (Side(left), Side(b, fmt="csv"))]:
        assert sorted(rows(run(spark, *sides, ["k"]).diff), key=repr) == want


def test_run_checks_and_filters(spark, pair):
    left, _ = pair
    live = schema_catalog(spark, left.schema)
    side = Side(left, LoadFilter(KeyFilter("pk_range", "k", upper=3)), declared=live, live=live, required=("k", "v"),
                transform=lambda df: df.withColumn("v", F.upper("v")))
    result = run(spark, side, Side(left), ["k"], ["v"])
    assert result.counts["source_rows"] == 3 and result.counts["extra_rows"] == 5
    wrong = Side(left, declared=live.filter("column_name <> 'W'"), live=live)
    with pytest.raises(quality.SchemaMismatchError):
        run(spark, wrong, None)
    with pytest.raises(quality.NullViolationError):
        run(spark, Side(left.withColumn("v", F.lit(None).cast("string")), required=("v",)), None)


def test_a_snapshot_side_is_filtered_and_checked(spark, pair, tmp_path):
    left, _ = pair
    path = str(tmp_path / "s")
    run(spark, Side(left, save_to=path), None)
    result = run(spark, Side(path, LoadFilter(KeyFilter("pk_range", "k", lower=5)), lambda df: df.filter("k <> 7")), Side(left), ["k"])
    assert result.counts["source_rows"] == 3
    with pytest.raises(Exception, match="nope"):
        run(spark, Side(path, required=("nope",)), None)
    declared = schema_catalog(spark, left.schema)
    run(spark, Side(left, declared=declared), None)  # the frame's own schema is the live one
    with pytest.raises(quality.SchemaMismatchError):
        run(spark, Side(path, declared=declared.filter("column_name <> 'W'")), None)


def test_a_refused_side_is_not_saved(spark, pair, tmp_path):
    path = tmp_path / "refused"
    nulls = pair[0].withColumn("v", F.lit(None).cast("string"))
    with pytest.raises(quality.NullViolationError):
        run(spark, Side(nulls, required=("v",), save_to=str(path)), None)
    assert not path.exists()


def test_options_reach_the_comparison(spark, pair):
    text = pair[0].select(*[F.col(c).cast("string").alias(c) for c in pair[0].columns])
    assert run(spark, Side(pair[0]), Side(text), ["k"], coerce=True, hash_bits=64).passed
    twice = pair[0].unionByName(pair[0])
    with pytest.raises(DuplicateKeyError):
        run(spark, Side(twice), Side(twice), ["k"], on_duplicate="raise")


@pytest.fixture
def spec():
    return TableSpec(
        "src", "tgt",
        (SourceColumn("k", is_key=True), SourceColumn("v", is_unique=True), SourceColumn("w")),
        (ColumnRule("rename", "k", "id"), ColumnRule("derived", "v", "name", rule="upper(val)"),
         ColumnRule("direct", "w", "w", nulls="fill_empty"), ColumnRule("constant", None, "load_ts", rule="NOW()", nulls="fill_empty")),
    )


def test_run_spec(spark, spec, tmp_path):
    src = spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (3, "c", 2.5)], "k int, v string, w double")
    tgt = spark.createDataFrame([(1, "A", 1.5), (2, "B", 0.0), (4, "D", 2.5)], "id int, name string, w double").withColumn("load_ts", F.lit("x"))
    report, saved = str(tmp_path / "r"), str(tmp_path / "s")
    result = run_spec(spark, spec, {"src": src}, tgt, report_path=report, save_to=saved)
    assert {(r.primary_key_value, r.column_name) for r in result.diff.collect()} == {("2", "w"), ("3", "<ENTIRE_ROW>"), ("4", "<ENTIRE_ROW>")}
    assert read_csv(spark, report).count() == 3 and load_snapshot(spark, saved).count() == 3
    kept = run_spec(spark, spec, {"src": src}, Side(tgt, LoadFilter(KeyFilter("pk_range", "id", upper=1))),
                    source_filter=LoadFilter(KeyFilter("pk_range", "k", upper=1)), strategy="exact")
    assert kept.passed
    with pytest.raises(quality.NullViolationError, match="name"):
        run_spec(spark, spec, {"src": src.withColumn("v", F.nullif("v", F.lit("b")))}, tgt)
    with pytest.raises(quality.UniqueViolationError, match="v"):
        run_spec(spark, spec, {"src": src.withColumn("v", F.lit("b"))}, tgt)
    with pytest.raises(SpecError, match="has no column"):
        run_spec(spark, spec, {"src": src}, tgt.drop("name"))
    with pytest.raises(SpecError, match="carries a key"):
        run_spec(spark, TableSpec("src", "tgt", (SourceColumn("k"),), (ColumnRule("direct", "k", "id"),)), {"src": src}, tgt)


def test_exit_codes(spark, pair):
    left, right = pair
    live = schema_catalog(spark, left.schema)
    narrow = Side(left, declared=live.filter("column_name <> 'W'"), live=live)
    nulls = Side(left.withColumn("v", F.lit(None).cast("string")), required=("v",))
    assert exit_code_of(lambda: run(spark, Side(left), Side(left), ["k"])) == 0
    assert exit_code_of(lambda: run(spark, Side(left), None)) == 0
    assert exit_code_of(lambda: run(spark, Side(left), Side(left), ["nope"])) == 1
    assert exit_code_of(lambda: run(spark, narrow, None)) == 2
    assert exit_code_of(lambda: run(spark, Side(left), Side(right), ["k"])) == 3
    assert exit_code_of(lambda: run(spark, nulls, None)) == 99
    assert exit_code_of(lambda: run(spark, Side("/no/such/place"), None)) == 99


def test_precision_map(spark):
    left = spark.createDataFrame([], "a int, b double, c decimal(9,2), d decimal(9,4), e string, f float").schema
    right = spark.createDataFrame([], "a bigint, b int, c double, d decimal(9,1), e string, f float").schema
    assert precision_map(left, right, left.names) == {"b": 6, "c": 2, "d": 4, "f": 6}


def test_normalise(spark):
    df = spark.sql("select 10000000 as I, 1.0d as d, cast(2.5 as decimal(5,2)) as n, ' TRUE ' as s, "
                   "true as b, date'2024-01-02' as day, timestamp_ntz'2024-01-02 03:04:05' as t, cast(null as int) as z")
    out = normalise(df, df.columns).first()
    assert tuple(out) == ("10000000", "1.000000", "2.50", "true", "true", "2024-01-02", "2024-01-02 03:04:05", None)


def test_fast_rounding_equals_decimal_rounding(spark):
    r = spark.range(200_000)
    values = [
        F.rand(1) * 2e7 - 1e7, F.rand(2) * 1e10, F.rand(3) * 1e20, F.rand(4) * 1e-4,
        (F.floor(F.rand(5) * 1e9) * 2 + 1) / F.lit(2e6), F.floor(F.rand(6) * 1e9) / F.lit(1e7),
        F.floor(F.rand(7) * 1e12) / 1e6 + (F.rand(8) - 0.5) * 1e-9, F.lit(2.0**47 / 1e6) + (F.rand(9) - 0.5) * 10,
    ]
    for value in values:
        x = F.col("x")
        slow = F.coalesce(x.try_cast("decimal(38,6)").cast("double"), x)
        assert r.select(value.alias("x")).filter(~F.expr(rounded_double("x", 6)).eqNullSafe(slow)).count() == 0
