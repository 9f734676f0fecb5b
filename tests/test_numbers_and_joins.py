"""Number keys of any size, spread joins, and counts that differences carry."""

from decimal import Decimal
from fractions import Fraction
from statistics import median

import pytest
from frame_checks import diff_set
from pyspark.sql import functions as F

from evenkeel.functions.canonical import exact_number
from evenkeel.operators.joins import hot_keys, splits_hot_keys, spread_join
from evenkeel.operators.reconcile import reconcile
from evenkeel.operators.report import diff_by_type
from evenkeel.plans.mapping import enrich
from evenkeel.plans.spec import JoinDef
from pyspark.sql import types as T

NUMBERS = ["1e-25", "1e30", "-1e30", "0", "-0.0", "1e-30", "123456789.125", "-0.001", "1e-7", "1e7", "100", "12300000", "0.1", "1.5e-320",
           "1.7976931348623157e308", "9007199254740993", "1e39", "1e40", "1e41", "-1.5e-39", "1e-40", "1e-41", "99999999999999999999"]


def texts(spark, dtype):
    df = spark.createDataFrame([(n,) for n in NUMBERS], "n string").selectExpr("n", f"try_cast(n as {dtype}) as v")
    kind = df.schema["v"].dataType
    rows = df.selectExpr("n", "v", f"{exact_number('v', kind)} as t").collect()
    return {r.n: (r.v, r.t) for r in rows if r.v is not None}


def test_equal_numbers_have_one_text_and_others_another(spark):
    by_text = {}
    for dtype in ("double", "decimal(38,0)", "decimal(38,30)", "decimal(38,18)", "decimal(20,3)", "bigint"):
        for value, text in texts(spark, dtype).values():
            exact = Fraction(str(value)) if dtype == "double" else Fraction(value)
            assert by_text.setdefault(text, exact) == exact, (dtype, value, text)
    assert len(set(by_text.values())) == len(by_text)
    assert [(t, x) for t, x in by_text.items() if Fraction(t) != x] == []


def test_floats_stand_for_what_they_print_as(spark):
    df = spark.sql("select stack(4, float(0.1), float('NaN'), float('-Infinity'), float(1e-20)) as v")
    assert [r.t for r in df.selectExpr(f"{exact_number('v', T.FloatType())} as t").collect()] == ["0.1", "NaN", "-Infinity", "0." + "0" * 19 + "1"]


@pytest.mark.parametrize("strategy", ["hash", "exact", "anti"])
def test_tiny_and_huge_keys_match(spark, strategy):
    left = spark.createDataFrame([(Decimal("1e-25"), 1), (Decimal("2.5"), 2), (Decimal("1e-30"), 3)], "k decimal(38,30), v int")
    right = spark.createDataFrame([(1e-25, 1), (2.5, 9), (1e30, 4)], "k double, v int")
    result = reconcile(left, right, "k", strategy=strategy)
    assert {r[:2] for r in diff_set(result)} == {("2.5", "v"), ("0." + "0" * 29 + "1", "<ENTIRE_ROW>"), ("1" + "0" * 30, "<ENTIRE_ROW>")}
    whole = spark.createDataFrame([(Decimal(10) ** 30, 4)], "k decimal(38,0), v int")
    assert reconcile(whole, right.filter("k > 3"), "k", strategy=strategy).passed


# --- spread joins ---------------------------------------------------------------------------------


@pytest.fixture
def no_adaptive(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_lines(spark, sf_dir, key):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    third = F.when(F.col("l_partkey") % 3 == 0, F.lit(key).cast("bigint")).otherwise(F.col("l_partkey") * 1000 + F.col("l_orderkey") % 997)
    return lines.withColumn("part", third).select("part", "l_orderkey", "l_linenumber", "l_quantity")


@pytest.mark.parametrize("key", [7, None])
def test_a_hot_key_goes_to_many_tasks(spark, sf_dir, no_adaptive, key):
    lines = hot_lines(spark, sf_dir, key)
    parts = lines.select(F.col("part").alias("p")).distinct().withColumn("name", F.concat(F.lit("part "), "p"))
    join = JoinDef("prt", "part", "part", "p", ("name",))

    def sizes(df):
        return sorted(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())

    plain = enrich(lines, join, parts, spread=False)
    assert max(sizes(plain)) > 3 * median(sizes(plain))
    spread = enrich(lines, join, parts)
    assert max(sizes(spread)) <= 3 * median(sizes(spread))
    assert spread.columns == plain.columns and spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_few_keys_are_hot(spark, sf_dir):
    found = {r["_hot"]: r["_copies"] for r in hot_keys(hot_lines(spark, sf_dir, 7), F.col("part"), 16).collect()}
    assert set(found) == {7} and 8 <= found[7] <= 16


@pytest.mark.parametrize("how", ["left", "inner", "right", "full"])
def test_all_kinds_of_joins(spark, no_adaptive, how):
    """Repeated keys on both sides, null keys, keys of one side only; a hot key that the other side has several times or not at all."""
    left = spark.createDataFrame([(1, i % 5) for i in range(200)] + [(2, 0)] * 100 + [(None, 1)] * 90 + [(3, 3), (4, 4)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "n"), (9, "z")], "id bigint, name string")
    join = JoinDef("o", "other", "k", "id", ("name",), how=how)
    spread, plain = enrich(left, join, right, spread=True), enrich(left, join, right, spread=False)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_a_spread_join_refuses_what_it_cannot_do(spark):
    assert splits_hot_keys(spark)
    with pytest.raises(ValueError):
        spread_join(spark.range(3), spark.range(3).toDF("k"), "id", "k", "full")


# --- counts ------------------------------------------------------------------------------------------


def test_text_that_looks_like_a_marker_is_not_a_count(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "c x7")], "k int, v string")
    right = spark.createDataFrame([(3, "d x9")], "k int, v string")
    result = reconcile(left, right, "k")
    by_type = {r.diff_type: r.affected_rows for r in diff_by_type(result).collect()}
    assert by_type == {"MISSING_IN_TARGET": 4, "VALUE_MISMATCH": 1} == {r.diff_type: r.affected_rows for r in diff_by_type(result.diff).collect()}
    assert result.counted_diff.agg(F.sum("rows")).first()[0] == 5 and "rows" not in result.diff.columns
