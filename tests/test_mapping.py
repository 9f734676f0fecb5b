import datetime as dt
from decimal import Decimal

import pytest
from frame_checks import formatted_plan
from pyspark.sql import functions as F

from evenkeel.functions.rules import fill_mode, fill_text, most_frequent, snowflake_value
from evenkeel.plans.mapping import apply_mapping, enrich, extract, perform_transform, target_extract
from evenkeel.plans.spec import ColumnRule, JoinDef, SourceColumn, SpecError, TableSpec


def spec(rules, columns=("a", "b"), joins=(), keys=("a",)):
    return TableSpec("src", "tgt", tuple(SourceColumn(c, is_key=c in keys) for c in columns), tuple(rules), tuple(joins))


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_target_order_and_drop(source):
    s = spec([ColumnRule("rename", "b", "text"), ColumnRule("direct", "a", "a")])
    assert apply_mapping(source, s).columns == ["text", "a"]
    assert s.target_keys == ["a"] and s.compare_columns == ["text"]


def test_key_is_carried_by_rename_and_cast_only():
    rules = [ColumnRule("rename", "a", "id"), ColumnRule("cast", "a", "id_text", rule="string(val)"),
             ColumnRule("derived", "a", "twice", rule="val * 2")]
    assert spec(rules).target_keys == ["id", "id_text"]


def test_val_is_not_replaced_in_quotes(source):
    s = spec([ColumnRule("derived", "b", "t", rule="concat('val=', val, ' it''s val')")])
    assert values(apply_mapping(source, s)) == [("val=x it's val",), (None,)]


def test_rules_see_the_source_row_or_the_earlier_result(source):
    s = spec([ColumnRule("derived", "a", "a", rule="val + 10"), ColumnRule("derived", "a", "c", rule="val + 1")])
    assert values(apply_mapping(source, s)) == [(11, 2), (12, 3)]
    assert values(apply_mapping(source, s, sequential=True)) == [(11, 12), (12, 13)]


def test_null_policies(source):
    s = spec([
        ColumnRule("direct", "b", "zero", nulls="fill_zero"),
        ColumnRule("direct", "b", "dflt", nulls="fill_default", default="none"),
        ColumnRule("direct", "b", "kept", nulls="fill_empty"),
        ColumnRule("direct", "a", "a"),
        ColumnRule("direct", "b", "b", nulls="error"),
    ])
    assert values(apply_mapping(source, s)) == [("0", "none", None, 2, None), ("x", "x", "x", 1, "x")]
    assert values(apply_mapping(source, s, sequential=True)) == values(apply_mapping(source, s))
    assert s.required_columns == ["a", "b"]


def test_constants(source):
    words = {"n": "3", "f": "2.5", "s": "'q'", "t": "TRUE", "i": "AUTO_INCREMENT", "z": "None", "b": "SYS_BATCH_ID"}
    s = spec([ColumnRule("constant", None, c, rule=r) for c, r in words.items()])
    mapped = apply_mapping(source, s, batch_id="B1")
    assert values(mapped)[0] == (3, 2.5, "q", True, None, None, "B1")
    assert dict(mapped.dtypes)["i"] == "int" and dict(mapped.dtypes)["z"] == "string"


@pytest.mark.parametrize("rule, value", [
    ("'IDENTITY card'", "IDENTITY card"), ("'auto_increment'", "auto_increment"), ("'nan'", "nan"), ("1e3", 1000.0),
    ("-2", -2), (" 4.5 ", 4.5), (0, 0), (False, False), (0.0, 0.0), ("identity(10, 5)", None), ("IDENTITY", None),
    ("null", None), ("sys_batch_id", "ETL_VALIDATION"), ("lower('NONE')", "none"), (lambda _: F.lit(9), 9),
])
def test_constant_rules(source, rule, value):
    s = spec([ColumnRule("constant", None, "c", rule=rule)], keys=())
    found = apply_mapping(source, s).first()[0]
    assert found == value and type(found) is type(value)


@pytest.mark.parametrize("rule", ["nan", "1_0", "IDENTITY card"])
def test_words_that_are_no_constant(source, rule):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|PARSE_SYNTAX"):
        apply_mapping(source, spec([ColumnRule("constant", None, "c", rule=rule)], keys=()))


def test_force_dtype_gives_null_for_what_does_not_fit(source):
    s = spec([ColumnRule("direct", "b", "b", force_dtype="int"), ColumnRule("direct", "a", "a", force_dtype="string")])
    assert values(apply_mapping(source, s)) == [(None, "1"), (None, "2")]


def test_join_columns_resolve_by_alias(spark, source):
    other = spark.createDataFrame([(1, "one", 1.5), (1, "uno", 2.5), (3, "three", 3.5)], "id int, label string, w double")
    joins = [JoinDef("j", "dim", "a", "id", ("label",))]
    rules = [ColumnRule("direct", "a", "a"), ColumnRule("direct", "j.label", "label"),
             ColumnRule("derived", None, "w2", rule="J.w * 2")]
    s = spec(rules, joins=joins)
    assert s.joins[0].fetch == ("label", "w")
    extracted = extract(s, {"src": source, "dim": other})
    assert extracted.columns == ["a", "j_label", "j_w"]
    assert values(apply_mapping(extracted, s)) == [(1, "one", 3.0), (1, "uno", 5.0), (2, None, None)]


@pytest.mark.parametrize("how", ["left", "inner", "right"])
def test_enrichment_equals_a_plain_join(spark, how):
    main = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (7, "e")], "k int, v string")
    other = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (3, "w"), (3, "w"), (None, "n")], "id int, label string")
    found = enrich(main, JoinDef("j", "dim", "k", "id", ("label",), how.upper()), other)
    plain = main.join(other, main.k == other.id, how).select("k", "v", "label")
    assert found.columns == ["k", "v", "j_label"] and found.dtypes[:2] == main.dtypes
    assert values(found) == values(plain)


def test_right_join_does_not_shuffle_the_main_table(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    plan = formatted_plan(enrich(lineitem, JoinDef("p", "part", "l_partkey", "p_partkey", ("p_name",), "RIGHT"), part))
    tree = plan.split("== Physical Plan ==")[1].split("(1) ")[0]
    # the only shuffle is that of the distinct keys
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1 and "RightOuter" not in tree


def test_a_chain_before_a_right_join_runs_once(spark, sf_dir):
    line, part, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "orders"))
    joins = [JoinDef("p", "part", "l_partkey", "p_partkey", ("p_name",)), JoinDef("o", "orders", "l_orderkey", "o_orderkey", ("o_custkey",), "RIGHT")]
    s = TableSpec("lineitem", "t", tuple(SourceColumn(c) for c in ("l_orderkey", "l_partkey")),
                  (ColumnRule("direct", "l_orderkey", "id"), ColumnRule("direct", "p.p_name", "n"), ColumnRule("direct", "o.o_custkey", "c")), tuple(joins))
    df = extract(s, {"lineitem": line, "part": part, "orders": orders})
    assert not any(f"{t}.parquet" in f for f in df.inputFiles() for t in ("lineitem", "part"))
    plain = line.join(part, line.l_partkey == part.p_partkey, "left").join(orders, line.l_orderkey == orders.o_orderkey, "right")
    assert df.count() == plain.count()


def test_needed_columns():
    joins = [JoinDef("j", "dim", "k", "id", ("label",))]
    rules = [ColumnRule("direct", "a", "a"), ColumnRule("derived", None, "z", rule="c + 1"),
             ColumnRule("drop", "b"), ColumnRule("drop", "d"), ColumnRule("drop", "k")]
    assert spec(rules, columns=("a", "b", "c", "d", "k"), joins=joins).needed_columns() == ["a", "c", "k"]


def test_chain_of_joins_prunes_unused_columns(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    s = TableSpec("lineitem", "t", tuple(SourceColumn(c) for c in lineitem.columns),
                  (ColumnRule("direct", "l_orderkey", "id"), ColumnRule("direct", "p.p_name", "name")),
                  (JoinDef("p", "part", "l_partkey", "p_partkey", ("p_name", "p_brand")),))
    text = formatted_plan(apply_mapping(extract(s, {"lineitem": lineitem, "part": part}), s))
    assert "l_extendedprice" not in text and "p_brand" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("rule, words", [
    (ColumnRule("magic", "a", "a"), "unknown transform"),
    (ColumnRule("", "a", "a"), "transform is empty"),
    (ColumnRule("drop"), "needs a source"),
    (ColumnRule("constant", None, "c"), "needs a rule"),
    (ColumnRule("constant", rule="1"), "needs a target"),
    (ColumnRule("cast", "a", "a"), "needs a rule"),
    (ColumnRule("direct", "a"), "needs a target"),
    (ColumnRule("direct", None, "t"), "neither"),
    (ColumnRule("direct", "zzz", "t"), "not a source column"),
    (ColumnRule("direct", "a", "t", nulls="guess"), "null policy"),
    (ColumnRule("direct", "a", "t", nulls="fill_default"), "needs a default"),
])
def test_spec_errors(rule, words):
    with pytest.raises(SpecError, match=words):
        spec([rule])


def test_repeated_names():
    with pytest.raises(SpecError, match="more than once"):
        spec([ColumnRule("direct", "a", "t"), ColumnRule("direct", "b", "T")])
    with pytest.raises(SpecError, match="twice"):
        spec([ColumnRule("direct", "a", "t")], columns=("a", "a"))
    with pytest.raises(SpecError, match="join type"):
        spec([ColumnRule("direct", "a", "t")], joins=[JoinDef("j", "d", "a", "id", how="CROSS")])


def test_spec_from_json_form():
    s = TableSpec.from_dict({
        "source_table": "src", "target_table": "tgt",
        "source_columns": [{"name": "a", "is_key": True}],
        "joins": [{"alias": "j", "table": "dim", "left_key": "a", "right_key": "id", "fetch": ["x"]}],
        "rules": [{"transform": "rename", "source": "a", "target": "id"},
                  {"transform": "derived", "target": "y", "rule": "j.y"}],
    })
    assert s.target_keys == ["id"] and s.joins[0].fetch == ("x", "y")


def test_unknown_name_in_a_rule_is_an_error_before_any_job(source):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        apply_mapping(source, spec([ColumnRule("derived", "a", "t", rule="nope + 1")]))


def test_target_extract(source):
    s = spec([ColumnRule("rename", "b", "text"), ColumnRule("direct", "a", "a")])
    assert target_extract(s, source.toDF("A", "TEXT")).columns == ["text", "a"]
    with pytest.raises(SpecError):
        target_extract(s, source)


def test_dialect(source):
    with pytest.raises(ValueError):
        apply_mapping(source, spec([ColumnRule("direct", "a", "a")]), dialect="oracle")


def test_snowflake_values(spark):
    row = spark.createDataFrame(
        [(1, "ab  ", "0000-00-00", "0000-00-00 00:00:00", "2024", Decimal("1.50"), dt.datetime(2024, 1, 2, 3, 4, 5)),
         (0, " c", "2024-02-30", "2024-02-03 04:05:06", "20x4", None, None)],
        "f int, c string, d string, t string, y string, n decimal(9,2), h timestamp")
    types = {"f": "TINYINT(1)", "c": "CHAR(4)", "d": "DATE", "t": "DATETIME", "y": "YEAR", "n": "NUMERIC(9,2)", "h": "TIME"}
    out = row.select(*[snowflake_value(F.col(c), t).alias(c) for c, t in types.items()])
    assert [tuple(r) for r in out.collect()] == [
        (True, "ab", None, None, 2024, 1.5, "03:04:05"),
        (False, " c", "2024-02-30", dt.datetime(2024, 2, 3, 4, 5, 6), None, None, None),
    ]
    same = row.select(snowflake_value(F.col("f"), "TINYINT").alias("f"))
    assert same.dtypes == [("f", "int")]


def test_most_frequent_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v string")
    assert most_frequent(df, "v").first()[0] == "a"
    assert fill_mode(df, ["v"]).filter("v = 'a'").count() == 5
    two = df.select("v", F.when(F.col("v") == "c", 3).when(F.col("v") == "b", 2).alias("w"))
    assert fill_mode(two, ["w", "v"]).columns == ["v", "w"]
    assert values(fill_mode(two, ["w", "v"])) == sorted(
        [("b", 2), ("a", 2), ("b", 2), ("a", 2), ("c", 3), ("a", 2), ("a", 2), ("a", 2)], key=repr
    )
    assert formatted_plan(fill_mode(two, ["v", "w"])).count("Scan ExistingRDD") <= 4 and fill_mode(df, []) is df
    empty = spark.createDataFrame([(None,)], "v string")
    assert fill_mode(empty, ["v"]).first()[0] is None
    assert fill_text(empty, ["v"]).first()[0] == ""


def test_user_transform(source):
    assert perform_transform(source) is source
    doubled = perform_transform(source, lambda df, by: df.withColumn("a", F.col("a") * by), by=3)
    assert sorted(r.a for r in doubled.collect()) == [3, 6]
