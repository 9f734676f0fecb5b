"""Comparisons and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions.canonical import normalise
from evenkeel.operators.filters import DateFilter, load_filters
from evenkeel.operators.joins import splits_hot_keys
from evenkeel.operators.reconcile import EXTRA, MISMATCH, MISSING, compare_columns, reconcile
from evenkeel.operators.report import diff_by_column, diff_by_type, write_report
from evenkeel.plans.check import Side, compare_expected, expected_table, run
from evenkeel.plans.spec import ColumnRule, JoinDef, SourceColumn, TableSpec
from evenkeel.sources.files import read_csv
from evenkeel.sources.workspace import new_table_path, written
from queries.registry import (
    LOADED_ORDERS,
    ORDER_COLUMNS,
    ORDERS_DIFF,
    canonical_orders,
    diff_sql,
    loaded_orders,
    query,
    table,
)


def _orders_result(spark, sf_dir, strategy="hash"):
    orders = table(spark, sf_dir, "orders")
    return reconcile(orders, loaded_orders(orders), ["o_orderkey"], strategy=strategy)


# --- flagship: mapped, enriched, composite key -------------------------------------------

LINE_SPEC = TableSpec(
    source_table="line_totals",
    target_table="fact_line",
    source_columns=(
        SourceColumn("l_orderkey", "int64", is_key=True),
        SourceColumn("l_linenumber", "int32", is_key=True),
        SourceColumn("l_partkey", "int64"),
        SourceColumn("l_returnflag", "string"),
        SourceColumn("quantity", "decimal(18,2)"),
        SourceColumn("revenue", "decimal(18,2)"),
        SourceColumn("lines", "int64"),
    ),
    joins=(
        JoinDef("ord", "orders", "l_orderkey", "o_orderkey", ("o_custkey", "o_orderstatus")),
        JoinDef("prt", "part", "l_partkey", "p_partkey", ("p_brand", "p_type")),
    ),
    rules=(
        ColumnRule("rename", "l_orderkey", "order_id"),
        ColumnRule("rename", "l_linenumber", "line_no"),
        ColumnRule("direct", "ord.o_custkey", "customer_id", nulls="fill_empty"),
        ColumnRule("derived", "l_returnflag", "returned", rule="if(val = 'R', 'Y', 'N')"),
        ColumnRule("cast", "quantity", "quantity", rule="cast(val as double)"),
        ColumnRule("direct", "revenue", "revenue"),
        ColumnRule("derived", None, "product", rule="concat(prt.p_brand, ' ', lower(prt.p_type))"),
        ColumnRule("direct", "ord.o_orderstatus", "status"),
        ColumnRule("constant", None, "load_ts", rule="CURRENT_TIMESTAMP"),
        ColumnRule("drop", "lines"),
    ),
)

_LINE_TOTALS = """
    select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, max(l_returnflag) as l_returnflag,
           sum(cast(l_quantity as decimal(18,2))) as quantity,
           sum(cast(l_extendedprice as decimal(18,2))) as revenue
    from lineitem group by l_orderkey, l_linenumber"""


def _fact_line(target: bool) -> str:
    quantity = "case when l_orderkey % 89 = 0 then quantity + 1 else quantity end" if target else "quantity"
    status = "case when l_orderkey % 83 <> 0 then o_orderstatus end" if target else "o_orderstatus"
    where = "where l_orderkey % 97 <> 0" if target else ""
    return f"""
    select cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) as k,
           cast(o_custkey as varchar) as customer_id,
           case when l_returnflag = 'R' then 'Y' else 'N' end as returned,
           cast(cast({quantity} as decimal(38,6)) as varchar) as quantity,
           cast(cast(revenue as decimal(38,2)) as varchar) as revenue,
           p_brand || ' ' || lower(p_type) as product,
           {status} as status
    from ({_LINE_TOTALS}) left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
    {where}"""


def sum_of_hundredths(df, keys, sums, *others):
    """``df`` grouped by ``keys``: sums of doubles as decimal(18,2), and ``others``.

    ``sums`` maps names to columns.  The same as ``sum(cast(column as decimal(18,2)))``, but
    as sums of whole numbers, each in two halves so that none overflows: decimals
    of that width are objects, which take most of the time of a large sum.
    """
    parts = []
    rows = df
    for name, c in sums.items():
        scaled = f"`{c}` * 100D"
        limit = f"{2**47}D"
        # below it scaling is off by less than 0.04 (``rounded_double``)
        clear = f"{scaled} between -{limit} and {limit} and {scaled} - rint({scaled}) between -0.45D and 0.45D"
        rows = rows.withColumn(f"_{name}", F.expr(
            f"if({clear}, cast(rint({scaled}) as bigint), cast(cast(`{c}` as decimal(18,2)) * 100 as bigint))"
        ))
        parts += [
            F.sum(F.shiftright(f"_{name}", 32)).alias(f"_{name}_high"),
            F.sum(F.col(f"_{name}").bitwiseAND(F.lit(2**32 - 1))).alias(f"_{name}_low"),
        ]
    grouped = rows.groupBy(*keys).agg(*parts, *others)

    def decimal(name: str):
        high, low = f"_{name}_high", f"_{name}_low"
        small = f"cast({high} * {2**32}L + {low} as decimal(17,0))"
        large = f"(cast({high} as decimal(20,0)) * {2**32}BD + cast({low} as decimal(20,0)))"
        is_small = f"{high} between -1000 and 1000 and {low} < {10**15}L"
        return F.expr(f"if({is_small}, cast({small} * 0.01BD as decimal(28,2)), cast({large} * 0.01BD as decimal(28,2)))")

    halves = [f"_{name}_{half}" for name in sums for half in ("high", "low")]
    return grouped.withColumns({name: decimal(name) for name in sums}).drop(*halves)


def flagship(spark, sf_dir):
    """Line totals mapped and enriched by a spec, against a faulty load, on a two-column key."""
    lineitem, orders, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    totals = sum_of_hundredths(
        lineitem, ("l_orderkey", "l_linenumber"), {"quantity": "l_quantity", "revenue": "l_extendedprice"},
        F.min("l_partkey").alias("l_partkey"),
        F.max("l_returnflag").alias("l_returnflag"),
        F.count(F.lit(1)).alias("lines"),
    )
    if not splits_hot_keys(spark):
        totals = written(totals, "totals")  # the joins then read it once more, to count hot keys
    tables = {"line_totals": totals, "orders": orders, "part": part}
    expected = expected_table(spark, LINE_SPEC, tables)
    key = F.col("order_id")
    loaded = expected.filter(key % 97 != 0).withColumns({
        "quantity": F.when(key % 89 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")),
        "status": F.when(key % 83 != 0, F.col("status")),
        "batch_id": F.lit("B7"),
    })
    return compare_expected(spark, LINE_SPEC, expected, loaded)


_FACT_COLUMNS = ("customer_id", "returned", "quantity", "revenue", "product", "status")


@query(diff_sql(_fact_line(False), _fact_line(True), _FACT_COLUMNS))
def reconcile_flagship(spark, sf_dir):
    return flagship(spark, sf_dir).diff


# --- strategies ---------------------------------------------------------------------------

_ORDERS_SUMMARY = f"""
with s as ({canonical_orders("select * from orders")}), t as ({canonical_orders(LOADED_ORDERS)}),
j as (
  select s.k is not null as in_s, t.k is not null as in_t,
         {" or ".join(f"s.{c} is distinct from t.{c}" for c in ORDER_COLUMNS)} as changed
  from s full join t on s.k = t.k)
select count(*) filter (where in_s) as source_rows,
       count(*) filter (where in_t) as target_rows,
       count(*) filter (where in_s and in_t and not changed) as matched_rows,
       count(*) filter (where in_s and not in_t) as missing_rows,
       count(*) filter (where in_t and not in_s) as extra_rows,
       count(*) filter (where in_s and in_t and changed) as mismatched_rows,
       count(*) filter (where not in_s or not in_t or changed) as total_diffs,
       cast(0 as bigint) as duplicate_keys,
       case when count(*) filter (where not in_s or not in_t or changed) = 0 then 'PASS' else 'FAIL' end as verdict
from j"""


@query(_ORDERS_SUMMARY)
def reconcile_summary(spark, sf_dir):
    return _orders_result(spark, sf_dir).summary


@query(ORDERS_DIFF)
def reconcile_exact(spark, sf_dir):
    return _orders_result(spark, sf_dir, "exact").diff


@query(ORDERS_DIFF)
def reconcile_hash(spark, sf_dir):
    return _orders_result(spark, sf_dir, "hash").diff


@query(ORDERS_DIFF)
def reconcile_anti_inner(spark, sf_dir):
    return _orders_result(spark, sf_dir, "anti").diff


_CANONICAL = (canonical_orders("select * from orders"), canonical_orders(LOADED_ORDERS), ORDER_COLUMNS)


@query(diff_sql(*_CANONICAL, extra=False, cells=False))
def reconcile_missing(spark, sf_dir):
    return _orders_result(spark, sf_dir, "anti").diff.filter(F.col("diff_type") == MISSING)


@query(diff_sql(*_CANONICAL, missing=False, cells=False))
def reconcile_extra(spark, sf_dir):
    return _orders_result(spark, sf_dir, "anti").diff.filter(F.col("diff_type") == EXTRA)


@query(diff_sql(*_CANONICAL, missing=False, extra=False))
def reconcile_cells(spark, sf_dir):
    return _orders_result(spark, sf_dir, "exact").diff.filter(F.col("diff_type") == MISMATCH)


@query(diff_sql(canonical_orders("select * from orders"), canonical_orders("select * from orders"), ORDER_COLUMNS))
def reconcile_identical(spark, sf_dir):
    """Decided by fingerprints alone: no key of either side is compared with one of the other."""
    orders = table(spark, sf_dir, "orders")
    return reconcile(orders, orders, "o_orderkey", skip_equal=True).diff


_FEW_WRONG = f"""
    select * replace (case when l_orderkey % 499 = 0 then l_tax + 0.5 else l_tax end as l_tax) from lineitem where l_orderkey % 503 <> 0"""

_LINE_COUNTS = """
select (select count(*) from s) as source_rows, (select count(*) from t) as target_rows,
       (select cast(sum(least(s.n, t.n)) as bigint) from (select k, v, count(*) as n from s group by all) s join (select k, v, count(*) as n from t group by all) t on s.k = t.k and s.v = t.v) as matched_rows,
       (select count(*) from (select k from (select k, count(*) as n from s group by k union all select k, count(*) from t group by k) where n > 1 group by k)) as duplicate_keys"""


@query(f"""
with l as (select l_orderkey || '|' || l_linenumber as k, l_partkey || '/' || l_quantity || '/' || l_tax || '/' || l_shipdate as v from lineitem),
w as (select l_orderkey || '|' || l_linenumber as k, l_partkey || '/' || l_quantity || '/' || l_tax || '/' || l_shipdate as v from ({_FEW_WRONG})),
s as (select * from l), t as (select * from w) {_LINE_COUNTS}""")
def reconcile_skip_equal(spark, sf_dir):
    """Line items, of whose keys many are repeated, with a few wrong: equal slices of the key space are left out."""
    lines = table(spark, sf_dir, "lineitem")
    loaded = lines.filter("l_orderkey % 503 <> 0").withColumn(
        "l_tax", F.when(F.col("l_orderkey") % 499 == 0, F.col("l_tax") + 0.5).otherwise(F.col("l_tax"))
    )
    columns = ["l_partkey", "l_quantity", "l_tax", "l_shipdate"]
    result = reconcile(lines, loaded, ["l_orderkey", "l_linenumber"], columns, skip_equal=True)
    return result.summary.select("source_rows", "target_rows", "matched_rows", "duplicate_keys")


@query(ORDERS_DIFF)
def reconcile_saved_sides(spark, sf_dir):
    """Both sides saved by their key; the comparison of the saved sides moves neither."""
    orders = table(spark, sf_dir, "orders")
    saved, loaded = new_table_path(spark, "expected"), new_table_path(spark, "actual")
    run(spark, Side(orders, save_to=saved, save_keys=("o_orderkey",)), None)
    run(spark, None, Side(loaded_orders(orders), save_to=loaded, save_keys=("o_orderkey",)))
    return run(spark, Side(saved), Side(loaded), ["o_orderkey"], strategy="exact").diff


# --- null, duplicate and type rules --------------------------------------------------------

_NULL_SIDES = """
    select case when c_custkey = 1 then null else c_custkey end as k,
           case c_custkey % 4 when 0 then null when 1 then null when 2 then '' else ' ' end as e_note,
           case c_custkey % 4 when 0 then null when 1 then 'null' when 2 then null else '' end as a_note,
           case when c_custkey % 2 = 0 then c_mktsegment end as e_first,
           case when c_custkey % 2 = 0 then null else c_mktsegment end as e_second,
           case when c_custkey % 2 = 0 then null else c_mktsegment end as a_first,
           case when c_custkey % 2 = 0 then c_mktsegment end as a_second
    from customer"""


@query(f"""
with j as ({_NULL_SIDES})
select coalesce(cast(k as varchar), '\\N') as primary_key_value, column_name, expected_value, actual_value,
       'VALUE_MISMATCH' as diff_type
from (select k, 'note' as column_name, trim(e_note) as expected_value, trim(a_note) as actual_value from j
      union all select k, 'first', e_first, a_first from j
      union all select k, 'second', e_second, a_second from j)
where expected_value is distinct from actual_value""")
def reconcile_nulls(spark, sf_dir):
    """Null against null, 'null' and the empty string; a null key; values that swap columns with a null."""
    customer = table(spark, sf_dir, "customer")
    key, rest = F.col("c_custkey"), F.col("c_custkey") % 4
    even = F.col("c_custkey") % 2 == 0

    def side(notes, first, second):
        return customer.select(
            F.when(key != 1, key).alias("k"),
            F.when(rest == 2, notes[2]).when(rest == 3, notes[3]).when(rest == 1, notes[1]).alias("note"),
            F.when(first, F.col("c_mktsegment")).alias("first"),
            F.when(second, F.col("c_mktsegment")).alias("second"),
        )

    expected = side((None, F.lit(None), F.lit(""), F.lit(" ")), even, ~even)
    actual = side((None, F.lit("null"), F.lit(None), F.lit("")), ~even, even)
    return reconcile(expected, actual, ["k"]).diff


_LINE_KEYS = "cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar)"


@query(f"""
with e as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all),
     a as (select l_orderkey, l_linenumber, count(*) as n from lineitem where l_returnflag <> 'R' group by all)
select {_LINE_KEYS} as primary_key_value, coalesce(e.n, 0) as expected_rows, coalesce(a.n, 0) as actual_rows,
       case when e.n > 1 and a.n > 1 then 'DUPLICATE_KEY_IN_BOTH'
            when e.n > 1 then 'DUPLICATE_KEY_IN_SOURCE' else 'DUPLICATE_KEY_IN_TARGET' end as diff_type
from e full join a using (l_orderkey, l_linenumber) where e.n > 1 or a.n > 1""")
def reconcile_duplicates(spark, sf_dir):
    """Keys that are not unique, with the rows each side has for them."""
    lineitem = table(spark, sf_dir, "lineitem")
    loaded = lineitem.filter(F.col("l_returnflag") != "R")
    return reconcile(lineitem, loaded, ["l_orderkey", "l_linenumber"]).duplicates


def _line_side(loaded: bool) -> str:
    tax = "case when l_linestatus = 'O' and l_tax > 0.07 then null else l_tax end" if loaded else "l_tax"
    return f"""
    select {_LINE_KEYS} as k, cast(l_partkey as varchar) as l_partkey,
           cast(cast(l_extendedprice as decimal(38,6)) as varchar) as l_extendedprice,
           cast(cast({tax} as decimal(38,6)) as varchar) as l_tax, l_returnflag,
           cast(l_shipdate as varchar) as l_shipdate
    from lineitem {"where l_returnflag <> 'R'" if loaded else ""}"""


_LINE_COLUMNS = ("l_partkey", "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate")


def _repeated_diff(source: str, target: str, columns) -> str:
    """Diff of two relations with a text key ``k`` that may repeat: cells of unique keys, left-over rows of others."""
    return f"""
with all_s as ({source}), all_t as ({target}),
     repeated as (select k from all_s group by k having count(*) > 1 union select k from all_t group by k having count(*) > 1),
     more_s as (select k, count(*) as n from (
       select * from all_s where k in (from repeated) except all select * from all_t where k in (from repeated)) group by k),
     more_t as (select k, count(*) as n from (
       select * from all_t where k in (from repeated) except all select * from all_s where k in (from repeated)) group by k)
select * from ({diff_sql("select * from all_s where k not in (from repeated)",
                         "select * from all_t where k not in (from repeated)", columns)})
union all
select k, '<ENTIRE_ROW>', '<PRESENT_IN_SOURCE>' || case when n > 1 then ' x' || n else '' end, '<MISSING_IN_TARGET>',
       'MISSING_IN_TARGET' from more_s
union all
select k, '<ENTIRE_ROW>', '<EXTRA_IN_TARGET>', '<PRESENT_IN_TARGET>' || case when n > 1 then ' x' || n else '' end,
       'EXTRA_IN_TARGET' from more_t"""


_LINES_DIFF = _repeated_diff(_line_side(False), _line_side(True), _LINE_COLUMNS)


def _lines_result(spark, sf_dir, strategy):
    lineitem = table(spark, sf_dir, "lineitem")
    loaded = lineitem.filter(F.col("l_returnflag") != "R").withColumn(
        "l_tax", F.when(~((F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.07)), F.col("l_tax"))
    )
    return reconcile(lineitem, loaded, ["l_orderkey", "l_linenumber"], _LINE_COLUMNS, strategy=strategy)


@query(_LINES_DIFF)
def reconcile_composite_key(spark, sf_dir):
    """All line items on a two-column key that repeats."""
    return _lines_result(spark, sf_dir, "exact").diff


@query(f"""
with d as ({_LINES_DIFF}), s as ({_line_side(False)}), t as ({_line_side(True)}),
     n as (select diff_type, primary_key_value, max(coalesce(
             try_cast(regexp_extract(expected_value || '/' || actual_value, '> ?x([0-9]+)', 1) as bigint), 1)) as n from d group by all)
select a.*, a.source_rows - a.missing_rows - a.mismatched_rows as matched_rows,
       a.missing_rows + a.extra_rows + a.mismatched_rows as total_diffs, 'FAIL' as verdict
from (select (select count(*) from s) as source_rows, (select count(*) from t) as target_rows,
             (select cast(sum(n) as bigint) from n where diff_type = 'MISSING_IN_TARGET') as missing_rows,
             (select coalesce(cast(sum(n) as bigint), 0) from n where diff_type = 'EXTRA_IN_TARGET') as extra_rows,
             (select count(*) from n where diff_type = 'VALUE_MISMATCH') as mismatched_rows,
             (select count(*) from (select k from s group by k having count(*) > 1
                                    union select k from t group by k having count(*) > 1)) as duplicate_keys) a""")
def reconcile_repeated_rows(spark, sf_dir):
    """Every row of a table with repeated keys is matched, mismatched, missing or extra."""
    return _lines_result(spark, sf_dir, "hash").summary


_NUMBER_TEXT = """case o_orderkey % 4 when 0 then '0.' || repeat('0', 23) || '1' || lpad(cast(o_orderkey as {text}), 5, '0') || '7'
    when 1 then '-100' || cast(o_orderkey as {text}) when 2 then cast(o_orderkey as {text}) || '.5' else cast(o_orderkey as {text}) end"""


@query(f"""
with o as (select o_orderkey, {_NUMBER_TEXT.format(text="varchar")} as k, o_custkey from orders where o_orderkey < 90000)
select k as primary_key_value, 'o_custkey' as column_name, cast(o_custkey as varchar) as expected_value,
       cast(o_custkey + 1 as varchar) as actual_value, 'VALUE_MISMATCH' as diff_type from o where o_orderkey % 11 = 0 and o_orderkey % 13 <> 0
union all
select k, '<ENTIRE_ROW>', '<PRESENT_IN_SOURCE>', '<MISSING_IN_TARGET>', 'MISSING_IN_TARGET' from o where o_orderkey % 13 = 0""")
def reconcile_number_keys(spark, sf_dir):
    """Keys from 1e-24 to ten million, as decimals on one side and doubles on the other."""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey < 90000")
    orders = orders.withColumn("t", F.expr(_NUMBER_TEXT.format(text="string")))
    expected = orders.select(F.col("t").cast("decimal(38,30)").alias("k"), "o_custkey")
    actual = orders.filter("o_orderkey % 13 <> 0").select(
        F.col("t").cast("double").alias("k"), (F.col("o_custkey") + (F.col("o_orderkey") % 11 == 0).cast("int")).alias("o_custkey")
    )
    return reconcile(expected, actual, "k").diff


_MIXED_KEY = "case when o_orderkey % 2 = 0 then 9007199254740992 + o_orderkey else o_orderkey end"


@query(f"""
with o as (select {_MIXED_KEY} as k, o_orderkey % 7 = 0 as changed, o_custkey from orders),
     s as (select cast(k as varchar) as k, o_custkey from o),
     t as (select cast(cast(cast(k as double) as decimal(38,0)) as varchar) as k,
                  case when changed then -1 else o_custkey end as o_custkey from o),
     tu as (select k from t group by k having count(*) > 1)
select s.k as primary_key_value, '<ENTIRE_ROW>' as column_name, '<PRESENT_IN_SOURCE>' as expected_value,
       '<MISSING_IN_TARGET>' as actual_value, 'MISSING_IN_TARGET' as diff_type
from s where k not in (select k from t)
union all
select s.k, 'o_custkey', cast(s.o_custkey as varchar), cast(t.o_custkey as varchar), 'VALUE_MISMATCH'
from s join t on s.k = t.k where s.o_custkey <> t.o_custkey and s.k not in (from tu)
union all
select k, '<ENTIRE_ROW>', '<PRESENT_IN_SOURCE>', '<MISSING_IN_TARGET>', 'MISSING_IN_TARGET'
from s where k in (from tu) and not exists (select 1 from t where t.k = s.k and t.o_custkey = s.o_custkey)
union all
select k, '<ENTIRE_ROW>', '<EXTRA_IN_TARGET>', '<PRESENT_IN_TARGET>' || case when n > 1 then ' x' || n else '' end, 'EXTRA_IN_TARGET'
from (select k, count(*) as n from (select k, o_custkey from t where k in (from tu) except all select k, o_custkey from s) group by k)""")
def reconcile_key_types(spark, sf_dir):
    """Whole-number keys on both sides of 2**53 against the doubles a careless load makes of them."""
    key = F.expr(_MIXED_KEY)
    orders = table(spark, sf_dir, "orders")
    expected = orders.select(key.alias("k"), "o_custkey")
    custkey = F.when(F.col("o_orderkey") % 7 == 0, -1).otherwise(F.col("o_custkey"))
    return reconcile(expected, orders.select(key.cast("double").alias("k"), custkey.alias("o_custkey")), "k").diff


def _text_keys(relation: str) -> str:
    return f"""
    select case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then '' else o_orderstatus || '|' end as a,
           case when o_orderkey % 3 = 0 then '|' || o_orderkey else 'b' || o_orderkey end as b, o_custkey from {relation}"""


@query(f"""
with s as ({_text_keys("orders")}), t as ({_text_keys("orders where o_orderkey % 4 <> 0")})
select 'MISSING_IN_TARGET' as diff_type, cast(count(*) as bigint) as affected_rows from s
where not exists (select 1 from t where t.a is not distinct from s.a and t.b = s.b) having count(*) > 0""")
def diff_by_type_text_keys(spark, sf_dir):
    """Composite text keys with the separator, nulls and empty pieces count each for itself."""
    a = "case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then '' else o_orderstatus || '|' end as a"
    b = "case when o_orderkey % 3 = 0 then '|' || o_orderkey else 'b' || o_orderkey end as b"
    orders = table(spark, sf_dir, "orders")
    expected, actual = (df.selectExpr(a, b, "o_custkey") for df in (orders, orders.filter("o_orderkey % 4 <> 0")))
    return diff_by_type(reconcile(expected, actual, ["a", "b"]).diff)


@query("""
select cast(vec_id as varchar) as primary_key_value, column_name, 'VALUE_MISMATCH' as diff_type
from embeddings, (values ('embedding', 6), ('entries', 10), ('raw', 15)) as c(column_name, every)
where vec_id % every = 0""")
def reconcile_nested_types(spark, sf_dir):
    """Arrays of floats against arrays of doubles, maps in another order, and bytes; all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    key = F.col("vec_id")
    first, second = F.lit("a"), F.lit("b")

    def side(loaded: bool):
        value = F.col("embedding").cast("array<double>") if loaded else F.col("embedding")
        if loaded:
            value = F.when(key % 6 == 0, F.transform(value, lambda x: x + 1)).otherwise(value)
        number = F.when(key % 10 == 0, -1.5).otherwise(0.5) if loaded else F.lit(0.5)
        pairs = [F.struct(first, number), F.struct(second, F.lit(None).cast("double"))]
        entries = F.map_from_entries(F.array(*(reversed(pairs) if loaded else pairs)))
        raw = F.when(key % 15 == 0, "other").otherwise("same") if loaded else F.lit("same")
        return vectors.select("vec_id", value.alias("embedding"), entries.alias("entries"), raw.cast("binary").alias("raw"))

    # the texts of the values are long and are checked by the unit tests
    return reconcile(side(False), side(True), "vec_id").diff.select("primary_key_value", "column_name", "diff_type")


def _balances(bias: str, dtype: str) -> str:
    return f"""
    select cast(c_custkey as varchar) as k, cast(cast({bias} as {dtype}) as varchar) as c_acctbal,
           cast(c_nationkey as varchar) as c_nationkey
    from customer"""


@query(diff_sql(
    _balances("c_acctbal", "decimal(38,2)"),
    _balances("c_acctbal + case when c_custkey % 3 = 0 then 0.01 else 0.002 end", "decimal(38,2)"),
    ("c_acctbal", "c_nationkey"),
))
def reconcile_number_types(spark, sf_dir):
    """Double against decimal and int against bigint: equal at the declared scale."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    bias = F.when(F.col("c_custkey") % 3 == 0, 0.01).otherwise(0.002)
    expected = customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    actual = customer.withColumns({
        "c_custkey": F.col("c_custkey").cast("decimal(20,0)"),
        "c_acctbal": F.col("c_acctbal") + bias,
        "c_nationkey": F.col("c_nationkey").cast("bigint"),
    })
    return reconcile(expected, actual, "c_custkey").diff


@query(ORDERS_DIFF)
def reconcile_coerced(spark, sf_dir):
    """Typed orders against a loaded table that holds nothing but text, as an untyped CSV does."""
    orders = table(spark, sf_dir, "orders")
    loaded = loaded_orders(orders).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,6)"))
    as_text = loaded.select([F.col(c).cast("string").alias(c) for c in loaded.columns])
    return reconcile(orders, as_text, "o_orderkey", coerce=True).diff


@query("""
select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
       cast(cast(l_extendedprice as decimal(38,6)) as varchar) as l_extendedprice,
       cast(cast(l_discount as decimal(38,6)) as varchar) as l_discount,
       trim(l_returnflag) as l_returnflag, cast(l_shipdate as varchar) as l_shipdate
from lineitem""")
def normalise_values(spark, sf_dir):
    columns = ["L_ORDERKEY", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
    return normalise(table(spark, sf_dir, "lineitem"), columns)


_WIDE = [f"w{i:03d}" for i in range(300)]


@query("""
select cast(o_orderkey as varchar) as primary_key_value, 'w123' as column_name, cast(o_custkey + 123 as varchar) as expected_value,
       cast(o_custkey + 124 as varchar) as actual_value, 'VALUE_MISMATCH' as diff_type from orders where o_orderkey % 50 = 0 and o_orderkey % 97 <> 0
union all
select cast(o_orderkey as varchar), '<ENTIRE_ROW>', '<PRESENT_IN_SOURCE>', '<MISSING_IN_TARGET>', 'MISSING_IN_TARGET'
from orders where o_orderkey % 97 = 0""")
def reconcile_wide(spark, sf_dir):
    """300 columns of which one changed: the census names its group, and the detail scan makes only that.

    The columns are made where they are compared: as tables, 300 of them twice would be most of what is written.
    """
    orders = table(spark, sf_dir, "orders")
    wide = orders.select("o_orderkey", *[(F.col("o_custkey") + i).alias(c) for i, c in enumerate(_WIDE)])
    changed = (F.col("o_orderkey") % 50 == 0).cast("int")
    loaded = wide.filter("o_orderkey % 97 <> 0").withColumn("w123", F.col("w123") + changed)
    return reconcile(wide, loaded, "o_orderkey").diff


# --- columns, filters, snapshots, verdict -----------------------------------------------------

def _event_side(loaded: bool) -> str:
    value = "case when event_type = 'error' then value + 0.5 else value end" if loaded else "value"
    return f"""
    select cast(event_id as varchar) as k, event_type, cast(cast({value} as decimal(38,6)) as varchar) as value,
           cast(user_id as varchar) as user_id, cast(ts as varchar) as ts, trim(props) as props
    from events"""


@query(diff_sql(_event_side(False), _event_side(True), ("event_type", "value", "user_id", "ts", "props")))
def reconcile_auto_columns(spark, sf_dir):
    """Columns chosen by name: upper case on one side, audit columns and one-sided columns left out."""
    events = table(spark, sf_dir, "events")
    expected = events.withColumns({"load_ts": F.lit("2024-01-01"), "only_here": F.lit(1)})
    changed = F.when(F.col("event_type") == "error", F.col("value") + 0.5).otherwise(F.col("value"))
    actual = events.withColumns({"value": changed, "load_ts": F.lit("2024-06-30"), "batch_id": F.lit(7)})
    actual = actual.toDF(*[c.upper() for c in actual.columns])
    keys = ["EVENT_ID"]
    return reconcile(expected, actual, keys, compare_columns(expected, actual, keys)).diff


_IN_RANGE = """where o_orderkey between (select max(o_orderkey) // 4 from orders) and (select max(o_orderkey) from orders)
      and o_orderdate >= timestamp '1996-01-01 00:00:00' and o_orderdate <= timestamp '1999-12-31 00:00:00'"""


@query(diff_sql(
    canonical_orders(f"select * from orders {_IN_RANGE}"),
    canonical_orders(f"select * from ({LOADED_ORDERS}) {_IN_RANGE}"),
    ORDER_COLUMNS,
))
def reconcile_filtered(spark, sf_dir):
    """The same key and date range on both sides, on keys with different names."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    dates = DateFilter("range", "1996-01-01", "o_orderdate", "1999-12-31", "o_orderdate")
    source, target = load_filters(
        "o_orderkey", "order_id", mode="pk_range", lower=top // 4, upper=top, dates=dates
    )
    loaded = loaded_orders(orders).withColumnRenamed("o_orderkey", "order_id")
    result = run(
        spark,
        Side(orders, source),
        Side(loaded, target, transform=lambda df: df.withColumnRenamed("order_id", "o_orderkey")),
        ["o_orderkey"],
    )
    return result.diff


@query(ORDERS_DIFF)
def reconcile_from_snapshot(spark, sf_dir):
    """Both sides saved first, one as Parquet and one as CSV, then compared from the saved files."""
    orders = table(spark, sf_dir, "orders")
    saved, loaded = new_table_path(spark, "expected"), new_table_path(spark, "actual")
    run(spark, Side(orders, save_to=saved), None)
    run(spark, None, Side(loaded_orders(orders), save_to=loaded, fmt="csv"))
    return run(spark, Side(saved), Side(loaded, fmt="csv"), ["o_orderkey"]).diff


@query("""
select count(*) as source_rows, count(*) as target_rows, count(*) as matched_rows, 0 as missing_rows, 0 as extra_rows,
       0 as mismatched_rows, 0 as total_diffs, 0 as duplicate_keys, 'PASS' as verdict from events""")
def reconcile_precise_snapshot(spark, sf_dir):
    """Events with microseconds, compared with their own CSV snapshot: not one difference."""
    micros = F.col("event_id") * 7 % 1_000_000
    events = table(spark, sf_dir, "events").withColumn("ts", F.timestamp_add("MICROSECOND", micros, F.col("ts")))
    saved = new_table_path(spark, "saved")
    run(spark, None, Side(events, save_to=saved, fmt="csv"))
    return run(spark, Side(events), Side(saved, fmt="csv"), ["event_id"]).summary


_VERDICT = """
  select '{name}' as scenario, case when n = 0 then 'PASS' else 'FAIL' end as verdict,
         cast(case when n = 0 then 0 else 3 end as bigint) as exit_code, n as total_diffs
  from (select count(*) as n from s full join t on s.k = t.k where {differs})"""


@query(f"""
with s as ({canonical_orders("select * from orders")}), loaded as ({canonical_orders(LOADED_ORDERS)}),
more as (select * from s union all select * from loaded where k not in (select k from s))
{_VERDICT.format(name="identical", differs="s.k is null or t.k is null").replace("join t", "join s t")}
union all
{_VERDICT.format(name="extra_only", differs="s.k is null or t.k is null").replace("join t", "join more t")}
union all
{_VERDICT.format(
    name="faulty_load",
    differs="s.k is null or t.k is null or " + " or ".join(f"s.{c} is distinct from t.{c}" for c in ORDER_COLUMNS),
).replace("join t", "join loaded t")}""")
def reconcile_verdict(spark, sf_dir):
    """Verdict and exit code of three loads; extra rows alone fail too."""
    orders = table(spark, sf_dir, "orders")
    loaded = loaded_orders(orders)
    extra = orders.unionByName(loaded.join(orders.select("o_orderkey"), "o_orderkey", "left_anti"))
    parts = []
    for name, actual in (("identical", orders), ("extra_only", extra), ("faulty_load", loaded)):
        result = reconcile(orders, actual, "o_orderkey")
        parts.append(result.summary.select(
            F.lit(name).alias("scenario"), "verdict",
            F.lit(result.exit_code).cast("bigint").alias("exit_code"), "total_diffs",
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- reports ------------------------------------------------------------------------------------

@query(f"select diff_type, count(distinct primary_key_value) as affected_rows from ({ORDERS_DIFF}) group by 1",
       name="diff_by_type")
def report_by_type(spark, sf_dir):
    return diff_by_type(_orders_result(spark, sf_dir))


@query(f"select column_name, count(*) as differences from ({ORDERS_DIFF}) group by 1",
       name="diff_by_column")
def report_by_column(spark, sf_dir):
    return diff_by_column(_orders_result(spark, sf_dir).diff)


@query(ORDERS_DIFF)
def report_csv(spark, sf_dir):
    """The diff report written as CSV and read back."""
    path = new_table_path(spark, "report")
    write_report(_orders_result(spark, sf_dir), path)
    return read_csv(spark, path)


@query(f"select * from ({_LINES_DIFF})")
def report_repeated_keys(spark, sf_dir):
    """A report of a table with repeated keys, written as CSV and read back."""
    path = new_table_path(spark, "report")
    write_report(_lines_result(spark, sf_dir, "hash"), path)
    return read_csv(spark, path)
