"""Mapping specs, enrichment joins, null policies, coercions and scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions.rules import fill_mode, fill_text, snowflake_value
from evenkeel.plans.mapping import apply_mapping, enrich, extract
from evenkeel.plans.spec import ColumnRule, JoinDef, SourceColumn, TableSpec
from queries.registry import query, table


def _spec(source, columns, rules, joins=()):
    return TableSpec(source, "target", tuple(SourceColumn(c) for c in columns), tuple(rules), tuple(joins))


ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
LINEITEM = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")


def _mapped(spark, sf_dir, name, columns, rules, **options):
    return apply_mapping(table(spark, sf_dir, name), _spec(name, columns, rules), **options)


@query("""
select o_orderkey as order_id, o_orderdate as ordered_at, o_orderstatus, o_custkey as customer_id from orders""")
def apply_mapping_orders(spark, sf_dir):
    """Renamed, copied and dropped columns in target order."""
    return _mapped(spark, sf_dir, "orders", ORDERS, [
        ColumnRule("rename", "o_orderkey", "order_id"),
        ColumnRule("rename", "o_orderdate", "ordered_at"),
        ColumnRule("direct", "o_orderstatus", "o_orderstatus"),
        ColumnRule("rename", "o_custkey", "customer_id"),
        ColumnRule("drop", "o_totalprice"),
        ColumnRule("drop", "o_orderpriority"),
    ])


@query("""
select o_orderkey as order_id,
       case when o_orderstatus = 'F' then 1 else 0 end as is_final,
       cast(cast(o_totalprice as decimal(18,1)) as decimal(18,1)) as price,
       cast(o_custkey as varchar) as customer,
       upper(trim(o_orderpriority)) as priority,
       cast(left(o_orderpriority, 1) as integer) as priority_no,
       try_cast(o_orderpriority as integer) as not_a_number,
       'val is ' || o_orderstatus as note
from orders""")
def apply_mapping_derived(spark, sf_dir):
    """Cast and derived columns from SQL rules, from functions, and with a forced type."""
    return _mapped(spark, sf_dir, "orders", ORDERS, [
        ColumnRule("direct", "o_orderkey", "order_id"),
        ColumnRule("derived", "o_orderstatus", "is_final", rule="if(val = 'F', 1, 0)"),
        ColumnRule("cast", "o_totalprice", "price", rule="cast(val as decimal(18,1))"),
        ColumnRule("cast", "o_custkey", "customer", rule=lambda val: val.cast("string")),
        ColumnRule("derived", "o_orderpriority", "priority", rule="UPPER(TRIM(val))"),
        ColumnRule("derived", "o_orderpriority", "priority_no", rule="left(val, 1)", force_dtype="int"),
        ColumnRule("direct", "o_orderpriority", "not_a_number", force_dtype="int"),
        ColumnRule("derived", "o_orderstatus", "note", rule="concat('val is ', val)"),
    ])


@query("""
select c_custkey, 'Y' as flag, 7 as number, cast(1.5 as double) as ratio, true as yes, false as no,
       'IDENTITY card' as words, 'nan' as not_a_number, 0 as zero, false as false_value,
       true as has_ts, true as has_date, true as has_now, true as has_uuid, true as no_identity, true as no_value,
       'ETL_VALIDATION' as batch_id
from customer""")
def apply_mapping_constants(spark, sf_dir):
    """Every kind of constant; values that depend on the time are only checked to be there."""
    mapped = _mapped(spark, sf_dir, "customer", CUSTOMER, [
        ColumnRule("direct", "c_custkey", "c_custkey"),
        ColumnRule("constant", None, "flag", rule="'Y'"),
        ColumnRule("constant", None, "number", rule="7"),
        ColumnRule("constant", None, "ratio", rule="1.5"),
        ColumnRule("constant", None, "yes", rule="TRUE"),
        ColumnRule("constant", None, "no", rule="FALSE"),
        ColumnRule("constant", None, "words", rule="'IDENTITY card'"),
        ColumnRule("constant", None, "not_a_number", rule="'nan'"),
        ColumnRule("constant", None, "zero", rule=0),
        ColumnRule("constant", None, "false_value", rule=False),
        ColumnRule("constant", None, "ts", rule="CURRENT_TIMESTAMP"),
        ColumnRule("constant", None, "day", rule="CURRENT_DATE()"),
        ColumnRule("constant", None, "now", rule="NOW()"),
        ColumnRule("constant", None, "id", rule="UUID()"),
        ColumnRule("constant", None, "serial", rule="IDENTITY(1,1)"),
        ColumnRule("constant", None, "nothing", rule="NULL"),
        ColumnRule("constant", None, "batch_id", rule="SYS_BATCH_ID"),
    ])
    return mapped.select(
        "c_custkey", "flag", "number", "ratio", "yes", "no", "words", "not_a_number", "zero", "false_value",
        F.col("ts").isNotNull().alias("has_ts"), F.col("day").isNotNull().alias("has_date"),
        F.col("now").isNotNull().alias("has_now"), (F.length("id") == 36).alias("has_uuid"),
        F.col("serial").isNull().alias("no_identity"), F.col("nothing").isNull().alias("no_value"), "batch_id",
    )


_PRICE_RULES = [
    ColumnRule("direct", "l_orderkey", "l_orderkey"),
    ColumnRule("direct", "l_linenumber", "l_linenumber"),
    ColumnRule("derived", "l_quantity", "l_quantity", rule="cast(val as int) + 1"),
    ColumnRule("derived", "l_quantity", "twice", rule="cast(val as int) * 2"),
]


@query("""
select l_orderkey, l_linenumber, cast(l_quantity as integer) + 1 as l_quantity, cast(l_quantity as integer) * 2 as twice
from lineitem""")
def apply_mapping_simultaneous(spark, sf_dir):
    """Rules read the source row, whatever an earlier rule put in its place."""
    return _mapped(spark, sf_dir, "lineitem", LINEITEM, _PRICE_RULES)


@query("""
select l_orderkey, l_linenumber, cast(l_quantity as integer) + 1 as l_quantity,
       (cast(l_quantity as integer) + 1) * 2 as twice
from lineitem""")
def apply_mapping_sequential(spark, sf_dir):
    """Rules one after the other: the second sees the column the first replaced."""
    return _mapped(spark, sf_dir, "lineitem", LINEITEM, _PRICE_RULES, sequential=True)


def _enriched(spark, sf_dir, how):
    """All orders with all customers, whose keys are shifted so that both sides have unmatched rows."""
    spec = _spec(
        "orders", ORDERS,
        [
            ColumnRule("direct", "o_orderkey", "o_orderkey"),
            ColumnRule("direct", "cust.c_name", "customer"),
            ColumnRule("derived", None, "label", rule="concat(cust.c_mktsegment, '/', o_orderstatus)"),
            ColumnRule("drop", "o_totalprice"),
        ],
        [JoinDef("cust", "customer", "o_custkey", "c_custkey", ("c_name",), how, database="crm")],
    )
    customer = table(spark, sf_dir, "customer").withColumn("c_custkey", F.col("c_custkey") - 50)
    extracted = extract(spec, {"orders": table(spark, sf_dir, "orders"), "crm.customer": customer})
    return extracted, apply_mapping(extracted, spec)


_ENRICHED = """
select o_orderkey, c_name as customer, c_mktsegment || '/' || o_orderstatus as label
from orders {how} join customer on o_custkey = c_custkey - 50"""


@query("""
select o_orderkey, o_custkey, o_orderstatus, c_name as cust_c_name, c_mktsegment as cust_c_mktsegment
from orders left join customer on o_custkey = c_custkey - 50""")
def extract_enriched(spark, sf_dir):
    """Needed columns only, the join key included, and a column that only a rule mentions."""
    return _enriched(spark, sf_dir, "LEFT")[0]


@query(_ENRICHED.format(how="left"))
def enrich_left(spark, sf_dir):
    return _enriched(spark, sf_dir, "LEFT")[1]


@query(_ENRICHED.format(how="inner"))
def enrich_inner(spark, sf_dir):
    return _enriched(spark, sf_dir, "INNER")[1]


@query(_ENRICHED.format(how="right"))
def enrich_right(spark, sf_dir):
    return _enriched(spark, sf_dir, "RIGHT")[1]


@query("""
with l as (select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 1 when l_orderkey % 7 <> 0 then l_partkey end as part from lineitem)
select l.*, p_name as prt_p_name, p_retailprice as prt_p_retailprice from l left join part on part = p_partkey""")
def enrich_hot_key(spark, sf_dir):
    """A third of all lines of one part, others without a part: the hot keys are dealt to several tasks when the plan is made."""
    part = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 7 != 0, F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", part.alias("part"))
    join = JoinDef("prt", "part", "part", "p_partkey", ("p_name", "p_retailprice"))
    return enrich(lines, join, table(spark, sf_dir, "part"), spread=True)


@query("""
select l_orderkey, l_linenumber, l_partkey,
       p_name as prt_p_name, s_name as sup_s_name, o_orderdate as ord_o_orderdate
from lineitem left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey
     inner join orders on l_orderkey = o_orderkey""")
def enrich_many(spark, sf_dir):
    """Several enrichment joins of the widest table."""
    spec = _spec(
        "lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax"),
        [
            ColumnRule("direct", "l_orderkey", "l_orderkey"),
            ColumnRule("direct", "l_linenumber", "l_linenumber"),
            ColumnRule("direct", "prt.p_name", "part"),
            ColumnRule("direct", "sup.s_name", "supplier"),
            ColumnRule("direct", "ord.o_orderdate", "ordered"),
            ColumnRule("drop", "l_tax"),
        ],
        [
            JoinDef("prt", "part", "l_partkey", "p_partkey", ("p_name",)),
            JoinDef("sup", "supplier", "l_suppkey", "s_suppkey", ("s_name",)),
            JoinDef("ord", "orders", "l_orderkey", "o_orderkey", ("o_orderdate",), "INNER"),
        ],
    )
    names = ("lineitem", "part", "supplier", "orders")
    return extract(spec, {n: table(spark, sf_dir, n) for n in names}).drop("l_suppkey")


_HOLES = {
    "c_nationkey": "if(val % 5 = 0, null, val)",
    "c_mktsegment": "nullif(val, 'BUILDING')",
    "c_acctbal": "if(val < 0, null, val)",
}


@query("""
select c_custkey, coalesce(case when c_nationkey % 5 <> 0 then c_nationkey end, 0) as nation,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'NONE') as segment,
       nullif(c_mktsegment, 'BUILDING') as kept,
       coalesce(nullif(c_mktsegment, 'BUILDING'), '0') as zeroed,
       coalesce(case when c_acctbal >= 0 then c_acctbal end, 0) as balance
from customer""")
def null_handling(spark, sf_dir):
    """Null policies: zero in the type of the column, a default, and left as null."""
    return _mapped(spark, sf_dir, "customer", CUSTOMER, [
        ColumnRule("direct", "c_custkey", "c_custkey"),
        ColumnRule("derived", "c_nationkey", "nation", rule=_HOLES["c_nationkey"], nulls="fill_zero"),
        ColumnRule("derived", "c_mktsegment", "segment", rule=_HOLES["c_mktsegment"],
                   nulls="fill_default", default="NONE"),
        ColumnRule("derived", "c_mktsegment", "kept", rule=_HOLES["c_mktsegment"], nulls="fill_empty"),
        ColumnRule("derived", "c_mktsegment", "zeroed", rule=_HOLES["c_mktsegment"], nulls="fill_zero"),
        ColumnRule("derived", "c_acctbal", "balance", rule=_HOLES["c_acctbal"], nulls="fill_zero"),
    ])


@query("""
with o as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority,
                  case when o_custkey % 3 <> 0 then o_orderstatus end as status from orders),
     p as (select priority as v from o where priority is not null group by 1 order by count(*) desc, 1 limit 1),
     q as (select status as v from o where status is not null group by 1 order by count(*) desc, 1 limit 1)
select o_orderkey, coalesce(priority, (select v from p)) as priority, coalesce(status, (select v from q)) as status
from o""", name="fill_mode")
def fill_most_frequent(spark, sf_dir):
    """Nulls replaced by the most frequent value of the column."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderstatus")).alias("status"),
    )
    return fill_mode(orders, ["priority", "status"])


@query("select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') as segment from customer", name="fill_text")
def fill_empty_text(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    return fill_text(customer.select("c_custkey", segment), ["segment"])


@query("""
select o_orderkey, o_orderkey % 2 = 1 as odd, rtrim(o_orderpriority || '  ') as priority,
       case when o_orderstatus = 'P' then null else strftime(o_orderdate, '%Y-%m-%d') end as day,
       case when o_orderstatus <> 'P' then o_orderdate end as at, strftime(o_orderdate, '%H:%M:%S') as clock,
       cast(year(o_orderdate) as integer) as yr, cast(cast(o_totalprice as decimal(12,1)) as double) as price,
       cast(cast(o_totalprice as decimal(12,1)) as double) as cost, o_orderdate as changed
from orders""")
def dialect_coercion(spark, sf_dir):
    """Values of one database as another takes them: flags, padding, zero dates, times, years, decimals."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    source = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 2).cast("tinyint").alias("odd"),
        F.concat("o_orderpriority", F.lit("  ")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "0000-00-00").otherwise(day).alias("day"),
        F.when(F.col("o_orderstatus") == "P", "0000-00-00 00:00:00")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("at"),
        F.col("o_orderdate").alias("clock"),
        F.date_format("o_orderdate", "yyyy").alias("yr"),
        F.col("o_totalprice").cast("decimal(12,1)").alias("price"),
        F.col("o_totalprice").cast("decimal(12,1)").alias("cost"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("changed"),
    )
    types = {"o_orderkey": "bigint", "odd": "TINYINT(1)", "priority": "CHAR(20)", "day": "DATE", "at": "DATETIME",
             "clock": "TIME", "yr": "YEAR", "price": "DECIMAL(12,1)", "cost": " numeric ( 12 , 1 )", "changed": "timestamp(6)"}
    rules = [ColumnRule("direct", c, c, dtype=t) for c, t in types.items()]
    return apply_mapping(source, _spec("source", tuple(types), rules), dialect="snowflake")


# --- scalar rules ----------------------------------------------------------------------------


@query("""
select c_custkey, upper(trim(c_name)) as upper_trim, upper(c_mktsegment) as upper_segment,
       trim('  ' || c_name || ' ') as trimmed, lower(c_mktsegment) as lower_segment,
       rtrim(c_name || '   ') as right_trimmed, c_name || '/' || c_mktsegment as joined,
       lpad(cast(c_nationkey as varchar), 4, '0') as zero_filled,
       c_name || '-' || cast(c_nationkey as varchar) as chained,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as first_value,
       coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) as if_null
from customer""")
def scalar_string_rules(spark, sf_dir):
    return _mapped(spark, sf_dir, "customer", CUSTOMER, [
        ColumnRule("direct", "c_custkey", "c_custkey"),
        ColumnRule("derived", "c_name", "upper_trim", rule="UPPER(TRIM(val))"),
        ColumnRule("derived", "c_mktsegment", "upper_segment", rule="UPPER(c_mktsegment)"),
        ColumnRule("derived", "c_name", "trimmed", rule="TRIM('  ' || val || ' ')"),
        ColumnRule("derived", "c_mktsegment", "lower_segment", rule="LOWER(val)"),
        ColumnRule("derived", "c_name", "right_trimmed", rule="RTRIM(val || '   ')"),
        ColumnRule("derived", "c_name", "joined", rule="CONCAT(c_name, '/', c_mktsegment)"),
        ColumnRule("derived", "c_nationkey", "zero_filled", rule="lpad(string(val), 4, '0')"),
        ColumnRule("derived", "c_nationkey", "chained", rule="c_name || '-' || string(val)"),
        ColumnRule("derived", "c_mktsegment", "first_value", rule="COALESCE(nullif(val, 'BUILDING'), 'none')"),
        ColumnRule("derived", "c_mktsegment", "if_null", rule="IFNULL(nullif(val, 'BUILDING'), c_name)"),
    ])


@query("""
select o_orderkey, case when s is null then 0 else 1 end as is_set, case when s is not null then 1 else 0 end as is_set2,
       case when s = 'F' then 'done' else 'open' end as eq, case when s <> 'F' then 1 else 0 end as ne,
       case when o_totalprice < 1000 then 1 else 0 end as lt, case when o_totalprice <= 1000 then 1 else 0 end as le,
       case when o_totalprice > 250000 then 1 else 0 end as gt,
       case when o_totalprice >= 250000 then 'big' else o_orderpriority end as ge,
       case when o_custkey = 1 then 'one' else 'many' end as if_rule,
       case when s = 'O' then 'x' when o_totalprice > 400000 then 'y' else 'z' end as case_rule
from (select *, nullif(o_orderstatus, 'P') as s from orders)""")
def scalar_conditional_rules(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("s", F.nullif("o_orderstatus", F.lit("P")))
    derived = [
        ("s", "is_set", "CASE WHEN val IS NULL THEN 0 ELSE 1 END"),
        ("s", "is_set2", lambda val: F.when(val.isNotNull(), 1).otherwise(0)),
        ("s", "eq", "IF(val = 'F', 'done', 'open')"),
        ("s", "ne", lambda val: F.when(val != "F", 1).otherwise(0)),
        ("o_totalprice", "lt", "IF(val < 1000, 1, 0)"),
        ("o_totalprice", "le", "IF(val <= 1000, 1, 0)"),
        ("o_totalprice", "gt", "IF(val > 250000, 1, 0)"),
        ("o_totalprice", "ge", "IF(val >= 250000, 'big', o_orderpriority)"),
        ("o_custkey", "if_rule", "IF(val = 1, 'one', 'many')"),
        ("s", "case_rule", "CASE WHEN val = 'O' THEN 'x' WHEN o_totalprice > 400000 THEN 'y' ELSE 'z' END"),
    ]
    rules = [ColumnRule("direct", "o_orderkey", "o_orderkey")]
    rules += [ColumnRule("derived", source, target, rule=rule) for source, target, rule in derived]
    return apply_mapping(orders, _spec("orders", (*ORDERS, "s"), rules))


@query("""
select l_orderkey, l_linenumber,
       round(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))), 2) as net,
       cast(l_quantity as integer) * 3 + l_linenumber as units,
       cast(cast(l_extendedprice as decimal(18,1)) as varchar) as price_text,
       cast(l_linenumber as double) as line
from lineitem""")
def scalar_numeric_rules(spark, sf_dir):
    return _mapped(spark, sf_dir, "lineitem", LINEITEM, [
        ColumnRule("direct", "l_orderkey", "l_orderkey"),
        ColumnRule("direct", "l_linenumber", "l_linenumber"),
        ColumnRule("derived", None, "net", rule=(
            "ROUND(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))), 2)")),
        ColumnRule("derived", "l_quantity", "units", rule="int(val) * 3 + l_linenumber"),
        ColumnRule("cast", "l_extendedprice", "price_text", rule="cast(cast(val as decimal(18,1)) as string)"),
        ColumnRule("cast", "l_linenumber", "line", rule="CAST(val AS double)"),
    ])


@query("""
select event_id, strftime(ts, '%H:%M:%S') as clock, strftime(ts, '%Y-%m-%d') as day,
       case when event_type = 'error' then null else strftime(ts, '%Y-%m-%d') end as kept,
       ts >= timestamp '2024-01-02 00:00:00' as is_later, cast(year(ts) as integer) as yr
from events""")
def scalar_date_rules(spark, sf_dir):
    columns = ("event_id", "ts", "user_id", "event_type", "value", "props")
    zero_date = "if(event_type = 'error', '0000-00-00', date_format(val, 'yyyy-MM-dd'))"
    mapped = _mapped(spark, sf_dir, "events", columns, [
        ColumnRule("direct", "event_id", "event_id"),
        ColumnRule("derived", "ts", "clock", rule="date_format(val, 'HH:mm:ss')"),
        ColumnRule("derived", "ts", "day", rule="date_format(val, 'yyyy-MM-dd')"),
        ColumnRule("derived", "ts", "kept", rule=zero_date, dtype="DATE"),
        ColumnRule("derived", "ts", "is_later", rule="val >= timestamp_ntz '2024-01-02 00:00:00'"),
        ColumnRule("derived", "ts", "yr", rule="year(val)"),
    ])
    return mapped.withColumn("kept", snowflake_value(F.col("kept"), "DATE"))
