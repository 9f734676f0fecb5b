"""Schema and data checks, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.filters import DateFilter, KeyFilter, LoadFilter
from evenkeel.operators.quality import (
    audit_columns,
    join_fanout,
    key_uniqueness,
    null_counts,
    repeated_keys,
    row_counts,
    schema_diff,
    unique_columns,
)
from evenkeel.plans.mapping import enrich
from evenkeel.plans.spec import JoinDef
from evenkeel.sources.catalog import declared_catalog, schema_catalog
from queries.registry import loaded_orders, query, table

# --- filters -------------------------------------------------------------------------------------


def _keys(spark, sf_dir, lower=None, upper=None):
    """Orders in a key range given as quarters of the largest key, so that it grows with the table."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    quarter = {None: None, 1: top // 4, 3: top // 4 * 3}
    return KeyFilter("pk_range", "O_ORDERKEY", lower=quarter[lower], upper=quarter[upper]).apply(orders)


_TOP = "(select max(o_orderkey) // 4 from orders)"


@query(f"select * from orders where o_orderkey between {_TOP} and {_TOP} * 3")
def filter_pk_range(spark, sf_dir):
    return _keys(spark, sf_dir, 1, 3)


@query(f"select * from orders where o_orderkey >= {_TOP}")
def filter_pk_lower(spark, sf_dir):
    return _keys(spark, sf_dir, lower=1)


@query(f"select * from orders where o_orderkey <= {_TOP} * 3")
def filter_pk_upper(spark, sf_dir):
    return _keys(spark, sf_dir, upper=3)


@query("select * from customer where c_nationkey in (2, 3, 5, 7, 11, 13)")
def filter_pk_set(spark, sf_dir):
    """A handful of key values as literals."""
    return KeyFilter("pk_set", "c_nationkey", values=(2, 3, 5, 7, 11, 13)).apply(table(spark, sf_dir, "customer"))


@query("select * from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')")
def filter_pk_set_table(spark, sf_dir):
    """Any number of key values from a table."""
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    return KeyFilter("pk_set", "o_orderkey", values=returned).apply(table(spark, sf_dir, "orders"))


@query("""select * from orders where o_orderdate >= timestamp '1996-03-01 00:00:00'
          and o_orderdate <= timestamp '1999-06-30 00:00:00'""")
def filter_date_range(spark, sf_dir):
    dates = DateFilter("range", "1996-03-01", "o_orderdate", "1999-06-30", "o_orderdate")
    return dates.apply(table(spark, sf_dir, "orders"))


@query("select * from events where ts < timestamp '2024-01-16 00:00:00'")
def filter_date_whole_day(spark, sf_dir):
    """An upper date that means the whole of that day."""
    dates = DateFilter("range", to_value="2024-01-15", to_column="ts", whole_day=True)
    return dates.apply(table(spark, sf_dir, "events"))


@query(f"select * from orders where o_orderkey >= {_TOP} and o_orderdate >= timestamp '1997-01-01 00:00:00'")
def filter_pk_and_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    low = orders.agg(F.max("o_orderkey")).first()[0] // 4
    dates = DateFilter("range", "1997-01-01 00:00:00", "o_orderdate")
    return LoadFilter(KeyFilter("pk_range", "o_orderkey", lower=low), dates).apply(orders)


# --- schema ----------------------------------------------------------------------------------------

DECLARED_ORDERS = {
    "o_orderkey": "BIGINT(20)",
    "o_custkey": "INT",
    "o_orderstatus": "string",
    "o_totalprice": "DOUBLE",
    "o_orderdate": "timestamp_ntz",
    "o_comment": "TEXT",
}


@query("""
with declared(column_name, declared_type) as (values
       ('O_ORDERKEY', 'BIGINT(20)'), ('O_CUSTKEY', 'INT'), ('O_ORDERSTATUS', 'TEXT'), ('O_TOTALPRICE', 'DOUBLE'),
       ('O_ORDERDATE', 'DATETIME'), ('O_COMMENT', 'TEXT')),
     live(column_name, live_type) as (values
       ('O_ORDERKEY', 'BIGINT'), ('O_CUSTKEY', 'BIGINT'), ('O_ORDERSTATUS', 'TEXT'), ('O_TOTALPRICE', 'DOUBLE'),
       ('O_ORDERDATE', 'DATETIME'), ('O_ORDERPRIORITY', 'TEXT')),
     filled(column_name, null_rows, total_rows) as (
       select 'O_ORDERKEY', count(*) filter (where o_orderkey is null), count(*) from orders
       union all select 'O_CUSTKEY', count(*) filter (where o_custkey is null), count(*) from orders
       union all select 'O_ORDERSTATUS', count(*) filter (where o_orderkey % 83 = 0), count(*) from orders
       union all select 'O_TOTALPRICE', count(*) filter (where o_totalprice is null), count(*) from orders
       union all select 'O_ORDERDATE', count(*) filter (where o_orderdate is null), count(*) from orders
       union all select 'O_ORDERPRIORITY', count(*) filter (where o_orderpriority is null), count(*) from orders)
select column_name, declared_type, live_type,
       case when live_type is null then 'MISSING_IN_LIVE' when declared_type is null then 'EXTRA_IN_LIVE'
            when column_name = 'O_CUSTKEY' then 'TYPE_MISMATCH' else 'OK' end as status, null_rows, total_rows
from declared full join live using (column_name) left join filled using (column_name)""", name="schema_diff")
def check_schema(spark, sf_dir):
    """Declared against live columns, with the nulls each live column really holds."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 83 != 0, F.col("o_orderstatus")))
    difference = schema_diff(declared_catalog(spark, DECLARED_ORDERS), schema_catalog(spark, orders.schema))
    filled = null_counts(orders, orders.columns).withColumn("column_name", F.upper("column_name"))
    return difference.join(filled, "column_name", "left")


# --- data ------------------------------------------------------------------------------------------

@query("""
with o as (select o_orderkey, case when o_orderkey % 83 <> 0 then o_orderstatus end as o_orderstatus,
                  nullif(o_orderpriority, '5-LOW') as o_orderpriority from orders)
select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as null_rows, count(*) as total_rows from o
union all select 'o_orderstatus', count(*) filter (where o_orderstatus is null), count(*) from o
union all select 'o_orderpriority', count(*) filter (where o_orderpriority is null), count(*) from o""")
def not_null_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns({
        "o_orderstatus": F.when(F.col("o_orderkey") % 83 != 0, F.col("o_orderstatus")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
    })
    return null_counts(orders, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("""
select *, expected_rows = actual_rows as is_equal
from (select count(*) as expected_rows,
             count(*) filter (where o_orderkey % 97 <> 0) + count(*) filter (where o_orderkey % 101 = 0) as actual_rows
      from orders)""")
def check_row_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return row_counts(orders, loaded_orders(orders))


@query("""
with joined as (select o_orderkey, l_orderkey from orders left join lineitem on o_orderkey = l_orderkey)
select *, rows_after > rows_before as fans_out
from (select (select count(*) from orders) as rows_before, count(*) as rows_after,
             count(*) filter (where l_orderkey is null) as unmatched_rows from joined)""")
def check_join_fanout(spark, sf_dir):
    """Orders to line items: one row per line item comes back."""
    return join_fanout(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query("""
select count(*) as expected_rows, count(*) as actual_rows, true as is_equal
from lineitem left join part on l_partkey = p_partkey""")
def check_join_row_counts(spark, sf_dir):
    """Rows before and after an enrichment join that must keep them."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return row_counts(lineitem, enrich(lineitem, JoinDef("p", "part", "l_partkey", "p_partkey", ("p_name",)), part))


@query("""
with k as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all)
select cast(sum(n) as bigint) as total_rows, count(*) as distinct_keys,
       count(*) filter (where n > 1) as repeated_keys, count(*) filter (where n > 1) = 0 as is_unique from k""")
def check_key_unique(spark, sf_dir):
    return key_uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
select l_orderkey, l_linenumber, count(*) as key_rows from lineitem group by all having count(*) > 1""")
def check_repeated_keys(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
select 'c_custkey' as column_name, count(c_custkey) as total_rows, count(distinct c_custkey) as distinct_values,
       count(c_custkey) = count(distinct c_custkey) as is_unique from customer
union all
select 'c_name', count(c_name), count(distinct c_name), count(c_name) = count(distinct c_name) from customer
union all
select 'c_nationkey', count(c_nationkey), count(distinct c_nationkey), count(c_nationkey) = count(distinct c_nationkey)
from customer""")
def check_unique_columns(spark, sf_dir):
    return unique_columns(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_nationkey"])


@query("""
select 'load_ts' as column_name, true as is_present, count(*) filter (where o_orderstatus = 'P') as null_rows,
       count(*) as total_rows, false as is_complete from orders
union all select 'batch_id', false, count(*), count(*), false from orders""")
def check_audit_columns(spark, sf_dir):
    """One audit column that some rows leave empty and one that is absent."""
    orders = table(spark, sf_dir, "orders")
    stamped = orders.withColumn("LOAD_TS", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return audit_columns(stamped)
