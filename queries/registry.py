"""Registry and shared inputs of the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its own or another name, with its oracle where SQL can say it."""

    def register(fn):
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLES[name or fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loaded_orders(orders: DataFrame) -> DataFrame:
    """All orders as a faulty load would leave them: rows lost, values changed, rows with new (negative) keys added.

    Padding around the priority is a difference that must not be reported.
    """
    key = F.col("o_orderkey")
    kept = orders.filter(key % 97 != 0).select(
        key,
        "o_custkey",
        F.when(key % 83 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 89 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(key % 79 == 0, F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    added = orders.filter(key % 101 == 0).withColumn("o_orderkey", -1 - key)
    return kept.unionByName(added)


LOADED_ORDERS = """
    select o_orderkey, o_custkey,
           case when o_orderkey % 83 <> 0 then o_orderstatus end as o_orderstatus,
           case when o_orderkey % 89 = 0 then o_totalprice + 1.0 else o_totalprice end as o_totalprice,
           o_orderdate,
           case when o_orderkey % 79 = 0 then ' ' || o_orderpriority || ' ' else o_orderpriority end as o_orderpriority
    from orders where o_orderkey % 97 <> 0
    union all
    select -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderkey % 101 = 0"""


def canonical_orders(relation: str) -> str:
    """Orders with text columns as a comparison sees them; ``k`` is the key."""
    return f"""
    select cast(o_orderkey as varchar) as k,
           cast(o_custkey as varchar) as o_custkey,
           trim(o_orderstatus) as o_orderstatus,
           cast(cast(o_totalprice as decimal(38,6)) as varchar) as o_totalprice,
           cast(o_orderdate as varchar) as o_orderdate,
           trim(o_orderpriority) as o_orderpriority
    from ({relation})"""


ORDER_COLUMNS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def diff_sql(source: str, target: str, columns, missing=True, extra=True, cells=True) -> str:
    """SQL of a diff table between two relations with a text key ``k`` and text columns."""
    parts = []
    if missing:
        parts.append("""
  select k as primary_key_value, '<ENTIRE_ROW>' as column_name, '<PRESENT_IN_SOURCE>' as expected_value,
         '<MISSING_IN_TARGET>' as actual_value, 'MISSING_IN_TARGET' as diff_type
  from s where not exists (select 1 from t where t.k = s.k)""")
    if extra:
        parts.append("""
  select k as primary_key_value, '<ENTIRE_ROW>' as column_name, '<EXTRA_IN_TARGET>' as expected_value,
         '<PRESENT_IN_TARGET>' as actual_value, 'EXTRA_IN_TARGET' as diff_type
  from t where not exists (select 1 from s where s.k = t.k)""")
    if cells:
        parts += [f"""
  select s.k as primary_key_value, '{c}' as column_name, s.{c} as expected_value,
         t.{c} as actual_value, 'VALUE_MISMATCH' as diff_type
  from s join t on s.k = t.k where s.{c} is distinct from t.{c}""" for c in columns]
    return f"with s as ({source}), t as ({target})" + " union all ".join(parts)


ORDERS_DIFF = diff_sql(canonical_orders("select * from orders"), canonical_orders(LOADED_ORDERS), ORDER_COLUMNS)
