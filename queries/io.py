"""Snapshots, upsert and JDBC reads."""

from __future__ import annotations

import uuid
import zlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.filters import KeyFilter
from evenkeel.operators.upsert import upsert, upsert_into
from evenkeel.sources.files import load_snapshot, read_csv, save_snapshot, write_csv
from evenkeel.sources.jdbc import Partitioning, choose_partitioning, partition_bounds, probe_bounds, read_jdbc
from evenkeel.sources.ranges import balanced_ranges
from evenkeel.sources.workspace import is_local, new_table_path
from queries.registry import query, table


@query("select min(o_orderkey) as lower_bound, max(o_orderkey) as upper_bound from orders", name="partition_bounds")
def bounds_of_orders(spark, sf_dir):
    return partition_bounds(table(spark, sf_dir, "orders"), "o_orderkey")


_AWKWARD = """
select {id} as id, {day} as amount,
       case {id} % 6 when 0 then '' when 1 then null when 2 then '  ' || {text} || ' ' when 4 then '\\N' when 5 then '\\\\N'
       else {text} || chr(10) || '"x", y' end as note from {table}"""


def _awkward(spark, sf_dir):
    """Customers with empty strings, nulls, padding, quotes, commas, line breaks and null markers in a column."""
    rest, name = F.col("c_custkey") % 6, F.col("c_name")
    note = (
        F.when(rest == 0, "")
        .when(rest == 2, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(rest == 3, F.concat(name, F.lit('\n"x", y')))
        .when(rest == 4, "\\N")
        .when(rest == 5, "\\\\N")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), note.alias("note")
    )


@query(_AWKWARD.format(id="c_custkey", day="c_acctbal", text="c_name", table="customer"))
def csv_roundtrip(spark, sf_dir):
    """Written and read back with the stored schema; every value survives."""
    path = new_table_path(spark, "csv")
    write_csv(_awkward(spark, sf_dir), path)
    return read_csv(spark, path)


_PRECISE = """
select event_id, ts + to_microseconds(event_id * 7 % 1000000) as ts, value / 3 as third, cast(value / 3 as real) as short,
       case when event_id % 5 <> 0 then user_id end as user_id, event_type || chr(92) || 'n' || chr(10) || chr(92) as note
from events"""


def _precise(spark, sf_dir):
    """Events with times to the microsecond, long fractions, and text with backslashes and line breaks."""
    micros = F.col("event_id") * 7 % 1_000_000
    return table(spark, sf_dir, "events").select(
        "event_id", F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("ts"), (F.col("value") / 3).alias("third"),
        (F.col("value") / 3).cast("float").alias("short"), F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id"),
        F.concat("event_type", F.lit("\\n\n\\")).alias("note"),
    )


@query(f"""
select *, cast(event_id * 1000 as integer) - 1000000 as far_day, upper(hex(note)) as bytes,
       [third, null, value_of] as several
from (select *, cast(event_id as double) / 7 as value_of from ({_PRECISE}))""")
def csv_roundtrip_precise(spark, sf_dir):
    """Microseconds, floats, days beyond year 9999, bytes and arrays, all through CSV.

    A date is a day of 32 bits: where the SQL has no such day, which it calls an error, the days begin again at the first.
    """
    path = new_table_path(spark, "csv")
    days = F.col("event_id").cast("decimal(38,0)") * 1000 - 1_000_000
    day = (F.pmod(days + 2**31, F.lit(2**32)) - 2**31).cast("int")
    events = _precise(spark, sf_dir).withColumn("value_of", F.col("event_id").cast("double") / 7)
    write_csv(events.withColumns({
        "far_day": F.date_from_unix_date(day), "bytes": F.col("note").cast("binary"),
        "several": F.array("third", F.lit(None), "value_of"),
    }), path)
    return read_csv(spark, path).withColumns({"far_day": F.unix_date("far_day"), "bytes": F.hex("bytes")})


@query("""
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
       cast(cast(c_acctbal as decimal(12,2)) as varchar) as c_acctbal, c_mktsegment from customer""")
def csv_as_text(spark, sf_dir):
    """Every column read as a string."""
    path = new_table_path(spark, "csv")
    write_csv(table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)")), path)
    return read_csv(spark, path, as_text=True)


@query("select * from orders")
def csv_inferred(spark, sf_dir):
    """A CSV without a stored schema: the types are inferred."""
    path = new_table_path(spark, "csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    inferred = read_csv(spark, path)
    return inferred.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("select * from lineitem")
def parquet_roundtrip(spark, sf_dir):
    path = new_table_path(spark, "snapshot")
    save_snapshot(table(spark, sf_dir, "lineitem"), path)
    return load_snapshot(spark, path)


_CHANGES = """
  select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice * 2 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderpriority = '1-URGENT'
  union all
  select -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderpriority = '5-LOW'"""


@query(f"""
with c as ({_CHANGES})
select * from orders where o_orderkey not in (select o_orderkey from c) union all select * from c""")
def upsert_merge(spark, sf_dir):
    """Changed rows replaced, new rows added."""
    orders = table(spark, sf_dir, "orders")
    updates = orders.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    inserts = orders.filter("o_orderpriority = '5-LOW'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return upsert(orders, updates.unionByName(inserts), "o_orderkey")


@query("""
with c as (select l_orderkey as k, max(l_shipdate) as day from lineitem group by 1)
select o_orderkey, o_custkey, case when k is not null then 'S' else o_orderstatus end as o_orderstatus, o_totalprice,
       case when k is not null then day else o_orderdate end as o_orderdate, o_orderpriority
from orders left join c on o_orderkey = k""")
def upsert_latest(spark, sf_dir):
    """Several changes of one order: the latest counts."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").distinct()
    changes = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey", "o_custkey", F.lit("S").alias("o_orderstatus"), "o_totalprice",
        F.col("l_shipdate").alias("o_orderdate"), "o_orderpriority",
    )
    return upsert(orders, changes, "o_orderkey", latest_by="o_orderdate")


@query("""
with c as (
  select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice, o_orderdate + interval 40 day as o_orderdate, o_orderpriority
  from orders where o_orderkey % 50 = 0 and month(o_orderdate) in (2, 7)
  union all
  select -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderkey % 70 = 0 and month(o_orderdate) = 7
)
select *, strftime(o_orderdate, '%Y-%m') as month from (
  select * from orders where o_orderkey not in (select o_orderkey from c) union all select * from c)""")
def upsert_partitions(spark, sf_dir):
    """Orders by month, changed in place: some move to another month, others are new; months without them keep their files."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    path = new_table_path(spark, "orders_by_month")
    orders.write.partitionBy("month").parquet(path)
    moved = orders.filter("o_orderkey % 50 = 0 and month(o_orderdate) in (2, 7)").withColumns(
        {"o_orderstatus": F.lit("X"), "o_orderdate": F.col("o_orderdate") + F.expr("interval 40 days")}
    )
    added = orders.filter("o_orderkey % 70 = 0 and month(o_orderdate) = 7").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    changes = moved.unionByName(added).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    upsert_into(path, changes, "o_orderkey", "month")
    return spark.read.schema(orders.schema).parquet(path)


@query("""
with c as (select o_orderkey as k, max(case when l_quantity > 25 then l_shipdate end) as day from lineitem join orders on l_orderkey = o_orderkey group by 1)
select o_orderkey, o_custkey, case when k is not null then 'S' else o_orderstatus end as o_orderstatus, o_totalprice,
       case when k is not null then day else o_orderdate end as o_orderdate, o_orderpriority
from orders left join c on o_orderkey = k""")
def upsert_latest_with_nulls(spark, sf_dir):
    """Changes some of which have no time: they count only where no other does, and none is lost."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "case when l_quantity > 25 then l_shipdate end as day")
    changes = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey", "o_custkey", F.lit("S").alias("o_orderstatus"), "o_totalprice", F.col("day").alias("o_orderdate"), "o_orderpriority"
    )
    return upsert(orders, changes, "o_orderkey", latest_by="o_orderdate")


@query("select o_orderkey * o_orderkey * o_orderkey as skewed, o_totalprice from orders")
def split_by_ranges(spark, sf_dir):
    """Orders under a key that is dense at one end, put together again from the ranges a split read would ask for.

    The cube is a decimal where the SQL's 64 bits, which it calls an error to pass, do not hold those of all orders.
    """
    key = F.col("o_orderkey").cast("decimal(38,0)")
    orders = table(spark, sf_dir, "orders").select((key * key * key).alias("skewed"), "o_totalprice")
    low, high = (int(n or 0) for n in orders.agg(F.min("skewed"), F.max("skewed")).first())
    if -(2**63) <= low and high < 2**63:
        orders = orders.withColumn("skewed", F.col("skewed").cast("bigint"))
    view = f"skewed_{uuid.uuid4().hex}"
    orders.createOrReplaceTempView(view)
    ranges = balanced_ranges(lambda sql: [tuple(r) for r in spark.sql(sql).collect()], f"select * from {view}", "skewed", low, high, 8)
    parts = [orders.filter(p) for p in ranges.predicates()]
    return reduce(DataFrame.unionByName, parts)


# --- JDBC ------------------------------------------------------------------------------------------

JDBC_URL = "spark.evenkeel.jdbc.url"
ORDERS_TABLE = "EK_ORDERS"
_COPIES: set[tuple[str, str, str]] = set()


def jdbc_orders(spark, sf_dir) -> dict[str, str]:
    """JDBC options of a database that holds the orders.

    The database named in the session is used if there is one.  Otherwise it is
    an in-memory one inside this process, which only a local session can read.
    The orders are copied into it once per application.
    """
    options = {"url": spark.conf.get(JDBC_URL, "")}
    if not options["url"]:
        if not is_local(spark):
            raise ValueError(f"set {JDBC_URL}: executors cannot see a database inside the driver")
        name = f"orders{zlib.crc32(sf_dir.encode()):08x}"
        options = {
            "url": f"jdbc:derby:memory:{name};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
        }
    copy = (spark.sparkContext.applicationId, options["url"], sf_dir)
    if copy not in _COPIES:
        orders = table(spark, sf_dir, "orders")
        orders.toDF(*[c.upper() for c in orders.columns]).write.format("jdbc").options(**options).option(
            "dbtable", ORDERS_TABLE
        ).option("createTableColumnTypes", "O_ORDERSTATUS VARCHAR(10), O_ORDERPRIORITY VARCHAR(20)").mode("overwrite").save()
        _COPIES.add(copy)
    return options


_JDBC_QUERY = f"SELECT * FROM {ORDERS_TABLE}"


def _lower(df):
    return df.toDF(*[c.lower() for c in df.columns])


@query("select * from orders")
def jdbc_scan(spark, sf_dir):
    """One connection."""
    return _lower(read_jdbc(spark, jdbc_orders(spark, sf_dir), _JDBC_QUERY + ";"))


def _split_read(spark, options, key=None):
    partitioning = choose_partitioning(
        key or KeyFilter(), "O_ORDERKEY", probe=lambda: probe_bounds(spark, options, ORDERS_TABLE, "O_ORDERKEY")
    )
    return _lower(read_jdbc(spark, options, _JDBC_QUERY, partitioning))


@query("select * from orders")
def jdbc_scan_partitioned(spark, sf_dir):
    """Several connections, on bounds the database was asked for."""
    return _split_read(spark, jdbc_orders(spark, sf_dir))


@query("select * from orders where o_orderkey >= 1000 and o_totalprice >= 250000")
def jdbc_filter_pushdown(spark, sf_dir):
    """A half-open key range, split on the bound that the database was asked for; both filters run in the database."""
    key = KeyFilter("pk_range", "o_orderkey", lower=1000)
    return key.apply(_split_read(spark, jdbc_orders(spark, sf_dir), key)).filter("o_totalprice >= 250000")


@query("select * from orders")
def jdbc_scan_narrow_bounds(spark, sf_dir):
    """Bounds inside the key range only set the strides; no row is lost."""
    options = jdbc_orders(spark, sf_dir)
    return _lower(read_jdbc(spark, options, _JDBC_QUERY, Partitioning("O_ORDERKEY", 100, 200, 4)))
