"""Joins whose hot keys are spread when the plan is made, for where Spark does not do it at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canonical import quoted

# A key with more rows than this part of an even task's share is hot; so there are never more hot keys than tasks divided by it.
HOT_PART = 0.5


def splits_hot_keys(spark: SparkSession) -> bool:
    """Whether adaptive execution may split a hot key of a join."""
    return all(spark.conf.get(f"spark.sql.adaptive.{name}", "true").lower() == "true" for name in ("enabled", "skewJoin.enabled"))


def hot_keys(df: DataFrame, key: Column, tasks: int) -> DataFrame:
    """(key, copies): keys with so many rows that they are to go to several tasks, and to how many.

    Keys are counted in the tasks first.  The result has at most ``tasks / HOT_PART`` rows.  A null key can be hot too.
    """
    counted = df.groupBy(key.alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    rows = df.count()
    share = max(rows * HOT_PART / tasks, 1.0)
    found = counted.filter((F.col("_rows") > share) & (F.col("_rows") > tasks))
    return found.select("_hot", F.least(F.ceil(F.col("_rows") / share), F.lit(tasks)).cast("int").alias("_copies"))


def spread_join(df: DataFrame, other: DataFrame, left_key: str, right_key: str, how: str = "left", *, tasks: int | None = None) -> DataFrame:
    """``df`` joined with ``other`` on one column of each, where a key of ``df`` may hold any part of its rows.

    Rows with a hot key are dealt to several tasks by what they hold and where
    they were read, so that a task that is run again deals them alike; the rows
    of ``other`` with that key are there in as many copies.  ``df`` is read once
    more, its key column only.  ``how`` is left or inner.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a spread join is 'left' or 'inner', not {how!r}")
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(df, F.col(quoted(left_key)), tasks))
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *(F.col(quoted(c)) for c in _hashable(df))), F.col("_copies"))
    left = df.join(hot, F.col(quoted(left_key)).eqNullSafe(F.col("_hot")), "left")
    left = left.withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hot", "_copies")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_copies"), F.lit(1)).cast("bigint") - 1)
    right = other.join(hot, F.col(quoted(right_key)) == F.col("_hot"), "left")
    right = right.select(*(F.col(quoted(c)) for c in other.columns), F.explode(copies).alias("_copy"))
    on = (left[quoted(left_key)] == right[quoted(right_key)]) & (F.col("_salt") == F.col("_copy"))
    return left.join(right, on, how).drop("_salt", "_copy")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
