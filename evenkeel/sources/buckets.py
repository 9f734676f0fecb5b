"""Snapshots whose rows lie together by key, so that a comparison need not move them again.

Spark knows the buckets of a table in its catalog only, so a snapshot is
registered there, under a name made from its path, whenever it is loaded.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.sources.workspace import exists, remove, written

# A bucket is one task's, so a table is only put in buckets if none holds more than so many times the mean, beyond so many rows.
MOST_UNEVEN = 2
EVEN_ENOUGH = 10_000


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def note_path(path: str) -> str:
    return path.rstrip("/") + "_buckets"


def table_name(path: str) -> str:
    return "evenkeel_buckets_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def is_even(df: DataFrame, keys: list[str], number: int) -> bool:
    """Whether no bucket would be far larger than the others; counted in the tasks first, so a hot key is no harm here."""
    counted = df.groupBy(F.pmod(F.hash(*map(F.col, map(_quoted, keys))), F.lit(number))).count()
    largest, rows = counted.agg(F.max("count"), F.sum("count")).first()
    return not rows or largest <= max(EVEN_ENOUGH, MOST_UNEVEN * rows / number)


def save(df: DataFrame, path: str, keys: list[str], number: int | None = None) -> bool:
    """Save in buckets sorted by key, if they are even; else as plain Parquet.  Says which it was.

    The rows are computed once, into the shared folder.  As many buckets as
    shuffle partitions by default: so other tables can join without the
    buckets being moved.
    """
    spark = df.sparkSession
    number = number or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_name = {c.lower(): c for c in df.columns}
    keys = [by_name[k.lower()] for k in keys]
    staged = written(df, "staged")
    remove(spark, note_path(path))
    spark.sql(f"drop table if exists {table_name(path)}")
    even = is_even(staged, keys, number)
    if even:
        columns = list(map(_quoted, keys))
        dealt = staged.repartition(number, *map(F.col, columns))
        writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
        writer.bucketBy(number, *keys).sortBy(*keys).saveAsTable(table_name(path))
        note = json.dumps({"schema": df.schema.jsonValue(), "keys": keys, "buckets": number})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(note_path(path))
    else:
        staged.write.mode("overwrite").parquet(path)
    remove(spark, staged.inputFiles()[0].rpartition("/")[0]) if staged.inputFiles() else None
    return even


def load(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot with its buckets; None if it has none."""
    if not exists(spark, note_path(path)):
        return None
    note = json.loads(spark.read.option("wholetext", True).text(note_path(path)).first().value)
    schema = T.StructType.fromJson(note["schema"])
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    keys, name = ", ".join(map(_quoted, note["keys"])), table_name(path)
    spark.sql(f"drop table if exists {name}")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) into {note['buckets']} buckets location '{location}'"
    )
    return spark.table(name)


def in_buckets(df: DataFrame) -> bool:
    """Whether a table that ``df`` reads is in buckets."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.bucketSpec().isDefined():
                return True
    return False


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)
