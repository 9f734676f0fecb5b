"""Update rows by key, insert the others: as a frame, or in a partitioned table in place."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canonical import quoted
from evenkeel.operators.quality import repeated_keys
from evenkeel.operators.reconcile import DuplicateKeyError
from evenkeel.sources.workspace import exists, new_table_path, remove, written

# Whoever plans a read of a partitioned table lists its partitions; up to this number their values are put in the plan.
LISTED_PARTITIONS = 10_000


def quoted_column(name: str) -> Column:
    return F.col(quoted(name))


def latest(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The change of each key with the largest ``order``; one without it only counts if there is no other.

    Of changes with the same order the one with the larger values counts, in the order of the columns.
    """
    comparable = [f.name for f in changes.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = F.struct(quoted_column(order).isNotNull(), quoted_column(order), *map(quoted_column, comparable))
    whole = F.max_by(F.struct(*map(quoted_column, changes.columns)), by)
    return changes.groupBy(*map(quoted_column, keys)).agg(whole.alias("_latest")).select("_latest.*")


def _one_for_each_key(target_columns, changes: DataFrame, keys: list[str], check_unique: bool, latest_by: str | None) -> DataFrame:
    if set(map(str.lower, target_columns)) != set(map(str.lower, changes.columns)):
        raise ValueError(f"columns differ: {target_columns} and {changes.columns}")
    if latest_by is not None:
        return latest(changes, keys, latest_by)
    if check_unique and not repeated_keys(changes, keys).isEmpty():
        raise DuplicateKeyError(f"the changes hold several rows for one key of {keys}")
    return changes


def upsert(target: DataFrame, changes: DataFrame, keys, *, check_unique: bool = True, latest_by: str | None = None) -> DataFrame:
    """The target after the changes: its rows whose key is not changed, plus all changes.

    Several changes of one key are an error, which costs a count of the keys of
    ``changes``; or the one with the largest ``latest_by`` counts, nulls last.  Without
    ``check_unique`` the caller vouches for one change for each key.  A null key is never updated.

    The target is only scanned if the changes are small enough to broadcast;
    otherwise both sides shuffle once on the key.  Write the result to a new
    place, since a table cannot be replaced while it is read, or use :func:`upsert_into`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    changes = _one_for_each_key(target.columns, changes, keys, check_unique, latest_by)
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(changes)


# In place -----------------------------------------------------------------------------------------------------------


def _intent_path(path: str) -> str:
    return path.rstrip("/") + "_upsert"


def _same(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(and_, [left[quoted(a)].eqNullSafe(right[quoted(b)]) for a, b in pairs])


def upsert_into(
    path: str, changes: DataFrame, keys, partition_by, *, check_unique: bool = True, latest_by: str | None = None
) -> int:
    """Apply ``changes`` to the partitioned Parquet table at ``path``; gives the number of partitions that were rewritten.

    Only partitions that hold a changed key, or get a row, are read in full and
    written again; a key that moves to another partition leaves its old one.  A
    partition that loses its last row goes.  Files of all others stay as they are.

    The new rows are first written beside the table, in the shared folder, and
    what is to be done is noted at ``path_upsert``.  Only then partitions are
    exchanged.  Until the note is there the table is as it was; if the run ends
    after that, :func:`finish_upsert`, which the next upsert calls first, brings
    it to its end, as often as it is run.  Two upserts of one table must not run at
    the same time.

    ``changes`` has the table's columns and its types.  Without a table, the changes
    make one.  Empty text in a partition column is read back as null, as Spark does.
    """
    spark = changes.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    finish_upsert(spark, path)
    if not exists(spark, path):
        changes = written(_one_for_each_key(changes.columns, changes, keys, check_unique, latest_by), "changes")
        changes.write.partitionBy(*parts).parquet(path)
        return changes.select(*map(quoted_column, parts)).distinct().count()
    table = spark.read.parquet(path)
    changes = written(_one_for_each_key(table.columns, changes, keys, check_unique, latest_by), "changes")
    if changes.isEmpty():
        return 0
    # partition values are read as what they look like; the changes know their types
    table = spark.read.schema(T.StructType([changes.schema[_named(changes, c)] for c in table.columns])).parquet(path)
    wanted = changes.select(*[quoted_column(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    is_changed = reduce(and_, [quoted_column(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    old = table.select(*map(quoted_column, [*keys, *parts]), folder.alias("_folder")).join(wanted, is_changed, "left_semi")
    names = [f"_p{i}" for i in range(len(parts))]
    values = [quoted_column(p).alias(n) for p, n in zip(parts, names, strict=True)]
    held = written(old.select(*values, "_folder").distinct(), "held")
    touched = written(held.select(*names).union(changes.select(*values)).distinct(), "touched")
    number = touched.count()
    after = rows_of_partitions(table, touched, parts, number).join(wanted, is_changed, "left_anti").unionByName(changes)
    staging = new_table_path(spark, "upsert")
    after.write.partitionBy(*parts).parquet(staging)
    left = spark.read.schema(after.schema).parquet(staging).select(*values).distinct()
    emptied = held.join(left, _same(held, left, zip(names, names, strict=True)), "left_anti").select("_folder").distinct()
    intent = {"staging": staging, "partition_by": parts, "emptied": [r[0] for r in emptied.collect()], "schema": after.schema.jsonValue()}
    spark.createDataFrame([(json.dumps(intent),)], "value string").coalesce(1).write.text(_intent_path(path))
    finish_upsert(spark, path)
    return number


def rows_of_partitions(table: DataFrame, touched: DataFrame, parts: list[str], number: int) -> DataFrame:
    """The table's rows in some partitions; the files of others are not opened while the values can be listed."""
    names = touched.columns
    if number <= LISTED_PARTITIONS:
        for p, n in zip(parts, names, strict=True):
            values = [r[0] for r in touched.select(n).distinct().collect()]
            known = quoted_column(p).isin([v for v in values if v is not None])
            table = table.filter(known | quoted_column(p).isNull() if None in values else known)
    if len(parts) == 1 and number <= LISTED_PARTITIONS:
        return table
    return table.join(touched, _same(table, touched, zip(parts, names, strict=True)), "left_semi")


def _named(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.lower() == name.lower())


def finish_upsert(spark: SparkSession, path: str) -> bool:
    """Bring a noted upsert of the table to its end; says whether there was one."""
    note = _intent_path(path)
    if not exists(spark, note + "/_SUCCESS"):
        remove(spark, note)  # what was begun and not noted in full
        return False
    intent = json.loads(spark.read.option("wholetext", True).text(note).first().value)
    schema = T.StructType.fromJson(intent["schema"])
    rows = spark.read.schema(schema).parquet(intent["staging"])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*intent["partition_by"]).parquet(path)
    for folder in intent["emptied"]:
        remove(spark, folder)
    remove(spark, note)
    remove(spark, intent["staging"])
    return True
