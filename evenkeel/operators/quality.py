"""Checks of one table: schema, required values, key uniqueness, join fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names that databases report for the same type.
TYPE_GROUPS = {
    "INT": ("INT", "INT(11)", "INTEGER", "INT(10)", "INT(4)"),
    "BIGINT": ("BIGINT", "BIGINT(20)"),
    "TINYINT(1)": ("TINYINT(1)", "BOOLEAN", "BOOL"),
    "SMALLINT": ("SMALLINT", "SMALLINT(6)"),
    "DATE": ("DATE",),
    "DATETIME": ("DATETIME", "TIMESTAMP", "TIMESTAMP_NTZ", "TIMESTAMP_LTZ", "TIMESTAMP_TZ"),
    "TEXT": ("TEXT", "LONGTEXT", "MEDIUMTEXT"),
}


class SchemaMismatchError(ValueError):
    """The live schema is not the declared one."""


class NullViolationError(ValueError):
    """A required column holds nulls."""


class UniqueViolationError(ValueError):
    """A unique column holds a value twice."""


def _type_group(data_type: Column) -> Column:
    """One name for all spellings of a type; NUMBER(p) means NUMBER(p,0)."""
    name = F.upper(F.trim(data_type))
    name = F.regexp_replace(name, r"^NUMBER\((\d+)\)$", "NUMBER($1,0)")
    names = [F.lit(x) for group, members in TYPE_GROUPS.items() for m in members for x in (m, group)]
    return F.coalesce(F.create_map(*names)[name], name)


def schema_diff(declared: DataFrame, live: DataFrame) -> DataFrame:
    """Declared against live catalog, both frames of ``(column_name, data_type)``.

    One row per column with a status of OK, MISSING_IN_LIVE, TYPE_MISMATCH or
    EXTRA_IN_LIVE.  Names match without regard to case.
    """
    left = declared.select(F.upper("column_name").alias("column_name"), F.col("data_type").alias("declared_type"))
    right = live.select(F.upper("column_name").alias("column_name"), F.col("data_type").alias("live_type"))
    status = (
        F.when(F.col("live_type").isNull(), "MISSING_IN_LIVE")
        .when(F.col("declared_type").isNull(), "EXTRA_IN_LIVE")
        .when(_type_group(F.col("declared_type")) != _type_group(F.col("live_type")), "TYPE_MISMATCH")
        .otherwise("OK")
    )
    return left.join(right, "column_name", "full").withColumn("status", status)


def require_schema(declared: DataFrame, live: DataFrame) -> None:
    """Raise unless the schemas agree; an extra live column fails too."""
    wrong = schema_diff(declared, live).filter("status <> 'OK'").orderBy("column_name").collect()
    if wrong:
        raise SchemaMismatchError("; ".join(
            f"{r.column_name}: {r.status} (declared {r.declared_type}, live {r.live_type})" for r in wrong
        ))


def null_counts(df: DataFrame, columns) -> DataFrame:
    """Nulls per column and rows in total, in one pass over only those columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    per_column = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_rows"))
        for i, c in enumerate(columns)
    ])
    return counts.select("total_rows", F.inline(per_column)).select("column_name", "null_rows", "total_rows")


def require_not_null(df: DataFrame, columns) -> None:
    if not columns:
        return
    bad = null_counts(df, columns).filter("null_rows > 0").collect()
    if bad:
        raise NullViolationError("nulls in required columns: " + ", ".join(
            f"{r.column_name} ({r.null_rows} of {r.total_rows} rows)" for r in bad
        ))


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).filter("key_rows > 1")


def key_uniqueness(df: DataFrame, keys) -> DataFrame:
    """One row: rows, distinct keys, repeated keys and the verdict."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
        .agg(
            F.coalesce(F.sum("key_rows"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("key_rows") > 1).alias("repeated_keys"),
        )
        .withColumn("is_unique", F.col("repeated_keys") == 0)
    )


def unique_columns(df: DataFrame, columns) -> DataFrame:
    """Uniqueness of each column on its own; nulls are not counted, as in a UNIQUE constraint.

    One scan.  A value goes to the shuffle as the number of its column and 128
    bits of hash, whatever its width, and equal ones are counted in each task
    first; two values of a column would have to agree in all of these bits to
    be taken for one.
    """
    numbered = F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(
            F.lit(i).alias("i"), F.xxhash64(F.lit(0), c).alias("h"), F.xxhash64(F.lit(1), c).alias("g")
        ))
        for i, c in enumerate(columns)
    ])
    values = df.select(F.inline(F.filter(numbered, lambda v: v.isNotNull()))).groupBy("i", "h", "g").agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("i").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(columns)], "i int, column_name string")
    total, distinct = F.coalesce("t", F.lit(0)), F.coalesce("d", F.lit(0))
    return names.join(counts, "i", "left").select(
        "column_name", total.alias("total_rows"), distinct.alias("distinct_values"), (total == distinct).alias("is_unique")
    )


def require_unique(df: DataFrame, columns) -> None:
    """Raise if one of the columns holds a value twice."""
    bad = unique_columns(df, list(columns)).filter("not is_unique").orderBy("column_name").collect()
    if bad:
        raise UniqueViolationError("repeated values in unique columns: " + ", ".join(
            f"{r.column_name} ({r.total_rows - r.distinct_values} too many)" for r in bad
        ))


def join_fanout(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows before and after a left join, worked out without running the join.

    Both sides are counted per key first, so a hot key is one row on each side
    and the rows of the join are never made.
    """
    lefts = left.groupBy(F.col(left_key).alias("_key")).agg(F.count(F.lit(1)).alias("_left"))
    rights = right.groupBy(F.col(right_key).alias("_key")).agg(F.count(F.lit(1)).alias("_right"))
    produced = F.col("_left") * F.greatest(F.coalesce("_right", F.lit(0)), F.lit(1))
    return (
        lefts.join(rights, "_key", "left")
        .agg(
            F.coalesce(F.sum("_left"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum(produced), F.lit(0)).alias("rows_after"),
            F.coalesce(F.sum(F.when(F.col("_right").isNull(), F.col("_left"))), F.lit(0)).alias("unmatched_rows"),
        )
        .withColumn("fans_out", F.col("rows_after") > F.col("rows_before"))
    )


def row_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Row counts of two tables in one row; nothing but the counts is shuffled."""
    sides = expected.select(F.lit(1).alias("_e"), F.lit(0).alias("_a")).unionAll(
        actual.select(F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    )
    return sides.agg(
        F.count_if(F.col("_e") == 1).alias("expected_rows"), F.count_if(F.col("_a") == 1).alias("actual_rows")
    ).withColumn("is_equal", F.col("expected_rows") == F.col("actual_rows"))


def audit_columns(df: DataFrame, required=("load_ts", "batch_id")) -> DataFrame:
    """Whether each audit column exists and how many rows leave it empty."""
    names = {c.lower(): c for c in df.columns}
    probes = df.select(*[
        (F.col(names[r.lower()]) if r.lower() in names else F.lit(None).cast("string")).alias(r) for r in required
    ])
    present = F.col("column_name").isin([r for r in required if r.lower() in names])
    return null_counts(probes, required).select(
        "column_name", present.alias("is_present"), "null_rows", "total_rows",
        (present & (F.col("null_rows") == 0)).alias("is_complete"),
    )
