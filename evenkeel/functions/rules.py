"""Column expressions of mapping rules: constants, expressions, fills, coercions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands for the batch id that the loading job would set.
BATCH_ID = "ETL_VALIDATION"

_TYPE = re.compile(r"\s*(\w+)\s*(?:\(([^)]*)\))?\s*$")


def type_parts(declared: str) -> tuple[str, str]:
    """Base name in lower case and the size of a declared type."""
    found = _TYPE.match(declared or "")
    return (found[1].lower(), (found[2] or "").replace(" ", "")) if found else ((declared or "").strip().lower(), "")


_QUOTED = re.compile(r"('(?:[^'\\]|\\.|'')*')")
_VAL = re.compile(r"\bval\b")


# Whole rules that are not SQL. The database assigns the value of the first kind.
_ASSIGNED = re.compile(r"(IDENTITY|AUTO_INCREMENT)(\s*\(\s*\d+\s*,\s*\d+\s*\))?", re.IGNORECASE)
_NOTHING = re.compile(r"NULL|NONE", re.IGNORECASE)
_BATCH = re.compile(r"SYS_BATCH_ID", re.IGNORECASE)
# As SQL a number with a point is a decimal; a mapping means a double.
_DOUBLE = re.compile(r"[+-]?(\d+\.\d*|\.\d+|\d+(\.\d*)?[eE][+-]?\d+)")


def constant(rule, batch_id: str = BATCH_ID) -> Column:
    """A constant: a value, a keyword that is the whole rule, or any Spark SQL expression, quoted text among them."""
    if callable(rule):
        return rule(None)
    if not isinstance(rule, str):
        return F.lit(rule)
    whole = rule.strip()
    if _ASSIGNED.fullmatch(whole):
        return F.lit(None).cast("int")
    if _NOTHING.fullmatch(whole):
        return F.lit(None).cast("string")
    if _BATCH.fullmatch(whole):
        return F.lit(batch_id)
    return F.lit(float(whole)) if _DOUBLE.fullmatch(whole) else F.expr(whole)


def expression(rule, source: str | None) -> Column:
    """A rule over the source row; ``val`` outside quotes means the source column."""
    if callable(rule):
        return rule(F.col(source) if source else None)
    if not rule:
        return F.col(source) if source else F.lit(None).cast("string")
    if source:
        name = ".".join(f"`{part}`" for part in source.split("."))
        pieces = _QUOTED.split(rule)
        rule = "".join(p if i % 2 else _VAL.sub(lambda _: name, p) for i, p in enumerate(pieces))
    return F.expr(rule)


def fill(value: Column, dtype: T.DataType, default) -> Column:
    """Null replaced by a default in the type of the column."""
    return F.coalesce(value, F.lit(default).cast(dtype))


def fill_text(df: DataFrame, columns) -> DataFrame:
    """Null strings replaced by empty ones."""
    return df.fillna("", subset=list(columns))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value of a column, the smallest one on a tie, as one row.

    Counted per value with partial aggregation, then a top-1: no task ever
    holds the set of all values, as the built-in mode aggregate does.
    """
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), F.asc(column))
        .limit(1)
        .select(column)
    )


def most_frequent_values(df: DataFrame, columns) -> DataFrame:
    """The most frequent value of each column, the smallest one on a tie, as one row; one scan for all of them.

    Values of all columns are counted together, each with its column's number,
    and the best of a column is an aggregate with a partial step.
    """
    values = F.array(*(
        F.struct(F.lit(i).alias("i"), *(
            (F.col(c) if i == j else F.lit(None).cast(df.schema[c].dataType)).alias(f"v{j}") for j, c in enumerate(columns)
        ))
        for i in range(len(columns)) for c in [columns[i]]
    ))
    names = [f"v{j}" for j in range(len(columns))]
    counted = df.select(F.inline(values)).groupBy("i", *names).agg(F.count(F.lit(1)).alias("n"))

    def best(j: int, c: str) -> Column:
        own = (F.col("i") == j) & F.col(f"v{j}").isNotNull()
        return F.min(F.when(own, F.struct(-F.col("n"), F.col(f"v{j}").alias("v"))))["v"].alias(c)

    return counted.agg(*(best(j, c) for j, c in enumerate(columns)))


def fill_mode(df: DataFrame, columns) -> DataFrame:
    """Nulls replaced by the most frequent value of their column: one scan to find those, one to fill."""
    columns = list(columns)
    if not columns:
        return df
    modes = most_frequent_values(df, columns).toDF(*(f"_mode{i}" for i in range(len(columns))))
    filled = df.join(F.broadcast(modes))  # one row
    return filled.select(*(
        F.coalesce(F.col(c), F.col(f"_mode{columns.index(c)}")).alias(c) if c in columns else F.col(c) for c in df.columns
    ))


# How a value is coerced, by the base name of the declared type; other types take it as it is.
_DATE_PARTS = "0000-00-00"
_COERCIONS: dict[str, Callable[[Column], Column]] = {
    "bool": lambda value: value.cast("boolean"),
    "char": F.rtrim,
    "date": lambda value: F.when(~_is_zero_date(value), value),
    "datetime": lambda value: F.when(~_is_zero_date(value), value.try_cast("timestamp_ntz")),
    "time": lambda value: F.date_format(value, "HH:mm:ss"),
    "year": lambda value: value.try_cast("int"),
    "decimal": lambda value: value.try_cast("double"),
}
_SAME_AS = {"boolean": "bool", "timestamp": "datetime", "numeric": "decimal"}


def _is_zero_date(value: Column) -> Column:
    return value.cast("string").startswith(_DATE_PARTS)


def snowflake_value(value: Column, declared: str) -> Column:
    """A MySQL value as Snowflake takes it, by the declared target type."""
    base, size = type_parts(declared)
    if (base, size) == ("tinyint", "1"):
        base = "bool"  # how MySQL writes a flag
    coerce = _COERCIONS.get(_SAME_AS.get(base, base))
    return coerce(value) if coerce else value
