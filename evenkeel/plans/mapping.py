"""Run a mapping spec: enrichment joins, then one projection to the target shape."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.rules import BATCH_ID, constant, expression, fill, snowflake_value
from evenkeel.operators.joins import splits_hot_keys, spread_join
from evenkeel.plans.spec import ColumnRule, JoinDef, SpecError, TableSpec
from evenkeel.sources.workspace import written

DIALECTS = ("mysql", "snowflake")


def enrich(df: DataFrame, join: JoinDef, other: DataFrame, *, spread: bool | None = None) -> DataFrame:
    """Join one table and add its fetched columns as ``alias_column``.

    The join key is a plain equality, so Spark broadcasts a small table by its
    known size, and splits a hot key of a large one at run time.  Where adaptive
    execution does not do that (or with ``spread``), hot keys are counted first
    and dealt to several tasks.  A right join allows neither for the main table,
    so it is put together from an inner join and the rows of the other table
    that no main row refers to.  It reads the main table twice: give it one
    that is cheap to read, as ``extract`` does.
    """
    key, how = f"_{join.alias}_key", join.how.lower()
    fetched = other.select(
        F.col(join.right_key).alias(key),
        *[F.col(c).alias(f"{join.alias}_{c}") for c in join.fetch],
    )
    inner = "inner" if how == "right" else how
    if inner in ("left", "inner") and (spread if spread is not None else not splits_hot_keys(df.sparkSession)):
        joined = spread_join(df, fetched, join.left_key, key, inner)
    else:
        joined = df.join(fetched, df[join.left_key] == fetched[key], inner)
    if how == "right":
        used = df.select(F.col(join.left_key).alias("_used")).distinct()
        unused = fetched.join(used, fetched[key] == used["_used"], "left_anti")
        joined = joined.unionByName(unused, allowMissingColumns=True)
    return joined.drop(key)


def extract(spec: TableSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The needed source columns with all enrichment joins.

    ``tables`` holds a frame per table name, with the database in front for
    joins that name one.
    """
    df, joined = tables[spec.source_table].select(*spec.needed_columns()), False
    for join in spec.joins:
        if joined and join.how.upper() == "RIGHT":
            df = written(df, "joined")  # it is read twice, and what is upstream shall run once
        df, joined = enrich(df, join, tables[join.full_table]), True
    return df


def _with_aliases(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Give each join a struct column named like its alias, so ``alias.column`` resolves.

    The optimizer takes the structs apart again.
    """
    have = {c.lower() for c in df.columns}
    structs = []
    for j in spec.joins:
        fields = [F.col(f"{j.alias}_{c}").alias(c) for c in j.fetch if f"{j.alias}_{c}".lower() in have]
        if fields and j.alias.lower() not in have:
            structs.append(F.struct(*fields).alias(j.alias))
    return df.select("*", *structs) if structs else df


def _value(rule: ColumnRule, batch_id: str) -> Column:
    if rule.transform == "constant":
        value = constant(rule.rule, batch_id)
    elif rule.transform in ("cast", "derived"):
        value = expression(rule.rule, rule.source)
    else:
        value = expression(None, rule.source)
    return value.try_cast(rule.force_dtype) if rule.force_dtype else value


def apply_mapping(
    df: DataFrame,
    spec: TableSpec,
    *,
    dialect: str = "mysql",
    sequential: bool = False,
    batch_id: str = BATCH_ID,
) -> DataFrame:
    """The target columns in target order.

    All rules read the source row.  ``sequential`` runs them one after the
    other instead, so a later rule sees a column that an earlier one replaced.
    ``dialect="snowflake"`` adds the value coercions of that database.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, got {dialect!r}")
    rules = [r for r in spec.rules if r.transform != "drop"]
    df = _with_aliases(df, spec)
    if sequential:
        for r in rules:
            df = df.withColumn(r.target, _value(r, batch_id))
            if r.nulls in ("fill_zero", "fill_default"):
                df = df.withColumn(r.target, _filled(df, r))
        mapped = df.select(*[r.target for r in rules])
    else:
        mapped = df.select(*[_value(r, batch_id).alias(r.target) for r in rules])
        if any(r.nulls in ("fill_zero", "fill_default") for r in rules):
            mapped = mapped.select(*[_filled(mapped, r).alias(r.target) for r in rules])
    if dialect == "snowflake":
        mapped = mapped.select(
            *[snowflake_value(F.col(r.target), r.effective_dtype).alias(r.target) for r in rules]
        )
    return mapped


def _filled(df: DataFrame, rule: ColumnRule) -> Column:
    default = {"fill_zero": 0, "fill_default": rule.default}.get(rule.nulls)
    value = F.col(rule.target)
    return value if default is None else fill(value, df.schema[rule.target].dataType, default)


def target_extract(spec: TableSpec, target: DataFrame) -> DataFrame:
    """The target columns of the actual table; an absent one is an error."""
    have = {c.lower() for c in target.columns}
    absent = [c for c in spec.target_columns if c.lower() not in have]
    if absent:
        raise SpecError(f"{spec.target_table} has no column(s) {absent}")
    return target.select(*spec.target_columns)


def perform_transform(df: DataFrame, transform: Callable[..., DataFrame] | None = None, **options) -> DataFrame:
    """Apply a caller's DataFrame function; the frame itself when there is none."""
    return df if transform is None else df.transform(transform, **options)
