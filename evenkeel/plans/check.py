"""The whole check: extract, map, snapshot, compare, report.

Each side is a frame or the path of a snapshot saved by an earlier run, so a
full run, a compare-only run, a run of one side and the reuse of either side
are the same call with other arguments.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from evenkeel.operators.filters import LoadFilter
from evenkeel.functions.rules import BATCH_ID
from evenkeel.operators.quality import (
    NullViolationError, SchemaMismatchError, UniqueViolationError, require_not_null, require_schema, require_unique,
)
from evenkeel.operators.reconcile import AUDIT_COLUMNS, DuplicateKeyError, Reconciliation, reconcile
from evenkeel.operators.report import write_report
from evenkeel.plans.mapping import apply_mapping, extract, perform_transform, target_extract
from evenkeel.plans.spec import SpecError, TableSpec
from evenkeel.sources.catalog import schema_catalog
from evenkeel.sources.files import load_snapshot, save_snapshot
from evenkeel.sources.workspace import written


@dataclass
class Side:
    """One table of the check.

    ``data`` is a frame or a snapshot path.  Both are checked against
    ``declared`` (by the catalog ``live``, else by their own schema), filtered
    and transformed, then saved when ``save_to`` names a place.  A saved side is
    read back from there, so its extract runs once however often the comparison
    scans it.  Nulls in a ``required`` column refuse a side before it counts as
    saved: it is written to the shared folder first, and to its place after that.
    Saved with ``save_keys``, the keys it is compared by, its rows lie by them, and
    neither this comparison nor a later one moves them again.
    """

    data: DataFrame | str
    load_filter: LoadFilter = field(default_factory=LoadFilter)
    transform: Callable[[DataFrame], DataFrame] | None = None
    declared: DataFrame | None = None
    live: DataFrame | None = None
    required: tuple[str, ...] = ()
    save_to: str | None = None
    fmt: str = "parquet"
    save_keys: tuple[str, ...] = ()

    def load(self, spark: SparkSession) -> DataFrame:
        df = load_snapshot(spark, self.data, self.fmt) if isinstance(self.data, str) else self.data
        if self.declared is not None:
            require_schema(self.declared, self.live if self.live is not None else schema_catalog(spark, df.schema))
        df = perform_transform(self.load_filter.apply(df), self.transform)
        if self.required:
            df = written(df, "checked")
            require_not_null(df, list(self.required))
        if not self.save_to:
            return df
        save_snapshot(df, self.save_to, self.fmt, keys=self.save_keys)
        return load_snapshot(spark, self.save_to, self.fmt, schema=df.schema)


def run(
    spark: SparkSession,
    source: Side | None,
    target: Side | None,
    keys=(),
    columns=None,
    *,
    report_path: str | None = None,
    report_format: str = "csv",
    **options,
) -> Reconciliation | None:
    """Load the sides that are given; compare and report when both are.

    ``options`` are those of :func:`reconcile`.
    """
    expected = source.load(spark) if source else None
    actual = target.load(spark) if target else None
    if expected is None or actual is None:
        return None
    result = reconcile(expected, actual, keys, columns, **options)
    if report_path:
        write_report(result, report_path, report_format)
    return result


def expected_table(
    spark: SparkSession,
    spec: TableSpec,
    tables: Mapping[str, DataFrame],
    *,
    source_filter: LoadFilter | None = None,
    dialect: str = "mysql",
    batch_id: str = BATCH_ID,
) -> DataFrame:
    """The table that a mapping spec makes of its source, computed once and written to the shared folder.

    ``tables`` holds the source table and those of the joins.  Columns the spec
    requires must hold no null there, and source columns it calls unique no
    value twice.
    """
    if not spec.target_keys:
        raise SpecError(f"{spec.target_table}: no rule carries a key over")
    source = tables[spec.source_table]
    if source_filter is not None:
        source = source_filter.apply(source)
    if spec.unique_columns:
        require_unique(source, spec.unique_columns)
    mapped = apply_mapping(extract(spec, {**tables, spec.source_table: source}), spec, dialect=dialect, batch_id=batch_id)
    expected = written(mapped, "expected")
    require_not_null(expected, spec.required_columns)
    return expected


def compare_expected(
    spark: SparkSession,
    spec: TableSpec,
    expected: DataFrame,
    target: DataFrame | Side,
    *,
    save_to: str | None = None,
    report_path: str | None = None,
    report_format: str = "csv",
    **options,
) -> Reconciliation:
    """The second half of :func:`run_spec`: what :func:`expected_table` gave, compared with the target."""
    if not isinstance(target, Side):
        target = Side(target)
    user_transform = target.transform
    target = replace(target, transform=lambda df: target_extract(spec, perform_transform(df, user_transform)))
    if "columns" in options:
        raise SpecError("the columns to compare are those of the spec; use exclude to leave some out")
    excluded = {c.lower() for c in options.pop("exclude", AUDIT_COLUMNS)}
    columns = [c for c in spec.compare_columns if c.lower() not in excluded]
    return run(
        spark, Side(expected, save_to=save_to), target, spec.target_keys, columns,
        report_path=report_path, report_format=report_format, **options,
    )


def run_spec(
    spark: SparkSession,
    spec: TableSpec,
    tables: Mapping[str, DataFrame],
    target: DataFrame | Side,
    *,
    source_filter: LoadFilter | None = None,
    save_to: str | None = None,
    dialect: str = "mysql",
    batch_id: str = BATCH_ID,
    report_path: str | None = None,
    report_format: str = "csv",
    **options,
) -> Reconciliation:
    """The check of one table by its mapping spec, from extract to report.

    The expected table is the extract, filtered and mapped (see
    :func:`expected_table`), and saved to ``save_to`` if that is given.  It is
    compared with ``target`` on the spec's keys and columns; ``options`` are
    those of :func:`reconcile`.
    """
    expected = expected_table(spark, spec, tables, source_filter=source_filter, dialect=dialect, batch_id=batch_id)
    return compare_expected(
        spark, spec, expected, target, save_to=save_to, report_path=report_path, report_format=report_format, **options
    )


# Exit codes of a check; 0 and 3 come from the result.
EXIT_CONFIG = 1
EXIT_SCHEMA = 2
EXIT_OTHER = 99


def exit_code_of(check: Callable[[], Reconciliation | None]) -> int:
    """Run a check and give the exit code of its result or of the error it raised."""
    try:
        result = check()
    except SchemaMismatchError:
        return EXIT_SCHEMA
    except (NullViolationError, UniqueViolationError, DuplicateKeyError):
        return EXIT_OTHER
    except (ValueError, KeyError):
        return EXIT_CONFIG
    except Exception:
        return EXIT_OTHER
    return result.exit_code if result else 0
