"""Reports over a diff table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.reconcile import DIFF_SCHEMA, EXTRA, MISMATCH, MISSING, Reconciliation
from evenkeel.sources.files import save_snapshot


def check_diff_columns(diff: DataFrame) -> None:
    absent = sorted(set(DIFF_SCHEMA.names) - set(diff.columns))
    if absent:
        raise ValueError(f"not a diff table, column(s) {absent} are absent; found {diff.columns}")


def diff_by_type(diff: DataFrame | Reconciliation) -> DataFrame:
    """Rows affected per kind of difference; a row with several changed cells counts once.

    A whole-row difference counts as many rows as it stands for, and needs no
    distinct count; only the keys of changed cells are told apart.  A result
    knows these numbers; of a diff table, which may come from a report, they are
    read from the markers that print them.
    """
    if isinstance(diff, Reconciliation):
        diff, rows = diff.counted_diff, F.col("rows")
    else:
        check_diff_columns(diff)
        printed = [F.regexp_extract(c, r" x(\d+)$", 1).try_cast("long") for c in ("expected_value", "actual_value")]
        rows = F.coalesce(*printed, F.lit(1))
    whole = diff.filter(F.col("diff_type") != MISMATCH).groupBy("diff_type").agg(F.sum(rows).alias("affected_rows"))
    changed = diff.filter(F.col("diff_type") == MISMATCH).groupBy("diff_type").agg(
        F.count_distinct("primary_key_value").alias("affected_rows")
    )
    return whole.unionByName(changed)


def diff_by_column(diff: DataFrame) -> DataFrame:
    """Differences per column, most frequent first."""
    check_diff_columns(diff)
    return (
        diff.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("differences"))
        .orderBy(F.desc("differences"), "column_name")
    )


def summary_text(result: Reconciliation, location: str = "") -> str:
    """The counts as text.  Reads one row per column of the compared tables, no more."""
    c = result.counts
    per_column = diff_by_column(result.diff).collect() if result.total_diffs else []
    lines = [
        "Comparison summary",
        f"  source rows      {c['source_rows']:,}",
        f"  target rows      {c['target_rows']:,}",
        f"  matching rows    {c['matched_rows']:,}",
        f"  {MISSING:<16} {c['missing_rows']:,}",
        f"  {EXTRA:<16} {c['extra_rows']:,}",
        f"  {MISMATCH:<16} {c['mismatched_rows']:,}",
        f"  duplicate keys   {c['duplicate_keys']:,}",
        "  columns          " + (", ".join(f"{r.column_name} ({r.differences})" for r in per_column) or "none"),
    ]
    if location:
        lines.append(f"  report           {location}")
    lines.append(f"  verdict          {result.verdict}")
    return "\n".join(lines)


def write_report(result: Reconciliation, path: str, fmt: str = "csv") -> int:
    """Write the diff table as a directory of files and return the exit code.

    The repeated keys go beside it to ``path_duplicates`` and the counts with
    the verdict to ``path_summary``, so a check that fails by repeated keys
    alone shows them too.
    """
    check_diff_columns(result.diff)
    beside = path.rstrip("/")
    for df, to in ((result.diff, path), (result.duplicates, f"{beside}_duplicates"), (result.summary, f"{beside}_summary")):
        save_snapshot(df, to, fmt)
    return result.exit_code
