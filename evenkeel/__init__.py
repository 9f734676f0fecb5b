"""Spark-native reconciliation of tables between two systems."""

from evenkeel.operators.filters import DateFilter, KeyFilter, LoadFilter, load_filters
from evenkeel.operators.reconcile import Reconciliation, compare_columns, reconcile
from evenkeel.operators.report import diff_by_column, diff_by_type, summary_text, write_report
from evenkeel.operators.upsert import finish_upsert, upsert, upsert_into
from evenkeel.plans.check import Side, run, run_spec
from evenkeel.plans.mapping import apply_mapping, extract
from evenkeel.plans.spec import ColumnRule, JoinDef, SourceColumn, TableSpec
from evenkeel.sources.workspace import workspace

__all__ = [
    "ColumnRule", "DateFilter", "JoinDef", "KeyFilter", "LoadFilter", "Reconciliation", "Side", "SourceColumn",
    "TableSpec", "apply_mapping", "compare_columns", "diff_by_column", "diff_by_type", "extract",
    "finish_upsert", "load_filters", "reconcile", "run", "run_spec", "summary_text", "upsert", "upsert_into", "workspace",
    "write_report",
]
