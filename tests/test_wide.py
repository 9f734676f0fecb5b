"""Wide tables: a hash for each group of columns."""

import random
import re

import pytest
from frame_checks import diff_set, formatted_plan
from pyspark.sql import functions as F

import evenkeel.operators.reconcile as module
from evenkeel.operators.reconcile import reconcile


@pytest.fixture
def wide(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("k"), *[(F.col("id") * (i % 7) + i).alias(f"c{i:03d}") for i in range(300)])
    rows.write.parquet(str(tmp_path / "wide"))
    return spark.read.parquet(str(tmp_path / "wide"))


def plans_of(monkeypatch):
    plans, keep = {}, module.written
    monkeypatch.setattr(module, "written", lambda df, name: (plans.update({name: formatted_plan(df)}), keep(df, name))[1])
    return plans


def columns_read(plan):
    return [set(re.findall(r"(?:k|c\d+)(?=:)", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


@pytest.mark.parametrize("skip_equal", [False, True])
def test_only_the_changed_group_is_read_again(spark, wide, tmp_path, monkeypatch, skip_equal):
    changed = wide.withColumn("c123", F.when(F.col("k") % 50 == 0, -1).otherwise(F.col("c123"))).withColumn("c130", F.when(F.col("k") == 7, -1).otherwise(F.col("c130")))
    changed.write.parquet(str(tmp_path / "changed"))
    plans = plans_of(monkeypatch)
    result = reconcile(wide, spark.read.parquet(str(tmp_path / "changed")), "k", skip_equal=skip_equal)
    assert {r[:2] for r in diff_set(result)} == {(str(k), "c123") for k in range(0, 500, 50)} | {("7", "c130")}
    read = [c for c in columns_read(plans["diff"]) if "c123" in c]
    assert len(read) == 2 and all({"k", "c123", "c130"} <= c and len(c) <= 1 + 300 // module.MOST_GROUPS + 1 for c in read)


def test_changes_in_several_groups(spark, wide, monkeypatch):
    rng = random.Random(1)
    cells = {(rng.randrange(500), f"c{rng.randrange(300):03d}") for _ in range(60)}
    changed = wide
    for name in sorted({c for _, c in cells}):
        keys = [k for k, c in cells if c == name]
        changed = changed.withColumn(name, F.when(F.col("k").isin(keys), -5).otherwise(F.col(name)))
    for strategy in ("hash", "exact"):
        result = reconcile(wide, changed, "k", strategy=strategy)
        assert {r[:2] for r in diff_set(result)} == {(str(k), c) for k, c in cells}
        assert result.counts["mismatched_rows"] == len({k for k, _ in cells})


def test_repeated_keys_of_a_wide_table(spark, wide):
    twice = wide.unionAll(wide.filter("k < 3")).unionAll(wide.filter("k = 9").withColumn("c299", F.lit(0).cast("bigint")))
    result = reconcile(twice, wide, "k")
    assert result.counts["missing_rows"] == 4 and result.counts["duplicate_keys"] == 4 and result.counts["extra_rows"] == 0
