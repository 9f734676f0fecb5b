"""Fingerprints of slices, and sides that lie by key."""

import random

import pytest
from frame_checks import diff_set, formatted_plan
from pyspark.sql import functions as F

import evenkeel.operators.reconcile as module
from evenkeel.operators.reconcile import DuplicateKeyError, reconcile
from evenkeel.plans.check import Side, run
from evenkeel.sources import buckets
from evenkeel.sources.files import load_snapshot, save_snapshot
from test_reconcile import brute_force, frame, random_rows

SCHEMA = "k int, a string, b int"


@pytest.fixture(params=["hash", "exact", "anti"])
def strategy(request):
    return request.param


def plans_of(monkeypatch):
    plans, keep = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: (plans.append((name, formatted_plan(df).split("(1) ")[0])), keep(df, name))[1])
    return plans


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("slices", [1, 16])
def test_random_tables(spark, strategy, seed, slices, monkeypatch):
    monkeypatch.setattr(module, "SLICES", slices)
    rng = random.Random(seed)
    left = random_rows(rng)
    right = [r for r in left if rng.random() > 0.05] + [(100, "x", 1)]
    right[0] = (right[0][0], "new", 9)
    diff, repeated = brute_force(left, right)
    plain = reconcile(frame(spark, left, SCHEMA), frame(spark, right, SCHEMA), "k", strategy=strategy)
    result = reconcile(frame(spark, left, SCHEMA), frame(spark, right, SCHEMA), "k", strategy=strategy, skip_equal=True)
    assert diff_set(result) == diff and result.counts == plain.counts
    assert {r.primary_key_value for r in result.duplicates.collect()} == repeated
    assert sorted(map(str, result.duplicates.collect())) == sorted(map(str, plain.duplicates.collect()))


def test_equal_tables_end_with_one_count_of_keys(spark, strategy, sf_dir, monkeypatch):
    plans = plans_of(monkeypatch)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    result = reconcile(orders, orders.orderBy("o_custkey"), "o_orderkey", strategy=strategy, skip_equal=True)
    n = orders.count()
    assert result.passed and result.diff.count() == 0 and result.counts["matched_rows"] == n == result.counts["source_rows"]
    assert [name for name, _ in plans] == ["repeated"]
    # one side's keys, and only those
    assert plans[0][1].count("Exchange") == 1 and plans[0][1].count("Scan") == 1


def test_equal_rows_take_no_part(spark, sf_dir, monkeypatch):
    plans = plans_of(monkeypatch)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    one = orders.withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("o_orderkey") == 7, 1).otherwise(0))
    result = reconcile(orders, one, "o_orderkey", skip_equal=True)
    assert diff_set(result).pop()[:2] == ("7", "o_custkey") and result.counts["matched_rows"] == orders.count() - 1
    findings = dict(plans)["findings"]
    # straight from the key aggregate: no second shuffle for the counts
    assert findings.count("Exchange") == 1


def test_repeats_count(spark, strategy):
    """Rows that come twice, against others that come twice: xor alone would not see it."""
    left = frame(spark, [(1, "a", 1)] * 2 + [(2, "b", 1)], SCHEMA)
    right = frame(spark, [(1, "c", 1)] * 2 + [(2, "b", 1)], SCHEMA)
    result = reconcile(left, right, "k", strategy=strategy, skip_equal=True)
    assert result.counts["missing_rows"] == result.counts["extra_rows"] == 2 and result.counts["matched_rows"] == 1
    swapped = reconcile(frame(spark, [(1, "a", 1), (2, "b", 1)], SCHEMA), frame(spark, [(1, "b", 1), (2, "a", 1)], SCHEMA), "k", strategy=strategy, skip_equal=True)
    assert swapped.counts["mismatched_rows"] == 2


def test_repeated_keys_in_equal_tables(spark, strategy):
    left = frame(spark, [(None, "a", 1), (None, "b", 1), (3, "x", 1), (3, "x", 1), (4, None, None)], SCHEMA)
    result = reconcile(left, left, "k", strategy=strategy, skip_equal=True)
    assert sorted(tuple(r) for r in result.duplicates.collect()) == [("3", 2, 2, "DUPLICATE_KEY_IN_BOTH"), ("\\N", 2, 2, "DUPLICATE_KEY_IN_BOTH")]
    assert not result.passed and result.total_diffs == 0 and result.counts["matched_rows"] == 5
    with pytest.raises(DuplicateKeyError):
        reconcile(left, left, "k", strategy=strategy, skip_equal=True, on_duplicate="raise")


def test_empty_tables(spark, strategy):
    none, some = frame(spark, [], SCHEMA), frame(spark, [(1, "a", 1)], SCHEMA)
    assert reconcile(none, none, "k", strategy=strategy, skip_equal=True).passed
    assert reconcile(none, some, "k", strategy=strategy, skip_equal=True).counts["extra_rows"] == 1
    assert reconcile(some, some, "k", [], strategy=strategy, skip_equal=True).passed


# --- sides in buckets ---------------------------------------------------------------------------


@pytest.fixture
def loaded(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    changed = orders.filter("o_orderkey % 97 > 0").withColumn("o_custkey", F.col("o_custkey") + (F.col("o_orderkey") % 83 == 0).cast("int"))
    return orders, changed


@pytest.mark.parametrize("saved", [(True, False), (False, True), (True, True)])
def test_saved_sides_are_not_moved(spark, loaded, strategy, saved, tmp_path, monkeypatch):
    orders, changed = loaded
    expected = reconcile(orders, changed, "o_orderkey", strategy=strategy)
    sides = []
    for i, (df, keep) in enumerate(zip(loaded, saved)):
        path = str(tmp_path / f"side{i}")
        sides.append(Side(Side(df, save_to=path, save_keys=("O_ORDERKEY",)).load(spark)) if keep else Side(df))
    monkeypatch.setattr(module, "BROADCAST_KEY_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = plans_of(monkeypatch)
        result = run(spark, *sides, ["o_orderkey"], strategy=strategy)
        assert diff_set(result) == diff_set(expected) and result.counts == expected.counts
        moved = 2 - sum(saved)
        # one shuffle is that of the findings
        assert dict(plans)["findings"].count("Exchange") == moved + 1
        if strategy != "hash":
            assert dict(plans)["diff" if strategy == "exact" else "cells"].count("Exchange") == moved
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_snapshot_is_found_again(spark, loaded, tmp_path):
    path = str(tmp_path / "it's here")
    save_snapshot(loaded[0], path, keys=["o_orderkey"])
    spark.sql(f"drop table {buckets.table_name(path)}")  # as in another session
    again = load_snapshot(spark, path)
    assert buckets.in_buckets(again) and again.dtypes == loaded[0].dtypes and again.exceptAll(loaded[0]).isEmpty() and again.count() == loaded[0].count()
    save_snapshot(loaded[1], path, keys=["o_orderkey"])
    assert load_snapshot(spark, path).count() == loaded[1].count()
    save_snapshot(loaded[0], path)
    assert not buckets.in_buckets(load_snapshot(spark, path)) and load_snapshot(spark, path).count() == loaded[0].count()
    with pytest.raises(ValueError):
        save_snapshot(loaded[0], path, "csv", keys=["o_orderkey"])


def test_a_hot_key_is_not_put_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "EVEN_ENOUGH", 10)
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
    path = str(tmp_path / "t")
    save_snapshot(df, path, keys=["k"])
    assert load_snapshot(spark, path).count() == 3000 and buckets.in_buckets(load_snapshot(spark, path)) is False
    assert buckets.is_even(df, ["id"], 8)


def test_other_keys_and_types_are_still_right(spark, tmp_path):
    """Snapshots by text, by several keys or compared by another type lie by something else; only the work differs."""
    left = spark.createDataFrame([(1, " a ", 1), (2, "b", 2), (None, "c", 3)], "k int, t string, v int")
    right = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (None, "c", 3)], "k bigint, t string, v int")
    for i, keys in enumerate((["k"], ["t"], ["k", "t"])):
        path = str(tmp_path / f"t{i}")
        save_snapshot(left, path, keys=keys)
        for strategy in ("hash", "exact", "anti"):
            result = reconcile(load_snapshot(spark, path), right, keys, ["v"], strategy=strategy)
            assert [r.expected_value for r in result.diff.collect()] == ["2"] and result.counts["matched_rows"] == 2
