"""Upserts as a frame and in place."""

import os
import random

import pytest
from frame_checks import formatted_plan

import evenkeel.operators.upsert as module
from evenkeel.operators.reconcile import DuplicateKeyError
from evenkeel.operators.upsert import finish_upsert, upsert, upsert_into
SCHEMA = "k int, month string, v string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "month", "v").collect()), key=repr)


def test_a_change_without_its_order_is_not_lost(spark):
    target = frame(spark, [(1, "a", "old"), (2, "a", "old")])
    changes = frame(spark, [(1, "a", None), (2, "b", "new"), (2, "c", None), (3, None, None)])
    got = upsert(target, changes, "k", latest_by="v")
    assert rows_of(got) == [(1, "a", None), (2, "b", "new"), (3, None, None)]


def test_equal_orders_are_settled_by_the_other_columns(spark):
    changes = frame(spark, [(1, "a", "x"), (1, "c", "x"), (1, None, "x"), (1, "b", "x")])
    for part in (changes, changes.orderBy("month"), changes.repartition(4)):
        assert rows_of(upsert(frame(spark, []), part, "k", latest_by="v")) == [(1, "c", "x")]


def test_maps_among_the_columns(spark):
    changes = spark.sql("select 1 as k, map('a', 1) as m, 2 as t union all select 1, map('b', 2), 3")
    assert [r.m for r in upsert(changes.limit(0), changes, "k", latest_by="t").collect()] == [{"b": 2}]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, f"m{i % 5}", "old") for i in range(100)] + [(100, "only", "old"), (101, None, "old")]
    frame(spark, rows).write.partitionBy("month").parquet(path)
    return path, rows


def files(path):
    return {os.path.relpath(os.path.join(d, n), path): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def read(spark, path):
    return rows_of(spark.read.schema(SCHEMA).parquet(path))


def after(rows, changes):
    changed = {r[0] for r in changes if r[0] is not None}
    return sorted([r for r in rows if r[0] not in changed] + changes, key=repr)


def test_only_partitions_with_a_changed_key_are_written(spark, table):
    path, rows = table
    before = files(path)
    changes = [(1, "m1", "new"), (2, "m4", "moved"), (500, "m1", "added")]
    assert upsert_into(path, frame(spark, changes), "k", "month") == 3
    assert read(spark, path) == after(rows, changes)
    now = files(path)
    kept = {f for f in before if before[f] == now.get(f)}
    assert {f.split("/")[0] for f in before if f not in kept} == {"month=m1", "month=m2", "month=m4"}
    assert not os.path.exists(path + "_upsert")


def test_partitions_come_and_go(spark, table):
    path, rows = table
    changes = [(100, "brand new", "moved"), (101, "m0", "moved"), (7, None, "moved")]
    upsert_into(path, frame(spark, changes), ["K"], ["month"])
    assert read(spark, path) == after(rows, changes)
    assert not os.path.exists(path + "/month=only") and os.path.exists(path + "/month=__HIVE_DEFAULT_PARTITION__")


def test_nothing_to_do_and_a_new_table(spark, table, tmp_path):
    path, rows = table
    before = files(path)
    assert upsert_into(path, frame(spark, []), "k", "month") == 0 and files(path) == before
    new = str(tmp_path / "new")
    assert upsert_into(new, frame(spark, rows), "k", "month") == 7 and read(spark, new) == after([], rows)


def test_an_upsert_that_broke_off_is_finished(spark, table, monkeypatch):
    path, rows = table
    first, second = [(1, "m1", "new"), (100, "m2", "moved")], [(3, "m3", "later")]
    real = module.finish_upsert
    calls = []
    monkeypatch.setattr(module, "finish_upsert", lambda *a: calls.append(a) or (real(*a) if len(calls) == 1 else None))
    upsert_into(path, frame(spark, first), "k", "month")  # noted, and ended before the exchange
    assert read(spark, path) == after([], rows) and os.path.exists(path + "_upsert/_SUCCESS")
    monkeypatch.setattr(module, "finish_upsert", real)
    upsert_into(path, frame(spark, second), "k", "month")
    assert read(spark, path) == after(after(rows, first), second)
    assert not finish_upsert(spark, path)


def test_an_upsert_that_broke_off_in_the_exchange_is_finished(spark, table, monkeypatch):
    path, rows = table
    changes = [(1, "m1", "new"), (100, "m2", "moved")]
    real = module.remove

    def broken(session, what):
        if what.endswith("month=only"):
            raise OSError("gone")
        real(session, what)

    monkeypatch.setattr(module, "remove", broken)
    with pytest.raises(OSError):
        upsert_into(path, frame(spark, changes), "k", "month")
    monkeypatch.setattr(module, "remove", real)
    assert finish_upsert(spark, path) and read(spark, path) == after(rows, changes)


def test_refusals(spark, table):
    path, rows = table
    before = files(path)
    with pytest.raises(DuplicateKeyError):
        upsert_into(path, frame(spark, [(1, "m1", "a"), (1, "m2", "b")]), "k", "month")
    with pytest.raises(ValueError):
        upsert_into(path, frame(spark, [(1, "m1")], "k int, month string"), "k", "month")
    assert files(path) == before
    upsert_into(path, frame(spark, [(1, "m1", "a"), (1, "m2", "b")]), "k", "month", latest_by="v")
    assert (1, "m2", "b") in read(spark, path)


@pytest.mark.parametrize("seed", range(2))
def test_random_changes(spark, tmp_path, seed):
    rng = random.Random(seed)
    path = str(tmp_path / "t")
    rows = [(i, f"{rng.randint(0, 9)}", "old") for i in range(300)]  # months that look like numbers
    upsert_into(path, frame(spark, rows), "k", "month")
    for turn in range(2):
        changes = [(k, f"{rng.randint(0, 12)}", f"t{turn}") for k in rng.sample(range(400), 40)]
        upsert_into(path, frame(spark, changes), "k", "month")
        rows = after(rows, changes)
        assert read(spark, path) == rows


@pytest.mark.parametrize("listed", [10_000, 0])
def test_two_partition_columns(spark, tmp_path, listed, monkeypatch):
    monkeypatch.setattr(module, "LISTED_PARTITIONS", listed)
    path, schema = str(tmp_path / "t"), "k int, month string, v string, day int"
    rows = [(i, f"m{i % 3}" if i % 7 else None, "old", i % 4 if i % 5 else None) for i in range(120)]
    upsert_into(path, spark.createDataFrame(rows, schema), "k", ["month", "day"])
    changes = [(1, "m0", "new", 1), (8, None, "new", None), (35, "m2", "new", 0), (999, "m9", "new", 9)]
    upsert_into(path, spark.createDataFrame(changes, schema), "k", ["month", "day"])
    got = spark.read.schema(schema).parquet(path).select("k", "month", "v", "day")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == after(rows, changes)


def test_files_of_other_partitions_are_not_opened(spark, table):
    path, rows = table
    read = spark.read.schema(SCHEMA).parquet(path)
    touched = spark.createDataFrame([("m1",), (None,)], "_p0 string")
    found = module.rows_of_partitions(read, touched, ["month"], 2)
    assert {r.month for r in found.select("month").distinct().collect()} == {"m1", None}
    filters = next(line for line in formatted_plan(found).splitlines() if "PartitionFilters" in line)
    assert "m1" in filters and "isnull" in filters
