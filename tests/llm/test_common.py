import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenkeel.llm.common import (
    BATCH_BYTES, BATCH_SETTING, bitmap_of, block_keys, block_masks, connected_components, fresh, groups, light_batches, starts, united,
    with_membership,
)
from tests_llm_helpers import brute_components


def test_members_are_always_found(spark):
    keys = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("k"))
    df = spark.range(3000).withColumn("piece", F.lit("own"))
    found = with_membership(df, F.xxhash64("id"), bitmap_of(keys, "k"), "held")
    rows = found.collect()
    assert len(rows) == 3000 and found.columns == ["id", "piece", "held"]
    assert all(r.held for r in rows if r.id % 3 == 0)
    assert sum(r.held for r in rows if r.id % 3) < 20  # 1000 keys in 2**24 bits


@pytest.mark.parametrize("bits", [4, 24])
def test_a_full_bitmap_says_yes(spark, bits):
    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    found = with_membership(spark.range(700), F.xxhash64("id"), bitmap_of(keys, "k", bits), "held", bits)
    held = {r.id for r in found.filter("held").collect()}
    assert set(range(500)) <= held and (len(held) == 700) == (bits == 4)


def test_no_keys(spark):
    none = spark.range(0).select(F.col("id").alias("k"))
    assert with_membership(spark.range(9), F.col("id"), bitmap_of(none, "k"), "held").filter("held").count() == 0


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "Row int, row_ int")
    assert fresh(df, "row") == "row__" and fresh(df, "other") == "other"


@pytest.mark.parametrize("differing,blocks", [(2, 4), (3, 4), (3, 5), (3, 6), (1, 2)])
def test_near_fingerprints_share_a_key(spark, differing, blocks):
    masks = block_masks(differing, blocks)
    for flipped in random.Random(1).sample(list(itertools.combinations(range(64), differing)), 60):
        change = sum(1 << b for b in flipped)
        assert any(change & m == 0 for m in masks)
    rows = [(5, 5 ^ (1 << 63) - (1 << 64) ^ 1)]
    keys = spark.createDataFrame(rows, "a long, b long").select(
        block_keys(F.col("a"), masks).alias("a"), block_keys(F.col("b"), masks).alias("b")
    ).first()
    change = (rows[0][0] ^ rows[0][1]) & ((1 << 64) - 1)
    assert [x == y for x, y in zip(keys.a, keys.b, strict=True)] == [change & m == 0 for m in masks]


def test_groups_come_whole():
    rng = random.Random(2)
    keys = sorted(rng.choices(range(40), k=300))
    table = pa.table({"k": keys, "v": range(300)})
    for size in (1, 7, 1000):
        got = list(groups(iter(table.to_batches(max_chunksize=size))))
        assert pa.concat_tables(got)["v"].to_pylist() == list(range(300))
        seen = [set(t["k"].to_pylist()) for t in got]
        assert sum(map(len, seen)) == len(set(keys))
    assert list(groups(iter([]))) == []


def test_starts_and_united():
    assert starts(np.array([3, 3, 5, 7, 7])).tolist() == [0, 2, 3]
    assert starts(np.array([3, 3, 3]), np.array([1, 2, 2])).tolist() == [0, 1]
    labels = united(np.arange(6), np.array([5, 3, 1]), np.array([3, 1, 2]))
    assert labels.tolist() == [0, 1, 1, 1, 4, 1]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(45)]
    edges += [(i, i + 1) for i in range(1000, 1040)]  # a long path
    edges += [(5000, 5001 + i) for i in range(50)]  # a star
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(frame, "a", "b").collect()}
    expected = brute_components([e for e in edges if e[0] != e[1]])
    assert got == expected


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_batches_of_texts_are_bounded_by_bytes(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    @F.arrow_udf("long")
    def rows(x: pa.Array) -> pa.Array:
        return pa.array([len(x)] * len(x), pa.int64())

    before = spark.conf.get(BATCH_SETTING, None)
    try:
        spark.conf.unset(BATCH_SETTING)
        light_batches(spark)
        assert max(r.n for r in docs.mapInArrow(size, "n long").collect()) < 2 * BATCH_BYTES
        assert docs.select(rows("text").alias("n")).agg(F.max("n")).first()[0] < 1000
        spark.conf.set(BATCH_SETTING, "1000000")  # a session's own limit stays
        light_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1000000"
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)
