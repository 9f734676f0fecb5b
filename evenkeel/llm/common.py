"""Helpers shared by the operators."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable_by_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is on a shared path and not installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (paths, ROOT) if p)


#: Of texts that go to a Python worker at once; Spark's own limit is by rows, 10,000 of them.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def light_batches(spark: SparkSession) -> None:
    """Let workers get batches of ``BATCH_BYTES`` at most, unless the session has a limit of its own.

    A batch is held by the JVM, beside its heap, and by the worker; a row larger than that is a batch by itself.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [b or b"" for b in texts.cast(pa.binary()).to_pylist()]


def each_utf8(texts: pa.Array, at_once: int = 200) -> Iterator[bytes]:
    """The same one by one, with few of them copied out of the column at a time."""
    for i in range(0, len(texts), at_once):
        yield from utf8(texts.slice(i, at_once))


# Bitmaps: which keys are surely not in a set --------------------------------------------------------------------------

#: Bits of a bitmap, as a power of two: 2 MB when broadcast, whatever the number of keys.
BITMAP_BITS = 24


def bitmap_of(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """A bitmap of the 64-bit hashes in column ``key``, in pieces of 4 KB; never over ``2**bits / 8`` bytes in all."""
    slot = F.pmod(F.col(key), F.lit(1 << bits)) + 1
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )


def bitmap_bytes(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """The same bitmap as bytes, for tasks in Python: ``2**bits / 8`` bytes, whatever the number of keys."""
    found = np.zeros(1 << bits - 3, np.uint8)
    for r in bitmap_of(keys, key, bits).collect():
        piece = np.frombuffer(r.bits, np.uint8)
        at = (r.piece - 1) * 4096
        found[at : at + len(piece)] = piece[: len(found) - at]
    return found


def maybe_held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the bitmap's set."""
    slot = keys.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def with_membership(df: DataFrame, key: Column, bitmap: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """``df`` with a boolean column ``name``: false where ``key`` is surely not in the bitmap's set.

    The more keys the set has, the more rows are true without being in it; an
    exact join of the true rows must follow.
    """
    piece, content = fresh(df, "bitmap_piece"), fresh(df, "bitmap_bits")
    slot = F.pmod(key, F.lit(1 << bits)) + 1
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(content), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    small = F.broadcast(bitmap.select(F.col("piece").alias(piece), F.col("bits").alias(content)))
    kept = [column(c) for c in df.columns]
    found = df.withColumn(piece, F.bitmap_bucket_number(slot)).join(small, piece, "left")
    return found.select(*kept, F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False)).alias(name))


# Groups of sorted rows ------------------------------------------------------------------------------------------------


def groups(batches: Iterable[pa.RecordBatch], keys: int = 1) -> Iterator[pa.Table]:
    """Whole groups, many at a time, of batches sorted by their first ``keys`` columns (longs without nulls)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1][k][-1] != batch[k][0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        last = starts(*(batch[k] for k in range(keys)))[-1]
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def starts(*keys) -> np.ndarray:
    """Where each group of equal neighbouring keys begins."""
    arrays = [np.asarray(k) for k in keys]
    changed = np.ones(len(arrays[0]), bool)
    changed[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in arrays])
    return np.flatnonzero(changed)


def united(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after uniting ``a[i]`` with ``b[i]``."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (labels[labels] != labels).any():
            labels = labels[labels]


# Hashes of many words at once ----------------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """The hashes with all bits stirred."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHash:
    """64-bit hashes of stretches of bytes, by prefix sums of a polynomial with an odd base."""

    def __init__(self, base: int):
        self.base, self.powers, self.inverse = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            self.powers = self._all_powers(self.base, n + 1)
            self.inverse = self._all_powers(pow(self.base, -1, 1 << 64), n + 1)

    @staticmethod
    def _all_powers(base: int, n: int) -> np.ndarray:
        return np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, base, np.uint64))])

    def __call__(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self._grow(len(text))
        terms = text.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.powers[: len(text)]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        return mixed((sums[end] - sums[start]) * self.inverse[start])


# Memory of workers ----------------------------------------------------------------------------------------------------


def tidy(task):
    """``task`` (batches in, batches out) that gives memory back to the system when it ends, since workers live on."""

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


# Pigeonhole keys ------------------------------------------------------------------------------------------------------


def block_masks(differing: int, blocks: int) -> list[int]:
    """Masks of 64 bits, cut into ``blocks``: fingerprints with up to ``differing`` differing bits agree under one of them.

    Each mask joins ``blocks - differing`` blocks, as so many have no differing bit.
    """
    from itertools import combinations

    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    whole = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(whole, blocks - differing)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def block_keys(fingerprint: Column, masks: list[int]) -> Column:
    """An array of one key for each mask."""
    return F.array(*(F.xxhash64(F.lit(i), fingerprint.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)))


# Connected components -------------------------------------------------------------------------------------------------


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge; a component's name is its smallest node.

    Nodes are longs, without nulls.  Rounds of large-star and small-star steps
    hang every node under smaller ones until only stars remain, in a number of
    rounds that grows with the logarithm of the longest path.  Each round is
    written to the shared folder, so no lineage builds up and nothing but two
    numbers comes to the driver.
    """
    from evenkeel.sources.workspace import written

    high, low = F.greatest(left, right), F.least(left, right)
    tree = written(edges.select(high.alias("u"), low.alias("v")).filter("u > v").distinct(), "edges")
    state = _state(tree)
    while True:
        both = tree.union(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tree = written(small.union(least).distinct(), "edges")
        before, state = state, _state(tree)
        if state == before:
            break
    nodes = tree.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(tree.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(tree: DataFrame) -> tuple:
    return tuple(tree.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
