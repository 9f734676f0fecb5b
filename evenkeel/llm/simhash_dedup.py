"""Near-duplicates by SimHash fingerprints and a hierarchical index in Gray order.

Distinct fingerprints that agree in two of four 16-bit blocks meet in one
shard of the index (two fingerprints that differ in at most two bits agree in
two blocks).  In a shard they are sorted by their rank in the reflected Gray
code, so that neighbours differ in few bits.  Runs of neighbours form nodes:
the bits on which a whole run agrees become the node's masked pattern, what a
parent already holds is taken out of its children, and a search adds up
differing bits on the way down and leaves a node with all below it once they
are too many.  A shard gives away only which of its fingerprints hang together,
at most one row for each, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import (
    block_keys, block_masks, column, connected_components, each_utf8, fresh, groups, starts, united, whole_text,
    bitmap_of, tidy, with_membership,
)
from evenkeel.sources.workspace import written

SEED = 42
#: Fingerprints with at most so many differing bits are linked.
DIFFERING = 2
#: For texts that are alike: words in a shingle, bits, blocks of the fingerprint, and the least Jaccard similarity.
SIZE_ALIKE, DIFFERING_ALIKE, BLOCKS_ALIKE, ALIKE = 5, 11, 13, 0.8
#: Children of a node of the index.
FAN = 16


def shingle_hashes(text: bytes, size: int = 3) -> np.ndarray:
    """XXH64 of all runs of ``size`` words, repeats included; of the whole sequence if there are fewer words.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at ``\\x20`` and ``\\x09-\\x0d`` only.
    """
    words = text.lower().split()
    if len(words) >= size:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
        return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - size + 1)
    return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The signed 64-bit number whose bits are set in over half of ``hashes``; zero for none."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, size: int = 3) -> Column:
    """The fingerprint of a text column over runs of ``size`` words, as a long."""

    def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([simhash(shingle_hashes(t, size)) for t in each_utf8(batch)], pa.int64())

    return F.arrow_udf(tidy(fingerprints), "long")(text)


class GrayIndex:
    """An index of distinct fingerprints, sorted by Gray rank, for searches within a few bits."""

    def __init__(self, fingerprints: np.ndarray, fan: int = FAN):
        pattern, mask = fingerprints, np.full(len(fingerprints), ~np.uint64(0))
        self.fan, self.levels = fan, []
        while True:
            above = np.arange(0, len(pattern), fan)
            if len(pattern) <= fan:
                self.levels.append((pattern, mask))
                break
            of = np.repeat(above, fan)[: len(pattern)]
            differ = np.bitwise_or.reduceat(pattern ^ pattern[of], above)
            shared = np.bitwise_and.reduceat(mask, above) & ~differ
            self.levels.append((pattern, mask & ~np.repeat(shared, fan)[: len(mask)]))
            pattern, mask = pattern[above] & shared, shared

    def within(self, queries: np.ndarray, differing: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) numbers of all that differ in at most ``differing`` bits."""
        top = len(self.levels[-1][0])
        q, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        apart = np.zeros(len(q), np.uint8)
        for level in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[level]
            apart = apart + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = apart <= differing
            q, node, apart = q[near], node[near], apart[near]
            if level:
                below = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                real = below < len(self.levels[level - 1][0])
                q, apart, node = np.repeat(q, self.fan)[real], np.repeat(apart, self.fan)[real], below[real]
        return q, node


def local_labels(fingerprints: np.ndarray, differing: int, block: int = 1 << 12) -> np.ndarray:
    """For each fingerprint (distinct, in Gray order) the first one it hangs together with."""
    labels = np.arange(len(fingerprints))
    index = GrayIndex(fingerprints)
    for i in range(0, len(fingerprints), block):
        q, j = index.within(fingerprints[i : i + block], differing)
        labels = united(labels, q + i, j)
    return labels


def _shards(differing: int):
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            key, fp = (table[i].to_numpy() for i in (0, 1))
            begin = starts(key)
            size = np.diff(np.append(begin, len(key)))
            u, v = [], []
            for i, n in zip(begin[size > 1], size[size > 1], strict=True):
                own = fp[i : i + n]
                if n == 2:
                    labels = np.array([0, int((own[0] ^ own[1]).view(np.uint64).item().bit_count() > differing)])
                else:
                    labels = local_labels(own.view(np.uint64), differing)
                hung = np.flatnonzero(labels != np.arange(n))
                u.append(own[hung])
                v.append(own[labels[hung]])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return stars


def gray_rank(fingerprint: Column) -> Column:
    """A number that sorts longs by their rank in the reflected Gray code of 64 bits."""
    rank = fingerprint
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))  # Spark's longs are signed


def components(nodes: DataFrame, differing: int = DIFFERING, blocks: int | None = None) -> DataFrame:
    """(node, component) of the fingerprints in column ``fp`` (distinct) that have a link to another one.

    The more ``blocks`` there are, the more shards a fingerprint is in, and the fewer others each of them has.
    """
    masks = block_masks(differing, blocks or 2 * differing)
    keyed = nodes.select(F.explode(block_keys(F.col("fp"), masks)).alias("key"), "fp")
    shards = keyed.repartition("key").sortWithinPartitions("key", gray_rank(F.col("fp")))
    return connected_components(shards.mapInArrow(_shards(differing), "u long, v long"), "u", "v")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, differing: int = DIFFERING
) -> DataFrame:
    """(doc_id, fingerprint, component_id, component, text_hash), one row for each row of ``docs``.

    Documents are in one component if a chain of fingerprints with steps of at
    most ``differing`` bits (1 or more) leads from one to the other;
    ``component_id`` is the smallest id in it.

    Null and empty texts, and texts of white space, have fingerprint zero and
    are linked like others.  Null ids are passed over for ``component_id``,
    which is null only if all ids of the component are.  Repeated rows each get
    a row.  An empty table gives no rows; other columns are ignored.
    ``component`` is a fingerprint of the component, the same for all of it, and
    ``text_hash`` is XXH64 of the text.
    """
    rows = docs.select(column(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    prints = written(
        rows.select("doc_id", fingerprint(F.col("text")).alias("fp"), F.xxhash64("text").alias("text_hash")), "prints"
    )
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    linked = written(components(nodes.select("fp"), differing), "components")
    named = nodes.join(linked.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = named.join(least, "component").select("fp", "component_id", "component")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component", "text_hash"
    )


def _alike(differing: int, least: float, size: int):
    """(u, v) links that hold together the texts of a key whose sets of shingles are alike, from (key, text_hash, fp, text)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            key, name = table["key"].to_numpy(), table["text_hash"].to_numpy()
            prints = table["fp"].to_numpy().view(np.uint64)
            sets = [np.unique(shingle_hashes(t, size)) for t in each_utf8(table["text"].combine_chunks())]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            u, v = [], []
            begin = starts(key)
            for at, n in zip(begin.tolist(), np.diff(np.append(begin, len(key))).tolist(), strict=True):
                labels, crowd, outside = np.arange(n), -1, np.arange(n)
                own, many = prints[at : at + n], sizes[at : at + n]
                for i in range(n - 1):
                    # what hangs together already need not be compared; the largest such set meets the others only
                    others = outside[outside > i] if labels[i] == crowd else np.arange(i + 1, n)
                    near = (labels[others] != labels[i]) & (np.bitwise_count(own[others] ^ own[i]) <= differing)
                    near &= np.minimum(many[others], many[i]) >= least * np.maximum(many[others], many[i])
                    before = len(u)
                    for j in others[near].tolist():
                        if labels[i] != labels[j] and alike(sets[at + i], sets[at + j], least):
                            labels[labels == labels[j]] = labels[i]
                            u.append(name[at + i])
                            v.append(name[at + j])
                    if len(u) > before and n > 64:
                        crowd = int(np.bincount(labels).argmax())
                        outside = np.flatnonzero(labels != crowd)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return found


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets, as sorted arrays, have a Jaccard similarity of ``least`` or more; empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def alike_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    size: int = SIZE_ALIKE, differing: int = DIFFERING_ALIKE, blocks: int = BLOCKS_ALIKE, similarity: float = ALIKE,
) -> DataFrame:
    """(doc_id, component_id, component, text_hash), one row for each row of ``docs``.

    Texts are linked if their fingerprints over runs of ``size`` words differ in
    at most ``differing`` bits and the Jaccard similarity of their sets of such
    runs is ``similarity`` or more; ``component`` is the same for all that a chain
    of links joins, and ``component_id`` the smallest id in it.

    Null and empty texts, and texts of white space, are alike.  Null ids are
    passed over for ``component_id``.  Equal texts are one from the start, and
    only texts with a near fingerprint are moved.
    """
    rows = docs.select(column(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    prints = written(rows.select("doc_id", fingerprint(F.col("text"), size).alias("fp"), "text_hash"), "prints")
    texts = written(prints.groupBy("text_hash").agg(F.first("fp").alias("fp")), "text_prints")
    nodes = texts.select("fp").distinct()
    near = components(nodes, differing, blocks).select(F.col("node").alias("fp"), F.col("component").alias("key"))
    # Different texts with one fingerprint are near as well.
    near = texts.join(near, "fp", "left").select("text_hash", "fp", F.coalesce("key", "fp").alias("key"))
    several = near.groupBy("key").agg(F.count("*").alias("texts")).filter("texts > 1")
    near = written(near.join(several, "key", "left_semi"), "near_texts")
    bitmap = bitmap_of(near.select(F.xxhash64("text_hash").alias("k")), "k")
    wanted = with_membership(rows.select("text_hash", "text"), F.xxhash64("text_hash"), bitmap, "wanted").filter("wanted")
    content = wanted.groupBy("text_hash").agg(F.first("text").alias("text"))
    links = (
        near.join(content, "text_hash").select("key", "text_hash", "fp", "text")
        .repartition("key").sortWithinPartitions("key", "text_hash")
        .mapInArrow(tidy(_alike(differing, similarity, size)), "u long, v long")
    )
    linked = connected_components(links, "u", "v").select(F.col("node").alias("text_hash"), "component")
    of_text = texts.select("text_hash").join(linked, "text_hash", "left").select("text_hash", F.coalesce("component", "text_hash").alias("component"))
    named = written(prints.select("doc_id", "text_hash").join(of_text, "text_hash"), "alike_texts")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select("doc_id", "component_id", "component", "text_hash")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, found: DataFrame | None = None) -> DataFrame:
    """``docs`` with one row of each component of ``simhash_dedup``, or of ``found``: one with the smallest id.

    Of rows that share that id, one stays.  Only documents that may have to go
    are moved between machines; the rest are read and passed on.
    """
    found = written(simhash_dedup(docs, id_col, text_col) if found is None else found, "near_copies")
    grouped = found.groupBy("component").agg(F.count("*").alias("rows")).filter("rows > 1")
    doubtful = written(found.join(grouped, "component", "left_semi"), "doubtful")

    text_hash, doubt = fresh(docs, "text_hash_of_row"), fresh(docs, "in_doubt")
    own = docs.withColumn(text_hash, F.xxhash64(whole_text(text_col)))
    key = F.xxhash64(column(id_col), F.col(text_hash))
    bitmap = bitmap_of(doubtful.select(F.xxhash64("doc_id", "text_hash").alias("k")), "k")
    marked = with_membership(own, key, bitmap, doubt)
    clear = marked.filter(~F.col(doubt))

    # Both tables have one row for each pair of id and text, so repeated rows meet one row each.
    names = [fresh(docs, n) for n in ("doubtful_id", "doubtful_hash", "doubtful_least", "doubtful_component")]
    distinct = doubtful.groupBy(
        F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])
    ).agg(F.first("component_id").alias(names[2]), F.first("component").alias(names[3]))
    open_rows = marked.filter(F.col(doubt))
    same_row = column(id_col).eqNullSafe(F.col(names[0])) & (F.col(text_hash) == F.col(names[1]))
    joined = open_rows.join(distinct, same_row, "left")
    outside = joined.filter(F.col(names[1]).isNull())
    inside = joined.filter(F.col(names[1]).isNotNull() & column(id_col).eqNullSafe(F.col(names[2])))
    columns = [column(c) for c in docs.columns]
    return clear.select(*columns).unionByName(outside.select(*columns)).unionByName(
        inside.dropDuplicates([names[3]]).select(*columns)
    )
