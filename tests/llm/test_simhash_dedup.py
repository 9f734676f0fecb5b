import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evenkeel.llm.common import reachable_by_workers
from evenkeel.llm.simhash_dedup import (
    GrayIndex, alike_texts, components, gray_rank, local_labels, one_of_each, shingle_hashes, simhash, simhash_dedup,
)
from tests_llm_helpers import brute_components


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, differing=2):
    """(doc_id, fingerprint, component_id) by all pairs of fingerprints."""
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    edges = [(a, a) for a in distinct] + [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= differing]
    of = brute_components(edges)
    ids = defaultdict(list)
    for (doc_id, _), p in zip(rows, prints, strict=True):
        ids[of[p]].append(doc_id)
    least = {c: min((i for i in own if i is not None), default=None) for c, own in ids.items()}
    return sorted(((d, f"{p:016x}", least[of[p]]) for (d, _), p in zip(rows, prints, strict=True)), key=repr)


def got(docs):
    return sorted((tuple(r)[:3] for r in simhash_dedup(docs).collect()), key=repr)


def near_prints(rng, n):
    """Fingerprints in clusters and chains."""
    found = {rng.getrandbits(64) for _ in range(max(1, n // 3))}
    while len(found) < n:
        p = rng.choice(list(found))
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        found.add(p)
    return list(found)


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    reachable_by_workers(spark)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert got(docs) == brute(rows)


def test_gray_rank(spark):
    rows = [(i, i ^ i >> 1) for i in [0, 1, 2, 3, 1000, (1 << 62) + 5, (1 << 63) + 9, (1 << 64) - 1]]
    signed = [(n, c - (1 << 64) if c >> 63 else c) for n, (_, c) in enumerate(rows)]
    df = spark.createDataFrame(signed, "n int, code long").orderBy(gray_rank(F.col("code")))
    assert [r.n for r in df.collect()] == list(range(len(rows)))


@pytest.mark.parametrize("n,fan,differing", [(1, 4, 2), (5, 4, 2), (300, 4, 2), (300, 16, 3), (2000, 16, 1)])
def test_index_finds_all(n, fan, differing):
    rng = random.Random(n + differing)
    prints = near_prints(rng, n)

    def rank(x):
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> s
        return x

    prints = np.array(sorted(prints, key=rank), np.uint64)
    queries = np.concatenate([prints[:200], np.array([rng.getrandbits(64) for _ in range(20)], np.uint64)])
    q, node = GrayIndex(prints, fan).within(queries, differing)
    found = set(zip(q.tolist(), node.tolist(), strict=True))
    near = np.bitwise_count(queries[:, None] ^ prints[None, :]) <= differing
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True)) and len(found) == len(q)


def test_index_prunes():
    """Groups that are far are left: most comparisons are with nodes, not with fingerprints."""
    rng = np.random.default_rng(1)
    prints = np.sort(rng.integers(0, 1 << 20, 4000, dtype=np.uint64) << np.uint64(44))
    prints = np.unique(prints)
    compared = []
    index = GrayIndex(prints)
    count = np.bitwise_count
    try:
        np.bitwise_count = lambda x: (compared.append(x.size), count(x))[1]
        index.within(prints[:50], 2)
    finally:
        np.bitwise_count = count
    assert sum(compared) < 0.7 * 50 * len(prints)


@pytest.mark.parametrize("n,differing", [(400, 2), (400, 3), (1500, 2)])
def test_components_of_fingerprints(spark, n, differing):
    prints = near_prints(random.Random(n), n)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    expected = brute_components([(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if (a ^ b).bit_count() <= differing or ((a ^ b) & (1 << 64) - 1).bit_count() <= differing])
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    assert {r.node: r.component for r in components(frame, differing).collect()} == expected


def test_local_labels_of_a_dense_group():
    base = random.Random(1).getrandbits(64)
    prints = np.array([base ^ (1 << i) for i in range(60)], np.uint64)
    assert set(local_labels(prints, 2, block=7)) == {0}


def test_odd_rows(spark):
    long = "some words of a text that is rather long " * 8_000
    rows = [(None, None), (5, ""), (9, " \n\t"), (None, "only nulls here"), (None, "only nulls here"), (3, "Two Words"), (4, "two  words"), (3, "Two Words"), (7, long), (8, long + "x"), (6, "İ x ſ")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component int")
    assert got(docs) == brute(rows)
    assert simhash_dedup(docs.limit(0)).collect() == []


def test_one_of_each(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = sorted({c for _, _, c in brute(rows)})
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == expected

    twice = docs.unionByName(docs).withColumn("rows", F.lit(1)).withColumn("doubtful_id", F.lit(2))
    assert sorted(r.doc_id for r in one_of_each(twice).collect()) == expected
    odd = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "d e f"), (1, "D E F"), (2, None), (3, "")], "doc_id long, text string")
    assert sorted((r.doc_id for r in one_of_each(odd).collect()), key=repr) == sorted([None, 1, 2], key=repr)
    assert one_of_each(docs.limit(0)).collect() == []


# --- texts that are alike ------------------------------------------------------------------------


def five_words(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def alike_components(rows, differing=11, least=0.8):
    """Each id's smallest one over links by fingerprint and Jaccard similarity; without ``differing`` by the latter alone."""
    sets = [five_words(t) for _, t in rows]
    prints = [simhash(shingle_hashes((t or "").encode(), 5)) & (1 << 64) - 1 for _, t in rows]
    edges = [(i, i) for i in range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            if differing is None or (prints[i] ^ prints[j]).bit_count() <= differing:
                if min(len(sets[i]), len(sets[j])) >= least * max(len(sets[i]), len(sets[j])) and jaccard(sets[i], sets[j]) >= least:
                    edges.append((j, i))
    of = brute_components(edges)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[of[i]] = min((x for x in (low.get(of[i]), doc) if x is not None), default=None)
    return {rows[i][0]: low[of[i]] for i in range(len(rows))}


def found_components(spark, rows):
    reachable_by_workers(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as key")
    return {r.doc_id: r.component_id for r in alike_texts(docs).collect()}


def edited_texts(rng, n):
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(3000)]
    rows = []
    for i in range(0, n, 2):
        w = rng.choices(vocabulary, k=rng.choice([40, 120, 300, 900]))
        rows.append((i, " ".join(w)))
        for _ in range(rng.randint(1, max(1, len(w) // 60))):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choices(vocabulary, k=rng.choice([0, 1, 1, 2]))
        rows.append((i + 1, " ".join(w).title()))
    return rows


def test_alike_texts_against_all_pairs(spark):
    rows = edited_texts(random.Random(1), 200) + [(1000 + i, "the same long text with one word of it put in place of " * 9 + f"another {i % 7}") for i in range(90)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "few words"), (2004, "Few  Words"), (None, rows[0][1])]
    assert found_components(spark, rows) == alike_components(rows)
    assert found_components(spark, []) == {}


def test_nine_of_ten_alike_texts_are_found(spark):
    """Against Jaccard similarity alone."""
    rows = edited_texts(random.Random(2), 600)
    wanted = {i for i, c in alike_components(rows, None).items() if i != c}
    found = {i for i, c in found_components(spark, rows).items() if i != c}
    assert len(wanted) > 150 and found <= wanted and len(found) >= 0.9 * len(wanted), (len(found), len(wanted))
