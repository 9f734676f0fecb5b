"""Collocations against plain counting; the summaries' promise by itself."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from evenkeel.llm import collocations as col
from evenkeel.llm.common import reachable_by_workers

SCHEMA = "doc_id long, text string, lang string, phrase string, rank int, size int"


def brute(rows, longest=3, least=10, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    found = []
    for lang, of in f.items():
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 50 * of[p[i : i + k]]:
                        gone.add(p[i : i + k])
        scores = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min((10**6 * a * a // (of[p[:k]] * of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p)))
                scores.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scores)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def got(spark, rows, **options):
    reachable_by_workers(spark)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in col.collocations(df, **options).collect())


def prose(rng, n, words=40, length=60):
    vocabulary = ["".join(rng.choices("abcdeÄß中", k=rng.randint(1, 4))) for _ in range(words)]
    glue = [" "] * 12 + ["  ", "\t", ", ", ". ", "\n", " - ", " "]
    return ["".join(rng.choice(vocabulary).title() + rng.choice(glue) for _ in range(length)) for _ in range(n)]


@pytest.mark.parametrize("longest,top", [(3, 2000), (3, 5), (2, 2000), (5, 50)])
def test_against_plain_counting(spark, longest, top):
    rng = random.Random(longest)
    rows = [(i, t, rng.choice(["en", "de", None, "und", ""])) for i, t in enumerate(prose(rng, 250, 25))]
    expected = brute(rows, longest, 10, top)
    assert len(expected) >= min(top, 20) and got(spark, rows, longest=longest, top=top) == expected


def test_odd_rows(spark):
    phrase = "New York, new york! NEW york. Ünder Über"
    rows = [(None, None, None), (1, "", "en"), (2, " \t\n.", "en"), (3, phrase, "en"), (3, phrase, "en")] + [(9, "hot hot hot hot hot hot", "x")] * 40
    rows += [(4, "tab\tbed tab  bed tab bed", None)] * 5 + [(5, "a b " * 60_000, "long"), (6, "w" * 300_000 + " a b", "long")]
    expected = brute(rows)
    assert got(spark, rows) == expected and {r[0] for r in expected} == {"x", "und", "long"}
    assert got(spark, []) == [] and got(spark, rows[:3]) == []


@pytest.mark.parametrize("most", [1, 7, 50, 10**6])
def test_windows_lose_and_repeat_nothing(most):
    rng = random.Random(most)
    texts = [*prose(rng, 12, 10, 40), "", "   ", "w" * 200, "one"]
    found, seeds = Counter(), np.zeros(1, np.uint64)
    words = 0
    for parts, langs, new in col.windows(iter((0, t.encode()) for t in texts), 3, most):
        grams = col.Grams(parts, langs, new, seeds, 3)
        words += int(grams.words.sum())
        for n, first in enumerate(grams.first, 1):
            found.update(p.decode() for p in grams.phrases(n, first))
    expected, total = Counter(), 0
    for t in texts:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(c.lower() if c.isascii() else c for c in t)):
            w = re.findall("[^ \t]+", piece)
            total += len(w)
            expected.update(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert found == expected and words == total


@pytest.mark.parametrize("hot", [0, 50_000])
def test_a_summary_keeps_all_that_is_frequent(hot):
    """With a capacity of the mass divided by the threshold, parts in any order, and a counter far above the others."""
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 60_000, 150_000), rng.integers(0, 2_000, 30_000), np.full(hot, 7)]).astype(np.uint32)
    rng.shuffle(keys)
    true = np.bincount(keys, minlength=60_000)
    summary = col.Summary(180_000 // 10 + 1, 10)
    for part in np.array_split(keys, 40):
        k, c = col._folded(part)
        summary.merge(k, c)
    survivors = set(summary.survivors().tolist())
    assert 0 < summary.taken < 10 and survivors >= set(np.flatnonzero(true >= 10).tolist())
    assert len(summary.keys) < (true > 0).sum()


def test_a_reduction_that_would_lose_something_is_not_made():
    summary = col.Summary(10, 10)
    keys = np.arange(70_000, dtype=np.uint32)
    summary.merge(keys, np.full(len(keys), 10))
    assert summary.taken == 0 and len(summary.survivors()) == len(keys)


def test_equal_first_hashes_are_told_apart(spark, monkeypatch):
    """Both hashes of a word decide; with a first hash that is the same for all, counts are still right."""

    class Poor(col.WordHash):
        def __call__(self, text, start, end):
            return (end - start).astype(np.uint64)

    rows = prose(random.Random(8), 30, 6, 40)
    parts, langs, new = next(col.windows(iter((0, t.encode()) for t in rows), 2, 10**6))

    class Value:
        value = np.full(1 << 12, 255, np.uint8)

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(rows)), pa.array(rows)], names=["lang", "text"])
    monkeypatch.setattr(col, "_HASHES", (Poor(3), col.WordHash(0xC2B2AE3D27D4EB4F)))
    found = Counter()
    for out in col._counted(2, 0, Value)(iter([batch])):
        for lang, size, phrase, f in zip(*(c.to_pylist() for c in out.columns)):
            found[phrase.decode()] += f
    grams = col.Grams(parts, langs, new, np.zeros(1, np.uint64), 2)
    assert found == Counter(p.decode() for n, first in enumerate(grams.first, 1) for p in grams.phrases(n, first))
