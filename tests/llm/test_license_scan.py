import random
import re

import pytest

from evenkeel.llm.license_scan import NOTICES, PHRASES, SEPARATORS, license_scan, license_spans, run_hash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(SEPARATORS, (text or "").translate(LOWER)) if w]


def brute(text):
    w = words(text)
    places = [
        (i, label) for p, label in PHRASES.items() for n in [len(p.split())]
        for i in range(len(w) - n + 1) if w[i : i + n] == p.split()
    ]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    expected = {r.doc_id: brute(r.text) for r in docs.collect()}
    rows = license_scan(docs).collect()
    assert {r.doc_id: base(r) for r in rows} == expected and len(rows) == len(expected)
    assert any(e[1] for e in expected.values())
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_spark_hashes_runs_alike(spark):
    row = spark.sql("select xxhash64('gnu', 'général') as a, xxhash64('cc', 'by') as b").first()
    assert tuple(row) == (run_hash(["gnu", "général"]), run_hash(["cc", "by"]))


def test_phrases_that_meet_and_repeat(spark):
    texts = [
        "MIT License MIT LICENSE; mit-license", "cc by cc by by cc", "the gnu general public", "gnu general gnu general public license",
        "xcc by", "cc byé", "Apache\x00License ", "apache license", "CC\n\nBY-NC", "", None, "ſmit license", "K cc by",
    ]
    got = {r.doc_id: r for r in license_scan(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert base(got[i]) == brute(t), t


@pytest.mark.parametrize("label", sorted(NOTICES))
def test_notices_are_found_whole_and_with_changes(spark, label):
    notice = max(NOTICES[label], key=len)
    w = notice.split()
    changed = " ".join([*w[: len(w) // 2], "really", *w[len(w) // 2 :]])
    texts = [f"Some text before. {notice} And after.", notice.upper(), changed, " ".join(w[1:5]), " ".join(reversed(w))]
    got = {r.doc_id: r for r in license_scan(frame(spark, texts)).collect()}
    for i in (0, 1):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    if len(w) >= 30:
        assert label in got[2].labels.split(",")
    for i in (3, 4):
        assert label not in got[i].labels.split(",")


def edited(w, rng, n):
    """Words put in, taken out or replaced, not at the ends."""
    w = list(w)
    for _ in range(n):
        at = rng.randrange(1, len(w) - 1)
        w[at : at + 1] = rng.choice([["really", w[at]], [], ["really"]])
    return " ".join(w)


@pytest.mark.parametrize("label", sorted(NOTICES))
def test_edited_notices_are_found(spark, label):
    """One changed word in every notice of nine words or more, two in those of twenty; shorter ones must stand as they are."""
    rng = random.Random(label)
    texts, found = [], []
    for notice in NOTICES[label]:
        w = words(notice)
        for n, least in ((1, 9), (2, 20)):
            if len(w) >= least:
                texts += [f"Some text before. {edited(w, rng, n)} And after." for _ in range(12)]
                found += [n] * 12
    got = {r.doc_id: r.labels.split(",") for r in license_scan(frame(spark, texts or ["x"])).collect()}
    assert all(label in got[i] for i in range(len(texts)) if found[i] == 2)
    ones = [label in got[i] for i in range(len(texts)) if found[i] == 1]
    assert sum(ones) >= 0.75 * len(ones)


def test_the_better_of_two_notices_counts(spark):
    texts = ["licensed under the GNU General Public License, version 3", "licensed under the GNU General Public License, version 2", "Licensed under CC BY-NC 4.0",
             "Licensed under the Mozilla License, Version 2.0", "Licensed under CC BY 4.0. Released under the MIT License",
             "This is free software and you can use the software under the terms of any license as published by the other party"]
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in license_scan(frame(spark, texts)).collect()}
    assert got == {0: {"gpl", "gpl-3.0"}, 1: {"gpl", "gpl-2.0"}, 2: {"cc-by", "cc-by-nc-4.0"}, 3: set(), 4: {"cc-by", "cc-by-4.0", "mit"}, 5: set()}


def test_spans(spark):
    notice = NOTICES["bsd"][0]
    n = len(words(notice))
    spans = license_spans(frame(spark, [f"one two {notice} three {notice}", "nothing"])).filter("label = 'bsd'").collect()
    assert sorted((s.first_word, s.n_span, s.score) for s in spans) == [(2, n, 1.0), (n + 3, n, 1.0)]


def test_odd_rows(spark):
    rows = [(None, "cc by", 1), (7, "cc by", 1), (7, "cc by", 1), (8, None, None), (9, "mit license " * 50_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = sorted(((r.doc_id, r.n_base, r.last_word) for r in license_scan(docs).collect()), key=repr)
    assert got == sorted([(None, 1, 0), (7, 1, 0), (7, 1, 0), (8, 0, None), (9, 50_000, 99_998)], key=repr)
    assert license_scan(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = license_scan(frame(spark, ["a"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan


def test_templates_too_short(spark):
    with pytest.raises(ValueError, match="2 words"):
        license_scan(frame(spark, ["a"]), phrases={"mit": "mit"})
