import hashlib
from collections import defaultdict

import pytest

from evenkeel.llm.exact_dedup import exact_dedup


def brute(rows):
    same = defaultdict(list)
    for doc_id, text in rows:
        same[text or ""].append(doc_id)
    return same


@pytest.mark.parametrize("prefix", [1, 256])
def test_documents(spark, sf_dir, prefix):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    same = brute(rows)
    got = {r.doc_id: r for r in exact_dedup(docs, prefix=prefix, every_digest=True).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        keep = max(same[text])
        assert tuple(got[doc_id]) == (doc_id, keep, len(same[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest())


def test_content_is_hashed_only_where_it_must_be(spark):
    rows = [(1, "a" * 300), (2, "a" * 300), (3, "a" * 299 + "b"), (4, "b" * 300), (5, "short")]
    got = {r.doc_id: r for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.text_sha256 is not None for i, r in got.items()} == {1: True, 2: True, 3: True, 4: False, 5: False}
    assert [got[i].group_size for i in range(1, 6)] == [2, 2, 1, 1, 1]


def test_odd_rows(spark):
    rows = [(None, None, "k"), (1, "", "k"), (2, "x", None), (2, "x", "k"), (None, "y", "k"), (None, "y", "k"), (3, "é" * 200_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep string").withColumnRenamed("keep", "keep_id")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()), key=repr)
    assert got == sorted([
        (None, 1, 2, False), (1, 1, 2, True), (2, 2, 2, True), (2, 2, 2, False), (None, None, 2, True), (None, None, 2, False),
        (3, 3, 1, True),
    ], key=repr)
    assert exact_dedup(docs.limit(0)).collect() == []


def test_one_hot_text(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 2 = 0, 'same', 'own ' || id) as text")
    got = exact_dedup(docs)
    assert got.filter("kept").count() == 10_001
    assert {tuple(r) for r in got.filter("group_size > 1").select("keep_id", "group_size").distinct().collect()} == {(19_998, 10_000)}
