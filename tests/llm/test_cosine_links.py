"""Cosine links against all pairs."""

import math
import random

import numpy as np
import pytest

from evenkeel.llm import cosine_links as links
from evenkeel.llm.common import reachable_by_workers
from tests_llm_helpers import brute_components

SCHEMA = "vec_id long, embedding array<double>, node string, n int"


def brute(rows, least=0.9):
    ok = [x is not None and len(x) > 0 and all(v is not None and math.isfinite(v) for v in x) and any(x) for _, x in rows]
    unit = [np.array(x) / max(map(abs, x)) if good else None for (_, x), good in zip(rows, ok)]
    unit = [None if u is None else u / np.sqrt((u * u).sum()) for u in unit]
    edges, n = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and (unit[i] * unit[j]).sum() >= least:
                edges.append((j, i))
                n[i] += 1
                n[j] += 1
    of = brute_components(edges)
    low = {}
    for i, (v, _) in enumerate(rows):
        c = of.get(i, i)
        low[c] = min((a for a in (low.get(c), v) if a is not None), default=None)
    found = [low[of.get(i, i)] for i in range(len(rows))]
    return sorted(((v, n[i], found[i], v is not None and v == found[i]) for i, (v, _) in enumerate(rows)), key=repr)


def got(spark, rows, schema=SCHEMA, **options):
    reachable_by_workers(spark)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    return sorted((tuple(r) for r in links.cosine_links(df, **options).collect()), key=repr)


def vectors(rng, n, around, width, d=64):
    middles = [rng.normal(size=d) for _ in range(around)]
    return [(i, (middles[i % around] + width * rng.normal(size=d)).tolist()) for i in range(n)]


@pytest.mark.parametrize("cell", [10_000, 20])
def test_against_all_pairs(spark, cell):
    """Groups whose cosines lie on both sides of the limit, and a hot group; small cells are cut and sliced."""
    rng = np.random.default_rng(1)
    rows = vectors(rng, 240, 30, 0.33) + [(1000 + i, v) for i, v in vectors(rng, 120, 1, 0.2)]
    expected = brute(rows)
    assert 0 < sum(n for _, n, _, _ in expected[:240]) and len({c for _, _, c, _ in expected}) > 30
    assert got(spark, rows, cell=cell) == expected


@pytest.mark.parametrize("d", [1, 2, 3, 7, 100])
def test_other_dimensions(spark, d):
    rows = vectors(np.random.default_rng(d), 90, 8, 0.3, d)
    assert got(spark, rows, cell=16) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 20, 5, 0.1) + vectors(rng, 6, 2, 0.1, 32)
    x = rows[0][1]
    odd = [(100, None), (101, []), (102, [0.0] * 64), (103, [math.nan, *x[1:]]), (104, [math.inf, *x[1:]]), (105, [None, *x[1:]]),
           (0, x), (0, x), (None, x), (None, [-v for v in x]), (None, None), (-7, [1e200 * v for v in x]), (106, [1e-200 * v for v in x]), (107, [-v for v in x])]
    assert got(spark, rows + odd) == brute(rows + odd)
    assert got(spark, []) == [] and got(spark, odd[:3]) == brute(odd[:3])


def test_floats_are_taken_as_they_are(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.float32(x).astype(float).tolist()) for i, x in vectors(rng, 100, 10, 0.33)]
    assert got(spark, rows, SCHEMA.replace("double", "float")) == brute(rows)


def test_every_linked_pair_meets_in_a_block():
    """Cells reached by a ball hold all vectors within its budget, and blocks share out the whole budget."""
    rng = np.random.default_rng(5)
    rotation = links.Rotation(64, 4, 0.9)
    assert sum(rotation.budgets) == pytest.approx(0.2, abs=1e-8)
    x = rng.normal(size=(600, 64))
    x[300:] = x[:300] + 0.3 * rng.normal(size=(300, 64))
    unit = rotation.unit(x)
    turned = rotation(unit)
    assert np.allclose(unit @ unit.T, turned @ turned.T)
    assert (rotation(unit[5:6]) == turned[5:6]).all()
    linked = np.argwhere(np.triu(unit @ unit.T >= 0.9, 1))
    assert len(linked) > 100
    met = np.zeros(len(linked), bool)
    for of, budget in zip(rotation.blocks, rotation.budgets):
        tree = links.Cells.of(turned[:200, of], 5)
        home, row, cell = tree.reached(turned[:, of], budget)
        reached = set(zip(row.tolist(), cell.tolist()))
        assert all((i, h) in reached for i, h in enumerate(home.tolist()))
        near = ((turned[linked[:, 0]][:, of] - turned[linked[:, 1]][:, of]) ** 2).sum(axis=1) <= budget
        assert all((a, home[b]) in reached and (b, home[a]) in reached for a, b in linked[near].tolist())
        met |= near
        assert len(reached) < 600 * 32
    assert met.all()
