"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest

from touchline.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        own[i] = min(own.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in own.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in whole.items() if i != a and len(w) == len(v)
        )
        for ps, p, _ in [s for s in scores if s[2]][:positives]:
            fits = [(i, -s) for s, i, same in scores if not same and low * -ps <= 100 * -s <= high * -ps][:negatives]
            out += [(a, p, n + 1, i, -ps, s) for n, (i, s) in enumerate(fits)]
    return sorted(out)


def clustered(seed, n, dim, every=10):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, dim))
    at = pick.integers(0, 6, n)
    v = centres[at] + pick.normal(size=(n, dim)) * 0.3
    return [(i, [float(x) for x in v[i]], int((at[i] + pick.integers(0, 2)) % 4)) for i in range(n)]


def mined(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hn.hard_negatives(df, **more).collect())


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(hn, "PART_ROWS", 300)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 20)
    rows = clustered(1, 900, 8)
    assert mined(spark, rows, every=20) == plain(rows, every=20)


def test_ties_and_rows_that_take_no_part(spark):
    same = [1.0, 0.5]
    rows = [(i, same, i % 3) for i in range(0, 60)] + [(i, [0.5, 0.25], 1) for i in range(60, 90)]
    rows += [(100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 1), (500, [], 1)]
    rows += [(600, same, None), (None, same, 1), (700, [0.0, 0.0], 2), (800, [1.0, 2.0, 3.0], 1), (801, [1.0, 1.0, 1.0], 1)]
    rows += [(802, [0.5, 0.5, 0.5], 2), (900, [-1.0, -1.0], 1), (0, [9.0, 9.0], 9), (0, same, 0), (1000, [9.0, 0.0], 1), (1000, [0.0, 9.0], 1)]
    got = mined(spark, rows)
    assert got == plain(rows) and any(r[0] == 800 for r in got)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_extra_columns(spark):
    rows = clustered(2, 120, 3)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", `rank` string, v int, score string")
    assert sorted(tuple(r) for r in hn.hard_negatives(df, every=10).collect()) == plain(rows, every=10)


@pytest.mark.parametrize("dim", [2, 16, 64])
def test_bounds_hold_every_score(dim):
    pick = np.random.default_rng(dim)
    v = np.concatenate([
        np.floor(256 * (pick.normal(size=(400, dim)))), np.zeros((2, dim)), np.full((3, dim), 2.0**20), -np.full((3, dim), 2.0**20),
    ]).astype(np.int64)
    units = hn.directions(v[:300].astype(np.float64))
    norms, angles = hn.angles_to(v, units)
    anchors = hn.Vectors(np.arange(len(v)), np.zeros(len(v)), v, norms, angles)
    bottom, top = hn.score_bounds(anchors, angles, angles, norms, norms)
    exact = hn.products(v, v)
    assert (bottom <= exact).all() and (exact <= top).all()


def test_filter_leaves_products_out():
    """Rows of clusters far from an anchor meet it in no product."""
    rows = clustered(3, 4_000, 8)
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    norms, angles = hn.angles_to(v, hn.directions(v[:500].astype(np.float64)))
    order = np.lexsort((angles.min(1), angles.argmin(1)))
    all_rows = hn.Vectors(order, np.array([r[2] for r in rows])[order], v[order], norms[order], angles[order])
    first = hn.Vectors(*(x[:100] for x in (all_rows.ids, all_rows.labels, all_rows.v, all_rows.norms, all_rows.angles)))
    search = hn.WindowSearch(first, np.full((100, 1), -(2**63)), np.full((100, 1), 2**63 - 1), True, 5)
    search.add(all_rows)
    assert search.scored < search.pairs / 2
