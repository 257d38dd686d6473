"""Joins and searches against brute force."""

import math
import os
import random

import numpy as np
import pytest
from compare import difference
from pyspark.sql import functions as F

from touchline.llm import ann_codes, license_scan, ngram_join, topk_exact
from touchline.llm.components import connected
from touchline.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), SF, ORACLES[name]) is None


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in sets}


def near_copies(seed, n):
    """Groups of copies with few and with many edits, chains of edits, shared
    passages, and short texts."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n // 12):
        base = [word() for _ in range(pick.choice([4, 5, 6, 8, 9, 20, 60, 150, 400]))]
        for _ in range(8):
            edited = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 25))):
                edited[pick.randrange(len(edited))] = word()
            texts.append(edited)
            if pick.random() < 0.3:
                base = edited
        texts.append(base + [word() for _ in range(len(base) // 4)])
        texts.append(passage + [word() for _ in range(pick.choice([3, 10, 40]))])
        texts.append([word() for _ in range(pick.randint(0, 7))])
        texts.append(base)
    pick.shuffle(texts)
    return [(7 * i % (len(texts) + 1) * 3 + i % 2, pick.choice([" ", "\n", "  "]).join(t)) for i, t in enumerate(texts)]


def test_ngram_join_equals_brute_force(spark):
    rows = near_copies(3, 360)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows)
    got = {r["doc_id"]: r for r in ngram_join.jaccard_join(docs).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(shingles(t)) for i, t in rows)


def test_too_few_filled_blocks_still_meet(monkeypatch):
    """With few blocks, sets fall back on their equal empty blocks."""
    monkeypatch.setattr(ngram_join, "blocks_of", lambda level: 4 ** (level + 1) // 3 + 2)
    rng = np.random.default_rng(1)
    counters = rng.integers(0, 50, ngram_join._COUNTERS)
    fallen = 0
    for _ in range(600):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        lost = int(rng.integers(0, n // 4 + 1))
        b = np.unique(np.concatenate([a[lost:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        a = np.unique(a)
        shared = len(np.intersect1d(a, b))
        fallen += any(len(ngram_join._filled(a, v)[1]) <= ngram_join.most_differences(len(a), v) for v in ngram_join._levels(len(a)))
        if 4 * shared >= 3 * (len(a) + len(b) - shared):
            assert len(np.intersect1d(ngram_join.join_keys(a, counters), ngram_join.join_keys(b, counters)))
    assert fallen


def test_ngram_join_on_awkward_rows(spark, odd, none):
    rows = ngram_join.jaccard_join(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[1] == by[2].copy() or by[1] == [(0, 1)]
    assert by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(1, 4)]
    assert by[5] == [(2, 5)] and by[6] == [(2, 5)]  # case and white space do not count
    assert by[9] == [(2, 9), (2, 9)] or {c for _, c in by[9]} == {9}
    assert all(c is None for _, c in by[None])
    assert ngram_join.jaccard_join(none).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f g"), (1, "h i j k l m"), (2, "h i j k l m"), (3, "a b c d e f g")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_join(twice).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_components(spark):
    pick = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 90)] + [(pick.randrange(200, 400), pick.randrange(200, 400)) for _ in range(120)] + [(5, 5)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {i: find(i) for a, b in edges if a != b for i in (a, b)}
    got = connected(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# --- vectors ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(float).tolist(), "x") for i in range(700)]
    rows += [(i, rows[3][1], "x") for i in range(700, 1000)]  # a third are one vector
    rows += [(1000, None, "x"), (1020, [None] * 16, "x"), (1040, [float("nan")] * 16, "x"), (1060, [math.inf] * 16, "x"),
             (1080, [0.0] * 16, "x"), (1100, [], "x"), (None, rows[0][1], "x"), (1120, [1.0, 2.0], "x"), (1121, [3.0, 1.0], "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)


def valid(rows, zero):
    return {
        r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows
        if r["vec_id"] is not None and r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"])
        and (zero or any(r["embedding"]))
    }


def brute(vs, k, integers):
    if integers:
        vs = {i: np.floor(64 * v) for i, v in vs.items()}
    out = {}
    for q, a in vs.items():
        if q % 20 == 0:
            scored = sorted((-float(a @ b), i) for i, b in vs.items() if i != q and len(a) == len(b))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: r for q, r in out.items() if r}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(got) + 1
        got.append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("rows", [100, 16_384])
def test_exact_top_k(monkeypatch, spark, vectors, rows):
    monkeypatch.setattr("touchline.llm.vector_blocks.SHARD_ROWS", rows)
    monkeypatch.setattr("touchline.llm.vector_blocks.BLOCK_QUERIES", 20 if rows == 100 else 4096)
    want = brute(valid(vectors.collect(), True), 20, True)
    assert found(topk_exact.exact_top_k(vectors)) == want
    assert topk_exact.exact_top_k(vectors.limit(0)).count() == 0


def test_branch_and_bound_with_large_components():
    rng = np.random.default_rng(4)
    x = rng.integers(-(1 << 28), 1 << 28, (300, 8))
    ids = np.arange(300) * 3
    rows, got, scores = topk_exact.search(ids, x, ids[:10], x[:10], np.full(10, -np.inf), 5)
    for q in range(10):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], v)), i) for i, v in zip(ids.tolist(), x) if i != ids[q])[:5]
        assert [(-s, i) for s, i in exact] == list(zip(scores[rows == q].tolist(), got[rows == q].tolist()))


@pytest.mark.parametrize("rows", [100, 16_384])
def test_approximate_top_k(monkeypatch, spark, vectors, rows):
    monkeypatch.setattr("touchline.llm.vector_blocks.SHARD_ROWS", rows)
    vs = valid(vectors.collect(), False)
    want = brute(vs, 20, False)
    got = found(ann_codes.approximate_top_k(vectors))
    assert set(got) == set(want)
    hit = total = 0
    for q, rows_ in got.items():
        assert len(rows_) == len(want[q]) and all(s == pytest.approx(float(vs[q] @ vs[i]), abs=1e-9) for i, s in rows_)
        least = want[q][-1][1] - 1e-9
        hit += sum(s >= least for _, s in rows_)
        total += len(rows_)
    assert hit / total >= 0.95
    assert ann_codes.approximate_top_k(vectors.limit(0)).count() == 0


def test_error_bound_of_codes():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(2000, 64)), rng.normal(size=(30, 64))
    turn = ann_codes.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes = ann_codes.Codes(x, turn)
    guess, error = codes.estimate(slice(0, 2000), (q @ turn.T).astype(np.float32), q @ codes.mean, np.sqrt((q**2).sum(1)))
    exact = q @ x.T
    assert (np.abs(guess - exact) <= error).mean() > 0.97 and abs((guess - exact).mean()) < 0.1


def test_repeated_ids_take_part_once(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(20, [9.0, 9.0, 9.0, 9.0]), (20, rows[20][1]), (31, [-9.0] * 4), (31, rows[31][1]), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    own = {}
    for i, v in rows:
        own[i] = min(own.get(i, v), v)
    vs = {i: np.array(v) for i, v in own.items()}
    assert found(topk_exact.exact_top_k(df, k=5)) == brute(vs, 5, True)
    got, want = found(ann_codes.approximate_top_k(df, k=5)), brute(vs, 5, False)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_bit_planes_give_the_rounded_products(dim):
    rng = np.random.default_rng(dim)
    x, q = rng.normal(size=(50, dim)), rng.normal(size=(7, dim)).astype(np.float32)
    codes = ann_codes.Codes(x, ann_codes.rotation(dim))
    signs = np.unpackbits(codes.packed, axis=1, count=dim, bitorder="little").astype(np.float64) * 2 - 1
    planes = ann_codes.Planes(q)
    levels = np.rint((q - planes.low[:, None]) / planes.step[:, None])
    rounded = planes.low[:, None] + levels * planes.step[:, None]
    assert np.allclose(planes.sums(codes.words, codes.ones), rounded @ signs.T, atol=1e-3)
    assert (np.abs(rounded - q) <= planes.step[:, None] / 2 + 1e-5).all()


# --- licenses --------------------------------------------------------------------


def test_templates_of_any_length(spark):
    """Blocks against templates of 3 to 150 words, against a plain version."""
    pick = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    templates = [(f"t{n}", " ".join(pick.choice(words) for _ in range(n))) for n in (3, 10, 40, 70, 150)]
    texts = []
    for i in range(80):
        text = [pick.choice(words[:200]) for _ in range(pick.randint(0, 300))]
        _, template = pick.choice(templates)
        own = [w for w in template.split() if pick.random() > pick.choice([0.0, 0.1, 0.2])]
        at = pick.randint(0, len(text))
        texts.append((i, " ".join(text[:at] + own + text[at:])))
    found_ = license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), templates=templates)
    got = {r["doc_id"]: (sorted(r["found"]), round(r["score"], 9)) for r in found_.collect()}
    for i, text in texts:
        ws, labels, best = text.split(), [], 0.0
        for label, template in templates:
            own, stride = set(template.split()), max(32, 1 << (len(template.split()) - 1).bit_length())
            need = math.ceil(0.85 * len(own) - 1e-9)
            most = max((len(own & set(ws[at : at + 2 * stride])) for at in range(-stride, len(ws), stride) for at in [max(at, 0)]), default=0)
            first = len(own & set(ws[:stride]))
            most = max(most, first)
            if most >= need:
                labels.append(label)
                best = max(best, most / len(own))
        assert got[i] == (sorted(labels), round(best, 9)), i
    assert sum(bool(labels) for labels, _ in got.values()) > 20
    empty = license_scan.scan_licenses(spark.createDataFrame(texts[:3], "doc_id long, text string"), templates=[])
    assert {tuple(r["found"]) for r in empty.collect()} == {()}
