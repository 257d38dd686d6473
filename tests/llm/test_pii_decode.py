"""Decoding of runs of windows against plain versions."""

import itertools
import random

import numpy as np

from touchline.llm import pii


def score(emit, trans, tags, before, after):
    total = sum(e[t] for e, t in zip(emit, tags)) + sum(trans[a, b] for a, b in zip(tags, tags[1:]))
    return total + (trans[0, tags[0]] if before else 0) + (trans[tags[-1], 0] if after else 0)


def test_best_path_against_all_paths():
    rng = np.random.default_rng(1)
    trans = rng.normal(size=(3, 3))
    lengths = np.array([5, 4, 4, 2, 1])
    emit = rng.normal(size=(5, 5, 3))
    before, after = np.array([1, 0, 1, 0, 1], dtype=bool), np.array([0, 1, 1, 0, 1], dtype=bool)
    tags = pii.best_path(emit, trans, lengths, before, after)
    for n, size in enumerate(lengths):
        every = itertools.product(range(3), repeat=int(size))
        want = max(every, key=lambda t: score(emit[n], trans, t, before[n], after[n]))
        assert tuple(tags[n, :size]) == want


def test_pieces_between_breaks_decode_like_the_whole_run():
    rng = np.random.default_rng(2)
    pick = random.Random(2)
    trans = rng.normal(size=(pii._TAGS, pii._TAGS)).astype(np.float32)
    for _ in range(20):
        text = "".join(pick.choice("1@a .\n") for _ in range(pick.randint(70, 400)))
        run = list(range(0, len(text) - pii.STRIDE, pii.STRIDE))
        scores = rng.normal(size=(len(run), pii.WINDOW, pii._TAGS)).astype(np.float32)
        pieces = []
        pii._decoded(text, run, scores, pieces)
        found = np.zeros(len(text), dtype=int)
        for n, tags in pii._paths(pieces, trans):
            found[pieces[n][0] : pieces[n][0] + len(tags)] = tags
        # the whole run at once, with the break's tag fixed by its scores
        mean, times = np.zeros((len(text), pii._TAGS)), np.zeros(len(text))
        for s, own in zip(run, scores):
            mean[s : s + pii.WINDOW] += own[: len(text) - s]
            times[s : s + pii.WINDOW] += 1
        end = min(len(text), run[-1] + pii.WINDOW)
        mean = mean[:end] / times[:end, None]
        for p in range(end):
            if text[p] == "\n":
                mean[p] = [0] + [-1e6] * (pii._TAGS - 1)
        no = np.array([False])
        whole = pii.best_path(mean[None].astype(np.float32), trans, np.array([end]), no, no)[0]
        assert found[:end].tolist() == whole.tolist()


def test_spans_of_tags():
    tags = np.array([0, 1, 2, 2, 0, 2, 3, 4, 1, 1, 2, 0, 8])
    assert pii.spans_of_tags(tags, 100) == [(101, 0, 104), (105, 0, 106), (106, 1, 108), (108, 0, 109), (109, 0, 111), (112, 3, 113)]
    assert pii.spans_of_tags(np.zeros(5, dtype=int), 0) == []


def test_spans_that_cross_no_base_span():
    pick = random.Random(4)
    for _ in range(300):
        base = sorted((s, 0, s + pick.randint(1, 9)) for s in (pick.randint(0, 60) for _ in range(pick.randint(0, 8))))
        cuts = sorted(pick.sample(range(80), 2 * pick.randint(0, 8)))
        more = [(a, 1, b) for a, b in zip(cuts[::2], cuts[1::2])]
        want = [(s, k, e) for s, k, e in more if not any(bs < e and s < be for bs, _, be in base)]
        assert pii.without_crossing(base, more) == want


def test_long_list_of_addresses():
    """Twelve thousand spans of either sort take one pass."""
    text = "\n".join(f"name{i}@example.org, 10.0.{i % 256}.{i % 200}" for i in range(6_000))
    tagger = pii.Tagger()
    found = pii.all_spans([text, ""], tagger)
    assert len(found[0][0]) == 12_000 and found[1] == ([], [])
    assert {s for s in found[0][1] if s in found[0][0]} == set(found[0][0])
