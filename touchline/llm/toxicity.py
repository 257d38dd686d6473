"""Toxicity: Levenshtein automata against a lexicon trie, scored in context.

The lexicon is learned: words that stand in toxic documents far more often than
chance allows. A trie holds it. Each distinct word of a text runs through the
trie with the rows of its Levenshtein automaton, which finds terms within one
edit (two for long terms) in one walk. So do words joined by a digit or symbol,
which disguises a term. A term's hits count apart by what stands
around them: quotation marks and reporting words, or direct address. A logistic
model on these counts, fitted on the same bounded sample, gives the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import bounded_ids, held_out, map_texts, rows_of_ids, worker_cache

_WORD = re.compile(r"[^\W\d_]+")
# One or two digits or symbols between letters. A term has letters only, so with
# two edits a disguised one has no more than two of them.
_INNER = re.compile(r"(?<=[^\W\d_])(?:[\W\d_](?<!\s)){1,2}(?=[^\W\d_])")
_QUOTES = "\"'«»“”„‘’‹›"

# Words of reporting, and of direct address, in four languages.
REPORTING = frozenset(
    "said says quoted quote wrote called word term sagte schrieb zitat wort dit citation mot dijo cita palabra".split()
)
ADDRESS = frozenset("you your youre u du dich dein deine ihr tu toi vous ton votre tú usted ustedes".split())

#: Words to either side of a hit that count as its context.
CONTEXT = 5
MEMO_WORDS = 100_000

#: Least log odds of a term. Clean documents may quote a term now and then; what
#: chance alone explains is ruled out by the likelihood ratio.
LEAST_ODDS = 2.0

FEATURES = ("bias", "strongest", "exact", "exact_quoted", "near", "near_quoted", "addressed", "rate")


def edits_allowed(term: str) -> int:
    """Short words differ from others by one letter too easily."""
    return 0 if len(term) < 5 else 1 if len(term) < 12 else 2


def _shortened(word: str) -> set[str]:
    """The word, and the word without one of its letters. Two words within one
    edit of each other have one of these in common."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def _letter_bits(word: str) -> int:
    """The letters of a word as a bit set. Each edit adds one bit at most, and
    takes one away at most."""
    bits = 0
    for ch in word:
        bits |= 1 << (ord(ch) & 63)
    return bits


def _within_two(word: str, where: dict[str, int], term: str) -> bool:
    """Whether the word's automaton, as in ``Lexicon.nearest``, accepts the term."""
    whole, r0, r1, r2 = (2 << len(word)) - 1, 1, 3, 7
    for ch in term:
        here = where.get(ch, 0)
        n0 = (r0 & here) << 1
        n1 = (r1 & here) << 1 | r0 << 1 | r0 | n0 << 1
        r2 = ((r2 & here) << 1 | r1 << 1 | r1 | n1 << 1) & whole
        if not r2:
            return False
        r0, r1 = n0, n1 & whole
    return bool(r2 >> len(word))


def _letter_places(word: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, ch in enumerate(word):
        where[ch] = where.get(ch, 0) | 1 << i
    return where


class Lexicon:
    """Terms with weights, as a trie, and the pieces of terms by length of word.

    A word within one edit of a term has its first or its second half unchanged,
    and the other half shares a shortened form. A word within two edits has one
    of three pieces unchanged: the first at its start, the last at its end, the
    middle one shifted by at most two; and it has at most two letters the term
    lacks, and lacks at most two. A word of which this is not true, or that no long
    term of such a piece is near to, needs no walk with two edits.
    """

    def __init__(self, terms: dict[str, float]) -> None:
        self.terms = terms
        self.trie: dict = {}
        # by length of word: (start, end) of a half -> half -> shortened forms of the other
        self.halves: dict[int, dict[tuple[int, int], dict[str, set[str]]]] = {}
        # by length of word: (start, end) of a third -> third -> long terms, with their letters
        self.thirds: dict[int, dict[tuple[int, int], dict[str, dict[str, int]]]] = {}
        self.memo: dict[str, tuple[str, int] | None] = {}
        for term in terms:
            node = self.trie
            for ch in term:
                node = node.setdefault(ch, {})
            node[""] = term
            k, n, cut = edits_allowed(term), len(term), len(term) // 2
            if k == 2:
                self._add_thirds(term)
            for size in (n - 1, n, n + 1) if k == 1 else ():
                known = self.halves.setdefault(size, {})
                known.setdefault((0, cut), {}).setdefault(term[:cut], set()).update(_shortened(term[cut:]))
                low = size - n + cut
                known.setdefault((low, size), {}).setdefault(term[cut:], set()).update(_shortened(term[:cut]))

    def _add_thirds(self, term: str) -> None:
        n, cut, letters = len(term), len(term) // 3, _letter_bits(term)
        tail = n - 2 * cut
        for size in range(n - 2, n + 3):
            known = self.thirds.setdefault(size, {})
            places = [(0, term[:cut]), (size - tail, term[2 * cut :])]
            places += [(start, term[cut : 2 * cut]) for start in range(cut - 2, cut + 3)]
            for start, piece in places:
                known.setdefault((start, start + len(piece)), {}).setdefault(piece, {})[term] = letters

    def _edits_to_try(self, word: str) -> int:
        """The edits a walk must allow to find all terms; 0 when it finds none."""
        letters = where = None
        for (start, end), known in self.thirds.get(len(word), {}).items():
            held = known.get(word[start:end])
            if held:
                letters = letters or _letter_bits(word)
                for term, t in held.items():
                    if (t & ~letters).bit_count() <= 2 and (letters & ~t).bit_count() <= 2:
                        where = where or _letter_places(word)
                        if _within_two(word, where, term):
                            return 2
        for (start, end), known in self.halves.get(len(word), {}).items():
            rests = known.get(word[start:end])
            if rests and not rests.isdisjoint(_shortened(word[:start] + word[end:])):
                return 1
        return 0

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The best term within its allowed edits, and the edits: fewest edits,
        then the heaviest, then the first in order.

        The states of the word's automaton are bit sets: bit i of the j-th one
        says that i letters of the word are read with j edits at most.
        """
        if word in self.terms:
            return word, 0
        most = self._edits_to_try(word)
        if not most:
            return None
        n = len(word)
        whole, last = (2 << n) - 1, 1 << n
        where = _letter_places(word)
        best = None
        stack = [(self.trie, 1, 3 & whole, 7 & whole)]
        while stack:
            node, r0, r1, r2 = stack.pop()
            for ch, child in node.items():
                if not ch:
                    continue
                here = where.get(ch, 0)
                n0 = (r0 & here) << 1
                n1 = ((r1 & here) << 1 | r0 << 1 | r0 | n0 << 1) & whole
                n2 = ((r2 & here) << 1 | r1 << 1 | r1 | n1 << 1) & whole if most == 2 else n1
                if not n2:
                    continue
                term = child.get("")
                if term is not None:
                    edits = 0 if n0 & last else 1 if n1 & last else 2 if n2 & last else 3
                    if edits <= edits_allowed(term):
                        found = (edits, -self.terms[term], term)
                        best = found if best is None else min(best, found)
                stack.append((child, n0, n1, n2))
        return None if best is None else (best[2], best[0])

    def lookup(self, word: str) -> tuple[str, int] | None:
        memo = self.memo
        if word in memo:
            return memo[word]
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found = memo[word] = self.nearest(word)
        return found


def lexicon_of(terms: dict[str, float]) -> Lexicon:
    """The lexicon of these terms, built once per worker."""
    key = tuple(sorted(terms.items()))
    cache = worker_cache("toxicity")
    if key not in cache:
        cache.clear()
        cache[key] = Lexicon(terms)
    return cache[key]


def _quoted(text: str, start: int, end: int, words: Sequence[str]) -> bool:
    """In a context window: quotation marks on both sides, or a reporting word."""
    left = text[max(0, start - 40) : start]
    right = text[end : end + 40]
    return any(q in left for q in _QUOTES) and any(q in right for q in _QUOTES) or not REPORTING.isdisjoint(words)


def _disguised(text: str, lookup, spans: Sequence[tuple[int, int]], hits: dict) -> dict[int, tuple]:
    """By number of its first word: the term that words with digits or symbols
    between them make, its edits, and the last word's number. Words that are
    hits by themselves are not part of one, nor is any word part of two."""
    gaps = [m.span() for m in _INNER.finditer(text)]
    if not gaps:
        return {}
    starts = [s for s, _ in spans]
    found: dict[int, tuple] = {}
    taken = -1
    for n, (left, right) in enumerate(gaps):
        last = bisect_left(starts, right)
        ends = [last]
        if right - left == 1 and n + 1 < len(gaps) and gaps[n + 1][0] == spans[last][1] and gaps[n + 1][1] == gaps[n + 1][0] + 1:
            ends.append(last + 1)
        best = None
        for end in ends:
            parts = range(last - 1, end + 1)
            if parts[0] <= taken or any(text[slice(*spans[i])] in hits for i in parts):
                continue
            f = lookup(text[spans[last - 1][0] : spans[end][1]])
            if f is not None and (best is None or f[1] < best[1]):
                best = (*f, end)
        if best is not None:
            found[last - 1] = best
            taken = best[2]
    return found


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values named in ``FEATURES``; a text without hits has the bias only."""
    text = (text or "").lower()
    lookup = lexicon.lookup
    words = _WORD.findall(text)
    hits = {w: f for w in set(words) if (f := lookup(w)) is not None}
    spans = [m.span() for m in _WORD.finditer(text)] if hits or _INNER.search(text) else []
    disguised = _disguised(text, lookup, spans, hits) if spans else {}
    if not hits and not disguised:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    strongest, counts, addressed, total = 0.0, [[0, 0], [0, 0]], 0, 0
    for i, w in enumerate(words):
        found, last = hits.get(w), i
        if found is None and i in disguised:
            *found, last = disguised[i]
        if found is None:
            continue
        around = words[max(0, i - CONTEXT) : i] + words[last + 1 : last + 1 + CONTEXT]
        quoted = _quoted(text, spans[i][0], spans[last][1], around)
        counts[found[1] > 0][quoted] += 1
        addressed += not quoted and not ADDRESS.isdisjoint(around)
        strongest = max(strongest, lexicon.terms[found[0]] / (1 + found[1]) / (1 + quoted))
        total += 1
    flat = [math.log1p(n) for pair in counts for n in pair]
    return [1.0, strongest, *flat, math.log1p(addressed), min(1.0, 20 * total / len(words))]


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, ids: list, most_terms: int
) -> dict[str, float]:
    """Words whose document frequency among the toxic is beyond chance.

    Words are counted per task and summed by Spark. A word is kept when its
    log-likelihood ratio exceeds what the most extreme of as many random words
    would reach; its weight is the log odds. At most ``most_terms`` are kept.
    """
    sample = rows_of_ids(docs.select(id_column, text), id_column, ids)
    marked = sample.join(labels, id_column)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[toxic == 1].update({"", *_WORD.findall((t or "").lower())})
        words = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string())] + [pa.array([c[w] for w in words], pa.int64()) for c in found],
            names=["word", "clean", "toxic"],
        )

    counts = (
        marked.select(F.col(text).cast("string"), F.col(label).cast("long"))
        .mapInArrow(count, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    every = counts.where("word = ''").collect()
    if not every or not every[0]["toxic"] or not every[0]["clean"]:
        return {}
    n_clean, n_toxic = every[0]["clean"], every[0]["toxic"]
    n_words = counts.count()
    in_toxic, in_clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(in_toxic / (n_toxic + 1.0)) - F.log(in_clean / (n_clean + 1.0))
    seen = F.col("toxic") + F.col("clean")
    share = n_toxic / (n_toxic + n_clean)

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("toxic"), seen * share) + part(F.col("clean"), seen * (1 - share)))
    kept = (
        counts.where("word != ''")
        .select("word", odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("odds") > LEAST_ODDS) & (F.col("ratio") > 2 * math.log(max(2, n_words)) + 5))
        .orderBy(F.desc("ratio"), "word")
        .limit(most_terms)
    )
    return {r["word"]: r["odds"] for r in kept.collect()}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Newton steps on the ridge-penalised likelihood."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        w = w - np.linalg.solve(hessian, gradient)
    return w


class Model:
    def __init__(self, terms: dict[str, float], weights: list[float]) -> None:
        self.terms, self.weights = terms, weights

    def scorer(self):
        lexicon, weights = lexicon_of(self.terms), self.weights

        def score(text: str | None) -> float:
            z = sum(a * b for a, b in zip(features(text, lexicon), weights))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_documents: int = 20_000,
    most_terms: int = 4_000,
) -> Model:
    """Learn from at most ``most_documents`` labelled documents that are not held
    out, chosen by hash of their id. An id labelled twice counts as toxic if one
    label says so. Without labels of both kinds, every score is the share of
    toxic ones, 0 without any."""
    known = (
        labels.where(F.col(label).isNotNull() & ~held_out(id_column))
        .groupBy(id_column)
        .agg(F.max(label).alias(label))
    )
    ids = bounded_ids(known, id_column, most_documents)
    known = F.broadcast(rows_of_ids(known, id_column, ids))
    terms = learn_lexicon(docs, known, id_column, text, label, ids, most_terms)
    sample = rows_of_ids(docs.select(id_column, text), id_column, ids).join(known, id_column)

    def make():
        lexicon = lexicon_of(terms)
        return lambda texts: ([features(t, lexicon) for t in texts],)

    rows = map_texts(sample, [label], text, make, "x array<double>").collect()
    if not rows:
        return Model({}, [-30.0] + [0.0] * (len(FEATURES) - 1))
    x = np.array([r["x"] for r in rows])
    y = np.array([float(r[label] == 1) for r in rows])
    order = np.lexsort((*x.T, y))  # the sums then run in one order
    return Model(terms, fit_logistic(x[order], y[order]).tolist())


def score_toxicity(
    docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) of every row. A null or empty text has the
    score of a text without hits; repeated rows stay repeated."""

    def make():
        score = model.scorer()
        return lambda texts: ([score(t) for t in texts],)

    return map_texts(docs, keep, text, make, "score double")
