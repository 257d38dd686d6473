"""Language identification by cross-parsing entropy.

For every language, a suffix automaton of labelled running text gives the longest
match at each place. A document's running text, its words with a blank between, is
parsed into as few such matches as a greedy reading needs, across blanks as well; their
number, weighed by the logarithm of the automaton's text and divided by the letters
read, estimates the cross entropy. The language of the smallest value wins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from touchline.llm.common import held_out, map_texts, rows_of_ids, worker_cache

UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")

#: Letters after which a phrase ends, so that the parts of a long text advance together.
STRETCH = 512

#: Letters of a text, a multiple of a stretch, and such pieces that are parsed side by side.
PIECE, PIECES = 2_048 * STRETCH, 4_096

#: Words that a long document gives in one piece to be learned from.
WORDS = 25


class SuffixAutomaton:
    """The substrings of a text as the smallest automaton that accepts them."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and ch not in self.next[p]:
                self.next[p][ch] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][ch]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(ch) == q:
                        self.next[p][ch] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def phrases(self, word: str) -> int:
        """Longest matches, one after another, that a word falls into. A letter
        the text never has is a phrase of its own."""
        n, state, steps = 0, 0, self.next
        root = steps[0]
        for ch in word:
            to = steps[state].get(ch)
            if to is None:
                if state:
                    n += 1
                to = root.get(ch)
                if to is None:
                    n += 1
                    to = 0
            state = to
        return n + (state != 0)


def letters_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class CrossParser:
    """Phrases of running texts, in the automata of all languages at once.

    The automata become one table: from a state and a letter to the next state and the
    phrases that end. Texts are cut into stretches, and all stretches of a slice go
    through the table side by side, a letter of each at a time.
    """

    def __init__(self, samples: Sequence[tuple[str, str]]) -> None:
        self.names = [name for name, _ in samples]
        self.weights = np.array([math.log2(len(text) + 2) for _, text in samples])
        letters = sorted(set().union(*(set(text) for _, text in samples)))
        self.size = len(letters) + 1  # 0 is a letter that no sample has
        self.codes = np.zeros(0x110000, dtype=np.uint16)
        self.codes[[ord(ch) for ch in letters]] = range(1, self.size)
        places = {ch: n for n, ch in enumerate(letters, 1)}
        tables, self.roots, at = [], [], 0
        for _, text in samples:
            tables.append(self._table(SuffixAutomaton(text), places, at).ravel())
            self.roots.append(at)
            at += len(tables[-1])
        kind = np.int32 if at * 4 < 2**31 else np.int64
        self.table = np.concatenate([t.astype(kind) for t in tables]) if tables else np.zeros(0, dtype=kind)

    def _table(self, made: SuffixAutomaton, places: dict[str, int], at: int) -> np.ndarray:
        """4 * place of the next state's row, and the phrases a letter ends: the open one
        if there is no way on, and one for a letter that the text never has."""
        row = lambda state: (at + state * self.size) * 4
        fresh = np.full(self.size, row(0) + 1, dtype=np.int64)
        for ch, to in made.next[0].items():
            fresh[places[ch]] = row(to)
        table = np.tile(fresh + 1, (len(made.next), 1))
        table[0] = fresh
        for state, ways in enumerate(made.next):
            for ch, to in ways.items():
                table[state, places[ch]] = row(to)
        return table

    def count(self, texts: list[str]) -> np.ndarray:
        """Phrases of every text (its letters and single blanks) in every language."""
        total = np.zeros((len(texts), len(self.names)))
        cuts = [(n, low, min(low + STRETCH, len(t))) for n, t in enumerate(texts) for low in range(0, len(t), STRETCH)]
        if not cuts:
            return total
        flat = self.codes[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")].astype(np.int64)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        owner, low, high = (np.array(c) for c in zip(*cuts))
        order = np.argsort(low - high, kind="stable")  # the longest first
        owner, first, length = owner[order], (starts[owner] + low)[order], (high - low)[order]
        roots = np.array(self.roots)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        phrases = np.zeros(state.shape, dtype=np.int64)
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # stretches longer than each place
        for place, n in enumerate(active.tolist()):
            found = self.table.take(state[:, :n] + flat[first[:n] + place])
            phrases[:, :n] += found & 3
            state[:, :n] = found >> 2
        phrases += state != roots
        np.add.at(total, owner, phrases.T)
        return total

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        read = [" ".join(letters_of(t)) if t else "" for t in texts]
        if not self.names:
            return [(UNDETERMINED, 0.0)] * len(read)
        # a very long text goes through in pieces that end with a stretch
        pieces = [(n, t[low : low + PIECE]) for n, t in enumerate(read) for low in range(0, len(t), PIECE)]
        counts = np.zeros((len(read), len(self.names)))
        for low in range(0, len(pieces), PIECES):
            some = pieces[low : low + PIECES]
            np.add.at(counts, [n for n, _ in some], self.count([t for _, t in some]))
        made = []
        for text, own in zip(read, counts):
            if not text:
                made.append((UNDETERMINED, 0.0))
                continue
            entropy = own * self.weights / len(text)
            best = int(entropy.argmin())
            share = np.exp(-4 * (entropy - entropy[best]))
            made.append((self.names[best], float(1 / share.sum())))
        return made


def learn_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    most_documents: int = 200,
    most_letters: int = 40_000,
) -> list[tuple[str, str]]:
    """A text per language: running text of at most ``most_documents`` labelled, not
    held-out documents of it, chosen by hash of their id, up to ``most_letters``. A
    document longer than its share gives stretches of words from all over it. Each gives
    an equal share of the bound first; what short ones leave goes to the others. All
    languages stop at the same bound, so that none gets longer matches merely for having
    more text. A larger bound changes nothing but how well languages are told apart.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_column))
    ranks = Window.partitionBy(lang).orderBy("_order", id_column)
    picked = (
        known.select(id_column, lang, F.xxhash64(id_column).alias("_order"))
        .withColumn("_rank", F.row_number().over(ranks))
        .where(F.col("_rank") <= most_documents)
    )
    ids = picked.select(id_column, lang).collect()
    sample = rows_of_ids(known, id_column, [r[0] for r in ids])
    counts = Counter(r[1] for r in ids)

    def make():
        def work(texts):
            return ([_stretches(letters_of(t or ""), most_letters) for t in texts],)

        return work

    stretches = map_texts(sample, [id_column, lang], text, make, "stretches array<string>")
    seen: dict[str, list[str]] = {}
    spare: dict[str, list[str]] = {}
    for row in stretches.orderBy(F.xxhash64(id_column), id_column).toLocalIterator():
        own, rest = seen.setdefault(row[lang], []), spare.setdefault(row[lang], [])
        share, used = most_letters // counts[row[lang]], 0
        left = most_letters - sum(map(len, rest))
        for words in (part.split() for part in row["stretches"]):
            fit = 0
            while fit < len(words) and used + len(words[fit]) <= share:
                used += len(words[fit])
                fit += 1
            own += words[:fit]
            for word in words[fit:]:
                if left > 0:
                    rest.append(word)
                    left -= len(word)
            if fit < len(words):
                share = used  # what follows is spare as well
    made = []
    for name in sorted(seen):
        parts, used = [], 0
        for word in seen[name] + spare[name]:
            if used >= most_letters:
                break
            parts.append(word)
            used += len(word)
        if parts:
            made.append((name, " ".join(parts)))
    return made


def _stretches(words: list[str], most_letters: int) -> list[str]:
    """Running text of a document, in stretches of words: all of them in order when they
    have at most ``most_letters`` letters, else stretches from all over it."""
    parts = [words[at : at + WORDS] for at in range(0, len(words), WORDS)]
    # steps of about the golden section reach all parts, far from one another
    step = max(1, round(len(parts) * 0.618))
    while math.gcd(step, len(parts)) > 1:
        step += 1
    short = sum(map(len, words)) <= most_letters
    order = range(len(parts)) if short else ((n * step) % len(parts) for n in range(len(parts)))
    taken, used = [], 0
    for n in order:
        if used >= most_letters:
            break
        taken.append(" ".join(parts[n]))
        used += sum(map(len, parts[n]))
    return taken


def identify_languages(
    docs: DataFrame, samples: Sequence[tuple[str, str]], keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` (0 to 1) of every row.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text when nothing was learned. Equal entropies go to the first language in
    alphabetic order. The score is the winner's share when entropies are turned
    into weights; repeated rows stay repeated. A text is read whole, about a megabyte of
    texts at a time; a phrase ends after ``STRETCH`` letters at the latest.
    """
    key = tuple(samples)

    def make():
        cache = worker_cache("langid")
        parser = cache.get(key)
        if parser is None:
            cache.clear()
            parser = cache[key] = CrossParser(key)

        def work(texts):
            made = parser.predict(texts)
            return [m[0] for m in made], [m[1] for m in made]

        return work

    return map_texts(docs, keep, text, make, "lang_pred string, score double")
