"""Byte-level BPE: corpus-level merge replay, and decoding.

The distinct pre-tokens of a batch lie behind one another in one list of nodes.
An inverted index maps the rank a token pair merges to onto the positions where
that pair stands; merges are applied in rank order, each to all its positions,
and only the two neighbours of a merged pair are entered anew. Replayed words
are remembered by the worker process, up to a bound.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from touchline.llm.common import map_texts, worker_cache

#: Words a worker remembers; beyond it, it forgets all of them and starts anew.
MEMO_WORDS = 400_000
#: Words longer than this are not remembered.
MEMO_BYTES = 64

_ONE = [bytes([b]) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a file with one "base64 rank" line per token."""
    cache = worker_cache("bpe")
    if path not in cache:
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        cache[path] = ranks
    return cache[path]


def replay_merges(words: Sequence[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Ids of every word. A word that is a token as a whole is that token;
    otherwise its bytes merge in rank order, leftmost first."""
    get = ranks.get
    toks: list[bytes | None] = []
    after: list[int] = []
    before: list[int] = []
    index: dict[int, list[int]] = {}
    starts = []
    for word in words:
        if word in ranks or not word:
            starts.append(-1)
            continue
        base, n = len(toks), len(word)
        starts.append(base)
        toks += [_ONE[b] for b in word]
        after += range(base + 1, base + n)
        after.append(-1)
        before.append(-1)
        before += range(base, base + n - 1)
        for i in range(n - 1):
            rank = get(word[i : i + 2])
            if rank is not None:
                index.setdefault(rank, []).append(base + i)
    heap = list(index)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for n, i in enumerate(places):
            j = after[i]
            if toks[i] is None or j < 0:
                continue
            pair = toks[i] + toks[j]
            if get(pair) != rank:
                continue  # one of the two has merged otherwise since
            k, h = after[j], before[i]
            toks[i], toks[j], after[i] = pair, None, k
            earlier = False
            if k >= 0:
                before[k] = i
                new = get(pair + toks[k])
                if new is not None:
                    earlier = new < rank
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        heapq.heappush(heap, new)
            if h >= 0:
                new = get(toks[h] + pair)
                if new is not None:
                    earlier = earlier or new < rank
                    if new in index:
                        index[new].append(h)
                    else:
                        index[new] = [h]
                        heapq.heappush(heap, new)
            if earlier and n + 1 < len(places):  # a better merge has come up: it goes first
                index[rank] = places[n + 1 :]
                heapq.heappush(heap, rank)
                break
    out = []
    for word, i in zip(words, starts):
        if i < 0:
            out.append([ranks[word]] if word else [])
            continue
        ids = []
        while i >= 0:
            ids.append(ranks[toks[i]])
            i = after[i]
        out.append(ids)
    return out


def encoder(path: str, pattern: str) -> Callable[[Iterable[str]], list[bytes]]:
    """A function from texts to their ids, packed as little-endian 32-bit integers."""
    import regex

    ranks, find = load_ranks(path), regex.compile(pattern).findall
    memo: dict[str, bytes] = worker_cache("bpe").setdefault((path, pattern), {})

    def encode(texts: Iterable[str]) -> list[bytes]:
        split = [find(t or "") for t in texts]
        new = set().union(*split) - memo.keys()
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = set().union(*split)
        words = list(new)
        own = memo
        if any(len(w) > MEMO_BYTES for w in words):
            own = dict(memo)
        for word, ids in zip(words, replay_merges([w.encode() for w in words], ranks)):
            packed = array("I", ids).tobytes()
            own[word] = packed
            if own is not memo and len(word) <= MEMO_BYTES:
                memo[word] = packed
        return [b"".join(map(own.__getitem__, s)) for s in split]

    return encode


def decoder(path: str) -> Callable[[Iterable[bytes | None]], list[bytes]]:
    """A function from packed ids to the bytes they stand for."""
    tokens = {rank: token for token, rank in load_ranks(path).items()}

    def decode(packed: Iterable[bytes | None]) -> list[bytes]:
        return [b"".join(map(tokens.__getitem__, memoryview(p or b"").cast("I"))) for p in packed]

    return decode


def encode_texts(
    docs: DataFrame, path: str, pattern: str, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep``, ``n_tokens`` and ``ids`` (packed) of every row.

    A null or empty text has no ids. Repeated rows stay repeated.
    """

    def make():
        encode = encoder(path, pattern)

        def work(texts):
            ids = encode(texts)
            return [len(i) // 4 for i in ids], ids

        return work

    return map_texts(docs, keep, text, make, "n_tokens long, ids binary")


def round_trip(
    docs: DataFrame, path: str, pattern: str, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """As ``encode_texts``, with ``decoded``: the bytes that the ids decode to,
    made from the ids alone in the same pass."""

    def make():
        encode, decode = encoder(path, pattern), decoder(path)

        def work(texts):
            ids = encode(texts)
            return [len(i) // 4 for i in ids], ids, decode(ids)

        return work

    return map_texts(docs, keep, text, make, "n_tokens long, ids binary, decoded binary")
