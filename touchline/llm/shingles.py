"""Sets of hashed word shingles, computed over arrays of bytes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_BYTES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

#: Bytes hashed at once; longer texts are cut at white space.
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_P, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of bytes that hold whole words."""
    a = np.frombuffer(data, dtype=np.uint8)
    up, down = _power(len(a) + 1)
    blank = np.empty(len(a) + 2, dtype=bool)
    blank[0] = blank[-1] = True
    blank[1:-1] = _SPACE[a]
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = turns[::2], turns[1::2]
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[a] * up[: len(a)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _chunks(data: bytes):
    at = 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield at, data[at:end]
        at = end


def shingle_sets(texts: Sequence[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are what ASCII white space parts, with A-Z lower-cased. A text of
    fewer words has one element, its whole sequence; one without words, none.
    """
    raw = [(t or "").encode().lower() for t in texts]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    parts = [(h, s + at) for at, c in _chunks(b"\n".join(raw)) for h, s in (_words(c),)]
    if not parts:
        return [np.empty(0, dtype=np.uint64) for _ in raw]
    words = np.concatenate([h for h, _ in parts])
    owner = np.searchsorted(begins, np.concatenate([s for _, s in parts]), "right") - 1
    n = max(0, len(words) - width + 1)
    full = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        full += words[k : n + k] * _PLACE[k]
    inside = owner[:n] == owner[width - 1 :]
    full, of = mix(full[inside]), owner[:n][inside]
    bounds = np.searchsorted(of, np.arange(len(raw) + 1))
    firsts = np.searchsorted(owner, np.arange(len(raw) + 1))
    made = []
    for d in range(len(raw)):
        count = firsts[d + 1] - firsts[d]
        if count >= width:
            made.append(np.unique(full[bounds[d] : bounds[d + 1]]))
        elif count:
            own = words[firsts[d] : firsts[d + 1]]
            with np.errstate(over="ignore"):
                one = (own * _PLACE[8 : 8 + count]).sum(dtype=np.uint64) + _U(count)
            made.append(mix(np.array([one], dtype=np.uint64)))
        else:
            made.append(np.empty(0, dtype=np.uint64))
    return made
