"""Personal data: patterns, and a character-level bidirectional LSTM with a CRF.

The patterns give the base spans, and on a bounded sample of documents they are
the labelled spans the network learns from. The network is written and trained
in numpy. It reads overlapping windows of characters around digits and at
signs: every kind it knows has one of the two, so text without them can hold no
span of its own and is not read by it. Where windows overlap, the mean of their
scores counts, and the CRF decodes all windows that hang together as one run. A
span of the network stands only where no base span is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import bounded_ids, map_texts, rows_of_ids, worker_cache

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from their at signs: the part before the sign goes
    back to the first other character or the last match, so no text is read
    twice however long its words are."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))
    return found


def base_spans(text: str) -> list[Span]:
    found = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


WINDOW, STRIDE, CONTEXT, GAP = 64, 32, 16, 24
_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
_SYMBOLS = {"@": 4, ".": 5, "-": 6, "+": 7, "(": 8, ")": 9, " ": 10, "_": 11, "%": 11, "\n": 12, "\t": 12, '"': 13, "'": 13, "=": 14, ":": 14}
_PAD, _N_SYMBOLS = 16, 17


def _symbol(ch: str) -> int:
    if "0" <= ch <= "9":
        return 0
    if "a" <= ch <= "z":
        return 1
    if "A" <= ch <= "Z":
        return 2
    return _SYMBOLS.get(ch, 3 if ch.isalpha() else 15)


def window_starts(text: str) -> list[int]:
    """Starts of the windows that cover every digit and at sign with context."""
    starts: list[int] = []
    low = high = -1
    for m in _MARK.finditer(text):
        if low >= 0 and m.start() <= high + GAP:
            high = m.end()
            continue
        if low >= 0:
            starts += _cover(low, high, len(text))
        low, high = m.span()
    if low >= 0:
        starts += _cover(low, high, len(text))
    return starts


def _cover(low: int, high: int, n: int) -> list[int]:
    start, end = max(0, low - CONTEXT), min(n, high + CONTEXT)
    return list(range(start, max(start + 1, end - STRIDE), STRIDE))


def _encode(text: str, start: int) -> list[int]:
    codes = [_symbol(c) for c in text[start : start + WINDOW]]
    return codes + [_PAD] * (WINDOW - len(codes))


def _tags(text: str, spans: Sequence[Span], start: int) -> list[int]:
    tags = [0] * WINDOW
    for s, k, e in spans:
        for p in range(max(s, start), min(e, start + WINDOW)):
            if not tags[p - start]:
                tags[p - start] = 1 + 2 * k if p == s else 2 + 2 * k
    return tags


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """The network: per direction an LSTM over symbols, one linear layer on both,
    and a linear-chain CRF on its scores."""

    def __init__(self, hidden: int = 16, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        h = hidden
        self.hidden = h
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (_N_SYMBOLS, 4 * h))
            self.p[f"h{d}"] = rng.normal(0, 0.3 / np.sqrt(h), (h, 4 * h))
            self.p[f"c{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        self.p["o"] = rng.normal(0, 0.3, (2 * h, _TAGS))
        self.p["ob"] = np.zeros(_TAGS)
        self.p["t"] = np.zeros((_TAGS, _TAGS))

    def _lstm(self, codes, d):
        n, steps = codes.shape
        h = np.zeros((n, self.hidden))
        c = np.zeros_like(h)
        x, w, b = self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"c{d}"]
        kept = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = x[codes[:, t]] + h @ w + b
            i, f, o = (_sigmoid(z[:, k * self.hidden : (k + 1) * self.hidden]) for k in range(3))
            g = np.tanh(z[:, 3 * self.hidden :])
            new = f * c + i * g
            squashed = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, squashed))
            h, c = o * squashed, new
        out = np.empty((n, steps, self.hidden))
        for (t, *_), after in zip(kept, [k[1] for k in kept[1:]] + [h]):
            out[:, t] = after
        return out, kept

    def scores(self, codes):
        forward, kept_f = self._lstm(codes, "f")
        backward, kept_b = self._lstm(codes, "b")
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["o"] + self.p["ob"], (both, kept_f, kept_b)

    def gradients(self, codes, tags):
        """Of the mean negative log likelihood."""
        n, steps = codes.shape
        emit, (both, kept_f, kept_b) = self.scores(codes)
        trans = self.p["t"]
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0]
        for t in range(1, steps):
            alpha[:, t] = _logsumexp(alpha[:, t - 1, :, None] + trans, 1) + emit[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _logsumexp(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[:, -1], 1)
        d_emit = np.exp(alpha + beta - total[:, None, None])
        d_emit[np.arange(n)[:, None], np.arange(steps), tags] -= 1
        pair = np.exp(
            alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ).sum((0, 1))
        np.subtract.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        d_emit /= n
        g = {"t": pair / n, "ob": d_emit.sum((0, 1)), "o": np.einsum("nth,ntk->hk", both, d_emit)}
        d_both = d_emit @ self.p["o"].T
        for d, kept, d_out in (("f", kept_f, d_both[:, :, : self.hidden]), ("b", kept_b, d_both[:, :, self.hidden :])):
            w = self.p[f"h{d}"]
            gx, gw, gb = (np.zeros_like(self.p[f"{a}{d}"]) for a in "xhc")
            dh = np.zeros((n, self.hidden))
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, gate, squashed in reversed(kept):
                dh = dh + d_out[:, t]
                dc = dc + dh * o * (1 - squashed**2)
                dz = np.concatenate(
                    [dc * gate * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - gate**2)], 1
                )
                np.add.at(gx, codes[:, t], dz)
                gw += h.T @ dz
                gb += dz.sum(0)
                dh, dc = dz @ w.T, dc * f
            g |= {f"x{d}": gx, f"h{d}": gw, f"c{d}": gb}
        return g

    def fit(self, codes, tags, steps: int = 240, batch: int = 48, rate: float = 0.02, seed: int = 11) -> "Tagger":
        """Adam over random batches, in a fixed order."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(codes), batch)
            for k, g in self.gradients(codes[pick], tags[pick]).items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                scale = rate * (1 - 0.8 * step / steps)
                self.p[k] -= scale * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, codes):
        """The best tags of each window (Viterbi)."""
        emit, _ = self.scores(codes)
        n, steps, _ = emit.shape
        trans, best = self.p["t"], emit[:, 0]
        back = np.empty((n, steps, _TAGS), dtype=np.int8)
        for t in range(1, steps):
            way = best[:, :, None] + trans
            back[:, t] = way.argmax(1)
            best = way.max(1) + emit[:, t]
        tags = np.empty((n, steps), dtype=np.int8)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags


def _plausible(kind: int, found: str) -> bool:
    """What a span of the network must have whatever it has learned."""
    digits = sum("0" <= c <= "9" for c in found)
    if kind == 0:
        at = found.find("@")
        return 0 < at < len(found) - 1
    if kind == 1:
        return found.count(".") == 3 and digits >= 4
    return 12 <= digits <= 19 if kind == 2 else 9 <= digits <= 15


def _runs(starts: Sequence[int], n: int) -> list[list[int]]:
    """Windows that overlap or touch, as lists of their starts."""
    runs: list[list[int]] = []
    for s in starts:
        if runs and s <= runs[-1][-1] + WINDOW:
            runs[-1].append(s)
        else:
            runs.append([s])
    return runs


def best_path(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The best tags of pieces of text side by side, the longest first (Viterbi).

    ``emit`` is pieces x steps x tags. ``before`` and ``after`` tell which pieces stand
    behind and in front of a line break, whose tag is none."""
    n, steps, tags_ = emit.shape
    best = emit[:, 0] + np.where(before[:, None], trans[0], 0)
    back = np.zeros((n, steps, tags_), dtype=np.int8)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for t in range(1, steps):
        k = active[t]
        way = best[:k, :, None] + trans
        back[:k, t] = way.argmax(1)
        best[:k] = way.max(1) + emit[:k, t]
    now = (best + np.where(after[:, None], trans[:, 0], 0)).argmax(1)
    tags = np.zeros((n, steps), dtype=np.int8)
    at = np.arange(n)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        tags[:k, t] = now[:k]
        now[:k] = back[at[:k], t, now[:k]]
    return tags


#: Scores of characters that are decoded side by side, so that memory is bounded.
SIDE_BY_SIDE = 1 << 20


def _decoded(text: str, run: list[int], scores: np.ndarray, pieces: list) -> None:
    """Cut a run of windows into pieces between line breaks. A character in several
    windows has the mean of their scores."""
    low, high = run[0], min(len(text), run[-1] + WINDOW)
    total = np.zeros((high - low, _TAGS), dtype=np.float32)
    times = np.zeros((high - low, 1), dtype=np.float32)
    for s, own in zip(run, scores):
        size = min(WINDOW, len(text) - s)
        total[s - low : s - low + size] += own[:size]
        times[s - low : s - low + size] += 1
    total /= times
    at = 0
    while at < high - low:
        end = text.find("\n", low + at, high) - low
        end = high - low if end < 0 else end
        if end > at:
            pieces.append((low + at, total[at:end], at > 0, end < high - low))
        at = end + 1


def _paths(pieces: list, trans: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Number of every piece and its best tags; pieces of like lengths go together."""
    order = sorted(range(len(pieces)), key=lambda n: -len(pieces[n][1]))
    at = 0
    while at < len(order):
        longest = len(pieces[order[at]][1])
        end = at + 1
        while end < len(order) and 2 * len(pieces[order[end]][1]) >= longest and (end - at) * longest < SIDE_BY_SIDE:
            end += 1
        some = order[at:end]
        emit = np.zeros((len(some), longest, _TAGS), dtype=np.float32)
        for row, n in enumerate(some):
            emit[row, : len(pieces[n][1])] = pieces[n][1]
        lengths = np.array([len(pieces[n][1]) for n in some])
        tags = best_path(emit, trans, lengths, np.array([pieces[n][2] for n in some]), np.array([pieces[n][3] for n in some]))
        for row, n in enumerate(some):
            yield n, tags[row, : lengths[row]]
        at = end


def spans_of_tags(tags: np.ndarray, start: int) -> list[Span]:
    """Runs of one kind; a begin tag starts another run."""
    found: list[Span] = []
    marked = np.flatnonzero(tags).tolist()
    run = None
    for p in marked:
        tag = int(tags[p])
        kind = (tag - 1) // 2
        if run and run[1] == kind and run[2] == p and tag != 1 + 2 * kind:
            run[2] = p + 1
            continue
        if run:
            found.append((start + run[0], run[1], start + run[2]))
        run = [p, kind, p + 1]
    if run:
        found.append((start + run[0], run[1], start + run[2]))
    return found


def network_spans(texts: Sequence[str], tagger: Tagger | None) -> list[list[Span]]:
    """Spans the network finds in each text, before base spans are considered.

    Windows are scored a batch at a time; where they overlap, their scores are averaged,
    and each run of windows is decoded as a whole. No kind of personal data goes
    over a line break, so a break has no tag, which parts a run into independent pieces.
    """
    out: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return out
    runs = [(n, run) for n, t in enumerate(texts) for run in _runs(window_starts(t), len(t))]
    pieces: list = []
    owner: list[int] = []
    held: list[tuple[int, list[int]]] = []
    size = 0

    def flush() -> None:
        places = [(n, s) for n, run in held for s in run]
        scores = [
            tagger.scores(np.array([_encode(texts[n], s) for n, s in places[at : at + 1024]]))[0].astype(np.float32)
            for at in range(0, len(places), 1024)
        ]
        scores, at = np.concatenate(scores), 0
        for n, run in held:
            _decoded(texts[n], run, scores[at : at + len(run)], pieces)
            owner.extend([n] * (len(pieces) - len(owner)))
            at += len(run)
        for piece, tags in _paths(pieces, tagger.p["t"]):
            out[owner[piece]] += spans_of_tags(tags, pieces[piece][0])
        pieces.clear()
        owner.clear()
        held.clear()

    for n, run in runs:
        held.append((n, run))
        size += len(run)
        if size >= 4096:
            flush()
            size = 0
    if held:
        flush()
    for n, text in enumerate(texts):
        out[n] = [
            (s, k, e)
            for s, k, e in sorted(out[n])
            if _plausible(k, text[s:e])
            and not (s and text[s - 1].isalnum())
            and not (e < len(text) and text[e].isalnum())
        ]
    return out


def without_crossing(base: Sequence[Span], more: Sequence[Span]) -> list[Span]:
    """Spans of ``more`` that overlap none of ``base``; both sorted, and those of ``more``
    one behind the other. One pass over both lists."""
    kept, at, reach = [], 0, -1
    for s, k, e in more:
        while at < len(base) and base[at][0] < e:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= s:
            kept.append((s, k, e))
    return kept


def all_spans(texts: Sequence[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and these with the network's wherever it crosses none."""
    made = []
    for text, more in zip(texts, network_spans(texts, tagger)):
        base = base_spans(text)
        made.append((base, sorted([*base, *without_crossing(sorted(base), more)])))
    return made


def train_tagger(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", most_documents: int = 2000, most_windows: int = 900, each: int = 6
) -> Tagger | None:
    """Learn from at most ``most_documents`` documents that hold a digit or an at
    sign, chosen by hash of their id, and at most ``most_windows`` windows of
    them, a third of these without a span; of one document at most ``each`` windows, half
    of them with spans as far as there are any. None when there is no labelled span.
    """
    marked = docs.where(F.col(text).rlike("[0-9@]"))
    sample = rows_of_ids(docs, id_column, bounded_ids(marked, id_column, most_documents))

    def make():
        def work(texts):
            rows = []
            for t in texts:
                spans = base_spans(t or "")
                found = []
                for s in window_starts(t or ""):
                    tags = _tags(t, spans, s)
                    found.append({"codes": bytes(_encode(t, s)), "tags": bytes(tags), "hit": any(tags)})
                found.sort(key=lambda w: not w["hit"])
                rows.append(found[:each] if len(found) <= each else found[: each // 2] + found[-each // 2 :])
            return (rows,)

        return work

    windows = map_texts(sample, [id_column], text, make, "windows array<struct<codes:binary,tags:binary,hit:boolean>>")
    got = [w for r in windows.orderBy(F.xxhash64(id_column), id_column).collect() for w in r["windows"]]
    hits = [w for w in got if w["hit"]][: most_windows * 2 // 3]
    if not hits:
        return None
    rest = [w for w in got if not w["hit"]][: most_windows // 3]
    picked = hits + rest
    read = lambda name: np.array([list(w[name]) for w in picked])
    return Tagger().fit(read("codes"), read("tags"))


def find_pii(
    docs: DataFrame, tagger: Tagger | None, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep``, ``base`` and ``spans`` of every row: arrays of (start, kind, end).

    ``base`` has the matches of the patterns, ``spans`` also those of the
    network; without a network both are equal. Places count code points, ends
    are exclusive. A null text counts as empty; repeated rows stay repeated. Work and
    memory of a long text follow its windows; one run of them without a line break is
    decoded as a whole.
    """
    kind = "array<struct<start:long,kind:string,end:long>>"
    weights = None if tagger is None else (tagger.hidden, tagger.p)

    def make():
        worker_cache("pii")
        model = None
        if weights is not None:
            model = Tagger(weights[0])
            model.p = weights[1]

        def rows(spans):
            return [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans]

        def work(texts):
            found = all_spans([t or "" for t in texts], model)
            return [rows(b) for b, _ in found], [rows(s) for _, s in found]

        return work

    return map_texts(docs, keep, text, make, f"base {kind}, spans {kind}")


def mask_pii(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by ``<kind>`` in
    brackets. Overlapping spans are masked as one, named by the first. A null
    text stays null."""
    spare = "masked_text"
    while spare in docs.columns:
        spare += "_"
    weights = None if tagger is None else (tagger.hidden, tagger.p)

    def make():
        worker_cache("pii")
        model = None
        if weights is not None:
            model = Tagger(weights[0])
            model.p = weights[1]

        def work(texts):
            made = []
            for t, (_, spans) in zip(texts, all_spans([t or "" for t in texts], model)):
                parts, end = [], 0
                for s, k, e in spans:
                    if s >= end:
                        parts += [t[end:s], f"[{KINDS[k].upper()}]"]
                    end = max(end, e)
                made.append(t if t is None else "".join([*parts, t[end:]]))
            return (made,)

        return work

    names = list(docs.columns)
    masked = map_texts(docs, names, text, make, f"{spare} string")
    return masked.select(*(F.col(spare).alias(c) if c == text else F.col(c) for c in names))
