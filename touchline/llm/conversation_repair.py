"""Conversation structure repair by a secondary-sorted stream.

Rows are shuffled by conversation and sorted by turn; a task then reads one
conversation after the other, and a conversation may span any number of Arrow
batches. What is carried from row to row is the state of a dynamic program over
the four places of the role grammar ``(s?(ua)+)?``: the cheapest cost of every
place and which of the cheapest edits come first in ASCII. Every row leaves one
small number that tells from where each place was reached; at the end of the
conversation the edits are read backwards from these numbers. Numbers and texts
of a conversation that outgrow a few megabytes go to a file of the task, so
memory does not follow the length of a conversation (but for its audit, which is
one cell of the result).

Edits of a row: Keep (free), Rerole to user or assistant, Delete (the only edit of
a blank or repeated row); and Insert of an empty user or assistant row anywhere. A
truncated row that is not deleted costs extra. Which row Rerole and Insert make
follows from the place in the grammar, so the letters of the edits name a repair.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import small_batches

#: Costs of the edits, and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3

#: A place that costs more than this above the cheapest one is on no cheapest repair:
#: from the cheapest, one insert, the deletion of an s row and two inserts at the end
#: follow any repair that starts at another place.
HOPELESS = INSERT + DELETE + 2 * INSERT

#: Bytes of numbers, and of texts, that a conversation holds in memory.
MEMORY = 4 << 20

SPACE = " \t\n\x0b\x0c\r"

# Places in the grammar: nothing yet, behind s, behind u, behind a.
START, S, U, A = range(4)
_NEXT = {START: "u", S: "u", U: "a", A: "u"}
_BEHIND = {"u": U, "a": A}
_ROLE = {"u": "user", "a": "assistant"}
#: Letters that lead to the accepted end from each place.
_END = {START: "", S: "II", U: "I", A: ""}

_LETTERS = ("D", "K", "R", "IK", "IR")
_NO_WAY = 255

FINE, CUT, GONE = range(3)


def _insert(place: int) -> int:
    return _BEHIND[_NEXT[place]]


def _consume(place: int, letter: str, initial: str) -> int | None:
    """The place behind a row that is kept or gets the next role."""
    if letter == "R":
        return _insert(place)
    if place == START and initial == "s":
        return S
    return _BEHIND[initial] if initial == _NEXT[place] else None


def _ways(initial: str, kind: int) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, letters) of all ways over a row. Two inserts ahead of a row
    lead where none does, and inserts ahead of a deletion can as well come later."""
    ways = [(p, p, DELETE, 0) for p in range(4)]
    if kind == GONE:
        return ways
    extra = TRUNCATED if kind == CUT else 0
    for code, letters in enumerate(_LETTERS[1:], 1):
        for p in range(4):
            at = _insert(p) if letters[0] == "I" else p
            to = _consume(at, letters[-1], initial)
            if to is not None:
                cost = INSERT * (len(letters) - 1) + (REROLE if letters[-1] == "R" else 0)
                ways.append((p, to, cost + extra, code))
    return ways


_WAYS = {(i, kind): _ways(i, kind) for i in ("s", "u", "a", "") for kind in (FINE, CUT, GONE)}

#: (cost above the cheapest, rank of the letters so far) of every place, None if unreached.
State = tuple


@lru_cache(maxsize=1 << 16)
def _step(state: State, initial: str, kind: int) -> tuple[int, State, int]:
    """Cost added to the cheapest, the new state, and where each place came from.

    Letters up to a row end with that row's own, so of two different ones neither
    begins the other, and an earlier difference decides for good: of equal costs
    the lower rank wins, then the lower letters of this row. States are few, so that
    most rows are a look into the cache.
    """
    best: list = [None] * 4
    for p, to, cost, code in _WAYS[initial, kind]:
        if state[p] is not None:
            way = (state[p][0] + cost, state[p][1], _LETTERS[code], p, code)
            if best[to] is None or way < best[to]:
                best[to] = way
    least = min(b[0] for b in best if b)
    best = [b if b and b[0] <= least + HOPELESS else None for b in best]
    order = sorted((b[1:3], to) for to, b in enumerate(best) if b)
    rank = {to: n for n, (_, to) in enumerate(order)}
    new = tuple((b[0] - least, rank[to]) if b else None for to, b in enumerate(best))
    back = 0
    for to, b in enumerate(best):
        back |= (b[3] * 8 + b[4] if b else _NO_WAY) << (8 * to)
    return least, new, back


_AT_START: State = ((0, 0), None, None, None)


class Spill:
    """Items in order; what outgrows ``most`` bytes goes to a file of the task."""

    def __init__(self, most: int) -> None:
        self.most, self.items, self.bytes, self.file, self.starts = most, [], 0, None, []

    def append(self, item, size: int) -> None:
        self.items.append(item)
        self.bytes += size
        if self.bytes > self.most:
            self.file = self.file or tempfile.TemporaryFile()
            self.starts.append(self.file.seek(0, 2))
            pickle.dump(self.items, self.file)
            self.items, self.bytes = [], 0

    def _chunk(self, start: int) -> list:
        self.file.seek(start)
        return pickle.load(self.file)

    def forward(self) -> Iterator:
        for start in self.starts:
            yield from self._chunk(start)
        yield from self.items

    def backward(self) -> Iterator:
        yield from reversed(self.items)
        for start in reversed(self.starts):
            yield from reversed(self._chunk(start))

    def close(self) -> None:
        if self.file:
            self.file.close()


class Conversation:
    """One conversation while its rows come in, and its repair at the end."""

    def __init__(self, name: str | None) -> None:
        self.name = name
        self.rows = self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self._lowest = self._turn = None
        self._turns = 0
        self._before = None
        self._state = _AT_START
        self._back, self._texts = Spill(MEMORY), Spill(MEMORY)

    def add(self, turn: str | None, role: str, text: str, again: bool) -> None:
        """The next row; ``again`` when its role and text occurred before."""
        self.rows += 1
        if turn is not None:
            turn = int(turn)
            if self._lowest is None:
                self._lowest = turn
            if turn != self._turn:
                self._turn, self._turns = turn, self._turns + 1
        bare, initial = text.strip(SPACE), role[:1]
        if not bare:
            self.blank, kind = self.blank + 1, GONE
        elif again:
            self.duplicate, kind = self.duplicate + 1, GONE
        elif bare[-1] not in ".!?":
            self.truncated, kind = self.truncated + 1, CUT
        else:
            kind = FINE
        if self._before is not None and self._before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self._before = initial
        added, self._state, back = _step(self._state, initial if initial in "sua" else "", kind)
        self.cost += added
        self._back.append(back, 8)
        self._texts.append((turn, role, text), len(role) + len(text) + 64)

    def end(self) -> None:
        """Choose the cheapest end, then read the letters of every row backwards."""
        if self._lowest is not None:
            self.gaps = self._turn - self._lowest + 1 - self._turns
        ends = [(s[0] + INSERT * len(_END[p]), s[1], p) for p, s in enumerate(self._state) if s is not None]
        cost, _, place = min(ends)
        self.cost += cost
        self._tail = _END[place]
        codes = bytearray()
        for back in self._back.backward():
            way = (back >> (8 * place)) & 255
            codes.append(way & 7)
            place = way >> 3
        codes.reverse()
        self._codes = codes
        self.audit = "".join([*(_LETTERS[c] for c in codes), self._tail])

    def repaired(self) -> Iterator[tuple[str, int | None, str, str]]:
        """(edit, turn, role, text) of the rows after the repair."""
        place = START
        for code, (turn, role, text) in zip(self._codes, self._texts.forward()):
            for letter in _LETTERS[code]:
                if letter == "D":
                    continue
                if letter != "K":
                    role_now = _ROLE[_NEXT[place]]
                    place = _insert(place)
                else:
                    role_now, place = role, _consume(place, "K", role[:1])
                yield (letter, None, role_now, "") if letter == "I" else (letter, turn, role_now, text)
        for _ in self._tail:
            yield "I", None, _ROLE[_NEXT[place]], ""
            place = _insert(place)

    def sha256(self) -> str:
        digest, first = hashlib.sha256(), True
        for _, _, role, text in self.repaired():
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        return digest.hexdigest()

    def close(self) -> None:
        self._back.close()
        self._texts.close()


def conversations(frames: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Every conversation of a sorted stream, when its last row has come."""
    now: Conversation | None = None
    for frame in frames:
        for name, turn, role, text, first, there in zip(*(frame[c].tolist() for c in _COLUMNS)):
            if now is None or name != now.name:
                if now is not None:
                    now.end()
                    yield now
                    now.close()
                now = Conversation(name)
            if there:
                now.add(turn, role, text, not first)
    if now is not None:
        now.end()
        yield now
        now.close()


_COLUMNS = ("conv", "turn", "role", "text", "first", "there")


def _stream(rows: DataFrame, conv: str, turn: str, role: str, text: str, there: Column | None) -> DataFrame:
    """Rows by conversation, in order of turn. Whether a row's role and text came
    before is found by a window of its own, so a task holds no set of texts."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(
        F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("number"),
        spaced(role).alias("role"), spaced(text).alias("text"),
        (F.lit(True) if there is None else F.coalesce(there, F.lit(False))).alias("there"),
    )
    same = Window.partitionBy("conv", "role", "text", "there").orderBy(F.col("number").asc_nulls_first())
    flagged = plain.withColumn("first", F.row_number().over(same) == 1)
    order = [F.col("conv"), F.col("number").asc_nulls_first(), F.col("role"), F.col("text"), F.col("first").desc()]
    ordered = small_batches(flagged).repartition("conv").sortWithinPartitions(*order)
    return ordered.withColumn("turn", F.col("number").cast("string")).select(*_COLUMNS)


_REPORT = (
    "conv string, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_REPAIRED = "conv string, place long, turn string, edit string, role string, text string"


def _in_frames(rows: Iterator[tuple], schema: str, size: Callable[[tuple], int]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in schema.split(", ")]
    part, filled = [], 0
    for row in rows:
        part.append(row)
        filled += size(row)
        if filled > MEMORY:
            yield pd.DataFrame(part, columns=names, dtype=object)
            part, filled = [], 0
    if part:
        yield pd.DataFrame(part, columns=names, dtype=object)


def audit_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_rows``, ``gaps`` in its turns, rows
    that are ``blank``, ``duplicate`` or ``truncated`` (the first of these counts),
    ``illegal`` neighbours of roles, the ``cost`` and the letters (``audit``) of the
    cheapest repair, of equal ones the ASCII-least, and ``repaired_sha256`` over the
    repaired ``role:text`` joined by line feeds.

    A null role or text is one space. Rows are taken by turn, nulls first, ties by
    role and text; equal rows repeat one another. Rows without a conversation are one
    of their own. Rows for which ``there`` is not true only name their conversation; one
    with such rows alone has zeros and an empty repair. Other columns are not read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reports = (
            (c.name, c.rows, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, c.audit, c.sha256())
            for c in conversations(frames)
        )
        yield from _in_frames(reports, _REPORT, lambda r: 256 + len(r[-2]))

    found = _stream(rows, conv, turn, role, text, there).mapInPandas(run, _REPORT)
    kind = rows.schema[conv].dataType
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None,
) -> DataFrame:
    """The rows after the cheapest repair: ``conv_id``, ``place`` (from 0), ``turn``
    (null for an inserted row), ``edit`` (K, R or I), ``role`` and ``text``. Terms as in
    ``audit_conversations``; a conversation of which nothing stays has no row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repaired = (
            (c.name, place, None if at is None else str(at), edit, who, said)
            for c in conversations(frames)
            for place, (edit, at, who, said) in enumerate(c.repaired())
        )
        yield from _in_frames(repaired, _REPAIRED, lambda r: 128 + len(r[-1]))

    found = _stream(rows, conv, turn, role, text, there).mapInPandas(run, _REPAIRED)
    kind = rows.schema[conv].dataType
    return found.select(
        F.col("conv").cast(kind).alias("conv_id"), "place", F.col("turn").cast("long").alias("turn"), "edit", "role", "text"
    )


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with planted faults, by crc32 of ``conv_id:turn``: a
    twentieth each is dropped (``there`` false), emptied, loses its ``.!?``, is repeated,
    or becomes the user's. Nulls count as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    coded = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role"))
    return coded.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("code") != 0).alias("there"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
