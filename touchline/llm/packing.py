"""Pack documents into token windows: bounded-space online best fit.

A task keeps a fixed number of open windows. The rest of a document beyond its
full windows goes to the open window it fills best; when none has room and no
further one may be opened, the fullest is emitted. The windows still open at the
end of the tasks are merged in far fewer tasks, where their pieces are cut to
fill windows up.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from touchline.llm.common import small_batches, stored, worker_cache

#: Chunks of text whose ids a worker remembers, those used last.
MEMO_CHUNKS = 300_000
MEMO_BYTES = 64

#: Words that the tokenizer gets as one text.
TOGETHER = 1_000

#: Open windows merged by one task at the end.
MERGED_WINDOWS = 4096

_PIECE = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)

# Letters that stay one letter each when they are composed and lower-cased.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_LETTERS = re.compile(f"[{_LATIN}]+")
# An ASCII sign behind such a letter or an ASCII digit, but those of special tokens.
_SIGN = rf"""([0-9{_LATIN}])([!"#$%&()*+,\-./:;=?@\[\\\]^_`{{}}~])"""
# What leaves a text as it is: it may name a special token, or has combining marks,
# which may join a capital before it is lowered, or a sign.
_AS_IS = "<\\||[\u0300-\u037f]"


class Encoder:
    """Ids of texts, packed as little-endian 32-bit integers.

    The tokenizer drops white space and never joins what white space parts, so
    the ids of a text are those of its chunks. It lower-cases, so ASCII capitals
    may go first, and begins a token at a sign behind an ASCII digit or a Latin letter,
    so a blank may go between them, but for texts of ``_AS_IS``. Arrow splits many texts
    and numbers their chunks; the tokenizer gets all new ones in one call. Short chunks
    are remembered; of two generations the older one goes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[n for token, n in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        letters = "".join(filter(_LETTERS.fullmatch, map(chr, range(0x41, 0x180))))
        self.latin = self._of_words(path, letters, bytewise=True)
        self.ascii = self._of_words(path, "".join(filter(str.isascii, letters)), bytewise=False)

    def _of_words(self, path: str, letters: str, bytewise: bool):
        """The tokenizer without what lower-cased words of these letters do not need, if
        it then treats such words alike: no normalising, words parted at blanks, and,
        unless ``bytewise``, letters that stand for themselves as bytes."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        plain = Tokenizer.from_file(path)
        plain.normalizer = normalizers.Sequence([])
        steps = [pre_tokenizers.WhitespaceSplit()]
        if bytewise:
            steps.append(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
        plain.pre_tokenizer = pre_tokenizers.Sequence(steps)
        probe = [letters, letters.lower(), " ".join(letters), " ".join(a + b for a, b in zip(letters, letters[7:] + letters))]
        alike = all(plain.encode(t.lower(), add_special_tokens=False).ids == self.tokenizer.encode(t, add_special_tokens=False).ids for t in probe)
        return plain if alike else self.tokenizer

    def _tokenize(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks. Those of Latin letters alone are one word each, so many of them
        go as one text, of which a token that ends a word ends the chunk's ids."""
        # a batch on threads costs more processor time than one call for each text
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        plain, latin, others, ids = [], [], [], {}
        one_word = _LETTERS.fullmatch
        for c in chunks:
            if self.ends is None:
                others.append(c)
            elif c.isalpha():
                plain.append(c)
            else:
                (latin if one_word(c.decode()) else others).append(c)
        for tokenizer, words in ((self.ascii, plain), (self.latin, latin)):
            groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
            found = tokenizer.encode_batch_fast([b" ".join(g).decode().lower() for g in groups], add_special_tokens=False)
            for group, encoded in zip(groups, found):
                own = np.array(encoded.ids, dtype="<u4")
                raw, start = own.tobytes(), 0
                for c, end in zip(group, (4 * np.flatnonzero(self.ends[own]) + 4).tolist(), strict=True):
                    ids[c] = raw[start:end]
                    start = end
        found = self.tokenizer.encode_batch_fast([c.decode() for c in others], add_special_tokens=False)
        for c, encoded in zip(others, found):
            ids[c] = array("I", encoded.ids).tobytes()
        return ids

    def _ids(self, chunks: Sequence[bytes]) -> list[bytes]:
        """Ids of distinct chunks; new ones are learned."""
        if len(self.memo) > MEMO_CHUNKS // 2:
            self.memo, self.older = {}, self.memo
        found = list(map(self.memo.get, chunks))
        missed = [n for n, ids in enumerate(found) if ids is None]
        learned = self._tokenize(chunks[n] for n in missed if chunks[n] not in self.older)
        for n in missed:
            c = chunks[n]
            found[n] = learned[c] if c in learned else self.older[c]
            if len(c) <= MEMO_BYTES:
                self.memo[c] = found[n]
        return found

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        texts = pc.fill_null(pa.array(texts, pa.string()) if not isinstance(texts, pa.Array) else texts, "")
        texts = texts.cast(pa.large_string())
        parted = pc.replace_substring_regex(pc.ascii_lower(texts), _SIGN, r"\1 \2")
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(texts, _AS_IS), texts, parted))
        numbered = split.flatten().dictionary_encode()
        found = pa.array(self._ids(_listed(numbered.dictionary)), pa.large_binary())
        ids = pa.ListArray.from_arrays(split.offsets, found.take(numbered.indices))
        return pc.binary_join(ids, pa.scalar(b"", pa.large_binary())).to_pylist()


def _listed(chunks: pa.Array) -> list[bytes]:
    """The chunks, none of which has a blank: much faster than each taken from Arrow."""
    whole = pa.ListArray.from_arrays([0, len(chunks)], chunks.cast(pa.large_binary()))
    joined = pc.binary_join(whole, pa.scalar(b" ", pa.large_binary()))[0].as_py()
    return joined.split(b" ") if len(chunks) else []


def encoder(path: str) -> Encoder:
    """The encoder a worker keeps from task to task."""
    cache = worker_cache("packing")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def tokenizer(path: str) -> Callable[[str], bytes]:
    """A function from one text to its packed ids."""
    return lambda text: encoder(path).encode([text])[0]


class _Windows:
    """The open windows of a task: pieces (doc, start, ids, doc_tokens) and room."""

    def __init__(self, size: int, most: int, number: int) -> None:
        self.size, self.most, self.next = size, most, number
        self.open: list[list] = []  # [room, id, pieces]

    def new_id(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, piece: tuple) -> Iterator[list]:
        """Put a piece of at most a window's size; gives windows that close."""
        need = len(piece[2]) // 4
        fits = [w for w in self.open if w[0] >= need]
        if fits:
            best = min(fits, key=lambda w: w[0])
        else:
            if len(self.open) >= self.most:
                full = min(self.open, key=lambda w: w[0])
                self.open.remove(full)
                yield full
            best = [self.size, self.new_id(), []]
            self.open.append(best)
        best[0] -= need
        best[2].append(piece)
        if not best[0]:
            self.open.remove(best)
            yield best


def _rows(window: list) -> Iterator[tuple]:
    offset = 0
    for doc, start, ids, doc_tokens in window[2]:
        n = len(ids) // 4
        yield doc, start, n, zlib.crc32(ids), doc_tokens, window[1], offset, ids
        offset += n


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 2048,
    open_windows: int = 64,
    end_id: int = 1,
    id_column: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``size`` ids.

    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone. Repeated rows are packed as often as they occur, and a null id is
    kept. ``start`` counts the ids before the piece within its document,
    ``offset`` those before it within its sequence. ``ids`` are packed; with
    ``keep_ids=False`` the column is null.

    The first pass moves no rows. Its pieces are written to the shared folder,
    from which those of open windows are merged. Each merging task leaves one
    window that is not full. Texts are tokenized a batch
    of about four megabytes at a time.
    """
    schema = T.StructType([docs.schema[id_column], *T.StructType.fromDDL(_PIECE), *T.StructType.fromDDL("closed boolean")])
    arrow = to_arrow_schema(schema)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer_path), array("I", [end_id]).tobytes()
        windows = _Windows(size, open_windows, TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []
        held = 0

        def close(window: list) -> int:
            before = len(rows)
            for row in _rows(window):
                rows.append((*row[:7], row[7] if keep_ids else None, True))
            return 64 * (len(rows) - before) + (4 * size if keep_ids else 0)

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), coder.encode(b.column(1))):
                ids += end
                total, step = len(ids) // 4, 4 * size
                for at in range(0, len(ids), step):
                    piece = (doc, at // 4, ids[at : at + step], total)
                    for window in windows.place(piece):
                        held += close(window)
                if held > 4 << 20:
                    yield batch(rows)
                    rows.clear()
                    held = 0
        yield batch(rows)
        for window in windows.open:
            yield batch([(*row, False) for row in _rows(window)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (1 << 62) + (TaskContext.get().partitionId() << 32)
        room, window = size, [size, number, []]
        for b in batches:
            rows = []
            for doc, start, ids, total in zip(
                *(b.column(arrow.get_field_index(c)).to_pylist() for c in (id_column, "start", "ids", "doc_tokens"))
            ):
                while ids:
                    cut = ids[: 4 * room]
                    window[2].append((doc, start, cut, total))
                    ids, start, room = ids[4 * room :], start + len(cut) // 4, room - len(cut) // 4
                    if not room:
                        rows += [(*r[:7], r[7] if keep_ids else None, True) for r in _rows(window)]
                        number += 1
                        room, window = size, [size, number, []]
            yield batch(rows)
        yield batch([(*r[:7], r[7] if keep_ids else None, True) for r in _rows(window)])

    packed = stored(small_batches(docs).select(id_column, F.col(text).cast("string")).mapInArrow(first, schema), "pieces")
    left = packed.where(~F.col("closed"))
    tasks = 1 + left.where(F.col("offset") == 0).count() // MERGED_WINDOWS
    merged = (
        left.repartition(tasks, "sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(merge, schema)
    )
    return packed.where("closed").unionByName(merged).drop("closed")
