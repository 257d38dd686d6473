"""Secrets, also under nested encodings: a worklist of decoded layers.

Every text is the first layer. A layer is scanned for secrets; its escaped,
base64 and compressed parts become new layers until none is left. Each layer
keeps, per character, the place in the original text it stems from. A layer
seen before is not entered again, which ends cycles.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from html.entities import html5
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from touchline.llm.common import map_texts

KINDS = ("assign", "access", "hex")

# What counts as a secret.
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_NAMES = ("passw", "secret", "token", "api")

_ESCAPE = re.compile(
    r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z][A-Za-z0-9]{1,31};"
)
_ESCAPED_RUN = re.compile(r"\S+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_NEXT_LINE = re.compile(r"[ \t]*\r?\n[ \t>]*(?!--)([A-Za-z0-9+/_-]+={0,2})(?![A-Za-z0-9+/_=-])")
_BLOB_ENDS = re.compile(r"[ \t]*(?:\r?\n|\Z)|[^\s\w]")
_BREAK = re.compile(r"[+/](?=.{20})", re.S)
_PACKED_BREAK = re.compile(r"[+/](?=(?:H4s|e[A-P]|Qlp|/Td6).{17})", re.S)

#: A decompressed layer is scanned in windows of about this many bytes. They end
#: before a byte that secrets, escapes and base64, also in lines, cannot hold.
WINDOW_BYTES = 1 << 20
_STANDARD = bytes.maketrans(b"-_", b"+/")
_BINARY = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f-\xff]")
_GOES_ON = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=.%\\&#;:\"'> \t\r\n"
_IN_BLOB = _GOES_ON[:66]

#: Without such a byte a window grows to this many, so memory is bounded whatever
#: a layer unpacks to. The next one then overlaps it, and begins at a multiple of
#: four letters of a base64 run. The run itself is decoded to its end beside them.
MOST_WINDOW_BYTES = 16 << 20

#: Compressed streams directly in one another; a stream that unpacks to itself has no end.
MOST_STREAMS = 32
WINDOW_OVERLAP = 4096

Span = tuple[int, int, int]  # start, kind, end
Places = tuple[np.ndarray, np.ndarray]  # start and end of every character


def base_spans(text: str) -> list[Span]:
    """Secrets in the text as it stands, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return found


def _unescape(run: str) -> tuple[str, np.ndarray]:
    """The run with its escapes decoded, and per character where it begins; the
    last entry is the run's end. Bytes that are no UTF-8 stay as Latin-1."""
    out: list[str] = []
    places = array("q")
    pending: list[tuple[int, int]] = []  # percent and \x bytes

    def flush() -> None:
        if not pending:
            return
        raw = bytes(b for b, _ in pending)
        try:
            text = raw.decode()
            at = 0
            for ch in text:
                out.append(ch)
                places.append(pending[at][1])
                at += len(ch.encode())
        except UnicodeDecodeError:
            for b, place in pending:
                out.append(chr(b))
                places.append(place)
        pending.clear()

    end = 0
    for m in _ESCAPE.finditer(run):
        if m.start() > end:
            flush()
            out.append(run[end : m.start()])
            places.extend(range(end, m.start()))
        esc, at = m.group(), m.start()
        if esc[0] == "%":
            pending.append((int(esc[1:], 16), at))
        elif esc[1] == "x":
            pending.append((int(esc[2:], 16), at))
        else:
            flush()
            decoded = _named_or_numbered(esc)
            out.append(decoded)
            # a name that stands for nothing stays as it is
            places.extend(range(at, m.end()) if decoded is esc else [at] * len(decoded))
        end = m.end()
    flush()
    out.append(run[end:])
    places.extend(range(end, len(run)))
    places.append(len(run))
    return "".join(out), np.array(places)


def _named_or_numbered(esc: str) -> str:
    """What an escape of a code point, or a named entity, stands for."""
    if esc[0] == "&" and esc[1] != "#":
        return html5.get(esc[1:], esc)
    if esc[1] == "u":
        code = int(esc[2:].strip("{}"), 16)
    else:
        code = int(esc[3:-1], 16) if esc[2] in "xX" else int(esc[2:-1])
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _cut(window: bytes) -> tuple[int, int]:
    """The end of a full window and the start of the next; 0 to let it grow."""
    end = len(window.rstrip(_GOES_ON))
    if end or len(window) < MOST_WINDOW_BYTES:
        return end, end
    start = len(window) - WINDOW_OVERLAP
    run = len(window.rstrip(_IN_BLOB))
    return len(window), start - max(0, start - run) % 4


def _is_packed(raw: bytes) -> bool:
    """True for the first bytes of gzip, zlib, bzip2 and xz streams."""
    zlib_head = len(raw) > 2 and raw[0] == 0x78 and (raw[0] * 256 + raw[1]) % 31 == 0
    return zlib_head or raw[:2] == b"\x1f\x8b" or raw[:3] == b"BZh" and raw[3:4] in b"123456789" or raw[:6] == b"\xfd7zXZ\0"


class _Unpack:
    """One compressed stream, fed in parts; gives its content in parts of bounded size."""

    def __init__(self, head: bytes, bare: bool = False) -> None:
        if bare:
            self.of = zlib.decompressobj(-15)
        elif head[:3] == b"BZh":
            self.of = bz2.BZ2Decompressor()
        elif head[:1] == b"\xfd":
            self.of = lzma.LZMADecompressor()
        else:
            self.of = zlib.decompressobj(47)
        self.rest = b""

    def feed(self, raw: bytes) -> Iterator[bytes]:
        """The content that ``raw`` completes; ``rest`` is what stands behind the stream.
        Raises at bytes that are no such stream."""
        while not self.of.eof:
            more = self.of.decompress(raw, WINDOW_BYTES)
            raw = getattr(self.of, "unconsumed_tail", b"")
            if more:
                yield more
            elif not raw and getattr(self.of, "needs_input", True):
                return
        self.rest = self.of.unused_data


_NO_STREAM = (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError)


def _opens(raw: bytes) -> bool:
    """True when a stream begins here: two letters of text can look like its head, but
    what follows them does not unpack."""
    if not _is_packed(raw):
        return False
    try:
        for _ in _Unpack(raw).feed(raw):
            pass
    except _NO_STREAM:
        return False
    return True


class _Windows:
    """Bytes that come in parts, cut into windows. A base64 run that goes on past the
    largest window is decoded as it comes, to its end, and what it holds is given in
    windows as well."""

    def __init__(self) -> None:
        self.window, self.run = b"", None

    def feed(self, more: bytes) -> Iterator[bytes]:
        if self.run is not None:
            inside = len(more) - len(more.lstrip(_IN_BLOB))
            yield from self.run.feed(more[:inside])
            if inside < len(more):
                yield from self.run.end()
                self.run = None
        self.window += more
        if len(self.window) >= WINDOW_BYTES:
            end, start = _cut(self.window)
            if end:
                began = len(self.window.rstrip(_IN_BLOB))
                if self.run is None and end == len(self.window) > began:
                    self.run = _Run()
                    yield from self.run.feed(self.window[began:])
                yield self.window[:end]
                self.window = self.window[start:]

    def end(self) -> Iterator[bytes]:
        if self.run is not None:
            yield from self.run.end()
        if self.window:
            yield self.window
        self.window, self.run = b"", None


class _Run:
    """A base64 run in parts: decoded four letters at a time, and unpacked if packed."""

    def __init__(self) -> None:
        self.letters, self.unpack, self.windows, self.begun, self.broken = b"", None, _Windows(), False, False
        self.inner: _Unpack | bool | None = None

    def feed(self, letters: bytes) -> Iterator[bytes]:
        letters = self.letters + letters.translate(_STANDARD)
        whole = len(letters) // 4 * 4
        self.letters = letters[whole:]
        yield from self._raw(letters[:whole])

    def _raw(self, letters: bytes) -> Iterator[bytes]:
        if self.broken or not letters:
            return
        raw = binascii.a2b_base64(letters + b"=" * (-len(letters) % 4))
        if not self.begun:
            self.begun = True
            self.unpack = _Unpack(raw) if _opens(raw) else None
        if self.unpack is None:
            yield from self.windows.feed(raw)
            return
        try:
            for more in self.unpack.feed(raw):
                yield from self._content(more)
        except _NO_STREAM:
            self.broken = True

    def _content(self, more: bytes) -> Iterator[bytes]:
        """What is unpacked may be packed once more."""
        if self.inner is None:
            self.inner = _Unpack(more) if _opens(more) else False
        if not self.inner:
            yield from self.windows.feed(more)
            return
        for part in self.inner.feed(more):
            yield from self.windows.feed(part)

    def end(self) -> Iterator[bytes]:
        if len(self.letters) % 4 != 1:
            yield from self._raw(self.letters)
        yield from self.windows.end()


def _through(parts: Iterator[bytes], depth: int = 0) -> Iterator[bytes]:
    """Parts of content; where they begin as a compressed stream themselves, what that
    unpacks to, down to ``MOST_STREAMS`` streams in one another."""
    first = next(parts, b"")
    if depth >= MOST_STREAMS or not _opens(first):
        yield first
        yield from parts
        return

    def inner() -> Iterator[bytes]:
        unpack = _Unpack(first)
        for part in chain([first], parts):
            try:
                yield from unpack.feed(part)
            except _NO_STREAM:
                return
            if unpack.of.eof:
                return

    yield from _through(inner(), depth + 1)
    for _ in parts:  # to the end of the outer stream, behind which another may stand
        pass


def _inflated(raw: bytes) -> Iterator[bytes]:
    """The windows of compressed streams that follow one another, and what stands
    behind the last one; nothing when the first is none. Bytes that are no text are
    tried as a bare deflate stream, which has no mark of its own."""
    rest, windows = raw, _Windows()
    while _is_packed(rest):
        unpack = _Unpack(rest)
        try:
            for more in _through(unpack.feed(rest)):
                yield from windows.feed(more)
        except _NO_STREAM:
            rest = b""
            break
        if not unpack.of.eof:
            rest = b""
            break
        rest = unpack.rest.lstrip(b"\0")
    yield from windows.end()
    if rest and rest is not raw:
        yield rest
    if rest is raw and len(raw) >= 8 and _BINARY.search(raw):
        yield from _bare(raw)


def _bare(raw: bytes) -> Iterator[bytes]:
    """The windows of a deflate stream without a head, if it is one to its end. It is
    tried through once before anything is given, so that chance gives nothing."""
    trial = _Unpack(raw, bare=True)
    try:
        size = sum(map(len, trial.feed(raw)))
    except _NO_STREAM:
        return
    if not trial.of.eof or not size or len(trial.rest) > 8:
        return
    windows = _Windows()
    for more in _through(_Unpack(raw, bare=True).feed(raw)):
        yield from windows.feed(more)
    yield from windows.end()


def _as_texts(raw: bytes) -> Iterator[str]:
    """Bytes as UTF-8, and as UTF-16 of either order where a quarter of them is null."""
    yield raw.decode("utf-8", "replace")
    if raw.count(0) * 4 >= len(raw) >= 4:
        # letters of ASCII have their null behind them, or before
        low = raw[1::2].count(0) >= raw[::2].count(0)
        yield raw.decode("utf-16-le" if low else "utf-16-be", "replace").lstrip("\ufeff")


def _wrapped(text: str, first: re.Match) -> list[range]:
    """The lines of a base64 blob that begins with this run: lines of one width,
    and a last one that may be shorter. The first may begin within its line."""
    lines, padded, width = [range(*first.span())], first.group().endswith("="), len(first.group())
    while not padded and (m := _NEXT_LINE.match(text, lines[-1].stop)):
        n = len(m.group(1))
        after = _NEXT_LINE.match(text, m.end())
        if len(lines) == 1 and (n > width or after and len(after.group(1)) == n):
            width = n
        padded = m.group(1).endswith("=")
        if n > width or n < width and not padded and not _BLOB_ENDS.match(text, m.end()):
            break
        lines.append(range(*m.span(1)))
        if n < width:
            break
    return lines


def _blobs(text: str) -> Iterator[tuple[str, list[range]]]:
    """Base64 runs with their places, and runs of consecutive lines as one."""
    until = 0
    for m in _BASE64.finditer(text):
        yield m.group(), [range(*m.span())]
        if m.start() < until:
            continue
        lines = _wrapped(text, m)
        if len(lines) > 1:
            yield "".join(text[x.start : x.stop] for x in lines), lines
            # a first line of another width may be none, so the second can begin a blob too
            until = lines[-1].stop if len(lines[0]) == len(lines[1]) else lines[0].stop


def _decoded(blob: str) -> Iterator[tuple[str, int]]:
    """Texts in a base64 run, and where in the run they begin. What stands before
    a blob in a path looks like base64 too, so a blob may begin after any break:
    a packed one is known by its first bytes, others need one start of each
    remainder modulo 4, as all of them read the same bytes from there on."""
    blob = blob.rstrip("=").replace("-", "+").replace("_", "/")
    first = {0: 0}
    for m in _BREAK.finditer(blob):
        first.setdefault(m.end() % 4, m.end())
        if len(first) == 4:
            break
    if len(blob) % 4 == 1:
        for at in (1, 2, 3):
            first.setdefault(at, at)
    packed = {at for m in _PACKED_BREAK.finditer(blob) if _is_packed(base64.b64decode(blob[(at := m.end()) : at + 4]))}
    for at in sorted({*first.values(), *packed}):
        size = len(blob) - at
        size -= size % 4 == 1  # one more letter holds no byte
        try:
            raw = base64.b64decode(blob[at : at + size] + "=" * (-size % 4))
        except (binascii.Error, ValueError):
            continue
        unpacked = False
        for window in _inflated(raw):
            unpacked = True
            for inner in _as_texts(window):
                yield inner, at
        if not unpacked:
            for inner in _as_texts(raw):
                yield inner, at


def _layers(text: str) -> Iterator[tuple[str, Places | tuple[int, int]]]:
    """Layers directly inside a layer: its text, and the place of each character
    in the outer layer, or one place for all of them.

    Escapes are decoded in the layer as a whole, as a secret may have blanks and
    plain parts between them, and in each run without white space by itself, as
    what stands before a run may use up its beginning.
    """
    if ("%" in text or "\\" in text or "&" in text) and _ESCAPE.search(text):
        inner, places = _unescape(text)
        yield inner, (places[:-1], places[1:])
        end = -1
        for m in _ESCAPE.finditer(text):
            if m.start() < end:
                continue
            low = max(end, 0)
            start = max(low, 1 + max(text.rfind(c, low, m.start()) for c in " \n\t\r"))
            run = _ESCAPED_RUN.search(text, start)
            while run.end() <= m.start():
                run = _ESCAPED_RUN.search(text, run.end())
            end = run.end()
            inner, places = _unescape(run.group())
            base = run.start()
            yield inner, (base + places[:-1], base + places[1:])
    for blob, lines in _blobs(text):
        for inner, at in _decoded(blob):
            for line in lines:
                if at < len(line):
                    break
                at -= len(line)
            yield inner, (line.start + at, lines[-1].stop)


def decoded_spans(text: str) -> list[Span]:
    """Secrets of all decoded layers, at the places of ``text`` they stem from."""
    found: set[Span] = set()
    seen = {hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()}
    work = [(text, None)]
    while work:
        layer, places = work.pop()
        for inner, (starts, ends) in _layers(layer):
            one = isinstance(starts, int)
            if not inner:
                continue
            if places is not None and isinstance(places[0], int):
                starts, ends, one = *places, True
            elif places is not None and one:
                starts, ends = int(places[0][starts]), int(places[1][ends - 1])
            elif places is not None:
                starts, ends = places[0][starts], places[1][ends - 1]
            # the same text elsewhere is another layer, so the place counts
            mark = repr((starts, ends) if one else (int(starts[0]), int(ends[-1])))
            key = hashlib.blake2b(f"{mark}\0{inner}".encode("utf-8", "replace"), digest_size=16).digest()
            if key in seen:
                continue
            seen.add(key)
            for start, kind, end in base_spans(inner):
                lo, hi = (starts, ends) if one else (int(starts[start]), int(ends[end - 1]))
                found.add((lo, kind, hi))
            work.append((inner, (starts, ends)))
    return sorted(found)


def joined(spans: Sequence[Span], kinds: Sequence[str] = KINDS) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``base`` and ``spans`` of every row: arrays of (start, kind, end).

    ``base`` holds what stands in the text itself, ``spans`` also what its
    decoded layers hold. Places count code points, ends are exclusive. A null
    text counts as empty and has no spans; repeated rows stay repeated. A text is
    read whole, and so is what it unpacks to, a window after the other; in one run without
    white space or other ends for 16 MB a secret may be cut that stands between two
    windows more than ``WINDOW_OVERLAP`` bytes long.
    """
    kind = "array<struct<start:long,kind:string,end:long>>"

    def make():
        def rows(spans):
            return [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans]

        def work(texts):
            base, every = [], []
            for t in texts:
                plain = base_spans(t or "")
                more = decoded_spans(t) if t else []
                base.append(rows(plain))
                every.append(rows(sorted({*plain, *more})) if more else base[-1])
            return base, every

        return work

    return map_texts(docs, keep, text, make, f"base {kind}, spans {kind}")
