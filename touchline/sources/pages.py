"""Stored pages as element arrays.

HTML is no XML, so the one step Spark's own functions cannot express is finding
the elements of a page. A small Arrow-batched helper does only that; every
selection and every field is a Column expression on its result.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from html import unescape
from itertools import zip_longest

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# Executors get this helper with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENT = (
    "pos int, stop int, tag string, cls string, href string, testid string, "
    "first boolean, last boolean, text string, visible string, at int, below int"
)

_ARROW_FIELDS = [
    ("pos", pa.int32()),
    ("stop", pa.int32()),
    ("tag", pa.string()),
    ("cls", pa.string()),
    ("href", pa.string()),
    ("testid", pa.string()),
    ("first", pa.bool_()),
    ("last", pa.bool_()),
    ("text", pa.string()),
    ("visible", pa.string()),
    ("at", pa.int32()),
    ("below", pa.int32()),
]

# HTML elements that never have content, that start a new line of visible text,
# and whose text is never shown.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside div dl dt dd fieldset footer form h1 h2 h3 h4 h5 h6 header li main nav "
    "ol p section table tr ul".split()
)
_HIDDEN = frozenset(["script", "style", "template", "noscript"])
_ENDS_OPEN = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# What a match page can be asked for: parts of class names, and plain tags.
_CLASS = re.compile(
    "match-card|match-list-item|match-header|match-date|match-details|match-stats|match-status|mc-summary"
    "|team-name|score|venue|referee|matchweek|gameweek|stats-row|stat-row|name|value|section"
    "|lineups|squad-list"
)
_TAGS = frozenset(["li", "p", "span", "td", "time"])


# Markup in a page: a tag with its name and attributes, in which ">" may stand in
# quotes; a comment; or a declaration. Possessive parts never look back.
_NAME = r"""[a-zA-Z][^\t\n\r\f />\x00]*+"""
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+"""
_NO_TAG = r"!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+>"
_MARKUP = re.compile(rf"<(?:(/?)({_NAME})({_REST})>|{_NO_TAG})", re.S)
_ATTRIBUTE = re.compile(r"""((?<=["'\s/])[^\s/>=]++|^[^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+""")
# An attribute value without quotes at the end of a tag, to which a "/" belongs.
_OPEN_VALUE = re.compile(r"""=\s*[^\s"'][^\s"']*$""")
_WANTED = ("class", "href", "data-testid")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in ("script", "style")}
# Scripts and styles: their tag, up to its end, and the text behind it, in which only their own end is markup.
_RAW_TAG = {tag: "<" + "".join(f"[{c}{c.upper()}]" for c in tag) + rf"(?=[\t\n\r\f />\x00])(?>(?:{_REST})>)" for tag in _RAW_END}
_RAW = "|".join(rf"{start}(?<!/>)(?:[^<]++|<(?!(?i:/{tag})(?=[\s/>])))*+" for tag, start in _RAW_TAG.items())
_MARKUPS = re.compile(rf"({_RAW}|<(?:/?{_NAME}(?:{_REST})>|{_NO_TAG}))", re.S)
_SLASHED_RAW = re.compile("|".join(rf"{start}(?<=/>)" for start in _RAW_TAG.values()))


def _attributes(text: str) -> tuple[str, str, str]:
    """Values of class, href and data-testid; empty ones where there are none."""
    found = dict.fromkeys(_WANTED, "")
    for name, value in _ATTRIBUTE.findall(text):
        name = name.lower()
        if name in found:
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            found[name] = unescape(value) if "&" in value else value
    return found["class"], found["href"], found["data-testid"]


def _pieces(html: str) -> Iterable[tuple[str, str]]:
    """A page as texts, each with the markup behind it; behind the last one is none."""
    if "/>" in html and _SLASHED_RAW.search(html):
        return _pieces_one_by_one(html)
    parts = _MARKUPS.split(html)
    return zip_longest(parts[::2], parts[1::2], fillvalue="")


def _pieces_one_by_one(html: str) -> Iterator[tuple[str, str]]:
    """The same where the slash that ends a script's tag may belong to an attribute."""
    at, end = 0, len(html)
    while m := _MARKUP.search(html, at):
        yield html[at : m.start()], m[0]
        at = m.end()
        closing, tag, attributes = m.groups()
        if tag and not closing and tag.lower() in _RAW_END and not _closes_itself(attributes):
            raw = _RAW_END[tag.lower()].search(html, at)
            at = raw.start() if raw else end
    yield html[at:], ""


def _closes_itself(attributes: str) -> bool:
    return attributes[-1:] == "/" and not _OPEN_VALUE.search(attributes)


class _Elements:
    """Finds the elements of pages with their text and extent.

    A page is split at its markup in one go. What a tag means is remembered, up to a number
    of tags, as pages repeat them. An open element is a list of its tag, first chunk of text,
    whether it is a block, whether it hides its text, its row in ``columns`` if it is kept,
    whether it has a child, and the row of its last child. The columns are place, stop, number
    of the tag in ``names``, whether it is its parent's first and last child, text, visible
    text, the number of the row in its page, and the number of rows in it.
    """

    _MOST, _LONGEST = 20_000, 300

    def __init__(self, links: bool = False) -> None:
        self._links = links
        self.forget()

    def forget(self) -> None:
        """Start over, with no tag known. Entries refer to the tags known since."""
        self._known: dict[str, tuple | None] = {"": None}
        self.names: list[tuple[str, str, str, str]] = []
        self.columns: tuple[list, ...] = tuple([] for _ in range(9))

    def crowded(self) -> bool:
        return len(self.names) > self._MOST or len(self._known) > self._MOST

    def _learn(self, markup: str) -> tuple | None:
        """What a tag does: its name, whether it is an end tag, is a block, starts a line,
        which open parents it ends, whether it has no content, hides its text, closes itself,
        and its number if it is kept. None for what is no tag."""
        m = _MARKUP.match(markup)
        if m is None or m[2] is None:
            found = None
        else:
            tag, rest = m[2].lower(), m[3]
            block, kept = tag in _BLOCK, None
            if not m[1]:
                cls, href, testid = _attributes(rest) if "=" in rest else ("", "", "")
                if tag in _TAGS or testid or (tag == "a" and (self._links or "match/" in href)) or (cls and _CLASS.search(cls)):
                    kept = len(self.names)
                    self.names.append((tag, f" {' '.join(cls.split())} ", href, testid))
            ends = _ENDS_OPEN.get(tag, frozenset()) | ({"p"} if block else frozenset())
            alone = not m[1] and _closes_itself(rest)
            found = tag, bool(m[1]), block, block or tag == "br", ends, tag in _VOID, tag in _HIDDEN, alone, kept
        if len(markup) <= self._LONGEST and len(self._known) <= self._MOST:
            self._known[markup] = found
        return found

    def read(self, html: str) -> int:
        """Add the kept elements of a page, in document order; the number of rows after it."""
        places, stops, numbers, firsts, lasts, texts, visible, at, below = self.columns
        top = len(places)
        opened: list[list] = []
        chunks: list[str] = []
        count = hidden = 0
        known_tags = self._known

        def close() -> bool:
            _, start, block, hides, row, _, last_child = opened.pop()
            if last_child is not None:
                lasts[last_child] = True
            if row is not None:
                # "\0" marks the line breaks of the layout
                text = chunks[start] if len(chunks) == start + 1 else "".join(chunks[start:])
                if "\0" in text:
                    visible[row] = "\n".join(s for s in (" ".join(p.split()) for p in text.split("\0")) if s)
                    text = text.replace("\0", "")
                else:
                    visible[row] = " ".join(text.split())
                texts[row] = text
                stops[row] = count
                below[row] = len(places) - row - 1
                if opened:
                    opened[-1][6] = row
            if block:
                chunks.append("\0")
            return hides

        for data, markup in _pieces(html):
            if data and not hidden:
                chunks.append(unescape(data) if "&" in data else data)
            try:
                known = known_tags[markup]
            except KeyError:
                known = self._learn(markup)
            if known is None:
                continue
            if not known[1]:
                tag, _, block, breaks, ends, void, hides, alone, kept = known
                if opened and opened[-1][0] in ends:
                    hidden -= close()
                if breaks:
                    chunks.append("\0")
                first = True
                if opened:
                    parent = opened[-1]
                    first = not parent[5]
                    parent[5] = True
                    parent[6] = None
                if not void:
                    hidden += hides
                    row = None
                    if kept is not None:
                        row = len(places)
                        places.append(count)
                        stops.append(0)
                        numbers.append(kept)
                        firsts.append(first)
                        lasts.append(False)
                        texts.append("")
                        visible.append("")
                        at.append(row - top)
                        below.append(0)
                    opened.append([tag, len(chunks), block, hides, row, False, None])
                    count += 1
                if not alone:
                    continue
            else:
                tag = known[0]
            if opened and opened[-1][0] == tag:
                hidden -= close()
            elif any(node[0] == tag for node in opened):
                while opened[-1][0] != tag:
                    hidden -= close()
                hidden -= close()
        while opened:
            close()
        return len(places)

    def take(self) -> list[pa.Array]:
        """The rows of the pages read so far, as columns of ``ELEMENT``."""
        pos, stop, number, *rest = self.columns
        self.columns = tuple([] for _ in range(9))
        number = pa.array(number, type=pa.int32())
        names = [pa.array(c, type=pa.string()).take(number) for c in (zip(*self.names) if self.names else [()] * 4)]
        flat = [pos, stop, *names, *rest]
        return [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, (_, t) in zip(flat, _ARROW_FIELDS)]


def page_elements(html: str | None, links: bool = False) -> list[list]:
    """Elements of a page in document order, fields as in ``ELEMENT``: the ``below``
    entries behind entry ``at`` lie in it. ``links`` keeps all links, not only those to matches."""
    parser = _Elements(links)
    parser.read(html or "")
    return [list(row) for row in zip(*(c.to_pylist() for c in parser.take()))]


def _element_lists(pages: list[str | None], parser: _Elements) -> pa.Array:
    if parser.crowded():
        parser.forget()
    offsets = [0, *(parser.read(html or "") for html in pages)]
    items = pa.StructArray.from_arrays(parser.take(), names=[n for n, _ in _ARROW_FIELDS])
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), items)


def with_elements(pages: DataFrame, html: str = "html", links: bool = False) -> DataFrame:
    """Replace column ``html`` by ``elements`` and ``page_hash``, which tells pages
    apart that were captured at the same time. The page itself goes no further.
    With ``links`` all links are elements, not only those to matches.

    Batches follow spark.sql.execution.arrow.maxBytesPerBatch, so large pages
    make short batches.
    """
    pages = pages.withColumn("page_hash", F.xxhash64(html))
    keep = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType([*keep, T.StructField("elements", T.ArrayType(T.StructType.fromDDL(ELEMENT)))])
    names = [f.name for f in keep]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Elements(links)
        for batch in batches:
            columns = [batch.column(n) for n in names]
            columns.append(_element_lists(batch.column(html).to_pylist(), parser))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "elements"])

    return pages.mapInArrow(parse, schema)
