"""Selectors over the element array of a stored page.

``sources.pages`` turns a page into ``array<struct<pos, stop, tag, cls, href,
testid, text, visible, at, below>>`` in document order. An element's descendants are
the ``below`` entries behind entry ``at``, its own, so CSS-like selection is a filter on
a slice of the array and stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from touchline import schemas
from touchline.functions.text import let, strip

Selector = Callable[[Column], Column]


def has_class(token: str) -> Selector:
    return lambda e: F.contains(e["cls"], F.lit(f" {token} "))


def class_like(*parts: str) -> Selector:
    """Class attribute contains every one of ``parts``."""

    def test(e: Column) -> Column:
        hit = F.contains(e["cls"], F.lit(parts[0]))
        for part in parts[1:]:
            hit = hit & F.contains(e["cls"], F.lit(part))
        return hit

    return test


def is_tag(name: str) -> Selector:
    return lambda e: e["tag"] == name


def either(*tests: Selector) -> Selector:
    def test(e: Column) -> Column:
        hit = tests[0](e)
        for t in tests[1:]:
            hit = hit | t(e)
        return hit

    return test


def both(a: Selector, b: Selector) -> Selector:
    return lambda e: a(e) & b(e)


def with_rows(elements: Column, body: Callable[[Column], Column]) -> Column:
    """Hand the elements of a page to ``body`` as rows that are decoded once: a slice of
    them is then as cheap as it is short."""
    return let(F.filter(elements, lambda e: e["at"] >= 0), body)


def inside(elements: Column, within: Column) -> Column:
    """The descendants of ``within``, none of a missing one. ``elements`` are all of the page."""
    return F.slice(elements, F.coalesce(within["at"] + 2, F.lit(1)), F.coalesce(within["below"], F.lit(0)))


def select_all(elements: Column, test: Selector, within: Column | None = None) -> Column:
    """Matching elements, below ``within`` when given."""
    return F.filter(elements if within is None else inside(elements, within), test)


def select_first(elements: Column, test: Selector, within: Column | None = None) -> Column:
    return F.get(select_all(elements, test, within), F.lit(0))


def closest(elements: Column, test: Selector, inner: Column) -> Column:
    """The nearest element around ``inner``, itself included."""
    around = F.filter(elements, lambda e: (e["pos"] <= inner["pos"]) & (e["stop"] >= inner["stop"]) & test(e))
    return F.try_element_at(around, F.lit(-1))


def category_of(section_text: Column) -> Column:
    """category of a section by its heading; ``top_stats`` by default."""

    def named(low: Column) -> Column:
        out = F.when(F.startswith(low, F.lit("top stats")), "top_stats")
        for heading, category in schemas.SECTION_CATEGORIES.items():
            out = out.when(F.startswith(low, F.lit(heading)), category)
        return out.otherwise("top_stats")

    return let(F.lower(section_text), named)


def drop_undefined_names(rows: Column) -> Column:
    """Keep rows whose name is neither empty nor a script leftover."""
    return F.filter(rows, lambda r: (r["name"] != "") & ~F.contains(r["name"], F.lit("undefined")))


def goal_entries(elements: Column, items: Column) -> Column:
    """``{scorer, assist}`` of goal items; the whole text when an item has
    no parts; blank items are dropped."""
    def entry(li: Column) -> Column:
        def parts(own: Column) -> Column:
            scorer = select_first(own, has_class("scoreboard-event__scorer"))["visible"]
            assist = select_first(own, has_class("scoreboard-event__assist"))["visible"]
            return let(
                strip(scorer),
                lambda s: F.struct(
                    F.coalesce(s, strip(li["visible"])).alias("scorer"), F.when(s.isNotNull(), strip(assist)).alias("assist")
                ),
            )

        return let(inside(elements, li), parts)

    return F.transform(F.filter(items, lambda li: strip(li["visible"]) != ""), entry)


def card_entries(items: Column) -> Column:
    """texts of card items without blanks."""
    return F.filter(F.transform(items, lambda li: strip(li["visible"])), lambda t: t != "")
