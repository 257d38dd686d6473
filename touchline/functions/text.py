"""Text expressions: names, seasons, and fields found in page text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Every character that counts as white space when a text is stripped.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Inside a higher-order function nothing shares repeated sub-expressions, so
    a costly value that is used several times is bound through a lambda.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` anywhere in the text, NULL when there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def normalize_stat_name(name: Column) -> Column:
    """``Passes Completed (%)`` -> ``passes_completed``."""
    return F.btrim(F.translate(F.lower(name), " ()%", "_"), F.lit("_"))


def season_slug(season: Column) -> Column:
    """``2025/26`` -> ``2025-26``."""
    return F.replace(season, F.lit("/"), F.lit("-"))


def season_label(first_year: Column) -> Column:
    """2024 -> ``2024/25``."""
    return F.format_string("%d/%02d", first_year, F.pmod(first_year + 1, F.lit(100)))


def zero_pad(matchweek: Column) -> Column:
    """at least two digits; longer numbers stay whole."""
    return F.format_string("%02d", matchweek)


def timestamp_slug(ts: Column | None = None) -> Column:
    """F8: ``20250816_100000``."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyyMMdd_HHmmss")


def iso_now(ts: Column | None = None) -> Column:
    """ISO-8601 text with microseconds."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# Fixed value: the match id in a link.
MATCH_LINK_PATTERN = r"match/(\d+)"


def match_id_from_href(href: Column) -> Column:
    """F10."""
    return extract(href, MATCH_LINK_PATTERN).try_cast("bigint")


# Fixed value: two numbers joined by a hyphen or an en dash.
SCORE_PATTERN = r"(\d+)\s*[-–]\s*(\d+)"


def score_from_text(text: Column) -> tuple[Column, Column]:
    """home and away goals of ``2 - 1``."""
    return (
        extract(text, SCORE_PATTERN, 1).try_cast("int"),
        extract(text, SCORE_PATTERN, 2).try_cast("int"),
    )


# How a matchweek is written in a label and in running text.
MATCHWEEK_LABEL_PATTERN = r"(?i)(?:Matchweek|MW|Gameweek|GW)\s*(\d+)"
MATCHWEEK_TEXT_PATTERN = r"(?i)Matchweek\s+(\d+)"


def matchweek_from_text(labels: list[Column], page_text: Column) -> Column:
    """the first label with a week number wins, then the page text."""
    found = [extract(label, MATCHWEEK_LABEL_PATTERN) for label in labels]
    found.append(extract(page_text, MATCHWEEK_TEXT_PATTERN))
    return F.coalesce(*found).try_cast("int")


# Fixed value: how a half-time score is written.
HALF_TIME_PATTERN = r"(?i)HT\s*(\d+)\s*[-–]\s*(\d+)"


def half_time_score(text: Column) -> Column:
    """``HT 1 - 0`` -> ``1-0``."""
    return F.when(
        text.rlike(HALF_TIME_PATTERN),
        F.concat_ws(
            "-",
            F.regexp_extract(text, HALF_TIME_PATTERN, 1),
            F.regexp_extract(text, HALF_TIME_PATTERN, 2),
        ),
    )


# Labels in page text. The names hold ASCII letters only and end
# at the next label; ``\z`` is the very end of the text.
REFEREE_PATTERN = r"(?i)Referee\s+([A-Za-z\s]+?)\s+(?:Assistant|Fourth|VAR|\n?\z)"
FORMATION_PATTERN = r"(?i)Formation\s+(\d+-\d+-\d+)"
FULL_FORMATION_PATTERN = r"(?i)Formation\s+(\d+(?:-\d+)+)"
MANAGER_PATTERN = r"(?i)Manager\s+([A-Za-z\s]+?)(?=\d|Formation|\n?\z)"


def referee_from_text(text: Column) -> Column:
    """F14."""
    return strip(extract(text, REFEREE_PATTERN))


def _first_two(found: Column, clean: Callable[[Column], Column]) -> tuple[Column, Column]:
    return (
        F.when(F.size(found) >= 2, clean(F.get(found, F.lit(0)))),
        F.when(F.size(found) >= 2, clean(F.get(found, F.lit(1)))),
    )


def formations_from_text(text: Column, whole: bool = False) -> tuple[Column, Column]:
    """both sides or neither; three numbers unless ``whole``."""
    pattern = FULL_FORMATION_PATTERN if whole else FORMATION_PATTERN
    return _first_two(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda c: c)


def managers_from_text(text: Column) -> tuple[Column, Column]:
    """F16: both sides or neither."""
    return _first_two(F.regexp_extract_all(text, F.lit(MANAGER_PATTERN), F.lit(1)), strip)


# Fixed value: the number a statistic begins with.
LEADING_NUMBER_PATTERN = r"^([\d.]+)"


def leading_number(v: Column) -> Column:
    """``412 (86%)`` -> ``412``; a text without leading number stays."""
    return F.coalesce(extract(v, LEADING_NUMBER_PATTERN), blank_to_null(v))


def strip_label(text: Column, label: str = "Referee:") -> Column:
    """drop the first occurrence of the label; blank becomes NULL."""
    cut = F.instr(text, label)
    without = F.when(
        cut > 0,
        F.concat(F.substring(text, F.lit(1), cut - 1), F.substring(text, cut + len(label), F.length(text))),
    ).otherwise(text)
    return blank_to_null(strip(without))


def first_line(text: Column) -> Column:
    """F22."""
    return F.substring_index(text, "\n", 1)


def last_line(text: Column) -> Column:
    """The value of an entry without a value element; empty for one line."""
    return F.when(F.contains(text, F.lit("\n")), strip(F.substring_index(text, "\n", -1))).otherwise("")


def info_entry(entries: Column, *labels: str) -> Column:
    """value of the last entry whose text names one of ``labels``.

    ``entries`` is ``array<struct<text, span>>``: visible text of the entry and
    of its value element, if it has one.
    """

    def names_it(e: Column) -> Column:
        text = F.lower(e["text"])
        hit = F.contains(text, F.lit(labels[0]))
        for label in labels[1:]:
            hit = hit | F.contains(text, F.lit(label))
        return hit

    values = F.transform(F.filter(entries, names_it), lambda e: F.coalesce(strip(e["span"]), last_line(e["text"])))
    return F.try_element_at(values, F.lit(-1))


def first_pair(*candidates: Column) -> Column:
    """the first array that holds at least two items."""
    return F.coalesce(*[F.when(F.size(c) >= 2, c) for c in candidates])
