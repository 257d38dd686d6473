"""Expressions over raw statistic values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline import schemas
from touchline.functions.text import WHITESPACE, strip

# A finite decimal number: sign, digits with single underscores between them,
# fraction, exponent. A plain cast would also take "5f" or "0x1p3".
_DIGITS = r"\d+(?:_\d+)*"
NUMBER_PATTERN = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
NAN_PATTERN = r"(?i)^[+-]?nan$"

# Fixed value: a count with its percentage, anywhere in the text.
PAIR_PATTERN = r"([\d\.]+)\s*\(([\d\.]+)%\)"


def number(text: Column) -> Column:
    """DOUBLE of a numeric text, else NULL. "Not a number" is NULL too."""
    low = F.lower(text)
    return (
        F.when(text.rlike(NUMBER_PATTERN), F.translate(text, "_", "").try_cast("double"))
        .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
    )


def _is_pair(s: Column) -> Column:
    return F.contains(s, F.lit("(")) & s.rlike(PAIR_PATTERN)


def pair_value(s: Column) -> Column:
    """F3b, the count of ``12 (60%)``."""
    return F.when(_is_pair(s), F.regexp_extract(s, PAIR_PATTERN, 1).try_cast("double"))


def pair_percent(s: Column) -> Column:
    """F3b, the percentage of ``12 (60%)``."""
    return F.when(_is_pair(s), F.regexp_extract(s, PAIR_PATTERN, 2).try_cast("double"))


def km_value(s: Column) -> Column:
    """``101.2km``."""
    low = F.lower(s)
    return F.when(F.endswith(low, F.lit("km")), number(strip(F.replace(low, F.lit("km"), F.lit("")))))


def percent_value(s: Column) -> Column:
    """F3d: ``55%``."""
    return F.when(F.endswith(s, F.lit("%")), number(strip(F.rtrim(s, F.lit("%")))))


def int_value(s: Column) -> Column:
    """F3e: digits only."""
    return F.when(s.rlike(r"^\d+$"), s.try_cast("double"))


# Every "km" of a text that ends in it, or the percent signs at the end.
_UNIT_PATTERN = r"(?s)km(?=.*km\z|\z)|%+\z"


def scalar_text(raw: Column) -> Column:
    """What has to be a number: the text without its unit. A text with a unit
    is a number without it or not at all."""
    return strip(F.regexp_replace(F.lower(strip(raw)), _UNIT_PATTERN, ""))


# The usual forms in one pattern: a number, alone or with one suffix. A match
# always gives a number.
_USUAL_PATTERN = (
    r"^\s*+([+-]?+(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+)\s*+(?:[kK][mM]|%++)?+\s*+$"
)

# What a number outside the usual forms must contain: an infinity, a repeated
# unit, digit groups, or white space beyond the common kinds.
_UNUSUAL_PATTERN = r"(?i)inf|km.*km|_|[^\x20-\x7e\t\n\x0b\f\r]"


def stat_value(raw: Column) -> Column:
    """The number of a raw text. Texts outside the usual forms take the long way."""
    return (
        F.when(raw.isNull(), F.lit(None).cast("double"))
        .when(raw.rlike(_USUAL_PATTERN), F.regexp_extract(raw, _USUAL_PATTERN, 1).try_cast("double"))
        .when(_is_pair(raw), F.regexp_extract(raw, PAIR_PATTERN, 1).try_cast("double"))
        .when(raw.rlike(_UNUSUAL_PATTERN), number(scalar_text(raw)))
    )


def parse_stat(raw: Column) -> Column:
    """raw text -> ``struct<value double, pct double, text string>``.

    ``text`` keeps what is no number, so no value is lost to typing.
    """
    return F.struct(
        stat_value(raw).alias("value"),
        pair_percent(raw).alias("pct"),
        F.when(~raw.rlike(_USUAL_PATTERN), F.when(stat_value(raw).isNull(), other_text(raw))).alias("text"),
    )


def other_text(raw: Column) -> Column:
    """F3f: the stripped text of a value that is no number; NaN is nothing."""
    s = strip(raw)
    return F.when(~s.rlike(NAN_PATTERN), s)


def is_object(json_text: Column) -> Column:
    """The JSON text is an object."""
    return F.startswith(json_text, F.lit("{")) | F.startswith(F.ltrim(json_text, F.lit(WHITESPACE)), F.lit("{"))


def keep_struct_stats(stats: Column) -> Column:
    """Drop map entries whose value is no JSON object."""
    return F.map_filter(stats, lambda _, v: is_object(v))


def keep_home_away(stat_json: Column) -> Column:
    """The ``home`` and ``away`` members of a statistic object."""
    return F.from_json(stat_json, schemas.STAT_PAIR)


def possession_repair(name: Column, pair: Column) -> Column:
    """a percentage that slipped into the name column. The pair of values is
    looked at only for such a name."""
    shifted = (
        F.contains(name, F.lit("%"))
        & name.rlike(r"\d")
        & (pair["home"].eqNullSafe("Possession") | pair["away"].eqNullSafe("Possession"))
    )
    return F.when(shifted, F.lit("Possession")).otherwise(name)
