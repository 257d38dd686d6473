"""Expressions over scores and results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline import schemas
from touchline.functions.text import strip

# A JSON number with fraction or exponent, as opposed to a quoted text.
_WHOLE = r"^[+-]?\d+$"


def json_score_text(raw_info: Column, info: Column, key: str) -> Column:
    """Text of a score with a JSON number cut to its whole part.

    2.7 is read as 2 but "2.7" is no whole number, and the string map no longer
    shows which it was; the raw JSON does. The variant is built only for the
    rare value that is not plain digits.
    """
    text = info[key]
    as_number = F.try_variant_get(F.try_parse_json(raw_info), f"$.{key}", "variant")
    fraction = F.schema_of_variant(as_number).rlike("DECIMAL|DOUBLE|FLOAT")
    whole = F.try_variant_get(F.try_parse_json(raw_info), f"$.{key}", "double")
    cut = F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole)).cast("string")
    return F.when(text.isNull() | text.rlike(_WHOLE), text).when(fraction, cut).otherwise(text)


def coerce_score(text: Column) -> Column:
    """Whole number, 0 for anything else, NULL stays NULL."""
    s = strip(text)
    return F.when(text.isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(F.when(s.rlike(r"^[+-]?\d+(?:_\d+)*$"), F.translate(s, "_", "").try_cast("int")), F.lit(0))
    )


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def result_wdl(scored: Column, conceded: Column, unplayed: str | None = "D") -> Column:
    """W, L or D. A missing or non-numeric score makes the match a D;
    ``unplayed`` gives another result for matches without both scores."""
    gs, gc = nan_to_null(scored.try_cast("double")), nan_to_null(conceded.try_cast("double"))
    wdl = F.when(gs > gc, "W").when(gs < gc, "L").otherwise("D")
    if unplayed == "D":
        return wdl
    return F.when(gs.isNull() | gc.isNull(), F.lit(unplayed).cast("string")).otherwise(wdl)


def played_status(home_score: Column, away_score: Column) -> Column:
    """PLAYED once both scores are whole numbers."""
    def whole(score: Column) -> Column:
        return F.coalesce(strip(score.cast("string")).rlike(_WHOLE), F.lit(False))

    return F.when(whole(home_score) & whole(away_score), schemas.PLAYED).otherwise(schemas.SCHEDULED)
