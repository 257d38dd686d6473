"""Long and wide forms of Silver statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

_SIDES = ("home", "away")


def explode_stats(docs: DataFrame, column: str = "statistics") -> DataFrame:
    """one row per entry of a raw statistics map."""
    return docs.select("*", F.explode(column).alias("stat_name", "stat_json"))


def to_long(flat: DataFrame) -> DataFrame:
    """One row per match, side and statistic. No shuffle."""

    def sides(e: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(side).alias("side"),
                    e["key"].alias("stat"),
                    *[e["value"][side][k].alias(k) for k in ("value", "pct", "text")],
                )
                for side in _SIDES
            ]
        )

    entries = F.flatten(F.transform(F.map_entries("stats"), sides))
    return flat.select("match_id", "season", "matchweek", F.explode(entries).alias("s")).select(
        "match_id", "season", "matchweek", "s.*"
    )


def stat_columns(pick: Callable[[str], Column], names: Sequence[str], prefix: str = "", text: bool = True) -> list[Column]:
    """``x`` and ``x_pct`` (and ``x_text``) of each name; ``pick`` gives the
    parsed statistic of a name."""
    out = []
    for name in names:
        stat = pick(name)
        out.append(stat["value"].alias(f"{prefix}{name}"))
        if f"{name}_pct" not in names:
            out.append(stat["pct"].alias(f"{prefix}{name}_pct"))
        if text:
            out.append(stat["text"].alias(f"{prefix}{name}_text"))
    return out


def to_wide(flat: DataFrame, names: Sequence[str], text: bool = True) -> DataFrame:
    """One wide row per match, by lookup in the map of the row. No shuffle."""
    fixed = [c for c in flat.columns if c != "stats"]
    wide = []
    for side in _SIDES:
        wide += stat_columns(lambda n: F.col("stats")[n][side], names, f"{side}_", text)
    return flat.select(*fixed, *wide)


def stat_pivot(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row per match from long rows.

    The names are given, so no extra job looks for them. There is one shuffle,
    on the match, and it carries partial results: a match with very many rows
    is one row per task before it travels.
    """
    columns = []
    for side in _SIDES:
        for name in names:
            here = (F.col("side") == side) & (F.col("stat") == name)
            columns.append(F.max(F.when(here, F.col("value"))).alias(f"{side}_{name}"))
            columns.append(F.max(F.when(here, F.col("pct"))).alias(f"{side}_{name}_pct"))
    return long.where(F.col("stat").isin(*names)).groupBy("match_id").agg(*columns)


def stat_names(long: DataFrame) -> list[str]:
    """The statistic vocabulary, for wide exports without a given dictionary: the
    names that become the columns of the export."""
    return [r["stat"] for r in long.select("stat").distinct().orderBy("stat").collect()]
