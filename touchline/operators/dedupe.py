"""One row per key by an explicit order.

``row_number() <= n`` plans a group limit below the shuffle: every task keeps
only its own best ``n`` rows per key, so a key that holds a third of the table
sends a handful of rows per task and not the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """A1, A2: the last row per key; ``order`` is ascending and missing values
    come first. Rows without key count as one group."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return first_n(df, keys, [c.desc_nulls_last() for c in cols], 1)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """A7 across pages: the first row per key."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return first_n(df, keys, [c.asc_nulls_last() for c in cols], 1)


def top_by_id(cards: DataFrame, n: int = 10) -> DataFrame:
    """O2: the ``n`` smallest match ids of every matchweek."""
    return first_n(cards, ["season", "matchweek"], [F.col("match_id").asc()], n)
