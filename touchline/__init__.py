"""Match-statistics medallion engine on Spark DataFrames.

Layers: stored pages -> Bronze documents -> Silver (one row per match with a
statistics map per side, plus long and wide forms) -> Gold (one row per match
seen from one team) -> masters over all seasons.
"""

from touchline.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
