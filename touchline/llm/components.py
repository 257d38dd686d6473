"""Connected components by contraction, as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import stored


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for every
    node of ``edges`` (columns ``a`` and ``b``, long).

    In a round every node goes to the best of its neighbours and itself, and
    edges are carried to where their ends went. The best has most neighbours in
    every other round, which draws stars together at once, and the smallest hash
    in the rest. Hashes change from round to round, so chains shrink by a
    constant share too, and the rounds grow with the logarithm of the nodes. Every round is written to the shared folder; the
    driver learns only whether edges are left.
    """
    left = stored(edges.where("a != b").select("a", "b").distinct(), name)
    moves = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if len(moves) % 2 == 0:
            size = both.groupBy("a").count()
            both = both.join(size.select(F.col("a").alias("b"), (-F.col("count")).alias("of_b")), "b")
            both = both.join(size.select("a", (-F.col("count")).alias("of_a")), "a")
        else:
            both = both.withColumns({"of_a": F.lit(0), "of_b": F.lit(0)})

        def rank(node: str):
            return F.struct(F.col(f"of_{node}").alias("o"), F.xxhash64(node, F.lit(len(moves))).alias("h"), F.col(node).alias("n"))

        best = both.groupBy("a").agg(F.min(F.least(rank("a"), rank("b"))).alias("m"))
        moved = stored(best.select(F.col("a").alias("node"), F.col("m")["n"].alias("to")), name)
        moves.append(moved)
        ends = left.join(moved.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(moved.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = stored(
            ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name
        )
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = moves[-1]
    for earlier in reversed(moves[:-1]):
        later = found.select(F.col("node").alias("to"), F.col("to").alias("end"))
        found = earlier.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    found = stored(found, name)
    least = stored(found.groupBy("to").agg(F.min("node").alias("component")), name)
    return found.join(least, "to").select("node", "component")
