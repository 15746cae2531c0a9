"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.runtime import discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("_least"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("_least").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    least = down.groupBy("src").agg(F.min("dst").alias("_least"))
    moved = down.join(least, "src").where("dst <> _least").select(F.col("dst").alias("src"), F.col("_least").alias("dst"))
    return moved.unionByName(least.select("src", F.col("_least").alias("dst"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst): root is the smallest node of its component.

    Nulls and self-loops are ignored; nodes without an edge to another node are absent. Each round writes the
    contracted edges to the shared folder, so lost executors cost one round at most; a node with very many edges is
    reduced by a partial aggregate before it is shuffled. The number of rounds grows with the logarithm of the longest
    chain.
    """
    current = materialize(edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct(), "edges")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        following = materialize(_small_star(_large_star(current)), "edges")
        new_state = _state(following)
        discard(current)
        current, unchanged, state = following, new_state == state, new_state
        if unchanged:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return current.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        current.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    )
