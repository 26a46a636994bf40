"""Connected components by alternating large-star and small-star rounds.

Every round is two groupings by node with a map-side minimum, a join and a distinct; no
node's neighbours are ever gathered in one place.  A checkpoint ends each round, so a lost
executor costs one round at most.

With ``split_hubs`` the least neighbours are checkpointed too before the links are joined with
them: both sides of the join are then plain shuffles, and adaptive execution can split a
hub's links over many tasks (above an aggregate it can't) or broadcast few least neighbours.
It costs two more jobs a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _stamp(edges: DataFrame) -> tuple:
    """Tells two edge sets apart without comparing them row by row."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame, split_hubs: bool = False) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = cut(least) if split_hubs else least
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame, split_hubs: bool = False) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = cut(least) if split_hubs else least
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, split_hubs: bool = False) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``edges`` but the least one of each component.

    ``component`` is the least node reachable.  Self-links, repeated links and links with a
    null end add nothing.  Nodes may be of any orderable type.  An empty table gives an
    empty result.  Raises if ``max_rounds`` rounds do not suffice (depth is logarithmic).
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = cut(e)
    before = _stamp(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = cut(_small_star(_large_star(e, split_hubs), split_hubs))
        after = _stamp(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
