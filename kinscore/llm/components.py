"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two (aggregate, join) steps over the link table, whose size never grows; the
state is checkpointed after every round, so the lineage stays short and a lost executor costs
one round. A hub node is met by a partial aggregate and by a join that adaptive execution may
split. Rounds grow with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinscore.llm.common import saved


def _star(links: DataFrame, smaller: bool) -> DataFrame:
    """Hang the neighbours of every node on the smallest of them (or on the node itself).

    ``smaller`` picks the small star (neighbours below the node, and the node itself);
    otherwise the large star (neighbours above the node)."""
    up = links.select("u", "v")
    if smaller:
        seen = up.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = seen.groupBy("u").agg(F.min("v").alias("m"))
        hung = seen.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(low.select("u", F.col("m").alias("v")))
    else:
        seen = up.unionByName(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        hung = seen.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``; the root is the smallest node that the
    node reaches. Self links and repeated links have no effect; an empty table gives none."""
    now = saved(links.where("u <> v").distinct())
    mark = None
    while True:
        now = saved(_star(_star(now, smaller=False), smaller=True))
        row = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
