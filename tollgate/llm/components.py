"""Connected components of an edge table, by alternating large-star and small-star steps.

Both steps are one partial aggregation (the least neighbour of each node, so a
hub costs one row per task), which is written, and one join back.  As the written
table has each node once and both sides of the join are plain shuffles, adaptive
execution can split a hub's edges over tasks.  Each round is written to the shared
folder; only two numbers per round reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.storage import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else \
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = settle(least, "least")
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Nodes that have a link, with the least node they reach: (node, component).

    *edges* has two columns of node ids (long); loops and repeated edges are
    ignored.  Nodes without links are absent; an empty table gives no rows.
    """
    now = settle(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
                 .where("u != v").distinct(), "edges")
    state = None
    while True:
        now = settle(_star(_star(now, large=True), large=False), "edges")
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (row.n, row.h) == state or row.n == 0:
            break
        state = (row.n, row.h)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
