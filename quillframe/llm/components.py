"""Connected components of an edge list, by alternating large and small stars.

Every round is a few joins and aggregations over the edges alone, written to the shared checkpoint
folder; the driver sees their number and a checksum, which stop changing at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common


def _with_least(edges: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) with m, the least b of their a. The centre of a large star is looked up, not joined in one task."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    return common.joined_to_hot(edges, least, "a", "degree", n)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = F.least("m", "a")
    return _with_least(both, 2 * n).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), least.alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    others = _with_least(down, n).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(down.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def labelled(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for every node of the edges (a, b)."""
    edges = common.checkpointed(edges.where("a <> b"))  # read several times below
    n = edges.count()
    now, seen = common.checkpointed(_small_star(edges, n)), None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen or not state["n"]:
            break
        now, seen = common.checkpointed(_small_star(_large_star(now, state["n"]), state["n"])), state
    common.freed(now.sparkSession)
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b"), F.col("b")).distinct())
