"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (``large``) or smaller neighbours below its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.join(lowest, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Edges with a null end and loops are dropped. Every round's edges are written to the
    shared folder; it ends when a round changes nothing, after about log(n) rounds.
    """
    now = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct())
    digest = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = digest(now)
    while was[0]:
        now = cut(_stars(_stars(now, True), False))
        mark = digest(now)
        if mark == was:
            break
        was = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
