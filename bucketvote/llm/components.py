"""Connected components as DataFrame jobs.

Alternates two joins until no label moves: every node learns the smallest
node among its neighbours, and neighbours are then linked to that node
instead (stars shrink onto their smallest member).  Both steps are a grouped
minimum (combined before its shuffle) and an equi-join whose large side is
the edges, so a hub with very many links is split by Spark's skew join and
never gathered in one task.  Each round is cut with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _directed(edges: DataFrame, larger_first: bool) -> DataFrame:
    hi, lo = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    one = edges.select(hi, lo)
    return one if larger_first else one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction step; ``large`` links larger neighbours, else smaller."""
    sided = _directed(edges, larger_first=not large)
    least = sided.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sided.join(least, "u")
    if large:
        new = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return new.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node
    reachable.  Null ends and self links are ignored (a node that only links
    to itself is its own root and need not be listed).  No edges: no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    seen = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        now = _star(_star(now, large=True), large=False).checkpoint()
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(rooted.select(F.col("root").alias("node"), "root").distinct())
