"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a minimum per node (partial aggregation first) and a join of the links with it; no node's neighbours
are ever gathered in one row, so a hub with millions of links is split like any skewed join. The labels of a round
are written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u")
    return near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v, longs); component is the smallest node reachable.

    Self links and repeated links are allowed and change nothing; an empty table gives an empty one.
    """
    now = materialise(spark, links.where("u <> v").select("u", "v").distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        nxt = _small_star(_large_star(now)).where("u <> v").distinct()
        now = materialise(spark, nxt, "links")
        fresh = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if fresh == mark:
            break
        mark = fresh
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
