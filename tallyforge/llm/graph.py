"""Connected components of a link table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import stage


def _mark(edges: DataFrame) -> tuple:
    """Count and two order-free sums of a set of links; equal marks mean an equal set but for a chance of 2**-64."""
    part = lambda seed: F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), part(1), part(2)).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(u, v)`` links (long ids) to ``(node, component)``, the smallest reachable id; ids without links are absent.

    Every step is a shuffle of the links and ends in files of the shared folder, so no id list is ever held by the
    driver and a lost executor repeats one step only. Null ends and self-links are ignored; an empty table gives
    none. Raises if ``rounds`` steps do not settle (a chain of 2**30 nodes needs about 60).
    """
    edges = stage(
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    now = _mark(edges)
    for _ in range(rounds):
        # large star: each node hands its larger neighbours to the smallest node it knows
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node hands its smaller neighbours, and itself, to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        after = stage(small, "stars")
        before, now = now, _mark(after)
        edges = after
        if now == before:
            nodes = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
            return nodes.unionByName(roots.join(nodes.select("node"), "node", "left_anti"))
    raise RuntimeError("components did not settle")
