"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import shared


def _toward_least(links: DataFrame) -> DataFrame:
    """For every node ``u`` and its neighbours ``v``: (u, v, m), m the least of them and u."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return links.join(least, "u")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)), F.sum(F.xxhash64("v", "u") % F.lit(1 << 31))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; component is the least node reachable.

    Each step is grouped aggregation and a join, written to the shared folder; the links never
    reach the driver, only their count and two hash sums do. The number of steps grows with the
    logarithm of the longest path. A node with very many links is a skewed join key, which Spark
    splits; its minimum is aggregated on the map side first.

    Cases: links with a null end and from a node to itself are no links; repeated links count
    once; no links give no rows.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = shared(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        toward = _toward_least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        small = (toward.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e = shared(small)
        now = _state(e)
        if now == state:
            break
        state = now
    return (e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
