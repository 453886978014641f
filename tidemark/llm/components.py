"""Connected components of links between numbered nodes, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held


def fresh(name: str) -> Column:
    """The same number, derived anew.

    A side that an aggregate or window has already dealt by its key gets no
    shuffle of its own below a join, and AQE splits hot keys only there.
    """
    return F.col(name).bitwiseXOR(F.lit(0).cast("long"))


def _to_least(links: DataFrame) -> DataFrame:
    """Links ``(u, v)`` with ``m``, the least of ``u`` and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(fresh("u").alias("__u"), F.least("u", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("__u")).drop("__u")


def _state(links: DataFrame) -> tuple:
    # Sums of unsigned 32-bit parts cannot overflow a decimal.
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links(a, b)``.

    Large-star and small-star steps alternate until nothing changes; rounds
    grow with the logarithm of the longest path. Each round is written to the
    shared folder. Minima combine before they are shuffled, and AQE can split
    the join of a hub with many neighbours. Links to the node itself are
    allowed, null ends are dropped.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).na.drop()
    star = held(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _state(star)
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_least(large).select(
            F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("x")
        ).select("x.u", "x.v").where("u > v").distinct()
        star = held(small)
        after = _state(star)
        if after == before:
            break
        before = after
    roots = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    alone = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # A node without a link to a lesser one is its own root.
    return (
        alone.join(roots.select(fresh("node").alias("__node"), "root"), F.col("node") == F.col("__node"), "left")
        .select("node", F.coalesce("root", "node").alias("root"))
    )
