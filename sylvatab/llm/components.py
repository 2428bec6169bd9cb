"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.sources.tables import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it can reach, for each node
    of the edges ``a``, ``b`` (any type that has an order).

    Large-star and small-star steps in turn: each node's larger neighbours, then
    its smaller ones and itself, are linked to its smallest neighbour, until
    nothing changes. The smallest neighbour is an aggregate, combined before the
    shuffle. Each round is written to the shared folder, so lineage stays short.
    """
    links = written(edges.filter("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        links = written(_star(_star(links, larger=True), larger=False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # Every node but the smallest of a component is linked to that.
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links ``a`` > ``b`` after one step."""
    big, small = F.greatest("a", "b"), F.least("a", "b")
    one_way = links.select(big.alias("a"), small.alias("b"))
    if larger:
        seen = links.select("a", "b").union(links.select("b", "a"))
    else:
        seen = one_way
    least = seen.groupBy("a").agg(F.min("b").alias("m"))
    # Dealt out again before the join, so that the adaptive planner can split a
    # node with very many neighbours: it splits shuffles, not aggregates.
    joined = seen.join(least.hint("rebalance"), "a").withColumn("m", F.least("a", "m"))
    if larger:
        linked = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.filter(F.col("a") != F.col("b")).distinct()
