"""Ranks of all rows of a table without one ordered partition."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.sources.tables import written

#: ``monotonically_increasing_id`` holds the row's place in the lower bits.
PLACE_BITS = 33


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """All rows and columns with ``__rank``, 1, 2, 3 ... in this order.

    Rows are dealt out by ranges and numbered in each; what goes before a range
    is the sum of the sizes of those before it, one number for each range. Rows
    that the order does not tell apart are numbered in any order. The table is
    written in between, so that both looks at it see the same ranges.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("__at", PLACE_BITS), F.col("__at").bitwiseAND((1 << PLACE_BITS) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = accumulate((r["n"] for r in sizes[:-1]), initial=0)
    starts = df.sparkSession.createDataFrame(
        [(r["part"], b) for r, b in zip(sizes, before)], "__part bigint, __before bigint"
    )
    joined = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return joined.withColumn("__rank", F.col("__before") + place + 1).drop("__part", "__before", "__at")
