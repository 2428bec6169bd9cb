"""Union by name, set difference, appended rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.operators.skew import quoted


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; null counts as a value.

    One grouped count over both inputs instead of distinct plus anti join: a
    single shuffle, and the map side already reduces a hot value to one row.
    """
    keys = left.columns
    right = right.toDF(*keys)
    both = left.withColumn("__in_right", F.lit(False)).union(right.withColumn("__in_right", F.lit(True)))
    grouped = both.groupBy(*quoted(keys)).agg(F.bool_or("__in_right").alias("__in_right"))
    return grouped.filter(~F.col("__in_right")).drop("__in_right")


def append_rows(df: DataFrame, rows: list[dict]) -> DataFrame:
    """Add literal rows; columns a row does not name are null."""
    if not rows:
        return df
    named = [f for f in df.schema.fields if any(f.name in r for r in rows)]
    schema = df.select(*quoted([f.name for f in named])).schema
    values = [tuple(r.get(f.name) for f in named) for r in rows]
    extra = df.sparkSession.createDataFrame(values, schema)
    return df.unionByName(extra, allowMissingColumns=True)
