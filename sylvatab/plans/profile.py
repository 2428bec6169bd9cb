"""Checks made before a table is used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.operators.summaries import column_ranges, column_run, mark_repeated, pretty_histogram


def check_coordinates(sites: DataFrame, name: str = "Site_name") -> DataFrame:
    """Are the coordinates present and on the globe, and is the name its own."""
    marked = mark_repeated(sites, name)
    lat_ok = F.coalesce(F.col("Latitude").between(-90, 90), F.lit(False))
    lon_ok = F.coalesce(F.col("Longitude").between(-180, 180), F.lit(False))
    marked = marked.withColumn("latitude_ok", lat_ok).withColumn("longitude_ok", lon_ok)
    marked = marked.withColumn("name_unique", ~F.col("repeated")).drop("repeated")
    return marked.withColumn(
        "sensible", F.col("latitude_ok") & F.col("longitude_ok") & F.col("name_unique")
    )


def profile(
    df: DataFrame,
    runs: list[tuple[str, str]],
    single: list[str] = (),
    na_rm: bool = False,
    sizes: str | None = None,
) -> DataFrame:
    """Ranges and null, NaN, infinite and zero counts for runs of columns (given
    by first and last name) and for single columns, in one pass.

    With ``sizes`` also the histogram of that column: rows with ``lower``,
    ``upper`` and ``n`` of each bin, the rest null.
    """
    columns = [c for first, last in runs for c in column_run(df, first, last)]
    ranges = column_ranges(df, [*columns, *single], na_rm)
    if sizes is None:
        return ranges
    bins = pretty_histogram(df, sizes).withColumn("variable", F.lit(sizes))
    return ranges.unionByName(bins, allowMissingColumns=True)


