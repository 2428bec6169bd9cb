"""Counts, duplicates, ranges and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.operators.skew import quoted, skew_join


def column_run(df: DataFrame, first: str, last: str) -> list[str]:
    """Names of the columns from ``first`` to ``last`` in table order."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*quoted(list(columns))).agg(F.count(F.lit(1)).alias("n"))


def having_more_than(counts: DataFrame, n: int) -> DataFrame:
    """Groups with more than ``n`` rows, without the count."""
    return counts.filter(F.col("n") > n).drop("n")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """The set of values that occur more than once; null counts as a value."""
    return having_more_than(count_by(df, column), 1)


def mark_repeated(df: DataFrame, column: str, mark: str = "repeated") -> DataFrame:
    """Add a boolean: does the row's value occur more than once.

    Counting then joining, rather than a window: a window would bring the whole
    of a hot group into one task.
    """
    counts = df.groupBy(*quoted([column])).agg(F.count(F.lit(1)).alias("__rows"))
    more = counts.filter(F.col("__rows") > 1).select(*quoted([column]), F.lit(True).alias(mark))
    joined = skew_join(df, more, [column], "left")
    return joined.withColumn(mark, F.coalesce(mark, F.lit(False)))


def duplicate_groups(df: DataFrame, column: str) -> DataFrame:
    """All rows whose value occurs more than once."""
    return mark_repeated(df, column, "__repeated").filter("__repeated").drop("__repeated")


def one_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row that comes first by ``order`` within each key.

    An aggregate over the row as a struct, so that each map task already
    reduces its copies of a key to one row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*quoted([c for c in order if c not in keys]), *quoted(rest))
    kept = df.groupBy(*quoted(keys)).agg(F.min(row).alias("__row"))
    return kept.select(*quoted(keys), "__row.*").select(*quoted(df.columns))


def column_ranges(df: DataFrame, columns: list[str], na_rm: bool = False) -> DataFrame:
    """Smallest and largest value per column, with null, NaN, infinite and zero
    counts; one scan and one aggregate for all columns.

    Without ``na_rm`` the range of a column that holds a null or NaN is null.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        present = F.when(x.isNotNull() & ~F.isnan(x), x)
        aggs += [
            F.min(present).alias(f"lo{i}"),
            F.max(present).alias(f"hi{i}"),
            _count(x.isNull()).alias(f"null{i}"),
            _count(F.isnan(x)).alias(f"nan{i}"),
            _count(F.abs(x) == float("inf")).alias(f"inf{i}"),
            _count(x == 0).alias(f"zero{i}"),
        ]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(columns):
        usable = F.lit(True) if na_rm else (F.col(f"null{i}") == 0) & (F.col(f"nan{i}") == 0)
        rows.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.when(usable, F.col(f"lo{i}")).alias("min"),
                F.when(usable, F.col(f"hi{i}")).alias("max"),
                F.col(f"null{i}").alias("n_null"),
                F.col(f"nan{i}").alias("n_nan"),
                F.col(f"inf{i}").alias("n_inf"),
                F.col(f"zero{i}").alias("n_zero"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def _count(test: Column) -> Column:
    return F.count(F.when(test, 1))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal-width bins from the smallest to the largest value.

    The last bin includes its upper edge; null, NaN and infinite values are left
    out (:func:`column_ranges` counts them); empty bins give no row. The edges are
    scalar subqueries, so nothing comes to the driver.
    """
    values = _finite(df, column)
    lo = values.agg(F.min("x").alias("lo")).scalar()
    width = values.agg(((F.max("x") - F.min("x")) / bins).alias("width")).scalar()
    place = F.when(width == 0, 0).otherwise(F.floor((F.col("x") - lo) / F.nullif(width, F.lit(0.0))))
    binned = values.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("lower"), "n")


def _finite(df: DataFrame, column: str) -> DataFrame:
    """The finite values of a column, as ``x``."""
    x = F.col(f"`{column}`").cast("double")
    return df.select(x.alias("x")).filter(F.abs("x") < float("inf"))


def pretty_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Histogram on rounded edges: the bin width is 1, 2, 5 or 10 times a power
    of ten, chosen near (largest - smallest) / ``bins``; a bin holds the values
    above its lower edge up to and including its upper edge, and the first bin
    also holds its lower edge. Where all values are equal the width is chosen as
    for a range of their size (of 1 for zeros). Null, NaN and infinite values are
    left out.
    """
    values = _finite(df, column)
    span = F.max("x") - F.min("x")
    size = F.when(F.max(F.abs("x")) > 0, F.max(F.abs("x"))).otherwise(1.0)
    cell = F.when(span > 0, span).otherwise(size) / bins
    power = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    # The bias of the usual rounded-edges rule towards wider bins.
    bias, bias5 = 1.5, 2.75
    steps = [(2, bias, 1), (5, bias5, 2), (10, bias, 5)]
    unit = reduce(
        lambda acc, s: F.when(s[0] * power - cell < s[1] * (cell - s[2] * power), s[0] * power).otherwise(acc),
        steps,
        power,
    )
    width = values.agg(unit.alias("width")).scalar()
    low = values.agg(F.min("x").alias("lo")).scalar()
    first = F.floor(low / width + 1e-7)
    place = F.greatest(F.ceil(F.col("x") / width - 1e-7) - 1, first).cast("long")
    binned = values.select(place.alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        (F.col("bin") * width).alias("lower"), ((F.col("bin") + 1) * width).alias("upper"), "n"
    )
