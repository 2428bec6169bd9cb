"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def same_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality over all pairs of columns."""
    tests = [left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def prefixed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def match_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join (inner, left, left_semi or left_anti).

    For tables already reduced to names. The driving side is on the left, the
    side that the adaptive planner can split when it finds a skewed partition.
    """
    other = prefixed(right, keys, "__r_")
    joined = left.join(other, same_key(left, other, [(k, f"__r_{k}") for k in keys]), how)
    rest = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*quoted(left.columns), *quoted(rest))


def skew_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join of a row-level table, where one key may hold a third
    of all rows, with a table that has few rows for each key.

    ``how`` is inner, left, left_semi or left_anti, seen from ``big``: the forms
    in which the adaptive planner can split the driving side's hot partitions by
    map output, reading the other side's partition again for each part. Both
    sides come to the join from a shuffle of their own, which it needs for that.
    Where the result is grouped next by the same keys, deal it out anew first
    (``repartition`` by more columns), or the planner keeps the partitions whole.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not support {how!r}")
    return match_join(big, small, keys, how)
