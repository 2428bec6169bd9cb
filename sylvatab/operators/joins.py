"""Natural and keyed joins with the missing-value rules of data frames: a
missing key matches a missing key, and without an explicit key every shared
column is part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sylvatab.operators.skew import prefixed, quoted, same_key, skew_join


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("the two tables share no column to join on")
    return keys


def natural_join(
    left: DataFrame, right: DataFrame, how: str = "inner", balanced: bool = False
) -> DataFrame:
    """Join on every shared column; key columns appear once.

    For the right and full forms the key comes from whichever side has the row.
    ``balanced`` takes the form in which the adaptive planner can split hot keys
    of either side.
    """
    keys = shared_columns(left, right)
    if balanced:
        if how == "inner":
            return skew_join(left, right, keys)
        return {"left": keep_all_left, "right": keep_all_right, "full": keep_all}[how](left, right)
    other = prefixed(right, keys, "__r_")
    joined = left.join(other, same_key(left, other, [(k, f"__r_{k}") for k in keys]), how)
    columns = []
    for c in left.columns:
        if c not in keys or how in ("inner", "left"):
            columns.append(F.col(f"`{c}`"))
        elif how == "right":
            columns.append(F.col(f"`__r_{c}`").alias(c))
        else:
            columns.append(F.coalesce(F.col(f"`{c}`"), F.col(f"`__r_{c}`")).alias(c))
    rest = [c for c in right.columns if c not in keys]
    return joined.select(*columns, *quoted(rest))


def keep_all_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Natural left join in a form in which hot keys of either side can be split."""
    keys = shared_columns(left, right)
    right = _with_partners(right, _lonely(left, right, keys, of_left=True))
    joined = skew_join(right, left, keys, "inner")
    rest = [c for c in right.columns if c not in keys]
    return joined.select(*quoted(left.columns), *quoted(rest))


def keep_all_right(left: DataFrame, right: DataFrame) -> DataFrame:
    """Natural right join: the mirror of :func:`keep_all_left`."""
    joined = keep_all_left(right, left)
    return joined.select(*quoted(left.columns), *quoted([c for c in right.columns if c not in left.columns]))


def keep_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Natural full join in a form in which hot keys of either side can be split."""
    keys = shared_columns(left, right)
    lonely = _lonely(left, right, keys, of_left=True, of_right=True)
    right = _with_partners(right, lonely.filter("__l = 1"))
    left = _with_partners(left, lonely.filter("__r = 1"))
    joined = skew_join(right, left, keys, "inner")
    rest = [c for c in right.columns if c not in keys]
    return joined.select(*quoted(left.columns), *quoted(rest))


def _lonely(
    left: DataFrame, right: DataFrame, keys: list[str], of_left: bool = False, of_right: bool = False
) -> DataFrame:
    """Keys that only one side has, with ``__l`` and ``__r``, 1 for the side that
    has them and 0 for the other.

    An outer join keeps rows without a partner, and Spark can split a hot key only
    on the side that is kept. So these keys are found first, by one union of both
    sides' keys and one aggregate, combined before the shuffle and as long as the
    keys are many; each gets a partner without values, and the join is an inner one,
    which can be split on both sides.
    """
    mine = left.select(*quoted(keys), F.lit(1).alias("__l"), F.lit(0).alias("__r"))
    theirs = right.select(*quoted(keys), F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    counted = mine.unionAll(theirs).groupBy(*quoted(keys)).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    wanted = [s for s, w in (("__l > __r", of_left), ("__r > __l", of_right)) if w]
    return counted.filter(" OR ".join(wanted))


def _with_partners(df: DataFrame, lonely: DataFrame) -> DataFrame:
    """``df`` and one row for each lonely key, its other columns null.

    The nulls are read from an empty array: a later join on such a column would
    otherwise find a constant there, and its condition be reduced to a test of one
    side, which leaves a join without a key.
    """
    columns = [
        F.col(f"`{f.name}`")
        if f.name in lonely.columns
        else F.get(F.array().cast(ArrayType(f.dataType)), F.col("__l")).alias(f.name)
        for f in df.schema
    ]
    return df.unionByName(lonely.select(*columns))


def join_keep_right(left: DataFrame, right: DataFrame, by: list[str], clash: list[str]) -> DataFrame:
    """Inner join on ``by`` where both sides also hold the ``clash`` columns:
    the left copies are dropped and the right copies kept."""
    return skew_join(right, left.drop(*clash), by, "inner")


def members_of(df: DataFrame, values: DataFrame, column: str, value_column: str | None = None) -> DataFrame:
    """Rows whose value occurs in a computed set (a missing value is a value)."""
    return skew_join(df, _value_set(values, column, value_column), [column], "left_semi")


def non_members_of(df: DataFrame, values: DataFrame, column: str, value_column: str | None = None) -> DataFrame:
    """Rows whose value does not occur in a computed set."""
    return skew_join(df, _value_set(values, column, value_column), [column], "left_anti")


def _value_set(values: DataFrame, column: str, value_column: str | None) -> DataFrame:
    return values.select(F.col(f"`{value_column or column}`").alias(column)).distinct()
