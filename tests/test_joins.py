import re

import pytest
from pyspark.sql import functions as F

from sylvatab.operators.joins import join_keep_right, members_of, natural_join, non_members_of
from sylvatab.operators.sets import append_rows, set_difference, union_by_name
from sylvatab.operators.skew import skew_join
from sylvatab.operators.summaries import (
    column_ranges,
    column_run,
    count_by,
    duplicate_groups,
    having_more_than,
    histogram,
    one_row_per_key,
    pretty_histogram,
    repeated_values,
)

LEFT = [(1, "a", 1.0), (1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (None, "a", 4.0), (None, None, 5.0)] + [
    (7, "hot", float(i % 3)) for i in range(30)
]
RIGHT = [(1, "a", "x"), (2, "b", "y"), (None, "a", "z"), (None, None, "w"), (7, "hot", "v"), (7, "hot", "u")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def tables(spark):
    left = spark.createDataFrame(LEFT, "k int, g string, v double")
    return left, spark.createDataFrame(RIGHT, "k int, g string, w string")


def expected(how):
    out, used = [], set()
    for k, g, v in LEFT:
        partners = [(i, r) for i, r in enumerate(RIGHT) if r[:2] == (k, g)]
        used |= {i for i, _ in partners}
        if how == "semi":
            out += [(k, g, v)] * bool(partners)
        elif how == "anti":
            out += [(k, g, v)] * (not partners)
        else:
            out += [(k, g, v, r[2]) for _, r in partners]
            out += [(k, g, v, None)] * (not partners and how in ("left", "full"))
    if how in ("right", "full"):
        out += [(k, g, None, w) for i, (k, g, w) in enumerate(RIGHT) if i not in used]
    return sorted(out, key=repr)


@pytest.mark.parametrize("balanced", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_natural_join_matches_missing_keys(tables, hot, how, balanced):
    got = natural_join(*tables, how, balanced).select("k", "g", "v", "w")
    assert rows(got) == expected(how)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_change_no_result(tables, hot, how):
    left, right = tables
    got = skew_join(left, right, ["k", "g"], how)
    assert rows(got) == expected(how.removeprefix("left_"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_split(spark, hot, how):
    big = spark.range(0, 4000, 1, 8).selectExpr("IF(id % 10 < 9, 1, id) AS k", "id AS v")
    joined = skew_join(big, spark.range(0, 4000, 1, 8).selectExpr("id AS k"), ["k"], how)
    assert joined.count() == 4000
    joined.collect()
    assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()


def test_join_reads_only_the_columns_it_needs(spark):
    def read(name):
        return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")

    line = read("lineitem").withColumnRenamed("l_partkey", "p_partkey")
    two = skew_join(line, read("part"), ["p_partkey"]).select("l_quantity", "p_size")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", two._jdf.queryExecution().executedPlan().toString())
    assert sorted(len(x.split(",")) for x in schemas) == [2, 2]


def test_no_shared_column_is_an_error(spark):
    with pytest.raises(ValueError):
        natural_join(spark.range(1), spark.range(1).withColumnRenamed("id", "x"))


def test_join_keeps_the_right_copy_of_a_clash(spark, hot):
    left = spark.createDataFrame([("n", None), ("m", "c9"), (None, "c")], "name string, code string")
    right = spark.createDataFrame([("n", "c1", 1), ("n", "c2", 2), (None, "c3", 3)], "name string, code string, v int")
    got = join_keep_right(left, right, ["name"], ["code"]).select("name", "code", "v")
    assert rows(got) == rows(right)


def test_membership_in_a_computed_set(tables, spark):
    left, _ = tables
    values = spark.createDataFrame([(2,), (None,), (2,)], "x int")
    assert len(rows(members_of(left, values, "k", "x"))) == 3
    assert len(rows(non_members_of(left, values, "k", "x"))) == len(LEFT) - 3


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "a int")
    b = spark.createDataFrame([(2,), (4,)], "b int")
    assert rows(set_difference(a, b)) == rows(spark.createDataFrame([(1,), (3,), (None,)], "a int"))
    assert rows(set_difference(a, spark.createDataFrame([(None,)], "b int"))) == [(1,), (2,), (3,)]
    u = union_by_name(a, b, a)
    assert u.columns == ["a", "b"] and u.count() == 12
    added = append_rows(a, [{"a": 9}, {}])
    assert added.count() == 7 and append_rows(a, []).count() == 5


def test_counts_and_duplicates(spark, hot):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "g string, v int")
    assert rows(having_more_than(count_by(df, "g"), 1)) == rows(repeated_values(df, "g")) == [("a",), (None,)]
    assert rows(duplicate_groups(df, "g")) == [("a", 1), ("a", 2), (None, 4), (None, 5)]
    assert rows(one_row_per_key(df, ["g"], ["v"])) == [("a", 1), ("b", 3), (None, 4)]


def test_ranges(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 0.0, 1.0), (0.0, None, float("nan"), 2.0), (3.0, 2.0, 1.0, float("inf"))],
        "a double, b double, c double, d double",
    )
    assert column_run(df, "b", "d") == ["b", "c", "d"]
    got = {r["variable"]: tuple(r)[1:] for r in column_ranges(df, df.columns).collect()}
    assert got["a"] == (0.0, 3.0, 0, 0, 0, 1)
    assert got["b"] == (None, None, 1, 0, 0, 0)
    assert got["c"] == (None, None, 0, 1, 0, 1)
    assert got["d"] == (1.0, float("inf"), 0, 0, 1, 0)
    kept = {r["variable"]: tuple(r)[1:3] for r in column_ranges(df, df.columns, na_rm=True).collect()}
    assert kept["b"] == (2.0, 5.0) and kept["c"] == (0.0, 1.0)


def test_histograms(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    assert [tuple(r) for r in histogram(df, "x", 5).orderBy("bin").collect()] == [
        (0, 0.0, 2), (1, 2.0, 2), (2, 4.0, 2), (3, 6.0, 2), (4, 8.0, 3)
    ]
    same = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [tuple(r) for r in histogram(same, "x", 5).collect()] == [(0, 4.0, 2)]
    assert [tuple(r) for r in pretty_histogram(df, "x", 5).orderBy("lower").collect()] == [
        (0.0, 2.0, 3), (2.0, 4.0, 2), (4.0, 6.0, 2), (6.0, 8.0, 2), (8.0, 10.0, 2)
    ]


def test_histograms_of_values_that_are_not_finite(spark):
    inf = float("inf")
    odd = spark.createDataFrame([(x,) for x in (1.0, 2.0, 5.0, inf, -inf, float("nan"), None)], "x double")
    assert sum(r.n for r in histogram(odd, "x", 4).collect()) == 3
    assert min(r.lower for r in histogram(odd, "x", 4).collect()) == 1.0
    edges = pretty_histogram(odd, "x", 4).collect()
    assert sum(r.n for r in edges) == 3 and all(r.lower < r.upper for r in edges)
    ranges = column_ranges(odd, ["x"], na_rm=True).first()
    assert (ranges.n_null, ranges.n_nan, ranges.n_inf) == (1, 1, 2)


@pytest.mark.parametrize("value", [0.0, 7.0, -250.0])
def test_histograms_of_a_constant(spark, value):
    same = spark.createDataFrame([(value,)] * 5, "x double")
    assert [tuple(r) for r in histogram(same, "x", 4).collect()] == [(0, value, 5)]
    (one,) = pretty_histogram(same, "x", 4).collect()
    assert one.lower <= value <= one.upper and one.upper > one.lower and one.n == 5


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_in_a_chain_keep_their_condition(spark, tables, hot, how):
    """A row without a partner has nulls that a later join must not take for constants."""
    left, right = tables
    third = spark.createDataFrame([("x", 1), (None, 2), ("q", 3)], "w string, n int")
    joined = natural_join(natural_join(left, right, how, balanced=True), third, how, balanced=True)
    plain = natural_join(natural_join(left, right, how), third, how)
    assert rows(joined.select("k", "g", "v", "w", "n")) == rows(plain.select("k", "g", "v", "w", "n"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    anti = joined.join(third.withColumnRenamed("w", "z"), F.col("w").eqNullSafe(F.col("z")), "left_anti")
    assert "NestedLoop" not in anti._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "full"])
@pytest.mark.parametrize("large", ["left", "right"])
def test_a_hot_key_of_either_side_of_an_outer_join_is_split(spark, hot, how, large):
    big = spark.range(0, 4000, 1, 8).selectExpr("IF(id % 10 < 9, 1, id) AS k", "id AS v")
    small = spark.range(0, 4000, 1, 8).selectExpr("id AS k", "id AS w")
    joined = natural_join(*((big, small) if large == "left" else (small, big)), how, balanced=True)
    n = joined.count()
    assert n == {("left", "left"): 4000, ("left", "right"): 7599, ("right", "left"): 7599}.get((how, large), n)
    joined.collect()
    assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
