import pytest
from pyspark.sql import functions as F

from sylvatab.functions.text import mentions, normalise_name_case, paste_na, prints_with_zero, squish, title_genus


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize(
    "name, lower, wanted",
    [
        ("ficus carica", False, "Ficus carica"),
        ("FICUS Carica L.", False, "Ficus Carica L."),
        ("FICUS Carica L.", True, "Ficus carica l."),
        ("ficus-x carica", False, "Ficus-x carica"),
        ("ficus", False, "Ficus NA"),
        ("na", False, "Na NA"),
        (None, False, "NA NA"),
        ("ficus  carica", False, "Ficus  carica"),
        ("a(b c", False, "A(b c"),
    ],
)
def test_title_genus(spark, name, lower, wanted):
    assert one(spark, [(name,)], "n string", title_genus(F.col("n"), lower)) == [(wanted,)]


def test_case_rules_by_site(spark):
    df = spark.createDataFrame([("a", "x Y"), ("b", "x Y"), ("c", "x Y"), ("c", None)], "site string, Submitted_Name string")
    out = normalise_name_case(df, case_rules={"a": "genus", "b": "lower_genus"}).collect()
    assert sorted(map(tuple, out), key=str) == [("a", "X Y"), ("b", "X y"), ("c", "x Y"), ("c", None)]


def test_paste_na(spark):
    rows = [("a", "b"), ("a", None), (None, None)]
    assert one(spark, rows, "x string, y string", paste_na(F.col("x"), F.col("y"))) == [("a b",), ("a NA",), ("NA NA",)]


def test_squish(spark):
    assert one(spark, [("  a  b\tc ",)], "n string", squish(F.col("n"))) == [("a b c",)]


def test_mentions(spark):
    rows = [("Ficus a(b L.", "a(b"), ("Ficus", "x"), (None, "x"), ("x", None)]
    got = one(spark, rows, "t string, n string", mentions(F.col("t"), F.col("n")))
    assert got == [(True,), (False,), (None,), (None,)]
    assert one(spark, [("abc", "a.c")], "t string, n string", mentions(F.col("t"), F.col("n"), regex=True)) == [(True,)]


def test_prints_with_zero(spark):
    rows = [(0.0,), (0.5,), (12.0,), (10.0,), (None,), (-0.5,)]
    got = one(spark, rows, "x double", prints_with_zero(F.col("x")), prints_with_zero(F.col("x"), exact_zero=True))
    assert got == [(True, True), (True, False), (False, False), (False, False), (False, False), (False, False)]
