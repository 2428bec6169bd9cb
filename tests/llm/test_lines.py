"""Line dedup against exact counts, in SQL and in Python."""

import hashlib
import re

import duckdb
import pytest

from sylvatab.llm import lines
from sylvatab.llm.queries import op2_lines

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]")


def expected(rows, least):
    """Texts that are left, for (id, text, site)."""
    sites, first = {}, {}
    for i, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                sites.setdefault(line, set()).update([] if site is None else [site])
                place = (i is not None, i or 0, pos)
                first[line] = min(first.get(line, place), place)
    out = []
    for i, text, _ in rows:
        left = [
            line
            for pos, line in enumerate((text or "").split("\n"))
            if len(sites.get(line, ())) < least or first[line] == (i is not None, i or 0, pos)
        ]
        out.append((i, None if text is None else "\n".join(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 9, 10, 11, 30])
def test_around_the_threshold(spark, least):
    rows = [(i, f"on {k} sites\nown {i}\n\n \nmany", f"s{i % 40}") for k in (1, 2, 8, 9, 10, 11, 12, 30) for i in range(100 * k, 100 * k + k)]
    rows += [(5, "many\nmany\nx", "s1"), (6, "on 9 sites", None), (7, None, "s1"), (8, "", "s2"), (None, "many\nno id", "s3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    left = lines.dedup(docs.repartition(6), min_sites=least).select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=str) == expected(rows, least)


def test_odd_rows(odd, nothing):
    rows = odd.select("doc_id", "text", "source").collect()
    left = lines.dedup(odd, min_sites=1)
    assert left.columns == [*odd.columns, "__gone"]
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    # Repeated rows are one place: both keep the line.
    assert got == expected(rows, 1)
    assert lines.dedup(nothing).collect() == []
    assert lines.report(nothing).collect() == []


def test_very_many_removed_lines(spark):
    """A text of 40,000 lines that go, but for every tenth."""
    lines_of = [f"line {i}" if i % 10 else f"own {i}" for i in range(40_000)]
    rows = [(k, "\n".join(x if x[0] == "l" else f"{x} {k}" for x in lines_of), f"s{k}") for k in range(3)]
    left = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), min_sites=3)
    got = {r.doc_id: (r.text, r["__gone"]) for r in left.collect()}
    assert got[0] == (rows[0][1], 0)
    for k in (1, 2):
        assert got[k] == ("\n".join(x for x in rows[k][1].split("\n") if x[0] == "o"), 36_000)


def test_near_copies_are_marked(spark):
    """Three quarters of both texts in lines that one of them keeps; repeats count once."""
    a, b, c = "a" * 39, "b" * 39, "c" * 39
    texts = [f"{a}\n{b}\n{c}", f"{a}\n{b}\n{c}\nx", f"{a}\n{b}\n{c}\n" + "y" * 45, "\n".join([a] * 9), f"{c}\n{b}\n{a}", None]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r["__copy"] for r in lines.dedup(docs, min_sites=2, copies=True).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: True, 5: False}


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(lines.SQL).fetchall()
    got = [tuple(r) for r in op2_lines(spark, SF).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[2] for r in got) > 0


def test_report_of_null(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a")], "doc_id bigint, text string, source string")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, lines.report(docs).collect())) == [(1, 0, 0, None), (2, 1, 0, empty)]
