"""Importance resampling against a plain count of every feature."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from sylvatab.llm import resampling
from sylvatab.llm.ordering import ranked
from sylvatab.llm.queries import op13_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def codes(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def expected(docs, target):
    raw, wanted = Counter(), Counter()
    for _, text in docs:
        raw.update(codes(text)[1])
    for text in target:
        wanted.update(codes(text)[1])
    s_all, t_all = raw.total(), wanted.total()
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000))))
        for b in range(10_000)
    ]
    out, able = {}, []
    for doc_id, text in docs:
        words, found = codes(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [doc_id, len(found), weight, score, None]
        if len(words) >= 20:
            able.append((-score, doc_id))
    for rank, (_, doc_id) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        out[doc_id][4] = rank
    return {k: tuple(v) for k, v in out.items()}


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in op13_resampling(spark, SF).collect()}
    assert got == expected(docs, target)
    assert sum(r[4] is not None for r in got.values()) > 3


def test_spans_of_any_text():
    for text in ("", " \n", "One two-THREE  four", "Ünïcode – 日本語 🎉 a1 É", "a", "a b", "x" * 50_000, "a\x7fb\x00c"):
        words, wanted = codes(text)
        n, found = resampling.buckets(text.encode())
        assert n == len(words) and sorted(found.tolist()) == sorted(wanted)


def test_odd_rows(spark, odd, nothing):
    target = spark.createDataFrame([("the quick fox",), (None,), ("",)], "text string")
    rows = resampling.resample(odd, target).collect()
    assert len(rows) == odd.count()
    assert all(r.weight == 0 and r["rank"] is None for r in rows if r.doc_id in (2, 3, 4))
    twice = [r for r in rows if r.doc_id == 5]
    assert twice[0] == twice[1]
    every = resampling.resample(odd, target, percent=100).collect()
    assert sorted(r["rank"] for r in every if r["rank"]) == [1]
    assert resampling.resample(nothing, target).collect() == []
    assert resampling.resample(odd, target.limit(0)).count() == odd.count()
    drawn = resampling.sample(odd, target, percent=100)
    assert drawn.columns == odd.columns and [r.doc_id for r in drawn.collect()] == [7]


def test_ranks_over_many_ranges(spark):
    df = spark.range(0, 3000, 1, 7).selectExpr("id", "id % 5 AS v", "'x' AS __rank0")
    got = ranked(df, F.col("v").desc(), F.col("id"))
    order = [r.id for r in got.orderBy("__rank").collect()]
    assert order == sorted(range(3000), key=lambda i: (-(i % 5), i))
    assert [r["__rank"] for r in got.orderBy("__rank").collect()] == list(range(1, 3001))
    assert ranked(df.limit(0), F.col("id")).collect() == []
