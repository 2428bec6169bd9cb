"""Base counts and likelihood ratios against brute force in Python."""

import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from sylvatab.llm import quality
from sylvatab.llm.queries import op10_quality

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id bigint, quality int, toxic int"


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def hashed(word, seed=42):
    return xxhash.xxh64_intdigest(word.encode(), seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(text):
    h = [hashed(w) for w in WORD.findall(text)]
    first = [xxhash.xxh64_intdigest(struct.pack("<Q", x), 42) for x in h]
    pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), a) for a, b in zip(first, h[1:])]
    return [signed(x) % quality.BUCKETS for x in [*h, *pairs]]


def scores(texts, trusted):
    raw, target = Counter(), Counter()
    for text, good in zip(texts, trusted, strict=True):
        raw.update(grams(text))
        target.update(grams(text) if good else [])
    n, m = raw.total(), target.total() + quality.PRIOR

    def ratio(b):
        return math.log((target[b] + quality.PRIOR * raw[b] / n) / m) - math.log(raw[b] / n)

    return [sum(map(ratio, g)) / len(g) if g and any(trusted) else 0.0 for g in map(grams, texts)]


TEXTS = [
    "a b c a b c x a b c",
    "a a a a a",
    "one\ntwo\n\none\n \n \ntwo \n",
    "# $5 <b>|</b> 100% *&*",
    "é ü x y z",
    "\ta\x0bb\x0cc\rd\ne  ",
    "w " * 60,
    " ".join(f"w{i}" for i in range(60)),
    "p q r s p q t q r s " * 30,
    "",
    " \n ",
]


@pytest.mark.parametrize("trusted", [[0, 5, 7], []])
def test_like_brute_force(spark, trusted):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted] + [(1, 0, 0), (None, 1, 0), (2, None, 0)], LABELS)
    rows = sorted(quality.report(docs, labels).collect())
    want = scores(TEXTS, [i in trusted for i in range(len(TEXTS))])
    for row, text, expected in zip(rows, TEXTS, want, strict=True):
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert got == base(text)
        assert row.score == pytest.approx(expected, abs=1e-9)
        assert row.kept == (not row.base_failed and row.score >= quality.THRESHOLD)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0)], LABELS)
    rows = quality.report(odd, labels).collect()
    assert sorted(r.n_words for r in rows) == sorted(base(r.text or "")[0] for r in odd.collect())
    assert quality.report(nothing, labels).collect() == []
    assert quality.keep(nothing, labels).columns == nothing.columns
    clash = odd.withColumnsRenamed({"source": "kept", "lang": "score"})
    assert quality.keep(clash, labels).columns == clash.columns


def test_all_trusted_documents_make_the_target(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in (0, 5, 7)] * 2, LABELS)
    want = scores(TEXTS, [i in (0, 5, 7) for i in range(len(TEXTS))])
    got = [r.score for r in sorted(quality.report(docs, labels).collect())]
    assert got == pytest.approx(want, abs=1e-9)


def test_same_plan_and_scores_with_and_without_broadcasts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (5, 1, 0)], LABELS)
    seen = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = quality.bucket_counts(docs, labels)._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
            out = quality.report(docs, labels)
            # No table of numbers in the plan.
            assert len(out._jdf.queryExecution().toString()) < 200_000
            seen.append(sorted(out.collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen[0] == seen[1]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    want = dict(zip(texts, scores(list(texts.values()), [i in good for i in texts]), strict=True))
    rows = op10_quality(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (*r[1:6], r.base_failed) == base(texts[r.doc_id])
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_held_out_labels(spark):
    """Clean documents stay and junk goes, on labels that did not make the target."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.report(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    good = [r.kept for r in rows.filter("quality = 1 and not base_failed").collect()]
    bad = [r.kept for r in rows.filter("quality = 0").collect()]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.15
