"""Periodic runs against brute force, and the defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sylvatab.llm import periodic
from sylvatab.llm.queries import made_periodic, op12_periodic

SF = "/root/testdata/sf0.001"


def brute(words, shortest, repeats):
    """Every period by itself: stretches of words that equal the ones q apart."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                stretch = words[i : j + q]
                smaller = any(stretch[p:] == stretch[:-p] for p in range(1, q))
                if len(stretch) >= max(shortest, repeats * q) and not smaller:
                    out.append((i, len(stretch), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def repetitive(rng):
    words = []
    while len(words) < rng.choice([5, 40, 120]):
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
        words += unit * rng.randint(1, 6) + unit[: rng.randint(0, 3)] + [rng.randrange(4)] * rng.randint(0, 2)
    return words


@pytest.mark.parametrize("shortest, repeats", [(24, 3), (6, 2), (4, 3), (10, 4)])
def test_runs_equal_brute_force(shortest, repeats):
    rng = random.Random(shortest)
    for _ in range(60):
        words = repetitive(rng)
        assert periodic.runs(np.array(words), shortest, repeats) == brute(words, shortest, repeats)


def test_one_word_and_long_periods():
    same = [0] * 5000
    assert periodic.runs(np.array(same)) == [(0, 5000, 1)]
    unit = list(range(700))
    assert periodic.runs(np.array(unit * 3 + unit[:5])) == [(0, 2105, 700)]
    assert periodic.runs(np.array(unit * 3)[1:]) == []
    assert periodic.runs(np.array([], np.int64)) == []


def test_prefilter_drops_no_text():
    rng = random.Random(3)
    texts = [repetitive(rng) for _ in range(80)]
    hashes = np.array([hash(bytes([w])) for t in texts for w in t])
    some = periodic.may_repeat(hashes, [len(t) for t in texts], 24, 3)
    assert all(s or not brute(t, 24, 3) for s, t in zip(some, texts))
    assert not periodic.may_repeat(np.arange(50), [20, 30], 24, 3).any()
    # Equal texts side by side are not compared with one another.
    assert not periodic.may_repeat(np.array([*range(30), *range(30)]), [30, 30], 24, 3).any()


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op12_periodic(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = [w.decode() for w in (text or "").encode().split()]
        words = planted(doc_id, words)
        runs = periodic.runs(np.unique(np.array(words, object), return_inverse=True)[1] if words else np.array([]))
        if len(words) < 400:
            assert runs == brute(words, 24, 3)
        got = rows[doc_id]
        assert got.n_runs == len(runs)
        assert got.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert got.collapsed_sha256 == digest(" ".join(collapsed(words, runs)))
        if runs:
            s, n, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (got.start, got.length, got.period, got.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (got.start, got.length, got.period, got.exponent_milli) == (None,) * 4
    assert sum(r.n_runs > 0 for r in rows.values()) > 5


def test_odd_rows(spark, odd, nothing):
    found = periodic.find(odd, keep=["doc_id", "ids"])
    rows = found.collect()
    assert len(rows) == odd.count()
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert [(r.n_words, r.runs, r.collapsed) for r in blank] == [(0, [], "")] * 3
    (long,) = [r for r in rows if r.doc_id == 7]
    assert [tuple(x) for x in long.runs] == [(0, 240_000, 4)] and long.collapsed == "the quick brown fox"
    twice = [r for r in rows if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert periodic.find(nothing, keep=["doc_id"]).collect() == []
    assert made_periodic(odd).count() == odd.count()
