"""Near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from sylvatab.llm import minhash
from sylvatab.llm.components import components
from sylvatab.llm.queries import op6_near_duplicates

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """(id, set size, component, kept) of rows (id, text) with ids."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    least = {i: i for i, _ in sets}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            common = len(a & b)
            if a and b and 100 * common >= 75 * (len(a) + len(b) - common):
                p, q = sorted((top(i), top(j)))
                least[q] = p
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets)


def answers(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


def changed(rng, words, share):
    return [rng.choice("qrstuvwxyz") * 3 if rng.random() < share else w for w in words]


def planted(rng):
    """Groups around the threshold, chains, copies, short and blank texts."""
    texts = []
    for _ in range(12):
        seed = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 6, 30, 80, 200]))]
        texts += [" ".join(changed(rng, seed, s)) for s in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.2)]
        link = seed
        for _ in range(4):
            link = changed(rng, link, 0.02)
            texts.append("\n".join(link).upper())
    texts += ["", None, " \n", "one two", "One  two", "one", "é É", "é é", "a b c d", "a b c d e"]
    ids = rng.sample(range(10**6), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = planted(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert answers(minhash.report(docs)) == brute_force(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = answers(op6_near_duplicates(spark, SF))
    assert got == brute_force(rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = minhash.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in got if r[3]]


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    most = minhash.CHUNKS * (minhash.ERRORS + 1) - 1
    one = rng.integers(0, 1 << 16, (2000, minhash.VALUES)).astype(np.uint16)
    two = one.copy()
    for row in two:
        row[rng.choice(minhash.VALUES, most, replace=False)] += 1
    shared = (minhash.keys(one) == minhash.keys(two)).any(axis=1)
    assert shared.all()


def test_signatures_estimate_similarity():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    hashes = minhash.WordHashes()
    a = minhash.shingles(" ".join(words).encode(), hashes)
    b = minhash.shingles(" ".join(changed(rng, words, 0.03)).encode(), hashes)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    equal = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(true - equal) < 0.25


def test_large_group_lists_no_pairs(spark):
    """A group of near copies gives links in proportion to its size."""
    rng = random.Random(9)
    seed = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(changed(rng, seed, 0.005))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = minhash.signed(docs)
    classes = signed.selectExpr("id node", "n_shingles", "signature")
    assert minhash.links(classes, docs).count() < 300 * minhash.CHUNKS * minhash.LENGTH / 4
    assert answers(minhash.report(docs)) == brute_force(rows)


def test_two_linked_groups(spark):
    """Groups whose only links are between members that are no key's smallest."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(100)]
    rows, text = [], words
    for i in range(40):
        rows.append((rng.randrange(10**6) * 100 + i, " ".join(text)))
        text = changed(rng, text, 0.02)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answers(minhash.report(docs)) == brute_force(rows)


def test_odd_rows(odd, nothing):
    got = minhash.report(odd).collect()
    want = {i: (n, c, k) for i, n, c, k in brute_force([(r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (None, 5, 6)])}
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id in want:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
        else:
            assert (r.component_id, r.kept) == (r.doc_id, True)
    assert minhash.report(nothing).collect() == []
    assert minhash.keep(nothing).columns == nothing.columns
    assert minhash.keep(odd).count() == odd.count()


CHAIN = [(i, i + 1) for i in range(40)]
EDGES = [
    ([], {}),
    ([(1, 1)], {}),
    ([(5, 4), (4, 3), (3, 2), (9, 8), (2, 1), (8, 7)], {**dict.fromkeys(range(1, 6), 1), **dict.fromkeys(range(7, 10), 7)}),
    (CHAIN, dict.fromkeys(range(41), 0)),
    ([(0, i) for i in range(1, 30)] * 2, dict.fromkeys(range(30), 0)),
]


@pytest.mark.parametrize(("edges", "want"), EDGES)
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    rows = components(df).collect()
    assert {r.node: r.component for r in rows} == want
    assert len(rows) == len(want)
