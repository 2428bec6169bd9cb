"""Fingerprints and the near search against brute force in Python."""

import hashlib
import random
import re
import struct

import pytest
import xxhash

from sylvatab.llm import simhash
from sylvatab.llm.queries import op8_fingerprints

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def chained(parts):
    h = 42
    for p in parts:
        if p is not None:
            h = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else struct.pack("<i", p), h)
    return h


def fingerprint(text):
    words = WORD.findall(text or "")
    pairs = list(zip(words, words[1:])) if len(words) > 1 else [(w, None) for w in words]
    votes = [0] * simhash.BITS
    for a, b in pairs:
        weight = len(a) + len(b or "")
        h = chained([a, b]), chained([1, b, a])
        for i in range(simhash.BITS):
            votes[i] += weight if h[i // 64] >> (i % 64) & 1 else -weight
    f = [sum(1 << i for i in range(64) if votes[64 * k + i] > 0) for k in range(2)]
    return f"{f[0]:016x}{f[1]:016x}"


def like(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / simhash.BITS


def expected(rows):
    """Rows (id, text) without ties of both."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (key, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        f, e, n = fingerprint(text), fingerprint(changed), fingerprint(after)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out[key] = (len(text), sha, f, e, pytest.approx(like(f, e)), pytest.approx(like(f, n)))
    return out


@pytest.mark.parametrize("n", [1, 2, 40])
def test_like_brute_force(spark, n):
    rng = random.Random(n)
    words = ["alpha", "beta", "é", "日本", "x", "\n", "\x0b", "longerword", " "]
    rows = [(rng.randrange(10**6) * 10 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(9)))) for i in range(n)]
    rows += [(None, "no key here")] if n > 1 else []
    got = simhash.report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r[0]: tuple(r[1:7]) for r in got} == expected(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op8_fingerprints(spark, SF).collect()
    assert len(got) == len(rows)
    assert {r[0]: tuple(r[1:7]) for r in got} == expected(rows)
    prints = {r.doc_id: r.fingerprint for r in got}
    for r in got:
        near = sum(like(r.fingerprint, f) >= 1 - simhash.RADIUS / simhash.BITS for f in prints.values()) - 1
        assert r.n_near == (near if r.doc_id % 100 == 0 else None)
    assert sum(r.near_edited > r.near_next for r in got if r.n_chars > 100) > 0.9 * len(got)


@pytest.mark.parametrize("radius", [0, 3, 9])
def test_near(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(128) for _ in range(6)]
    flipped = [s ^ sum(1 << b for b in rng.sample(range(128), k)) for s in seeds for k in range(13)]

    def halves(x):
        return simhash._signed(x & ((1 << 64) - 1)), simhash._signed(x >> 64)

    table = spark.createDataFrame([halves(x) for x in flipped] * 2, "f0 bigint, f1 bigint")
    queries = spark.createDataFrame([halves(x) for x in seeds], "f0 bigint, f1 bigint")
    got = [(r.q0, r.q1, r.f0, r.f1, r.distance) for r in simhash.near(queries, table, radius).collect()]
    want = {
        (*halves(q), *halves(f), (q ^ f).bit_count()) for q in seeds for f in flipped if (q ^ f).bit_count() <= radius
    }
    assert len(got) == len(set(got))
    assert set(got) == want


def test_edited_copies_are_found(spark):
    """Copies with every fiftieth word replaced (Jaccard 0.75 or more on five-word shingles)."""
    rng, rows = random.Random(3), []
    texts = [WORD.findall(r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    words = [w for t in texts for w in t]

    def shingles(t):
        return {tuple(t[i : i + 5]) for i in range(len(t) - 4)}

    for t in texts:
        copy = list(t)
        for i in rng.sample(range(len(t)), len(t) // 50):
            copy[i] = rng.choice(words)
        a, b = shingles(t), shingles(copy)
        if len(t) >= 50 and a != b and len(a & b) >= 0.75 * len(a | b):
            rows += [(100 * len(rows), " ".join(t)), (100 * len(rows) + 1, " ".join(copy))]
    found = simhash.report(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("n_near is not null")
    got = [r.n_near > 0 for r in found.collect()]
    assert len(got) > 200
    assert sum(got) > 0.9 * len(got)


def test_looked_up_keys_are_not_broadcast(spark):
    few = spark.createDataFrame([(1, 2)], "f0 bigint, f1 bigint")
    plan = simhash.near(few, few)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_odd_rows(spark, odd, nothing):
    rows = simhash.report(odd).collect()
    assert sorted(r.n_chars for r in rows) == sorted(len(r.text or "") for r in odd.collect())
    texts = {r.text or "" for r in odd.collect() if len(r.text or "") < 1000}
    assert {fingerprint(t) for t in texts} <= {r.fingerprint for r in rows}
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert simhash.report(nothing).collect() == []


def test_plan_has_no_python(spark):
    rows = simhash.compare(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def sizes_of_parts(rows):
    found = {}
    for r in simhash.in_order(rows).select("part", "head").collect():
        found[r.part] = found.get(r.part, 0) + 1
    return found


@pytest.mark.parametrize("hot", [7, None])
def test_hot_ids_lie_in_many_ranges(spark, hot):
    """A third of all rows has one id or none: no range holds much more than its share."""
    rows = [(hot if i % 3 == 0 else 10 + i, f"text number {i}") for i in range(3000)]
    sizes = sizes_of_parts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6))
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes.values()) < 1.5 * 3000 / len(sizes)
    assert sum(sizes.values()) == 3000 + len(sizes)


def test_ranges_grow_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_CHARS", 1000)
    rows = [(i, "word " * 20) for i in range(600)]
    sizes = sizes_of_parts(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(sizes) > 50 and max(sizes.values()) < 15


def test_order_of_equal_ids(spark):
    """Each row but one is followed by the one after it in the order; copies of a row, too."""
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3]), f"t{rng.randrange(6)}") for _ in range(300)]
    placed = simhash.in_order(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).filter("not head").collect()

    def mark(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -mark(r[1])))
    want = [(k, t, after) for (k, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True)]

    def counted(xs):
        return sorted(xs, key=str)

    assert counted((r.key, r.text, r.next_text) for r in placed) == counted(want)


def test_texts_are_dealt_out_once(spark):
    """One exchange holds texts; what follows uses its partitions."""
    rows = simhash.compare(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.split("\n") if re.search(r"\bExchange ", x) and "SinglePartition" not in x]) <= 2
