"""The word vectors against plain loops, the network, and held-out labels."""

import zlib

import numpy as np
import pytest

from sylvatab.llm import indexing
from sylvatab.llm.queries import op11_indexing

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op11_indexing(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert len(held) > 50
    assert sum(r.predicted == y for y, r in held) / len(held) > 0.95
    assert np.mean([(r.score - y) ** 2 for y, r in held]) < 0.05


def plain_table(texts):
    places, signs = indexing.index_vectors()
    table = np.zeros((indexing.ROWS, indexing.DIMENSIONS))
    for text in texts:
        rows = [zlib.crc32(t) % indexing.ROWS for t in indexing.TOKEN.findall(text)]
        for i, row in enumerate(rows):
            for j in range(max(0, i - indexing.REACH), min(len(rows), i + indexing.REACH + 1)):
                if i != j:
                    table[row, places[rows[j]]] += signs[rows[j]]
    return table


def plain_pool(vectors, text):
    v = np.array([vectors[zlib.crc32(t) % indexing.ROWS] for t in indexing.TOKEN.findall(text)], np.float64)
    if not len(v):
        return np.zeros(2 * indexing.DIMENSIONS + 2)
    like = (v[:-1] * v[1:]).sum() / max(len(v) - 1, 1)
    return np.concatenate([v.mean(axis=0), (v**2).mean(axis=0), [like, np.log1p(len(v))]])


TEXTS = ["a b a c!! d", "", "one", None, "a b a", "word " * 40 + "é ü &&& x"]


def test_vectors_and_pooling_equal_plain_loops(spark, monkeypatch):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    table = plain_table([(t or "").encode() for t in TEXTS])
    length = np.sqrt((table**2).sum(axis=1, keepdims=True))
    wanted = table / np.where(length > 0, length, 1)
    got = indexing.context_vectors(docs)
    assert np.allclose(got, wanted, atol=1e-6)
    contents = [(t or "").encode() for t in TEXTS]
    plain = np.array([plain_pool(got, t) for t in contents])
    assert np.allclose(indexing.pooled(got, contents), plain, atol=1e-5)
    # Blocks of any size give the same.
    monkeypatch.setattr(indexing, "AT_ONCE", 3)
    assert np.allclose(indexing.pooled(got, contents), plain, atol=1e-5)
    again = np.zeros(table.size, np.int64)
    hashes, starts = indexing.token_hashes(contents)
    indexing.add_contexts(again, hashes % indexing.ROWS, starts, *indexing.index_vectors())
    assert (again.reshape(table.shape) == table).all()


def test_network_learns_a_curve_and_its_temperature():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 2))
    p = np.where(x[:, 0] * x[:, 1] > 0, 0.9, 0.1)
    y = (rng.random(3000) < p).astype(float)
    made = indexing.train(x, y, np.arange(3000) % 5 == 0)
    score = made.scores(x)
    assert np.mean((score > 0.5) == (p > 0.5)) > 0.93
    assert abs(score[score > 0.5].mean() - 0.9) < 0.05
    assert 1 / 8 <= made.temperature <= 8
    assert indexing.temperature(np.array([9.0, -9.0, 9.0, -9.0]), np.array([1.0, 0.0, 0.0, 1.0])) == pytest.approx(8, rel=0.01)


def test_labels(spark, odd, nothing):
    def scores(labels, docs=odd):
        return indexing.predict(docs, spark.createDataFrame(labels, LABELS)).collect()

    assert {r.score for r in scores([])} == {0.5}
    assert {r.score for r in scores([(1, 1, 0), (6, 1, None), (None, 0, 0), (99, 0, 0), (5, None, 0)])} == {1.0}
    both = [(1, 1, 0), (5, 0, 0), (5, 1, 1), (7, 1, 0), (8, 0, 0)]
    got = scores(both)
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(repr, scores(both[::-1]))) == sorted(map(repr, got))
    twice = [r for r in got if r.doc_id == 5]
    assert twice[0] == twice[1]
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert scores(both, nothing) == []


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(indexing, "TRAINED_ON", 7)
    seen = {}

    def train(x, y, calibrate):
        seen["n"] = len(y)
        return indexing.Network(0.5)

    monkeypatch.setattr(indexing, "train", train)
    docs = spark.range(60).selectExpr("id % 20 AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(20).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    indexing.fit(docs, labels, np.zeros((indexing.ROWS, indexing.DIMENSIONS), np.float32))
    assert seen["n"] == 7
