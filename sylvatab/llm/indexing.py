"""Quality by word vectors: random indexing, pooling, and a small network.

Every token has a fixed index vector of ``NONZERO`` entries of +1 or -1 at places
given by its hash. A token's context vector is the sum of the index vectors of the
tokens up to ``REACH`` away, over all places of the whole corpus; tokens share a
vector by hash, ``ROWS`` in all, so that the table has the same size for any
corpus. Sums are whole numbers, so their order changes nothing; each task adds up
its own table first. Vectors are scaled to length 1.

A document is pooled to the mean and the mean square of its tokens' vectors, the
mean likeness of neighbours, and the logarithm of its length. A network with one
hidden layer, written with numpy, is fitted on ``TRAINED_ON`` labelled documents
at most, chosen by the hash of their id, four fifths of them; on the last fifth one
temperature is chosen by which its answers are divided so that the score is a
probability. Equal tables give equal weights.

Tokens are stretches of letters and digits, case kept, and of other signs. A null
or empty text has none: it is pooled to zeros and gets the network's answer for
these. Of several labels of one id the lowest counts, of several texts of one id
the one with the smallest hash teaches. Labels without id or quality, and of ids
without document, teach nothing. Where all labels agree, or there is none, every
score is the share of label 1 (one half without labels). Repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import per_text, slices

TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\s]+")
#: Size of the table of context vectors, and of an index vector.
ROWS, DIMENSIONS, NONZERO = 1 << 14, 32, 4
#: Tokens so far away are context.
REACH = 2
#: The network is fitted on so many labelled documents at most.
TRAINED_ON = 20_000
HIDDEN, EPOCHS, STEP, DECAY, SEED = 32, 400, 0.01, 1e-4, 7
#: Documents from this score on are predicted to be of quality 1.
CUT = 0.7
#: Tokens whose vectors are looked up at one time.
AT_ONCE = 1 << 16


def token_hashes(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every token of the texts behind one another, and where each
    text starts (one more entry for the end)."""
    found = [TOKEN.findall(x) for x in contents]
    starts = np.array([0, *accumulate(map(len, found))], np.int64)
    return np.fromiter(map(zlib.crc32, chain.from_iterable(found)), np.int64, starts[-1]), starts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each of the ``ROWS`` rows."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((ROWS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places, rng.choice(np.array([-1, 1]), (ROWS, NONZERO))


def add_contexts(table: np.ndarray, rows: np.ndarray, starts: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of all neighbours within a text to ``table``, flat."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for away in range(1, REACH + 1):
        for at in range(0, max(len(rows) - away, 0), AT_ONCE):
            left, right = rows[at : at + AT_ONCE], rows[at + away : at + away + AT_ONCE]
            left = left[: len(right)]
            near = text[at : at + len(left)] == text[at + away : at + away + len(right)]
            left, right = left[near], right[near]
            for word, other in ((left, right), (right, left)):
                cells = (word[:, None] * DIMENSIONS + places[other]).ravel()
                table += np.bincount(cells, signs[other].ravel(), len(table)).astype(np.int64)


def context_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The vectors of the corpus, scaled to length 1: ``ROWS`` rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table = np.zeros(ROWS * DIMENSIONS, np.int64)
        for batch in batches:
            for _, contents in slices(batch, "__text"):
                hashes, starts = token_hashes(contents)
                add_contexts(table, hashes % ROWS, starts, places, signs)
        table = table.reshape(ROWS, DIMENSIONS)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used), *(pa.array(table[used, d]) for d in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"v{d}" for d in range(DIMENSIONS))])

    names = [f"v{d}" for d in range(DIMENSIONS)]
    each = docs.select(F.col(f"`{text}`").alias("__text"))
    each = each.mapInArrow(count, "row bigint, " + ", ".join(f"{v} bigint" for v in names))
    total = each.groupBy("row").agg(*[F.sum(v).alias(v) for v in names]).toArrow()
    vectors = np.zeros((ROWS, DIMENSIONS), np.float32)
    sums = np.array([total.column(v).to_numpy() for v in names], np.float64).T
    if len(sums):
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        vectors[total.column("row").to_numpy()] = sums / np.where(length > 0, length, 1)
    return vectors


def pooled(vectors: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """One row of features for each text."""
    hashes, starts = token_hashes(contents)
    rows = hashes % ROWS
    size = np.diff(starts)
    mean, square = np.zeros((len(size), DIMENSIONS)), np.zeros((len(size), DIMENSIONS))
    like = np.zeros(len(size))
    text = np.repeat(np.arange(len(size)), size)
    for at in range(0, len(rows), AT_ONCE):
        block = vectors[rows[at : at + AT_ONCE + 1]]
        owner = text[at : at + AT_ONCE + 1]
        near = (block[:-1] * block[1:]).sum(axis=1) * (owner[:-1] == owner[1:])
        np.add.at(like, owner[:-1], near)
        block, owner = block[:AT_ONCE], owner[:AT_ONCE]
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        mean[owner[first]] += np.add.reduceat(block, first, axis=0)
        square[owner[first]] += np.add.reduceat(block**2, first, axis=0)
    n = np.maximum(size, 1)[:, None]
    likeness = like / np.maximum(size - 1, 1)
    return np.column_stack([mean / n, square / n, likeness, np.log1p(size)])


class Network(NamedTuple):
    """Scaling, two layers and a temperature; without layers every answer is ``share``."""

    share: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(x), self.share)
        return sigmoid(self.margins(x) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def train(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network:
    """Full-batch fit with momentum and per-weight steps (Adam); rows marked
    ``calibrate`` only choose the temperature."""
    share = float(y.mean()) if len(y) else 0.5
    fitted = ~calibrate
    if len(set(y[fitted])) < 2:
        return Network(share)
    centre, scale = x[fitted].mean(axis=0), x[fitted].std(axis=0) + 1e-6
    rng = np.random.default_rng(SEED)
    weights = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    z, t = (x[fitted] - centre) / scale, y[fitted]
    for epoch in range(1, EPOCHS + 1):
        hidden = np.tanh(z @ weights[0] + weights[1])
        wrong = (sigmoid(hidden @ weights[2] + weights[3]) - t) / len(t)
        back = np.outer(wrong, weights[2]) * (1 - hidden**2)
        slopes = [z.T @ back, back.sum(axis=0), hidden.T @ wrong, wrong.sum(keepdims=True)]
        for k, slope in enumerate(slopes):
            slope = slope + DECAY * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            change = first[k] / (1 - 0.9**epoch) / (np.sqrt(second[k] / (1 - 0.999**epoch)) + 1e-8)
            weights[k] = weights[k] - STEP * change
    made = Network(share, centre, scale, tuple(weights))
    if len(set(y[calibrate])) < 2:
        return made
    return made._replace(temperature=temperature(made.margins(x[calibrate]), y[calibrate]))


def temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the margins under which the labels are likeliest: a search
    between 1/8 and 8 by golden sections of its logarithm."""
    sign = np.where(y > 0.5, 1.0, -1.0)

    def loss(log_t: float) -> float:
        return float(np.logaddexp(0, -sign * margins / np.exp(log_t)).mean())

    low, high = -np.log(8), np.log(8)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(key: Column) -> Column:
    """Whether labels of the id teach nothing: CRC-32 of the id, remainder 2 of 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def pooled_documents(docs: DataFrame, vectors: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``pooled``, the features of every text."""

    def of_slice(contents: list[bytes]) -> list[pa.Array]:
        return [pa.array(list(pooled(vectors, contents)), pa.list_(pa.float64()))]

    return per_text(docs, lambda: of_slice, text, keep, "pooled array<double>")


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, text: str = "text", key: str = "doc_id") -> Network:
    """The network, from the labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("y")).dropna()
    known = known.filter(~held_out(F.col("__id"))).groupBy("__id").agg(F.min("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(TRAINED_ON)
    given = docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    # The chosen labels are TRAINED_ON rows at most, so they may be broadcast.
    given = given.join(F.broadcast(chosen), "__id").withColumn("__h", F.xxhash64("__text"))
    each = pooled_documents(given, vectors, ["__id", "y", "__h"], "__text")
    rows = each.groupBy("__id").agg(F.min("y").alias("y"), F.min_by("pooled", "__h").alias("pooled")).orderBy("__id")
    calibrate = (F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(5)) == 0).alias("c")
    table = rows.select("y", "pooled", calibrate).toArrow()
    width = 2 * DIMENSIONS + 2
    x = np.array(table.column("pooled").to_pylist(), np.float64).reshape(-1, width)
    y = np.array(table.column("y").to_pylist(), np.float64)
    return train(x, (y > 0.5).astype(np.float64), np.array(table.column("c").to_pylist(), bool))


def classify(docs: DataFrame, vectors: np.ndarray, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``score``, the probability of label 1."""

    def of_slice(contents: list[bytes]) -> list[pa.Array]:
        return [pa.array(network.scores(pooled(vectors, contents)), pa.float64())]

    return per_text(docs, lambda: of_slice, text, keep, "score double")


def predict(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For every row its key, ``held_out``, ``score`` and ``predicted``."""
    vectors = context_vectors(docs, text)
    network = fit(docs, labels, vectors, text, key)
    out = classify(docs, vectors, network, [key], text)
    predicted = (F.col("score") >= CUT).cast("int").alias("predicted")
    return out.select(F.col(f"`{key}`"), held_out(F.col(f"`{key}`")).alias("held_out"), "score", predicted)
