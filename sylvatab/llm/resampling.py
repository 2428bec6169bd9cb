"""Importance resampling towards a target text collection.

Every run of one to three words of a text is a feature; features fall into
``BUCKETS`` buckets by CRC-32. A bucket's gain is the log ratio of how often the
target and the raw corpus fill it, in thousandths, rounded down. A document's
weight is the sum of the gains of its features, its score the weight and a Gumbel
number drawn from its id, and the highest scores are the sample: drawn without
replacement, each in proportion to the exponential of its weight.

Features are found by an overlapped regex scan. A-Z are made small, separators
become single spaces, and one expression, tried again from every word on, gives
the spans of the runs of one, two and three words that start there; look-arounds
keep it at word borders. The CRC of each span is taken of the text in place. The
scan is run once: each text's buckets are written as 16-bit numbers, counted and
weighed from there. Only two numbers for each bucket come to the driver.

A null text has no words, weight 0 and is never drawn, as all texts with fewer
than ``LEAST_WORDS``. A null id draws by the empty text. Repeated rows have equal
scores and are drawn one by one. Without a document the sample is empty; without
a target all gains come from its smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import per_text
from sylvatab.llm.ordering import ranked
from sylvatab.sources.tables import written

BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Share of the documents that is drawn, in percent.
PERCENT = 5
SEED = 42
#: From a word's start: the word, and the second and the third after it if any.
RUNS = regex.compile(rb"(?<![^ ])([^ ]+)(?: ([^ ]+)(?: ([^ ]+))?)?(?![^ ])")
#: A-Z become small, all other separators of ASCII a space.
FOLDED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def collapsed(text: bytes) -> bytes:
    """The words of a text between single spaces."""
    return b" ".join(text.translate(FOLDED).split())


def buckets(text: bytes) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of one to three of them."""
    plain = collapsed(text)
    view = memoryview(plain)
    crc = zlib.crc32
    codes: list[int] = []
    add = codes.append
    n = 0
    for found in RUNS.finditer(plain, overlapped=True):
        start, one = found.span(1)
        code = crc(view[start:one])
        n += 1
        add(code)
        two = found.end(2)
        if two > 0:
            code = crc(view[one:two], code)
            add(code)
            three = found.end(3)
            if three > 0:
                add(crc(view[two:three], code))
    return n, (np.array(codes, np.int64) % BUCKETS).astype("<u2")


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns with ``n_words``, ``n_features`` and ``buckets``, the
    features' buckets as 16-bit numbers, low byte first."""

    def of_slice(contents: list[bytes]) -> list[pa.Array]:
        found = [buckets(x) for x in contents]
        return [
            pa.array([n for n, _ in found], pa.int64()),
            pa.array([len(b) for _, b in found], pa.int64()),
            pa.array([b.tobytes() for _, b in found], pa.binary()),
        ]

    return per_text(docs, lambda: of_slice, text, keep, "n_words bigint, n_features bigint, buckets binary")


def bucket_counts(featured: DataFrame, name: str) -> DataFrame:
    """``bucket`` and how many features fall into it; each task counts its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for codes in batch.column(0):
                total += np.bincount(np.frombuffer(codes.as_py() or b"", "<u2"), minlength=BUCKETS)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    each = featured.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    return each.groupBy("bucket").agg(F.sum("n").alias(name))


def gains(raw: DataFrame, target: DataFrame) -> list[int]:
    """The gain of each bucket, in thousandths; ``BUCKETS`` rows at most come to
    the driver."""
    counts = bucket_counts(raw, "s").join(bucket_counts(target, "t"), "bucket", "full").fillna(0, ["s", "t"])
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    of_raw, of_target = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return [math.floor(1000 * math.log((b + 1) * of_raw / ((a + 1) * of_target))) for a, b in zip(s, t, strict=True)]


def weighed(featured: DataFrame, gain: list[int]) -> DataFrame:
    """``weight``, the sum of the gains of the features, instead of ``buckets``."""
    others = [c for c in featured.columns if c != "buckets"]
    schema = featured.select(*[F.col(f"`{c}`") for c in others]).withColumn("weight", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in batches:
            sums = [int(table[np.frombuffer(x.as_py() or b"", "<u2")].sum()) for x in batch.column(len(others))]
            kept = [batch.column(i) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=[*others, "weight"])

    return featured.select(*[F.col(f"`{c}`") for c in others], "buckets").mapInArrow(run, schema)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """A number drawn from a Gumbel distribution by the key, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """For every row its key, ``n_features``, ``weight``, ``score`` and ``rank``
    in the sample, null where it is not drawn. ``target`` has a column ``text``."""
    raw = written(features(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), ["key"]), "features")
    gain = gains(raw, features(target.select(F.col(f"`{text}`").alias("text")), []))
    scored = weighed(raw, gain).withColumn("score", F.col("weight") + gumbel(F.col("key")))
    scored = written(scored, "scores")
    able = scored.filter(F.col("n_words") >= LEAST_WORDS)
    drawn = able.count() * percent // 100
    order = ranked(able, F.col("score").desc(), F.col("key").asc(), F.col("n_features"), F.col("weight"))
    order = order.withColumn("rank", F.when(F.col("__rank") <= drawn, F.col("__rank")))
    rest = scored.filter(F.col("n_words") < LEAST_WORDS).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    return order.select(*columns).unionByName(rest.select(*columns))


def sample(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; ``key`` tells rows apart."""
    drawn = resample(docs, target, text, key, percent).filter("rank is not null").select(F.col(f"`{key}`").alias("__drawn"))
    return docs.join(drawn, docs[f"`{key}`"].eqNullSafe(drawn["__drawn"]), "left_semi")
