"""Registered queries of the text operators: name -> (function, SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvatab.llm import (
    bpe,
    indexing,
    langid,
    licenses,
    lines,
    minhash,
    mixing,
    periodic,
    quality,
    resampling,
    secrets,
    simhash,
    urls,
)
from sylvatab.llm.common import documents, let

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe.digests(documents(spark, sf_dir), BPE_FILE)


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that stand on many sites."""
    return lines.report(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those not held out."""
    return langid.predict(documents(spark, sf_dir))


def joined(labels: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return urls.judge(documents(spark, sf_dir, "pages"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every document."""
    found = licenses.scan(documents(spark, sf_dir), keep=["doc_id"])
    base = F.transform("phrases", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(F.transform("phrases", lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda x: x["first"])).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("spans", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return minhash.report(documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.scan(documents(spark, sf_dir), [*secrets.BASE, *secrets.MORE], keep=["doc_id"])
    kinds = [r.kind for r in secrets.BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(k) for k in kinds],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return simhash.report(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document."""
    return mixing.report(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality.report(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op11_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a network on pooled word vectors."""
    return indexing.predict(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text; in one of ten documents, by the CRC-32 of the id, the
    words from a place on repeat those before with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(words: Column) -> Column:
        n = F.size(words)

        def from_place(x: Column) -> Column:
            a, g = x["a"], x["g"]
            period = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
            return F.transform(
                F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int"))
            )

        g = F.floor(h / 10)
        return let(F.struct((g % n).alias("a"), g.alias("g")), from_place)

    words = quality.words(F.col("text"))
    changed = F.array_join(let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(w)), " ")
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and what is left when each is cut to one period."""
    found = periodic.find(made_periodic(documents(spark, sf_dir)), keep=["doc_id"])
    order = F.transform(
        "runs", lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    longest = found.withColumn("longest", F.array_max(order))
    best = F.col("longest")
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["n"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["n"] / -best["p"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark's texts."""
    return resampling.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_bpe": (op1_bpe, None),
    "op2_lines": (op2_lines, lines.SQL),
    "op3_language": (op3_language, None),
    "op4_urls": (op4_urls, None),
    "op5_licenses": (op5_licenses, None),
    "op6_near_duplicates": (op6_near_duplicates, None),
    "op7_secrets": (op7_secrets, None),
    "op8_fingerprints": (op8_fingerprints, None),
    "op9_mixing": (op9_mixing, None),
    "op10_quality": (op10_quality, None),
    "op11_indexing": (op11_indexing, None),
    "op12_periodic": (op12_periodic, None),
    "op13_resampling": (op13_resampling, None),
}
