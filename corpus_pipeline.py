"""The pipeline from raw documents to tokens, a stage after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvatab.llm import bpe, lines, minhash, mixing, quality
from sylvatab.llm.common import documents
from sylvatab.llm.queries import BPE_FILE
from sylvatab.sources.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.keep(docs, documents(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites stay in one document only. A document that
    loses all it has goes, since each of its lines stands where it was first, and so
    does a near copy of one that keeps the lines they share: what is left of it is
    no document, and too little for the next stage to know it by."""
    emptied = (F.col("__gone") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = lines.dedup(docs, copies=True).filter(~F.coalesce(emptied, F.lit(False)) & ~F.col("__copy"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates for the target weights say; likely clean ones stay."""
    return mixing.mix(docs, documents(spark, sf_dir, "labels"), keep_protected=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``intact`` says that they decode to its text."""
    coded = bpe.encode(docs, BPE_FILE, keep=["doc_id", "lang", "source", "text"])
    intact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return bpe.decode(coded, BPE_FILE).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", intact.alias("intact")
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding", encode),
]
#: Hashed signatures, a fitted classifier and merges are beyond SQL; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
