"""Quality rules: fixed counts, and a likelihood ratio of hashed n-grams.

Single words and pairs of neighbours are hashed into ``BUCKETS`` buckets. One
multinomial is counted over all documents, one over trusted documents (labels
with quality 1). A document's score is the mean over its n-grams of the log
ratio of the two; it is kept from ``THRESHOLD`` on.

Only DataFrame functions: the counts are one pass over the documents, which meet
the trusted ids by a shuffle, and one aggregate over the buckets; their ratios are
one cell of ``BUCKETS`` numbers, and every document is scored where it stands.
Words are runs without ``[\\x20\\x09-\\x0D]``.

A null or empty text has no words and fails the base rules. Without a trusted
document all ratios are 0 and the base rules alone decide. Repeated rows are
judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import let
from sylvatab.sources.tables import written

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 1 << 16
#: Least mean log ratio of a document that is kept.
THRESHOLD = -0.04
#: The target's multinomial is smoothed by so many n-grams spread like the raw
#: corpus, so that a bucket that trusted documents don't fill tends to ratio 0
#: where few documents are trusted.
PRIOR = 10 * BUCKETS
#: Base rules: least number of words; most repeated words, in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK)
    return F.filter(parts, lambda w: w != "")


def pair_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def repeated_words(hashes: Column) -> Column:
    """Words in windows of three that occur twice or more, of the words' hashes.

    Windows are sorted with their places; those with an equal neighbour repeat.
    Each repeated window adds the words from its start to the next one's, three
    at most.
    """
    n = F.size(hashes)
    windows = F.transform(
        F.slice(hashes, 1, F.greatest(n - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )

    def starts(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(p: Column) -> Column:
            def same(x: Column, other: Column) -> Column:
                return F.coalesce(F.get(p, other)["h"] == x["h"], F.lit(False))

            marked = F.transform(p, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
            return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

        return let(pairs, repeated)

    def covered(s: Column) -> Column:
        each = F.transform(s, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - i, F.lit(3))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x)

    def count(w: Column) -> Column:
        none = F.size(F.array_distinct(w)) == F.size(w)
        return F.when(none, F.lit(0).cast("long")).otherwise(let(starts(w), covered))

    return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(windows, count))


def base_counts(text: Column, word_list: Column, hashes: Column) -> list[Column]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        F.size(word_list).cast("long").alias("n_words"),
        F.length(F.array_join(word_list, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(hashes).alias("n_repeat_words"),
    ]


def grams(docs: DataFrame, text: str) -> DataFrame:
    """The bucket of every n-gram of the texts, beside ``good``."""
    split = docs.select("good", words(F.col(f"`{text}`")).alias("w"))
    # The last word's pair has no second word and counts nowhere.
    following = F.slice("w", 2, F.greatest(F.size("w"), F.lit(1)))
    pairs = split.select("good", F.inline(F.arrays_zip(F.col("w").alias("a"), following.alias("b"))))
    a, b = F.xxhash64("a"), F.xxhash64("b")
    both = F.array(bucket(a), F.when(F.col("b").isNotNull(), bucket(pair_hash(a, b))))
    return pairs.select("good", F.explode(both).alias("bucket")).filter("bucket is not null")


def bucket_counts(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For each bucket its n-grams in all documents and in trusted ones, in one pass.

    Documents meet the trusted ids by one shuffle of the texts, at every size:
    the ids grow with the corpus, so that a plan that broadcasts them on small
    tables is not the one that large tables get. The ids are the hashed side, so
    texts are not sorted, and the documents the side that the planner can split.
    """
    given = docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    good = labels.filter(F.col("quality") == 1).select(F.col(key).alias("__id")).dropna().distinct()
    good = good.withColumn("__good", F.lit(1)).hint("shuffle_hash")
    marked = given.join(good, "__id", "left").withColumn("good", F.coalesce("__good", F.lit(0)))
    counts = grams(marked, "__text").groupBy("bucket")
    return counts.agg(F.count(F.lit(1)).alias("n_raw"), F.sum("good").alias("n_target"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """One row, ``ratios``: the log ratio of target and raw for each of the
    ``BUCKETS`` buckets, 0 for those that no document fills."""
    spark = counts.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    # One group of BUCKETS rows, whatever the corpus.
    cells = F.sort_array(F.collect_list(F.struct("bucket", "n_raw", "n_target")))
    table = every.agg(F.sum("n_raw").alias("raw"), F.sum("n_target").alias("target"), cells.alias("cells"))

    def ratio(cell: Column) -> Column:
        share = cell["n_raw"] / F.col("raw")
        known = F.log((cell["n_target"] + PRIOR * share) / (F.col("target") + PRIOR)) - F.log(share)
        return F.when((F.col("target") > 0) & cell["n_raw"].isNotNull(), known).otherwise(0.0)

    return table.select(F.transform("cells", ratio).alias("ratios"))


def score(hashes: Column, ratios: Column) -> Column:
    """Mean log ratio over a document's n-grams; 0 without words."""
    n = F.size(hashes)
    following = F.zip_with(
        F.slice(hashes, 1, F.greatest(n - 1, F.lit(0))), F.slice(hashes, 2, F.greatest(n - 1, F.lit(0))), pair_hash
    )

    def total(table: Column) -> Column:
        def add(sum_so_far: Column, hashed: Column) -> Column:
            return sum_so_far + F.get(table, bucket(hashed))

        return F.aggregate(hashes, F.lit(0.0), add) + F.aggregate(following, F.lit(0.0), add)

    return F.when(n == 0, F.lit(0.0)).otherwise(let(ratios, total) / (2 * n - 1))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and one more, ``__quality``: a struct of the base
    counts, ``base_failed``, ``score`` and ``kept``. Clashing names stay apart."""
    # One cell, which plans refer to: as a constant it would stand in each of their
    # descriptions. A column first, since functions of arrays take no subquery.
    ratios = written(log_ratios(bucket_counts(docs, labels, text, key)), "ratios").scalar()
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counted = (
        docs.withColumn("__words", words(content))
        .withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
        .withColumn("__base", F.struct(*base_counts(content, F.col("__words"), F.col("__hashes"))))
        .withColumn("__ratios", ratios)
        .withColumn("__score", score(F.col("__hashes"), F.col("__ratios")))
    )
    base, scored = F.col("__base"), F.col("__score")
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])
    verdict = F.struct(
        "__base.*",
        failed.alias("base_failed"),
        scored.alias("score"),
        (~failed & (scored >= THRESHOLD)).alias("kept"),
    )
    # As a generator's row: a filter on the verdict is not moved below it, where
    # it would compute the words again for every word.
    judged = counted.select("*", F.explode(F.array(verdict)).alias("__quality"))
    return judged.drop("__words", "__hashes", "__base", "__ratios", "__score")


def keep(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that are kept, with their columns."""
    return judge(docs, labels, text, key).filter("__quality.kept").drop("__quality")


def report(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The judgement of every document beside its key."""
    return judge(docs, labels, text, key).select(F.col(f"`{key}`"), "__quality.*")
