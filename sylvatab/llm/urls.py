"""URL filters: rules by host and path, and boosted trees for the other URLs.

The trees learn from the URLs that a rule decides. Features are lexical:
lengths, depth, digit ratio, entropy, parameter counts, and for the last label
and the last two labels of the host and the first part of the path the share of
blocked URLs among all URLs, with those that no rule decides. Only DataFrame functions and MLlib.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A null URL, or one
without ``://``, has an empty host and path. A rule ``host/path`` fits its host
and all subdomains where the path starts with its path; the longest rule that
fits wins, then the first in order. If the rules don't leave both verdicts to
learn from, URLs without a rule are allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

import string

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.sources.tables import written

ALLOW, BLOCK = "allow", "block"
#: Rules and their verdicts. Fixed values.
RULES = {"net/": BLOCK, "example.net/en/": ALLOW, "example.com/de/": BLOCK, "org/fr/": ALLOW}
#: The trees are fitted on about so many distinct URLs at most that have a rule, chosen
#: by hash; each weighs as much as it has rows.
TRAINED_ON = 20_000
TREES, DEPTH = 10, 3
#: Added to the counts behind a share of blocked URLs, half to each verdict.
PRIOR = 10.0
FEATURES = ["n_chars", "n_host", "n_path", "n_query", "depth", "labels", "digits", "entropy", "parameters"]
SUFFIXES = ["last", "last_two", "section"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    after = F.when(url.contains("://"), F.substring_index(url, "://", 1))
    rest = F.coalesce(F.substr(url, F.length(after) + 4), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The rule that decides, or null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    blocked = [r for r, verdict in rules.items() if verdict == BLOCK]
    return F.when(rule.isin(blocked), BLOCK).when(rule.isNotNull(), ALLOW)


def entropy(text: Column) -> Column:
    """Bits of the distribution of characters; 0 for an empty text."""
    n = F.length(text)
    of_char = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: F.when(c == "", 0.0).otherwise((n - F.length(F.replace(text, c, F.lit("")))) / n),
    )
    return F.aggregate(of_char, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Features and host suffixes of ``url``, ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = F.length(url) - F.length(F.translate(url, string.digits, ""))
    return urls.withColumns(
        {
            "n_chars": F.length(url),
            "n_host": F.length("host"),
            "n_path": F.length("path"),
            "n_query": F.length(query),
            "depth": F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit(""))),
            "labels": F.size(F.split("host", r"\.")),
            "digits": F.coalesce(F.try_divide(digits, F.length(url)), F.lit(0.0)),
            "entropy": entropy(url),
            "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
            "last": F.substring_index("host", ".", -1),
            "last_two": F.substring_index("host", ".", -2),
            "section": F.split_part("path", F.lit("/"), F.lit(2)),
        }
    )


def shares(urls: DataFrame, suffix: str) -> DataFrame:
    """For each suffix the smoothed share of URLs that a rule blocks, among all."""
    blocked = F.count_if(F.coalesce(F.col("known") == BLOCK, F.lit(False)))
    return urls.groupBy(suffix).agg(((blocked + PRIOR / 2) / (F.count(F.lit(1)) + PRIOR)).alias(f"{suffix}_share"))


def with_shares(urls: DataFrame, tables: list[DataFrame]) -> DataFrame:
    for suffix, table in zip(SUFFIXES, tables, strict=True):
        urls = urls.join(table, suffix, "left").fillna(0.5, [f"{suffix}_share"])
    return urls


def fit(learnt: DataFrame) -> PipelineModel:
    inputs = [*FEATURES, *[f"{s}_share" for s in SUFFIXES]]
    trees = GBTClassifier(
        labelCol="blocked", featuresCol="features", weightCol="rows", maxIter=TREES, maxDepth=DEPTH, seed=1, checkpointInterval=-1
    )
    labelled = learnt.withColumn("blocked", (F.col("known") == BLOCK).cast("double"))
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), trees]).fit(labelled)


def judge(pages: DataFrame, rules: dict[str, str] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """For every row its key, ``host``, ``path``, ``rule``, ``verdict`` and
    ``p_block``, the trees' probability (null where none were fitted)."""
    host, path = parts(F.col("url"))
    given = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"))
    placed = given.withColumns({"host": host, "path": path})
    ruled = placed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    known = ruled.withColumn("known", verdict_of(F.col("rule"), rules))
    urls = lexical(known)

    decided = known.filter("known is not null")
    distinct = decided.groupBy("known").agg(F.approx_count_distinct("url", 0.01).alias("n"))
    counts = {r["known"]: r["n"] for r in distinct.collect()}
    if len(counts) < 2:
        judged = known.withColumn("p_block", F.lit(None).cast("double"))
    else:
        share = min(1.0, TRAINED_ON / sum(counts.values()))
        chosen = F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share * (1 << 20)
        once = decided.filter(chosen).groupBy("url", "host", "path", "known").agg(F.count(F.lit(1)).alias("rows"))
        # Written once: every tree reads it again. Its size is bounded, so few files do.
        learnt = written(lexical(once.repartition(8)), "url-sample")
        tables = [shares(urls, s) for s in SUFFIXES]
        model = fit(with_shares(learnt, tables))
        scored = model.transform(with_shares(urls, tables))
        judged = scored.withColumn("p_block", vector_to_array("probability")[1])
    method = F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("known", method).alias("verdict"), "p_block"
    )
