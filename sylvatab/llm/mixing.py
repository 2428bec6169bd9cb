"""Mixing to target weights with soft domains.

A classifier learnt from labelled documents gives each document a posterior
over domains: one regression for the last domain against all others, one for the
domain before it against what is left, and so on, as the labels are read.
Features that cannot have a weight are left out beforehand. Nonnegative rates for all documents are fitted by projected
gradient with momentum, so that the expected tokens of each domain (rate x tokens x posterior)
come closest to the targets in least squares, each domain in units of what it
has. ``keep_protected`` gives a document whose likeliest domain is protected a
rate of 1 at least, for stages that are to keep such documents; the totals then
miss the targets by what these documents hold of other domains.
The rate becomes whole copies: its integer part, and one more where the hash of
id and text falls below the rest.

Posteriors are multiples of 1 / ``STEPS``, so documents with equal posteriors
have equal rates all along, and the gradient is summed over at most as many rows
as there are such posteriors. Each round is one small aggregate; only one number
for each domain comes to the driver, and the rate is an expression of these.

A null or empty text has no tokens; its posterior is that of no words. Labels
without quality and toxicity, and labels of no document, teach nothing; of several labels of
one id the most frequent domain counts, of equally frequent ones the first, and of
several texts of one id the one with the smallest hash teaches. With
fewer than two domains among the labels every document belongs to the one there
is (or the first). A domain without any expected tokens is left out of the fit.
Repeated rows have equal rates and equal copies.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VarianceThresholdSelector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import let
from sylvatab.sources.tables import written

#: Domains of the labels, in this order.
DOMAINS = ["clean", "poor", "toxic"]
#: Wanted share of the tokens after mixing for each domain.
TARGETS = {"clean": 0.98, "poor": 0.02, "toxic": 0.0}
#: There are to be as many tokens in all as make these domains' targets what they
#: have; with ``keep_protected`` their documents stay.
PROTECTED = ["clean"]
#: The classifier is fitted on so many labelled documents at most, by the hash of their id.
TRAINED_ON = 10_000
FEATURES = 1 << 16
#: Penalty on the size of the classifier's weights.
PENALTY = 0.001
STEPS = 64
#: Rounds of the fit at most, and the change of the domains' tokens that ends it.
ROUNDS, SETTLED = 60, 1e-5


def domain_of() -> Column:
    """The domain a label names, or null."""
    return (
        F.when(F.col("toxic") == 1, F.lit("toxic"))
        .when(F.col("quality") == 0, F.lit("poor"))
        .when(F.col("quality") == 1, F.lit("clean"))
    )


def tokens(text: Column) -> Column:
    """Number of words without white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), ""))


def featured(df: DataFrame, text: str) -> DataFrame:
    """``__features``: which lower-case words and symbols occur, hashed."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"\p{L}+|[^\s\p{L}]"), F.lit(0))
    with_terms = df.withColumn("__terms", F.array_distinct(terms))
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__terms", outputCol="__features")
    return hashing.transform(with_terms).drop("__terms")


def chosen_labels(labels: DataFrame) -> DataFrame:
    """``__id`` and ``__domain`` of at most ``TRAINED_ON`` labelled ids, by hash."""
    known = labels.select(F.col("doc_id").alias("__id"), domain_of().alias("__domain")).dropna()
    place = F.array_position(F.array(*map(F.lit, DOMAINS)), F.col("__domain"))
    counts = known.groupBy("__id", "__domain").agg((-F.count(F.lit(1))).alias("n"))
    first = F.min_by("__domain", F.struct("n", place.alias("place"))).alias("__domain")
    return counts.groupBy("__id").agg(first).orderBy(F.xxhash64("__id"), "__id").limit(TRAINED_ON)


def classified(df: DataFrame, docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """``df`` and ``__posterior``, an array of one number for each domain; the
    classifier is learnt from the labelled ones of ``docs``. Few words decide: a
    penalty on their weights' size leaves the others out."""
    texts = docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    # TRAINED_ON ids at most, so they may be broadcast; a row for each.
    given = texts.join(F.broadcast(chosen_labels(labels)), "__id")
    one = given.groupBy("__id").agg(
        F.first("__domain").alias("__domain"), F.min_by("__text", F.xxhash64("__text")).alias("__text")
    )
    sample = featured(one, "__text").select("__features", "__domain")
    # Few rows, of a bounded number: in one partition, since every partition
    # sends as many numbers to the driver as there are weights, in every round.
    sample = written(sample, "labelled").coalesce(1)
    counts = {r["__domain"]: r["count"] for r in sample.groupBy("__domain").count().collect()}
    present = [d for d in DOMAINS if d in counts]
    if len(present) < 2:
        sure = present[0] if present else DOMAINS[0]
        return df.withColumn("__posterior", F.array(*[F.lit(float(d == sure)) for d in DOMAINS]))
    chosen = weighable(sample, sum(counts[d] for d in present[:2]) / sum(counts.values()))
    scored, rest = featured(df, f"`{text}`"), sample if chosen is None else chosen.transform(sample)
    left, of = F.lit(1.0), {}
    for domain in reversed(present[1:]):
        if chosen is None:
            share = F.lit(counts[domain] / sum(counts[d] for d in present[: present.index(domain) + 1]))
        else:
            model = LogisticRegression(
                featuresCol="__chosen",
                labelCol="__label",
                family="binomial",
                regParam=PENALTY,
                elasticNetParam=1.0,
                standardization=False,
                maxIter=60,
            ).fit(rest.withColumn("__label", (F.col("__domain") == domain).cast("double")))
            share = chance(sorted(chosen.selectedFeatures), model.coefficients.toArray().tolist(), model.intercept)
            rest = rest.filter(F.col("__domain") != domain)
        of[domain] = left * share
        left = left * (1 - share)
    of[present[0]] = left
    scored = scored.withColumn("__found", F.unwrap_udt("__features")["indices"])
    scored = scored.withColumn("__r", F.array(*[F.round(of[d] * STEPS) if d in of else F.lit(0.0) for d in DOMAINS]))
    total = F.aggregate("__r", F.lit(0.0), lambda a, p: a + p)
    posterior = F.transform("__r", lambda p: p / total).alias("__posterior")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], posterior)


def chance(features: list[int], weights: list[float], intercept: float) -> Column:
    """The probability that a regression gives, from ``__found``, the features that occur in
    ascending order: summed up as the model does, over the few that have a weight."""
    some = [(f, w) for f, w in zip(features, weights, strict=True) if w]
    total = F.lit(0.0)
    if some:
        places, sizes = (F.array(*map(F.lit, x)) for x in zip(*some, strict=True))
        weighed = F.array_intersect("__found", places)
        total = F.aggregate(weighed, total, lambda a, f: a + F.get(sizes, (F.array_position(places, f) - 1).cast("int")))
    return 1 - 1 / (1 + F.exp(total + F.lit(float(intercept))))


def weighable(sample: DataFrame, least_share: float):
    """The choice (to ``__chosen``) of the features that may get a weight in a fit on
    ``least_share`` of the sample or more; None where there are none.

    What a feature pulls at its weight is its covariance with the errors, which are
    below 1: on all rows at most twice its variance, and on a share of them that by
    the share. A weight on which no more than the penalty pulls stays 0 all along, so
    the fit is the same without it.
    """
    most = PENALTY / 2 * least_share
    selector = VarianceThresholdSelector(featuresCol="__features", outputCol="__chosen", varianceThreshold=most).fit(sample)
    return selector if selector.selectedFeatures else None


def least_rate(posterior: Column) -> Column:
    """1 where the likeliest domain (the first of equals) is protected, else 0."""
    likeliest = F.array_position(posterior, F.array_max(posterior)).cast("int")
    return F.when(likeliest.isin([DOMAINS.index(d) + 1 for d in PROTECTED]), 1.0).otherwise(0.0)


def walked(posterior: Column, steps: list[list[float]], keep_protected: bool = False) -> Column:
    """The rate after these steps, ``x``, and ``y``, the place that the next gradient
    is taken at. A step is the scaled gradient and the momentum: it takes the
    posterior's product with the gradient off ``y``, projects on what the rate may
    be, and goes on in the direction that the rate has moved."""
    floor = least_rate(posterior) if keep_protected else F.lit(0.0)
    n = len(DOMAINS)

    def step(now: Column, by: Column) -> Column:
        products = F.zip_with(posterior, F.slice(by, 1, n), lambda p, g: p * g)
        change = F.aggregate(products, F.lit(0.0), lambda a, x: a + x)

        def moved(x: Column) -> Column:
            return F.struct(x.alias("x"), (x + F.get(by, F.lit(n)) * (x - now["x"])).alias("y"))

        return let(F.greatest(floor, F.lit(0.0), now["y"] - change), moved)

    history = F.array(*[F.array(*[F.lit(g) for g in s]) for s in steps]) if steps else F.lit([]).cast("array<array<double>>")
    start = F.greatest(F.lit(1.0), floor)
    return F.aggregate(history, F.struct(start.alias("x"), start.alias("y")), step)


def rate(posterior: Column, steps: list[list[float]], keep_protected: bool = False) -> Column:
    """The rate after these steps."""
    return walked(posterior, steps, keep_protected)["x"]


def wanted_tokens(has: list[float], targets: dict[str, float]) -> list[float]:
    """Tokens that each domain is to have."""
    safe = sum(h for h, d in zip(has, DOMAINS, strict=True) if d in PROTECTED)
    share = sum(targets[d] for d in PROTECTED)
    total = safe / share if safe and share else sum(has)
    return [targets[d] * total for d in DOMAINS]


def fit(scored: DataFrame, targets: dict[str, float], keep_protected: bool = False) -> list[list[float]]:
    """The steps that lead to the rates, from ``__posterior`` and ``__tokens``: in each
    the gradient for every domain and the momentum, which grows towards 1."""
    cells = scored.groupBy("__posterior").agg(F.sum("__tokens").alias("tokens"))
    cells = written(cells, "cells")

    def totals(weight: Column) -> list[float]:
        sums = [F.sum(F.col("tokens") * F.col("__posterior")[d] * weight) for d in range(len(DOMAINS))]
        return [x or 0.0 for x in cells.agg(*sums).first()]

    has = totals(F.lit(1.0))
    wanted = wanted_tokens(has, targets)
    steps: list[list[float]] = []
    before, pace = None, 1.0
    for _ in range(ROUNDS):
        now = has if not steps else totals(walked(F.col("__posterior"), steps, keep_protected)["y"])
        if before and max(abs(a - b) for a, b in zip(now, before, strict=True)) <= SETTLED * max(sum(has), 1.0):
            break
        before = now
        # The scaled problem's largest eigenvalue is 1, since posteriors sum to 1: so is the step.
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        gradient = [(a - w) / h if h > 0 else 0.0 for a, w, h in zip(now, wanted, has, strict=True)]
        steps.append([*gradient, (pace - 1) / faster])
        pace = faster
    return steps


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    text: str = "text",
    key: str = "doc_id",
    keep_protected: bool = False,
) -> DataFrame:
    """All rows and columns with ``__tokens``, ``__posterior``, ``__rate`` and ``__copies``."""
    counted = docs.withColumn("__tokens", tokens(F.col(f"`{text}`")).cast("long")).withColumn(
        "__u", F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(1 << 30)) / (1 << 30)
    )
    # Written with the documents, so that nothing is shuffled or classified twice.
    scored = written(classified(counted, docs, labels, text, key), "posteriors")
    rated = scored.withColumn("__rate", rate(F.col("__posterior"), fit(scored, targets, keep_protected), keep_protected))
    whole = F.floor("__rate")
    copies = (whole + F.when(F.col("__u") < F.col("__rate") - whole, 1).otherwise(0)).cast("int")
    return rated.withColumn("__copies", copies).drop("__u")


def mix(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", keep_protected: bool = False
) -> DataFrame:
    """The documents, each as often as its rate says."""
    repeated = mixed(docs, labels, text=text, key=key, keep_protected=keep_protected)
    copies = F.explode(F.when(F.col("__copies") > 0, F.sequence(F.lit(1), F.col("__copies")))).alias("__copy")
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns], copies).drop("__copy")


def balance(mixed_rows: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """For each domain the tokens it has, is wanted to have and is expected to have
    after mixing, and ``residual``, what it misses as a share of all wanted tokens.
    ``mixed_rows`` is what :func:`mixed` gives."""
    tokens = F.col("__tokens") * 1.0
    has = [F.sum(tokens * F.col("__posterior")[i]) for i in range(len(DOMAINS))]
    gets = [F.sum(tokens * F.col("__posterior")[i] * F.col("__rate")) for i in range(len(DOMAINS))]
    row = [x or 0.0 for x in mixed_rows.agg(*has, *gets).first()]
    has, gets = row[: len(DOMAINS)], row[len(DOMAINS) :]
    wanted = wanted_tokens(has, targets)
    total = sum(wanted) or 1.0
    rows = [(d, h, w, g, (g - w) / total) for d, h, w, g in zip(DOMAINS, has, wanted, gets, strict=True)]
    return mixed_rows.sparkSession.createDataFrame(rows, "domain string, has double, wanted double, expected double, residual double")


def report(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, tokens, posterior of each domain, rate and copies of every row."""
    out = mixed(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), labels)
    return out.select(
        F.col("doc_id").alias(key),
        F.col("__tokens").alias("n_tokens"),
        *[F.col("__posterior")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
        F.col("__rate").alias("rate"),
        F.col("__copies").alias("copies"),
    )
