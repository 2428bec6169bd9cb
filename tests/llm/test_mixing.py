"""The fit against projected gradient over single documents; posteriors held out."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VarianceThresholdSelector
from pyspark.sql import functions as F

from sylvatab.llm import mixing
from sylvatab.llm.queries import op9_mixing

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def brute_force(posteriors, tokens, targets, keep_protected=False):
    """Rates of all documents, each with a row of its own."""
    has = tokens @ posteriors
    wanted = np.array(mixing.wanted_tokens(list(has), targets))
    protected = [mixing.DOMAINS.index(d) for d in mixing.PROTECTED]
    floor = np.isin(posteriors.argmax(axis=1), protected).astype(float) * keep_protected
    rates = ahead = np.ones(len(tokens))
    before, pace = None, 1.0
    for _ in range(mixing.ROUNDS):
        now = (tokens * ahead) @ posteriors
        if before is not None and abs(now - before).max() <= mixing.SETTLED * max(has.sum(), 1):
            break
        before = now
        gradient = np.where(has > 0, (now - wanted) / np.where(has > 0, has, 1), 0)
        moved = np.maximum(ahead - posteriors @ gradient, floor)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        rates, ahead, pace = moved, moved + (pace - 1) / faster * (moved - rates), faster
    return rates


@pytest.mark.parametrize(
    "targets",
    [mixing.TARGETS, {"clean": 0.5, "poor": 0.3, "toxic": 0.2}, {"clean": 0.0, "poor": 1.0, "toxic": 0.0}],
)
@pytest.mark.parametrize("keep", [False, True])
def test_fit_like_brute_force(spark, targets, keep):
    rng = np.random.default_rng(3)
    posteriors = np.round(rng.dirichlet([2, 0.6, 0.4], 200) * mixing.STEPS)
    posteriors /= posteriors.sum(axis=1, keepdims=True)
    tokens = rng.integers(0, 500, 200)
    rows = [(i, p.tolist(), int(t)) for i, (p, t) in enumerate(zip(posteriors, tokens, strict=True))]
    scored = spark.createDataFrame(rows, "id int, __posterior array<double>, __tokens bigint")
    steps = mixing.fit(scored, targets, keep)
    got = scored.select("id", mixing.rate(F.col("__posterior"), steps, keep).alias("rate")).collect()
    want = brute_force(posteriors, tokens, targets, keep)
    assert [r.rate for r in sorted(got)] == pytest.approx(want, abs=1e-6)
    # Nearer to the targets than no mixing at all.
    wanted = np.array(mixing.wanted_tokens(list(tokens @ posteriors), targets))
    has = tokens @ posteriors
    off = [(((tokens * r) @ posteriors - wanted) ** 2 / has).sum() for r in (want, np.ones(200))]
    assert off[0] <= off[1]


def test_query(spark):
    rows = sorted(op9_mixing(spark, SF).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert [r.doc_id for r in rows] == sorted(texts)
    assert all(r.n_tokens == len(texts[r.doc_id].split()) for r in rows)
    posteriors = np.array([[r.p_clean, r.p_poor, r.p_toxic] for r in rows])
    assert posteriors.sum(axis=1) == pytest.approx(np.ones(len(rows)))
    want = brute_force(posteriors, np.array([r.n_tokens for r in rows]), mixing.TARGETS)
    assert [r.rate for r in rows] == pytest.approx(want, abs=1e-6)
    assert all(np.floor(r.rate) <= r.copies <= np.ceil(r.rate) for r in rows)


def test_held_out_labels(spark):
    """Clean documents that taught nothing stay where they are to; most toxic ones go."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = mixing.mixed(docs, labels.filter("doc_id % 3 <> 0"), keep_protected=True).withColumnRenamed("__copies", "copies")
    held = rows.join(labels.filter("doc_id % 3 = 0").withColumn("domain", mixing.domain_of()), "doc_id").collect()
    kept = {d: np.mean([r.copies > 0 for r in held if r.domain == d]) for d in mixing.DOMAINS}
    assert kept["clean"] > 0.99
    assert kept["toxic"] < 0.5
    assert kept["poor"] < 0.5


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_targets_are_met(spark, sf):
    """Expected tokens of every domain are within 1 % of all tokens of the wanted ones."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/sf{sf}/labels.parquet")
    rows = {r.domain: r for r in mixing.balance(mixing.mixed(docs, labels)).collect()}
    assert list(rows) == mixing.DOMAINS
    assert all(abs(r.residual) < 0.01 for r in rows.values())
    assert all(abs(r.expected / r.wanted - 1) < 0.01 for r in rows.values() if r.wanted)
    assert rows["toxic"].expected < 0.1 * rows["toxic"].has


def test_labels_in_any_order(spark):
    rows = [(1, 1, 0), (1, 0, 0), (1, 0, 0), (2, 1, 0), (2, 0, 1), (3, 0, 0), (3, 1, 0), (3, None, None), (None, 1, 0)]
    for given in (rows, rows[::-1]):
        chosen = mixing.chosen_labels(spark.createDataFrame(given, LABELS)).collect()
        assert {r[0]: r[1] for r in chosen} == {1: "poor", 2: "clean", 3: "clean"}


def test_one_row_for_each_labelled_id(spark, monkeypatch):
    """An id with very many rows teaches once."""
    docs = spark.range(3000).selectExpr("IF(id < 2900, 1, id) AS doc_id", "concat('text ', id % 7) AS text")
    labels = spark.createDataFrame([(1, 1, 0), (2950, 0, 0), (2951, 1, 1)], LABELS)
    seen = []
    monkeypatch.setattr(mixing, "written", lambda df, name: seen.append((name, df.count())) or df)
    mixing.classified(docs, docs, labels, "text", "doc_id")
    assert ("labelled", 3) in seen


def test_mix_repeats_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * i, "x") for i in range(6)], "doc_id bigint, text string, copies string")
    monkeypatch.setattr(mixing, "fit", lambda scored, *_: [[-1.5, 0.0, 0.0]])
    none = spark.createDataFrame([], LABELS)
    rows = mixing.mix(docs, none)
    assert rows.columns == docs.columns
    assert {r.doc_id for r in rows.collect()} == set(range(6))
    assert 12 <= rows.count() <= 18  # a rate of 2.5
    monkeypatch.setattr(mixing, "PROTECTED", [])
    monkeypatch.setattr(mixing, "fit", lambda scored, *_: [[2.0, 0.0, 0.0]])
    assert mixing.mix(docs, none).collect() == []


def test_features_left_out_have_no_weight(spark):
    """A regression on all features gives none to those that are left out beforehand."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "__id")
    given = docs.join(mixing.chosen_labels(spark.read.parquet(f"{sf}/labels.parquet")), "__id").select("__domain", "text")
    # The rule by the penalty, made visible on few documents.
    sample = mixing.featured(given, "text").repartition(1).withColumn("__label", (F.col("__domain") == "poor").cast("double")).cache()
    occurring = VarianceThresholdSelector(featuresCol="__features", outputCol="c").fit(sample).selectedFeatures
    for penalty in (0.006, 0.012):
        selector = VarianceThresholdSelector(featuresCol="__features", outputCol="c", varianceThreshold=penalty / 2).fit(sample)
        fitted = LogisticRegression(
            featuresCol="__features", labelCol="__label", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60
        ).fit(sample)
        weights = fitted.coefficients.toArray()
        assert 0 < np.count_nonzero(weights) < len(selector.selectedFeatures) < len(occurring)
        assert set(np.flatnonzero(weights)) <= set(selector.selectedFeatures)
    sample.unpersist()


def test_documents_meet_only_the_features_with_a_weight(spark, monkeypatch):
    """No vector of the chosen features is made for documents; the chances are the models'."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    models, chosen, fit, of = [], [], LogisticRegression.fit, mixing.weighable
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df: models.append(fit(self, df)) or models[-1])
    monkeypatch.setattr(mixing, "weighable", lambda *a: chosen.append(of(*a)) or chosen[-1])
    scored = mixing.classified(docs, docs, labels, "text", "doc_id")
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("UDF(") == 1
    want = chosen[0].transform(mixing.featured(docs, "text"))
    for i, model in enumerate(models):
        assert np.count_nonzero(model.coefficients.toArray())
        model = model.setProbabilityCol(f"p{i}").setRawPredictionCol(f"r{i}").setPredictionCol(f"l{i}")
        want = model.transform(want)
    rows = {r.doc_id: r["__posterior"] for r in scored.select("doc_id", "__posterior").collect()}
    for r in want.select("doc_id", "p0", "p1").collect():
        toxic, poor = r.p0[1], (1 - r.p0[1]) * r.p1[1]
        shares = np.round(np.array([1 - toxic - poor, poor, toxic]) * mixing.STEPS)
        assert rows[r.doc_id] == pytest.approx(shares / shares.sum())


def test_nothing_to_weigh(spark):
    """Equal texts under several domains: the posterior is the labels' share."""
    docs = spark.createDataFrame([(i, "same words") for i in range(8)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 6), int(i < 2)) for i in range(8)], LABELS)
    rows = mixing.report(docs, labels).collect()
    assert {(r.p_clean, r.p_poor, r.p_toxic) for r in rows} == {(0.5, 0.25, 0.25)}


def test_words_rarely_collide(spark):
    """Of 3,000 words about 70 share a feature with another in 1 << 16, twice as many in half."""
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    row = mixing.featured(spark.createDataFrame([(" ".join(words),)], "text string"), "text").first()
    assert len(words) - row["__features"].numNonzeros() < 100


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (None, 1, 1), (5, None, None), (1, 1, 0), (77, 0, 1)], LABELS)
    rows = mixing.report(odd, labels).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len((r.text or "").split()) for r in odd.collect())
    for given in (labels, labels.filter("doc_id = 1"), labels.filter("doc_id = 77")):
        assert mixing.report(nothing, given).collect() == []
        assert mixing.mix(odd, given).columns == odd.columns
