"""Every stage of the pipeline against brute force on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from sylvatab.llm import mixing, quality
from llm import test_bpe, test_lines, test_minhash, test_quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """The rows after each stage, written and read as the driver does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        out.append(docs)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(outputs):
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns
        assert df.count() > 0


def test_quality_rules(spark, outputs):
    given, left = by_id(outputs[0]), by_id(outputs[1])
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    scores = test_quality.scores([r.text for r in given.values()], [i in good for i in given])
    want = {
        i: r
        for (i, r), score in zip(given.items(), scores, strict=True)
        if not test_quality.base(r.text)[-1] and score >= quality.THRESHOLD
    }
    assert left == want


def test_line_dedup(outputs):
    rows = [(r.doc_id, r.text, r.source) for r in outputs[1].collect()]
    want = test_lines.expected(rows, corpus_pipeline.lines.MIN_SITES)
    assert sorted(((r.doc_id, r.text) for r in outputs[2].collect()), key=str) == want
    assert all(r.n_chars == len(r.text) for r in outputs[2].collect())


def test_near_dedup(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[2].collect()]
    kept = {i for i, _, _, keep in test_minhash.brute_force(rows) if keep}
    assert by_id(outputs[3]) == {i: r for i, r in by_id(outputs[2]).items() if i in kept}


def test_mixing(spark, outputs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rates = {r.doc_id: r for r in mixing.mixed(outputs[3], labels, keep_protected=True).collect()}
    counts = dict.fromkeys(rates, 0)
    for r in outputs[4].collect():
        counts[r.doc_id] += 1
    assert counts == {i: r["__copies"] for i, r in rates.items()}
    assert all(r["__copies"] >= 1 for r in rates.values() if np.argmax(r["__posterior"]) == 0)


def test_encoding(outputs):
    texts = by_id(outputs[4])
    rows = outputs[5].collect()
    assert len(rows) == outputs[4].count()
    for r in rows:
        assert (list(r.ids), r.n_tokens) == (test_bpe.library(texts[r.doc_id].text)[0], len(r.ids))
        assert r.intact


def test_run(spark, outputs):
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.n_tokens) for r in outputs[5].collect())


def test_copies_over_many_sources(spark):
    """Of exact copies on many sources one is left, with the whole text; blank documents stay."""
    rows = [(i, "one line\n\nand another", "en", f"s{i}", 21, None) for i in range(1, 15)] + [(20, " ", "en", "s", 1, None), (21, None, "en", "s", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string")
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert left == {1: rows[0][1], 20: " ", 21: None}


def test_near_copies_over_many_sources(spark, tmp_path):
    """Of twelve near copies on twelve sources one whole document comes out, and no
    fragments; documents that share some of their lines only stay."""
    shared = "\n".join(" ".join(f"w{line}x{word}" for word in range(9)) for line in range(12))
    footer = "all pages of this kind end with these few words"
    rows = [(i, f"{shared}\nthis line is of copy {i}", "en", f"s{i}", 1) for i in range(1, 13)]
    rows += [(i, " ".join(f"d{i}y{word}" for word in range(80)) + f"\n{footer}", "en", f"s{i}", 1) for i in range(20, 32)]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(left) == [1, *range(20, 32)]
    whole = test_bpe.library(rows[0][1])[0]
    assert list(left[1].ids) == whole
    texts = {i: t for i, t, *_ in rows}
    assert list(left[20].ids) == test_bpe.library(texts[20])[0]
    assert list(left[31].ids) == test_bpe.library(texts[31].removesuffix(f"\n{footer}"))[0]


def test_odd_rows(spark, odd, nothing):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "ids")
    for stage in (s for _, s in corpus_pipeline.STAGES):
        assert stage(spark, nothing, SF).collect() == []
        assert stage(spark, docs, SF).count() <= 2 * docs.count()
