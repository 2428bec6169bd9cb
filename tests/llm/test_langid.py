"""Held-out accuracy and the defined cases of the compression classifier."""

import zlib

import zstandard

from sylvatab.llm import langid
from sylvatab.llm.queries import op3_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    firm = [r for r in held if not r.rejected]
    assert sum(truth[r.doc_id] == r.lang_pred for r in firm) / len(firm) > 0.98


def test_like_plain_compression(spark):
    """Sizes by plain zstandard with the same dictionaries: prediction, score and rejection."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    learnt = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in langid.classify(docs, learnt, keep=["doc_id"]).collect():
        text = (texts[r.doc_id] or "").lower().encode()
        sizes = {}
        for name, content in sorted(learnt.items()):
            given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            one = zstandard.ZstdCompressor(langid.LEVEL, given, write_content_size=False, write_dict_id=False)
            sizes[name] = sum(len(one.compress(text[i : i + langid.BLOCK])) for i in range(0, len(text), langid.BLOCK))
        best, second = sorted(sizes, key=lambda k: (sizes[k], k))[:2]
        margin = (sizes[second] - sizes[best]) / sizes[second]
        assert (r.lang_pred, r.score, r.rejected) == (best, margin, margin < langid.MARGIN)


def test_windows_lie_anywhere(spark):
    """Learnt are windows within the texts, of the stated size, and not their starts."""
    rows = spark.range(400).selectExpr("concat('start', repeat(concat(' ', id, 'z'), 3000)) text", "'x' lang")
    parts = langid.learn(rows)["x"].split(b"\n")
    assert all(len(p) == langid.SAMPLE_BYTES for p in parts)
    assert sum(p.startswith(b"start") for p in parts) <= 2


def test_sample_is_bounded(spark):
    rows = spark.range(5000).selectExpr("concat('text ', id) text", "if(id % 2 = 0, 'x', 'y') lang")
    learnt = langid.learn(rows)
    assert sorted(learnt) == ["x", "y"]
    assert all(len(d.split(b"\n")) <= langid.SAMPLES for d in learnt.values())
    assert learnt == langid.learn(rows.repartition(7))


def test_odd_rows(odd, nothing):
    rows = langid.predict(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred in ("en", "fr", "de", langid.UNKNOWN) for r in rows)
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert [(r.lang_pred, r.score, r.rejected) for r in blank] == [(langid.UNKNOWN, 0.0, True)] * 3
    assert langid.predict(nothing).collect() == []


def test_no_label_at_all(odd):
    assert {r.lang_pred for r in langid.classify(odd, {}, keep=["doc_id"]).collect()} == {langid.UNKNOWN}


def test_tie_goes_to_the_first():
    answer = langid.Judge({"b": b"same words here", "a": b"same words here"})(b"same words here")
    assert (answer.lang, answer.score, answer.rejected) == ("a", 0.0, True)


def test_letters():
    assert [langid.has_letter(t) for t in ("", "12 ² ½ Ⅷ _ !", "1a", "é", "日", "٣")] == [False, False, True, True, True, False]
