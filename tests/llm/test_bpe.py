"""Encoding against the tokenizers library, decoding as a round trip."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sylvatab.llm import bpe
from sylvatab.llm.queries import BPE_FILE, op1_bpe

SF = "/root/testdata/sf0.001"

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "a",
        "aaaaaaaaaaaaaaaaa aaa",
        "I'll say it's we're <|endoftext|> done <|endoftext|>",
        "  \n\n x\t\ty  ",
        "　\x85\x1c\x1d\xa0 x² ½ Ⅷ ٣",
        "日本語 テキスト 🎉🎉 é",
        "".join(chr(c) for c in range(0x20, 0x3000)),
    ],
)
def test_like_the_library(text):
    ids, decoded = library(text)
    mine = np.frombuffer(bpe.Encoder(BPE_FILE).encode([text.encode()])[0], np.int32).tolist()
    assert mine == ids
    assert bpe.decode_ids(mine, BPE_FILE) == decoded


def test_bytes_that_are_no_text(spark):
    part = library("é")[0][:1]
    lone = [i for i, b in enumerate(bpe.pieces(BPE_FILE)) if b == b"\xc3"]
    assert bpe.decode_ids(lone, BPE_FILE) == "�" == LIBRARY.decode(lone)
    coded = spark.createDataFrame([(lone,), (part,), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(coded, BPE_FILE).collect()] == ["�", "é", "", None]


def test_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(BPE_FILE)
    for text in ["one two three four", "five six seven eight", "one five <|endoftext|>"]:
        assert np.frombuffer(encoder.encode([text.encode()])[0], np.int32).tolist() == library(text)[0]


def digest(text):
    ids, decoded = library(text or "")
    return len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]


def test_odd_rows(odd, nothing):
    got = sorted(map(tuple, bpe.digests(odd, BPE_FILE).collect()), key=str)
    want = sorted(((r.doc_id, *digest(r.text)) for r in odd.collect()), key=str)
    assert got == want
    assert bpe.digests(nothing, BPE_FILE).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in op1_bpe(spark, SF).collect()}
    assert got == {i: digest(t) for i, t in texts.items()}
