"""Language by compression: each language has a raw-content dictionary of texts
known to be in it; a text is in the language whose dictionary makes it smallest.

A null text, or one without a letter, is ``und``. Where the two smallest sizes
lie close together the answer is marked as rejected. Ties go to the language
that comes first in order. Case makes no difference. Long texts are taken whole, in blocks, so that the
dictionary and not the text's own start decides.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import per_text

UNKNOWN = "und"
#: At most so many texts are taken for a language, and of each a window of so many
#: bytes, placed by the text's hash: the dictionaries hold ``SAMPLES * SAMPLE_BYTES`` bytes a language at most.
SAMPLES, SAMPLE_BYTES = 128, 2048
#: Texts are compressed in blocks of so many bytes.
BLOCK = 2048
LEVEL = 6
#: The smallest size must be smaller than the second by this share.
MARGIN = 0.02
#: Letters, and signs for numbers that are no digits.
NEARLY = re.compile(r"[^\W\d_]")


class Answer(NamedTuple):
    lang: str
    score: float
    rejected: bool


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample of its texts.

    Texts fall into ``SAMPLES`` slots by hash; the smallest hash of each slot is
    taken, so that the sample does not depend on the order or place of rows.
    Only the chosen rows, ``SAMPLES`` a language at most, come to the driver.
    Rows without text or language teach nothing.
    """
    rows = labelled.select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("hash")
    ).filter("lang is not null and length(text) > 0")
    slot = F.pmod("hash", F.lit(SAMPLES)).alias("slot")
    chosen = rows.groupBy("lang", slot).agg(F.min("hash").alias("hash")).drop("slot")
    # A text's window lies anywhere in it, by its hash.
    start = F.pmod(F.xxhash64(F.lit(1), "text"), F.greatest(F.length("text") - SAMPLE_BYTES + 1, F.lit(1)))
    window = F.substr("text", start.cast("int") + 1, F.lit(SAMPLE_BYTES)).alias("text")
    texts = rows.join(F.broadcast(chosen), ["lang", "hash"], "left_semi").select("lang", "hash", window)
    found: dict[str, list[bytes]] = {}
    for row in sorted(texts.distinct().collect()):
        found.setdefault(row["lang"], []).append(row["text"].lower().encode()[:SAMPLE_BYTES])
    return {name: b"\n".join(parts) for name, parts in sorted(found.items())}


def has_letter(text: str) -> bool:
    return any(found.group().isalpha() for found in NEARLY.finditer(text))


class Judge:
    """Compressors for all languages, made once a task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.compress = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            made = zstandard.ZstdCompressor(LEVEL, content, write_content_size=False, write_dict_id=False)
            self.compress.append(made.compress)

    def __call__(self, text: bytes) -> Answer:
        letters = text.decode()
        if not self.names or not has_letter(letters):
            return Answer(UNKNOWN, 0.0, True)
        text = letters.lower().encode()
        blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
        sizes = [sum(len(compress(x)) for x in blocks) for compress in self.compress]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min([s for i, s in enumerate(sizes) if i != best], default=sizes[best])
        margin = (second - sizes[best]) / second
        return Answer(self.names[best], margin, margin < MARGIN and len(sizes) > 1)


def classify(
    df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The ``keep`` columns (default: all others) with ``lang_pred``, ``score``
    (the share by which the smallest size beats the second) and ``rejected``."""

    def make():
        judge = Judge(dictionaries)

        def run(contents: list[bytes]) -> list[pa.Array]:
            found = [judge(x) for x in contents]
            return [
                pa.array([x.lang for x in found], pa.string()),
                pa.array([x.score for x in found], pa.float64()),
                pa.array([x.rejected for x in found], pa.bool_()),
            ]

        return run

    added = "lang_pred string, score double, rejected boolean"
    return per_text(df, make, text, keep or [c for c in df.columns if c != text], added)


def held_out(key: str) -> Column:
    """Whether the row is kept from learning: CRC-32 of the key, remainder 1 of 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def predict(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and judge every row by its text."""
    dictionaries = learn(df.filter(~held_out(key)), text, lang)
    judged = classify(df, dictionaries, text, [key])
    return judged.select(key, held_out(key).alias("held_out"), "lang_pred", "score", "rejected")
