"""Byte-pair encoding and decoding by an index from pairs to their positions.

The words of a slice of texts stand one after another in one array of symbols.
The index maps each pair that has a rank to all its positions; the lowest
active rank is taken, merged at all its positions at once, and the lists of the
pairs that this makes are extended. Since no merge makes a pair of a lower rank
(checked when the vocabulary is read), this gives each word what merging it
alone gives.

A null text has no tokens; an empty one likewise. Text of any length is taken
whole. Special tokens that the vocabulary file names are found in the text
first, as the tokenizers library does by default.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import per_text

#: Splits text into words before the merges; fixed by the public vocabulary. The
#: commonest kind stands first: no other kind can begin with a letter.
WORDS = r" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: The same for text below U+0250, with letters, numbers and white space spelt
#: out, for the faster of the two expression engines.
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
NEAR_WORDS = (
    f" ?[{LETTERS}]++|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]++| ?[^{SPACES}{LETTERS}{NUMBERS}]++"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Encoded words a worker remembers; beyond it, it forgets all and goes on.
REMEMBERED = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it
    can be printed, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """A byte-level vocabulary file: ids, ranks of pairs, bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.byte_ids = np.array([ids[x] for x in letters], np.int64)
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.pieces = [b""] * self.size
        for token, i in ids.items():
            self.pieces[i] = bytes(byte_of[x] for x in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        made: dict[int, int] = {}
        pairs = []
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = ids[left], ids[right], ids[left + right]
            if max(made.get(a, -1), made.get(b, -1)) >= rank or c in made:
                raise ValueError(f"merge {rank} is not of a higher rank than what it joins")
            made[c] = rank
            pairs.append((a * self.size + b, a, b, c))
        table = np.array(pairs, np.int64).reshape(-1, 4)
        self.left, self.right, self.merged = table[:, 1], table[:, 2], table[:, 3]
        order = np.argsort(table[:, 0])
        self._keys, self._ranks = table[order, 0], order

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where it has none."""
        if not len(self._keys):
            return np.full(len(left), -1)
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], -1)


class PairIndex:
    """Positions of every ranked pair in a sequence of words."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.vocabulary = vocabulary
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(lengths)
        n = len(data)
        self.symbols = vocabulary.byte_ids[data]
        self.alive = np.ones(n, bool)
        # One place more than the symbols: reading or writing at -1 hits it.
        self.following = np.arange(1, n + 2)
        self.before = np.arange(-1, n)
        self.following[self.ends - 1] = -1
        self.before[self.ends - lengths] = -1
        self.following[n] = self.before[n] = -1
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.following[:n] >= 0))

    def _add(self, at: np.ndarray) -> None:
        """Enter the pairs that begin at these positions."""
        ranks = self.vocabulary.ranks(self.symbols[at], self.symbols[self.following[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        first = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
        for start, end, rank in zip(first, [*first[1:], len(at)], ranks[first].tolist(), strict=True):
            if rank in self.lists:
                self.lists[rank].append(at[start:end])
            else:
                self.lists[rank] = [at[start:end]]
                heapq.heappush(self.active, rank)

    def _positions(self, rank: int) -> np.ndarray:
        """Where the pair still stands, without overlaps, leftmost first."""
        left, right = self.vocabulary.left[rank], self.vocabulary.right[rank]
        at = np.concatenate(self.lists.pop(rank))
        at = at[self.alive[at]]
        after = self.following[at]
        at = at[(after >= 0) & (self.symbols[at] == left) & (self.symbols[after] == right)]
        if left != right or len(at) < 2:
            return at
        at = np.unique(at)
        chained = np.r_[False, self.following[at[:-1]] == at[1:]]
        run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        return at[(np.arange(len(at)) - run) % 2 == 0]

    def merge(self) -> list[bytes]:
        """Apply all ranks; the ids of each word as the bytes of 32-bit integers."""
        while self.active:
            rank = heapq.heappop(self.active)
            at = self._positions(rank)
            if not len(at):
                continue
            gone = self.following[at]
            self.symbols[at] = self.vocabulary.merged[rank]
            self.alive[gone] = False
            after = self.following[gone]
            self.following[at] = after
            self.before[after] = at
            self.before[-1] = -1
            ahead = self.before[at]
            # A place named twice does no harm: merging it again changes nothing.
            self._add(np.concatenate([ahead[ahead >= 0], at[after >= 0]]))
        ids = self.symbols[self.alive].astype(np.int32).tobytes()
        ends = (np.cumsum(self.alive)[self.ends - 1] * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Encoder:
    """Encodes slices of texts; remembers a bounded number of words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.all_words = regex.compile(WORDS).findall
        self.near_words = re.compile(NEAR_WORDS).findall
        self.far = re.compile("[^\0-ɏ]").search
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        return self.all_words(text) if self.far(text) else self.near_words(text)

    def parts(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        if not self.special or not self.special.search(text):
            return self.words(text)
        out, start = [], 0
        for found in self.special.finditer(text):
            out += [*self.words(text[start : found.start()]), found.group()]
            start = found.end()
        return out + self.words(text[start:])

    def encode(self, contents: list[bytes]) -> list[bytes]:
        """Ids of each text, as the bytes of 32-bit integers."""
        parts = [self.parts(t.decode()) for t in contents]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if not self.known:
            special = self.vocabulary.special.items()
            self.known.update((t, np.int32(i).tobytes()) for t, i in special)
        new = list(set().union(*parts).difference(self.known))
        if new:
            self.known.update(zip(new, PairIndex(self.vocabulary, [w.encode() for w in new]).merge(), strict=True))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in parts]


@lru_cache(maxsize=2)
def pieces(path: str) -> list[bytes]:
    return Vocabulary(path).pieces


def decode_ids(ids: list[int], path: str) -> str:
    """The text of a list of ids; bytes that are no UTF-8 become U+FFFD."""
    table = pieces(path)
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all others) and ``ids``, an array of ids
    that is empty for a null or empty text. ``path`` must exist on every
    executor."""

    def make():
        encoder = Encoder(path)

        def run(contents: list[bytes]) -> list[pa.Array]:
            encoded = encoder.encode(contents)
            ends = np.cumsum([0, *[len(x) // 4 for x in encoded]]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(encoded), np.int32))
            return [pa.ListArray.from_arrays(pa.array(ends), values)]

        return run

    return per_text(df, make, text, keep or [c for c in df.columns if c != text], "ids array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the text of ``ids``; null ids give null."""
    schema = df.withColumn(out, F.lit(None).cast("string")).schema

    def run(batches):
        table = np.array(pieces(path), object)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for start in range(0, batch.num_rows, 256):
                part, few = batch.slice(start, 256), column.slice(start, 256)
                texts = [
                    b"".join(table[x.values.to_numpy()]).decode("utf-8", "replace") if x.is_valid else None for x in few
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` of every row."""
    return decode(encode(df, path, text, [key]), path)


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and the SHA-256 of the ids (decimal, joined by
    commas) and of the decoded text."""
    coded = round_trip(df, path, key, text)
    return coded.select(
        F.col(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
