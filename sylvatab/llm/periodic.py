"""Periodic runs: stretches of words that repeat themselves three times or more.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), of ``max(shortest, repeats * q)`` words or more, that no
neighbouring word extends. Runs come from the suffixes of a text, united by
falling length of their common prefix: neighbours in suffix order are edges, the
longest common prefix is their weight, and a union-find joins classes of
suffixes, the ordered positions of the smaller one going into those of the
larger. Two positions that become neighbours in a class at common prefix ``l``
and lie ``d <= l`` apart start a repetition of period ``d`` and ``l + d`` words.
``d`` is its smallest period, since a smaller one would have put a position
between the two at a greater ``l``; and the pair at the very start of a run is
always among them, for the same reason. So each run is found once.

A run of ``n`` words has a pair with a common prefix of ``n - q`` words, at least
``shortest * (repeats - 1) / repeats``; suffixes with less in common are never
united. Texts without two equal stretches of that many words (by a hash of
windows, so that a chance collision only costs time) have no run and are not sorted.

Words are runs without ``[\\x20\\x09-\\x0D]``. A null, empty or blank text has no
words, no runs and an empty collapsed text. Rows are treated by themselves:
repeated rows give equal results, and other columns are only carried along. A
text is held as a whole in one task, whatever its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sylvatab.llm.common import per_text

#: A run has so many words at least, and so many periods.
SHORTEST, REPEATS = 24, 3

Run = tuple[int, int, int]


def ranks(words: np.ndarray) -> list[np.ndarray]:
    """Order of all windows of 1, 2, 4, ... words, until all differ. Windows that
    the end cuts off differ from all others; one more entry stands for the end."""
    n = len(words)
    levels = [np.append(np.unique(words, return_inverse=True)[1].astype(np.int64), -1)]
    width = 1
    while levels[-1].max() + 1 < n:
        now = levels[-1]
        follow = np.zeros(n, np.int64)
        follow[: n - width] = now[width:n] + 1
        levels.append(np.append(np.unique(now[:n] * (n + 1) + follow, return_inverse=True)[1], -1))
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Words that neighbours in suffix order have in common at their start."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        shared += step
        # A window that fits lies within the text, so none goes beyond its end.
        a, b = a + step, b + step
    return shared


def runs(words: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[Run]:
    """All runs as (start, length, period), by start, then period; ``words`` are
    numbers, equal for equal words."""
    n = len(words)
    if n < shortest:
        return []
    levels = ranks(words)
    order = np.argsort(levels[-1][:n])
    shared = common_prefixes(levels, order)
    least = -(-shortest * (repeats - 1) // repeats)
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    root: dict[int, int] = {}
    placed: dict[int, list[int]] = {}

    def find(i: int) -> int:
        while (up := root.setdefault(i, i)) != i:
            root[i] = i = root[up]
        return i

    found = []
    ends = zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist())
    for first, second, common in ends:
        small, large = find(first), find(second)
        few, many = placed.pop(small, [small]), placed.pop(large, [large])
        if len(few) > len(many):
            small, large, few, many = large, small, many, few
        for left, right in new_neighbours(few, many):
            apart = right - left
            if common + apart >= max(shortest, repeats * apart) and (left == 0 or words[left - 1] != words[right - 1]):
                found.append((left, common + apart, apart))
        if len(few) == 1:
            insort(many, few[0])
        else:
            many += few
            many.sort()  # two ordered stretches: merged in one pass
        root[small] = large
        placed[large] = many
    return sorted(found, key=lambda r: (r[0], r[2]))


def new_neighbours(few: list[int], many: list[int]) -> list[tuple[int, int]]:
    """Pairs of one position from each list with none between them."""
    pairs = []
    before = -1
    for k, place in enumerate(few):
        at = bisect_left(many, place)
        if at and many[at - 1] > before:
            pairs.append((many[at - 1], place))
        if at < len(many) and (k + 1 == len(few) or few[k + 1] > many[at]):
            pairs.append((place, many[at]))
        before = place
    return pairs


def may_repeat(hashes: np.ndarray, sizes: list[int], shortest: int, repeats: int) -> np.ndarray:
    """For each of the texts behind one another whether it has two windows of
    words with equal hash, as wide as a power of two up to what a run needs."""
    n = len(hashes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    mixed = hashes.astype(np.uint64)
    width, least = 1, -(-shortest * (repeats - 1) // repeats)
    while 2 * width <= least and n >= 2 * width:
        left, right = mixed[: len(mixed) - width], mixed[width:]
        mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ ((right << np.uint64(23)) | (right >> np.uint64(41)))
        width *= 2
    whole = np.flatnonzero(text[: len(mixed)] == text[width - 1 : width - 1 + len(mixed)])
    text = text[whole]
    mixed = mixed[whole] * np.uint64(0xC2B2AE3D27D4EB4F) + text.astype(np.uint64)
    by_hash = np.argsort(mixed)
    same = mixed[by_hash[1:]] == mixed[by_hash[:-1]]
    hit = np.zeros(len(sizes), bool)
    hit[text[by_hash[1:]][same]] = True
    return hit


def kept_words(n: int, found: list[Run]) -> np.ndarray:
    """Which words stay when each run keeps its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def find(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    shortest: int = SHORTEST,
    repeats: int = REPEATS,
) -> DataFrame:
    """The ``keep`` columns with ``n_words``, ``runs`` (start and length in words,
    period; by start, then period) and ``collapsed``, the words joined by single
    spaces, without those that a run holds after its first period."""

    def numbered(words: list[bytes]) -> np.ndarray:
        number: dict[bytes, int] = {}
        return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))

    def of_slice(contents: list[bytes]) -> list[pa.Array]:
        split = [x.split() for x in contents]
        sizes = [len(w) for w in split]
        hashes = np.fromiter(map(hash, chain.from_iterable(split)), np.int64, sum(sizes))
        some = may_repeat(hashes, sizes, shortest, repeats)
        found = [runs(numbered(w), shortest, repeats) if s else [] for w, s in zip(split, some)]
        left = [b" ".join(compress(w, kept_words(len(w), r)) if r else w) for w, r in zip(split, found)]
        flat = np.array(list(chain.from_iterable(found)), np.int64).reshape(-1, 3)
        parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
        offsets = pa.array([0, *accumulate(len(r) for r in found)], pa.int32())
        return [
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(offsets, parts),
            pa.array(left, pa.binary()).cast(pa.string()),
        ]

    added = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return per_text(docs, lambda: of_slice, text, keep, added)
