"""Near-duplicates: b-bit MinHash signatures, a multi-index Hamming join, exact
confirmation, and components.

A document's set is its distinct shingles of five words. Documents with equal
sets form a class; the rest works on one row for each class. A signature has
``CHUNKS`` chunks of ``LENGTH`` values of ``VALUE_BITS`` bits. Two signatures
that differ in fewer than ``CHUNKS * (ERRORS + 1)`` values have a chunk with
``ERRORS`` errors at most (pigeonhole), so each chunk is entered under every
choice of its values that may be wrong: the key is what remains. All pairs under
that distance share a key, and so do nearly all beyond it: of two sets with
similarity 0.75, one pair in a million does not. A pair found is dropped without
confirmation only from ``FAR`` differing values on, which similar sets reach
once in 10^8.

No pairs within a group are listed. First each key's classes are compared with
the smallest one only; what is confirmed is linked and components are formed. A
group of near copies is then one component. Then, for keys whose classes still
lie in several components, the classes outside the key's largest one are
compared with those of other components: at most twice as many pairs as there
are open ones, and none between classes that are linked already. Of these only
pairs are listed whose sets can have enough in common: shingles that stand in
one of the sets only are left out, the others counted in ``BINS`` bins, and two
sets share in each bin at most the smaller of their numbers.

Links are confirmed on full sets (of 64-bit shingle hashes): 100 * common >= 75
* union. Words are runs without [\\x20\\x09-\\x0D], after A-Z has been lower-cased;
a text of fewer than five words has them all as its one shingle. A null or blank
text has an empty set and is linked with nothing, and so is a set that only rows
without an id have. Rows of one id are one document, whatever their texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import per_text
from sylvatab.llm.components import components
from sylvatab.sources.tables import written

SHINGLE = 5
#: Linked from this similarity on, in percent.
SIMILAR = 75
CHUNKS, LENGTH, ERRORS, VALUE_BITS = 10, 4, 1, 16
VALUES = CHUNKS * LENGTH
#: Signatures that differ in so many values are not confirmed.
FAR = 27
#: Bins in which the shingles of sets are counted before pairs of them are listed.
BINS = 64
#: Up to so many ids (8 bytes each) are broadcast to find their documents.
BROADCAST_NODES = 500_000
#: Word hashes a worker remembers; beyond it, it forgets all and goes on.
REMEMBERED = 400_000

_RANDOM = np.random.default_rng(20_240_601)
_MULTIPLY = _RANDOM.integers(1, 1 << 63, VALUES + SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 63, VALUES, np.uint64)


class WordHashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    joined = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        joined += mixed(h[k : k + n] * _MULTIPLY[VALUES + k])
    return np.unique(mixed(joined))


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions, cut to ``VALUE_BITS``."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for start in range(0, len(found), 4096):  # in blocks, so that a very long text needs little memory
        part = found[start : start + 4096, None] * _MULTIPLY[None, :VALUES] + _ADD[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return mixed(least).astype(np.uint16)


def keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature the keys of all chunks and choices: the number of the
    choice above the three values that remain."""
    values = signatures.reshape(-1, CHUNKS, LENGTH).astype(np.int64)
    out = np.empty((len(values), CHUNKS, LENGTH), np.int64)
    for chunk in range(CHUNKS):
        for wrong in range(LENGTH):
            a, b, c = (values[:, chunk, i] for i in range(LENGTH) if i != wrong)
            out[:, chunk, wrong] = (chunk * LENGTH + wrong) << 48 | a << 32 | b << 16 | c
    return out.reshape(len(values), CHUNKS * LENGTH)


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row ``id``, ``n_shingles``, ``class`` (16 bytes, equal for equal
    sets; null for the empty set) and ``signature`` (two bytes a value)."""

    def make():
        hashes = WordHashes()

        def run(contents: list[bytes]) -> list[pa.Array]:
            sizes, classes, signatures = [], [], []
            for content in contents:
                found = shingles(content, hashes)
                sizes.append(len(found))
                some = len(found) > 0
                classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if some else None)
                signatures.append(signature(found).tobytes() if some else None)
            if len(hashes) > REMEMBERED:
                hashes.clear()
            return [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(signatures, pa.binary())]

        return run

    given = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return per_text(given, make, "text", ["id"], "n_shingles bigint, class binary, signature binary")


def keyed(classes: DataFrame) -> DataFrame:
    """A row for each key of each class: ``key``, ``node``."""

    def run(batches):
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, VALUES)
            found = keys(rows).reshape(-1)
            ends = np.arange(0, len(found) + 1, CHUNKS * LENGTH, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "keys"])

    lists = classes.select("node", "signature").mapInArrow(run, "node bigint, keys array<bigint>")
    return lists.select(F.explode("keys").alias("key"), "node")


def not_far(pairs: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures ``s_a``, ``s_b`` differ in fewer than ``FAR`` values."""

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, VALUES) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x != y).sum(axis=1) < FAR))

    return pairs.select("a", "b", "s_a", "s_b").mapInArrow(run, "a bigint, b bigint")


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of nodes ``a``, ``b`` whose sizes and signatures allow a link."""

    def of(name: str) -> DataFrame:
        return classes.select(
            F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}")
        )

    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    sized = sized.filter(100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
    return not_far(sized).distinct()


def sets_of(nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``node`` and ``shingles`` of the documents with these ids. The ids are
    broadcast while they are few; beyond that Spark chooses the join."""
    wanted = written(nodes.select("node").distinct(), "nodes")
    given = docs.select(F.col(f"`{key}`").alias("node"), F.col(f"`{text}`").alias("text"))
    few = wanted.count() <= BROADCAST_NODES
    return written(_sets(given.join(F.broadcast(wanted) if few else wanted, "node", "left_semi")), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of nodes ``a``, ``b`` whose sets are similar enough."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("in_a")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("in_b")), "b")
    common = both.select(
        "a",
        "b",
        (F.size("in_a") + F.size("in_b")).alias("n_both"),
        F.size(F.array_intersect("in_a", "in_b")).alias("n"),
    )
    return common.filter(100 * F.col("n") >= SIMILAR * (F.col("n_both") - F.col("n"))).select("a", "b")


def shared_bins(sets: DataFrame) -> DataFrame:
    """For each node whose set can be similar to another's: ``n``, its size, and
    ``h0`` ..., how many of its shingles that stand in another set, too, fall in
    each of ``BINS`` bins.

    What two sets have in common is in each bin at most the smaller of their
    numbers. A set of which fewer than ``SIMILAR`` percent stand elsewhere is
    similar to none.
    """
    rows = sets.select("node", F.explode("shingles").alias("shingle"))
    common = rows.groupBy("shingle").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    common = common.filter("least < most").select("shingle")
    place = F.pmod(F.shiftright("shingle", 20), F.lit(BINS))
    bins = [F.count_if(place == i).alias(f"h{i}") for i in range(BINS)]
    counted = rows.join(common, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("u"), *bins)
    sizes = sets.groupBy("node").agg(F.max(F.size("shingles")).alias("n"))
    return counted.join(sizes, "node").filter(100 * F.col("u") >= SIMILAR * F.col("n")).drop("u")


def _sets(found: DataFrame) -> DataFrame:
    """``node`` and its ``shingles``."""

    def make():
        hashes = WordHashes()

        def run(contents: list[bytes]) -> list[pa.Array]:
            sets = [shingles(x, hashes) for x in contents]
            if len(hashes) > REMEMBERED:
                hashes.clear()
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))
            return [pa.ListArray.from_arrays(pa.array(ends), values)]

        return run

    return per_text(found, make, "text", ["node"], "shingles array<bigint>")


def links(classes: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links ``a``, ``b`` between nodes, enough to connect every component."""
    all_keys = keyed(classes)
    shared = all_keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    # Written, so that the join that follows can be split at a hot key.
    shared = written(shared.filter("least < most").select("key", "least"), "keys")
    placed = written(all_keys.join(shared, "key"), "shared-keys")
    stars = placed.filter("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    near = written(likely(stars, classes), "pairs")
    ends = near.select(F.col("a").alias("node")).union(near.select("b"))
    first = written(confirmed(near, sets_of(ends, docs, key, text)), "links")

    found = components(first)
    component = F.coalesce("component", "node").alias("component")
    members = written(placed.select("key", "node").join(found, "node", "left").select("key", "node", component), "members")
    sets = sets_of(_open(members), docs, key, text)
    bins = written(shared_bins(sets), "bins")
    live = written(_open(members.join(bins.select("node"), "node", "left_semi")), "open-nodes")

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.join(bins, "node")
        return rows.withColumnsRenamed({c: f"{c}_{name}" for c in rows.columns if c not in ("key", "largest")})

    outside = side(live.filter("component <> largest").drop("largest"), "a")
    inside = side(live, "b")
    together = sum((F.least(f"h{i}_a", f"h{i}_b") for i in range(BINS)), F.lit(0))
    n_both = F.col("n_a") + F.col("n_b")
    crossing = outside.join(
        inside,
        (outside["key"] == inside["key"])
        & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("largest")) | (F.col("node_a") < F.col("node_b")))
        & (100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
        & ((100 + SIMILAR) * together >= SIMILAR * n_both),
    )
    pairs = crossing.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))
    untested = likely(pairs.distinct().join(stars, ["a", "b"], "left_anti"), classes)
    return first.unionByName(confirmed(untested, sets))


def _open(members: DataFrame) -> DataFrame:
    """The rows of ``key``, ``node``, ``component`` whose key has several
    components, with the key's ``largest`` one."""
    counts = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("parts")
    )
    # Written, so that the join that follows can be split at a hot key.
    return members.join(written(largest.filter("parts > 1").select("key", "largest"), "open-keys"), "key")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row ``id``, ``n_shingles``, ``component_id`` (smallest id that can
    be reached) and ``kept``."""
    rows = written(signed(docs, key, text), "signatures")
    # A class is known by its smallest id: the node of the graph.
    classes = (
        rows.filter("id is not null and class is not null")
        .groupBy("class")
        .agg(F.min("id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    classes = written(classes, "classes")
    found = components(links(classes, docs, key, text))
    component = F.coalesce("component", "node").alias("component_id")
    ids = written(classes.select("class", "node").join(found, "node", "left").select("class", component), "component-ids")
    joined = rows.select("id", "n_shingles", "class").join(ids, "class", "left")
    of = F.coalesce("component_id", "id")
    return joined.select("id", "n_shingles", of.alias("component_id"), of.eqNullSafe(F.col("id")).alias("kept"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return near_duplicates(docs, key, text).withColumnRenamed("id", key)


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all columns: that with the smallest id."""
    gone = near_duplicates(docs, key, text).filter("not kept").select(F.col("id").alias("__gone")).distinct()
    return docs.join(gone, docs[key].eqNullSafe(gone["__gone"]), "left_anti")
