"""Document fingerprints: SimHash, and the search for near ones by block tables.

A document's terms are its pairs of neighbouring words (a single word where it
has one only). Each term's hash votes with the term's length on each of
``BITS`` signed bits; a bit is set where the votes for it outweigh those
against. The likeness of two fingerprints is the share of equal bits.

Only DataFrame functions. The votes are sums: 64 columns hold two counters each,
one in either half of a long, which cannot run over since a text's terms are
together less than twice as long as the text, and that below 2^31.

A null text is empty; a text without words has the fingerprint 0. Equal texts
have equal fingerprints. Repeated rows stay: each is a row of its own.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sylvatab.sources.tables import written

BITS = 128
BLANK = r"[\x20\x09-\x0D]+"
#: Fingerprints within so many bits are near. Measured on planted edits of the test
#: texts: of copies with a Jaccard similarity of 0.75 to 0.8 on five-word shingles
#: half lie within 13 bits and 95 % within 20.
RADIUS = 20
#: Least bits of a block, so that its values stay selective.
LEAST_BLOCK = 18
_LANES = 32
#: Where a row stands in the order of ids: whether it has one, the id, the hash of its text.
PLACE = ("known", "number", "mark")
#: Characters of a range of rows in that order, the most ranges, and how many rows
#: are looked at to find where they begin.
RANGE_CHARS, MOST_RANGES, SAMPLED = 32_000_000, 10_000, 20_000


def terms(text: Column) -> Column:
    """Array of (word, next word); the last word has none beside it unless it is alone."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")

    def pairs(w: Column) -> Column:
        first = F.when(F.size(w) > 1, F.slice(w, 1, F.size(w) - 1)).otherwise(w)
        return F.arrays_zip(first.alias("a"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("b"))

    # The words are bound to a name, so that they are split once.
    return F.get(F.transform(F.array(words), pairs), F.lit(0))


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, which identify a row, and its fingerprint: ``f0`` and ``f1``, 64
    bits each. No shuffle where rows are dealt out by some of the keys."""
    parts = rows.select(*keys, F.inline_outer(terms(F.col(text))))
    hashed = parts.select(
        *keys,
        F.xxhash64("a", "b").alias("h0"),
        F.xxhash64(F.lit(1), "b", "a").alias("h1"),
        (F.coalesce(F.length("a"), F.lit(0)) + F.coalesce(F.length("b"), F.lit(0))).cast("long").alias("weight"),
    )
    mask = F.lit((1 << 32) + 1)
    sums = [
        F.sum(F.shiftright(f"h{h}", i).bitwiseAND(mask) * F.col("weight")).alias(f"s{h}_{i}")
        for h in range(2)
        for i in range(_LANES)
    ]
    voted = hashed.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)

    def bit(votes: Column, place: int) -> Column:
        return F.when(2 * votes > F.col("total"), F.lit(_signed(1 << place))).otherwise(F.lit(0)).cast("long")

    def bits(h: int) -> Column:
        low = [bit(F.col(f"s{h}_{i}").bitwiseAND(F.lit(0xFFFFFFFF)), i) for i in range(_LANES)]
        high = [bit(F.shiftrightunsigned(f"s{h}_{i}", _LANES), i + _LANES) for i in range(_LANES)]
        return reduce(lambda x, y: x.bitwiseOR(y), low + high)

    return voted.select(*keys, bits(0).alias("f0"), bits(1).alias("f1"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def likeness(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return 1 - distance(a0, a1, b0, b1) / F.lit(BITS)


def shown(f0: Column, f1: Column) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in (f0, f1)]))


def near(queries: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of distinct fingerprints of ``queries`` and ``table`` (columns
    ``f0``, ``f1``) that differ in ``radius`` bits at most: ``q0``, ``q1``,
    ``f0``, ``f1``, ``distance``.

    The bits are cut into blocks and each may have some ``errors``, so many that
    the blocks are long enough; two fingerprints within the radius have a block
    with no more than these (pigeonhole). There is one table for each block, with
    the block as its key; a query looks up its own block and all that differ from
    it in ``errors`` bits at most. The pairs that share a key are compared whole. A
    pair comes out of the first table that it shares a key in only.
    """
    errors = next((e for e in range(radius) if BITS // (radius // (e + 1) + 1) >= LEAST_BLOCK), radius)
    blocks = radius // (errors + 1) + 1
    bits = [range(BITS * k // blocks, BITS * (k + 1) // blocks) for k in range(blocks)]

    def halves(places) -> tuple[int, int]:
        return tuple(_signed(sum(1 << (b - 64 * h) for b in places if b // 64 == h)) for h in range(2))

    def table_of(flips: int) -> Column:
        """For each block and each choice of ``flips`` or fewer bits of it: table, block, bits."""
        rows = [(k, *halves(bits[k]), *halves(x)) for k in range(blocks) for n in range(flips + 1) for x in combinations(bits[k], n)]
        names = ["table", "b0", "b1", "x0", "x1"]
        return F.arrays_zip(
            *[F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>").alias(name) for name, c in zip(names, zip(*rows))]
        )

    def keyed(df: DataFrame, a: str, b: str, flips: int) -> DataFrame:
        def entry(x: Column) -> Column:
            f0, f1 = (F.col(f).bitwiseXOR(x[f"x{h}"]).bitwiseAND(x[f"b{h}"]) for h, f in enumerate(("f0", "f1")))
            return F.struct(x["table"].alias("table"), F.xxhash64(x["table"], f0, f1).alias("key"))

        entries = F.inline(F.transform(table_of(flips), entry))
        return df.select("f0", "f1").distinct().select("*", entries).withColumnsRenamed({"f0": a, "f1": b})

    left, right = keyed(queries, "q0", "q1", errors), keyed(table, "f0", "f1", 0).withColumnsRenamed({"table": "t", "key": "k"})
    q, f = (F.col("q0"), F.col("q1")), (F.col("f0"), F.col("f1"))

    def shared(k: int) -> Column:
        here = [F.bit_count(x.bitwiseXOR(y).bitwiseAND(F.lit(m))) for x, y, m in zip(q, f, halves(bits[k]), strict=True)]
        return here[0] + here[1] <= errors

    earlier = reduce(lambda x, y: x | y, [(F.col("table") > k) & shared(k) for k in range(blocks)])
    # In the join's own condition, so that candidates are not rows.
    same = (F.col("table") == F.col("t")) & (F.col("key") == F.col("k"))
    # Merged: Spark takes the looked up keys for as few as the queries and would broadcast them.
    close = left.hint("merge").join(right, same & (distance(*q, *f) <= radius) & ~earlier)
    return close.select("q0", "q1", "f0", "f1", distance(*q, *f).alias("distance"))


def part_of(place: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """The number of bounds not above the place (a struct of ``PLACE``), found by halving."""
    if not bounds:
        return F.lit(0)
    columns = [F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>").alias(n) for n, c in zip(PLACE, zip(*bounds))]
    table = F.arrays_zip(*columns)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def step(low: Column, width: Column) -> Column:
        beyond = F.coalesce(F.get(table, low + width - 1) <= place, F.lit(False))
        return low + F.when(beyond, width).otherwise(F.lit(0))

    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), step)


def range_bounds(placed: DataFrame, least: int) -> list[tuple[int, int, int]]:
    """Where ranges begin that hold about equally much text: ``least`` ranges, or as
    many as have ``RANGE_CHARS`` each, up to ``MOST_RANGES``.

    Taken from about ``SAMPLED`` rows, drawn by hash; repeated rows are one with
    their texts' sum. Only the sizes of ranges depend on what is drawn.
    """
    one_in = max(1, placed.count() // SAMPLED)
    drawn = placed.filter(F.pmod(F.xxhash64(F.lit(0), *PLACE), F.lit(one_in)) == 0)
    rows = drawn.groupBy(*PLACE).agg(F.sum(F.length("text") + 1).alias("size")).collect()
    rows.sort()
    total = sum(r["size"] for r in rows)
    n = min(MOST_RANGES, max(least, total * one_in // RANGE_CHARS))
    bounds, before, wanted = [], 0, 1
    for r in rows:
        if before * n >= wanted * total and before:
            bounds.append(tuple(r[c] for c in PLACE))
            wanted = before * n // total + 1
        before += r["size"]
    return bounds


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the text that follows it in descending order of the key (an
    integer), the last one followed by the first: ``part`` and ``place`` (they
    identify a row), ``head``, ``key``, ``text`` and ``next_text``.

    Rows are dealt out once, by ranges of key and text's hash, each a task of its
    own; so a key with very many rows, or very many rows without one, lie in many
    ranges. The first row of a range (and rows equal to it) also goes to the end
    of the range before, marked ``head``, so that its last row finds it there.
    Rows without a key come last; equal keys are ordered by the hash of the text,
    then by the text. Rows equal in key and text are one range.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    place = [F.col("key").isNotNull().cast("long"), F.coalesce(F.col("key").cast("long"), F.lit(0)), F.xxhash64("text")]
    placed = given.select("*", *[c.alias(n) for n, c in zip(PLACE, place)])
    bounds = range_bounds(placed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.withColumn("part", part_of(F.struct(*PLACE), bounds))
    # One row for each range.
    heads = dealt.groupBy("part").agg(F.max(F.struct(*PLACE)).alias("first"))
    every = Window.partitionBy(F.lit(0)).orderBy(F.col("part").desc())
    before = F.coalesce(F.lag("part").over(every), F.min("part").over(Window.partitionBy(F.lit(0))))
    heads = heads.select(*[F.col(f"first.{c}").alias(c) for c in PLACE], before.alias("before"))
    both = dealt.join(F.broadcast(heads), list(PLACE), "left")
    here, there = F.struct("part", F.lit(False).alias("head")), F.struct(F.col("before").alias("part"), F.lit(True).alias("head"))
    rows = both.select(
        "key", "text", "mark", F.inline(F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there)))
    )
    own = rows.repartitionById(len(bounds) + 1, F.col("part"))
    within = Window.partitionBy("part").orderBy("head", F.col("key").desc_nulls_last(), F.col("mark").desc(), F.col("text").desc())
    return own.select(
        "part", F.row_number().over(within).alias("place"), "head", "key", "text", F.lead("text").over(within).alias("next_text")
    )


def edited(text: Column, following: Column) -> Column:
    """The last half of the text's code points, rounded down, replaced by the
    first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row the fingerprints of its text, of its edited text and of the
    next row's text: ``key``, ``n_chars``, ``edited_sha256``, ``f0``, ``f1``,
    ``e0``, ``e1``, ``n0``, ``n1``."""
    rows = in_order(docs, key, text)
    changed = rows.withColumn("changed", F.when(~F.col("head"), edited(F.col("text"), F.col("next_text"))))
    ids = ["part", "place", "head", "key", "n_chars", "edited_sha256"]
    own, other = F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("changed").alias("text"))
    versions = changed.select(
        "part",
        "place",
        "head",
        "key",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("changed", 256).alias("edited_sha256"),
        F.inline(F.when(F.col("head"), F.array(own)).otherwise(F.array(own, other))),
    )
    marked = fingerprints(versions, [*ids, "which"])

    def of(which: int, f: str, name: str) -> Column:
        return F.max(F.when(F.col("which") == which, F.col(f))).alias(name)

    wide = marked.groupBy(*ids).agg(of(0, "f0", "f0"), of(0, "f1", "f1"), of(1, "f0", "e0"), of(1, "f1", "e1"))
    within = Window.partitionBy("part").orderBy("place")
    followed = wide.withColumns({"n0": F.lead("f0").over(within), "n1": F.lead("f1").over(within)})
    return followed.filter(~F.col("head")).drop("part", "place", "head")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 100) -> DataFrame:
    """Fingerprints and likenesses of every row, and ``n_near``: for rows whose
    key is divisible by ``every`` the number of other rows within ``RADIUS``."""
    rows = written(compare(docs, key, text), "fingerprints")
    counted = rows.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("n"))
    queries = rows.filter(F.col("key") % every == 0).select("f0", "f1")
    pairs = near(queries, counted.select("f0", "f1"))
    found = pairs.join(counted, ["f0", "f1"]).groupBy("q0", "q1").agg((F.sum("n") - 1).alias("found"))
    joined = rows.join(
        found.withColumnsRenamed({"q0": "f0", "q1": "f1"}), ["f0", "f1"], "left"
    )
    f, e, n = [(F.col(f"{x}0"), F.col(f"{x}1")) for x in "fen"]
    return joined.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        shown(*f).alias("fingerprint"),
        shown(*e).alias("edited_fingerprint"),
        likeness(*f, *e).alias("near_edited"),
        likeness(*f, *n).alias("near_next"),
        F.when(F.col("key") % every == 0, F.col("found")).alias("n_near"),
    )
