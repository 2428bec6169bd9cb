"""Line dedup: lines that stand on many sites are boilerplate and go.

For each line (by a hash of 128 bits) a HyperLogLog sketch of its sites is
merged by aggregation. A line whose estimate is clearly above ``MIN_SITES`` is
boilerplate, clearly below it is not; the lines between, within ``NEAR`` of the
threshold, get an exact count of distinct sites. A boilerplate line stays where
it first stands, in the document with the smallest id, and goes everywhere else,
so that one copy of each passage remains.

Only DataFrame functions. Lines are aggregated and joined by hash without their
text; a line on a third of all documents is one row for each task after the
partial aggregate, and its places are split by the adaptive planner.

Lines are split at ``\\n``; blank lines are never removed. A null text stays
null. A null site counts for nothing. Rows of one id and text are treated
alike; a null id counts as the smallest. No row goes: a document may become
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvatab.llm.common import let
from sylvatab.sources.tables import written

#: A line on so many distinct sites or more is boilerplate.
MIN_SITES = 10
#: Estimates within this share of the threshold are counted exactly. With 2^12
#: registers the standard error is 1.6 %, so this is six of them.
NEAR = 0.1
REGISTERS = 12
#: Texts with so many percent of both in lines that one of them keeps are near copies.
SIMILAR = 75


def places(docs: DataFrame, text: str, key: str, site: str) -> DataFrame:
    """Each line that is not blank: ``h0``, ``h1`` (its hash), ``size`` (characters
    and the line's end), ``site``, and ``id``, ``th``, ``n``, ``pos`` (its place;
    ``th`` is the hash of the text and ``n`` the text's size)."""
    lines = docs.select(
        F.col(f"`{key}`").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("th"),
        (F.length(F.col(f"`{text}`")) + 1).alias("n"),
        F.col(f"`{site}`").cast("string").alias("site"),
        F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("pos", "line"),
    ).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.xxhash64("line").alias("h0"), F.xxhash64(F.lit(1), "line").alias("h1")
    return lines.select(*hashes, (F.length("line") + 1).alias("size"), "site", "id", "th", "n", "pos")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines on ``min_sites`` sites or more, and ``first``, the
    place that keeps the line: ``h0``, ``h1``, ``first``."""
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    spread = lines.groupBy("h0", "h1").agg(
        F.hll_sketch_agg("site", REGISTERS).alias("sites"), F.min(F.struct("id", "th", "pos", "n")).alias("first")
    )
    estimated = spread.select("h0", "h1", "first", F.hll_sketch_estimate("sites").alias("n"))
    likely = written(estimated.filter(F.col("n") >= low), "line-spread")
    clear = likely.filter(F.col("n") > high).select("h0", "h1", "first")
    near = likely.filter(F.col("n") <= high).select("h0", "h1", "first")
    counted = (
        lines.select("h0", "h1", "site")
        .join(near.select("h0", "h1"), ["h0", "h1"], "left_semi")
        .groupBy("h0", "h1")
        .agg(F.count_distinct("site").alias("n"))
    )
    exact = near.join(counted.filter(F.col("n") >= min_sites), ["h0", "h1"]).select("h0", "h1", "first")
    return clear.unionByName(exact)


def removals(docs: DataFrame, text: str, key: str, site: str, min_sites: int = MIN_SITES) -> DataFrame:
    """For each document with such lines their places, and whether it is a near copy
    of one in which they stay: ``id``, ``th``, ``gone``, ``copy``.

    Texts that have ``SIMILAR`` percent or more of both in lines that one of them
    keeps are near copies; a line counts once, however often a text repeats it.
    A text from which others are copies by this measure is never one itself, since
    its lines cannot stay in it and in a third text.
    """
    lines = places(docs, text, key, site)
    bad = written(boilerplate(lines, min_sites), "boilerplate")
    here = F.struct("id", "th", "pos", "n")
    hits = lines.drop("site").join(bad, ["h0", "h1"]).filter(~here.eqNullSafe(F.col("first")))
    # Dealt out by text once: all that follows is grouped by it and more.
    hits = hits.select("*", F.struct("first.id", "first.th", "first.n").alias("other")).repartition("id", "th")
    each = hits.groupBy("id", "th", "n", "other", "h0", "h1").agg(F.max("size").alias("size"), F.collect_set("pos").alias("pos"))
    shared = each.groupBy("id", "th", "n", "other").agg(F.sum("size").alias("shared"), F.flatten(F.collect_list("pos")).alias("pos"))
    itself = F.struct("id", "th", "n").eqNullSafe(F.col("other"))
    union = F.col("n") + F.col("other.n") - F.col("shared")
    near = ~itself & (100 * F.col("shared") >= SIMILAR * union)
    return shared.groupBy("id", "th").agg(F.flatten(F.collect_list("pos")).alias("gone"), F.bool_or(near).alias("copy"))


def without(text: Column, gone: Column) -> Column:
    """The text without the lines at these places, in time linear in both."""

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n"), left))


def dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    site: str = "source",
    min_sites: int = MIN_SITES,
    copies: bool = False,
) -> DataFrame:
    """All rows and columns, the text without repeated boilerplate lines, and
    ``__gone``, the number of lines removed. With ``copies`` also ``__copy``,
    whether the text is a near copy of one in which these lines stay."""
    marked = docs.withColumns({"__id": F.col(f"`{key}`"), "__th": F.xxhash64(F.col(f"`{text}`"))})
    gone = removals(docs, text, key, site, min_sites).withColumnsRenamed({"id": "__rid", "th": "__rth", "gone": "__gone", "copy": "__copy"})
    same = marked["__id"].eqNullSafe(gone["__rid"]) & (marked["__th"] == gone["__rth"])
    joined = marked.join(gone, same, "left")
    return joined.withColumns(
        {
            text: without(F.col(f"`{text}`"), F.col("__gone")),
            "__gone": F.coalesce(F.size("__gone"), F.lit(0)),
            "__copy": F.coalesce("__copy", F.lit(False)),
        }
    ).select(*[F.col(f"`{c}`") for c in docs.columns], "__gone", *(["__copy"] if copies else []))


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", site: str = "source") -> DataFrame:
    """For every row its key, ``n_lines``, ``n_removed`` and the SHA-256 of what
    is left (null for a null text)."""
    n_lines = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(F.split(F.col(f"`{text}`"), "\n")))
    given = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{site}`").alias("site"), n_lines.alias("n_lines")
    )
    left = dedup(given, "text", "key", "site")
    return left.select(
        F.col("key").alias(key),
        F.col("n_lines").cast("long"),
        F.col("__gone").cast("long").alias("n_removed"),
        F.sha2("text", 256).alias("left_sha256"),
    )


#: The same by exact counts, for the check.
SQL = f"""
WITH lines AS (
    SELECT doc_id, source, pos, line FROM (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), bad AS (
    SELECT line, min((doc_id, pos)) AS first FROM lines
    GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), gone AS (
    SELECT doc_id, pos FROM lines JOIN bad USING (line) WHERE (doc_id, pos) <> first
), every AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents
), rest AS (
    SELECT doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY e.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
    FROM every e LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(kept) END AS left_sha256
FROM documents d LEFT JOIN rest r USING (doc_id)
"""
