"""Curation rules: what people decided about single names at single sites."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from re import _parser as parser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvatab.operators.skew import match_join

# Rule kinds. ``value`` is a pattern for PATTERN, an accepted name for the
# duplicate labels, a submitted name for the others, and a mode for CASE,
# DUPLICATES and CODES.
CASE = "case"  # "genus" or "lower_genus"
SENTINEL = "sentinel"  # text that stands for a missing name
PRE_EXCLUDE = "pre_exclude"  # never searched
OVERRIDE = "override"  # take the candidate ``target`` instead of the best match
PATTERN = "pattern"  # names that match are not trusted
NAME = "name"  # this name is not trusted
APPEND = "append"  # row added to the names without a match
DOUBLE_COUNT = "double count"
SYNONYM = "synonym"
LISTED_UNRESOLVED = "in LCVP unresvd"
DUPLICATES = "duplicates"  # label for duplicates without a rule, or "keep"
CODES = "codes"  # "rejoin": the species code is part of the key of unresolved rows

NOT_LISTED = "not in LCVP"
LABELS = (LISTED_UNRESOLVED, DOUBLE_COUNT, SYNONYM)


class Rule(NamedTuple):
    site: str
    rule: str
    value: str
    on_mismatch_only: bool = False
    target: str | None = None


# Names of POSIX character classes and what Java calls them.
POSIX_CLASSES = {
    "alnum": "Alnum",
    "alpha": "Alpha",
    "blank": "Blank",
    "cntrl": "Cntrl",
    "digit": "Digit",
    "graph": "Graph",
    "lower": "Lower",
    "print": "Print",
    "punct": "Punct",
    "space": "Space",
    "upper": "Upper",
    "xdigit": "XDigit",
}


def java_pattern(pattern: str) -> str:
    """POSIX character classes in the spelling of Java; an unknown one is an error."""

    def spelled(found: re.Match) -> str:
        if found[1] not in POSIX_CLASSES:
            raise ValueError(f"unknown character class {found[0]} in {pattern!r}")
        return f"\\p{{{POSIX_CLASSES[found[1]]}}}"

    return re.sub(r"\[:(\w*):\]", spelled, pattern)


def required_text(pattern: str) -> str:
    """The longest text that everything a pattern matches contains; empty where
    none is known. It is read off the parsed pattern: literals that follow one another
    outside of choices and of parts that may be absent. Patterns that Python and
    Java may read differently, and those with flags, have none."""
    if re.search(r"\[:|\\[^.()\[\]{}*+?|\s-]|\(\?|&&|#", pattern):
        return ""
    try:
        parsed = parser.parse(pattern)
    except re.error:
        return ""
    texts = [""]

    def read(items) -> None:
        for kind, value in items:
            if kind is parser.LITERAL:
                texts[-1] += chr(value)
            elif kind is parser.SUBPATTERN and value[1] == value[2] == 0:
                read(value[3])
            elif kind is parser.MAX_REPEAT and value[0] > 0:
                texts.append("")
                read(value[2])
                texts.append("")
            elif kind is not parser.AT:
                texts.append("")

    read(parsed)
    return max(texts, key=len)


def grams(text: Column, size: int) -> Column:
    """All stretches of ``size`` characters of a text."""
    last = F.length(text) - size + 1
    each = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(last > 0, each).otherwise(F.array().cast("array<string>"))


#: Patterns are looked up by the last so many characters of the text they require.
GRAMS = (6, 3)


@dataclass(frozen=True)
class RuleBook:
    rules: tuple[Rule, ...]

    def of(self, *kinds: str) -> list[Rule]:
        return [r for r in self.rules if r.rule in kinds]

    def modes(self, kind: str) -> dict[str, str]:
        """The mode of each site that has one; two different ones are an error."""
        found: dict[str, str] = {}
        for r in self.of(kind):
            if found.setdefault(r.site, r.value) != r.value:
                raise ValueError(f"site {r.site!r} has two {kind} rules: {found[r.site]!r} and {r.value!r}")
        return found

    def table(self, spark: SparkSession, kinds: tuple[str, ...], column: str) -> DataFrame:
        """One row per site and value with its rule kinds and override target; two
        different targets for one name are an error.

        Made from Arrow data, so the planner knows its size: it is broadcast
        while it is below the session's broadcast threshold, and joined by a
        shuffle beyond that.
        """
        found: dict[tuple[str, str], tuple[set[str], str | None]] = {}
        for r in self.of(*kinds):
            have, target = found.get((r.site, r.value), (set(), None))
            if target and r.target and target != r.target:
                raise ValueError(f"{r.value!r} at {r.site!r} has two targets: {target!r} and {r.target!r}")
            found[r.site, r.value] = (have | {r.rule}, r.target or target)
        schema = pa.schema(
            {"site": pa.string(), column: pa.string(), "kinds": pa.list_(pa.string()), "target": pa.string()}
        )
        rows = [
            {"site": site, column: value, "kinds": sorted(have), "target": target}
            for (site, value), (have, target) in found.items()
        ]
        return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))

    def attach(self, df: DataFrame, kinds: tuple[str, ...], column: str) -> DataFrame:
        """Left join the rules of these kinds on site and ``column``.

        Adds ``kinds`` (empty where there is no rule) and ``target``.
        """
        none = F.array().cast("array<string>")
        if not self.of(*kinds):
            return df.withColumns({"kinds": none, "target": F.lit(None).cast("string")})
        rules = self.table(df.sparkSession, kinds, column)
        joined = df.join(rules, ["site", column], "left")
        return joined.withColumn("kinds", F.coalesce("kinds", none))

    def patterns(self, spark: SparkSession) -> DataFrame:
        """One row for each site with patterns that require no text: ``always`` and
        ``on_mismatch``, the site's patterns of either kind joined to one, null
        where it has none."""
        joined: dict[str, dict[bool, list[str]]] = defaultdict(lambda: {False: [], True: []})
        for r in self.of(PATTERN):
            if len(required_text(r.value)) < min(GRAMS):
                joined[r.site][r.on_mismatch_only].append(f"(?:{java_pattern(r.value)})")
        rows = [
            {"site": site, "always": "|".join(of[False]) or None, "on_mismatch": "|".join(of[True]) or None}
            for site, of in joined.items()
        ]
        schema = pa.schema({"site": pa.string(), "always": pa.string(), "on_mismatch": pa.string()})
        return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))

    def pattern_index(self, spark: SparkSession) -> DataFrame:
        """One row for each pattern that requires a text: site, ``gram`` (the end of
        the text), ``required``, ``pattern`` and ``on_mismatch_only``."""
        rows = set()
        for r in self.of(PATTERN):
            text = required_text(r.value)
            size = next((n for n in GRAMS if n <= len(text)), None)
            if size:
                rows.add((r.site, text[-size:], text, java_pattern(r.value), r.on_mismatch_only))
        names = ["site", "gram", "required", "pattern", "on_mismatch_only"]
        types = [pa.string()] * 4 + [pa.bool_()]
        columns = [pa.array([r[i] for r in sorted(rows)], t) for i, t in enumerate(types)]
        return spark.createDataFrame(pa.Table.from_arrays(columns, names=names))

    def pattern_hits(self, names: DataFrame, name: str) -> DataFrame:
        """Which of the (site, name) pairs a pattern that requires a text matches:
        site, name, ``__hit`` and ``__hit_on_mismatch``. A name meets only the patterns
        that share a stretch of characters with it, and is tested where it holds
        the required text."""
        index = self.pattern_index(names.sparkSession)
        text = F.col(f"`{name}`")
        sizes = [n for n in GRAMS if n in {len(x) for x in self._sizes()}]
        every = F.array_distinct(F.concat(*[grams(text, n) for n in sizes]))
        pairs = names.select("site", text, F.explode(every).alias("gram")).join(index, ["site", "gram"])
        tested = pairs.filter(F.contains(text, F.col("required"))).filter(F.rlike(text, F.col("pattern")))
        return tested.groupBy("site", f"`{name}`").agg(
            F.bool_or(~F.col("on_mismatch_only")).alias("__hit"), F.bool_or("on_mismatch_only").alias("__hit_on_mismatch")
        )

    def _sizes(self) -> set[str]:
        """The ends by which patterns are looked up."""
        texts = [required_text(r.value) for r in self.of(PATTERN)]
        return {t[-n:] for t in texts for n in [next((n for n in GRAMS if n <= len(t)), 0)] if n}

    def with_pattern_hit(
        self, names: DataFrame, name: str, mismatch: Column, out: str, distinct: DataFrame | None = None
    ) -> DataFrame:
        """Add ``out``: does a pattern of the row's site say the name is not to be
        trusted. A rule for mismatches looks at those only.

        Patterns are tables joined by site, so the plan is as long for one rule as
        for thousands: those that require a text by an index of its end, the others
        as one alternation for each site, which every name of it is tested with.
        ``distinct`` has the site and name of all rows once, where that is at hand.
        """
        if not self.of(PATTERN):
            return names.withColumn(out, F.lit(False))
        text = F.col(f"`{name}`")
        always, mismatched, added = [], [], []
        joined = names
        if self._sizes():
            pairs = names.select("site", f"`{name}`").distinct() if distinct is None else distinct
            joined = match_join(joined, self.pattern_hits(pairs, name), ["site", name], "left")
            added += ["__hit", "__hit_on_mismatch"]
            always.append(F.col("__hit"))
            mismatched.append(F.col("__hit_on_mismatch"))
        if any(len(required_text(r.value)) < min(GRAMS) for r in self.of(PATTERN)):
            scanned = self.patterns(names.sparkSession).withColumnsRenamed({"always": "__always", "on_mismatch": "__on_mismatch"})
            joined = joined.join(scanned, "site", "left")
            added += ["__always", "__on_mismatch"]
            always.append(F.rlike(text, F.col("__always")))
            mismatched.append(F.rlike(text, F.col("__on_mismatch")))

        def either(tests: list[Column]) -> Column:
            return reduce(lambda x, y: x | y, [F.coalesce(t, F.lit(False)) for t in tests])

        hit = either(always) | (F.coalesce(mismatch, F.lit(False)) & either(mismatched))
        return joined.withColumn(out, hit).drop(*added)

    def appended(self, spark: SparkSession) -> DataFrame:
        """The rows that the rules add to the names without a match: site, Submitted_Name."""
        rows = [{"site": r.site, "Submitted_Name": r.value} for r in self.of(APPEND)]
        schema = pa.schema({"site": pa.string(), "Submitted_Name": pa.string()})
        return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))

    def with_mode(self, df: DataFrame, kind: str, default: str, out: str) -> DataFrame:
        """Add ``out``: the site's mode of this kind, or the default."""
        modes = self.modes(kind)
        if not modes:
            return df.withColumn(out, F.lit(default))
        table = pa.table({"site": list(modes), out: list(modes.values())})
        joined = df.join(df.sparkSession.createDataFrame(table), "site", "left")
        return joined.withColumn(out, F.coalesce(out, F.lit(default)))


def read_rules(table: DataFrame) -> RuleBook:
    """Rule book from a table with the columns of :class:`Rule`: decisions that
    people have made about single names, as many as they have made."""
    return RuleBook(tuple(Rule(*r) for r in table.select(*Rule._fields).collect()))
