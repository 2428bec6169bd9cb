"""Name resolution against a checklist: exact first, then the nearest entry
within a bounded number of edits.

A name is compared with every entry of its genus if these are at most ``BLOCK``: its
search keys would take longer. Comparing them all is quadratic in the size of a genus,
so in larger ones candidate pairs come from an equi-join on search keys
(:mod:`sylvatab.operators.pieces`) that every pair within the limit shares and few
others do; ``levenshtein`` with the row's limit decides. No pair is missed, and
nothing is cut off.

The best match is searched by rising distance: exact names leave first, then those
found within ``NEAR`` edits, so that the wide and costly keys are made only for names
that have nothing nearer.

Names of two words whose genus may differ are searched within ``NEAR`` edits by their words,
which are far fewer than the names (:func:`_pairs_by_words`).

A checklist that several searches use is indexed once (:func:`index_checklist`):
its keys stand bucketed by hash in the shared folder, names are shuffled to them,
and the index is not shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvatab.functions.text import squish
from sylvatab.operators.pieces import (
    DELETES_UP_TO,
    edit_limit,
    entry_keys,
    genus_of,
    kinds_of,
    letters,
    name_keys,
    name_places,
    neighbours,
    search_form,
    word_forms,
    word_splits,
)
from sylvatab.operators.skew import match_join, quoted
from sylvatab.sources.tables import bucketed, written

# Columns of a checklist as it is read, and their names in a search result.
CHECKLIST_NAMES = {"Input.Taxon": "First_matched_Name", "Output.Taxon": "LCVP_Accepted_Taxon"}
MATCH_COLUMNS = [
    "First_matched_Name",
    "Status",
    "PL.comparison",
    "PL.alternative",
    "LCVP_Accepted_Taxon",
    "Family",
    "Order",
]

# Genus and epithet, with an optional hybrid sign, and the infraspecific
# epithet where a rank word follows directly.
BINOMIAL = r"^\S+ (?:[x×] )?\S+(?: (?:subsp|ssp|var|subvar|f|forma)\. [a-z]\S*)?"

#: Entries of a genus up to which its names are compared with all of them. The keys of one
#: name take as long as that many comparisons of letters.
BLOCK = 16_384

#: Pairs up to which names of any genus are compared with all entries.
FEW = 1 << 26

#: ``BLOCK`` for names of two words with one in common.
WORD_BLOCK = 2_048

#: Pairs that one group of equal keys may have; above it names and entries are
#: dealt out over tiles of at most about half as many.
TILE = 2_000_000


def match_key(name: Column) -> Column:
    """Single spaces, first word capitalised; empty for a null name.

    Never null, so that a join on it puts no null test, and with it a second
    evaluation of the key, into the scan of the names.
    """
    return _capitalised(squish(name))


def _capitalised(clean: Column) -> Column:
    genus = F.substring_index(clean, " ", 1)
    key = F.concat(F.initcap(genus), F.substr(clean, F.length(genus) + 1))
    return F.coalesce(key, F.lit(""))


def entry_key(full_name: Column) -> Column:
    """The part of a checklist name without authors, as a match key."""
    clean = squish(full_name)
    binomial = F.regexp_extract(clean, BINOMIAL, 0)
    return _capitalised(F.when(binomial != "", binomial).otherwise(clean))


def distinct_names(names: DataFrame, name: str) -> DataFrame:
    """Distinct non-null names with their match key.

    The null test is made on a count, after the aggregate: a plain filter would
    be pushed below it and evaluate the name once more for every input row.
    """
    counted = names.groupBy(F.col(f"`{name}`").alias(name)).agg(F.count(f"`{name}`").alias("n"))
    return counted.filter("n > 0").select(name, match_key(F.col(name)).alias("key"))


def prepare_checklist(checklist: DataFrame) -> DataFrame:
    """Checklist with result column names, a match key and the tie-break rank."""
    named = checklist.withColumnsRenamed(CHECKLIST_NAMES).select(*quoted(MATCH_COLUMNS))
    rank = F.when(F.col("Status") == "accepted", 0).otherwise(1)
    return named.withColumn("key", entry_key(F.col("First_matched_Name"))).withColumn("rank", rank)


#: Edits up to which keys are whole strings with characters left out.
NEAR = 2


class Index(NamedTuple):
    """A checklist ready for search."""

    #: One row for each checklist row: the result columns, ``key`` and ``rank``.
    entries: DataFrame
    #: ``key``, ``letters``, ``kind`` and ``h`` of the distinct keys; None: made anew for each search.
    keys: DataFrame | None
    distances: tuple[float, ...]
    match_genus: bool
    #: The distinct keys of ``entries`` in search form, where they serve several steps of a search.
    form: DataFrame | None = None


def index_checklist(checklist: DataFrame, *distances: float, match_genus: bool = True) -> Index:
    """The search keys of a checklist for searches up to these distances, written
    once, bucketed by their hash. The exact search needs no distance."""
    entries = bucketed(prepare_checklist(checklist), "entries", "key")
    near = [d for d in distances if d > 0]
    keys = _entry_keys(_search_entries(entries, match_genus), near, match_genus, None) if near else None
    if keys is not None:
        keys = bucketed(keys, "search-keys", "h", by=["kind"])
    return Index(entries, keys, tuple(near), match_genus)


def _searched(df: DataFrame, match_genus: bool) -> DataFrame:
    """Search form with the length ``n`` of the body, and where a genus is compared by itself
    its ``letters`` and ``neighbours``."""
    form = search_form(df, match_genus).withColumn("n", F.length("body"))
    return form.withColumn("letters", letters("body")).withColumn("neighbours", neighbours("body")) if match_genus else form


def _lettered(form: DataFrame) -> DataFrame:
    return form if "letters" in form.columns else form.withColumn("letters", letters("body"))


def _search_entries(entries: DataFrame, match_genus: bool) -> DataFrame:
    return written(_searched(entries.select("key").distinct(), match_genus), "search-entries")


def _entry_keys(form: DataFrame, distances: list[float], match_genus: bool, edits: range | None) -> DataFrame:
    # A few bytes of an entry become a hundred keys, as with names.
    keys = entry_keys(_lettered(form.repartition(_parts(form))), distances, match_genus, edits)
    return keys.select("key", "letters", "kind", "h")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _indexed(checklist: DataFrame | Index, max_distance: float, match_genus: bool) -> Index:
    if not isinstance(checklist, Index):
        entries = prepare_checklist(checklist)
        if max_distance == 0:
            return Index(entries, None, (max_distance,), match_genus)
        entries = written(entries, "entries")
        return Index(entries, None, (max_distance,), match_genus, _search_entries(entries, match_genus))
    if max_distance > 0 and (max_distance not in checklist.distances or match_genus != checklist.match_genus):
        raise ValueError("the index was made for other searches")
    return checklist


def resolve_names(
    names: DataFrame,
    checklist: DataFrame | Index,
    max_distance: float = 0.1,
    match_genus: bool = True,
    name: str = "Submitted_Name",
) -> DataFrame:
    """Best checklist entry for each distinct non-null name, plus ``distance``.

    Ties go to the smaller distance, then to an accepted entry, then to the
    first checklist name in order. A name without an entry within the limit
    gives no row.
    """
    index = _indexed(checklist, max_distance, match_genus)
    wanted = distinct_names(names, name)
    per_key = index.entries.groupBy("key").agg(F.min(F.struct("rank", *quoted(MATCH_COLUMNS))).alias("entry"))
    if max_distance == 0:
        best = wanted.join(per_key, "key").select(name, "entry", F.lit(0).alias("distance"))
    else:
        placed = written(wanted.join(per_key, "key", "left"), "names")
        best = placed.filter("entry IS NOT NULL").select(name, "entry", F.lit(0).alias("distance"))
        missing = placed.filter("entry IS NULL")
        for near in _by_rising_distance(missing.select("key").distinct(), index, per_key, max_distance):
            best = best.unionByName(missing.drop("entry").join(near, "key").select(name, "entry", "distance"))
    fields = [F.col("entry").getField(c).alias(c) for c in MATCH_COLUMNS]
    return best.select(name, *fields, "distance")


def _by_rising_distance(names: DataFrame, index: Index, per_key: DataFrame, max_distance: float) -> list[DataFrame]:
    """``key``, ``entry`` and ``distance`` of the nearest entry within the limit, a
    table for each width of the search."""
    names = names.withColumn("limit", edit_limit(F.col("key"), max_distance)).filter("limit > 0")
    longest = names.agg(F.max("limit")).first()[0] or 0

    def nearest(left: DataFrame, edits: range) -> DataFrame:
        now = left.select("key", F.least("limit", F.lit(edits[-1])).alias("edits"))
        pairs = close_pairs(now, index, edits)
        # Only the nearest distance's entries are looked up.
        least = F.min("distance").over(Window.partitionBy("key"))
        pairs = pairs.withColumn("least", least).filter("distance = least").drop("least")
        entries = pairs.join(per_key.withColumnRenamed("key", "entry_key"), "entry_key")
        best = entries.groupBy("key").agg(F.min(F.struct("distance", "entry")).alias("near"))
        return best.select("key", "near.entry", "near.distance")

    if longest == 0:
        return []
    near = nearest(names, range(1, min(longest, NEAR) + 1))
    if longest <= NEAR:
        return [near]
    near = written(near, "near")
    left = names.filter(F.col("limit") > NEAR).join(near.select("key"), "key", "left_anti")
    return [near, nearest(left, range(NEAR + 1, longest + 1))]


def fuzzy_candidates(
    names: DataFrame,
    checklist: DataFrame | Index,
    max_distance: float = 0.1,
    match_genus: bool = True,
    name: str = "Submitted_Name",
) -> DataFrame:
    """Every checklist entry within the limit of each distinct non-null name."""
    index = _indexed(checklist, max_distance, match_genus)
    wanted = distinct_names(names, name)
    entries = index.entries.drop("rank")
    if max_distance == 0:
        found = wanted.join(entries, "key").withColumn("distance", F.lit(0))
        return found.select(F.col(name), *quoted(MATCH_COLUMNS), "distance")
    wanted = written(wanted, "names")
    keys = wanted.select("key").distinct().withColumn("edits", edit_limit(F.col("key"), max_distance))
    longest = keys.agg(F.max("edits")).first()[0] or 0
    exact = keys.select("key").join(entries.select("key").distinct(), "key", "left_semi")
    pairs = exact.select("key", F.col("key").alias("entry_key"), F.lit(0).alias("distance"))
    if longest:
        near = close_pairs(keys.filter("edits > 0"), index, range(1, longest + 1))
        pairs = pairs.unionByName(near.filter("distance > 0"))
    found = pairs.join(wanted, "key").drop("key").withColumnRenamed("entry_key", "key")
    return found.join(entries, "key").select(F.col(name), *quoted(MATCH_COLUMNS), "distance")


def keep_resolved(resolved: DataFrame, kept: DataFrame, name: str = "Submitted_Name") -> DataFrame:
    """Results for the names kept after curation. The search is deterministic,
    so the first result is reused instead of searching again."""
    return match_join(resolved, kept.select(F.col(f"`{name}`").alias(name)).distinct(), [name], "left_semi")


def close_pairs(names: DataFrame, index: Index, edits: range) -> DataFrame:
    """All (key, entry_key) pairs within the names' edits, each once, with ``distance``.

    ``names`` has distinct ``key`` and ``edits``, which lie in the range ``edits`` and are the
    name's limit, or ``NEAR`` where that is more.
    """
    kinds = sorted({kind for k in edits for kind in kinds_of(k)})
    form = written(_searched(names.select("key", "edits"), index.match_genus), "search-names")
    places = name_places(form, kinds)
    places = places if places is None else written(places, "places")

    def by_keys(form: DataFrame, keys: DataFrame) -> DataFrame:
        return _pairs_by_keys(form, keys, kinds, places, index.match_genus)

    if index.keys is not None:
        near = by_keys(form, index.keys.filter(F.col("kind").isin(kinds)))
    else:
        entries = index.form if index.form is not None else _search_entries(index.entries, index.match_genus)

        def made(entries: DataFrame, edits: range = edits) -> DataFrame:
            return _entry_keys(entries, list(index.distances), index.match_genus, edits)

        near = (_by_size_of_genus if index.match_genus else _of_any_genus)(form, entries, by_keys, made)
    equal = form.select("key").join(index.entries.select("key").distinct(), "key", "left_semi")
    return near.unionByName(equal.select("key", F.col("key").alias("entry_key"), F.lit(0).alias("distance")))


def _by_size_of_genus(
    names: DataFrame,
    entries: DataFrame,
    by_keys: Callable[[DataFrame, DataFrame], DataFrame],
    made: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Pairs of a genus with up to ``BLOCK`` entries compared directly, those of the others
    by the keys ``made`` of entries."""
    sizes = entries.groupBy("genus").agg(F.count(F.lit(1)).alias("entries"))
    large = sizes.filter(F.col("entries") > BLOCK).select("genus")
    if large.isEmpty():
        return _pairs_by_genus(names, entries)
    large = written(large, "large-genera")
    many = [df.join(large, "genus", "left_semi") for df in (names, entries)]
    few = [df.join(large, "genus", "left_anti") for df in (names, entries)]
    return by_keys(many[0], made(many[1])).unionByName(_pairs_by_genus(*few))


def _of_any_genus(
    names: DataFrame,
    entries: DataFrame,
    by_keys: Callable[[DataFrame, DataFrame], DataFrame],
    made: Callable[..., DataFrame],
) -> DataFrame:
    """Pairs of two words each within two edits by their words, all others by the keys ``made``
    of entries. Few pairs are compared directly."""
    if names.count() * entries.count() <= FEW:
        return _pairs_by_genus(*(_lettered(df).withColumn("neighbours", neighbours("body")) for df in (names, entries)))
    two = F.col("key").rlike("^[^ ]+ [^ ]+$")
    plain = two & (F.col("edits") <= NEAR) & (F.col("n") <= DELETES_UP_TO)
    # Longer entries are too far from these names.
    reached = F.col("n") <= DELETES_UP_TO + NEAR
    near = _pairs_by_words(names.filter(plain).select("key", "edits"), entries.filter(two & reached).select("key"))
    others, rest = entries.filter(~two & reached), names.filter(~plain)
    if not others.isEmpty():
        near = near.unionByName(by_keys(names.filter(plain), made(others, range(1, NEAR + 1))))
    # Only entries that these names can reach make keys.
    k, n = F.col("edits"), F.col("n")
    few, many, shortest, longest = rest.agg(F.min(k), F.max(k), F.min(n - k), F.max(n + k)).first()
    if few is not None:
        reached = entries.filter(n.between(shortest, longest))
        near = near.unionByName(by_keys(rest, made(reached, range(few, many + 1))))
    return near


def _pairs_by_words(names: DataFrame, entries: DataFrame) -> DataFrame:
    """Near pairs of different names and entries of two words each, within one or two edits, each
    once.

    If the spaces stand for each other, the edits are those of the first words and those of
    the last words: one at most in each, or two in one while the other is the same.
    If not, they are the two edits there are (:func:`_with_moved_space`).
    """
    first, last = F.substring_index("key", " ", 1).alias("first"), F.substring_index("key", " ", -1).alias("last")
    names, entries = names.select("key", "edits", first, last), entries.select("key", first, last)
    words = {}
    for side, df in (("names", names), ("entries", entries)):
        for word in ("first", "last"):
            found = df.select(F.col(word).alias("word")).distinct()
            found = found.select("word", letters("word").alias("letters"), neighbours("word").alias("neighbours"))
            words[side, word] = written(found, "words")
    found = _one_edit_in_a_word(names, entries, words)
    far = names.filter(F.col("edits") == NEAR)
    for same, word in (("last", "first"), ("first", "last")):
        found = found.unionByName(_with_a_word_in_common(far, entries, words, same, word))
    here = _with_moved_space(far, entries, words["names", "last"], words["entries", "first"], words["names", "first"], words["entries", "last"])
    there = _with_moved_space(
        entries.withColumn("edits", F.lit(NEAR)), far, words["entries", "last"], words["names", "first"], words["entries", "first"], words["names", "last"]
    )
    swapped = there.select(F.col("entry_key").alias("key"), F.col("key").alias("entry_key"), "distance")
    return found.unionByName(here).unionByName(swapped)


def _one_edit_in_a_word(names: DataFrame, entries: DataFrame, words: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Pairs with one edit in one of the words or in both. Names are taken with each first
    word that is one edit away, entries with each last word: where these are equal
    is nothing but such pairs."""

    def apart(word: str) -> DataFrame:
        forms = [word_forms(words[side, word].select("word"), "word", 1) for side in ("names", "entries")]
        left, right = (df.select(F.col("word").alias(key), F.xxhash64("form").alias("h")) for df, key in zip(forms, ("key", "entry_key"), strict=True))
        pairs = _measured(left, right, F.col("key") != F.col("entry_key"), F.expr("levenshtein(key, entry_key, 1)")).distinct()
        return written(pairs.select(F.col("key").alias("of_name"), F.col("entry_key").alias("of_entry")), "near-words")

    firsts, lasts = apart("first"), apart("last")
    left = names.select("key", "edits", F.lit(0).alias("own"), F.xxhash64("first", "last").alias("h"))
    other = _for_each(names, "first", firsts, "of_name", "of_entry")
    left = left.unionByName(other.select("key", "edits", F.lit(1).alias("own"), F.xxhash64("of_entry", "last").alias("h")))
    right = entries.select(F.col("key").alias("entry_key"), F.lit(0).alias("other"), F.xxhash64("first", "last").alias("h"))
    other = _for_each(entries, "last", lasts, "of_entry", "of_name")
    right = right.unionByName(
        other.select(F.col("key").alias("entry_key"), F.lit(1).alias("other"), F.xxhash64("first", "of_name").alias("h"))
    )
    sum_ = F.col("own") + F.col("other")
    near = sum_.between(1, F.col("edits")) & (F.expr(f"levenshtein(key, entry_key, {NEAR})") == sum_)
    return _joined(left, right, ["h"], near).select("key", "entry_key", sum_.alias("distance"))


def _for_each(df: DataFrame, word: str, table: DataFrame, of: str, *columns: str) -> DataFrame:
    """Rows of ``df`` once for each row of ``table`` with their word. A word may have very many of
    both."""
    right = table.select(F.col(of).alias("entry_key"), *columns, F.xxhash64(of).alias("h"))
    found = tiled(df.withColumn("h", F.xxhash64(word)), right, F.col(word) == F.col("entry_key"))
    return found.drop("entry_key")


def _with_a_word_in_common(
    names: DataFrame, entries: DataFrame, words: dict[tuple[str, str], DataFrame], same: str, word: str
) -> DataFrame:
    """Pairs with two edits in one word whose other is the same: compared directly where the
    entries with that word are few, else by what the words are without up to two characters."""
    sizes = entries.groupBy(F.col(same).alias("genus")).agg(F.count(F.lit(1)).alias("entries"))
    large = sizes.filter(F.col("entries") > WORD_BLOCK).select("genus")

    def form(df: DataFrame, side: str) -> DataFrame:
        bits = words[side, word].withColumnRenamed("word", word)
        return df.join(bits, word).withColumnsRenamed({word: "body", same: "genus"}).withColumn("n", F.length("body"))

    forms = [form(names, "names"), form(entries, "entries")]
    distance = F.expr(f"IF(levenshtein(body, entry_body, {NEAR}) = {NEAR}, {NEAR}, -1)")
    if large.isEmpty():
        return _pairs_by_genus(*forms, distance)
    large = written(large, "large-words")
    found = _pairs_by_genus(*(df.join(large, "genus", "left_anti") for df in forms), distance)
    many = [df.join(large, "genus", "left_semi").repartition(_parts(df)) for df in forms]
    left, right = (word_forms(df, "body", NEAR).withColumn("h", F.xxhash64("genus", "form")) for df in many)
    left = left.select("key", "edits", "letters", "h")
    right = right.select(F.col("key").alias("entry_key"), F.col("letters").alias("entry_letters"), "h")
    at = 1 if same == "first" else -1
    equal = F.substring_index("key", " ", at) == F.substring_index("entry_key", " ", at)
    distance = F.when(equal & (F.expr(f"levenshtein(key, entry_key, {NEAR})") == NEAR), NEAR).otherwise(-1)
    near = (_apart("letters") <= 2 * F.col("edits")) & (F.col("key") != F.col("entry_key"))
    return found.unionByName(_measured(left, right, near, distance).distinct())


def _with_moved_space(
    names: DataFrame, entries: DataFrame, lasts: DataFrame, firsts: DataFrame, name_firsts: DataFrame, entry_lasts: DataFrame
) -> DataFrame:
    """Pairs with two edits at the spaces, that of the name standing first.

    A space that stands for none is taken away or put in, or becomes a character or comes from
    one; that is an edit for each space and leaves none. So the name is a word P, a
    space, characters Q, maybe one more, and a word R; the entry is P, maybe a
    character, Q, a space and R. P is the first word of a name, R the last of an entry.
    """
    ends = _for_each(names, "last", word_splits(lasts, entry_lasts, False), "word", "part", "other")
    ends = ends.withColumn("own", F.explode(F.expr("IF(length(other) > 1, array(0, 1), array(0))")))
    middle = F.expr("substring(other, 1, length(other) - own)")
    left = ends.select("key", F.col("other").alias("between"), "own", F.xxhash64("first", middle, "part").alias("h"))
    starts = _for_each(entries, "first", word_splits(firsts, name_firsts, True), "word", "part", "other")
    starts = starts.withColumn("own", F.explode(F.expr("IF(length(other) > 1, array(0, 1), array(0))")))
    middle = F.expr("substring(other, 1 + own, length(other))")
    right = starts.select(
        F.col("key").alias("entry_key"),
        F.col("other").alias("entry_between"),
        F.col("own").alias("entry_own"),
        F.xxhash64("part", middle, "last").alias("h"),
    )
    # One character moved over the space is an edit in each word. Equal characters between
    # the spaces would be found again without the last of one and the first of the other.
    near = F.length("between") + F.length("entry_between") > 2
    near = near & ~((F.col("own") == 1) & (F.col("entry_own") == 1) & (F.col("between") == F.col("entry_between")))
    near = near & (F.expr(f"levenshtein(key, entry_key, {NEAR})") == NEAR)
    return _joined(left, right, ["h"], near).select("key", "entry_key", F.lit(NEAR).alias("distance"))


def _pairs_by_genus(names: DataFrame, entries: DataFrame, distance: Column | None = None) -> DataFrame:
    """Near pairs of different names and entries (both in search form), each once: all
    of a genus are compared, by length and letters first: ``levenshtein`` takes a hundred
    times as long."""
    parts, told = _parts(names), ("key", "body", "letters", "neighbours", "n")
    left = names.select(*told, "edits", F.col("genus").alias("h"))
    right = entries.select(*[F.col(c).alias(f"entry_{c}") for c in told], F.col("genus").alias("h"))
    # Rows are few bytes for the pairs they make, so they are spread over all partitions.
    left, right = left.repartition(parts, "h"), right.repartition(parts, "h")
    # Of the edits, those that change the length change a bit less than the others.
    longer = F.abs(F.col("n") - F.col("entry_n"))
    near = (longer <= F.col("edits")) & (_apart("letters") + longer <= 2 * F.col("edits"))
    near = near & (_apart("neighbours") + longer <= 4 * F.col("edits")) & (F.col("body") != F.col("entry_body"))
    return _measured(left, right, near, F.expr("levenshtein(body, entry_body, edits)") if distance is None else distance)


def _pairs_by_keys(names: DataFrame, keys: DataFrame, kinds: list[int], places: DataFrame | None, match_genus: bool) -> DataFrame:
    """Near pairs of different names (in search form) and entries that share a key, each once."""
    # A name grows by a factor of a hundred into keys: more work than its bytes
    # tell. So names are spread over all partitions instead of being packed by size.
    # Names are written and their keys are not: these are made for each use, which takes
    # less than writing and reading them, and no room.
    left = name_keys(_lettered(names.repartition(_parts(names))), kinds, match_genus, places)
    left = left.select("key", "edits", "letters", "h")
    # The kind is part of the hash, so that the index is looked up by one column.
    right = keys.select(F.col("key").alias("entry_key"), F.col("letters").alias("entry_letters"), "h")
    # An edit changes two bits of the letters at most: pairs further apart are not
    # measured, and not listed either, since this is part of the join. Equal ones
    # share all their keys, so they are joined by the name.
    other = F.col("key") != F.col("entry_key")
    distance = F.expr("levenshtein(key, entry_key, edits)")
    if match_genus:
        # The hash tells genera apart already; a test by itself would become a second
        # key of the join, for which the index would have to be shuffled.
        distance = F.when(genus_of("key") == genus_of("entry_key"), distance).otherwise(-1)
    return _measured(left, right, (_apart("letters") <= 2 * F.col("edits")) & other, distance).distinct()


def _apart(bits: str) -> Column:
    return F.bit_count(F.col(bits).bitwiseXOR(F.col(f"entry_{bits}")))


def _measured(names: DataFrame, entries: DataFrame, near: Column, distance: Column) -> DataFrame:
    """Pairs of equal ``h`` that are ``near`` and have a ``distance``. It is tested last within
    the join: a filter after it would be pushed before the cheaper tests."""
    pairs = tiled(names, entries, near & (distance >= 0))
    return pairs.select("key", "entry_key", distance.alias("distance"))


def tiled(names: DataFrame, entries: DataFrame, near: Column, most: int = TILE) -> DataFrame:
    """Pairs of equal ``h`` that are ``near``, of which no task gets more than about
    ``most`` from one key.

    Names and entries of each key are counted, combined before the shuffle. Keys
    with more pairs are few: their names and entries are dealt out over tiles of a
    side of ``sqrt(most / 2)``, each name to a row of tiles and each entry to a column.
    """
    of_names = names.groupBy("h").agg(F.count(F.lit(1)).alias("names"))
    costs = of_names.join(entries.groupBy("h").agg(F.count(F.lit(1)).alias("entries")), "h")
    crowded = costs.filter(F.col("names") * F.col("entries") > most)
    if crowded.isEmpty():
        return _joined(names, entries, ["h"], near)
    crowded = written(crowded, "crowded-keys")
    # Few bytes make many pairs here too.
    left, right = (df.repartition(_parts(df), "h", "tile") for df in dealt(names, entries, crowded, most))
    rare = names.join(crowded.select("h"), "h", "left_anti")
    return _joined(rare, entries, ["h"], near).unionByName(_joined(left, right, ["h", "tile"], near))


def dealt(names: DataFrame, entries: DataFrame, crowded: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The names and the entries of crowded keys, each row once for every ``tile``
    it belongs to."""
    side = int((most / 2) ** 0.5)
    grid = crowded.select(
        "h",
        F.ceil(F.col("names") / side).cast("int").alias("rows"),
        F.ceil(F.col("entries") / side).cast("int").alias("columns"),
    )

    def of(df: DataFrame, key: str, own: str, other: str, tile: str) -> DataFrame:
        mine = df.join(grid, "h").withColumn("own", F.pmod(F.xxhash64(key), F.col(own)))
        across = mine.withColumn("across", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return across.withColumn("tile", F.expr(tile)).select(*df.columns, "tile")

    left = of(names, "key", "rows", "columns", "own * columns + across")
    return left, of(entries, "entry_key", "columns", "rows", "across * columns + own")


def _joined(names: DataFrame, entries: DataFrame, on: list[str], near: Column) -> DataFrame:
    other = entries.withColumnsRenamed({c: f"__e_{c}" for c in on})
    for c in on:
        near = near & (F.col(c) == F.col(f"__e_{c}"))
    return names.join(other, near).drop(*on, *[f"__e_{c}" for c in on])
