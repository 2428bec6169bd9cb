"""Submitted names: extract, resolve, curate, and sort into resolved and
unresolved with an issue label.

The single steps take and return tables and can be called one by one.
:func:`name_status` runs them for all sites in one pass. It works on one row
per site and submitted name, with the number of submitted rows: every rule and
every search result depends on those two columns alone, and a name that fills a
third of the input is a single row there.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.functions.text import mentions, normalise_name_case
from sylvatab.operators.joins import shared_columns
from sylvatab.operators.pieces import edit_limit
from sylvatab.operators.resolve import (
    MATCH_COLUMNS,
    Index,
    fuzzy_candidates,
    match_key,
    prepare_checklist,
    resolve_names,
)
from sylvatab.operators.sets import set_difference, union_by_name
from sylvatab.operators.skew import match_join, quoted, skew_join
from sylvatab.operators.summaries import mark_repeated
from sylvatab.plans import rules as k
from sylvatab.plans.rules import RuleBook
from sylvatab.sources.tables import written

TAXA_NAMES = {
    "latin": "Submitted_Name",
    "sp": "Sp_Code",
    "genus": "Submitted_Genus",
    "family": "Submitted_Family",
}
SUBMITTED = ["Submitted_Name", "Sp_Code", "Submitted_Genus", "Submitted_Family", "IDlevel"]
NAME_KEY = ["site", "Submitted_Name"]


def site_extract(measures: DataFrame, *sites: str) -> DataFrame:
    """Rows of some sites; the filter reaches the scan. All sites in one table
    are the normal case, with ``site`` as part of every key."""
    return measures.filter(F.col("site").isin(*sites))


def submitted_taxa(measures: DataFrame, rules: RuleBook | None = None) -> DataFrame:
    """Name, code, genus, family and level of each submitted row, names in the
    case their site uses."""
    taxa = measures.select("latin", "sp", "genus", "family", "IDlevel", "site")
    taxa = taxa.withColumnsRenamed(TAXA_NAMES)
    return normalise_name_case(taxa, case_rules=rules.modes(k.CASE)) if rules else taxa


def split_missing(taxa: DataFrame, sentinels: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows without a name, rows with one). A sentinel text counts as none."""
    name = F.col("Submitted_Name")
    missing = name.isNull() | F.coalesce(name.isin(*sentinels), F.lit(False))
    return taxa.filter(missing), taxa.filter(~missing)


def exclude_names(taxa: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows taken out before the search, rows to search)."""
    listed = F.coalesce(F.col("Submitted_Name").isin(names), F.lit(False))
    return taxa.filter(listed), taxa.filter(~listed)


def resolve_with_test(names: DataFrame, checklist: DataFrame | Index, max_distance: float = 0.1) -> DataFrame:
    """Best match per name, and whether the match contains the name as submitted."""
    found = resolve_names(names, checklist, max_distance).drop("distance")
    return found.withColumn("mismatch_test", mentions(F.col("First_matched_Name"), F.col("Submitted_Name")))


def review_list(matches: DataFrame, checklist: DataFrame | Index, max_distance: float = 0.1) -> DataFrame:
    """All candidates for the names whose match does not contain them."""
    return fuzzy_candidates(matches.filter(~F.col("mismatch_test")), checklist, max_distance)


def quarantine_by_pattern(
    matches: DataFrame, pattern: str, on_mismatch_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(matches not to be trusted, matches to keep)."""
    hit = F.coalesce(F.col("Submitted_Name").rlike(k.java_pattern(pattern)), F.lit(False))
    if on_mismatch_only:
        hit = hit & ~F.coalesce("mismatch_test", F.lit(False))
    return matches.filter(hit), matches.filter(~hit)


def quarantine_by_list(taxa: DataFrame, matches: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(submitted rows with a listed name, matches without the listed names)."""
    listed = F.coalesce(F.col("Submitted_Name").isin(names), F.lit(False))
    return taxa.filter(listed), matches.filter(~listed)


def override_targets(
    names: DataFrame, checklist: DataFrame, max_distance: float = 0.1
) -> DataFrame:
    """Candidates chosen by hand: of the entries the fuzzy search offers for a
    name, the one called ``target``. ``names`` has ``Submitted_Name`` and
    ``target``; the entry is looked up by its name, so no search is run."""
    entries = prepare_checklist(checklist).withColumnRenamed("key", "entry_key").drop("rank")
    wanted = names.withColumn("key", match_key(F.col("Submitted_Name")))
    wanted = wanted.withColumn("edits", edit_limit(F.col("key"), max_distance))
    pairs = wanted.join(entries, wanted["target"] == entries["First_matched_Name"])
    near = F.levenshtein("key", "entry_key") <= F.col("edits")
    same_genus = F.substring_index("key", " ", 1) == F.substring_index("entry_key", " ", 1)
    return pairs.filter(near & same_genus).drop("key", "entry_key", "edits")


def apply_override(matches: DataFrame, chosen: DataFrame, rejected: list[str]) -> DataFrame:
    """Replace the matches named in ``rejected`` by the chosen candidates."""
    refused = F.coalesce(F.col("First_matched_Name").isin(rejected), F.lit(False))
    return union_by_name(matches.filter(~refused), chosen)


def unmatched_by_name(taxa: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct submitted names without a match."""
    return set_difference(taxa.select("Submitted_Name"), matches.select("Submitted_Name"))


def unmatched_by_code(taxa: DataFrame, matches: DataFrame) -> DataFrame:
    """Submitted rows whose species code belongs to no matched name."""
    names = matches.select("Submitted_Name").distinct()
    coded = skew_join(taxa.select("Sp_Code", "Submitted_Name"), names, ["Submitted_Name"], "left_semi")
    codes = set_difference(taxa.select("Sp_Code"), coded.select("Sp_Code"))
    return skew_join(taxa, codes, ["Sp_Code"], "left_semi")


def label_duplicates(
    matches: DataFrame, double_counts: list[str], synonyms: list[str], other: str = k.SYNONYM
) -> DataFrame:
    """Add ``issue``: null where the accepted name is reached once, else a label.

    ``other`` labels duplicates on neither list; the accepted name
    ``unresolved`` is labelled as listed but unresolved.
    """
    accepted = F.col("LCVP_Accepted_Taxon")
    label = (
        F.when(~F.col("repeated"), F.lit(None))
        .when(accepted == "unresolved", k.LISTED_UNRESOLVED)
        .when(accepted.isin(double_counts), k.DOUBLE_COUNT)
        .when(accepted.isin(synonyms), k.SYNONYM)
        .otherwise(other)
    )
    return mark_repeated(matches, "LCVP_Accepted_Taxon").withColumn("issue", label).drop("repeated")


def triage_duplicates(
    matches: DataFrame, double_counts: list[str], synonyms: list[str], other: str = k.SYNONYM
) -> tuple[DataFrame, DataFrame]:
    """(matches whose accepted name is reached once, the others with ``issue``)."""
    labelled = label_duplicates(matches, double_counts, synonyms, other)
    return labelled.filter("issue is null").drop("issue"), labelled.filter("issue is not null")


def assemble_unresolved(
    taxa: DataFrame, without_match: DataFrame, missing: DataFrame, duplicates: DataFrame
) -> DataFrame:
    """Names without a match with their submitted columns, rows without a name,
    and labelled duplicates, each row once."""
    not_listed = skew_join(taxa, without_match.distinct(), shared_columns(taxa, without_match))
    not_listed = union_by_name(not_listed, missing).withColumn("issue", F.lit(k.NOT_LISTED))
    return union_by_name(not_listed, duplicates).distinct()


def name_status(
    taxa: DataFrame, checklist: DataFrame, rules: RuleBook, max_distance: float = 0.1
) -> DataFrame:
    """One row per site and submitted name: its match and what became of it.

    Columns: site, Submitted_Name, n_rows, the match columns, mismatch_test,
    outcome (resolved or unresolved) and issue (null when resolved).
    """
    names = taxa.groupBy(*NAME_KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("Submitted_Name").alias("n_named")
    )
    names = rules.attach(names, (k.SENTINEL, k.PRE_EXCLUDE, k.NAME, k.OVERRIDE), "Submitted_Name")
    names = names.withColumn(
        "searched",
        (F.col("n_named") > 0)
        & ~F.arrays_overlap("kinds", F.array(F.lit(k.SENTINEL), F.lit(k.PRE_EXCLUDE))),
    )
    # The search is the expensive part and is read twice below, so its result,
    # one row per distinct name, is written to the shared folder.
    found = resolve_names(names.filter("searched"), checklist, max_distance).drop("distance")
    found = written(found, "name-matches")
    matched = match_join(names, found, ["Submitted_Name"], "left")

    if rules.of(k.OVERRIDE):
        pairs = {(r.value, r.target) for r in rules.of(k.OVERRIDE)}
        wanted = pa.table(dict(zip(("Submitted_Name", "target"), map(list, zip(*sorted(pairs))))))
        chosen = override_targets(taxa.sparkSession.createDataFrame(wanted), checklist, max_distance)
        chosen = chosen.groupBy("Submitted_Name", "target").agg(
            F.min(F.struct(*quoted(MATCH_COLUMNS))).alias("chosen")
        )
        matched = matched.join(chosen, ["Submitted_Name", "target"], "left")
        # The rule rejects the best match, also when its target is not offered.
        ruled = F.col("target").isNotNull()
        matched = matched.withColumns(
            {
                c: F.when(ruled, F.col("chosen").getField(c)).otherwise(F.col(f"`{c}`"))
                for c in MATCH_COLUMNS
            }
        ).drop("chosen")
    has_match = F.col("searched") & F.col("First_matched_Name").isNotNull()
    matched = matched.withColumns(
        {c: F.when(has_match, F.col(f"`{c}`")) for c in MATCH_COLUMNS}
    ).drop("target")
    matched = matched.withColumn(
        "mismatch_test", mentions(F.col("First_matched_Name"), F.col("Submitted_Name"))
    )
    matched = rules.with_pattern_hit(matched, "Submitted_Name", ~F.col("mismatch_test"), "pattern_hit", names)
    distrusted = F.array_contains("kinds", k.NAME) | F.col("pattern_hit")
    kept = matched.withColumn("kept", F.col("First_matched_Name").isNotNull() & ~distrusted).drop("kinds", "pattern_hit")

    # Names that are not kept have no partner; the last key spreads them out.
    part = F.when(F.col("kept"), 0).otherwise(1 + F.pmod(F.hash("Submitted_Name"), F.lit(1023)))
    kept = kept.withColumn("part", part)
    by_accepted = ["site", "LCVP_Accepted_Taxon", "part"]
    doubles = (
        kept.filter("kept")
        .groupBy(*by_accepted)
        .agg((F.sum("n_rows") > 1).alias("doubled"))
        .filter("doubled")
    )
    status = match_join(kept, doubles, by_accepted, "left")
    status = rules.attach(status, k.LABELS, "LCVP_Accepted_Taxon")
    status = rules.with_mode(status, k.DUPLICATES, k.SYNONYM, "other")
    other = F.col("other")
    label = F.when(~F.col("kept"), k.NOT_LISTED)
    label = label.when(F.col("doubled").isNull(), F.lit(None))
    for kind in k.LABELS:
        label = label.when(F.array_contains("kinds", kind), kind)
    label = label.when(other != "keep", other)
    status = status.withColumn("issue", label)
    return status.select(
        *NAME_KEY,
        "n_rows",
        *quoted(MATCH_COLUMNS),
        "mismatch_test",
        F.when(F.col("issue").isNull(), "resolved").otherwise("unresolved").alias("outcome"),
        "issue",
    )


def resolved_names(status: DataFrame) -> DataFrame:
    """Resolved search results, one row per site and name."""
    rows = status.filter(F.col("outcome") == "resolved")
    return rows.select("Submitted_Name", *quoted(MATCH_COLUMNS), "mismatch_test", "site")


def resolved_taxa(taxa: DataFrame, status: DataFrame) -> DataFrame:
    """Resolved search results, one row per submitted row. (A name is submitted
    more than once only where a site keeps duplicates.)"""
    submitted = taxa.select("site", "Submitted_Name")
    joined = skew_join(submitted, resolved_names(status), NAME_KEY, "inner")
    return joined.select("Submitted_Name", *quoted(MATCH_COLUMNS), "mismatch_test", "site")


def unmatched_with_added(status: DataFrame, rules: RuleBook) -> DataFrame:
    """Names without a match at each site, and the rows that the rules add to
    them: site, Submitted_Name."""
    none = status.filter(F.col("First_matched_Name").isNull() & F.col("Submitted_Name").isNotNull())
    return none.select("site", "Submitted_Name").unionByName(rules.appended(status.sparkSession))


def unresolved_taxa(taxa: DataFrame, status: DataFrame, rules: RuleBook) -> DataFrame:
    """Unresolved rows with their issue, each once.

    Names that are not listed come with their submitted columns. Labelled
    duplicates come with their search result, and with the submitted columns
    only where the site's rules rejoin them.
    """
    unresolved = status.filter(F.col("outcome") == "unresolved")
    not_listed = unresolved.filter(F.col("issue") == k.NOT_LISTED).select(*NAME_KEY, "issue")
    submitted = skew_join(taxa, not_listed, NAME_KEY, "inner")
    labelled = unresolved.filter(F.col("issue") != k.NOT_LISTED).drop("n_rows", "outcome")
    rejoined = list(rules.modes(k.CODES))
    coded = labelled.filter(F.col("site").isin(rejoined))
    parts = [submitted, labelled.filter(~F.col("site").isin(rejoined))]
    if rejoined:
        own = taxa.filter(F.col("site").isin(rejoined))
        parts.append(skew_join(own, coded, NAME_KEY, "inner"))
    out = union_by_name(*parts).distinct()
    return out.select(
        "Submitted_Name",
        *quoted(MATCH_COLUMNS),
        "mismatch_test",
        "Sp_Code",
        "Submitted_Genus",
        "Submitted_Family",
        "IDlevel",
        "issue",
        "site",
    )
