"""Queries for name resolution and curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvatab.operators.resolve import fuzzy_candidates, index_checklist, keep_resolved, resolve_names
from sylvatab.operators.sets import union_by_name
from sylvatab.operators.skew import skew_join
from sylvatab.plans import rules as k
from sylvatab.plans.taxa import (
    apply_override,
    assemble_unresolved,
    exclude_names,
    label_duplicates,
    name_status,
    override_targets,
    quarantine_by_list,
    quarantine_by_pattern,
    resolve_with_test,
    resolved_taxa,
    review_list,
    split_missing,
    submitted_taxa,
    triage_duplicates,
    unmatched_by_code,
    unmatched_by_name,
    unmatched_with_added,
    unresolved_taxa,
)
from sylvatab.queries import standin
from sylvatab.queries.standin import MATCH_SQL, best_sql, candidates_sql, checklist, source_rows, table
from sylvatab.sources.tables import written


def _taxa(spark, sf):
    return submitted_taxa(source_rows(spark, sf), standin.rule_book())


def _searched(taxa, spark, sf):
    """The result of the search, written once as a script would keep it."""
    return written(resolve_with_test(taxa, checklist(spark, sf)), "matches")


RAW_SQL = f"SELECT {standin._LATIN} AS Submitted_Name, p_partkey FROM part"


def _raw(spark, sf):
    return source_rows(spark, sf).select(F.col("latin").alias("Submitted_Name"))


def resolve_exact(spark, sf):
    return resolve_names(_raw(spark, sf), checklist(spark, sf), max_distance=0)


RESOLVE_EXACT_SQL = f"WITH raw AS ({RAW_SQL}), {best_sql('raw', limit='0')} SELECT Submitted_Name, {MATCH_SQL}, distance FROM best"


def resolve_fuzzy_best(spark, sf):
    return resolve_names(_raw(spark, sf), checklist(spark, sf))


RESOLVE_FUZZY_SQL = f"WITH raw AS ({RAW_SQL}), {best_sql('raw')} SELECT Submitted_Name, {MATCH_SQL}, distance FROM best"


def resolve_five_edits(spark, sf):
    return resolve_names(_raw(spark, sf), checklist(spark, sf), max_distance=5)


RESOLVE_FIVE_SQL = f"WITH raw AS ({RAW_SQL}), {best_sql('raw', limit='5')} SELECT Submitted_Name, {MATCH_SQL}, distance FROM best"


def fuzzy_candidates_query(spark, sf):
    return fuzzy_candidates(_raw(spark, sf), checklist(spark, sf))


CANDIDATES_SQL = f"WITH raw AS ({RAW_SQL}), {candidates_sql('raw')} SELECT Submitted_Name, {MATCH_SQL}, distance FROM candidates"


def _document_names(spark, sf):
    """Two-word names in whole texts (a capitalised word and a lower-case one),
    and a checklist of those that occur in a document without a label."""
    found = F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ [a-z]+"), F.lit(0))
    words = table(spark, sf, "documents").select("doc_id", F.explode(found).alias("Submitted_Name"))
    words = written(words, "words")
    labels = table(spark, sf, "labels").select("doc_id").distinct()
    listed = words.join(labels, "doc_id", "left_anti").select("Submitted_Name").distinct()
    none = F.lit(None).cast("string")
    return words.select("Submitted_Name"), listed.select(
        F.col("Submitted_Name").alias("Input.Taxon"),
        F.lit("accepted").alias("Status"),
        F.lit("identical").alias("PL.comparison"),
        none.alias("PL.alternative"),
        F.col("Submitted_Name").alias("Output.Taxon"),
        none.alias("Family"),
        none.alias("Order"),
    )


def resolve_document_names(spark, sf):
    names, listed = _document_names(spark, sf)
    found = resolve_names(names, listed, max_distance=0.2)
    return found.select("Submitted_Name", "LCVP_Accepted_Taxon", "distance")


def resolve_document_names_any_genus(spark, sf):
    names, listed = _document_names(spark, sf)
    found = fuzzy_candidates(names, listed, max_distance=0.1, match_genus=False)
    return found.select("Submitted_Name", "LCVP_Accepted_Taxon", "distance")


def _document_sql(limit: str, condition: str) -> str:
    return f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+')) AS n FROM documents),
  a AS (SELECT DISTINCT n AS nk, split_part(n, ' ', 1) AS g, {limit} AS edits FROM w),
  l AS (SELECT DISTINCT n AS k, split_part(n, ' ', 1) AS g FROM w WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
  pairs AS (SELECT nk AS Submitted_Name, k AS "LCVP_Accepted_Taxon", levenshtein(nk, k) AS distance
    FROM a JOIN l ON {condition} AND length(k) BETWEEN length(nk) - edits AND length(nk) + edits
      AND levenshtein(nk, k) <= edits)"""


DOCUMENT_NAMES_SQL = f"""{_document_sql("(length(n) + 4) // 5", "a.g = l.g")}
  SELECT * FROM pairs QUALIFY row_number() OVER (
    PARTITION BY Submitted_Name ORDER BY distance, "LCVP_Accepted_Taxon") = 1"""

# Every name with every entry, whatever the genus.
DOCUMENT_ANY_SQL = f"{_document_sql('(length(n) + 9) // 10', 'TRUE')} SELECT * FROM pairs"


def resolution_test(spark, sf):
    return resolve_with_test(_taxa(spark, sf), checklist(spark, sf))


_TESTED_SQL = f"""{standin.taxa_sql()}, {best_sql("taxa")},
  m AS (SELECT Submitted_Name, {MATCH_SQL}, contains("First_matched_Name", Submitted_Name) AS mismatch_test FROM best)"""

RESOLUTION_TEST_SQL = f"WITH {_TESTED_SQL} SELECT * FROM m"


def mismatch_review(spark, sf):
    """The search and the review after it, on one index of the checklist."""
    index = index_checklist(checklist(spark, sf), 0.1)
    found = written(resolve_with_test(_taxa(spark, sf), index), "matches")
    return review_list(found, index)


MISMATCH_REVIEW_SQL = f"""WITH {_TESTED_SQL} SELECT c.Submitted_Name, {MATCH_SQL.replace('"First', 'c."First').replace(', "', ', c."')},
  c.distance FROM candidates c JOIN m ON m.Submitted_Name = c.Submitted_Name WHERE NOT m.mismatch_test"""


def resolve_kept(spark, sf):
    found = resolve_names(_raw(spark, sf), checklist(spark, sf))
    kept = _raw(spark, sf).filter(~F.col("Submitted_Name").rlike("xx|aaaa"))
    return keep_resolved(found, kept)


RESOLVE_KEPT_SQL = f"{RESOLVE_FUZZY_SQL} WHERE NOT regexp_matches(Submitted_Name, 'xx|aaaa')"


def quarantine_pattern(spark, sf):
    found = _searched(_taxa(spark, sf), spark, sf)
    out, kept = quarantine_by_pattern(found, "xx|a[[:punct:]]", on_mismatch_only=True)
    return union_by_name(
        out.withColumn("trusted", F.lit(False)), kept.withColumn("trusted", F.lit(True))
    ).select("Submitted_Name", "First_matched_Name", "mismatch_test", "trusted")


QUARANTINE_PATTERN_SQL = f"""WITH {_TESTED_SQL} SELECT Submitted_Name, "First_matched_Name", mismatch_test,
  mismatch_test OR NOT regexp_matches(Submitted_Name, 'xx|a[[:punct:]]') AS trusted FROM m"""

_LISTED = [f"{g} {w}promo{c * 4}" for g in standin.GENERA for w in standin.WORDS for c in "abkl"]
_LISTED_SQL = ", ".join(f"'{n}'" for n in _LISTED)


def quarantine_list(spark, sf):
    taxa = _taxa(spark, sf)
    out, kept = quarantine_by_list(taxa, _searched(taxa, spark, sf), _LISTED)
    return union_by_name(out.select("Submitted_Name", "Sp_Code"), kept.select("Submitted_Name", "First_matched_Name"))


QUARANTINE_LIST_SQL = f"""WITH {_TESTED_SQL} SELECT Submitted_Name, Sp_Code, NULL AS "First_matched_Name" FROM taxa
    WHERE Submitted_Name IN ({_LISTED_SQL})
  UNION ALL SELECT Submitted_Name, NULL, "First_matched_Name" FROM m WHERE Submitted_Name NOT IN ({_LISTED_SQL})"""


def pre_exclusion(spark, sf):
    out, rest = exclude_names(_taxa(spark, sf), _LISTED)
    return union_by_name(out.withColumn("searched", F.lit(False)), rest.withColumn("searched", F.lit(True)))


PRE_EXCLUSION_SQL = f"""WITH {standin.taxa_sql()}
  SELECT *, NOT COALESCE(Submitted_Name IN ({_LISTED_SQL}), FALSE) AS searched FROM taxa"""

# The best match of a "rod" with one of these letters is given up for the "ring"
# of the same type, three edits away.
_GIVEN_UP = [f"{g} rod{t}{c * 4}" for g in standin.GENERA for t in ("standard", "economy", "small") for c in "abklmnop"]
_GIVEN_UP_SQL = ", ".join(f"'{n}'" for n in _GIVEN_UP)


def manual_override(spark, sf):
    taxa, listed = _taxa(spark, sf), checklist(spark, sf)
    found = _searched(taxa, spark, sf).drop("mismatch_test")
    wanted = found.filter(F.col("Submitted_Name").isin(_GIVEN_UP)).select(
        "Submitted_Name", F.concat(F.replace("Submitted_Name", F.lit(" rod"), F.lit(" ring")), F.lit(" Auth.")).alias("target")
    )
    chosen = override_targets(wanted, listed).drop("target")
    return apply_override(found, chosen, [f"{n} Auth." for n in _GIVEN_UP])


MANUAL_OVERRIDE_SQL = f"""WITH {_TESTED_SQL}
  SELECT Submitted_Name, {MATCH_SQL} FROM best
    WHERE "First_matched_Name" NOT IN (SELECT concat(n, ' Auth.') FROM unnest([{_GIVEN_UP_SQL}]) t(n))
  UNION ALL SELECT Submitted_Name, {MATCH_SQL} FROM candidates WHERE Submitted_Name IN ({_GIVEN_UP_SQL})
    AND Submitted_Name IN (SELECT Submitted_Name FROM best)
    AND "First_matched_Name" = concat(replace(Submitted_Name, ' rod', ' ring'), ' Auth.')"""


def _matches(spark, sf):
    taxa = split_missing(_taxa(spark, sf), ("Na NA",))[1]
    return taxa, _searched(taxa, spark, sf)


_MATCHED_SQL = f"""{standin.taxa_sql()}, present AS (SELECT * FROM taxa WHERE Submitted_Name IS NOT NULL
    AND Submitted_Name <> 'Na NA'), {best_sql("present")}"""


def no_match_by_name(spark, sf):
    return unmatched_by_name(*_matches(spark, sf))


NO_MATCH_NAME_SQL = f"""WITH {_MATCHED_SQL} SELECT Submitted_Name FROM present
  EXCEPT SELECT Submitted_Name FROM best"""


def no_match_by_code(spark, sf):
    return unmatched_by_code(*_matches(spark, sf))


NO_MATCH_CODE_SQL = f"""WITH {_MATCHED_SQL} SELECT * FROM present WHERE Sp_Code NOT IN (
  SELECT Sp_Code FROM present p JOIN best b ON b.Submitted_Name = p.Submitted_Name)"""


def no_match_with_added(spark, sf):
    """Names without a match at each site, plus the rows that the rules add."""
    return unmatched_with_added(_status(spark, sf)[1], standin.rule_book())


NO_MATCH_ADDED_SQL = f"""WITH {standin.status_sql()}
  SELECT site, Submitted_Name FROM status WHERE "First_matched_Name" IS NULL AND Submitted_Name IS NOT NULL
  UNION ALL SELECT site, val FROM rules WHERE rule = 'append'"""

_DOUBLES = [f"{g} boltbbbb Auth." for g in standin.GENERA]
_SYNONYMS = [f"{g} gearbbbb Auth." for g in standin.GENERA]


def duplicate_triage(spark, sf):
    """All sites' matches as one list: one row per submitted row."""
    taxa, found = _matches(spark, sf)
    rows = skew_join(taxa.select("Submitted_Name", "Sp_Code"), found, ["Submitted_Name"], "inner")
    labelled = label_duplicates(rows, _DOUBLES, _SYNONYMS, "double count")
    return labelled.select("Submitted_Name", "Sp_Code", "LCVP_Accepted_Taxon", "issue")


def _label_sql(other: str) -> str:
    doubles = ", ".join(f"'{n}'" for n in _DOUBLES)
    synonyms = ", ".join(f"'{n}'" for n in _SYNONYMS)
    return f"""CASE WHEN "LCVP_Accepted_Taxon" = 'unresolved' THEN 'in LCVP unresvd'
      WHEN "LCVP_Accepted_Taxon" IN ({doubles}) THEN 'double count'
      WHEN "LCVP_Accepted_Taxon" IN ({synonyms}) THEN 'synonym' ELSE '{other}' END"""


DUPLICATE_TRIAGE_SQL = f"""WITH {_MATCHED_SQL} SELECT p.Submitted_Name, Sp_Code, "LCVP_Accepted_Taxon",
  CASE WHEN count(*) OVER (PARTITION BY "LCVP_Accepted_Taxon") > 1 THEN {_label_sql("double count")} END AS issue
  FROM present p JOIN best b ON b.Submitted_Name = p.Submitted_Name"""


def unresolved_assembly(spark, sf):
    """Step by step, the way a script would do it, with all rows as one list."""
    missing = split_missing(_taxa(spark, sf))[0]
    taxa, found = _matches(spark, sf)
    rows = skew_join(taxa.select("Submitted_Name", "site"), found, ["Submitted_Name"], "inner")
    _, repeated = triage_duplicates(rows, _DOUBLES, _SYNONYMS)
    repeated = repeated.select("Submitted_Name", "First_matched_Name", "LCVP_Accepted_Taxon", "issue", "site")
    return assemble_unresolved(taxa, unmatched_by_name(taxa, found), missing, repeated)


UNRESOLVED_ASSEMBLY_SQL = f"""WITH {_MATCHED_SQL},
  d AS (SELECT p.Submitted_Name, "First_matched_Name", "LCVP_Accepted_Taxon", site,
      count(*) OVER (PARTITION BY "LCVP_Accepted_Taxon") AS n
    FROM present p JOIN best b ON b.Submitted_Name = p.Submitted_Name)
  SELECT DISTINCT *, 'not in LCVP' AS issue FROM taxa WHERE Submitted_Name IS NULL
    OR (Submitted_Name <> 'Na NA' AND Submitted_Name NOT IN (SELECT Submitted_Name FROM best))
  UNION ALL BY NAME SELECT DISTINCT * EXCLUDE (n), {_label_sql("synonym")} AS issue FROM d WHERE n > 1"""


def _status(spark, sf):
    taxa = _taxa(spark, sf)
    return taxa, name_status(taxa, checklist(spark, sf), standin.rule_book())


def name_status_query(spark, sf):
    return _status(spark, sf)[1]


def taxa_resolved(spark, sf):
    return resolved_taxa(*_status(spark, sf))


def taxa_unresolved(spark, sf):
    taxa, status = _status(spark, sf)
    return unresolved_taxa(taxa, written(status, "name-status"), standin.rule_book())


QUERIES = {
    "resolve_exact": (resolve_exact, RESOLVE_EXACT_SQL),
    "resolve_fuzzy_best": (resolve_fuzzy_best, RESOLVE_FUZZY_SQL),
    "resolve_five_edits": (resolve_five_edits, RESOLVE_FIVE_SQL),
    "fuzzy_candidates": (fuzzy_candidates_query, CANDIDATES_SQL),
    "resolve_kept": (resolve_kept, RESOLVE_KEPT_SQL),
    "resolve_document_names": (resolve_document_names, DOCUMENT_NAMES_SQL),
    "resolve_document_names_any_genus": (resolve_document_names_any_genus, DOCUMENT_ANY_SQL),
    "resolution_test": (resolution_test, RESOLUTION_TEST_SQL),
    "mismatch_review": (mismatch_review, MISMATCH_REVIEW_SQL),
    "quarantine_pattern": (quarantine_pattern, QUARANTINE_PATTERN_SQL),
    "quarantine_list": (quarantine_list, QUARANTINE_LIST_SQL),
    "pre_exclusion": (pre_exclusion, PRE_EXCLUSION_SQL),
    "manual_override": (manual_override, MANUAL_OVERRIDE_SQL),
    "no_match_by_name": (no_match_by_name, NO_MATCH_NAME_SQL),
    "no_match_by_code": (no_match_by_code, NO_MATCH_CODE_SQL),
    "no_match_with_added": (no_match_with_added, NO_MATCH_ADDED_SQL),
    "duplicate_triage": (duplicate_triage, DUPLICATE_TRIAGE_SQL),
    "unresolved_assembly": (unresolved_assembly, UNRESOLVED_ASSEMBLY_SQL),
    "name_status": (name_status_query, f"WITH {standin.status_sql()} SELECT * FROM status"),
    "taxa_resolved": (taxa_resolved, f"WITH {standin.resolved_sql()} SELECT * FROM resolved"),
    "taxa_unresolved": (taxa_unresolved, f"WITH {standin.unresolved_sql()} SELECT * FROM unresolved"),
}
