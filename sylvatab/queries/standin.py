"""Species tables derived from the given tables, in Spark and as SQL.

Parts play the submitted taxa: the brand is the site, the two-word part name
with type and size letter is the name, written with the faults that real lists
have (missing, one word, wrong case, a lost letter, an "xx" suffix) on keys
that a fixed rule picks. The checklist is derived from the same distinct names.
Line items, aggregated by part, give sample sizes and interval bounds. Every
part and every line item takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvatab.plans import rules as k
from sylvatab.plans.rules import Rule, RuleBook


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The expressions below are common to Spark and the checking engine.
_LETTER = "chr(97 + p_size % 26)"
_GENUS = "concat(upper(substr(p_name, 1, 1)), substr(split_part(p_name, ' ', 1), 2))"
_FULL = f"concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), lower(p_type), repeat({_LETTER}, 4))"
_LATIN = f"""CASE
  WHEN p_partkey % 41 = 0 THEN NULL
  WHEN p_partkey % 37 = 0 THEN 'NA'
  WHEN p_partkey % 31 = 0 THEN {_GENUS}
  ELSE concat(
    CASE WHEN p_partkey % 13 = 0 THEN substr(p_name, 1, 1) ELSE upper(substr(p_name, 1, 1)) END,
    substr(p_name, 2),
    CASE WHEN p_partkey % 7 = 0 THEN substr(lower(p_type), 2) WHEN p_partkey % 11 = 0 THEN upper(p_type)
      ELSE lower(p_type) END,
    repeat({_LETTER}, 4),
    CASE WHEN p_partkey % 29 = 0 THEN 'xx' ELSE '' END) END"""
_SOURCE_COLUMNS = {
    "site": "p_brand",
    "latin": _LATIN,
    "sp": "concat('s', CAST(p_partkey - p_partkey % 2 AS VARCHAR(20)))",
    "genus": _GENUS,
    "family": "p_type",
    "IDlevel": "concat('size ', CAST(p_size AS VARCHAR(10)))",
}

MEASURE_COLUMNS = (
    [f"growth_layer_{i}_obs" for i in range(1, 5)]
    + [f"survival_layer_{i}_obs" for i in range(1, 5)]
    + [f"{m}_layer{i}_CI.{b}" for m in ("growth", "survival") for i in range(1, 5) for b in ("05", "95")]
    + ["max_tax"]
)
FLAG_COLUMNS = [f"{m}_layer_{i}_imputed" for m in ("growth", "survival") for i in range(1, 5)]


def _aggregates(value: str) -> dict[str, str]:
    """Sample size and bounds per layer: line numbers 1-4 are growth, 4-7 survival."""
    out = {}
    for m, shift in (("growth", 0), ("survival", 3)):
        for i in range(1, 5):
            test = f"l_linenumber = {i + shift}"
            out[f"{m}_layer_{i}_obs"] = f"CAST(count(CASE WHEN {test} THEN 1 END) AS DOUBLE)"
            out[f"{m}_layer{i}_CI.05"] = f"min(CASE WHEN {test} THEN {value} END)"
            out[f"{m}_layer{i}_CI.95"] = f"max(CASE WHEN {test} THEN {value} END)"
    out["max_tax"] = "max(l_tax)"
    return {c: out[c] for c in MEASURE_COLUMNS}


VALUES = {"means": "l_quantity", "medians": "l_extendedprice"}


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted rows without measurements; names as they came in."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", *[F.expr(e).alias(c) for c, e in _SOURCE_COLUMNS.items()])


def measures(spark: SparkSession, sf_dir: str, kind: str = "means") -> DataFrame:
    """The source table: submitted rows with their measurements."""
    items = table(spark, sf_dir, "lineitem")
    per_part = items.groupBy("l_partkey").agg(
        *[F.expr(e).alias(c) for c, e in _aggregates(VALUES[kind]).items()]
    )
    rows = source_rows(spark, sf_dir)
    joined = rows.join(per_part, rows["p_partkey"] == per_part["l_partkey"], "left")
    sizes = [c for c in MEASURE_COLUMNS if c.endswith("_obs")]
    return joined.fillna(0.0, sizes).select(
        *_SOURCE_COLUMNS, *[F.col(f"`{c}`") for c in MEASURE_COLUMNS]
    )


def checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per distinct full name, but for names with x or y that no list
    has; c to f are synonyms, g is listed but unresolved, h has two authors."""
    part = table(spark, sf_dir, "part")
    names = part.select(
        F.expr(_FULL).alias("full"),
        F.expr(_LETTER).alias("letter"),
        F.expr(_GENUS).alias("genus"),
        F.expr("split_part(p_name, ' ', 2)").alias("word"),
        F.col("p_type").alias("family"),
    ).distinct()
    second = names.filter(F.col("letter") == "h").withColumn("author", F.lit("Aa."))
    listed = names.filter(~F.col("letter").isin("x", "y")).withColumn("author", F.lit("Auth."))
    return listed.unionByName(second).select(
        F.concat_ws(" ", "full", "author").alias("Input.Taxon"),
        F.expr(_STATUS).alias("Status"),
        F.expr(_COMPARISON).alias("PL.comparison"),
        F.expr(_ALTERNATIVE).alias("PL.alternative"),
        F.expr(_ACCEPTED).alias("Output.Taxon"),
        F.col("family").alias("Family"),
        F.concat_ws(" ", F.lit("Order"), "genus").alias("Order"),
    )


_STATUS = """CASE WHEN letter IN ('c', 'd', 'e', 'f') OR author = 'Aa.' THEN 'synonym'
  WHEN letter = 'g' THEN 'unresolved' ELSE 'accepted' END"""
_COMPARISON = "CASE WHEN letter = 'i' THEN 'misspelling' WHEN letter = 'j' THEN NULL ELSE 'identical' END"
_ALTERNATIVE = "CASE WHEN letter = 'i' THEN concat(word, ' alternative') END"
_ACCEPTED = """CASE WHEN letter IN ('c', 'd', 'e', 'f') THEN concat(genus, ' ', word, 'bbbb Auth.')
  WHEN letter = 'g' THEN 'unresolved' ELSE concat_ws(' ', "full", 'Auth.') END""".replace('"full"', "full")

GENERA = ["Blue", "New", "Cold", "Hot", "Old", "Red", "Large", "Small"]
WORDS = ["ring", "bolt", "plate", "rod", "anvil", "widget", "gear", "gizmo"]


def rule_book() -> RuleBook:
    rules = [Rule(f"Brand#{i}", k.CASE, "genus") for i in range(1, 9)]
    rules += [Rule(f"Brand#{i}", k.CASE, "lower_genus") for i in range(9, 15)]
    rules += [Rule(f"Brand#{i}", k.SENTINEL, "Na NA") for i in range(2, 5)]
    rules += [Rule(f"Brand#{i}", k.PATTERN, "xx|sp[[:punct:]]") for i in (1, 5, 9, 15, 19)]
    rules += [Rule(f"Brand#{i}", k.PATTERN, "x.$| NA", True) for i in (2, 10, 16, 20)]
    rules += [
        Rule(f"Brand#{i}", k.NAME, f"{g} {w}promo{letter * 4}")
        for i in (17, 18)
        for g in GENERA
        for w in WORDS[:4]
        for letter in "abklm"
    ]
    rules += [
        Rule(f"Brand#{i}", k.PRE_EXCLUDE, f"{g} {w}economy{letter * 4}")
        for i in (18, 19)
        for g in GENERA
        for w in WORDS[4:]
        for letter in "abklm"
    ]
    rules += [
        Rule(
            "Brand#21",
            k.OVERRIDE,
            f"{g} rod{t}{letter * 4}",
            target=f"{g} ring{t}{letter * 4} Auth.",
        )
        for g in GENERA
        for t in ("standard", "economy")
        for letter in "abcklmno"
    ]
    rules += [Rule(f"Brand#{i}", k.LISTED_UNRESOLVED, "unresolved") for i in range(1, 13)]
    rules += [
        Rule(f"Brand#{i}", kind, f"{g} {w}bbbb Auth.")
        for i in range(1, 26)
        for g in GENERA
        for kind, w in ((k.DOUBLE_COUNT, "bolt"), (k.SYNONYM, "gear"))
    ]
    rules += [Rule("Brand#22", k.APPEND, "Unidentified .")] * 10 + [Rule("Brand#23", k.APPEND, "Trichoscypha sp.")]
    rules += [Rule("Brand#13", k.DUPLICATES, "double count")]
    rules += [Rule(f"Brand#{i}", k.DUPLICATES, "keep") for i in (22, 23)]
    rules += [Rule(f"Brand#{i}", k.CODES, "rejoin") for i in (22, 24)]
    return RuleBook(tuple(rules))


# ---------------------------------------------------------------- SQL


def quote(c: str) -> str:
    return f'"{c}"'


MATCH_SQL = ", ".join(
    quote(c)
    for c in [
        "First_matched_Name",
        "Status",
        "PL.comparison",
        "PL.alternative",
        "LCVP_Accepted_Taxon",
        "Family",
        "Order",
    ]
)


def source_sql(kind: str = "means") -> str:
    aggregates = ", ".join(f"{e} AS {quote(c)}" for c, e in _aggregates(VALUES[kind]).items())
    columns = ", ".join(f"{e} AS {c}" for c, e in _SOURCE_COLUMNS.items())
    picked = ", ".join(
        f"COALESCE(m.{quote(c)}, 0) AS {quote(c)}" if c.endswith("_obs") else f"m.{quote(c)}"
        for c in MEASURE_COLUMNS
    )
    return f"""SELECT {columns}, {picked} FROM part
      LEFT JOIN (SELECT l_partkey, {aggregates} FROM lineitem GROUP BY l_partkey) m ON p_partkey = m.l_partkey"""


def checklist_sql() -> str:
    accepted = _ACCEPTED.replace("concat_ws(' ', full,", "concat_ws(' ', fullname,")
    return f"""SELECT concat(fullname, ' ', author) AS "Input.Taxon", {_STATUS} AS "Status",
      {_COMPARISON} AS "PL.comparison", {_ALTERNATIVE} AS "PL.alternative",
      {accepted} AS "Output.Taxon", family AS "Family", concat('Order ', genus) AS "Order"
    FROM (SELECT DISTINCT {_FULL} AS fullname, {_LETTER} AS letter, {_GENUS} AS genus,
            split_part(p_name, ' ', 2) AS word, p_type AS family FROM part) d
    CROSS JOIN (VALUES ('Auth.'), ('Aa.')) a(author)
    WHERE CASE WHEN author = 'Aa.' THEN letter = 'h' ELSE letter NOT IN ('x', 'y') END"""


def key_sql(name: str) -> str:
    """Match key of a name with single spaces."""
    genus = f"split_part({name}, ' ', 1)"
    return (
        f"concat(upper(substr({genus}, 1, 1)), lower(substr({genus}, 2)), "
        f"substr({name}, length({genus}) + 1))"
    )


ENTRIES_SQL = f"""entries AS (SELECT "Input.Taxon" AS "First_matched_Name", "Status", "PL.comparison",
    "PL.alternative", "Output.Taxon" AS "LCVP_Accepted_Taxon", "Family", "Order",
    concat(split_part("Input.Taxon", ' ', 1), ' ', split_part("Input.Taxon", ' ', 2)) AS k
    FROM ({checklist_sql()}) c)"""


def limit_sql(key: str) -> str:
    return f"((length({key}) + 9) // 10)"


def candidates_sql(names: str, limit: str | None = None) -> str:
    """CTEs: candidates(Submitted_Name, match columns, distance) by brute force."""
    limit = limit or limit_sql(key_sql("Submitted_Name"))
    return f"""{ENTRIES_SQL},
    wanted AS (SELECT DISTINCT Submitted_Name, {key_sql("Submitted_Name")} AS nk, {limit} AS edits
      FROM {names} WHERE Submitted_Name IS NOT NULL),
    candidates AS (SELECT w.Submitted_Name, e.*, levenshtein(nk, k) AS distance
      FROM wanted w JOIN entries e ON split_part(nk, ' ', 1) = split_part(k, ' ', 1)
      WHERE levenshtein(nk, k) <= edits)"""


def best_sql(names: str, limit: str | None = None) -> str:
    """CTEs: candidates and best, one row per name."""
    return f"""{candidates_sql(names, limit)},
    best AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY Submitted_Name
      ORDER BY distance, CASE WHEN "Status" = 'accepted' THEN 0 ELSE 1 END, "First_matched_Name") = 1)"""


def case_sql(name: str) -> str:
    """A name in the case its site uses."""

    def title(n: str) -> str:
        first, at = f"split_part({n}, ' ', 1)", f"strpos({n}, ' ')"
        return (
            f"CASE WHEN {n} IS NULL THEN 'NA NA' ELSE concat(upper(substr({first}, 1, 1)), "
            f"lower(substr({first}, 2)), ' ', CASE WHEN {at} = 0 THEN 'NA' ELSE substr({n}, {at} + 1) END) END"
        )

    modes = rule_book().modes(k.CASE)
    genus = ", ".join(f"'{s}'" for s, m in modes.items() if m == "genus")
    lowered = ", ".join(f"'{s}'" for s, m in modes.items() if m == "lower_genus")
    return (
        f"CASE WHEN site IN ({genus}) THEN {title(name)} "
        f"WHEN site IN ({lowered}) THEN {title(f'lower({name})')} ELSE {name} END"
    )


def taxa_sql() -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in _SOURCE_COLUMNS.items())
    return f"""taxa AS (SELECT {case_sql("latin")} AS Submitted_Name, sp AS Sp_Code,
      genus AS Submitted_Genus, family AS Submitted_Family, "IDlevel", site
      FROM (SELECT {columns} FROM part) s)"""


def rules_sql() -> str:
    rows = ", ".join(
        f"('{r.site}', '{r.rule}', '{r.value}', {r.on_mismatch_only}, "
        + (f"'{r.target}')" if r.target else "NULL)")
        for r in rule_book().rules
    )
    return f"rules(site, rule, val, only_mismatch, target) AS (VALUES {rows})"


def status_sql() -> str:
    """CTEs up to status: one row per site and submitted name."""
    match = MATCH_SQL.split(", ")
    replaced = ", ".join(
        f"CASE WHEN NOT n.searched THEN NULL WHEN n.target IS NOT NULL THEN o.{c} ELSE b.{c} END AS {c}"
        for c in match
    )

    def has(kind: str, value: str, site: str) -> str:
        return f"EXISTS (SELECT 1 FROM rules r WHERE r.rule = '{kind}' AND r.site = {site} AND r.val = {value})"

    return f"""{taxa_sql()}, {rules_sql()},
    names AS (SELECT g.site, g.Submitted_Name, g.n_rows, o.target,
        g.Submitted_Name IS NOT NULL AND s.site IS NULL AS searched, l.site IS NOT NULL AS listed
      FROM (SELECT site, Submitted_Name, count(*) AS n_rows FROM taxa GROUP BY ALL) g
      LEFT JOIN rules o ON o.rule = 'override' AND o.site = g.site AND o.val = g.Submitted_Name
      LEFT JOIN rules l ON l.rule = 'name' AND l.site = g.site AND l.val = g.Submitted_Name
      LEFT JOIN rules s ON s.rule IN ('sentinel', 'pre_exclude') AND s.site = g.site AND s.val = g.Submitted_Name),
    searched AS (SELECT * FROM names WHERE searched),
    {best_sql("searched")},
    matched AS (SELECT n.site, n.Submitted_Name, n.n_rows, n.listed, {replaced}
      FROM names n LEFT JOIN best b ON b.Submitted_Name = n.Submitted_Name
      LEFT JOIN candidates o ON o.Submitted_Name = n.Submitted_Name AND o."First_matched_Name" = n.target),
    tested AS (SELECT *, contains("First_matched_Name", Submitted_Name) AS mismatch_test FROM matched),
    kept AS (SELECT *, "First_matched_Name" IS NOT NULL AND NOT listed AND NOT EXISTS (
        SELECT 1 FROM rules r WHERE r.rule = 'pattern' AND r.site = t.site
          AND regexp_matches(t.Submitted_Name, r.val) AND (NOT r.only_mismatch OR NOT t.mismatch_test)) AS keep
      FROM tested t),
    counted AS (SELECT *, sum(n_rows) OVER (PARTITION BY site, keep, "LCVP_Accepted_Taxon") AS reached FROM kept),
    labelled AS (SELECT c.*, CASE WHEN NOT keep THEN 'not in LCVP' WHEN reached = 1 THEN NULL
        WHEN {has('in LCVP unresvd', '"LCVP_Accepted_Taxon"', 'c.site')} THEN 'in LCVP unresvd'
        WHEN {has('double count', '"LCVP_Accepted_Taxon"', 'c.site')} THEN 'double count'
        WHEN {has('synonym', '"LCVP_Accepted_Taxon"', 'c.site')} THEN 'synonym'
        WHEN d.val = 'keep' THEN NULL ELSE coalesce(d.val, 'synonym') END AS issue
      FROM counted c LEFT JOIN rules d ON d.rule = 'duplicates' AND d.site = c.site),
    status AS (SELECT site, Submitted_Name, n_rows, {MATCH_SQL}, mismatch_test,
        CASE WHEN issue IS NULL THEN 'resolved' ELSE 'unresolved' END AS outcome, issue FROM labelled)"""


def resolved_sql() -> str:
    return f"""{status_sql()},
    resolved AS (SELECT Submitted_Name, {MATCH_SQL}, mismatch_test, site
      FROM (SELECT *, unnest(range(n_rows)) AS copy FROM status WHERE outcome = 'resolved') u)"""


def unresolved_sql() -> str:
    """CTEs up to unresolved (and resolved)."""
    empty = ", ".join(f"NULL AS {c}" for c in MATCH_SQL.split(", "))
    return f"""{resolved_sql()},
    rejoined AS (SELECT site FROM rules WHERE rule = 'codes'),
    unresolved AS (
      SELECT DISTINCT t.Submitted_Name, {empty}, CAST(NULL AS BOOLEAN) AS mismatch_test, t.Sp_Code,
        t.Submitted_Genus, t.Submitted_Family, t."IDlevel", s.issue, t.site
      FROM taxa t JOIN status s ON s.site = t.site AND s.Submitted_Name IS NOT DISTINCT FROM t.Submitted_Name
      WHERE s.issue = 'not in LCVP'
      UNION
      SELECT Submitted_Name, {MATCH_SQL}, mismatch_test, NULL, NULL, NULL, NULL, issue, site
      FROM status WHERE issue <> 'not in LCVP' AND site NOT IN (SELECT site FROM rejoined)
      UNION
      SELECT t.Submitted_Name, {MATCH_SQL}, mismatch_test, t.Sp_Code, t.Submitted_Genus, t.Submitted_Family,
        t."IDlevel", s.issue, t.site
      FROM taxa t JOIN status s ON s.site = t.site AND s.Submitted_Name = t.Submitted_Name
      WHERE s.issue <> 'not in LCVP' AND s.site IN (SELECT site FROM rejoined))"""
