"""Queries for measurements, sources and sinks, and the combined database."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvatab.plans.combine import (
    MEANINGS,
    combined_means,
    combined_sites,
    combined_taxa,
    full_run,
    dictionary,
    merged,
    read_database,
    stacked,
    write_database,
)
from sylvatab.plans.demography import (
    demography_resolved,
    demography_unresolved,
    measure_columns,
    size_and_width,
    with_imputed_flags,
    with_interval_widths,
)
from sylvatab.operators.resolve import MATCH_COLUMNS
from sylvatab.plans.profile import check_coordinates, profile
from sylvatab.plans.second_source import second_source_demography, second_source_taxa
from sylvatab.plans.taxa import name_status, resolved_names, resolved_taxa, submitted_taxa, unresolved_taxa
from sylvatab.queries import standin
from sylvatab.queries.standin import FLAG_COLUMNS, MEASURE_COLUMNS, checklist, measures, quote, table
from sylvatab.sources.tables import (
    read_csv,
    read_csv_set,
    read_table,
    scratch_path,
    write_csv,
    write_split,
    written,
)

MEASURES_SQL = ", ".join(quote(c) for c in MEASURE_COLUMNS)


def _flags_sql() -> str:
    return ", ".join(
        f"COALESCE(regexp_matches(CAST({c.replace('_imputed', '_obs')} AS VARCHAR), '^0'), FALSE) AS {c}"
        for c in FLAG_COLUMNS
    )


def coordinate_check(spark, sf):
    """Customers as sites, with coordinates from their balance."""
    sites = table(spark, sf, "customer").select(
        F.concat("c_mktsegment", F.lit(" "), F.floor(F.abs("c_acctbal"))).alias("Site_name"),
        F.expr("CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / 100 END").alias("Latitude"),
        (F.col("c_acctbal") / 50).alias("Longitude"),
        "c_custkey",
    )
    return check_coordinates(sites)


COORDINATE_SQL = """WITH s AS (SELECT concat(c_mktsegment, ' ', CAST(floor(abs(c_acctbal)) AS BIGINT)) AS "Site_name",
    CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / 100 END AS "Latitude", c_acctbal / 50 AS "Longitude", c_custkey
    FROM customer),
  c AS (SELECT *, COALESCE("Latitude" BETWEEN -90 AND 90, FALSE) AS latitude_ok,
    COALESCE("Longitude" BETWEEN -180 AND 180, FALSE) AS longitude_ok,
    count(*) OVER (PARTITION BY "Site_name") = 1 AS name_unique FROM s)
  SELECT *, latitude_ok AND longitude_ok AND name_unique AS sensible FROM c"""


def measure_flags(spark, sf):
    return with_imputed_flags(measures(spark, sf)).drop("genus", "family", "IDlevel")


MEASURE_FLAGS_SQL = f"SELECT site, latin, sp, {MEASURES_SQL}, {_flags_sql()} FROM ({standin.source_sql()}) s"


def ci_widths(spark, sf):
    wide = with_interval_widths(measures(spark, sf))
    return wide.select("site", "latin", "sp", *[c for c in wide.columns if c.endswith("_width")])


def _width_sql(m: str, i: int) -> str:
    return f'"{m}_layer{i}_CI.95" - "{m}_layer{i}_CI.05"'


_LAYERS = [(m, i) for m in ("growth", "survival") for i in range(1, 5)]

CI_WIDTHS_SQL = f"""SELECT site, latin, sp, {", ".join(
    f'{_width_sql(m, i)} AS "{m}_layer_{i}_CI90_width"' for m, i in _LAYERS)} FROM ({standin.source_sql()}) s"""


def obs_vs_width_long(spark, sf):
    return size_and_width(measures(spark, sf), ["site", "latin", "sp"])


OBS_WIDTH_SQL = f"WITH s AS ({standin.source_sql()}) " + " UNION ALL ".join(
    f"""SELECT site, latin, sp, '{m}' AS measure, {i} AS layer, {m}_layer_{i}_obs AS obs, {_width_sql(m, i)} AS width
    FROM s WHERE NOT COALESCE(regexp_matches(CAST({m}_layer_{i}_obs AS VARCHAR), '^0'), FALSE)"""
    for m, i in _LAYERS
)


def _taxa_tables(spark, sf):
    rules = standin.rule_book()
    taxa = submitted_taxa(standin.source_rows(spark, sf), rules)
    return rules, taxa, written(name_status(taxa, checklist(spark, sf), rules), "name-status")


def _resolved_measures(spark, sf, rules, resolved, kind="means"):
    columns = measure_columns(measures(spark, sf, kind), rules)
    return with_imputed_flags(demography_resolved(columns, resolved))


def demography_resolved_query(spark, sf):
    rules, _, status = _taxa_tables(spark, sf)
    return _resolved_measures(spark, sf, rules, resolved_names(status))


def medians_resolved(spark, sf):
    rules, _, status = _taxa_tables(spark, sf)
    return _resolved_measures(spark, sf, rules, resolved_names(status), "medians")


def demography_unresolved_query(spark, sf):
    rules, taxa, status = _taxa_tables(spark, sf)
    columns = measure_columns(measures(spark, sf), rules)
    return with_imputed_flags(demography_unresolved(columns, unresolved_taxa(taxa, status, rules), rules))


def _measured_sql(kind: str = "means") -> str:
    return f"""measured AS (SELECT {standin.case_sql("latin")} AS Submitted_Name, sp AS Sp_Code, site, {MEASURES_SQL}
    FROM ({standin.source_sql(kind)}) s)"""


def _resolved_demography_sql(kind: str = "means") -> str:
    return f"""{standin.resolved_sql()}, {_measured_sql(kind)},
    demography AS (SELECT r."LCVP_Accepted_Taxon", m.site, {MEASURES_SQL}, {_flags_sql()}
      FROM measured m JOIN (SELECT DISTINCT site, Submitted_Name, "LCVP_Accepted_Taxon" FROM resolved) r
        ON r.site = m.site AND r.Submitted_Name = m.Submitted_Name)"""


DEMOGRAPHY_UNRESOLVED_SQL = f"""WITH {standin.unresolved_sql()}, {_measured_sql()}
  SELECT DISTINCT m.Submitted_Name, m.Sp_Code, m.site, {MEASURES_SQL}, {_flags_sql()} FROM measured m
  WHERE EXISTS (SELECT 1 FROM unresolved u WHERE u.site = m.site
    AND u.Submitted_Name IS NOT DISTINCT FROM m.Submitted_Name
    AND (u.site NOT IN (SELECT site FROM rejoined) OR u.Sp_Code = m.Sp_Code))"""


def _second_source(spark, sf):
    """Parts as a second source: genus and species in two columns."""
    rows = measures(spark, sf).drop("genus")
    parts = F.split("latin", " ", 2)
    return rows.select(
        F.try_element_at(parts, F.lit(1)).alias("Genus"),
        F.try_element_at(parts, F.lit(2)).alias("Species"),
        *[F.col(f"survival_layer_{i}_obs").alias(f"mu{i}_1") for i in range(1, 5)],
        *[F.col(f"`growth_layer{i}_CI.95`").alias(f"G{i}_1") for i in range(1, 5)],
        F.col("max_tax").alias("F_1"),
        F.col("growth_layer_1_obs").alias("SampleSize"),
    )


def second_source_taxa_query(spark, sf):
    resolved, review = second_source_taxa(_second_source(spark, sf), checklist(spark, sf), 5)
    out = resolved.unionByName(review, allowMissingColumns=True)
    return out.select(
        "Submitted_Name", "Genus_author", "Species_author", "First_matched_Name", "LCVP_Accepted_Taxon", "search",
        "candidates",
    )


def second_source_demography_query(spark, sf):
    source = _second_source(spark, sf)
    resolved, _ = second_source_taxa(source, checklist(spark, sf), 5)
    return second_source_demography(source, resolved, "BCI")


def _second_sql() -> str:
    return f"""src AS (SELECT CASE WHEN latin IS NOT NULL THEN split_part(latin, ' ', 1) END AS g,
      CASE WHEN strpos(latin, ' ') > 0 THEN substr(latin, strpos(latin, ' ') + 1) END AS s, *
      FROM ({standin.source_sql()}) x),
    names AS (SELECT DISTINCT g AS "Genus_author", s AS "Species_author",
      concat(COALESCE(g, 'NA'), ' ', COALESCE(s, 'NA')) AS Submitted_Name FROM src),
    {standin.candidates_sql("names", limit="5")},
    best AS (SELECT * FROM candidates WHERE distance = 0 QUALIFY row_number() OVER (PARTITION BY Submitted_Name
      ORDER BY CASE WHEN "Status" = 'accepted' THEN 0 ELSE 1 END, "First_matched_Name") = 1),
    identical AS (SELECT * FROM best WHERE "PL.comparison" = 'identical'),
    others AS (SELECT Submitted_Name FROM names EXCEPT SELECT Submitted_Name FROM identical),
    counted AS (SELECT o.Submitted_Name, count(c.Submitted_Name) AS n FROM others o
      LEFT JOIN candidates c ON c.Submitted_Name = o.Submitted_Name GROUP BY ALL),
    found AS (SELECT *, 'exact' AS search FROM identical UNION ALL
      SELECT c.*, 'fuzzy' FROM candidates c JOIN counted k ON k.Submitted_Name = c.Submitted_Name AND k.n = 1)"""


SECOND_TAXA_SQL = f"""WITH {_second_sql()}
  SELECT f.Submitted_Name, "Genus_author", "Species_author", "First_matched_Name", "LCVP_Accepted_Taxon", search,
    NULL AS candidates FROM found f JOIN names n ON n.Submitted_Name = f.Submitted_Name
  UNION ALL SELECT Submitted_Name, NULL, NULL, NULL, NULL, NULL, n FROM counted WHERE n <> 1"""

_SECOND_MEASURES_SQL = ", ".join(
    [f"src.survival_layer_{i}_obs AS mu{i}_1" for i in range(1, 5)]
    + [f'src."growth_layer{i}_CI.95" AS "G{i}_1"' for i in range(1, 5)]
    + ['src.max_tax AS "F_1"', 'src.growth_layer_1_obs AS "SampleSize"']
)

SECOND_DEMOGRAPHY_SQL = f"""WITH {_second_sql()}
  SELECT {_SECOND_MEASURES_SQL}, n.Submitted_Name, n."Genus_author" AS "Genus", n."Species_author" AS "Species",
    'BCI' AS "Site_name"
  FROM (SELECT DISTINCT n.* FROM names n JOIN found f ON f.Submitted_Name = n.Submitted_Name) n
  LEFT JOIN src ON concat(COALESCE(src.g, 'NA'), ' ', COALESCE(src.s, 'NA')) = n.Submitted_Name"""


def profile_measures(spark, sf):
    """The second source, with infinite values, values that are not a number and
    a constant column, and the histogram of the sample sizes."""
    source = _second_source(spark, sf)
    odd = F.when(F.col("SampleSize") > 40, F.lit(float("inf"))).when(F.col("SampleSize") < 5, F.lit(float("nan")))
    source = source.withColumns({"mu1_1": odd.otherwise(F.col("mu1_1")), "mu2_1": F.lit(3.0)})
    return profile(source, [("mu1_1", "mu4_1"), ("G1_1", "G4_1")], ["F_1", "SampleSize"], sizes="SampleSize")


_PROFILED = [f"mu{i}_1" for i in range(1, 5)] + [f"G{i}_1" for i in range(1, 5)] + ["F_1", "SampleSize"]
PROFILE_SQL = (
    f"""WITH {_second_sql()}, q AS (SELECT {_SECOND_MEASURES_SQL} FROM src),
  p AS (SELECT * REPLACE (CASE WHEN "SampleSize" > 40 THEN CAST('inf' AS DOUBLE)
    WHEN "SampleSize" < 5 THEN CAST('nan' AS DOUBLE) ELSE mu1_1 END AS mu1_1, 3.0 AS mu2_1) FROM q),
  e AS (SELECT min("SampleSize") AS lo, (max("SampleSize") - min("SampleSize")) / 30 AS c FROM p),
  w1 AS (SELECT lo, c, pow(10.0, floor(log10(c))) AS u FROM e),
  w2 AS (SELECT lo, CASE WHEN 10 * u - c < 1.5 * (c - 5 * u) THEN 10 * u WHEN 5 * u - c < 2.75 * (c - 2 * u) THEN 5 * u
    WHEN 2 * u - c < 1.5 * (c - u) THEN 2 * u ELSE u END AS w FROM w1),
  bins AS (SELECT CAST(greatest(ceil("SampleSize" / w - 1e-7) - 1, floor(lo / w + 1e-7)) AS BIGINT) AS bin, w
    FROM p, w2 WHERE "SampleSize" IS NOT NULL) """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS variable,
      CASE WHEN count(*) = count("{c}") AND NOT bool_or(isnan("{c}")) THEN min("{c}") END AS min,
      CASE WHEN count(*) = count("{c}") AND NOT bool_or(isnan("{c}")) THEN max("{c}") END AS max,
      count(*) - count("{c}") AS n_null, count(*) FILTER (isnan("{c}")) AS n_nan,
      count(*) FILTER (isinf("{c}")) AS n_inf, count(*) FILTER ("{c}" = 0) AS n_zero,
      CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper, CAST(NULL AS BIGINT) AS n
      FROM (SELECT CAST("{c}" AS DOUBLE) AS "{c}" FROM p) x"""
        for c in _PROFILED
    )
    + """ UNION ALL BY NAME SELECT 'SampleSize' AS variable, bin * w AS lower, (bin + 1) * w AS upper, count(*) AS n
      FROM bins GROUP BY bin, w"""
)


def _sites(spark, sf):
    """One site per brand with coordinates from its parts, and one without taxa."""
    part = table(spark, sf, "part")
    sites = part.groupBy(F.col("p_brand").alias("site")).agg(
        F.min("p_retailprice").alias("Latitude"), F.max("p_retailprice").alias("Longitude")
    )
    nations = table(spark, sf, "nation").select(
        F.col("n_name").alias("site"), F.lit(0.0).alias("Latitude"), F.col("n_nationkey").cast("double").alias("Longitude")
    )
    return sites.unionByName(nations)


_SITES_SQL = """sites AS (SELECT p_brand AS "Site_name", min(p_retailprice) AS "Latitude",
    max(p_retailprice) AS "Longitude" FROM part GROUP BY p_brand
    UNION ALL SELECT n_name, 0.0, n_nationkey FROM nation)"""


def combine_sites(spark, sf):
    """The three combined tables stacked, each row with its table."""
    rules, taxa, status = _taxa_tables(spark, sf)
    means = _resolved_measures(spark, sf, rules, resolved_names(status))
    tables = {
        "site": combined_sites(_sites(spark, sf)),
        "taxa": combined_taxa(resolved_taxa(taxa, status)),
        "means": combined_means(means),
    }
    return stacked(tables)


COMBINE_SQL = f"""WITH {_resolved_demography_sql()}, {_SITES_SQL}
  SELECT *, 'site' AS table_name FROM sites
  UNION ALL BY NAME SELECT * EXCLUDE (site), site AS "Site_name", 'taxa' AS table_name FROM resolved
  UNION ALL BY NAME SELECT * EXCLUDE (site), site AS "Site_name", 'means' AS table_name FROM demography"""


def merged_database(spark, sf):
    rules, _, status = _taxa_tables(spark, sf)
    names = resolved_names(status)
    means = written(combined_means(_resolved_measures(spark, sf, rules, names)), "means")
    return merged(combined_sites(_sites(spark, sf)), combined_taxa(names), means)


def full_run_query(spark, sf):
    """Every table of the full run, stacked."""
    tables = full_run(
        measures(spark, sf),
        measures(spark, sf, "medians"),
        _sites(spark, sf),
        checklist(spark, sf),
        standin.rule_book(),
    )
    return stacked(tables)


_MERGED_SQL = """SELECT s.*, r.* EXCLUDE (site), d.* EXCLUDE (site, "LCVP_Accepted_Taxon") FROM sites s
  LEFT JOIN (SELECT DISTINCT * FROM resolved) r ON r.site = s."Site_name"
  LEFT JOIN demography d ON d.site = s."Site_name"
    AND d."LCVP_Accepted_Taxon" IS NOT DISTINCT FROM r."LCVP_Accepted_Taxon" """

MERGED_SQL = f"WITH {_resolved_demography_sql()}, {_SITES_SQL} {_MERGED_SQL}"


def data_dictionary_query(spark, sf):
    """Dictionary of the site table and the resolved taxa, with the number of
    values present in each column."""
    _, taxa, status = _taxa_tables(spark, sf)
    return dictionary(
        {"site_table": combined_sites(_sites(spark, sf)), "taxa_table": combined_taxa(resolved_taxa(taxa, status))}
    )


_TAXA_VARIABLES = ("Submitted_Name", *MATCH_COLUMNS, "mismatch_test", "Site_name")


def _dictionary_rows_sql() -> str:
    parts = [
        f"""SELECT 'site_table' AS table_name, '{c}' AS variable, '{MEANINGS[c]}' AS meaning,
          count("{c}") AS n_present FROM sites"""
        for c in ("Site_name", "Latitude", "Longitude")
    ]
    for c in _TAXA_VARIABLES:
        column = "site" if c == "Site_name" else c
        parts.append(f"""SELECT 'taxa_table', '{c}', '{MEANINGS[c]}', count("{column}") FROM resolved""")
    return " UNION ALL ".join(parts)


DICTIONARY_SQL = f"WITH {standin.resolved_sql()}, {_SITES_SQL} {_dictionary_rows_sql()}"


def _stack_sql(name: str, select: str) -> str:
    return f"SELECT *, '{name}' AS table_name FROM ({select}) x"


def _full_run_sql() -> str:
    """All tables by brute force: those of the means, the medians, both kinds of
    unresolved rows, the combined tables, the merged one and the dictionary."""
    both = []
    for kind in ("means", "medians"):
        both.append(f"""m_{kind} AS (SELECT {standin.case_sql("latin")} AS Submitted_Name, sp AS Sp_Code, site,
            {MEASURES_SQL}, {_flags_sql()} FROM ({standin.source_sql(kind)}) s),
          {kind}_good AS (SELECT r."LCVP_Accepted_Taxon", m.* EXCLUDE (Submitted_Name, Sp_Code) FROM m_{kind} m
            JOIN (SELECT DISTINCT site, Submitted_Name, "LCVP_Accepted_Taxon" FROM resolved) r
              ON r.site = m.site AND r.Submitted_Name = m.Submitted_Name),
          {kind}_bad AS (SELECT DISTINCT m.* FROM m_{kind} m WHERE EXISTS (SELECT 1 FROM unresolved u
            WHERE u.site = m.site AND u.Submitted_Name IS NOT DISTINCT FROM m.Submitted_Name
            AND (u.site NOT IN (SELECT site FROM rejoined) OR u.Sp_Code = m.Sp_Code)))""")
    tables = {
        "taxa": "SELECT * FROM resolved",
        "taxa_unresolved": "SELECT * FROM unresolved",
        "means": "SELECT * FROM means_good",
        "means_unresolved": "SELECT * FROM means_bad",
        "medians": "SELECT * FROM medians_good",
        "medians_unresolved": "SELECT * FROM medians_bad",
        "site_table": "SELECT * FROM sites",
        "taxa_table": 'SELECT * EXCLUDE (site), site AS "Site_name" FROM resolved',
        "means_table": 'SELECT * EXCLUDE (site), site AS "Site_name" FROM means_good',
        "merged": _MERGED_SQL.replace("LEFT JOIN demography", "LEFT JOIN means_good"),
    }
    parts = [_stack_sql(name, select) for name, select in tables.items()]
    # The dictionary names its own tables; in the stack it is one table itself.
    parts.append(_stack_sql("dictionary", f"SELECT * EXCLUDE (table_name) FROM ({_dictionary_rows_sql()}) y"))
    return f"WITH {standin.unresolved_sql()}, {', '.join(both)}, {_SITES_SQL} " + " UNION ALL BY NAME ".join(parts)


FULL_RUN_SQL = _full_run_sql()


def text_table_scan(spark, sf):
    """The source table written as whitespace-delimited text, in two orders of
    the columns, and read back."""
    rows = measures(spark, sf)
    path = scratch_path(spark, "text-table")
    first = F.col("site") < "Brand#3"
    for part, columns in ((rows.filter(first), rows.columns), (rows.filter(~first), rows.columns[::-1])):
        part.select(*[f"`{c}`" for c in columns]).write.mode("append").csv(path, sep=" ", header=True, nullValue="NA")
    return read_table(spark, path, rows.schema)


# The text "NA" reads back as missing: this format has no other mark for it.
TEXT_TABLE_SQL = f"SELECT * REPLACE (NULLIF(latin, 'NA') AS latin) FROM ({standin.source_sql()}) s"


def csv_round_trip(spark, sf):
    rows = submitted_taxa(standin.source_rows(spark, sf), standin.rule_book())
    rows = rows.withColumn("IDlevel", F.concat(F.lit('"'), "IDlevel", F.lit('", \\')))
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


CSV_SQL = f"""WITH {standin.taxa_sql()} SELECT * REPLACE (NULLIF(Submitted_Name, 'NA') AS Submitted_Name,
  '"' || "IDlevel" || '", ' || chr(92) AS "IDlevel") FROM taxa"""


def multi_file_scan(spark, sf):
    """Four tables in one folder, two of them wanted, one without a column and
    one with a column that the schema does not name."""
    rows = submitted_taxa(standin.source_rows(spark, sf)).fillna("none", ["Submitted_Name"])
    folder = scratch_path(spark, "tables")
    low = F.col("Submitted_Family").isin("ECONOMY", "PROMO", "SMALL")
    write_csv(rows.filter(low), f"{folder}/a_taxa.csv")
    write_csv(rows.filter(~low).drop("IDlevel").withColumn("remark", F.lit("b")), f"{folder}/b_taxa.csv")
    write_csv(rows.filter(low), f"{folder}/a_taxa_unresvd.csv")
    write_csv(rows, f"{folder}/a_means.csv")
    return read_csv_set(spark, folder, "taxa", r"unresvd\.csv", rows.schema)


MULTI_FILE_SQL = f"""SELECT NULLIF(COALESCE(latin, 'none'), 'NA') AS Submitted_Name, sp AS Sp_Code,
  genus AS Submitted_Genus, family AS Submitted_Family,
  CASE WHEN family IN ('ECONOMY', 'PROMO', 'SMALL') THEN "IDlevel" END AS "IDlevel", site,
  CASE WHEN NOT COALESCE(family IN ('ECONOMY', 'PROMO', 'SMALL'), FALSE) THEN 'b' END AS remark
  FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in standin._SOURCE_COLUMNS.items())} FROM part) s"""


def split_sink(spark, sf):
    """Names written in one pass, split by outcome and site, and read back."""
    status = _taxa_tables(spark, sf)[2].select("Submitted_Name", "n_rows", "issue", "outcome", "site")
    path = scratch_path(spark, "split")
    write_split(status, path)
    schema = "Submitted_Name string, n_rows bigint, issue string, outcome string, site string"
    return spark.read.csv(path, header=True, schema=schema, nullValue="NA")


SPLIT_SINK_SQL = f"""WITH {standin.status_sql()}
  SELECT NULLIF(Submitted_Name, 'NA') AS Submitted_Name, n_rows, issue, outcome, site FROM status"""


def rerun_site(spark, sf):
    """Names of all sites written, one site written again without what was not
    resolved, and all read back."""
    status = _taxa_tables(spark, sf)[2].select("Submitted_Name", "n_rows", "issue", "outcome", "site")
    path = scratch_path(spark, "sites")
    write_split(status, path)
    again = status.filter("outcome = 'resolved'").withColumn("n_rows", F.col("n_rows") + 100)
    write_split(again, path, sites=["Brand#11"])
    schema = "Submitted_Name string, n_rows bigint, issue string, outcome string, site string"
    return spark.read.csv(path, header=True, schema=schema, nullValue="NA")


RERUN_SITE_SQL = f"""WITH {standin.status_sql()}
  SELECT NULLIF(Submitted_Name, 'NA') AS Submitted_Name, n_rows + CASE WHEN site = 'Brand#11' THEN 100 ELSE 0 END AS n_rows,
    issue, outcome, site FROM status WHERE site <> 'Brand#11' OR outcome = 'resolved'"""


def database_read_back(spark, sf):
    """Every table of the full run, written as the database and read back from it."""
    tables = full_run(
        measures(spark, sf),
        measures(spark, sf, "medians"),
        _sites(spark, sf),
        checklist(spark, sf),
        standin.rule_book(),
    )
    path = scratch_path(spark, "database")
    write_database(tables, path)
    return stacked(read_database(spark, path, {name: t.schema for name, t in tables.items()}))


READ_BACK_SQL = f"SELECT * REPLACE (NULLIF(Submitted_Name, 'NA') AS Submitted_Name) FROM ({FULL_RUN_SQL}) t"


QUERIES = {
    "coordinate_check": (coordinate_check, COORDINATE_SQL),
    "measure_flags": (measure_flags, MEASURE_FLAGS_SQL),
    "ci_widths": (ci_widths, CI_WIDTHS_SQL),
    "obs_vs_width_long": (obs_vs_width_long, OBS_WIDTH_SQL),
    "demography_resolved": (
        demography_resolved_query,
        f"WITH {_resolved_demography_sql()} SELECT * FROM demography",
    ),
    "medians_resolved": (medians_resolved, f"WITH {_resolved_demography_sql('medians')} SELECT * FROM demography"),
    "demography_unresolved": (demography_unresolved_query, DEMOGRAPHY_UNRESOLVED_SQL),
    "second_source_taxa": (second_source_taxa_query, SECOND_TAXA_SQL),
    "second_source_demography": (second_source_demography_query, SECOND_DEMOGRAPHY_SQL),
    "profile_measures": (profile_measures, PROFILE_SQL),
    "combine_sites": (combine_sites, COMBINE_SQL),
    "merged_database": (merged_database, MERGED_SQL),
    "full_run": (full_run_query, FULL_RUN_SQL),
    "data_dictionary": (data_dictionary_query, DICTIONARY_SQL),
    "text_table_scan": (text_table_scan, TEXT_TABLE_SQL),
    "csv_round_trip": (csv_round_trip, CSV_SQL),
    "multi_file_scan": (multi_file_scan, MULTI_FILE_SQL),
    "split_sink": (split_sink, SPLIT_SINK_SQL),
    "rerun_site": (rerun_site, RERUN_SITE_SQL),
    "database_read_back": (database_read_back, READ_BACK_SQL),
}
