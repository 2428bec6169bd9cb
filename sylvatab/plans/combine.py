"""All sites in one database, and the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sylvatab.operators.sets import union_by_name
from sylvatab.operators.skew import quoted, skew_join
from sylvatab.plans.demography import (
    demography_resolved,
    demography_unresolved,
    measure_columns,
    with_imputed_flags,
)
from sylvatab.plans.rules import RuleBook
from sylvatab.plans.taxa import name_status, resolved_names, resolved_taxa, submitted_taxa, unresolved_taxa
from sylvatab.sources.tables import completeness, data_dictionary, read_csv, write_csv, write_split, written

#: Tables that are split by outcome and site, and those of all sites in one.
SPLIT = ("means", "medians", "taxa")
COMBINED = ("site_table", "taxa_table", "means_table", "merged", "dictionary")

# Meanings of the columns of the finished tables.
MEANINGS = {
    "Submitted_Name": "Name of the taxon as given in the source file",
    "First_matched_Name": "Checklist name nearest to the submitted name",
    "Status": "Status of the matched name: accepted, synonym, unresolved or external",
    "PL.comparison": "How the match compares with a second plant list: identical, synonym, other "
    "synonym, different authors, missing, misspelling or unresolved",
    "PL.alternative": "Alternative name in the second plant list",
    "LCVP_Accepted_Taxon": "Accepted name of the taxon",
    "Family": "Family of the taxon",
    "Order": "Order of the taxon",
    "mismatch_test": "Does the matched name contain the submitted one; false marks a typing error "
    "that the search could resolve",
    "Site_name": "Code of the site, the key of the site table",
    "Latitude": "Latitude in degrees",
    "Longitude": "Longitude in degrees",
    "Sp_Code": "Species code as given in the source file",
    "Submitted_Genus": "Genus as given in the source file",
    "Submitted_Family": "Family as given in the source file",
    "IDlevel": "How far the taxon was identified, as given in the source file",
    "site": "Code of the site",
    "issue": "Why the name is not resolved",
}


def combined_sites(sites: DataFrame) -> DataFrame:
    """Site table keyed by the site code, which taxa and measurements use too."""
    return sites.select(F.col("site").alias("Site_name"), "Latitude", "Longitude")


def combined_taxa(resolved: DataFrame) -> DataFrame:
    return resolved.withColumnRenamed("site", "Site_name")


def combined_means(demography: DataFrame) -> DataFrame:
    return demography.withColumnRenamed("site", "Site_name")


def merged(sites: DataFrame, taxa: DataFrame, means: DataFrame) -> DataFrame:
    """Site, then taxa, then measurements; every site and every taxon stays.

    A taxon counts once, however often its name was submitted: a name submitted
    k times has k measurements, not k times k. Driven by the measurements, the
    only table with many rows; then come taxa without any, and sites without
    taxa.
    """
    taxa = written(taxa.distinct(), "merged-taxa")
    key = ["Site_name", "LCVP_Accepted_Taxon"]
    measured = skew_join(skew_join(means, taxa, key), sites, ["Site_name"])
    bare = skew_join(taxa, means.select(*key).distinct(), key, "left_anti")
    empty = skew_join(sites, taxa.select("Site_name").distinct(), ["Site_name"], "left_anti")
    out = measured.unionByName(skew_join(bare, sites, ["Site_name"]), allowMissingColumns=True)
    out = out.unionByName(empty, allowMissingColumns=True)
    rest = [c for c in means.columns if c not in key]
    return out.select(*quoted(sites.columns), *quoted([c for c in taxa.columns if c != "Site_name"]), *quoted(rest))


def dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """Name, meaning and number of present values of each column of the tables."""
    parts = [
        data_dictionary(t, MEANINGS).join(completeness(t), "variable").select(F.lit(name).alias("table_name"), "*")
        for name, t in tables.items()
    ]
    return union_by_name(*parts)


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables in one, each row with its table's name; columns that a table
    lacks are null."""
    return union_by_name(*[t.withColumn("table_name", F.lit(name)) for name, t in tables.items()])


def full_run(
    means: DataFrame, medians: DataFrame, sites: DataFrame, checklist: DataFrame, rules: RuleBook
) -> dict[str, DataFrame]:
    """All tables of the database for all sites at once.

    What several tables need is written once and read back: the status of each
    name, and the resolved measurements. Nothing else is computed until a table
    is used.
    """
    taxa = submitted_taxa(means, rules)
    status = written(name_status(taxa, checklist, rules), "name-status")
    resolved, unresolved = resolved_taxa(taxa, status), unresolved_taxa(taxa, status, rules)
    names = resolved_names(status)
    tables = {"taxa": resolved, "taxa_unresolved": unresolved}
    keys = unresolved.select("site", "Submitted_Name", "Sp_Code")
    for kind, source in (("means", means), ("medians", medians)):
        columns = measure_columns(source, rules)
        tables[kind] = with_imputed_flags(demography_resolved(columns, names))
        if kind == "means":
            tables[kind] = written(tables[kind], "means")
        tables[f"{kind}_unresolved"] = with_imputed_flags(demography_unresolved(columns, keys, rules))
    tables["site_table"] = combined_sites(sites)
    tables["taxa_table"] = combined_taxa(resolved)
    tables["means_table"] = combined_means(tables["means"])
    tables["merged"] = merged(tables["site_table"], combined_taxa(names), tables["means_table"])
    tables["dictionary"] = dictionary({name: tables[name] for name in ("site_table", "taxa_table")})
    return tables


def write_database(tables: dict[str, DataFrame], path: str, sites: list[str] | None = None) -> None:
    """Resolved and unresolved tables split by outcome and site; the combined
    tables beside them. With ``sites`` only these sites' folders are written anew:
    the combined tables are then made of what :func:`read_database` reads."""
    for kind in SPLIT:
        good = tables[kind].withColumn("outcome", F.lit("resolved"))
        bad = tables[f"{kind}_unresolved"].withColumn("outcome", F.lit("unresolved"))
        write_split(good.unionByName(bad, allowMissingColumns=True), f"{path}/{kind}", sites=sites)
    for kind in COMBINED if sites is None else ():
        write_csv(tables[kind], f"{path}/full/{kind}")


def read_database(spark: SparkSession, path: str, columns: dict[str, StructType]) -> dict[str, DataFrame]:
    """The tables of a written database by name, with these columns: those of
    all sites from their folders, and the combined ones."""
    found = {}
    for name, schema in columns.items():
        if name in COMBINED:
            found[name] = read_csv(spark, f"{path}/full/{name}", schema)
            continue
        kind = name.removesuffix("_unresolved")
        outcome = "resolved" if name == kind else "unresolved"
        # A folder's columns stand in the order they were written in.
        own, other = columns[kind].fields, columns[f"{kind}_unresolved"].fields
        fields = [*own, *(f for f in other if f.name not in columns[kind].names)]
        split = StructType([*(f for f in fields if f.name != "site"), StructField("outcome", StringType()), columns[kind]["site"]])
        rows = read_csv(spark, f"{path}/{kind}", split).filter(F.col("outcome") == outcome)
        found[name] = rows.select(*quoted(schema.names))
    return found


def combine_written(tables: dict[str, DataFrame], sites: DataFrame, path: str) -> None:
    """The combined tables made anew of the sites' tables that were read back."""
    taxa, means = tables["taxa"], tables["means"]
    whole = {
        "site_table": combined_sites(sites),
        "taxa_table": combined_taxa(taxa),
        "means_table": combined_means(means),
    }
    whole["merged"] = merged(whole["site_table"], whole["taxa_table"], whole["means_table"])
    whole["dictionary"] = dictionary({name: whole[name] for name in ("site_table", "taxa_table")})
    for kind in COMBINED:
        write_csv(whole[kind], f"{path}/full/{kind}")
