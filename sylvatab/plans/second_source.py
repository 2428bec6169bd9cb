"""A second source for one site: names in two columns, exact search first,
then a wider one for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.functions.text import paste_na
from sylvatab.operators.joins import keep_all_right, natural_join
from sylvatab.operators.resolve import Index, fuzzy_candidates, index_checklist, resolve_names
from sylvatab.operators.sets import set_difference, union_by_name
from sylvatab.operators.skew import match_join, quoted
from sylvatab.operators.summaries import column_run, count_by
from sylvatab.sources.tables import written


def binomials(source: DataFrame) -> DataFrame:
    """The distinct names as given, with the pasted binomial."""
    names = source.select(F.col("Genus").alias("Genus_author"), F.col("Species").alias("Species_author"))
    return names.distinct().withColumn("Submitted_Name", paste_na(F.col("Genus_author"), F.col("Species_author")))


def second_source_taxa(
    source: DataFrame, checklist: DataFrame | Index, retry_distance: float = 5, max_candidates: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(resolved names, names for review).

    A name is resolved when the exact search finds it and reports the match as
    identical, or when the wider search offers no more than ``max_candidates``
    entries. The others are listed with the number of candidates, 0 for none.
    """
    # Both searches read one index, and both results are read from the two
    # searches, so each is written once.
    index = checklist if isinstance(checklist, Index) else index_checklist(checklist, retry_distance)
    names = binomials(source)
    exact = written(resolve_names(names, index, max_distance=0).drop("distance"), "exact-matches")
    identical = exact.filter(F.col("`PL.comparison`") == "identical").withColumn("search", F.lit("exact"))
    others = set_difference(names.select("Submitted_Name"), identical.select("Submitted_Name"))
    wider = written(fuzzy_candidates(others, index, retry_distance).drop("distance"), "wider-matches")
    counts = count_by(wider, "Submitted_Name")
    few = counts.filter(F.col("n") <= max_candidates).drop("n")
    fuzzy = match_join(wider, few, ["Submitted_Name"], "left_semi").withColumn("search", F.lit("fuzzy"))
    resolved = natural_join(union_by_name(identical, fuzzy), names)
    review = others.join(counts, "Submitted_Name", "left").fillna(0, ["n"])
    review = review.filter((F.col("n") == 0) | (F.col("n") > max_candidates))
    return resolved, review.withColumnRenamed("n", "candidates")


def second_source_demography(source: DataFrame, resolved: DataFrame, site_name: str) -> DataFrame:
    """Measurements of the resolved names; a resolved name without any is kept."""
    columns = [*column_run(source, "mu1_1", "mu4_1"), *column_run(source, "G1_1", "G4_1"), "F_1", "SampleSize"]
    measures = source.select(
        *quoted(columns), paste_na(F.col("Genus"), F.col("Species")).alias("Submitted_Name")
    )
    names = resolved.select(
        "Submitted_Name", F.col("Genus_author").alias("Genus"), F.col("Species_author").alias("Species")
    ).distinct()
    return keep_all_right(measures, names).withColumn("Site_name", F.lit(site_name))
