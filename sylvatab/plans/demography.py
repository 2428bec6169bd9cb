"""Measurements of resolved and unresolved names, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvatab.functions.text import normalise_name_case, prints_with_zero
from sylvatab.operators.skew import quoted, skew_join
from sylvatab.plans import rules as k
from sylvatab.plans.rules import RuleBook

# The measures that come per canopy layer.
MEASURES = ("growth", "survival")
LAYERS = (1, 2, 3, 4)


def measure_columns(measures: DataFrame, rules: RuleBook | None = None) -> DataFrame:
    """Measurements keyed by submitted name and species code, names in the case
    their site uses."""
    out = measures.drop("genus", "family", "IDlevel")
    out = out.withColumnsRenamed({"latin": "Submitted_Name", "sp": "Sp_Code"})
    return normalise_name_case(out, case_rules=rules.modes(k.CASE)) if rules else out


def demography_resolved(measures: DataFrame, resolved: DataFrame) -> DataFrame:
    """Measurements under the accepted name; the submitted name and code go."""
    # A name that is submitted several times is one key, not one for each time.
    names = resolved.select("site", "Submitted_Name", "LCVP_Accepted_Taxon").distinct()
    joined = skew_join(measures, names, ["site", "Submitted_Name"], "inner")
    rest = [c for c in measures.columns if c not in ("site", "Submitted_Name", "Sp_Code")]
    return joined.select("LCVP_Accepted_Taxon", "site", *quoted(rest))


def demography_unresolved(
    measures: DataFrame, unresolved: DataFrame, rules: RuleBook | None = None
) -> DataFrame:
    """Measurements of unresolved names with their own species code, each row once.

    The key is the name, because labelled duplicates carry no code, and the code
    as well at sites whose rules rejoin it. Joining and then taking distinct
    measurement rows is a semi-join.
    """
    rejoined = list(rules.modes(k.CODES)) if rules else []
    code = F.when(F.col("site").isin(rejoined), F.col("Sp_Code"))
    names = unresolved.select("site", "Submitted_Name", code.alias("key_code")).distinct()
    keyed = measures.withColumn("key_code", code)
    out = skew_join(keyed, names, ["site", "Submitted_Name", "key_code"], "left_semi")
    first = ["Submitted_Name", "Sp_Code", "site"]
    rest = [c for c in measures.columns if c not in first]
    # Dealt out by the whole row, so that the join's hot keys can be split.
    whole = out.select(*first, *quoted(rest))
    return whole.repartition(*quoted(whole.columns)).distinct()


def with_imputed_flags(measures: DataFrame, exact_zero: bool = False) -> DataFrame:
    """Was the value imputed: the sample size printed starts with 0."""
    return measures.withColumns(
        {
            f"{m}_layer_{i}_imputed": prints_with_zero(F.col(f"{m}_layer_{i}_obs"), exact_zero)
            for m in MEASURES
            for i in LAYERS
        }
    )


def with_interval_widths(measures: DataFrame) -> DataFrame:
    """Width of the 90 % interval per measure and layer."""
    return measures.withColumns(
        {
            f"{m}_layer_{i}_CI90_width": F.col(f"`{m}_layer{i}_CI.95`") - F.col(f"`{m}_layer{i}_CI.05`")
            for m in MEASURES
            for i in LAYERS
        }
    )


def size_and_width(measures: DataFrame, keys: list[str], exact_zero: bool = False) -> DataFrame:
    """Sample size against interval width in long form, rows with imputed
    values left out. One pass: each row is unfolded in place."""
    flagged = with_interval_widths(with_imputed_flags(measures, exact_zero))
    cells = [
        F.struct(
            F.lit(m).alias("measure"),
            F.lit(i).alias("layer"),
            F.col(f"{m}_layer_{i}_obs").alias("obs"),
            F.col(f"{m}_layer_{i}_CI90_width").alias("width"),
            F.col(f"{m}_layer_{i}_imputed").alias("imputed"),
        )
        for m in MEASURES
        for i in LAYERS
    ]
    long = flagged.select(*quoted(keys), F.inline(F.array(*cells)))
    return long.filter(~F.col("imputed")).drop("imputed")
