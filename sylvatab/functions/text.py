"""Column expressions for names. All of them are built-in functions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squish(text: Column) -> Column:
    """Trim, and reduce every run of white space to one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def paste_na(*parts: Column, sep: str = " ") -> Column:
    """Concatenate with a separator; a null part becomes the text ``NA``."""
    pieces = [F.coalesce(p.cast("string"), F.lit("NA")) for p in parts]
    return F.concat(*reduce(lambda acc, p: [*acc, F.lit(sep), p], pieces[1:], pieces[:1]))


def title_genus(name: Column, lower_first: bool = False) -> Column:
    """Capitalise the first word (first letter upper, the rest lower; a hyphen
    does not start a word) and paste the remainder back on.

    A one-word name has no remainder and a null name has neither part, so they
    come out as ``"Foo NA"`` and ``"NA NA"``.
    """
    source = F.lower(name) if lower_first else name
    parts = F.split(source, " ", 2)
    return paste_na(F.initcap(F.try_element_at(parts, F.lit(1))), F.try_element_at(parts, F.lit(2)))


def normalise_name_case(
    df: DataFrame,
    name: str = "Submitted_Name",
    site: str = "site",
    case_rules: dict[str, str] | None = None,
) -> DataFrame:
    """Apply each site's case rule to ``name``; sites without a rule keep it as is.

    ``case_rules`` maps a site to ``"genus"`` or ``"lower_genus"``. Without it
    every row gets the genus rule.
    """
    raw = F.col(name)
    if case_rules is None:
        return df.withColumn(name, title_genus(raw))
    genus = sorted(s for s, rule in case_rules.items() if rule == "genus")
    lowered = sorted(s for s, rule in case_rules.items() if rule == "lower_genus")
    out = F.when(F.col(site).isin(genus), title_genus(raw))
    out = out.when(F.col(site).isin(lowered), title_genus(raw, lower_first=True))
    return df.withColumn(name, out.otherwise(raw))


def mentions(text: Column, name: Column, regex: bool = False) -> Column:
    """Does ``text`` contain ``name``; null when either is null.

    The literal test is the default because a name such as ``a(b`` is not a
    valid pattern.
    """
    return F.rlike(text, name) if regex else F.contains(text, name)


def prints_with_zero(number: Column, exact_zero: bool = False) -> Column:
    """Does the printed number start with 0 (``0`` and ``0.5`` do); never null.

    ``exact_zero`` tests the number itself for 0.
    """
    test = (number == 0) if exact_zero else F.startswith(number.cast("string"), F.lit("0"))
    return F.coalesce(test, F.lit(False))
