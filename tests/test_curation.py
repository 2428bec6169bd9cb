"""Curation of a small table that has a case for each rule of the 13 sites."""

import re
import time

import pytest
from pyspark.sql import functions as F

from sylvatab.operators.skew import match_join
from sylvatab.plans import rules as k
from sylvatab.plans.combine import combined_means, combined_sites, combined_taxa, full_run, merged, write_database
from sylvatab.plans.demography import (
    demography_resolved,
    demography_unresolved,
    measure_columns,
    size_and_width,
    with_imputed_flags,
    with_interval_widths,
)
from sylvatab.plans.profile import check_coordinates, profile
from sylvatab.plans.rules import Rule, RuleBook, java_pattern, read_rules, required_text
from sylvatab.plans.second_source import second_source_demography, second_source_taxa
from sylvatab.plans.site_rules import PATTERNS, YASUNI_NAMES, site_rules, site_table
from sylvatab.plans.taxa import (
    apply_override,
    assemble_unresolved,
    exclude_names,
    name_status,
    override_targets,
    quarantine_by_list,
    quarantine_by_pattern,
    resolve_with_test,
    resolved_taxa,
    review_list,
    site_extract,
    split_missing,
    submitted_taxa,
    triage_duplicates,
    unmatched_by_code,
    unmatched_by_name,
    unresolved_taxa,
)
from test_resolve import SCHEMA, entry

CHECKLIST = [
    entry("Casearia grewiifolia Vent."),
    entry("Casearia grewifolia Foo", "synonym", "Casearia grewiifolia Vent."),
    entry("Ficus variegata Blume"),
    entry("Ficus racemosa L."),
    entry("Shorea macroptera subsp. macroptera Dyer"),
    entry("Cinnamomum bahianum Lukman."),
    entry("Cinnamomum tahijanum Kosterm."),
    entry("Xanthophyllum affine Korth."),
    entry("Neea gigantea Foo", "accepted"),
    entry("Sterculia hispidissima Ridl.", "unresolved", "unresolved"),
    entry("Eugenia spicata Lam.", "unresolved", "unresolved"),
    entry("Celtis formosana Hayata"),
    entry("Tapirira guianensis Aubl."),
    entry("Tapirira guianensiz Foo", "synonym", "Tapirira guianensis Aubl."),
]

# site, name, code; what becomes of it
ROWS = [
    ("fushan", "Ficus racemosa", "f1", "resolved", None),
    ("hkk", "Casearia grewiifolia", "h1", "unresolved", "double count"),
    ("hkk", "Casearia grewifolia", "h2", "unresolved", "double count"),
    ("hkk", "Ficus racemosa", "h3", "resolved", None),  # duplicates without a rule are kept here
    ("hkk", "Ficus racemosa", "h4", "resolved", None),
    ("hkk", "Ficus cf. racemosa", "h5", "unresolved", "not in LCVP"),
    ("hkk", None, "h6", "unresolved", "not in LCVP"),
    ("korup", "Ficus sp.", "k1", "unresolved", "not in LCVP"),
    ("korup", "Ficus variegataa", "k2", "resolved", None),  # a typing error that stays
    ("korup", "Unidentified .", "k3", "unresolved", "not in LCVP"),
    ("korup", "Unidentified .", "k4", "unresolved", "not in LCVP"),
    ("lambir", "Shorea macroptera subsp. macroptera", "l1", "unresolved", "not in LCVP"),
    ("lambir", "Cinnamomum tahyanum", "l2", "resolved", None),
    ("lambir", "Xanthophyllum affine", "l3", "resolved", None),  # an exact match is not searched for "aff."
    ("lambir", "Ficus racemosa cf.", "l4", "unresolved", "not in LCVP"),
    ("luquillo", "ficus racemosa", "q1", "resolved", None),
    ("luquillo", None, "q2", "unresolved", "not in LCVP"),
    ("nanjenshan", "NA", "celtfo", "unresolved", "not in LCVP"),
    ("nanjenshan", "NA", "celtfo", "unresolved", "not in LCVP"),
    ("nanjenshan", "celtis formosana", "n1", "resolved", None),
    ("palanan", "Ficus variegata", "p1", "unresolved", "double count"),
    ("palanan", "Ficus variegata", "p2", "unresolved", "double count"),
    ("pasoh", "STERCULIA HISPIDISSIMA", "s1", "unresolved", "in LCVP unresvd"),
    ("pasoh", "Eugenia spicata", "s2", "unresolved", "in LCVP unresvd"),
    ("pasoh", "Ficus racemosa", "s3", "unresolved", "synonym"),
    ("pasoh", "Ficus racemosaa", "s4", "unresolved", "synonym"),
    ("yasuni", "Neea gigante", "y1", "unresolved", "not in LCVP"),  # on the list, though it has a match
    ("yasuni", "Tapirira guianensis", "y2", "unresolved", "synonym"),
    ("yasuni", "Tapirira guianensiz", "y3", "unresolved", "synonym"),
    ("ituri_edoro", "Ficus xx", "e1", "unresolved", "not in LCVP"),
    ("bci", "Piper", "b1", "unresolved", "not in LCVP"),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def checklist(spark):
    return spark.createDataFrame(CHECKLIST, SCHEMA)


@pytest.fixture(scope="module")
def means(spark):
    df = spark.createDataFrame(
        [(site, name, code, "genus", "family", "species") for site, name, code, _, _ in ROWS],
        "site string, latin string, sp string, genus string, family string, IDlevel string",
    )
    out = df
    for m in ("growth", "survival"):
        for i in range(1, 5):
            out = out.withColumn(f"{m}_layer_{i}_obs", F.lit(float(10 * (i - 1)) if m == "growth" else 0.5 * i))
            out = out.withColumn(f"{m}_layer{i}_CI.05", F.lit(1.0)).withColumn(f"{m}_layer{i}_CI.95", F.lit(1.0 + i))
    return out.withColumn("rate", F.length("sp").cast("double"))


@pytest.fixture(scope="module")
def done(spark, means, checklist):
    taxa = submitted_taxa(means, site_rules())
    return taxa, name_status(taxa, checklist, site_rules()).cache()


def test_rules_hold_what_the_sites_need():
    book = site_rules()
    assert len(YASUNI_NAMES.strip().splitlines()) == 66
    assert len(PATTERNS) == 9 and len(book.of(k.APPEND)) == 12
    assert book.modes(k.CASE)["pasoh"] == "lower_genus"
    assert java_pattern("sp[[:punct:]]") == r"sp[\p{Punct}]"


def test_rule_table_round_trip(spark):
    table = spark.createDataFrame(
        [tuple(r) for r in site_rules().rules],
        "site string, rule string, value string, on_mismatch_only boolean, target string",
    )
    assert sorted(map(repr, read_rules(table).rules)) == sorted(map(repr, site_rules().rules))


def test_contradicting_rules_are_refused(spark):
    with pytest.raises(ValueError):
        RuleBook((Rule("a", k.CASE, "genus"), Rule("a", k.CASE, "lower_genus"))).modes(k.CASE)
    two = RuleBook((Rule("a", k.OVERRIDE, "x", target="p"), Rule("a", k.OVERRIDE, "x", target="q")))
    with pytest.raises(ValueError):
        two.table(spark, (k.OVERRIDE,), "Submitted_Name")


def test_posix_classes(spark):
    assert java_pattern("sp[[:digit:][:space:]]") == r"sp[\p{Digit}\p{Space}]"
    hits = spark.createDataFrame([("abc sp1",), ("abc sp:",), ("abc spd",)], "n string")
    assert [r.n for r in hits.filter(hits.n.rlike(java_pattern("sp[[:digit:]]"))).collect()] == ["abc sp1"]
    with pytest.raises(ValueError):
        java_pattern("[[:vowel:]]")


def test_thousands_of_pattern_rules(spark):
    book = RuleBook(tuple(Rule("a", k.PATTERN, f"sp{i}$", i % 2 == 1) for i in range(5000)))
    names = spark.createDataFrame(
        [("a", "x sp10", True), ("a", "x sp11", True), ("a", "x sp11", False), ("b", "x sp10", False), ("a", None, None)],
        "site string, n string, found boolean",
    )
    out = book.with_pattern_hit(names, "n", ~F.col("found"), "hit")
    assert [r.hit for r in out.orderBy("site", F.col("n").desc_nulls_last(), "found").collect()] == [
        True, False, True, False, False,
    ]


@pytest.mark.parametrize(
    "pattern, text",
    [
        ("Shorea mac", "Shorea mac"), ("xx|aa", ""), ("sp[.]", "sp."), (r"sp\.", "sp."), ("abc?def", "def"), ("a(b", ""),
        ("(abc|d)efg+hi", "ef"), ("^Ficus (c|d)arica$", "Ficus "), ("(abcd){2}xyz", "abcd"), ("x{0,3}yz", "yz"),
        ("(?i)ficus", ""), ("a[[:punct:]]", ""), (r"\bficus", ""), ("", ""),
    ],
)
def test_text_that_a_pattern_requires(pattern, text):
    assert required_text(pattern) == text


def test_patterns_like_one_by_one(spark):
    """Indexed and scanned patterns, of both kinds, at several sites."""
    patterns = ["Ficus c", "ca+rica$", "xx|aa", "sp[.]1", "^Aus (b|c)us", "a", "us b", "[[:digit:]]{2}", "é ü", "carica"]
    rules = [Rule("ab"[i % 2], k.PATTERN, p, i % 3 == 0) for i, p in enumerate(patterns)] + [Rule("c", k.PATTERN, "Aus")]
    values = ["Ficus carica", "Ficus caarica", "xx", "Aus sp.1", "Aus bus", "us b", "é ü", "12", "", None, "a", "nothing"]
    given = [(s, v, f) for s in "abcd" for v in values for f in (True, False, None)]
    names = spark.createDataFrame(given, "site string, n string, found boolean")
    out = RuleBook(tuple(rules)).with_pattern_hit(names, "n", ~F.col("found"), "hit")
    assert out.columns == [*names.columns, "hit"]

    def hit(site, name, found):
        mine = [r for r in rules if r.site == site and name is not None]
        return any(re.search(r.value.replace("[[:digit:]]", "[0-9]"), name) and (not r.on_mismatch_only or found is False) for r in mine)

    assert rows(out) == sorted(((*g, hit(*g)) for g in given), key=repr)


def test_patterns_cost_like_a_literal_filter(spark):
    """5,000 patterns and 100,000 names: each name meets the patterns whose text it holds."""
    book = RuleBook(tuple(Rule("a", k.PATTERN, f"^Aus b{i:05d}(us|um)?$") for i in range(5000)))
    names = spark.range(100_000).selectExpr("'a' AS site", "concat('Aus b', lpad(string(id * 7 % 100000), 5, '0'), 'us') AS n")
    start = time.perf_counter()
    out = book.with_pattern_hit(names, "n", F.lit(False), "hit")
    assert out.filter("hit").count() == 5000
    assert time.perf_counter() - start < 30


def test_a_name_with_very_many_rows(spark, done):
    taxa, status = done
    many = status.withColumn("n_rows", F.lit(3_000_000_000))
    assert resolved_taxa(taxa, many).count() == resolved_taxa(taxa, status).count()


def test_each_name_ends_where_it_should(done):
    taxa, status = done
    by_row = match_join(taxa, status, ["site", "Submitted_Name"]).select("site", "Sp_Code", "outcome", "issue")
    assert rows(by_row) == sorted(((s, c, o, i) for s, _, c, o, i in ROWS), key=repr)


def test_every_submitted_row_is_counted_once(done):
    taxa, status = done
    assert status.agg(F.sum("n_rows")).first()[0] == taxa.count() == len(ROWS)
    assert status.groupBy("site", "Submitted_Name").count().filter("count > 1").count() == 0


def test_override_and_typing_error(done):
    found = {(r["site"], r["Submitted_Name"]): r for r in resolved_taxa(*done).collect()}
    assert found["lambir", "Cinnamomum tahyanum"]["First_matched_Name"] == "Cinnamomum tahijanum Kosterm."
    typo = found["korup", "Ficus variegataa"]
    assert typo["LCVP_Accepted_Taxon"] == "Ficus variegata Blume" and typo["mismatch_test"] is False
    assert found["luquillo", "Ficus racemosa"]["mismatch_test"] is True


def test_override_without_its_candidate_is_no_match(spark, means, checklist):
    book = RuleBook((Rule("fushan", k.OVERRIDE, "Ficus racemosa", target="Ficus absent L."),))
    status = name_status(submitted_taxa(means).filter("site = 'fushan'"), checklist, book)
    assert [r["issue"] for r in status.collect()] == ["not in LCVP"]


def test_kept_duplicates_come_once_per_submitted_row(done):
    kept = resolved_taxa(*done).filter("site = 'hkk'")
    assert [r["Submitted_Name"] for r in kept.collect()] == ["Ficus racemosa"] * 2


def test_unresolved_table(done):
    taxa, status = done
    out = unresolved_taxa(taxa, status, site_rules())
    assert out.filter("site = 'fushan'").count() == 0
    listed = {(r["site"], r["Submitted_Name"], r["Sp_Code"], r["issue"]) for r in out.collect()}
    assert ("korup", "Unidentified .", "k3", "not in LCVP") in listed
    assert ("korup", "Unidentified .", "k4", "not in LCVP") in listed
    assert ("luquillo", "NA NA", "q2", "not in LCVP") in listed
    # A duplicate has its search result but no code, and so comes once.
    assert [x for x in listed if x[0] == "palanan"] == [("palanan", "Ficus variegata", None, "double count")]
    same = out.filter("site = 'nanjenshan'")
    assert rows(same.select("Submitted_Name", "Sp_Code")) == [("Na NA", "celtfo")]


def test_code_rejoined_where_the_rules_say_so(spark, means, checklist):
    book = RuleBook((Rule("palanan", k.CODES, "rejoin"),))
    taxa = submitted_taxa(means).filter("site = 'palanan'")
    out = unresolved_taxa(taxa, name_status(taxa, checklist, book), book)
    assert rows(out.select("Sp_Code", "issue")) == [("p1", "synonym"), ("p2", "synonym")]


def test_demography_follows_the_names(done, means):
    taxa, status = done
    columns = measure_columns(means, site_rules())
    good = demography_resolved(columns, resolved_taxa(taxa, status))
    assert good.columns[:2] == ["LCVP_Accepted_Taxon", "site"] and "Sp_Code" not in good.columns
    # Two kept rows of one name have two measurement rows, one each.
    assert good.filter("site = 'hkk'").count() == 2
    assert good.filter("site = 'luquillo'").count() == 1
    bad = demography_unresolved(columns, unresolved_taxa(taxa, status, site_rules()), site_rules())
    codes = {(r["site"], r["Sp_Code"]) for r in bad.collect()}
    assert codes == {(s, c) for s, _, c, o, _ in ROWS if o == "unresolved"}
    # The two equal measurement rows come once; the missing name matches itself.
    assert bad.filter("site = 'nanjenshan'").count() == 1
    assert bad.filter("Submitted_Name is null").count() == 1


def test_flags_and_widths(means):
    one = with_interval_widths(with_imputed_flags(means)).first()
    assert [one[f"growth_layer_{i}_imputed"] for i in range(1, 5)] == [True, False, False, False]
    assert [one[f"survival_layer_{i}_imputed"] for i in range(1, 5)] == [True, False, False, False]
    assert [one[f"growth_layer_{i}_CI90_width"] for i in range(1, 5)] == [1.0, 2.0, 3.0, 4.0]
    exact = with_imputed_flags(means, exact_zero=True).first()
    assert exact["survival_layer_1_imputed"] is False
    long = size_and_width(means.limit(1), ["site"])
    assert long.count() == 6 and long.columns == ["site", "measure", "layer", "obs", "width"]


def test_single_steps(spark, means, checklist):
    """The steps one by one, for one site."""
    book = site_rules()
    taxa = submitted_taxa(site_extract(means, "hkk"), book).drop("site")
    missing, present = split_missing(taxa)
    assert missing.count() == 1 and present.count() == 5
    out, rest = exclude_names(present, ["Ficus racemosa"])
    assert (out.count(), rest.count()) == (2, 3)
    found = resolve_with_test(present, checklist)
    assert found.count() == 3 and review_list(found, checklist).count() == 0
    bad, kept = quarantine_by_pattern(found, "greww|greWi|grewifolia")
    assert (bad.count(), kept.count()) == (1, 2)
    assert quarantine_by_pattern(found, "grewi", on_mismatch_only=True)[0].count() == 0
    listed, others = quarantine_by_list(present, found, ["Ficus racemosa"])
    assert (listed.count(), others.count()) == (2, 2)
    assert rows(unmatched_by_name(present, found)) == [("Ficus cf. racemosa",)]
    assert rows(unmatched_by_code(present, found).select("Sp_Code")) == [("h5",)]
    single, repeated = triage_duplicates(found, ["Casearia grewiifolia Vent."], [])
    assert [r["Submitted_Name"] for r in single.collect()] == ["Ficus racemosa"]
    assert {r["issue"] for r in repeated.collect()} == {"double count"}
    table = assemble_unresolved(present, unmatched_by_name(present, found), missing, repeated)
    assert sorted(r["issue"] for r in table.collect()) == ["double count"] * 2 + ["not in LCVP"] * 2


def test_review_and_override(spark, checklist):
    asked = spark.createDataFrame([("Cinnamomum tahyanum",), ("Ficus racemosa",)], "Submitted_Name string")
    found = resolve_with_test(asked, checklist)
    offered = {r["First_matched_Name"] for r in review_list(found, checklist).collect()}
    assert offered == {"Cinnamomum tahijanum Kosterm.", "Cinnamomum bahianum Lukman."}
    wanted = asked.withColumn("target", F.lit("Cinnamomum tahijanum Kosterm."))
    chosen = override_targets(wanted, checklist).drop("target")
    assert chosen.count() == 1  # the other name is of another genus
    new = apply_override(found, chosen, ["Cinnamomum bahianum Lukman."])
    got = {r["Submitted_Name"]: r["First_matched_Name"] for r in new.collect()}
    assert got["Cinnamomum tahyanum"] == "Cinnamomum tahijanum Kosterm."


def test_full_run_and_merge(spark, means, checklist, tmp_path):
    tables = full_run(means, means, site_table(spark), checklist, site_rules())
    whole = tables["merged"]
    assert whole.select("Site_name").distinct().count() == 13  # sites without taxa stay
    assert whole.filter("Site_name = 'ituri_lenda'").first()["Submitted_Name"] is None
    assert whole.filter("Site_name = 'hkk'").count() == 2  # one name with two measurement rows
    n = tables["taxa"].count() + tables["taxa_unresolved"].count()
    write_database(tables, str(tmp_path / "db"))
    back = spark.read.csv(str(tmp_path / "db" / "taxa"), header=True, nullValue="NA")
    assert back.count() == n and {"outcome", "site"} < set(back.columns)
    assert (tmp_path / "db" / "medians" / "outcome=resolved" / "site=hkk").is_dir()
    meanings = spark.read.csv(str(tmp_path / "db" / "full" / "dictionary"), header=True, nullValue="NA")
    assert meanings.filter("meaning is null").count() == 0 and meanings.count() == 13


def test_a_name_submitted_often_has_as_many_measurements(spark, means, checklist):
    one = means.filter("site = 'hkk' and latin = 'Ficus racemosa'").limit(1)
    often = one.crossJoin(spark.range(1000).select("id")).withColumn("sp", F.concat(F.lit("c"), "id")).drop("id")
    tables = full_run(often, often, site_table(spark), checklist, site_rules())
    assert tables["taxa"].count() == tables["means"].count() == 1000
    assert tables["merged"].filter("Site_name = 'hkk'").count() == 1000


def test_sites_without_partner_survive_the_merge(spark):
    sites = combined_sites(site_table(spark))
    taxa = combined_taxa(
        spark.createDataFrame([("hkk", "A", "x"), ("hkk", "B", "y")], "site string, LCVP_Accepted_Taxon string, t string")
    )
    means = combined_means(
        spark.createDataFrame([("hkk", "A", 1.0), ("hkk", "A", 2.0)], "site string, LCVP_Accepted_Taxon string, m double")
    )
    got = rows(merged(sites, taxa, means).filter("Site_name in ('hkk', 'bci')").select("Site_name", "t", "m"))
    assert got == [("bci", None, None), ("hkk", "x", 1.0), ("hkk", "x", 2.0), ("hkk", "y", None)]


def test_coordinates(spark):
    sites = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", 91.0, 0.0), ("c", None, 0.0), ("d", 0.0, -181.0), ("e", 0.0, 0.0), ("e", 1.0, 1.0)],
        "Site_name string, Latitude double, Longitude double",
    )
    got = check_coordinates(sites)
    assert [r["Site_name"] for r in got.filter("sensible").collect()] == ["a"]
    assert check_coordinates(site_table(spark)).filter("not sensible").count() == 0


@pytest.fixture(scope="module")
def second(spark):
    base = spark.createDataFrame(
        [("Ficus", "racemosa"), ("Ficus", "variegataa"), ("Ficus", "variegata"), ("Tapirira", "guianensi"), ("Sapium", None)],
        "Genus string, Species string",
    )
    columns = [f"mu{i}_1" for i in range(1, 5)] + [f"G{i}_1" for i in range(1, 5)] + ["F_1", "SampleSize"]
    return base.select("*", *[F.lit(float(i)).alias(c) for i, c in enumerate(columns)])


def test_second_source(spark, second, checklist):
    resolved, review = second_source_taxa(second, checklist, retry_distance=2)
    assert rows(resolved.select("Submitted_Name", "First_matched_Name", "search")) == [
        ("Ficus racemosa", "Ficus racemosa L.", "exact"),
        ("Ficus variegata", "Ficus variegata Blume", "exact"),
        ("Ficus variegataa", "Ficus variegata Blume", "fuzzy"),
    ]
    assert rows(review) == [("Sapium NA", 0), ("Tapirira guianensi", 2)]
    demography = second_source_demography(second, resolved, "BCI")
    assert demography.count() == 3 and demography.first()["Site_name"] == "BCI"
    table = profile(second, [("mu1_1", "mu4_1"), ("G1_1", "G4_1")], ["F_1"])
    assert table.count() == 9
