import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvatab.operators import resolve
from sylvatab.operators.pieces import edit_limit, letters, neighbours
from sylvatab.operators.resolve import (
    Index,
    close_pairs,
    dealt,
    entry_key,
    fuzzy_candidates,
    index_checklist,
    keep_resolved,
    match_key,
    resolve_names,
    tiled,
)

SCHEMA = (
    "`Input.Taxon` string, Status string, `PL.comparison` string, `PL.alternative` string, "
    "`Output.Taxon` string, Family string, `Order` string"
)


def entry(name, status="accepted", accepted=None, comparison="identical"):
    return (name, status, comparison, None, accepted or name, "Moraceae", "Rosales")


@pytest.fixture
def listed(spark):
    return spark.createDataFrame(
        [
            entry("Ficus carica L."),
            entry("Ficus carina Zz."),
            entry("Ficus variegata Aa.", "synonym", "Ficus other Blume"),
            entry("Ficus variegata Blume"),
            entry("Shorea macroptera Dyer"),
            entry("Shorea macroptera subsp. macroptera Dyer", "synonym", "Shorea macroptera Dyer"),
            entry("Acer a(b Bar"),
            entry("Quercus × alba L."),
        ],
        SCHEMA,
    )


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "Submitted_Name string")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def limit_of(name, share):
    return int(share) if share >= 1 else -(-len(name) * round(share * 100) // 100)


def test_keys(spark):
    df = spark.createDataFrame(
        [
            ("Ficus carica L.", "Ficus carica"),
            ("Shorea macroptera subsp. macroptera Dyer", "Shorea macroptera subsp. macroptera"),
            ("Quercus × alba L.", "Quercus × alba"),
            ("ficus  carica (L.) Foo", "Ficus carica"),
            ("Ficus", "Ficus"),
            ("Abies alba f. Foo", "Abies alba"),
        ],
        "full string, key string",
    )
    assert df.filter(entry_key(F.col("full")) != F.col("key")).collect() == []
    assert names(spark, "  FICUS   carica ").select(match_key(F.col("Submitted_Name"))).first()[0] == "Ficus carica"


def test_limits(spark):
    df = spark.createDataFrame([("x" * n,) for n in (1, 9, 10, 11, 30, 70)], "k string")
    got = [r[0] for r in df.select(edit_limit(F.col("k"), 0.1)).collect()]
    assert got == [1, 1, 1, 2, 3, 7]
    assert {r[0] for r in df.select(edit_limit(F.col("k"), 5)).collect()} == {5}


def best(df):
    return {r["Submitted_Name"]: (r["First_matched_Name"], r["distance"]) for r in df.collect()}


def test_best_match(spark, listed):
    asked = names(
        spark, "Ficus carica", "ficus carica", "Ficus caricca", "Ficus cariba", "Ficus variegata", "Ficus", None,
        "Ficus carica", "Shorea macroptera subsp. macroptera", "Betula carica", "Acer a(b", "Fcus carica", "NA NA",
    )
    assert best(resolve_names(asked, listed)) == {
        "Ficus carica": ("Ficus carica L.", 0),
        "ficus carica": ("Ficus carica L.", 0),
        "Ficus caricca": ("Ficus carica L.", 1),
        # One edit from two entries: the first name in order.
        "Ficus cariba": ("Ficus carica L.", 1),
        # Two authors: the accepted entry.
        "Ficus variegata": ("Ficus variegata Blume", 0),
        "Shorea macroptera subsp. macroptera": ("Shorea macroptera subsp. macroptera Dyer", 0),
        "Acer a(b": ("Acer a(b Bar", 0),
    }
    assert set(best(resolve_names(asked, listed, max_distance=0))) == {
        "Ficus carica", "ficus carica", "Ficus variegata", "Shorea macroptera subsp. macroptera", "Acer a(b",
    }
    wide = best(resolve_names(asked, listed, match_genus=False))
    assert wide["Fcus carica"] == ("Ficus carica L.", 1)


def test_all_candidates(spark, listed):
    got = fuzzy_candidates(names(spark, "Ficus cariba", "Ficus variegata"), listed)
    assert sorted((r["Submitted_Name"], r["First_matched_Name"], r["distance"]) for r in got.collect()) == [
        ("Ficus cariba", "Ficus carica L.", 1),
        ("Ficus cariba", "Ficus carina Zz.", 1),
        ("Ficus variegata", "Ficus variegata Aa.", 0),
        ("Ficus variegata", "Ficus variegata Blume", 0),
    ]


def test_search_again_is_reuse(spark, listed):
    asked = names(spark, "Ficus carica", "Ficus caricca", "Shorea macroptera")
    kept = names(spark, "Ficus caricca", "Ficus caricca", "unknown")
    again = keep_resolved(resolve_names(asked, listed), kept)
    assert best(again) == best(resolve_names(names(spark, "Ficus caricca"), listed))


def brute(asked, entries, share, genus):
    out = set()
    for a in asked:
        k = limit_of(a, share)
        for b in entries:
            if genus and a.split(" ")[0] != b.split(" ")[0]:
                continue
            if abs(len(a) - len(b)) <= k and (d := edits(a, b)) <= k:
                out.add((a, b, d))
    return out


def pairs(spark, asked, entries, share, genus):
    left = spark.createDataFrame([(a,) for a in asked], "key string")
    left = left.withColumn("edits", edit_limit(F.col("key"), share)).filter("edits > 0")
    right = spark.createDataFrame([(b,) for b in entries], "key string")
    longest = left.agg(F.max("edits")).first()[0] or 0
    found = close_pairs(left, Index(right, None, (share,), genus), range(1, longest + 1)).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def some_names(seed, n, lengths):
    rng = random.Random(seed)

    def body(size):
        return "".join(rng.choice("ab") for _ in range(size))

    entries = sorted({rng.choice(["Ga", "Gab"]) + " " + body(rng.choice(lengths)) for _ in range(n)})
    asked = set()
    for e in entries:
        s = list(e)
        for _ in range(rng.randint(0, 4 if len(e) < 60 else 12)):
            i = rng.randrange(3, len(s) + 1)
            step = rng.choice("ids")
            if step == "i":
                s.insert(i, rng.choice("ab"))
            elif i < len(s):
                s[i : i + 1] = [] if step == "d" else [rng.choice("ab")]
        asked.add("".join(s))
    return sorted(asked | {"Ga", "Gab a"}), entries


@pytest.mark.parametrize("genus", [True, False])
@pytest.mark.parametrize("share", [0.1, 0.3, 2, 5])
def test_blocked_join_equals_brute_force(spark, share, genus):
    asked, entries = some_names(7, 90, [1, 2, 4, 8, 13, 25])
    assert pairs(spark, asked, entries, share, genus) == brute(asked, entries, share, genus)


def test_long_names_equal_brute_force(spark):
    asked, entries = some_names(3, 25, [85, 100, 140])
    assert pairs(spark, asked, entries, 0.1, True) == brute(asked, entries, 0.1, True)


word = st.text(alphabet="abé", min_size=0, max_size=9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(word, min_size=1, max_size=12), st.sets(word, min_size=1, max_size=12), st.sampled_from([0.2, 1, 3]))
def test_any_words(spark, a, b, share):
    asked, entries = ["G " + w for w in sorted(a)], ["G " + w for w in sorted(b)]
    assert pairs(spark, asked, entries, share, True) == brute(asked, entries, share, True)


@pytest.mark.parametrize("share", [0.1, 0.15, 2])
def test_ends_equal_brute_force(spark, share):
    """Two edits anywhere in strings about as long as both ends, and longer."""
    rng = random.Random(13)
    entries = {"".join(rng.choice("abc ") for _ in range(n)).replace(" ", "a") for n in range(5, 22) for _ in range(6)}
    asked = set(entries)
    for e in sorted(entries):
        for _ in range(6):
            s = list(e)
            for _ in range(rng.randint(1, 2)):
                i, step = rng.randrange(len(s)), rng.choice("idr")
                s[i : i + 1] = {"i": [rng.choice("abc"), s[i]], "d": [], "r": [rng.choice("abc")]}[step]
            asked.add("".join(s))
    asked, entries = sorted(asked), sorted(entries)
    assert pairs(spark, asked, entries, share, False) == brute(asked, entries, share, False)


def rows_joined(spark, monkeypatch, asked, entries, share, genus):
    seen = []

    def counted(left, right, near):
        seen.append((left.count(), right.count()))
        return tiled(left, right, near)

    monkeypatch.setattr(resolve, "tiled", counted)
    assert pairs(spark, asked, entries, share, genus) == brute(asked, entries, share, genus)
    return seen[0][0] / len(asked), seen[0][1] / len(entries)


def test_names_of_any_genus_make_few_keys(spark, monkeypatch):
    """Without two of 18 characters there are 172 texts; by the ends far fewer tell."""
    entries = [f"Ga{c}us longepithe{d}" for c in "abc" for d in "ab"]
    asked = [f"Ga{c}us lonepithe{d}" for c in "abc" for d in "ax"]
    of_names, of_entries = rows_joined(spark, monkeypatch, asked, entries, 0.1, False)
    assert of_names < 50 and of_entries < 50


def test_entries_make_no_keys_that_no_name_looks_for(spark, monkeypatch):
    """All names near an entry of 15 characters may have three edits, and are searched
    within two first: no keys for one edit or for four."""
    entries = [f"Gaus epitheto{c}x" for c in "abc"]
    asked = [f"Gaus epitheto{c}y" for c in "abc"]
    left = spark.createDataFrame([(a, 2) for a in asked], "key string, edits int")
    seen = []
    monkeypatch.setattr(resolve, "tiled", lambda n, e, near: seen.append(e.count()) or tiled(n, e, near))
    found = close_pairs(left, Index(spark.createDataFrame([(e,) for e in entries], "key string"), None, (0.2,), True), range(1, 3))
    assert {(r.key, r.entry_key) for r in found.collect()} == {(a, e) for a in asked for e in entries if edits(a, e) <= 2}
    body = len(entries[0]) - 4
    assert seen[0] <= len(entries) * (1 + body + body * (body - 1) // 2)


def test_places_are_found_once_for_each_length(spark, monkeypatch):
    """What names look for by kind 3 depends on their length and edits alone."""
    rows = {}
    monkeypatch.setattr(resolve, "written", lambda df, name: rows.setdefault(name, df.count()) and df)
    asked = [f"Gaus epithe{a}{b}" for a in "abcd" for b in "abcd"] + ["Gaus epithet"]
    assert pairs(spark, asked, asked[:4], 3, True) == brute(asked, asked[:4], 3, True)
    assert rows["places"] == 2


def two_words(seed, n):
    """Names of two words and others up to three edits away, some with the space elsewhere."""
    rng = random.Random(seed)

    def word(most):
        return "".join(rng.choice("ab") for _ in range(rng.randint(1, most)))

    entries = sorted({f"{word(6)} {word(6)}" for _ in range(n)})
    asked = set(entries)
    for e in entries:
        s = list(e)
        for _ in range(rng.randint(1, 3)):
            i, step = rng.randrange(len(s)), rng.choice("idr")
            s[i : i + 1] = {"i": [rng.choice("ab "), s[i]], "d": [], "r": [rng.choice("ab ")]}[step]
        asked.add("".join(s))
        asked.add(e.replace(" ", "")[:-2] + " " + e[-2:].strip())
    return sorted(a for a in asked if len(a.split()) == 2 and a.count(" ") == 1 and a == a.strip()), entries


@pytest.mark.parametrize(("share", "block"), [(0.2, 2_048), (2, 0)])
def test_two_words_of_any_genus_make_no_keys(spark, monkeypatch, share, block):
    """Names meet by their words, with up to two edits in one, one in each or at the spaces."""
    monkeypatch.setattr(resolve, "name_keys", unwanted)
    monkeypatch.setattr(resolve, "entry_keys", unwanted)
    monkeypatch.setattr(resolve, "WORD_BLOCK", block)
    monkeypatch.setattr(resolve, "FEW", 0)
    asked, entries = two_words(19, 40)
    asked = [a for a in asked if limit_of(a, share) <= 2]
    assert pairs(spark, asked, entries, share, False) == brute(asked, entries, share, False)


def test_moved_spaces(spark, monkeypatch):
    """The space taken away and put in elsewhere, or exchanged with characters."""
    monkeypatch.setattr(resolve, "FEW", 0)
    entries = ["abc def", "aaaa aa", "ab cdef", "abyc ef", "aa aaaa"]
    asked = ["ab cdef", "ab cxdef", "abcd ef", "abcde f", "abxc ef", "ab cxef", "abcd xef", "aaa aaa", "aaaaa a", "abcx ef", "ab yxef"]
    wanted = brute(asked, entries, 2, False)
    assert {("ab cdef", "abc def", 2), ("aaa aaa", "aaaa aa", 2), ("aaa aaa", "aa aaaa", 2), ("ab cxef", "abyc ef", 2)} <= wanted
    assert pairs(spark, asked, entries, 2, False) == wanted


def test_few_names_of_any_genus_are_compared_directly(spark, monkeypatch):
    monkeypatch.setattr(resolve, "name_keys", unwanted)
    asked, entries = some_names(7, 40, [1, 2, 4, 8, 13, 25])
    assert pairs(spark, asked, entries, 0.3, False) == brute(asked, entries, 0.3, False)


def test_ends_of_many_names_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resolve, "FEW", 0)
    test_ends_equal_brute_force(spark, 0.15)


def test_names_of_two_words_and_others_of_any_genus(spark, monkeypatch):
    """Names and entries of one word, of three and longer than keys go among those of two."""
    monkeypatch.setattr(resolve, "FEW", 0)
    asked, entries = two_words(23, 25)
    entries = [*entries, "abaab", "ab aa b", "a b a b", "a" * 41 + " b", "b" * 39 + " a", "ab  b"]
    asked = [*asked, "abab", "ab aab", "aba ab b", "a" * 40 + " b", "a" * 38 + " b", "b" * 38 + " a", "abb", "ab b"]
    asked = list(dict.fromkeys(asked))
    for share in (2, 0.3):
        assert pairs(spark, asked, entries, share, False) == brute(asked, entries, share, False)


def as_checklist(spark, keys):
    return spark.createDataFrame([entry(k, "synonym" if i % 3 else "accepted") for i, k in enumerate(keys)], SCHEMA)


@pytest.mark.parametrize("share", [0.1, 0.3, 5])
def test_rising_distance_equals_brute_force(spark, share):
    asked, entries = some_names(11, 60, [3, 6, 12, 30, 50])
    listed = as_checklist(spark, entries)
    rank = {r["Input.Taxon"]: (r["Status"] != "accepted") for r in listed.collect()}
    wanted = {}
    for a, b, d in brute(asked, entries, share, True):
        wanted[a] = min(wanted.get(a, (99,)), (d, rank[b], b))
    got = best(resolve_names(names(spark, *asked), listed, share))
    assert got == {a: (b, d) for a, (d, _, b) in wanted.items()}


def test_best_match_meets_fewer_pairs_than_all_candidates(spark, monkeypatch):
    """Names found nearby are not searched further away."""
    asked, entries = some_names(5, 60, [12, 25])
    seen = []

    def counted(names, *args):
        seen.append(names.count())
        return close_pairs(names, *args)

    monkeypatch.setattr(resolve, "close_pairs", counted)
    found = resolve_names(names(spark, *asked), as_checklist(spark, entries), 5).count()
    assert found and len(seen) == 2 and seen[1] < seen[0]


@pytest.mark.parametrize("genus", [True, False])
def test_one_index_for_several_searches(spark, genus):
    asked, entries = some_names(9, 50, [4, 9, 20])
    listed, given = as_checklist(spark, entries), names(spark, *asked)
    index = index_checklist(listed, 0.1, 5, match_genus=genus)
    for share in (0, 0.1, 5):
        assert best(resolve_names(given, index, share, genus)) == best(resolve_names(given, listed, share, genus))
        one, two = fuzzy_candidates(given, index, share, genus), fuzzy_candidates(given, listed, share, genus)
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    with pytest.raises(ValueError, match="other searches"):
        resolve_names(given, index, 0.2, genus)


def test_the_index_is_not_shuffled(spark, hot):
    """Names are shuffled to the keys of the checklist, which stay where they are."""
    asked, entries = some_names(9, 50, [4, 9, 20])
    index = index_checklist(as_checklist(spark, entries), 5)
    left = names(spark, *asked).select(F.col("Submitted_Name").alias("key"), F.lit(5).alias("edits"))
    found = close_pairs(left, index, range(5, 6))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    # The scan's own ancestors: lines of the join's other side are no less deep.
    deep = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < deep:
            deep = depth(line)
            assert "Exchange" not in line
            if "SortMergeJoin" in line:
                break


def test_crowded_keys_are_dealt_over_tiles(spark):
    """One key with all names and all entries: no tile holds more pairs than stated."""
    most = 5_000
    left = spark.range(900).selectExpr("concat('n', id) AS key", "1 AS edits", "0L AS letters", "IF(id < 700, 1L, id) AS h")
    right = spark.range(800).selectExpr("concat('e', id) AS entry_key", "0L AS entry_letters", "IF(id < 600, 1L, id) AS h")
    crowded = spark.createDataFrame([(1, 700, 600)], "h bigint, names bigint, entries bigint")
    names_dealt, entries_dealt = dealt(left, right, crowded, most)
    a, b = (d.groupBy("tile").count().withColumnRenamed("count", c) for d, c in ((names_dealt, "a"), (entries_dealt, "b")))
    cells = a.join(b, "tile").selectExpr("a * b AS pairs").collect()
    assert len(cells) >= 700 * 600 / most and max(r.pairs for r in cells) <= most
    assert sum(r.pairs for r in cells) == 700 * 600
    found = tiled(left, right, F.lit(True), most).select("key", "entry_key")
    plain = left.join(right, "h").select("key", "entry_key")
    assert found.count() == found.distinct().count() == plain.count()
    assert found.exceptAll(plain).isEmpty()


def test_a_genus_of_near_equal_names(spark):
    """20,000 names of one genus that differ in a few characters."""
    base = spark.range(20_000).select(F.concat(F.lit("Aus b"), F.lpad((F.col("id") * 7919 % 100_003).cast("string"), 6, "0"), F.lit("us")).alias("key"))
    found = close_pairs(base.withColumn("edits", F.lit(1)), Index(base, None, (1,), True), range(1, 2))
    near = found.filter("distance = 1")
    # Every name with each of the 54 texts that differ in one digit and, with one
    # digit moved, some that need two edits only.
    listed = {r.key for r in base.collect()}
    some = sorted(listed)[::1000]
    wanted = {(a, b) for a in some for i in range(5, 11) for d in "0123456789" if (b := a[:i] + d + a[i + 1 :]) != a and b in listed}
    assert {(r.key, r.entry_key) for r in near.filter(F.col("key").isin(some)).collect()} == wanted


def unwanted(*args):
    raise AssertionError("keys were made")


@pytest.mark.parametrize("share", [0.2, 5])
def test_names_of_small_genera_make_no_keys(spark, monkeypatch, share):
    """The keys of a name take longer than comparing it with the entries of its genus."""
    monkeypatch.setattr(resolve, "name_keys", unwanted)
    monkeypatch.setattr(resolve, "entry_keys", unwanted)
    asked, entries = some_names(7, 90, [1, 2, 4, 8, 13, 25])
    assert pairs(spark, asked, entries, share, True) == brute(asked, entries, share, True)


@pytest.mark.parametrize("share", [0.1, 0.3, 2, 5])
@pytest.mark.parametrize("block", [0, 33])
def test_large_genera_equal_brute_force(spark, monkeypatch, block, share):
    """All genera by keys, or one by keys and one compared directly."""
    monkeypatch.setattr(resolve, "BLOCK", block)
    asked, entries = some_names(7, 90, [1, 2, 4, 8, 13, 25])
    sizes = sorted(sum(e.startswith(g + " ") for e in entries) for g in ("Ga", "Gab"))
    assert sizes == [33, 34]
    assert pairs(spark, asked, entries, share, True) == brute(asked, entries, share, True)


def test_long_names_of_large_genera_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resolve, "BLOCK", 0)
    test_long_names_equal_brute_force(spark)


def test_rising_distance_in_large_genera(spark, monkeypatch):
    monkeypatch.setattr(resolve, "BLOCK", 0)
    test_rising_distance_equals_brute_force(spark, 0.3)


def test_entries_of_large_genera_make_no_keys_that_no_name_looks_for(spark, monkeypatch):
    monkeypatch.setattr(resolve, "BLOCK", 0)
    test_entries_make_no_keys_that_no_name_looks_for(spark, monkeypatch)


@pytest.mark.parametrize("block", [0, 33])
def test_pairs_are_measured_after_cheaper_tests(spark, monkeypatch, block):
    """The optimizer puts a filter on the distance before the tests of the join."""
    monkeypatch.setattr(resolve, "BLOCK", block)
    keys = spark.createDataFrame([("Ga abc",), ("Ga abd",)], "key string")
    found = close_pairs(keys.withColumn("edits", F.lit(2)), Index(keys, None, (2,), True), range(1, 3))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and "levenshtein" in line]
    assert joins and all(line.index("bit_count") < line.index("levenshtein") for line in joins)


def test_bits_that_an_edit_can_change(spark):
    rng = random.Random(17)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abcdé -") for _ in range(rng.randint(0, 9)))
        s = list(a)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice(["", *"abcdé"])
        b = "".join(s)
        rows.append((a, b, edits(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int").withColumn("longer", F.expr("abs(length(a) - length(b))"))
    for bits, most in ((letters, 2), (neighbours, 4)):
        changed = F.bit_count(bits("a").bitwiseXOR(bits("b")))
        assert df.filter(changed + F.col("longer") > most * F.col("d")).collect() == []
    assert df.filter(F.bit_count(neighbours("a").bitwiseXOR(neighbours("b"))) > 4).count() > 0
