"""Queries for the single operators: projection, filters, joins, aggregates,
set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvatab.functions.text import mentions, normalise_name_case, prints_with_zero
from sylvatab.operators.joins import (
    join_keep_right,
    members_of,
    natural_join,
    non_members_of,
)
from sylvatab.operators.sets import append_rows, set_difference, union_by_name
from sylvatab.operators.summaries import (
    column_ranges,
    column_run,
    count_by,
    duplicate_groups,
    having_more_than,
    histogram,
    one_row_per_key,
    pretty_histogram,
    repeated_values,
)
from sylvatab.plans.taxa import site_extract, split_missing, submitted_taxa
from sylvatab.queries import standin
from sylvatab.queries.standin import source_rows, table


def scan_project_rename(spark, sf):
    part = table(spark, sf, "part").drop("p_retailprice", "p_size")
    part = part.withColumnsRenamed({"p_name": "Submitted_Name", "p_partkey": "Sp_Code", "p_type": "IDlevel"})
    return part.withColumns({"source": F.lit("parts"), "n_chars": F.length("Submitted_Name")})


SCAN_SQL = """SELECT p_partkey AS "Sp_Code", p_name AS "Submitted_Name", p_brand, p_type AS "IDlevel",
  'parts' AS source, length(p_name) AS n_chars FROM part"""


def column_run_select(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select("l_orderkey", *column_run(items, "l_quantity", "l_tax"))


COLUMN_RUN_SQL = "SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"


def site_extract_query(spark, sf):
    return site_extract(source_rows(spark, sf).drop("p_partkey"), "Brand#7", "Brand#13")


SITE_SQL = f"""SELECT * FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in standin._SOURCE_COLUMNS.items())}
  FROM part) s WHERE site IN ('Brand#7', 'Brand#13')"""

TAXA_SQL = standin.taxa_sql()


def taxa_extract(spark, sf):
    return submitted_taxa(source_rows(spark, sf), standin.rule_book())


def null_split(spark, sf):
    missing, present = split_missing(submitted_taxa(source_rows(spark, sf)))
    return union_by_name(missing.withColumn("side", F.lit("missing")), present.withColumn("side", F.lit("present")))


NULL_SPLIT_SQL = f"""SELECT latin AS "Submitted_Name", sp AS "Sp_Code", genus AS "Submitted_Genus",
  family AS "Submitted_Family", "IDlevel", site, CASE WHEN latin IS NULL THEN 'missing' ELSE 'present' END AS side
  FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in standin._SOURCE_COLUMNS.items())} FROM part) s"""


def sentinel_filter(spark, sf):
    taxa = submitted_taxa(source_rows(spark, sf), standin.rule_book())
    return split_missing(taxa, ("Na NA", "NA"))[1]


SENTINEL_SQL = f"""WITH {TAXA_SQL} SELECT * FROM taxa
  WHERE Submitted_Name IS NOT NULL AND Submitted_Name <> 'Na NA' AND Submitted_Name <> 'NA'"""


def bool_filter(spark, sf):
    part = table(spark, sf, "part").withColumn("holds", mentions(F.col("p_name"), F.lower("p_type")))
    part = part.withColumn("large", F.col("p_size") > 25)
    return part.filter(~F.col("large") & ~F.col("holds"))


BOOL_SQL = """SELECT * FROM (SELECT *, contains(p_name, lower(p_type)) AS holds, p_size > 25 AS large
  FROM part) p WHERE NOT large AND NOT holds"""


def membership_filter(spark, sf):
    rows = source_rows(spark, sf).select("p_partkey", "latin")
    listed = F.coalesce(F.col("latin").isin("Red", "Blue", "NA"), F.lit(False))
    return rows.withColumn("listed", listed).filter(~listed | (F.col("latin") == "NA"))


MEMBERSHIP_SQL = f"""SELECT * FROM (SELECT p_partkey, latin, COALESCE(latin IN ('Red', 'Blue', 'NA'), FALSE) AS listed
  FROM (SELECT p_partkey, {standin._LATIN} AS latin FROM part) a) b WHERE NOT listed OR latin = 'NA'"""


def regex_keep(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.filter(F.col("text").rlike("ction|ment|[0-9]{4}")).select("doc_id", "lang", "source", "n_chars")


REGEX_KEEP_SQL = """SELECT doc_id, lang, source, n_chars FROM documents
  WHERE regexp_matches(text, 'ction|ment|[0-9]{4}')"""


def regex_drop(spark, sf):
    rows = source_rows(spark, sf).select("p_partkey", "latin")
    return rows.filter(~F.coalesce(F.col("latin").rlike("xx|r.d|NA"), F.lit(False)))


REGEX_DROP_SQL = f"""SELECT * FROM (SELECT p_partkey, {standin._LATIN} AS latin FROM part) a
  WHERE NOT COALESCE(regexp_matches(latin, 'xx|r.d|NA'), FALSE)"""


def drop_repeat_rows(spark, sf):
    return one_row_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


DROP_REPEAT_SQL = """SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""


def _keyed(spark, sf):
    """Orders and customers sharing a key column that is missing on some rows:
    every tenth order, and one customer."""
    orders = table(spark, sf, "orders").select(
        F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END").alias("custkey"), "o_orderkey", "o_totalprice"
    )
    customers = table(spark, sf, "customer").select(
        F.expr("CASE WHEN c_custkey <> 0 THEN c_custkey END").alias("custkey"), "c_name", "c_acctbal"
    )
    return orders, customers


KEYED_SQL = """o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS custkey, o_orderkey, o_totalprice
    FROM orders),
  c AS (SELECT CASE WHEN c_custkey <> 0 THEN c_custkey END AS custkey, c_name, c_acctbal FROM customer)"""


def natural_inner_nullsafe(spark, sf):
    return natural_join(*_keyed(spark, sf), "inner", balanced=True)


NATURAL_INNER_SQL = f"""WITH {KEYED_SQL} SELECT o.custkey, o_orderkey, o_totalprice, c_name, c_acctbal
  FROM o JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey"""


def suffix_join(spark, sf):
    names = source_rows(spark, sf).select(F.col("latin").alias("Submitted_Name"), F.col("sp").alias("Sp_Code"))
    firsts = names.groupBy("Submitted_Name").agg(F.min("Sp_Code").alias("Sp_Code"))
    return join_keep_right(firsts, names, ["Submitted_Name"], ["Sp_Code"]).distinct()


SUFFIX_SQL = f"""WITH n AS (SELECT {standin._LATIN} AS Submitted_Name,
    {standin._SOURCE_COLUMNS["sp"]} AS Sp_Code FROM part)
  SELECT DISTINCT r.Submitted_Name, r.Sp_Code FROM (SELECT Submitted_Name, min(Sp_Code) AS m FROM n GROUP BY ALL) l
  JOIN n r ON l.Submitted_Name IS NOT DISTINCT FROM r.Submitted_Name"""


def _star(spark, sf):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "regionkey")
    nation = table(spark, sf, "nation").withColumnsRenamed({"n_regionkey": "regionkey", "n_nationkey": "nationkey"})
    supplier = table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    # Region 2 and nation 6 have no partner: their rows point elsewhere.
    nation = nation.withColumn("regionkey", F.expr("CASE WHEN regionkey = 2 THEN -1 ELSE regionkey END"))
    supplier = supplier.withColumn("nationkey", F.expr("CASE WHEN nationkey = 6 THEN -1 ELSE nationkey END"))
    return region, nation, supplier


STAR_SQL = """r AS (SELECT r_regionkey AS regionkey, r_name FROM region),
  n AS (SELECT n_nationkey AS nationkey, n_name,
    CASE WHEN n_regionkey = 2 THEN -1 ELSE n_regionkey END AS regionkey FROM nation),
  s AS (SELECT s_suppkey, s_name, CASE WHEN s_nationkey = 6 THEN -1 ELSE s_nationkey END AS nationkey, s_acctbal
    FROM supplier)"""


def star_left_join(spark, sf):
    region, nation, supplier = _star(spark, sf)
    return natural_join(natural_join(region, nation, "left", balanced=True), supplier, "left", balanced=True)


STAR_LEFT_SQL = f"""WITH {STAR_SQL} SELECT r.regionkey, r_name, n.nationkey, n_name, s_suppkey, s_name, s_acctbal
  FROM r LEFT JOIN n ON r.regionkey = n.regionkey LEFT JOIN s ON n.nationkey = s.nationkey"""


def _partly(spark, sf):
    """Orders and customers where either side has rows without a partner: the
    keys of cheap orders and of rich customers are moved out of each other's way."""
    orders, customers = _keyed(spark, sf)
    orders = orders.withColumn("custkey", F.expr("CASE WHEN o_totalprice < 100000 THEN -1 - custkey ELSE custkey END"))
    rich = "CASE WHEN c_acctbal > 5000 THEN -1000000000 - custkey ELSE custkey END"
    return orders, customers.withColumn("custkey", F.expr(rich))


PARTLY_SQL = f"""{KEYED_SQL}, op AS (SELECT * REPLACE (
    CASE WHEN o_totalprice < 100000 THEN -1 - custkey ELSE custkey END AS custkey) FROM o),
  cp AS (SELECT * REPLACE (CASE WHEN c_acctbal > 5000 THEN -1000000000 - custkey ELSE custkey END AS custkey) FROM c)"""


def natural_right(spark, sf):
    return natural_join(*_partly(spark, sf), "right", balanced=True)


NATURAL_RIGHT_SQL = f"""WITH {PARTLY_SQL} SELECT cp.custkey, o_orderkey, o_totalprice, c_name, c_acctbal
  FROM op RIGHT JOIN cp ON op.custkey IS NOT DISTINCT FROM cp.custkey"""


def natural_full(spark, sf):
    return natural_join(*_partly(spark, sf), "full", balanced=True)


NATURAL_FULL_SQL = f"""WITH {PARTLY_SQL} SELECT COALESCE(op.custkey, cp.custkey) AS custkey,
    o_orderkey, o_totalprice, c_name, c_acctbal
  FROM op FULL JOIN cp ON COALESCE(op.custkey, -2000000000000) = COALESCE(cp.custkey, -2000000000000)"""


def natural_full_star(spark, sf):
    _, nation, supplier = _star(spark, sf)
    return natural_join(nation, supplier, "full", balanced=True)


NATURAL_FULL_STAR_SQL = f"""WITH {STAR_SQL} SELECT COALESCE(n.nationkey, s.nationkey) AS nationkey, n_name,
    regionkey, s_suppkey, s_name, s_acctbal FROM n FULL JOIN s ON n.nationkey = s.nationkey"""


def _big_spenders(spark, sf):
    return table(spark, sf, "orders").filter("o_totalprice > 400000").select("o_custkey")


def semi_computed(spark, sf):
    return members_of(table(spark, sf, "customer"), _big_spenders(spark, sf), "c_custkey", "o_custkey")


SEMI_SQL = """SELECT * FROM customer SEMI JOIN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) o
  ON c_custkey = o_custkey"""


def anti_computed(spark, sf):
    return non_members_of(table(spark, sf, "customer"), _big_spenders(spark, sf), "c_custkey", "o_custkey")


ANTI_SQL = SEMI_SQL.replace("SEMI JOIN", "ANTI JOIN")


def group_count(spark, sf):
    return count_by(table(spark, sf, "orders"), "o_custkey", "o_orderstatus")


GROUP_COUNT_SQL = "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL"


def group_count_having(spark, sf):
    return having_more_than(count_by(table(spark, sf, "orders"), "o_custkey"), 12)


HAVING_SQL = "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12"


def column_ranges_query(spark, sf):
    items = table(spark, sf, "lineitem").withColumn(
        "checked", F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END")
    )
    return column_ranges(items, [*column_run(items, "l_quantity", "l_tax"), "checked"])


COLUMN_RANGES_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS variable, CASE WHEN count(*) = count(x) THEN min(x) END AS min,
      CASE WHEN count(*) = count(x) THEN max(x) END AS max, count(*) - count(x) AS n_null,
      count(*) FILTER (isnan(x)) AS n_nan, count(*) FILTER (isinf(x)) AS n_inf, count(*) FILTER (x = 0) AS n_zero
    FROM (SELECT {expr} AS x FROM lineitem) t"""
    for name, expr in [
        *[(c, c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        ("checked", "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END"),
    ]
)


def _prices(spark, sf):
    """Prices, some of which are infinite and some not a number."""
    price = F.when(F.col("l_quantity") == 50, F.lit(float("inf"))).when(F.col("l_quantity") == 49, F.lit(float("nan")))
    return table(spark, sf, "lineitem").select(price.otherwise(F.col("l_extendedprice")).alias("price"))


def histogram_bins(spark, sf):
    return histogram(_prices(spark, sf), "price", 30)


HISTOGRAM_SQL = """WITH v AS (SELECT l_extendedprice FROM lineitem WHERE l_quantity NOT IN (49, 50)),
  e AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS w FROM v),
  b AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 29) AS INTEGER) AS bin, lo, w FROM v, e)
  SELECT bin, lo + bin * w AS lower, count(*) AS n FROM b GROUP BY bin, lo, w"""


def histogram_pretty(spark, sf):
    return pretty_histogram(_prices(spark, sf), "price", 30)


PRETTY_SQL = """WITH v AS (SELECT l_extendedprice FROM lineitem WHERE l_quantity NOT IN (49, 50)),
  e AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS c FROM v),
  p AS (SELECT lo, c, pow(10.0, floor(log10(c))) AS u FROM e),
  s AS (SELECT lo, CASE WHEN 10 * u - c < 1.5 * (c - 5 * u) THEN 10 * u WHEN 5 * u - c < 2.75 * (c - 2 * u) THEN 5 * u
    WHEN 2 * u - c < 1.5 * (c - u) THEN 2 * u ELSE u END AS w FROM p),
  b AS (SELECT CAST(greatest(ceil(l_extendedprice / w - 1e-7) - 1, floor(lo / w + 1e-7)) AS BIGINT) AS bin, w
    FROM v, s)
  SELECT bin * w AS lower, (bin + 1) * w AS upper, count(*) AS n FROM b GROUP BY bin, w"""


def row_distinct(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_tax").distinct()


ROW_DISTINCT_SQL = "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_tax FROM lineitem"


def repeated_values_query(spark, sf):
    return repeated_values(source_rows(spark, sf), "latin")


REPEATED_SQL = f"""SELECT latin FROM (SELECT {standin._LATIN} AS latin FROM part) a
  GROUP BY latin HAVING count(*) > 1"""


def duplicate_groups_query(spark, sf):
    return duplicate_groups(source_rows(spark, sf).select("p_partkey", "latin", "site"), "latin")


DUPLICATES_SQL = f"""SELECT p_partkey, latin, p_brand AS site FROM (SELECT *, {standin._LATIN} AS latin FROM part) a
  QUALIFY count(*) OVER (PARTITION BY latin) > 1"""


def _people(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return customers, suppliers


def union_by_name_query(spark, sf):
    return union_by_name(*_people(spark, sf))


UNION_SQL = """SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
  UNION ALL BY NAME SELECT s_acctbal AS acctbal, s_name AS name, s_nationkey AS nationkey FROM supplier"""


def set_difference_query(spark, sf):
    orders, customers = _partly(spark, sf)
    return set_difference(customers.select("custkey"), orders.select("custkey"))


SET_DIFFERENCE_SQL = f"WITH {PARTLY_SQL} SELECT custkey FROM cp EXCEPT SELECT custkey FROM op"


def append_rows_query(spark, sf):
    supplier = table(spark, sf, "supplier")
    return append_rows(supplier, [{"s_name": "Unidentified ."}] * 10 + [{"s_suppkey": -1, "s_name": "added"}])


APPEND_SQL = """SELECT * FROM supplier UNION ALL BY NAME SELECT 'Unidentified .' AS s_name FROM range(10)
  UNION ALL BY NAME SELECT -1 AS s_suppkey, 'added' AS s_name"""


def name_case_normalise(spark, sf):
    rows = source_rows(spark, sf).select("p_partkey", "site", F.col("latin").alias("Submitted_Name"))
    return normalise_name_case(rows, case_rules=standin.rule_book().modes("case"))


NAME_CASE_SQL = f"""SELECT p_partkey, site, {standin.case_sql("latin")} AS Submitted_Name
  FROM (SELECT p_partkey, p_brand AS site, {standin._LATIN} AS latin FROM part) a"""


def text_matches_column(spark, sf):
    rows = source_rows(spark, sf).select("p_partkey", "latin", "genus")
    return rows.withColumns(
        {"holds": mentions(F.col("latin"), F.col("genus")), "like": mentions(F.col("latin"), F.col("genus"), True)}
    )


TEXT_MATCHES_SQL = f"""SELECT p_partkey, latin, genus, contains(latin, genus) AS holds,
  regexp_matches(latin, genus) AS "like" FROM (SELECT p_partkey, {standin._LATIN} AS latin, {standin._GENUS} AS genus
  FROM part) a"""


def imputed_flags(spark, sf):
    events = table(spark, sf, "events").withColumn("obs", F.expr("CASE WHEN event_id % 9 <> 0 THEN value END"))
    return events.select(
        "event_id",
        "obs",
        prints_with_zero(F.col("obs")).alias("imputed"),
        prints_with_zero(F.col("obs"), exact_zero=True).alias("is_zero"),
    )


IMPUTED_SQL = """SELECT event_id, obs, COALESCE(regexp_matches(CAST(obs AS VARCHAR), '^0'), FALSE) AS imputed,
  COALESCE(obs = 0, FALSE) AS is_zero
  FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN value END AS obs FROM events) e"""


QUERIES = {
    "scan_project_rename": (scan_project_rename, SCAN_SQL),
    "column_run_select": (column_run_select, COLUMN_RUN_SQL),
    "site_extract": (site_extract_query, SITE_SQL),
    "taxa_extract": (taxa_extract, f"WITH {TAXA_SQL} SELECT * FROM taxa"),
    "null_split": (null_split, NULL_SPLIT_SQL),
    "sentinel_filter": (sentinel_filter, SENTINEL_SQL),
    "bool_filter": (bool_filter, BOOL_SQL),
    "membership_filter": (membership_filter, MEMBERSHIP_SQL),
    "regex_keep": (regex_keep, REGEX_KEEP_SQL),
    "regex_drop": (regex_drop, REGEX_DROP_SQL),
    "drop_repeat_rows": (drop_repeat_rows, DROP_REPEAT_SQL),
    "natural_inner_nullsafe": (natural_inner_nullsafe, NATURAL_INNER_SQL),
    "suffix_join": (suffix_join, SUFFIX_SQL),
    "star_left_join": (star_left_join, STAR_LEFT_SQL),
    "natural_right": (natural_right, NATURAL_RIGHT_SQL),
    "natural_full": (natural_full, NATURAL_FULL_SQL),
    "natural_full_star": (natural_full_star, NATURAL_FULL_STAR_SQL),
    "semi_computed": (semi_computed, SEMI_SQL),
    "anti_computed": (anti_computed, ANTI_SQL),
    "group_count": (group_count, GROUP_COUNT_SQL),
    "group_count_having": (group_count_having, HAVING_SQL),
    "column_ranges": (column_ranges_query, COLUMN_RANGES_SQL),
    "histogram_bins": (histogram_bins, HISTOGRAM_SQL),
    "histogram_pretty": (histogram_pretty, PRETTY_SQL),
    "row_distinct": (row_distinct, ROW_DISTINCT_SQL),
    "repeated_values": (repeated_values_query, REPEATED_SQL),
    "duplicate_groups": (duplicate_groups_query, DUPLICATES_SQL),
    "union_by_name": (union_by_name_query, UNION_SQL),
    "set_difference": (set_difference_query, SET_DIFFERENCE_SQL),
    "append_rows": (append_rows_query, APPEND_SQL),
    "name_case_normalise": (name_case_normalise, NAME_CASE_SQL),
    "text_matches_column": (text_matches_column, TEXT_MATCHES_SQL),
    "imputed_flags": (imputed_flags, IMPUTED_SQL),
}
