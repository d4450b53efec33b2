"""Quality rules, completeness, uniqueness and timeliness over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.operators import profile as P
from pitwise.operators import quality as Q
from pitwise.operators.joins import block_pairs, parent_consistency
from pitwise.operators.ordering import row_positions
from pitwise.queries import query, read
from pitwise.queries.cleaning import GAPS, gappy

RECORD = ["dimension", "table_name", "check_name", "status", "applicable_rows", "failed_rows", "failed_pct"]


def _record(dimension: str, table: str, name: str, failed: str, applicable: str = "TRUE", source: str | None = None) -> str:
    """SQL for one check record, counted on its own."""
    return f"""SELECT '{dimension}' AS dimension, '{table}' AS table_name, '{name}' AS check_name, CASE WHEN f = 0 THEN 'passed' ELSE 'failed' END AS status, a AS applicable_rows,
  f AS failed_rows, ROUND(f * 100.0 / greatest(a, 1), 4) AS failed_pct FROM (SELECT COUNT(*) FILTER ({applicable}) AS a, COUNT(*) FILTER (({applicable}) AND ({failed})) AS f FROM {source or table})"""


LINE_RULES_SQL = "\nUNION ALL ".join([
    _record("accuracy", "lineitem", "quantity_between", "NOT (l_quantity BETWEEN 1 AND 45)"),
    _record("accuracy", "lineitem", "discount_not_negative", "l_discount < 0"),
    _record("accuracy", "lineitem", "flag_in_set", "l_returnflag NOT IN ('A', 'N')"),
    _record("accuracy", "lineitem", "line_number_format", "NOT regexp_matches(CAST(l_linenumber AS VARCHAR), '^[1-6]$')"),
    _record("accuracy", "lineitem", "price_per_unit", "l_extendedprice / l_quantity < 1000", "l_quantity > 10"),
])


def line_rules():
    return [
        Q.between("l_quantity", 1, 45, name="quantity_between"), Q.between("l_discount", 0, name="discount_not_negative"),
        Q.in_set("l_returnflag", ["A", "N"], name="flag_in_set"), Q.matches_regex("l_linenumber", "^[1-6]$", name="line_number_format"),
        Q.predicate("price_per_unit", ["l_extendedprice", "l_quantity"], F.col("l_extendedprice") / F.col("l_quantity") < 1000, applicable=F.col("l_quantity") > 10)]


def line_checks(spark, sf):
    return Q.run_checks(read(spark, sf, "lineitem"), line_rules(), table="lineitem", dimension="accuracy", order_by=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("quality_checks", LINE_RULES_SQL + "\nUNION ALL SELECT 'accuracy', 'lineitem', 'missing_column', 'skipped', COUNT(*), NULL, NULL FROM lineitem")
def quality_checks(spark, sf):
    """Range, set, pattern and expression rules counted in one pass; a rule on an absent column is skipped."""
    lines = read(spark, sf, "lineitem")
    out = Q.run_checks(lines, [*line_rules(), Q.not_null("l_comment", name="missing_column")], table="lineitem", dimension="accuracy")
    return out.select(*RECORD)


@query("quality_samples", r"""
WITH x AS (SELECT 'quantity_between' AS check_name, CAST(l_quantity AS VARCHAR) AS v, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT (l_quantity BETWEEN 1 AND 45)
  UNION ALL SELECT 'discount_not_negative', CAST(l_discount AS VARCHAR), l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_discount < 0
  UNION ALL SELECT 'flag_in_set', l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
  UNION ALL SELECT 'line_number_format', CAST(l_linenumber AS VARCHAR), l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT regexp_matches(CAST(l_linenumber AS VARCHAR), '^[1-6]$')
  UNION ALL SELECT 'price_per_unit', '{\"l_extendedprice\":' || l_extendedprice || ',\"l_quantity\":' || l_quantity || '}', l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_quantity > 10 AND l_extendedprice / l_quantity < 1000),
r AS (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, v) AS rn FROM x),
s AS (SELECT check_name, '[' || string_agg('"' || v || '"', ',' ORDER BY rn) || ']' AS sample FROM r WHERE rn <= 5 GROUP BY 1)
SELECT check_name, COALESCE(sample, '[]') AS sample_unexpected_values
FROM (VALUES ('quantity_between'), ('discount_not_negative'), ('flag_in_set'), ('line_number_format'), ('price_per_unit')) AS c(check_name) LEFT JOIN s USING (check_name)""")
def quality_samples(spark, sf):
    """Five offending values of every rule: the limit is the report."""
    return line_checks(spark, sf).select("check_name", "sample_unexpected_values")


@query("consistency_checks", "\nUNION ALL ".join([
    _record("consistency", "orders", "day_layout", "d IS NOT NULL AND TRY_CAST(d AS DATE) IS NULL", source="(SELECT *, CASE o_orderkey % 8 WHEN 0 THEN '1997-02-31' WHEN 1 THEN '31.12.1997' WHEN 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)"),
    _record("consistency", "orders", "priority_layout", "NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]+$')"),
    _record("consistency", "orders", "status_letter", "o_orderstatus NOT IN ('F', 'O')")]))
def consistency_checks(spark, sf):
    """Date layout, pattern and set rules; the layout rule also refuses dates that do not exist."""
    key = F.col("o_orderkey")
    d = F.when(key % 8 == 0, "1997-02-31").when(key % 8 == 1, "31.12.1997").when(key % 8 == 2, F.lit(None)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rules = [Q.matches_layout("d", "%Y-%m-%d", name="day_layout"), Q.matches_regex("o_orderpriority", r"^[1-4]-[A-Z]+$", name="priority_layout"),
             Q.in_set("o_orderstatus", ["F", "O"], name="status_letter")]
    return Q.run_checks(read(spark, sf, "orders").withColumn("d", d), rules, table="orders", dimension="consistency").select(*RECORD)


@query("quality_summary", f"""
WITH c AS ({LINE_RULES_SQL})
SELECT dimension, table_name, COUNT(*) AS checks_run, COUNT(*) FILTER (status = 'failed') AS failed_checks, COUNT(*) FILTER (status = 'skipped') AS skipped_checks,
  CAST(SUM(failed_rows) AS BIGINT) AS total_failed_rows FROM c GROUP BY 1, 2""")
def quality_summary(spark, sf):
    return Q.summarize(line_checks(spark, sf))


@query("quality_report", f"""
WITH c AS ({LINE_RULES_SQL}), n AS (SELECT dimension, string_agg(check_name, ', ' ORDER BY failed_pct DESC, table_name, check_name) AS names
  FROM (SELECT * FROM c WHERE status = 'failed' ORDER BY failed_pct DESC, table_name, check_name LIMIT 3) GROUP BY 1)
SELECT dimension, CASE WHEN COUNT(*) FILTER (status = 'failed') = 0 THEN 'passed' ELSE 'failed' END AS status, COUNT(*) AS checks, COUNT(*) FILTER (status = 'passed') AS passed,
  COUNT(*) FILTER (status = 'failed') AS failed, COUNT(*) FILTER (status = 'skipped') AS skipped,
  dimension || ': ' || COUNT(*) FILTER (status = 'failed') || ' of ' || COUNT(*) || ' executed checks failed (' || any_value(names) || ').' AS report FROM c JOIN n USING (dimension) GROUP BY 1""")
def quality_report(spark, sf):
    return Q.report_lines(line_checks(spark, sf))


REQUIRED_SQL = "\nUNION ALL ".join([_record("completeness", "orders", f"{c}_required", f"{c} IS NULL", source=GAPS) for c in ("o_orderkey", "price", "day")])


@query("report_order", f"""
WITH c AS ({LINE_RULES_SQL} UNION ALL {REQUIRED_SQL} UNION ALL SELECT 'accuracy', 'lineitem', 'missing_column', 'skipped', COUNT(*), NULL, NULL FROM lineitem)
SELECT *, row_number() OVER (ORDER BY status, failed_pct DESC NULLS LAST, table_name, check_name) AS report_rank FROM c""")
def report_order(spark, sf):
    """Records of two tables with their place in the report: status, share of failed rows from the largest, table, name."""
    lines = Q.run_checks(read(spark, sf, "lineitem"), [*line_rules(), Q.not_null("l_comment", name="missing_column")], table="lineitem", dimension="accuracy")
    orders = Q.run_checks(gappy(spark, sf), [Q.not_null(c) for c in ("o_orderkey", "price", "day")], table="orders", dimension="completeness")
    records = lines.select(*RECORD).unionByName(orders.select(*RECORD))
    return row_positions(records, [("status", "asc"), ("failed_pct", "desc"), ("table_name", "asc"), ("check_name", "asc")], name="report_rank")


@query("row_order", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY day DESC NULLS LAST, priority ASC NULLS LAST, price DESC NULLS LAST, o_orderkey) AS position FROM {GAPS}""")
def row_order(spark, sf):
    """Every order's place by date (latest first), priority and price, missing ones last, ties by key; ranges of 5,000 rows."""
    rows = gappy(spark, sf).select("o_orderkey", "day", "priority", "price")
    placed = row_positions(rows, [("day", "desc"), ("priority", "asc"), ("price", "desc"), ("o_orderkey", "asc")], range_rows=5_000)
    return placed.select("o_orderkey", "position")


@query("scalar_checks", """
WITH s AS (SELECT COUNT(DISTINCT l_linestatus) AS states, MAX(l_tax) AS top_tax FROM lineitem)
SELECT 'one_status' AS check_name, CASE WHEN states = 1 THEN 'passed' ELSE 'failed' END AS status, CAST(1 AS BIGINT) AS applicable_rows, CAST(states <> 1 AS BIGINT) AS failed_rows FROM s
UNION ALL SELECT 'tax_below_ten_percent', CASE WHEN top_tax < 0.1 THEN 'passed' ELSE 'failed' END, 1, CAST(top_tax >= 0.1 AS BIGINT) FROM s""")
def scalar_checks(spark, sf):
    """Rules over one aggregated row."""
    row = read(spark, sf, "lineitem").agg(F.count_distinct("l_linestatus").alias("states"), F.max("l_tax").alias("top_tax"))
    rules = [Q.predicate("one_status", ["states"], F.col("states") != 1), Q.predicate("tax_below_ten_percent", ["top_tax"], F.col("top_tax") >= 0.1)]
    return Q.run_checks(row, rules, table="lineitem", dimension="consistency").select("check_name", "status", "applicable_rows", "failed_rows")


@query("table_completeness", f"""
WITH t AS (SELECT *, CAST(price IS NULL AS INT) + CAST(priority IS NULL AS INT) + CAST(sparse IS NULL AS INT) + CAST(day IS NULL AS INT) AS m FROM {GAPS})
SELECT 'orders' AS table_name, COUNT(*) AS rows, CAST(5 AS BIGINT) AS columns, CAST(SUM(m) AS BIGINT) AS missing_cells, ROUND(SUM(m) * 100.0 / (COUNT(*) * 5), 4) AS missing_cells_pct,
  COUNT(*) FILTER (m > 0) AS rows_with_missing, ROUND(COUNT(*) FILTER (m > 0) * 100.0 / COUNT(*), 4) AS rows_with_missing_pct, CAST(1 AS BIGINT) AS expected_min_rows, 'passed' AS size_status FROM t""")
def table_completeness(spark, sf):
    return Q.table_completeness(gappy(spark, sf), "orders")


@query("field_completeness", f"""
WITH n AS (SELECT COUNT(*) AS n, COUNT(o_orderkey) AS k, COUNT(price) AS p, COUNT(priority) AS r, COUNT(sparse) AS s, COUNT(day) AS d FROM {GAPS}),
u AS (SELECT n, unnest(['o_orderkey', 'price', 'priority', 'sparse', 'day']) AS column_name, unnest(['required', 'required', 'optional', 'optional', 'optional']) AS field_role, unnest([n - k, n - p, n - r, n - s, n - d]) AS missing_count FROM n)
SELECT 'orders' AS table_name, column_name, field_role, missing_count, ROUND(missing_count * 100.0 / n, 4) AS missing_pct FROM u""")
def field_completeness(spark, sf):
    return Q.field_completeness(gappy(spark, sf), "orders", required=["o_orderkey", "price"])


@query("required_fields", "\nUNION ALL ".join([
    _record("completeness", "orders", f"{c}_required", f"{c} IS NULL", source=GAPS) for c in ("o_orderkey", "price", "day")]))
def required_fields(spark, sf):
    return Q.run_checks(gappy(spark, sf), [Q.not_null(c) for c in ("o_orderkey", "price", "day")], table="orders", dimension="completeness").select(*RECORD)


@query("exact_duplicates", """
WITH t AS (SELECT l_returnflag, l_linestatus, l_partkey, l_linenumber FROM lineitem)
SELECT 'lineitem' AS table_name, COUNT(*) AS rows, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t)) AS exact_duplicate_rows,
  ROUND((COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t))) * 100.0 / COUNT(*), 4) AS exact_duplicate_pct FROM t""")
def exact_duplicates(spark, sf):
    return Q.exact_duplicates(read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_partkey", "l_linenumber"), "lineitem")


@query("unique_fields", """
WITH c AS (SELECT 'p_partkey' AS column_name, CAST(p_partkey AS VARCHAR) AS v FROM part UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part)
SELECT 'part' AS table_name, column_name, CASE WHEN COUNT(v) = COUNT(DISTINCT v) THEN 'passed' ELSE 'failed' END AS status, COUNT(v) - COUNT(DISTINCT v) AS duplicate_count,
  ROUND((COUNT(v) - COUNT(DISTINCT v)) * 100.0 / COUNT(*), 4) AS duplicate_pct FROM c GROUP BY column_name
UNION ALL SELECT 'part', 'p_code', 'skipped', NULL, NULL""")
def unique_fields(spark, sf):
    return Q.unique_fields(read(spark, sf, "part"), "part", ["p_partkey", "p_name", "p_retailprice", "p_code"])


@query("unique_keys", """
WITH a AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2), b AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT 'lineitem' AS table_name, 'l_orderkey, l_linenumber' AS key_fields, CASE WHEN SUM(n - 1) = 0 THEN 'passed' ELSE 'failed' END AS status, CAST(SUM(n - 1) AS BIGINT) AS duplicate_count,
  COUNT(*) FILTER (n > 1) AS duplicate_groups, ROUND(SUM(n - 1) * 100.0 / SUM(n), 4) AS duplicate_pct FROM a
UNION ALL SELECT 'orders', 'o_custkey, day', CASE WHEN SUM(n - 1) = 0 THEN 'passed' ELSE 'failed' END, CAST(SUM(n - 1) AS BIGINT), COUNT(*) FILTER (n > 1), ROUND(SUM(n - 1) * 100.0 / SUM(n), 4) FROM b""")
def unique_keys(spark, sf):
    orders = read(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return Q.unique_key(read(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]).unionByName(Q.unique_key(orders, "orders", ["o_custkey", "day"]))


@query("uniqueness_checks", _record("uniqueness", "lineitem", "line_key_is_unique", "c > 1", source="(SELECT row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem)"))
def uniqueness_checks(spark, sf):
    return Q.unique_key_check(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], table="lineitem", dimension="uniqueness", name="line_key_is_unique").select(*RECORD)


@query("child_parent_date_check", """
SELECT COUNT(*) FILTER (d IS NOT NULL AND o_orderdate IS NOT NULL) AS applicable_rows, COUNT(*) FILTER (d IS NOT NULL AND o_orderdate IS NOT NULL AND d <> CAST(o_orderdate AS DATE)) AS failed_rows
FROM (SELECT l_orderkey, CASE WHEN l_partkey % 10 <> 0 THEN CAST(l_shipdate AS DATE) END AS d FROM lineitem) LEFT JOIN orders ON l_orderkey = CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END""")
def child_parent_date_check(spark, sf):
    """Shipments whose date differs from the order date, where both are known; a fifth of the order keys is changed."""
    child = read(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 10 != 0, F.to_date("l_shipdate")).alias("d"))
    parent = read(spark, sf, "orders").select(F.expr("CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END").alias("o_orderkey"), F.to_date("o_orderdate").alias("day"))
    return parent_consistency(child, parent, on={"l_orderkey": "o_orderkey"}, child_col="d", parent_col="day")


@query("timeliness_checks", "\nUNION ALL ".join([
    _record("timeliness", "orders", "date_values_are_parseable", "d IS NULL", source=GAPS.replace("AS day", "AS d")),
    _record("timeliness", "orders", "no_future_dates", "d > DATE '2001-06-30'", "d IS NOT NULL", source=GAPS.replace("AS day", "AS d")),
    _record("timeliness", "orders", "season_matches_date_year", "NOT (year(d) = s OR year(d) = s + 1)", "d IS NOT NULL AND s IS NOT NULL",
            source=f"(SELECT day AS d, CASE WHEN o_orderkey % 3 > 0 THEN year(day) - o_orderkey % 4 END AS s FROM {GAPS})")]))
def timeliness_checks(spark, sf):
    """Readable dates, no date after a reference day, season against year."""
    o = gappy(spark, sf).withColumn("season", F.when(F.col("o_orderkey") % 3 > 0, F.year("day") - F.col("o_orderkey") % 4))
    year = F.year("day")
    rules = Q.timeliness_rules("day", F.lit("2001-06-30").cast("date"), "date") + [Q.predicate(
        "season_matches_date_year", ["season", "day"], ~((year == F.col("season")) | (year == F.col("season") + 1)), applicable=year.isNotNull() & F.col("season").isNotNull())]
    return Q.run_checks(o, rules, table="orders", dimension="timeliness").select(*RECORD)


@query("relationship_checks", "\nUNION ALL ".join([
    _record("relationships", "lineitem", "tax_matches_share", "abs(l_tax * 100 - l_quantity / 50 * 8) > 5", "l_quantity > 0"),
    _record("relationships", "lineitem", "status_matches_flag", "(CASE WHEN l_returnflag = 'A' THEN 'F' ELSE 'O' END) <> l_linestatus"),
    _record("relationships", "lineitem", "discount_not_above_tax", "l_discount > l_tax", "l_discount IS NOT NULL AND l_tax IS NOT NULL")]))
def relationship_checks(spark, sf):
    """Dependencies between columns: share within a tolerance, flag implied by another, one value not above the other."""
    rules = [Q.predicate("tax_matches_share", ["l_tax", "l_quantity"], F.abs(F.col("l_tax") * 100 - F.col("l_quantity") / 50 * 8) > 5, applicable=F.col("l_quantity") > 0),
             Q.predicate("status_matches_flag", ["l_returnflag", "l_linestatus"], F.when(F.col("l_returnflag") == "A", "F").otherwise("O") != F.col("l_linestatus")),
             Q.predicate("discount_not_above_tax", ["l_discount", "l_tax"], F.col("l_discount") > F.col("l_tax"), applicable=F.col("l_discount").isNotNull() & F.col("l_tax").isNotNull())]
    return Q.run_checks(read(spark, sf, "lineitem"), rules, table="lineitem", dimension="relationships").select(*RECORD)


@query("profile_summary", """
SELECT 'lineitem' AS table_name, CAST(2 AS BIGINT) AS numeric_fields_profiled, CAST(2 AS BIGINT) AS categorical_fields_profiled,
  CAST((abs(skewness(l_extendedprice)) >= 1) AS BIGINT) + CAST((abs(skewness(l_tax)) >= 1) AS BIGINT) AS high_skew_numeric_fields,
  CAST((COUNT(DISTINCT l_returnflag) >= 20) AS BIGINT) + CAST((COUNT(DISTINCT l_partkey) >= 20) AS BIGINT) AS high_cardinality_categorical_fields FROM lineitem""")
def profile_summary(spark, sf):
    lines = read(spark, sf, "lineitem")
    return Q.profile_summary(P.numeric_profile(lines, ["l_extendedprice", "l_tax"], "lineitem"), P.categorical_profile(lines, ["l_returnflag", "l_partkey"], "lineitem"))


@query("uniqueness_summary", """
WITH e AS (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT p_name, p_brand FROM part)) AS d FROM part), s AS (SELECT COUNT(*) - COUNT(DISTINCT p_partkey) AS a, COUNT(*) - COUNT(DISTINCT p_name) AS b FROM part),
k AS (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT p_brand, p_size FROM part)) AS d FROM part)
SELECT 'exact_duplicates' AS check_type, CAST(d > 0 AS BIGINT) AS issue_count, d AS affected_rows FROM e
UNION ALL SELECT 'strict_unique_fields', CAST(a > 0 AS BIGINT) + CAST(b > 0 AS BIGINT), a + b FROM s
UNION ALL SELECT 'subset_duplicates', CAST(d > 0 AS BIGINT), d FROM k
UNION ALL SELECT 'fuzzy_duplicate_candidates', COUNT(*), COUNT(*) FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.p_partkey < y.p_partkey
  WHERE x.p_name <> y.p_name AND 1 - CAST(levenshtein(x.p_name, y.p_name) AS DOUBLE) / greatest(length(x.p_name), length(y.p_name)) >= 0.5""")
def uniqueness_summary(spark, sf):
    """Exact, strict, key and similar-name findings over the parts; similar are different names of one brand and size that share half of their letters in order."""
    part = read(spark, sf, "part")
    blocked = part.select("p_partkey", "p_name", F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("block"))
    similar = block_pairs(blocked, block="block", order_by="p_partkey", columns=["p_partkey", "p_name"], where=lambda x, y: (x("p_name") != y("p_name")) & (
        1 - F.levenshtein(x("p_name"), y("p_name")) / F.greatest(F.length(x("p_name")), F.length(y("p_name"))) >= 0.5))
    return Q.uniqueness_summary(Q.exact_duplicates(part.select("p_name", "p_brand"), "part"), Q.unique_fields(part, "part", ["p_partkey", "p_name"]),
                                Q.unique_key(part, "part", ["p_brand", "p_size"]), similar)
