"""Statistical profiles over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.operators import ordering as O
from pitwise.operators import profile as P
from pitwise.operators import quality as Q
from pitwise.queries import query, read

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _gappy_orders(spark, sf):
    """Orders with a price missing for every 9th order."""
    return read(spark, sf, "orders").withColumn("price", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")))


GAPPY = "(SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS price FROM orders)"


@query("group_statistics", """
SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS mean, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2""")
def group_statistics(spark, sf):
    o = read(spark, sf, "orders").withColumn("p", F.col("o_totalprice").cast("decimal(18,2)"))
    return o.groupBy("o_orderpriority", F.to_date(F.trunc("o_orderdate", "month")).alias("month")).agg(
        F.sum("p").cast("double").alias("total"), (F.sum("p").cast("double") / F.count(F.lit(1))).alias("mean"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("o_custkey").alias("customers"))


@query("group_medians", """
SELECT o_orderpriority, o_orderstatus, COUNT(price) AS n, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.9) AS p90 FROM """ + GAPPY + " GROUP BY 1, 2")
def group_medians(spark, sf):
    """Exact medians and upper deciles per group."""
    out = O.quantiles(_gappy_orders(spark, sf), ["price"], {"median": 0.5, "p90": 0.9}, by=["o_orderpriority", "o_orderstatus"])
    return out.drop("column")


@query("last_known_values", """
WITH t AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS st FROM orders)
SELECT o_custkey, arg_max(price, o_orderkey) FILTER (price IS NOT NULL) AS last_price, arg_max(st, o_orderkey) FILTER (st IS NOT NULL) AS last_status FROM t GROUP BY 1""")
def last_known_values(spark, sf):
    """Last non-null value per column and customer."""
    price, status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))
    t = read(spark, sf, "orders").select("o_custkey", "o_orderkey", price.alias("price"), status.alias("st"))
    return t.groupBy("o_custkey").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("o_orderkey"))).alias(n) for c, n in (("price", "last_price"), ("st", "last_status"))])


@query("kpis", """
SELECT COUNT(*) AS rows, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_discount > 0) AS DOUBLE) / COUNT(*) FILTER (l_discount > 0) AS discounted_mean,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS mean_quantity, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM lineitem""")
def kpis(spark, sf):
    """Headline numbers of one table in one aggregation."""
    cut = F.col("l_discount") > 0
    return read(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(F.when(cut, F.col("l_extendedprice").cast("decimal(18,2)"))).cast("double") / F.count_if(cut)).alias("discounted_mean"),
        (F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("mean_quantity"),
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct(F.struct("l_partkey", "l_suppkey")).alias("pairs"))


@query("numeric_profile", """
WITH c AS (SELECT 'l_quantity' AS column_name, l_quantity AS v FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', CASE WHEN l_discount > 0 THEN l_discount END FROM lineitem)
SELECT 'lineitem' AS table_name, column_name, COUNT(v) AS non_null_count, COUNT(*) - COUNT(v) AS missing_count, ROUND((COUNT(*) - COUNT(v)) * 100.0 / COUNT(*), 4) AS missing_pct,
  COUNT(DISTINCT v) AS distinct_count, ROUND(MIN(v), 4) AS min, ROUND(quantile_cont(v, 0.25), 4) AS q1, ROUND(median(v), 4) AS median, ROUND(AVG(v), 4) AS mean,
  ROUND(quantile_cont(v, 0.75), 4) AS q3, ROUND(MAX(v), 4) AS max, ROUND(stddev_samp(v), 4) AS std, ROUND(skewness(v), 4) AS skew, ROUND(abs(skewness(v)), 4) AS abs_skew,
  ROUND(kurtosis(v), 4) AS kurtosis FROM c GROUP BY column_name""")
def numeric_profile_query(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount")))
    return P.numeric_profile(lines, ["l_quantity", "l_extendedprice", "l_discount"], "lineitem")


@query("iqr_outliers", """
WITH v AS (SELECT column_name, CAST(id AS VARCHAR) AS row_id, v FROM (
   SELECT 'n_chars' AS column_name, doc_id AS id, CAST(n_chars AS DOUBLE) AS v FROM documents)),
b AS (SELECT column_name, COUNT(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1),
c AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b)
SELECT 'documents' AS table_name, c.column_name, n AS non_null_count, ROUND(q1, 4) AS q1, ROUND(q3, 4) AS q3, ROUND(iqr, 4) AS iqr, ROUND(lo, 4) AS lower_bound,
  ROUND(hi, 4) AS upper_bound, o.n_out AS outlier_count, ROUND(o.n_out * 100.0 / n, 4) AS outlier_pct
FROM c, (SELECT COUNT(*) AS n_out FROM v, c WHERE v.v < c.lo OR v.v > c.hi) o""")
def iqr_outliers_query(spark, sf):
    return P.iqr_outliers(read(spark, sf, "documents"), ["n_chars"], row_id="doc_id", label="source", table="documents")[0]


@query("outlier_examples", """
WITH b AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT 'documents' AS table_name, 'n_chars' AS column_name, CAST(doc_id AS VARCHAR) AS row_id, source AS label, CAST(n_chars AS DOUBLE) AS value,
  row_number() OVER (ORDER BY n_chars DESC, CAST(doc_id AS VARCHAR)) AS rank
FROM documents, b WHERE n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1) QUALIFY rank <= 5""")
def outlier_examples(spark, sf):
    """Top five offending values: the limit is the report."""
    return P.iqr_outliers(read(spark, sf, "documents"), ["n_chars"], row_id="doc_id", label="source", table="documents")[1]


@query("categorical_profile", """
WITH c AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS v FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT 'o_custkey', CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END FROM orders),
n AS (SELECT column_name, v, COUNT(*) AS n FROM c WHERE v IS NOT NULL GROUP BY 1, 2),
t AS (SELECT column_name, COUNT(v) AS nn, COUNT(*) - COUNT(v) AS miss, COUNT(*) AS tot, COUNT(DISTINCT v) AS d FROM c GROUP BY 1),
k AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, v) AS r FROM n QUALIFY r <= 5), m AS (SELECT * FROM k WHERE r = 1),
top AS (SELECT column_name, '[' || string_agg('{"value":"' || v || '","count":' || n || ',"pct":' || ROUND(n * 100.0 / nn, 4) || '}', ',' ORDER BY r) || ']' AS top_values FROM k JOIN t USING (column_name) GROUP BY 1)
SELECT top_values, 'orders' AS table_name, column_name, nn AS non_null_count, miss AS missing_count, ROUND(miss * 100.0 / tot, 4) AS missing_pct, d AS distinct_count,
  m.v AS mode_value, m.n AS mode_count, ROUND(m.n * 100.0 / nn, 4) AS mode_pct FROM t JOIN m USING (column_name) JOIN top USING (column_name)""")
def categorical_profile_query(spark, sf):
    o = read(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")))
    return P.categorical_profile(o, ["o_orderstatus", "o_orderpriority", "o_custkey"], "orders")


@query("top_frequencies", """
WITH c AS (SELECT 'event_type' AS column_name, event_type AS value FROM events UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events),
n AS (SELECT column_name, value, COUNT(*) AS count FROM c GROUP BY 1, 2)
SELECT column_name, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS rank, value, count,
  ROUND(count * 100.0 / SUM(count) OVER (PARTITION BY column_name), 4) AS pct FROM n QUALIFY rank <= 5""")
def top_frequencies_query(spark, sf):
    return P.top_frequencies(read(spark, sf, "events"), ["event_type", "user_id"])


@query("histogram", """
WITH v AS (SELECT 'o_totalprice' AS column_name, o_totalprice AS v FROM orders UNION ALL SELECT 'year', CAST(year(o_orderdate) AS DOUBLE) FROM orders
   UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders),
s AS (SELECT column_name, MIN(v) AS lo, MAX(v) AS hi, COUNT(DISTINCT v) AS d FROM v GROUP BY 1),
f AS (SELECT column_name, 'exact_frequency' AS kind, row_number() OVER (PARTITION BY column_name ORDER BY v) AS bin, v AS bin_start, COUNT(*) AS count
   FROM v JOIN s USING (column_name) WHERE d <= 10 GROUP BY column_name, v),
w AS (SELECT column_name, greatest(1, least(8, CAST(ceil((v - lo) / ((hi - lo) / 8)) AS INTEGER))) AS bin, COUNT(*) AS count FROM v JOIN s USING (column_name) WHERE d > 10 GROUP BY 1, 2),
e AS (SELECT s.column_name, 'equal_width_bins' AS kind, g.bin, CASE WHEN g.bin = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (g.bin - 1) * ((hi - lo) / 8) END AS a, lo + g.bin * ((hi - lo) / 8) AS b,
   COALESCE(w.count, 0) AS count FROM s CROSS JOIN (SELECT CAST(unnest(range(1, 9)) AS INTEGER) AS bin) g LEFT JOIN w ON w.column_name = s.column_name AND w.bin = g.bin WHERE s.d > 10)
SELECT column_name, kind, CAST(bin AS INTEGER) AS bin, ROUND(bin_start, 4) AS bin_start, ROUND(bin_start, 4) AS bin_end, count FROM f UNION ALL
SELECT column_name, kind, bin, """ + ", ".join(f"ROUND(CASE WHEN {x} = 0 THEN {x} WHEN abs({x}) >= 1 THEN ROUND({x}, 3) ELSE ROUND({x} * pow(10.0, 2 - floor(log10(abs({x})))), 0) / pow(10.0, 2 - floor(log10(abs({x})))) END, 4)" for x in "ab") + ", count FROM e")
def histogram_query(spark, sf):
    o = read(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return P.histogram(o, ["o_totalprice", "year", "o_custkey"])


@query("value_shares", "SELECT CAST(quality AS INTEGER) AS value, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS pct FROM labels GROUP BY 1")
def value_shares_query(spark, sf):
    return P.value_shares(read(spark, sf, "labels"), "quality")


@query("monthly_profile", """
WITH m AS (SELECT CAST(date_trunc('month', CASE WHEN year(l_shipdate) = 1998 AND month(l_shipdate) IN (3, 4) THEN l_shipdate - INTERVAL 2 MONTH ELSE l_shipdate END) AS DATE) AS month, COUNT(*) AS n FROM lineitem GROUP BY 1),
g AS (SELECT CAST(unnest(generate_series((SELECT MIN(month) FROM m), (SELECT MAX(month) FROM m), INTERVAL 1 MONTH)) AS DATE) AS month),
f AS (SELECT g.month, month(g.month) AS cal, COALESCE(n, 0) AS n, g.month IN ((SELECT MIN(month) FROM m), (SELECT MAX(month) FROM m)) AS edge FROM g LEFT JOIN m USING (month)),
b AS (SELECT cal, median(n) AS base FROM f WHERE NOT edge GROUP BY 1),
x AS (SELECT f.*, base, CASE WHEN base > 0 THEN ROUND((n - base) / base * 100, 4) END AS diff, (NOT edge AND base >= 100) AS judged FROM f LEFT JOIN b USING (cal))
SELECT 'lineitem' AS table_name, strftime(month, '%Y-%m') AS year_month, CAST(cal AS INTEGER) AS calendar_month, n AS row_count, base AS baseline_median, diff AS pct_diff_from_baseline,
  CASE WHEN judged THEN CASE WHEN abs(diff) <= 40 THEN 'passed' ELSE 'failed' END ELSE 'skipped' END AS volume_status,
  CASE WHEN judged THEN CASE WHEN n > 0 THEN 'passed' ELSE 'failed' END ELSE 'skipped' END AS gap_status, edge AS is_edge_month FROM x""")
def monthly_profile_query(spark, sf):
    """Monthly shipments against the usual month; the dates of two months are moved to make a gap."""
    moved = (F.year("l_shipdate") == 1998) & F.month("l_shipdate").isin(3, 4)
    lines = read(spark, sf, "lineitem").withColumn("l_shipdate", F.when(moved, F.add_months("l_shipdate", -2)).otherwise(F.to_date("l_shipdate")))
    return P.monthly_profile(lines, "l_shipdate", table="lineitem")


@query("date_coverage", """
WITH t AS (SELECT CASE WHEN o_orderkey % 17 <> 0 THEN CAST(CASE WHEN year(o_orderdate) = 1998 AND month(o_orderdate) = 3 THEN o_orderdate - INTERVAL 1 MONTH ELSE o_orderdate END AS DATE) END AS d FROM orders),
m AS (SELECT date_trunc('month', d) AS m, COUNT(*) AS n FROM t WHERE d IS NOT NULL GROUP BY 1),
s AS (SELECT COUNT(*) AS rows, COUNT(d) AS valid_dates, COUNT(*) - COUNT(d) AS invalid_dates, MIN(d) AS min_date, MAX(d) AS max_date, COUNT(DISTINCT d) AS unique_days,
   CAST((year(MAX(d)) - year(MIN(d))) * 12 + month(MAX(d)) - month(MIN(d)) + 1 AS BIGINT) AS months_in_range, MAX(d) - MIN(d) AS span_days FROM t)
SELECT 'orders' AS table_name, 'day' AS date_column, rows, valid_dates, invalid_dates, min_date, max_date, unique_days, (SELECT COUNT(*) FROM m) AS unique_months, months_in_range,
  months_in_range - (SELECT COUNT(*) FROM m) AS gap_months, CAST(floor((SELECT median(n) FROM m)) AS BIGINT) AS median_monthly_rows, (SELECT MAX(n) FROM m) AS max_monthly_rows, span_days FROM s""")
def date_coverage_query(spark, sf):
    moved = (F.year("o_orderdate") == 1998) & (F.month("o_orderdate") == 3)          # a month without orders
    day = F.when(moved, F.add_months("o_orderdate", -1)).otherwise(F.to_date("o_orderdate"))
    return P.date_coverage(read(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 17 != 0, day).alias("day")), "day", table="orders")


@query("season_volume", """
WITH s AS (SELECT CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS season, COUNT(*) AS n FROM orders GROUP BY 1),
b AS (SELECT median(n) AS m FROM s WHERE season < (SELECT MAX(season) FROM s) OR (SELECT COUNT(*) FROM s) = 1)
SELECT CAST(season AS INTEGER) AS season, n AS row_count, ROUND((n - m) / greatest(m, 1) * 100, 4) AS pct_vs_median,
  CASE WHEN n BETWEEN m * 0.8 AND m * 1.2 THEN 'passed' ELSE 'failed' END AS volume_status FROM s, b""")
def season_volume_query(spark, sf):
    o = read(spark, sf, "orders").withColumn("season", F.when(F.month("o_orderdate") >= 7, F.year("o_orderdate")).otherwise(F.year("o_orderdate") - 1))
    return P.season_volume(o, "season")


@query("corr_pairs", """
WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE l_partkey % 3 <> 0),
r AS (SELECT x, y, (rank() OVER (ORDER BY x) + rank() OVER (ORDER BY x) + COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
   (rank() OVER (ORDER BY y) + rank() OVER (ORDER BY y) + COUNT(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p),
c AS (SELECT COUNT(*) AS n, corr(x, y) AS p, corr(rx, ry) AS s FROM r)
SELECT 'lineitem' AS table_name, 'l_quantity' AS left_column, 'price' AS right_column, n AS shared_rows, ROUND(p, 4) AS pearson, ROUND(s, 4) AS spearman,
  CASE WHEN abs(s) > abs(p) THEN 'spearman' ELSE 'pearson' END AS stronger_method, ROUND(CASE WHEN abs(s) > abs(p) THEN s ELSE p END, 4) AS stronger_value,
  CASE WHEN CASE WHEN abs(s) > abs(p) THEN s ELSE p END >= 0 THEN 'positive' ELSE 'negative' END AS direction,
  CASE WHEN greatest(abs(s), abs(p)) >= 0.9 THEN 'very_high' WHEN greatest(abs(s), abs(p)) >= 0.7 THEN 'high' WHEN greatest(abs(s), abs(p)) >= 0.5 THEN 'moderate'
    WHEN greatest(abs(s), abs(p)) >= 0.3 THEN 'weak' ELSE 'very_weak' END AS strength FROM c WHERE n >= 100""")
def corr_pairs(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("price", F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice")))
    return P.correlation_pair(lines, "l_quantity", "price", table="lineitem")


_STRENGTH = """CASE WHEN greatest(abs(s), abs(p)) >= 0.9 THEN 'very_high' WHEN greatest(abs(s), abs(p)) >= 0.7 THEN 'high' WHEN greatest(abs(s), abs(p)) >= 0.5 THEN 'moderate'
    WHEN greatest(abs(s), abs(p)) >= 0.3 THEN 'weak' ELSE 'very_weak' END"""
RELATED_SQL = f"""
l AS (SELECT *, CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice END AS price, CASE WHEN l_orderkey % 4 <> 1 THEN l_tax * l_quantity END AS due FROM lineitem),
t AS (SELECT 'l_quantity' AS a, 'price' AS b, l_quantity AS x, price AS y FROM l UNION ALL SELECT 'price', 'due', price, due FROM l
  UNION ALL SELECT 'l_discount', 'due', l_discount, due FROM l UNION ALL SELECT 'l_quantity', 'l_linenumber', l_quantity, l_linenumber FROM l),
v AS (SELECT * FROM t WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY x) + (COUNT(*) OVER (PARTITION BY a, b, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY a, b ORDER BY y) + (COUNT(*) OVER (PARTITION BY a, b, y) - 1) / 2.0 AS ry FROM v),
c AS (SELECT a, b, COUNT(*) AS n, corr(x, y) AS p, corr(rx, ry) AS s FROM r GROUP BY a, b)"""


def _related_lines(spark, sf):
    lines = read(spark, sf, "lineitem")
    price, due = F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice")), F.when(F.col("l_orderkey") % 4 != 1, F.col("l_tax") * F.col("l_quantity"))
    return lines.withColumns({"price": price, "due": due})


def _related(lines):
    return P.correlation_pairs(lines, [("l_quantity", "price"), ("price", "due"), ("l_discount", "due"), ("l_quantity", "l_linenumber")], table="lineitem")


@query("relationship_pairs", f"""
WITH {RELATED_SQL}
SELECT 'lineitem' AS table_name, a AS left_column, b AS right_column, n AS shared_rows, ROUND(p, 4) AS pearson, ROUND(s, 4) AS spearman,
  CASE WHEN abs(s) > abs(p) THEN 'spearman' ELSE 'pearson' END AS stronger_method, ROUND(CASE WHEN abs(s) > abs(p) THEN s ELSE p END, 4) AS stronger_value,
  CASE WHEN CASE WHEN abs(s) > abs(p) THEN s ELSE p END >= 0 THEN 'positive' ELSE 'negative' END AS direction, {_STRENGTH} AS strength FROM c""")
def relationship_pairs(spark, sf):
    """Four pairs with different gaps, each on its own complete rows, from one pass."""
    return _related(_related_lines(spark, sf))


@query("relationship_summary", f"""
WITH {RELATED_SQL},
d AS (SELECT COUNT(*) FILTER (l_extendedprice < l_quantity * 900) AS cheap, COUNT(*) FILTER (due < 0) AS negative FROM l)
SELECT 'lineitem' AS table_name, COUNT(*) AS correlation_pairs_profiled, COUNT(*) FILTER (greatest(abs(ROUND(p, 4)), abs(ROUND(s, 4))) >= 0.6) AS strong_pairs,
  CAST(2 AS BIGINT) AS dependency_checks_run, any_value(CAST(cheap > 0 AS BIGINT) + CAST(negative > 0 AS BIGINT)) AS failed_dependency_checks FROM c, d""")
def relationship_summary_query(spark, sf):
    """Strong pairs and failed dependency checks of one table."""
    lines = _related_lines(spark, sf)
    rules = [Q.predicate("price_covers_quantity", ["l_extendedprice", "l_quantity"], F.col("l_extendedprice") < F.col("l_quantity") * 900),
             Q.predicate("due_not_negative", ["due"], F.col("due") < 0, applicable=F.col("due").isNotNull())]
    return Q.relationship_summary(_related(lines), Q.run_checks(lines, rules, table="lineitem", dimension="relationships"))


@query("corr_matrix_complete", """
WITH v AS (SELECT l_quantity AS q, CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice END AS p, CASE WHEN l_orderkey % 4 <> 1 THEN l_tax * l_quantity END AS u FROM lineitem),
w AS (SELECT * FROM v WHERE q IS NOT NULL AND p IS NOT NULL AND u IS NOT NULL), c AS (SELECT corr(q, p) AS qp, corr(q, u) AS qu, corr(p, u) AS pu FROM w),
x AS (SELECT unnest([{'a': 'l_quantity', 'b': 'price', 'r': qp}, {'a': 'l_quantity', 'b': 'due', 'r': qu}, {'a': 'price', 'b': 'due', 'r': pu}]) AS s FROM c)
SELECT s.a AS "left", s.b AS "right", ROUND(s.r, 4) AS r FROM x UNION ALL SELECT s.b, s.a, ROUND(s.r, 4) FROM x
UNION ALL SELECT unnest(['l_quantity', 'price', 'due']) AS c, c, 1.0""")
def corr_matrix_complete(spark, sf):
    """Correlations over the rows in which no column is missing."""
    return P.correlation_matrix(_related_lines(spark, sf), ["l_quantity", "price", "due"], complete_rows=True)


@query("corr_matrix", """
WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS qp, corr(l_quantity, l_discount) AS qd, corr(l_quantity, l_tax) AS qt, corr(l_extendedprice, l_discount) AS pd,
  corr(l_extendedprice, l_tax) AS pt, corr(l_discount, l_tax) AS dt FROM lineitem),
u AS (SELECT unnest([{'a': 'l_quantity', 'b': 'l_extendedprice', 'r': qp}, {'a': 'l_quantity', 'b': 'l_discount', 'r': qd}, {'a': 'l_quantity', 'b': 'l_tax', 'r': qt},
  {'a': 'l_extendedprice', 'b': 'l_discount', 'r': pd}, {'a': 'l_extendedprice', 'b': 'l_tax', 'r': pt}, {'a': 'l_discount', 'b': 'l_tax', 'r': dt}]) AS s FROM c)
SELECT s.a AS "left", s.b AS "right", ROUND(s.r, 4) AS r FROM u UNION ALL SELECT s.b, s.a, ROUND(s.r, 4) FROM u
UNION ALL SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS c, c, 1.0""")
def corr_matrix(spark, sf):
    return P.correlation_matrix(read(spark, sf, "lineitem"), LINE_NUMBERS)


@query("target_correlations", """
WITH t AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS target FROM lineitem)
SELECT 'l_quantity' AS column_name, ROUND(corr(l_quantity, target), 4) AS r FROM t UNION ALL SELECT 'l_extendedprice', ROUND(corr(l_extendedprice, target), 4) FROM t
UNION ALL SELECT 'l_discount', ROUND(corr(l_discount, target), 4) FROM t UNION ALL SELECT 'l_tax', ROUND(corr(l_tax, target), 4) FROM t""")
def target_correlations_query(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("target", (F.col("l_returnflag") == "A").cast("int"))
    return P.target_correlations(lines, LINE_NUMBERS, "target")


@query("linear_fit", """
WITH t AS (SELECT log10(l_quantity) AS x, log10(l_extendedprice) AS y FROM lineitem WHERE l_quantity > 0 AND l_extendedprice > 0)
SELECT ROUND(regr_slope(y, x), 4) AS slope, ROUND(regr_intercept(y, x), 4) AS intercept, ROUND(corr(x, y), 4) AS r, COUNT(*) AS n FROM t""")
def linear_fit_query(spark, sf):
    out = P.linear_fit(read(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", log=True)
    return out.select(*[F.round(c, 4).alias(c) for c in ("slope", "intercept", "r")], "n")


@query("box_stats", """
WITH b AS (SELECT source, quantile_cont(n_chars, 0.25) AS q1, median(n_chars) AS median, quantile_cont(n_chars, 0.75) AS q3, COUNT(*) AS n FROM documents GROUP BY 1),
j AS (SELECT b.*, n_chars AS v, n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM b JOIN documents USING (source))
SELECT source, q1, median, q3, n, CAST(MIN(v) FILTER (inside) AS DOUBLE) AS low_whisker, CAST(MAX(v) FILTER (inside) AS DOUBLE) AS high_whisker,
  COUNT(*) FILTER (NOT inside) AS outliers FROM j GROUP BY ALL""")
def box_stats_query(spark, sf):
    return P.box_stats(read(spark, sf, "documents"), "n_chars", ["source"])


@query("kde_grid", """
WITH c AS (SELECT p_retailprice AS v, COUNT(*) AS n FROM part GROUP BY 1), s AS (SELECT COUNT(*) AS n, MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi, stddev_samp(p_retailprice) AS sd FROM part),
b AS (SELECT *, sd * pow(n, -0.2) AS h FROM s), g AS (SELECT unnest(range(0, 300)) AS point)
SELECT CAST(point AS INTEGER) AS point, ROUND(lo + point * (hi - lo) / 299, 4) AS x, ROUND(SUM(exp(-pow((lo + point * (hi - lo) / 299 - v) / h, 2) / 2) * c.n) / (any_value(b.n) * any_value(h) * sqrt(2 * pi())), 8) AS density
FROM g, b, c GROUP BY point, lo, hi""")
def kde_grid_query(spark, sf):
    return P.kde_grid(read(spark, sf, "part"), "p_retailprice").select("point", F.round("x", 4).alias("x"), F.round("density", 8).alias("density"))


@query("average_ranks", """
SELECT 'l_quantity' AS "column", l_quantity AS value, MIN(rk) + (COUNT(*) - 1) / 2.0 AS rank FROM (SELECT l_quantity, rank() OVER (ORDER BY l_quantity) AS rk FROM lineitem) GROUP BY 2""")
def average_ranks_query(spark, sf):
    return O.average_ranks(read(spark, sf, "lineitem"), ["l_quantity"])


@query("seeded_sample", "SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 500")
def seeded_sample_query(spark, sf):
    """A reproducible sample of orders; the size is the feature."""
    orders = read(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")).drop("o_orderdate")
    return O.seeded_sample(orders, key="o_orderkey", n=500)
