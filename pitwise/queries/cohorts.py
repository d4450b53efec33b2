"""Audited cohorts, enrichment and follow-up labels over orders, the analogue of transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.functions.scalars import age_at, safe_divide, same_flag
from pitwise.operators import cohort as C
from pitwise.operators.joins import keep_last, lookup, role_lookup
from pitwise.operators.timeline import LastValue, Totals, point_in_time
from pitwise.queries import query, read
from pitwise.queries.pointintime import _lines, _orders

START, END = "1996-01-01", "2000-12-31"
REGIONS = ("ASIA", "EUROPE")

# The business key (customer, month, status) repeats; the order key gives the file order.
AUDIT_SQL = """
o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, o_orderstatus, o_totalprice,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
j AS (SELECT o.*, r.r_name AS region, n.n_name AS nation FROM o JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND c.c_nationkey <> 7 LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, month, o_orderstatus ORDER BY o_orderkey) AS copy FROM j),
audited AS (SELECT *, NULLIF(concat_ws(';',
    CASE WHEN day IS NULL THEN 'missing_date' END,
    CASE WHEN day < DATE '1996-01-01' THEN 'before_window' END,
    CASE WHEN day > DATE '2000-12-31' THEN 'after_window' END,
    CASE WHEN region IS NULL THEN 'missing_region' END,
    CASE WHEN region NOT IN (SELECT r_name FROM region ORDER BY r_name LIMIT 2) THEN 'region_out_of_scope' END,
    CASE WHEN copy > 1 THEN 'duplicate_business_key' END), '') AS reason FROM k)
"""


def audited_orders(spark, sf):
    """Orders with nation and region of the customer, and every reason to exclude them.

    Order dates are removed for every 50th order and one nation is unknown, so that the missing-value reasons occur.
    """
    orders = read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.when(F.col("o_orderkey") % 50 != 0, F.to_date("o_orderdate")).alias("day"),
        F.to_date(F.trunc("o_orderdate", "month")).alias("month"))
    regions = read(spark, sf, "region")
    in_scope = regions.agg(F.slice(F.sort_array(F.collect_set("r_name")), 1, 2)).scalar()     # names of a five-row dimension
    nations = lookup(read(spark, sf, "nation").withColumn("n_nationkey", F.when(F.col("n_nationkey") == 7, F.lit(-7)).otherwise(F.col("n_nationkey"))), regions, on={"n_regionkey": "r_regionkey"}, take={"r_name": "region"})
    homes = lookup(read(spark, sf, "customer"), nations, on={"c_nationkey": "n_nationkey"}, take={"region": "region", "n_name": "nation"})
    joined = lookup(orders, homes, on={"o_custkey": "c_custkey"}, take={"region": "region", "nation": "nation"})
    rules = C.window_rules("day", START, END, missing="missing_date", before="before_window", after="after_window") + [
        ("missing_region", F.col("region").isNull()),
        ("region_out_of_scope", ~F.array_contains(in_scope, F.col("region")))]
    return C.audit(joined, rules, duplicate_keys=["o_custkey", "month", "o_orderstatus"], order_by="o_orderkey",
                   duplicate_reason="duplicate_business_key", name="reason")


@query("audited_cohort", "WITH " + AUDIT_SQL + " SELECT o_orderkey, o_custkey, day, region, nation, reason FROM audited")
def audited_cohort(spark, sf):
    return audited_orders(spark, sf).select("o_orderkey", "o_custkey", "day", "region", "nation", "reason")


@query("included_rows", "WITH " + AUDIT_SQL + " SELECT o_orderkey, day, nation FROM audited WHERE reason IS NULL")
def included_rows(spark, sf):
    return C.included(audited_orders(spark, sf), "reason").select("o_orderkey", "day", "nation")


@query("excluded_reasons", "WITH " + AUDIT_SQL + """, x AS (SELECT unnest(string_split(reason, ';')) AS reason FROM audited WHERE reason IS NOT NULL)
SELECT reason, COUNT(*) AS rows FROM x GROUP BY 1""")
def excluded_reasons(spark, sf):
    return C.reason_counts(C.excluded(audited_orders(spark, sf), "reason"), "reason")


@query("audit_summary", "WITH " + AUDIT_SQL + """
SELECT 'raw_rows' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM audited
UNION ALL SELECT 'included_rows', CAST(COUNT(*) FILTER (reason IS NULL) AS VARCHAR) FROM audited
UNION ALL SELECT 'excluded_rows', CAST(COUNT(*) FILTER (reason IS NOT NULL) AS VARCHAR) FROM audited
UNION ALL SELECT 'start_date', '1996-01-01' UNION ALL SELECT 'end_date', '2000-12-31'""")
def audit_summary(spark, sf):
    reason = F.col("reason")
    return C.metric_values({"raw_rows": F.count(F.lit(1)), "included_rows": F.count_if(reason.isNull()), "excluded_rows": F.count_if(reason.isNotNull()),
                            "start_date": F.lit(START), "end_date": F.lit(END)}, audited_orders(spark, sf))


@query("enriched_cohort", """
WITH d AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day,
  a.n_name AS source_nation, a.r_name AS source_region, b.n_name AS destination_nation, b.r_name AS destination_region,
  CAST(a.n_name = b.n_name AS INTEGER) AS is_same_nation, CAST(a.r_name = b.r_name AS INTEGER) AS is_same_region,
  CAST(date_part('year', l_shipdate) - date_part('year', o_orderdate)
    - CASE WHEN (month(l_shipdate), day(l_shipdate)) < (month(o_orderdate), day(o_orderdate)) THEN 1 ELSE 0 END AS BIGINT) AS years_since_order
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN d a ON s_nationkey = a.n_nationkey JOIN d b ON c_nationkey = b.n_nationkey""")
def enriched_cohort(spark, sf):
    """Shipments with supplier and customer nation in two roles of one dimension."""
    lines = _lines(spark, sf)
    orders = lookup(read(spark, sf, "orders"), read(spark, sf, "customer"), on={"o_custkey": "c_custkey"}, take={"c_nationkey": "to_nation"})
    out = lookup(lines, orders, on={"l_orderkey": "o_orderkey"}, take={"to_nation": "to_nation", "o_orderdate": "ordered"})
    out = lookup(out, read(spark, sf, "supplier"), on={"l_suppkey": "s_suppkey"}, take={"s_nationkey": "from_nation"})
    places = lookup(read(spark, sf, "nation"), read(spark, sf, "region"), on={"n_regionkey": "r_regionkey"}, take={"r_name": "region"}).withColumnRenamed("n_name", "nation")
    out = role_lookup(out, places, key="n_nationkey", roles={"source": "from_nation", "destination": "to_nation"}, take=["nation", "region"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "day", "source_nation", "source_region", "destination_nation",
                      "destination_region", same_flag("source_nation", "destination_nation").alias("is_same_nation"),
                      same_flag("source_region", "destination_region").alias("is_same_region"), age_at("day", "ordered").alias("years_since_order"))


LABEL_SQL = """
a AS (SELECT o_orderkey, o_custkey AS k, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH AS DATE) AS until,
        o_orderpriority AS place, CASE WHEN o_orderkey % 40 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS base FROM orders),
h AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, arg_max(CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS v FROM orders
        WHERE o_orderstatus = 'F' GROUP BY 1, 2),
e AS (SELECT a.*, h.v AS end_value, h.d AS end_day FROM a ASOF LEFT JOIN h ON a.k = h.k AND a.until >= h.d),
f AS (SELECT o_custkey AS k, o_orderpriority AS place, CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS p
        FROM orders GROUP BY 1, 2, 3),
t AS (SELECT e.o_orderkey, SUM(f.n) AS n, SUM(f.p) AS p FROM e JOIN f ON e.k = f.k AND e.place = f.place AND f.d >= e.day AND f.d <= e.until GROUP BY 1),
x AS (SELECT e.*, COALESCE(t.n, 0) AS n, COALESCE(t.p, 0) AS p, (SELECT MAX(d) FROM h) AS horizon FROM e LEFT JOIN t USING (o_orderkey)),
labelled AS (SELECT *, NULLIF(concat_ws(';',
    CASE WHEN base IS NULL THEN 'missing_baseline_value' END,
    CASE WHEN end_value IS NULL THEN 'missing_follow_up_value' END,
    CASE WHEN end_day IS NULL OR end_day <= day THEN 'no_value_inside_follow_up_window' END,
    CASE WHEN until > horizon THEN 'incomplete_follow_up_window' END), '') AS failure_reason FROM x)
"""


def _judged_orders(spark, sf):
    """All orders as a cohort, and what judges them: the customer's activity at the same priority and the last finished value within 24 months."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("place"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus")
    cohort = orders.select("o_orderkey", "k", "day", "place", F.when(F.col("o_orderkey") % 40 != 0, F.col("price")).alias("base"))
    return cohort, C.FollowUp(entity="k", place="place", date="day", activity=orders, activity_on="day", metrics={"orders": F.lit(1), "spend": F.col("price")},
                              threshold_metric="spend", threshold=500_000, valuations=orders, value_on="day", value="price", baseline="base",
                              value_ties=["o_orderkey"], valuations_where=F.col("o_orderstatus") == "F")


def labelled_orders(spark, sf):
    return C.follow_up_label(*_judged_orders(spark, sf))


@query("follow_up_label", "WITH " + LABEL_SQL + """
SELECT o_orderkey, day, until AS follow_up_window_end, CAST(n AS BIGINT) AS target_orders, CAST(p AS DOUBLE) AS target_spend,
  CAST(end_value AS DOUBLE) AS target_end_value, end_day AS target_end_value_date, CAST(end_value - base AS DOUBLE) AS target_value_delta, failure_reason,
  CASE WHEN failure_reason IS NULL THEN CAST(p >= 500000 AND end_value >= base AS INTEGER) END AS success FROM labelled""")
def follow_up_label_query(spark, sf):
    return labelled_orders(spark, sf).select(
        "o_orderkey", "day", "follow_up_window_end", F.col("target_orders").cast("long").alias("target_orders"),
        *[F.col(c).cast("double").alias(c) for c in ("target_spend", "target_end_value")], "target_end_value_date",
        F.col("target_value_delta").cast("double").alias("target_value_delta"), F.col("target_failure_reason").alias("failure_reason"), "success")


@query("label_failures", "WITH " + LABEL_SQL + """, x2 AS (SELECT unnest(string_split(failure_reason, ';')) AS reason FROM labelled WHERE failure_reason IS NOT NULL)
SELECT reason, COUNT(*) AS rows FROM x2 GROUP BY 1""")
def label_failures(spark, sf):
    return C.reason_counts(labelled_orders(spark, sf).where("not target_is_eligible"), "target_failure_reason")


SCORE_SQL = """
t AS (SELECT o_orderkey, o_custkey AS k, o_orderpriority AS place, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price FROM orders),
s AS (SELECT DISTINCT k, place, day, CAST(day + INTERVAL 3 YEAR AS DATE) AS stop FROM t),
act AS (SELECT s.k, s.place, s.day, COUNT(*) AS n, SUM(CAST(f.price AS DECIMAL(18,2))) AS p FROM s JOIN t f ON s.k = f.k AND s.place = f.place AND f.day >= s.day AND f.day < s.stop GROUP BY 1, 2, 3),
val AS (SELECT s.k, s.place, s.day, MAX(f.price) AS v FROM s JOIN t f ON s.k = f.k AND s.place = f.place AND f.day >= s.day AND f.day < s.stop
   JOIN orders o ON o.o_orderkey = f.o_orderkey AND o.o_orderstatus = 'F' GROUP BY 1, 2, 3),
lim(place, min_n, min_p) AS (VALUES ('1-URGENT', 3, 600000), ('2-HIGH', 2, 500000), ('3-MEDIUM', 2, 400000), ('5-LOW', 1, 300000)),
"""


def _scored(spark, sf, pool: bool):
    orders = read(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("place"), F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus")
    limits = spark.createDataFrame([("1-URGENT", 3, 600000), ("2-HIGH", 2, 500000), ("3-MEDIUM", 2, 400000), ("5-LOW", 1, 300000)],
                                   "limit_place string, min_n int, min_p int")
    stats = C.window_scores(orders, orders, orders.where("o_orderstatus = 'F'"), entity="k", place="place", date="day", activity_on="day",
                            activity_place="place", sums={"n": F.lit(1), "p": F.col("price")}, value_on="day", value_place="place",
                            value="price", pool_places=pool)
    return lookup(stats, F.broadcast(limits), on={"place": "limit_place"}, take={"min_n": "min_n", "min_p": "min_p"})


@query("weighted_label", "WITH " + SCORE_SQL + """
pooled AS (SELECT s.k, s.day, SUM(n) AS n, SUM(p) AS p, MAX(v) AS v FROM s LEFT JOIN act USING (k, place, day) LEFT JOIN val USING (k, place, day) GROUP BY 1, 2),
x AS (SELECT t.*, COALESCE(n, 0) AS n, COALESCE(p, 0) AS p, COALESCE(v, 0) AS v, min_n, min_p FROM t LEFT JOIN pooled USING (k, day) LEFT JOIN lim USING (place)),
y AS (SELECT o_orderkey, CAST(n AS BIGINT) AS n, CAST(p AS DOUBLE) AS p, CASE WHEN p >= 800000 THEN 3 ELSE 0 END + CASE WHEN n >= min_n THEN 1 ELSE 0 END
   + CASE WHEN p >= min_p THEN 1 ELSE 0 END + CASE WHEN v > price THEN 3 ELSE 0 END AS score FROM x)
SELECT o_orderkey, n, p, score, CAST(score >= 5 AS INTEGER) AS success FROM y""")
def weighted_label(spark, sf):
    """Weighted vote over pooled three-year statistics with a threshold table per priority."""
    scored = C.score_label(_scored(spark, sf, True), [
        (F.col("p") >= 800_000, 3), (F.col("n") >= F.col("min_n"), 1), (F.col("p") >= F.col("min_p"), 1), (F.col("new_value") > F.col("price"), 3)], 5)
    return scored.select("o_orderkey", F.col("n").cast("long").alias("n"), F.col("p").cast("double").alias("p"), "score", "success")


@query("unweighted_label", "WITH " + SCORE_SQL + """
x AS (SELECT t.*, COALESCE(n, 0) AS n, COALESCE(p, 0) AS p, v, min_n, min_p FROM t LEFT JOIN act USING (k, place, day) LEFT JOIN val USING (k, place, day) LEFT JOIN lim USING (place)),
y AS (SELECT o_orderkey, CASE WHEN p >= 800000 THEN 1 ELSE 0 END + CASE WHEN n >= min_n THEN 1 ELSE 0 END
   + CASE WHEN p >= min_p THEN 1 ELSE 0 END + CASE WHEN v > price THEN 1 ELSE 0 END AS score FROM x)
SELECT o_orderkey, score, CAST(score >= 2 AS INTEGER) AS success FROM y""")
def unweighted_label(spark, sf):
    """Equal votes over statistics at the row's own place; half of the votes make a success."""
    scored = C.score_label(_scored(spark, sf, False), [
        (F.col("p") >= 800_000, 1), (F.col("n") >= F.col("min_n"), 1), (F.col("p") >= F.col("min_p"), 1), (F.col("new_value") > F.col("price"), 1)], 2)
    return scored.select("o_orderkey", "score", "success")


@query("order_point_in_time", "WITH " + LABEL_SQL + """,
d AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS p FROM orders GROUP BY 1, 2),
w AS (SELECT k, day, SUM(n) OVER v AS n180, SUM(p) OVER v AS p180 FROM d
   WINDOW v AS (PARTITION BY k ORDER BY day RANGE BETWEEN INTERVAL 179 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
prior AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, arg_max(CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS v FROM orders GROUP BY 1, 2),
z AS (SELECT l.*, w.n180, w.p180, (SELECT arg_max(v, d) FROM prior p WHERE p.k = l.k AND p.d < l.day) AS prior_value FROM labelled l JOIN w USING (k, day))
SELECT o_orderkey, k AS o_custkey, day, CAST(prior_value AS DOUBLE) AS prior_value, CAST(COALESCE(n180, 0) AS BIGINT) AS orders_180d,
  CAST(COALESCE(p180, 0) AS DOUBLE) AS spend_180d, ROUND(CAST(base AS DOUBLE) / prior_value, 4) AS value_ratio, failure_reason,
  CASE WHEN failure_reason IS NULL THEN CAST(p >= 500000 AND end_value >= base AS INTEGER) END AS success FROM z""")
def order_point_in_time(spark, sf):
    """Flagship: prior value, 180-day totals, eligibility and follow-up outcome for every order."""
    cohort, judged = _judged_orders(spark, sf)
    work = judged.judge(point_in_time(
        cohort, by=["k"], within=["place"], on=["day"], instants={**judged.instants(), "half_year": F.date_sub("day", 180)}, sources=judged.sources(), probes=[
            *judged.probes(), Totals("activity", "half_year", "before", {"orders_180d": F.lit(1), "spend_180d": F.col("price")}),
            LastValue("activity", "before", {"prior_price": F.col("price")}, [F.col("o_orderkey")])]))
    return work.select("o_orderkey", F.col("k").alias("o_custkey"), "day", F.col("prior_price").cast("double").alias("prior_value"),
                       F.col("orders_180d").cast("long").alias("orders_180d"), F.col("spend_180d").cast("double").alias("spend_180d"),
                       F.round(safe_divide("base", "prior_price"), 4).alias("value_ratio"), F.col("target_failure_reason").alias("failure_reason"), "success")


@query("keep_last_per_key", """
SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def keep_last_per_key(spark, sf):
    """The latest order of each customer and priority."""
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return keep_last(orders, ["o_custkey", "o_orderpriority"], ["day", "o_orderkey"])
