"""As-of lookups, look-back totals, follow-up totals and form rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.functions.scalars import safe_divide
from pitwise.operators.asof import asof_lookup, cumulative_history, interval_aggregate, interval_totals, lookback_totals
from pitwise.operators.timeline import LastValue, Totals, point_in_time
from pitwise.queries import query, read

MONEY = "decimal(18,2)"


def _orders(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast(MONEY).alias("price"), "o_orderstatus")


def _lines(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast(MONEY).alias("qty"), F.col("l_extendedprice").cast(MONEY).alias("price"), "l_returnflag")


ORDERS_SQL = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders"
LAST_PRICE_SQL = """SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d,
    arg_max(CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS p, arg_max(o_orderstatus, o_orderkey) AS s
  FROM orders GROUP BY 1, 2"""


@query("asof_prior_value", f"""
WITH a AS ({ORDERS_SQL}), h AS ({LAST_PRICE_SQL})
SELECT a.o_orderkey, a.o_custkey, CAST(h.p AS DOUBLE) AS prior_price, h.s AS prior_o_orderstatus, h.d AS prior_day
FROM a ASOF LEFT JOIN h ON a.o_custkey = h.k AND a.day > h.d""")
def asof_prior_value(spark, sf):
    """For each order, the same customer's last order on an earlier day."""
    orders = _orders(spark, sf)
    out = asof_lookup(orders, orders.select("o_custkey", "day", "price", "o_orderstatus", "o_orderkey"), by=["o_custkey"], anchor_on="day",
                      history_on="day", values=["price", "o_orderstatus"], prefix="prior_", order_ties_by=["o_orderkey"], allow_exact=False)
    return out.select("o_orderkey", "o_custkey", F.col("prior_price").cast("double").alias("prior_price"), "prior_o_orderstatus", "prior_day")


@query("asof_180d_value", f"""
WITH a AS ({ORDERS_SQL}), h AS ({LAST_PRICE_SQL}),
b AS (SELECT a.*, a.day - 180 AS d180, a.day - 365 AS d365 FROM a),
c AS (SELECT b.*, h.p AS p180 FROM b ASOF LEFT JOIN h ON b.o_custkey = h.k AND b.d180 >= h.d),
e AS (SELECT c.*, h.p AS p365 FROM c ASOF LEFT JOIN h ON c.o_custkey = h.k AND c.d365 >= h.d)
SELECT o_orderkey, CAST(p180 AS DOUBLE) AS price_180d, CAST(p365 AS DOUBLE) AS price_365d,
       CAST(price - p180 AS DOUBLE) AS change_180d, CAST(price - p365 AS DOUBLE) AS change_365d FROM e""")
def asof_180d_value(spark, sf):
    """Value as of 180 and 365 days before each order, and the change since."""
    orders = _orders(spark, sf)
    ago = {f"d{days}": F.date_sub("day", days) for days in (180, 365)}
    out = point_in_time(orders, by=["o_custkey"], on=["day"], instants=ago, sources={"orders": (orders, F.col("day"))}, probes=[
        LastValue("orders", f"d{days}", {f"at{days}_price": F.col("price")}, [F.col("o_orderkey")]) for days in (180, 365)])
    return out.select("o_orderkey", *[F.col(f"at{d}_price").cast("double").alias(f"price_{d}d") for d in (180, 365)],
                      *[(F.col("price") - F.col(f"at{d}_price")).cast("double").alias(f"change_{d}d") for d in (180, 365)])


@query("asof_event_value", """
WITH h AS (SELECT user_id, ts, arg_max(value, event_id) AS v, max(event_id) AS e FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT a.event_id, h.v AS last_value, h.e AS last_event_id, CAST(epoch_us(h.ts) AS BIGINT) AS last_us
FROM events a ASOF LEFT JOIN h ON a.user_id = h.user_id AND a.ts >= h.ts""")
def asof_event_value(spark, sf):
    """For each event, the user's last purchase up to that microsecond."""
    events = read(spark, sf, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", "value", "event_id")
    out = asof_lookup(events.select("event_id", "user_id", "ts"), bought, by=["user_id"], anchor_on="ts", history_on="ts",
                      values=["value", "event_id"], prefix="last_", order_ties_by=["event_id"])
    return out.select("event_id", "last_value", "last_event_id", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', last_ts)").alias("last_us"))


@query("cumulative_history", """
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, day, CAST(SUM(n) OVER w AS BIGINT) AS cum_lines, CAST(SUM(q) OVER w AS DOUBLE) AS cum_quantity
FROM d WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)""")
def cumulative_history_query(spark, sf):
    """Running shipment totals per supplier and day."""
    out = cumulative_history(_lines(spark, sf), by=["l_suppkey"], on="day", metrics={"lines": F.lit(1), "quantity": F.col("qty")})
    return out.withColumn("cum_quantity", F.col("cum_quantity").cast("double"))


@query("cumulative_lookup", """
WITH d AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1, 2),
c AS (SELECT k, day, SUM(q) OVER (PARTITION BY k ORDER BY day) AS cum FROM d),
a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_custkey % (SELECT COUNT(*) FROM supplier) AS k FROM orders)
SELECT a.o_orderkey, CAST(COALESCE(c.cum, 0) AS DOUBLE) AS shipped_so_far FROM a ASOF LEFT JOIN c ON a.k = c.k AND a.day >= c.day""")
def cumulative_lookup(spark, sf):
    """Running total as of the order day, 0 without history."""
    history = cumulative_history(_lines(spark, sf).withColumnRenamed("l_suppkey", "k"), by=["k"], on="day", metrics={"quantity": F.col("qty")})
    suppliers = read(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()
    anchors = _orders(spark, sf).select("o_orderkey", "day", (F.col("o_custkey") % suppliers).alias("k"))
    out = asof_lookup(anchors, history, by=["k"], anchor_on="day", history_on="day", values=["cum_quantity"], prefix="as_of_")
    return out.select("o_orderkey", F.coalesce(F.col("as_of_cum_quantity").cast("double"), F.lit(0.0)).alias("shipped_so_far"))


@query("lookback_totals_180_365", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
d AS (SELECT o_custkey, day, COUNT(*) AS n, SUM(price) AS p FROM o GROUP BY 1, 2),
w AS (SELECT o_custkey, day,
  SUM(n) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL 179 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS n180,
  SUM(p) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL 179 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS p180,
  SUM(n) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS n365,
  SUM(p) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS p365 FROM d)
SELECT o.o_orderkey, CAST(COALESCE(n180, 0) AS BIGINT) AS orders_180d, CAST(COALESCE(p180, 0) AS DOUBLE) AS spend_180d,
  CAST(COALESCE(n365, 0) AS BIGINT) AS orders_365d, CAST(COALESCE(p365, 0) AS DOUBLE) AS spend_365d,
  ROUND(CAST(p180 AS DOUBLE) * 90 / n180, 2) AS spend_per_90_180d
FROM o JOIN w USING (o_custkey, day)""")
def lookback_totals_query(spark, sf):
    """Order count and spend of the customer in the 180 and 365 days before each order, order day excluded."""
    orders = _orders(spark, sf)
    out = lookback_totals(orders, orders, by=["o_custkey"], anchor_on="day", fact_on="day",
                          metrics={"orders": F.lit(1), "spend": F.col("price")}, windows={"180d": (-179, -1), "365d": (-364, -1)})
    rate = F.round(safe_divide(F.col("spend_180d").cast("double") * 90, "orders_180d"), 2)
    return out.select("o_orderkey", *[F.col(f"orders_{w}").cast("long").alias(f"orders_{w}") for w in ("180d", "365d")],
                      *[F.col(f"spend_{w}").cast("double").alias(f"spend_{w}") for w in ("180d", "365d")], rate.alias("spend_per_90_180d"))


@query("follow_up_totals", """
WITH a AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH AS DATE) AS until FROM orders),
f AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS p FROM orders GROUP BY 1, 2)
SELECT a.o_orderkey, CAST(COALESCE(SUM(f.n), 0) AS BIGINT) AS next_orders, CAST(COALESCE(SUM(f.p), 0) AS DOUBLE) AS next_spend
FROM a LEFT JOIN f ON a.o_custkey = f.o_custkey AND f.day > a.day AND f.day <= a.until GROUP BY 1""")
def follow_up_totals(spark, sf):
    """Orders and spend within 24 calendar months after each order."""
    orders = _orders(spark, sf).withColumn("until", F.add_months("day", 24))
    out = interval_totals(orders, orders, by=["o_custkey"], after="day", until="until", fact_on="day",
                          metrics={"orders": F.lit(1), "spend": F.col("price")}, prefix="next_")
    return out.select("o_orderkey", F.col("next_orders").cast("long").alias("next_orders"), F.col("next_spend").cast("double").alias("next_spend"))


@query("interval_join_agg", """
WITH a AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR AS DATE) AS e FROM orders)
SELECT a.o_orderkey, CAST(SUM(CAST(f.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(f.o_totalprice) AS highest, MIN(f.o_totalprice) AS lowest
FROM a LEFT JOIN orders f ON a.o_custkey = f.o_custkey AND CAST(f.o_orderdate AS DATE) >= a.day AND CAST(f.o_orderdate AS DATE) < a.e GROUP BY 1""")
def interval_join_agg(spark, sf):
    """Sum, maximum and minimum of the customer's orders in the three years from each order on."""
    orders = _orders(spark, sf).withColumn("stop", F.add_months("day", 36))
    out = interval_aggregate(orders, orders, by=["o_custkey"], start="day", end="stop", fact_on="day", grain="year", aggregates={
        "total": ("sum", F.col("price")), "highest": ("max", F.col("price")), "lowest": ("min", F.col("price"))})
    return out.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("total", "highest", "lowest")])


FORM_SQL = """WITH f AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, COUNT(*) AS m, COUNT(*) FILTER (l_returnflag = 'A') AS w,
  SUM(CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 1 ELSE 0 END) AS p FROM lineitem GROUP BY 1, 2)"""


@query("supplier_form", FORM_SQL + """,
a AS (SELECT s_suppkey, d.day FROM supplier CROSS JOIN (SELECT DISTINCT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS day FROM lineitem) d),
t AS (SELECT a.s_suppkey, a.day, SUM(m) AS m, SUM(w) AS w, SUM(p) AS p FROM a LEFT JOIN f ON f.l_suppkey = a.s_suppkey
      AND f.day > a.day - 365 AND f.day <= a.day - 1 GROUP BY 1, 2)
SELECT s_suppkey, day, CAST(COALESCE(m, 0) AS BIGINT) AS matches_365d, ROUND(CAST(w AS DOUBLE) / m, 4) AS win_rate_365d,
  ROUND(CAST(p AS DOUBLE) / m, 4) AS points_per_match_365d FROM t""")
def supplier_form(spark, sf):
    """Win rate and points per shipment of each supplier over the year before each quarter."""
    lines = _lines(spark, sf)
    quarters = lines.select(F.trunc("day", "quarter").alias("day")).distinct()
    span = quarters.agg(F.sort_array(F.collect_set("day")).alias("days"))     # one entry per calendar quarter
    anchors = read(spark, sf, "supplier").select("s_suppkey", F.explode(F.lit(span.scalar())).alias("day"))
    flag = F.col("l_returnflag")
    out = lookback_totals(anchors, lines.withColumnRenamed("l_suppkey", "s_suppkey"), by=["s_suppkey"], anchor_on="day", fact_on="day",
                          metrics={"matches": F.lit(1), "wins": (flag == "A").cast("int"), "points": F.when(flag == "A", 3).when(flag == "N", 1).otherwise(0)},
                          windows={"365d": (-364, -1)})
    return out.select("s_suppkey", "day", F.col("matches_365d").cast("long").alias("matches_365d"),
                      F.round(safe_divide("wins_365d", "matches_365d"), 4).alias("win_rate_365d"),
                      F.round(safe_divide("points_365d", "matches_365d"), 4).alias("points_per_match_365d"))


@query("exact_window_totals", """
WITH a AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(38,2)) + CASE WHEN o_orderkey % 7 = 0 THEN 1e17::DECIMAL(38,2) ELSE 0 END AS v FROM orders),
t AS (SELECT a.o_orderkey, SUM(f.v) AS v FROM a JOIN (SELECT o_custkey, day, SUM(v) AS v FROM a GROUP BY 1, 2) f ON a.o_custkey = f.o_custkey AND f.day > a.day AND f.day <= a.day + 90 GROUP BY 1)
SELECT a.o_orderkey, CAST(COALESCE(t.v, 0) AS DOUBLE) AS next_90d, CAST(COALESCE(t.v, 0) AS DOUBLE) AS next_90d_by_interval FROM a LEFT JOIN t USING (o_orderkey)""")
def exact_window_totals(spark, sf):
    """Totals of doubles over the 90 days after each order, with amounts beside them that are 17 digits larger; no cent is lost where those lie outside."""
    whole = F.col("o_totalprice")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), whole.alias("price"), F.when(F.col("o_orderkey") % 7 == 0, 1e17).otherwise(0.0).alias("large"))
    parts = orders.select("o_custkey", "day", F.explode(F.array("price", "large")).alias("amount"))      # as two rows: their sum is no double
    out = point_in_time(orders, by=["o_custkey"], on=["day"], instants={"day": F.col("day"), "end": F.date_add("day", 90)}, sources={"parts": (parts, F.col("day"))},
                        probes=[Totals("parts", "day", "end", {"next_90d": F.col("amount")})])
    out = interval_totals(out.withColumn("end", F.date_add("day", 90)), parts, by=["o_custkey"], after="day", until="end", fact_on="day",
                          metrics={"next_90d_by_interval": F.col("amount")}, points=orders.withColumn("end", F.date_add("day", 90)))
    return out.select("o_orderkey", "next_90d", "next_90d_by_interval")


@query("timeline_answers", """
WITH o AS (SELECT o_orderkey, o_custkey AS k, o_orderpriority AS place, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderstatus AS status FROM orders),
l AS (SELECT o_custkey AS k, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS DECIMAL(18,2)) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT k, day, SUM(qty) AS qty FROM l GROUP BY 1, 2),
pd AS (SELECT k, place, day, COUNT(*) AS n, SUM(price) AS price FROM o GROUP BY 1, 2, 3),
h AS (SELECT k, day, arg_max(price, o_orderkey) AS price FROM o GROUP BY 1, 2), hf AS (SELECT k, day, arg_max(price, o_orderkey) AS price FROM o WHERE status = 'F' GROUP BY 1, 2),
q AS (SELECT o_orderkey, SUM(d.qty) AS qty FROM o JOIN d ON o.k = d.k AND d.day > o.day - 91 AND d.day <= o.day - 1 GROUP BY 1),
s AS (SELECT o_orderkey, SUM(pd.n) AS n, SUM(pd.price) AS price FROM o JOIN pd ON o.k = pd.k AND o.place = pd.place AND pd.day > o.day AND pd.day <= o.day + 365 GROUP BY 1),
p1 AS (SELECT o.o_orderkey, h.price, h.day FROM o ASOF LEFT JOIN h ON o.k = h.k AND o.day > h.day),
p2 AS (SELECT o.o_orderkey, hf.price FROM (SELECT *, day + 365 AS ahead FROM o) o ASOF LEFT JOIN hf ON o.k = hf.k AND o.ahead >= hf.day)
SELECT o.o_orderkey, CAST(p1.price AS DOUBLE) AS prior_price, p1.day AS prior_day, CAST(p2.price AS DOUBLE) AS finished_price, CAST(COALESCE(q.qty, 0) AS DOUBLE) AS shipped_90d,
  CAST(COALESCE(s.n, 0) AS BIGINT) AS next_orders, CAST(COALESCE(s.price, 0) AS DOUBLE) AS next_spend
FROM o JOIN p1 USING (o_orderkey) JOIN p2 USING (o_orderkey) LEFT JOIN q USING (o_orderkey) LEFT JOIN s USING (o_orderkey)""")
def timeline_answers(spark, sf):
    """Two last values, a look-back total of another table, and totals at the same priority ahead, all from one timeline."""
    orders = read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("place"), F.to_date("o_orderdate").alias("day"),
                                              F.col("o_totalprice").cast(MONEY).alias("price"), "o_orderstatus")
    lines = _lines(spark, sf).join(read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("k")), "l_orderkey")
    out = point_in_time(orders, by=["k"], within=["place"], on=["day"], instants={
        "day": F.col("day"), "before": F.date_sub("day", 1), "from": F.date_sub("day", 91), "ahead": F.date_add("day", 365)},
        sources={"orders": (orders, F.col("day")), "lines": (lines, F.col("day"))}, probes=[
            LastValue("orders", "day", {"prior_price": F.col("price")}, [F.col("o_orderkey")], strict=True, dated="prior_day"),
            LastValue("orders", "ahead", {"finished_price": F.col("price")}, [F.col("o_orderkey")], where=F.col("o_orderstatus") == "F"),
            Totals("lines", "from", "before", {"shipped_90d": F.col("qty")}),
            Totals("orders", "day", "ahead", {"next_orders": F.lit(1), "next_spend": F.col("price")}, inside=True)])
    return out.select("o_orderkey", "prior_day", F.col("next_orders").cast("long").alias("next_orders"),
                      *[F.col(c).cast("double").alias(c) for c in ("prior_price", "finished_price", "shipped_90d", "next_spend")])
