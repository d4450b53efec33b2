"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.functions import scalars as S
from pitwise.functions.text import entity_key, normalize_text
from pitwise.queries import query, read
from pitwise.session import spread


@query("coerce_values", """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN CAST(o_totalprice AS VARCHAR) || 'x' WHEN 2 THEN 'nan' ELSE CAST(o_totalprice AS VARCHAR) END AS num,
  CASE o_orderkey % 5 WHEN 0 THEN 'not a date' WHEN 1 THEN '' WHEN 2 THEN '1997-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dat, o_totalprice FROM orders)
SELECT o_orderkey, CASE WHEN isnan(TRY_CAST(num AS DOUBLE)) THEN NULL ELSE TRY_CAST(num AS DOUBLE) END AS number_value,
  TRY_CAST(dat AS DATE) AS date_value, (dat IS NULL OR trim(dat) = '') AS is_missing, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS VARCHAR) AS one_decimal FROM t""")
def coerce_values(spark, sf):
    """Numbers and dates from messy text; what cannot be read becomes null."""
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd")
    num = F.when(key % 6 == 0, "N/A").when(key % 6 == 1, F.concat(price.cast("string"), F.lit("x"))).when(key % 6 == 2, "nan").otherwise(price.cast("string"))
    dat = F.when(key % 5 == 0, "not a date").when(key % 5 == 1, "").when(key % 5 == 2, "1997-02-30").otherwise(day)
    t = read(spark, sf, "orders").select("o_orderkey", num.alias("num"), dat.alias("dat"), "o_totalprice")
    return t.select("o_orderkey", S.to_number("num").alias("number_value"), S.parse_date("dat").alias("date_value"),
                    S.missing_mask("dat").alias("is_missing"), S.stringify_1dp("o_totalprice").alias("one_decimal"))


@query("safe_divide", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / NULLIF(l_discount, 0) AS ratio,
  l_extendedprice / NULLIF(CASE WHEN l_tax > 0.02 THEN l_quantity END, 0) AS unit_price FROM lineitem""")
def safe_divide_query(spark, sf):
    taxed = F.when(F.col("l_tax") > 0.02, F.col("l_quantity"))
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.safe_divide("l_extendedprice", "l_discount").alias("ratio"),
        S.safe_divide("l_extendedprice", taxed).alias("unit_price"))


@query("normalize_text", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS folded
FROM documents""")
def normalize_text_query(spark, sf):
    """Whole documents folded to lower-case ASCII words."""
    return spread(read(spark, sf, "documents").select("doc_id", "text")).select("doc_id", normalize_text("text").alias("folded"))


@query("entity_key", r"""
WITH t AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS n FROM part),
k AS (SELECT p_partkey, list_aggregate(list_filter(string_split(n, ' '), lambda w: w NOT IN ('brand', 'red', 'small')), 'string_agg', ' ') AS k FROM t)
SELECT p_partkey, CASE k WHEN 'ring 5' THEN 'band five' WHEN 'widget 17' THEN 'gadget' ELSE COALESCE(k, '') END AS entity FROM k""")
def entity_key_query(spark, sf):
    """Part names without stop-words; an alias replaces the whole key."""
    return read(spark, sf, "part").select("p_partkey", entity_key(
        F.concat_ws(" ", "p_name", "p_brand"), ["brand", "red", "small"], {"ring 5": "band five", "widget 17": "gadget"}).alias("entity"))


@query("season_years", """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%y') || '/' || strftime(o_orderdate + INTERVAL 1 YEAR, '%y')
  WHEN 1 THEN 'xx/yy' WHEN 2 THEN NULL ELSE strftime(o_orderdate, '%Y') END AS s FROM orders)
SELECT o_orderkey, CASE WHEN contains(s, '/') THEN CASE WHEN TRY_CAST(split_part(s, '/', 1) AS INTEGER) >= 90 THEN 1900 + TRY_CAST(split_part(s, '/', 1) AS INTEGER)
     ELSE 2000 + TRY_CAST(split_part(s, '/', 1) AS INTEGER) END WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS season,
  CASE WHEN regexp_matches(left(s, 2), '^[0-9]{2}$') THEN 2000 + CAST(left(s, 2) AS BIGINT) END AS prefix_season,
  CASE WHEN regexp_full_match(s, '[0-9]{2}/[0-9]{2}') THEN CAST(right(s, 2) AS BIGINT) END AS pair_end FROM t""")
def season_years(spark, sf):
    """Season start year from ``NN/NN`` text, else from the date; July starts a season."""
    key, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    text = (F.when(key % 5 == 0, F.concat_ws("/", F.date_format(d, "yy"), F.date_format(F.add_months(d, 12), "yy")))
            .when(key % 5 == 1, "xx/yy").when(key % 5 == 2, F.lit(None)).otherwise(F.date_format(d, "yyyy")))
    t = read(spark, sf, "orders").select("o_orderkey", d.alias("d"), text.alias("s"))
    return t.select("o_orderkey", S.season_start_year("s", "d").alias("season"), S.season_from_prefix("s").alias("prefix_season"),
                    S.season_pair("s")["end"].cast("long").alias("pair_end"))


@query("age_at", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_partkey % 9 <> 0 THEN DATE '1960-02-29' + CAST(l_partkey % 9000 AS INTEGER) END AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(year(d) - year(b) - CASE WHEN (month(d), day(d)) < (month(b), day(b)) THEN 1 ELSE 0 END AS BIGINT) AS age,
  CAST(year(d) - year(b) AS BIGINT) AS season_age FROM t""")
def age_at_query(spark, sf):
    """Completed years at the ship date for a birth date derived from the part key."""
    born = F.when(F.col("l_partkey") % 9 != 0, F.date_add(F.lit("1960-02-29").cast("date"), (F.col("l_partkey") % 9000).cast("int")))
    t = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("d"), born.alias("b"))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.age_at("d", "b").alias("age"), S.age_at_season(F.year("d"), "b").alias("season_age"))


@query("date_offsets", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) - 180 AS back_180, CAST(o_orderdate AS DATE) - 365 AS back_365,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH AS DATE) AS plus_24m, CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR AS DATE) AS plus_3y,
  strftime(o_orderdate, '%Y-%m-%d') AS day_text FROM orders""")
def date_offsets(spark, sf):
    t = read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return t.select("o_orderkey", S.plus_days("d", -180).alias("back_180"), S.plus_days("d", -365).alias("back_365"),
                    S.plus_months("d", 24).alias("plus_24m"), S.plus_years("d", 3).alias("plus_3y"), S.date_only("d").alias("day_text"))


@query("keys_reasons_flags", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '_' || CASE WHEN o_orderkey % 11 = 0 THEN 'missing-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END || '_'
    || CASE WHEN o_orderkey % 13 = 0 THEN '<NA>' ELSE o_orderstatus END AS business_key,
  NULLIF(concat_ws(';', CASE WHEN o_orderkey % 11 = 0 THEN 'missing_date' END, CASE WHEN o_totalprice > 300000 THEN 'too_large' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END), '') AS reasons,
  CAST(COALESCE(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END = 'F', FALSE) AS INTEGER) AS same_status,
  CAST(o_orderkey % 13 <> 0 AS INTEGER) AS has_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' ELSE 'other' END AS level FROM orders""")
def keys_reasons_flags(spark, sf):
    """Composite keys with placeholders, ordered reasons, null-safe flags and a literal lookup."""
    key = F.col("o_orderkey")
    t = read(spark, sf, "orders").select("*", F.when(key % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
                                         F.when(key % 13 != 0, F.col("o_orderstatus")).alias("s"))
    return t.select("o_orderkey", S.composite_key("o_custkey", "d", "s", placeholders={1: "missing-date"}).alias("business_key"),
                    S.reasons([("missing_date", F.col("d").isNull()), ("too_large", F.col("o_totalprice") > 300000),
                               ("pending", F.col("o_orderstatus") == "P")]).alias("reasons"),
                    S.same_flag("s", F.lit("F")).alias("same_status"), S.match_flag("s").alias("has_status"),
                    S.map_values("o_orderpriority", {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"}, F.lit("other")).alias("level"))


@query("epoch_difference", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) + event_id % 130 AS seconds, (event_id % 130) > 60 AS too_far FROM events""")
def epoch_difference(spark, sf):
    """Epoch seconds against a timestamp, allowed difference one minute."""
    # the stored time has no zone: count its seconds, then compare as instants
    since = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    t = read(spark, sf, "events").select("event_id", since.alias("s"))
    seconds = F.col("s") + F.col("event_id") % 130
    return t.select("event_id", seconds.alias("seconds"), S.differs_by_more_than(S.epoch_to_timestamp(seconds), S.epoch_to_timestamp("s")).alias("too_far"))


@query("scaled_values", """
SELECT p_partkey, p_retailprice / 1e6 AS millions, ROUND(log10(p_retailprice), 4) AS log_price,
  CASE WHEN p_size >= 25 THEN 'Success' ELSE 'Failure' END AS outcome,
  CASE WHEN p_size / 50.0 >= 0.9 THEN 'very_high' WHEN p_size / 50.0 >= 0.7 THEN 'high' WHEN p_size / 50.0 >= 0.5 THEN 'moderate' WHEN p_size / 50.0 >= 0.3 THEN 'weak' ELSE 'very_weak' END AS strength
FROM part WHERE p_size BETWEEN 5 AND 45 AND p_type IN ('ECONOMY', 'STANDARD', 'PROMO')""")
def scaled_values(spark, sf):
    """Predicate filters, scaling, logarithm and label maps."""
    t = read(spark, sf, "part").where(F.col("p_size").between(5, 45) & F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO"))
    return t.select("p_partkey", (F.col("p_retailprice") / 1e6).alias("millions"), F.round(F.log10("p_retailprice"), 4).alias("log_price"),
                    S.map_values((F.col("p_size") >= 25).cast("int"), {0: "Failure", 1: "Success"}).alias("outcome"),
                    S.correlation_strength(F.col("p_size") / -50.0).alias("strength"))
