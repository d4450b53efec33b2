"""Record linkage over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.functions.text import normalize_text
from pitwise.operators import joins as J
from pitwise.operators import linkage as L
from pitwise.queries import query, read

BLOCKED = """
b AS (SELECT c_custkey AS k, c_name AS name, c_nationkey || '/' || CAST(floor(c_acctbal / 100) AS BIGINT) AS block FROM customer),
pairs AS (SELECT l.block, l.k AS left_key, l.name AS left_name, r.k AS right_key, r.name AS right_name FROM b l JOIN b r ON l.block = r.block AND l.k < r.k)"""


def blocked_customers(spark, sf):
    """Customers in blocks of the same nation and balance range."""
    block = F.concat_ws("/", F.col("c_nationkey").cast("string"), F.floor(F.col("c_acctbal") / 100).cast("string"))
    return read(spark, sf, "customer").select("c_custkey", "c_name", block.alias("block"))


@query("linkage_full_outer", """
SELECT COALESCE(d.doc_id, l.doc_id) AS doc_id, d.lang, l.quality, CASE WHEN d.doc_id IS NULL THEN 'right_only' WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS side
FROM (SELECT CASE WHEN doc_id % 4 = 0 THEN -doc_id - 1 ELSE doc_id END AS doc_id, lang FROM documents) d FULL OUTER JOIN (SELECT doc_id, quality FROM labels) l ON d.doc_id = l.doc_id""")
def linkage_full_outer(spark, sf):
    """Documents and labels side by side, with the side each row came from; a quarter of the ids is changed, so each side has rows alone."""
    docs = read(spark, sf, "documents").select(F.expr("CASE WHEN doc_id % 4 = 0 THEN -doc_id - 1 ELSE doc_id END").alias("doc_id"), "lang")
    return J.outer_with_side(docs, read(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"]).select("doc_id", "lang", "quality", "side")


MATCH_SQL = """a AS (SELECT o_orderkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CASE WHEN o_orderkey % 20 <> 0 THEN o_orderstatus END AS st, o_totalprice FROM orders),
b AS (SELECT l_orderkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, CASE WHEN l_orderkey % 20 <> 0 THEN 'F' END AS st, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2, 3),
o AS (SELECT a.k AS ak, b.k AS bk FROM a FULL OUTER JOIN b ON a.k = b.k AND a.m = b.m AND a.st IS NOT DISTINCT FROM b.st)"""


def _match(spark, sf):
    key = F.col("o_orderkey")
    left = read(spark, sf, "orders").select(key.alias("k"), F.to_date(F.trunc("o_orderdate", "month")).alias("m"),
                                            F.when(key % 20 != 0, F.col("o_orderstatus")).alias("st"), "o_totalprice")
    right = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.to_date(F.trunc("l_shipdate", "month")).alias("m")).agg(F.count(F.lit(1)).alias("lines"))
    right = right.withColumn("st", F.when(F.col("k") % 20 != 0, F.lit("F")))
    return L.match_sources(left, right, ["k", "m", "st"])


@query("match_summary", f"""WITH {MATCH_SQL}
SELECT (SELECT COUNT(*) FROM a) AS left_rows, (SELECT COUNT(*) FROM b) AS right_rows, COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL) AS matched_rows, COUNT(*) FILTER (bk IS NULL) AS left_unmatched_rows,
  COUNT(*) FILTER (ak IS NULL) AS right_unmatched_rows, ROUND(COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL) * 100.0 / (SELECT COUNT(*) FROM a), 4) AS left_match_rate_pct,
  ROUND(COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL) * 100.0 / (SELECT COUNT(*) FROM b), 4) AS right_match_rate_pct FROM o""")
def match_summary(spark, sf):
    """Match rates of orders and shipment months on three keys, a missing key equal to a missing key."""
    return _match(spark, sf)["summary"]


@query("matched_rows", f"WITH {MATCH_SQL} SELECT a.k, a.m, a.st, o_totalprice, lines FROM a JOIN b ON a.k = b.k AND a.m = b.m AND a.st IS NOT DISTINCT FROM b.st")
def matched_rows(spark, sf):
    return _match(spark, sf)["matched"].select("k", "m", "st", "o_totalprice", "lines")


@query("unmatched_left", f"WITH {MATCH_SQL} SELECT k, m, st FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.k = b.k AND a.m = b.m AND a.st IS NOT DISTINCT FROM b.st)")
def unmatched_left(spark, sf):
    return _match(spark, sf)["unmatched_left"].select("k", "m", "st")


@query("unmatched_right", f"WITH {MATCH_SQL} SELECT k, m, st, lines FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = b.k AND a.m = b.m AND a.st IS NOT DISTINCT FROM b.st)")
def unmatched_right(spark, sf):
    return _match(spark, sf)["unmatched_right"].select("k", "m", "st", "lines")


@query("documents_without_label", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def documents_without_label(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "lang")
    return J.unmatched(docs, read(spark, sf, "labels"), ["doc_id"])


@query("null_safe_join", """
WITH d AS (SELECT CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS name, MIN(n_regionkey) AS region, COUNT(*) AS n FROM nation GROUP BY 1),
s AS (SELECT s_suppkey, CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, s.name, region, n FROM s LEFT JOIN d ON s.name IS NOT DISTINCT FROM d.name""")
def null_safe_join(spark, sf):
    """A missing name finds the missing name."""
    nation = read(spark, sf, "nation").select("*", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("name"))
    dim = nation.groupBy("name").agg(F.min("n_regionkey").alias("region"), F.count(F.lit(1)).alias("n"))
    left = J.lookup(read(spark, sf, "supplier"), nation, on={"s_nationkey": "n_nationkey"}, take={"name": "name"}).select("s_suppkey", "name")
    return J.null_safe_left_join(left, dim, on={"name": "name"}, take={"region": "region", "n": "n"})


@query("block_pairs", f"WITH {BLOCKED} SELECT * FROM pairs")
def block_pairs(spark, sf):
    """Unordered pairs of customers inside blocks."""
    pairs = J.block_pairs(blocked_customers(spark, sf), block="block", order_by="c_custkey", columns=["c_custkey", "c_name"])
    return pairs.select("block", F.col("left_c_custkey").alias("left_key"), F.col("left_c_name").alias("left_name"),
                        F.col("right_c_custkey").alias("right_key"), F.col("right_c_name").alias("right_name"))


@query("oversized_blocks", "SELECT c_nationkey AS block, COUNT(*) AS members FROM customer GROUP BY 1 HAVING COUNT(*) > 20")
def oversized_blocks(spark, sf):
    """Blocks by nation with more than 20 customers."""
    rows = read(spark, sf, "customer").select(F.col("c_nationkey").alias("block"), "c_custkey")
    return J.large_blocks(rows, block="block", columns=["c_custkey"])


@query("edit_similar_pairs", f"""WITH {BLOCKED},
n AS (SELECT *, regexp_replace(lower(left_name), '[^a-z0-9]', ' ', 'g') AS a, regexp_replace(lower(right_name), '[^a-z0-9]', ' ', 'g') AS b FROM pairs)
SELECT block, left_key, right_key, ROUND(1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)), 4) AS similarity FROM n
WHERE 1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)) >= 0.88""")
def edit_similar_pairs(spark, sf):
    """Similar names inside blocks by edit distance."""
    found = L.edit_pairs(blocked_customers(spark, sf).withColumn("norm", normalize_text("c_name")), block="block", key="c_custkey", text="norm", threshold=0.88)
    return found.withColumn("similarity", F.round("similarity", 4))


@query("fuzzy_pairs")
def fuzzy_pairs(spark, sf):
    """Similar names inside blocks by matching-block ratio; tested against brute force."""
    return L.fuzzy_duplicates(blocked_customers(spark, sf), block="block", key="c_custkey", name="c_name")[0]


@query("map_entity", """
WITH t AS (SELECT CASE WHEN n_regionkey = 1 THEN n_name END AS n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT n_name FROM t WHERE n_name IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, n_name LIMIT 1)
SELECT n_nationkey, nation.n_name, r_name, 1 AS exact_match FROM nation JOIN m USING (n_name) JOIN region ON n_regionkey = r_regionkey""")
def map_entity(spark, sf):
    """The nation that the most frequent known nation of customers maps to."""
    nations = J.lookup(read(spark, sf, "nation"), read(spark, sf, "region"), on={"n_regionkey": "r_regionkey"}, take={"r_name": "r_name"})
    seen = J.lookup(read(spark, sf, "customer"), nations, on={"c_nationkey": "n_nationkey"}, take={"n_name": "n_name", "r_name": "r_name", "n_regionkey": "region"})
    seen = seen.withColumns({c: F.when(F.col("region") == 1, F.col(c)) for c in ("n_name", "r_name")})      # names of other regions are missing
    return L.map_entity(seen, nations, name="n_name", country="r_name", candidate_id="n_nationkey", candidate_names=["n_name"], candidate_country="r_name").select(
        "n_nationkey", "n_name", "r_name", "exact_match")
