"""Cleaning operators over whole tables with gaps, copies and bad dates derived from the key."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.operators import cleaning as C
from pitwise.operators.joins import mark_all_copies, mark_duplicates
from pitwise.operators.ordering import forward_fill
from pitwise.queries import query, read

# o_orderkey gives the row order; gaps depend on it.
GAPS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS sparse, CASE WHEN o_orderkey % 4 > 0 AND o_orderkey > 3 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)"""


def gappy(spark, sf):
    key = F.col("o_orderkey")
    return read(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"), F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 2 == 0, F.col("o_custkey")).alias("sparse"), F.when((key % 4 > 0) & (key > 3), F.to_date("o_orderdate")).alias("day"))


@query("drop_sparse_columns", f"SELECT o_orderkey, price, priority, day FROM {GAPS}")
def drop_sparse_columns(spark, sf):
    """Half of ``sparse`` is missing, so it goes."""
    return C.drop_sparse_columns(gappy(spark, sf))


@query("keep_filled_columns", f"SELECT o_orderkey, price, priority FROM {GAPS}")
def keep_filled_columns(spark, sf):
    return C.keep_filled_columns(gappy(spark, sf), 0.8)


@query("impute", f"""
WITH t AS (SELECT * EXCLUDE (sparse, day) FROM {GAPS}), m AS (SELECT median(price) AS p FROM t),
c AS (SELECT priority FROM t WHERE priority IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, priority LIMIT 1)
SELECT o_orderkey, COALESCE(price, m.p) AS price, COALESCE(t.priority, c.priority) AS priority FROM t, m, c""")
def impute(spark, sf):
    """Median for numbers, most frequent value for text."""
    return C.impute(gappy(spark, sf).drop("sparse", "day"))


@query("column_modes", f"""
WITH c AS (SELECT 'priority' AS "column", priority AS value FROM {GAPS} UNION ALL SELECT 'day', strftime(day, '%Y-%m-%d') FROM {GAPS}),
n AS (SELECT "column", value, COUNT(*) AS n FROM c WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""")
def column_modes(spark, sf):
    return C.modes(gappy(spark, sf), ["priority", "day"])


@query("forward_fill", f"""
SELECT o_orderkey, LAST_VALUE(day IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS day, sparse FROM {GAPS}""")
def forward_fill_query(spark, sf):
    """Dates carried along the order key; ``sparse`` has too many gaps to be filled; leading gaps stay."""
    out = forward_fill(gappy(spark, sf), ["day", "sparse"], order_by="o_orderkey", max_missing=0.5, bucket_rows=1_000)
    return out.select("o_orderkey", "day", "sparse")


@query("forward_fill_sparse", f"""
SELECT o_orderkey * 10000000 AS position, LAST_VALUE(day IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS day FROM {GAPS}""")
def forward_fill_sparse(spark, sf):
    """Dates carried along positions that lie far apart."""
    rows = gappy(spark, sf).select((F.col("o_orderkey") * 10_000_000).alias("position"), "day")
    return forward_fill(rows, ["day"], order_by="position", bucket_rows=1_000)


@query("clip_iqr", """
WITH b AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT doc_id, source, CASE WHEN q3 = q1 THEN CAST(n_chars AS DOUBLE) ELSE greatest(least(CAST(n_chars AS DOUBLE), q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) END AS n_chars FROM documents, b""")
def clip_iqr(spark, sf):
    return C.clip_iqr(read(spark, sf, "documents").select("doc_id", "source", "n_chars"))


@query("clean_table", """
WITH s AS (SELECT o_orderkey * 2 AS row_order, CASE WHEN o_orderkey % 6 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice * CASE WHEN o_orderkey % 100 = 0 THEN 50 ELSE 1 END END AS price,
     CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS sparse, o_orderkey FROM orders),
d AS (SELECT * FROM s),
f AS (SELECT row_order, o_orderkey, LAST_VALUE(TRY_CAST(order_date AS DATE) IGNORE NULLS) OVER (ORDER BY row_order ROWS UNBOUNDED PRECEDING) AS dt, price, priority FROM d),
m AS (SELECT median(price) AS p FROM f), c AS (SELECT priority FROM f WHERE priority IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, priority LIMIT 1),
md AS (SELECT dt FROM f WHERE dt IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, dt LIMIT 1),
i AS (SELECT row_order, COALESCE(f.dt, md.dt) AS day, COALESCE(price, p) AS price, COALESCE(f.priority, c.priority) AS priority FROM f, m, c, md),
b AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM i)
SELECT row_order, strftime(day, '%Y-%m-%d') AS day, greatest(least(price, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS price, priority FROM i, b""")
def clean_table(spark, sf):
    """Every order twice: copies dropped, dates repaired, sparse column dropped, gaps filled, outliers clipped."""
    key = F.col("o_orderkey")
    base = read(spark, sf, "orders").select(
        F.when(key % 6 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.when(key % 7 != 0, F.col("o_totalprice") * F.when(key % 100 == 0, 50).otherwise(1)).alias("price"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"), F.when(key % 2 == 0, F.col("o_custkey")).alias("sparse"), "o_orderkey",
        F.array(key * 2, key * 2 + 1).alias("rows"))
    twice = base.withColumn("row_order", F.explode("rows")).drop("rows")
    out = C.clean_table(twice, order_by="row_order")
    return out.select("row_order", F.date_format("order_date", "yyyy-MM-dd").alias("day"), "price", "priority")


@query("mark_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey * 100000 + l_suppkey) > 1 AS is_copy,
  COUNT(*) OVER (PARTITION BY l_partkey, l_linenumber) > 1 AS has_copies
FROM (SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber FROM lineitem GROUP BY ALL)""")
def mark_duplicates_query(spark, sf):
    """First copy by position stays; every member of a group of copies is known as well."""
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber").distinct()
    lines = lines.withColumn("position", F.col("l_orderkey") * 100_000 + F.col("l_suppkey"))
    out = mark_duplicates(lines, ["l_partkey", "l_linenumber"], "position", "is_copy")
    out = mark_all_copies(out, ["l_partkey", "l_linenumber"], "position", "has_copies")
    return out.drop("position")


@query("missing_summary", f"""
WITH n AS (SELECT COUNT(*) AS n, COUNT(price) AS price, COUNT(priority) AS priority, COUNT(sparse) AS sparse, COUNT(day) AS day FROM {GAPS})
SELECT * FROM (SELECT unnest(['price', 'priority', 'sparse', 'day']) AS column_name, unnest([n - price, n - priority, n - sparse, n - day]) AS missing_count,
  unnest([ROUND((n - price) * 100.0 / n, 2), ROUND((n - priority) * 100.0 / n, 2), ROUND((n - sparse) * 100.0 / n, 2), ROUND((n - day) * 100.0 / n, 2)]) AS missing_pct FROM n) WHERE missing_count > 0""")
def missing_summary(spark, sf):
    from pitwise.operators.quality import field_completeness, missing_patterns
    fields = missing_patterns(field_completeness(gappy(spark, sf), "orders"))
    return fields.select("column_name", "missing_count", F.round("missing_pct", 2).alias("missing_pct"))
