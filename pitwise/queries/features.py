"""Splits, encoders, metrics and models over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.operators import features as M
from pitwise.operators import models as K
from pitwise.operators.joins import lookup
from pitwise.operators.ordering import chronological_split, split_summary
from pitwise.queries import query, read

SPLIT = """
r AS (SELECT *, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS pos, COUNT(*) OVER () AS n FROM orders),
split AS (SELECT *, CAST(o_orderdate AS DATE) AS day, CASE WHEN pos < floor(n * 0.7e0) THEN 'train' WHEN pos < floor(n * (0.7e0 + 0.15e0)) THEN 'val' ELSE 'test' END AS split,
   CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END AS priority FROM r)"""


def _split(spark, sf):
    key = F.col("o_orderkey")
    orders = read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), F.when(key % 6 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 8 != 0, F.col("o_orderpriority")).alias("priority"))
    return chronological_split(orders, sort_by="day", tie_by="o_orderkey")


@query("chrono_split", f"WITH {SPLIT} SELECT o_orderkey, day, split FROM split")
def chrono_split(spark, sf):
    return _split(spark, sf).select("o_orderkey", "day", "split")


@query("split_summary", f"WITH {SPLIT} SELECT split, COUNT(*) AS rows, MIN(day) AS start_date, MAX(day) AS end_date FROM split GROUP BY 1")
def split_summary_query(spark, sf):
    return split_summary(_split(spark, sf), sort_by="day")


@query("scaled_features", f"""WITH {SPLIT}, m AS (SELECT median(price) AS med FROM split WHERE split = 'train'),
f AS (SELECT o_orderkey, split, COALESCE(price, med) AS p, CAST(o_custkey AS DOUBLE) AS c FROM split, m),
s AS (SELECT AVG(p) AS mp, stddev_pop(p) AS sp, AVG(c) AS mc, stddev_pop(c) AS sc FROM f WHERE split = 'train')
SELECT o_orderkey, split, ROUND((p - mp) / sp, 4) + 0.0 AS numeric__price, ROUND((c - mc) / sc, 4) + 0.0 AS numeric__o_custkey FROM f, s""")
def scaled_features(spark, sf):
    """Median filling and scaling fitted on train, applied to all parts."""
    parts = _split(spark, sf)
    fitted = M.fit_preprocessor(parts.where("split = 'train'"), target="o_orderstatus", columns=["price", "o_custkey"])
    out = fitted.transform(parts, keep=["o_orderkey", "split"])
    return out.select("o_orderkey", "split", *[(F.round(F.col(n), 4) + 0.0).alias(n) for n in fitted.feature_names])


@query("one_hot_features", f"""WITH {SPLIT}, train AS (SELECT CASE WHEN priority <> '2-HIGH' THEN priority END AS priority FROM split WHERE split = 'train'),
c AS (SELECT priority FROM train WHERE priority IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, priority LIMIT 1),
f AS (SELECT o_orderkey, split, COALESCE(split.priority, c.priority) AS p FROM split, c)
SELECT o_orderkey, split, CAST(p = '1-URGENT' AS DOUBLE) AS "categorical__priority_1-URGENT", CAST(p = '3-MEDIUM' AS DOUBLE) AS "categorical__priority_3-MEDIUM",
  CAST(p = '4-NOT SPECIFIED' AS DOUBLE) AS "categorical__priority_4-NOT SPECIFIED", CAST(p = '5-LOW' AS DOUBLE) AS "categorical__priority_5-LOW" FROM f""")
def one_hot_features(spark, sf):
    """Mode filling and one-hot columns; a category absent from train becomes all zeros."""
    parts = _split(spark, sf)
    train = parts.where("split = 'train'").withColumn("priority", F.when(F.col("priority") != "2-HIGH", F.col("priority")))
    fitted = M.fit_preprocessor(train, target="o_orderstatus", columns=["priority"])
    return fitted.transform(parts, keep=["o_orderkey", "split"])


@query("freq_encode", f"""WITH {SPLIT}, t AS (SELECT priority, COUNT(*) * 1.0e0 / (SELECT COUNT(*) FROM split WHERE split = 'train') AS share FROM split WHERE split = 'train' AND priority <> '3-MEDIUM' GROUP BY 1),
u AS (SELECT o_orderkey, priority FROM split)
SELECT o_orderkey, COALESCE(share, 0) AS priority FROM u LEFT JOIN t USING (priority)""".replace("AND priority <> '3-MEDIUM' ", ""))
def freq_encode(spark, sf):
    """Share of each priority among the training rows."""
    parts = _split(spark, sf)
    return M.frequency_encode(parts.select("o_orderkey", "priority"), parts.where("split = 'train'"), ["priority"])


@query("model_columns", """SELECT unnest(['l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linestatus']) AS column_name,
 (SELECT COUNT(*) FROM lineitem) AS non_null""")
def model_columns(spark, sf):
    """Columns that may be features of a return model, with their filled rows."""
    lines = read(spark, sf, "lineitem").withColumn("empty", F.lit(None).cast("double")).withColumn("target_x", F.lit(1))
    names = M.usable_columns(lines, target="l_returnflag", excluded=["l_orderkey"])
    row = lines.agg(*[F.count(c).alias(c) for c in names])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in names])))


METRICS = """SELECT {by} tp, fp, fn, tn, ROUND((tp + tn) * 1.0e0 / (tp + fp + fn + tn), 4) AS accuracy, ROUND(COALESCE(tp * 1.0e0 / NULLIF(tp + fp, 0), 0), 4) AS "precision",
  ROUND(COALESCE(tp * 1.0e0 / NULLIF(tp + fn, 0), 0), 4) AS recall, ROUND(COALESCE(2.0e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 4) AS f1_score FROM (
  SELECT {by} COUNT(*) FILTER (y = 1 AND p = 1) AS tp, COUNT(*) FILTER (y = 0 AND p = 1) AS fp, COUNT(*) FILTER (y = 1 AND p = 0) AS fn, COUNT(*) FILTER (y = 0 AND p = 0) AS tn FROM t {group})"""


@query("class_metrics", "WITH t AS (SELECT lang, quality AS y, CAST(n_chars > 800 AS INTEGER) AS p FROM labels JOIN documents USING (doc_id)) " + METRICS.format(by="lang,", group="GROUP BY 1"))
def class_metrics(spark, sf):
    """Accuracy, precision, recall and F1 of a length rule per language."""
    t = labelled_documents(spark, sf).withColumn("p", (F.col("n_chars") > 800).cast("int"))
    return K.class_metrics(t, label="quality", prediction="p", by=["lang"])


@query("majority_baseline", """WITH m AS (SELECT l_linestatus FROM lineitem WHERE year(l_shipdate) < 1999 GROUP BY 1 ORDER BY COUNT(*) DESC, l_linestatus LIMIT 1),
t AS (SELECT CAST(lineitem.l_linestatus = 'F' AS INTEGER) AS y, CAST(m.l_linestatus = 'F' AS INTEGER) AS p FROM lineitem, m WHERE year(l_shipdate) >= 1999) """ + METRICS.format(by="", group=""))
def majority_baseline(spark, sf):
    """Most frequent training class predicted for the later shipments."""
    lines = read(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), (F.col("l_linestatus") == "F").cast("int").alias("y"))
    return K.class_metrics(K.majority_baseline(lines.where("year < 1999"), lines.where("year >= 1999"), "y"), label="y", prediction="prediction")


def labelled_documents(spark, sf):
    return lookup(read(spark, sf, "labels"), read(spark, sf, "documents"), on={"doc_id": "doc_id"},
                  take={"lang": "lang", "source": "source", "n_chars": "n_chars"})


def _vectors(spark, sf):
    """Labelled documents in three chronological parts (by identifier) as feature vectors."""
    docs = labelled_documents(spark, sf)
    parts = M.build_feature_splits(docs.select("doc_id", "quality", "lang", "source", "n_chars", "toxic"), target="quality", sort_by="doc_id", tie_by="doc_id", form="vector")
    return parts["features_train"], parts["features_val"], parts["features_test"]


@query("oversample_counts", """
WITH c AS (SELECT l_returnflag = 'R' AND l_linenumber <= 2 AS y, COUNT(*) AS n FROM lineitem GROUP BY 1),
k AS (SELECT MAX(n) AS many, MIN(n) AS few FROM c)
SELECT CAST(y AS INTEGER) AS label, FALSE AS synthetic, n AS rows FROM c UNION ALL
SELECT 1, TRUE, CAST(floor(many * 0.5) AS BIGINT) - few FROM k WHERE floor(many * 0.5) > few""")
def oversample_counts(spark, sf):
    """Synthetic minority rows made to reach half of the majority."""
    from pyspark.ml.feature import VectorAssembler
    lines = read(spark, sf, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("h"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)).cast("int").alias("label"), "l_quantity", "l_discount", "l_tax")
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(lines.withColumnRenamed("h", "key"))
    made = K.oversample_minority(rows.select("key", "label", "features"), label="label", key="key")
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query("oversample_between", """
WITH c AS (SELECT l_returnflag = 'R' AND l_linenumber <= 2 AS y, l_quantity, l_discount, l_tax FROM lineitem),
k AS (SELECT COUNT(*) FILTER (NOT y) AS many, COUNT(*) FILTER (y) AS few FROM c)
SELECT CAST(floor(many * 0.5) AS BIGINT) - few AS rows, CAST(floor(many * 0.5) AS BIGINT) - few AS in_bounds FROM k""")
def oversample_between(spark, sf):
    """Synthetic rows, and how many of them lie within the minority's bounds of every feature, as points between two of its rows must."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    names = ("l_quantity", "l_discount", "l_tax")
    lines = read(spark, sf, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("key"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)).cast("int").alias("label"), *names)
    rows = VectorAssembler(inputCols=list(names), outputCol="features").transform(lines)
    made = K.oversample_minority(rows.select("key", "label", "features"), label="label", key="key").where("synthetic").select(vector_to_array("features").alias("x"))
    limits = lines.where("label = 1").agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))]).first()
    first, second, third = [F.col("x")[i].between(limits[f"lo_{c}"] - 1e-9, limits[f"hi_{c}"] + 1e-9) for i, c in enumerate(names)]
    return made.agg(F.count(F.lit(1)).alias("rows"), F.count_if(first & second & third).alias("in_bounds"))


@query("nearest_distances", """
WITH c AS (SELECT c_custkey AS key, c_acctbal / 100 AS x, c_nationkey * 1.0 AS y FROM customer),
p AS (SELECT a.key, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d FROM c a JOIN c b ON a.key <> b.key)
SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY d) AS INTEGER) AS rank, ROUND(sqrt(d), 6) AS distance FROM p QUALIFY rank <= 5""")
def nearest_distances(spark, sf):
    """Distances of each customer's five nearest others by balance and nation, in cells of some hundred rows."""
    from pyspark.ml.feature import VectorAssembler
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_acctbal") / 100).alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(c)
    near = K.near_neighbours(rows, "key", "features", k=5, cell_rows=400).select("key", "x", F.posexplode("neighbours").alias("at", "n"))
    gap = [F.col("x")[j] - F.col("n")[j] for j in (0, 1)]
    return near.select("key", (F.col("at") + 1).alias("rank"), F.round(F.sqrt(gap[0] * gap[0] + gap[1] * gap[1]), 6).alias("distance"))


@query("chrono_split_large_keys", """
WITH n AS (SELECT COUNT(*) AS n FROM orders), r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS p FROM orders),
b AS (SELECT greatest(1, CAST(floor(n * 0.70::DOUBLE) AS BIGINT)) AS a, CAST(floor(n * 0.85::DOUBLE) AS BIGINT) AS b FROM n)
SELECT o_orderkey, CASE WHEN p < a THEN 'train' WHEN p < b THEN 'val' ELSE 'test' END AS split FROM r, b""")
def chrono_split_large_keys(spark, sf):
    """Split of orders by the code of their priority, ties by keys that a double cannot tell apart."""
    from pitwise.operators import ordering as O
    rows = read(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("s"), (F.col("o_orderkey") + F.lit(1 << 60)).alias("t"))
    return O.chronological_split(rows, sort_by="s", tie_by="t").select("o_orderkey", "split")


@query("chrono_split_missing", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_totalprice END AS s FROM orders),
n AS (SELECT COUNT(*) AS n FROM orders), r AS (SELECT o_orderkey, row_number() OVER (ORDER BY s NULLS LAST, o_orderkey) - 1 AS p FROM o),
b AS (SELECT greatest(1, CAST(floor(n * 0.70::DOUBLE) AS BIGINT)) AS a, CAST(floor(n * 0.85::DOUBLE) AS BIGINT) AS b FROM n)
SELECT o_orderkey, CASE WHEN p < a THEN 'train' WHEN p < b THEN 'val' ELSE 'test' END AS split FROM r, b""")
def chrono_split_missing(spark, sf):
    """Split by prices of which two fifths are null or NaN: those rows come last."""
    from pitwise.operators import ordering as O
    key = F.col("o_orderkey")
    price = F.when(key % 5 == 0, F.lit(float("nan"))).when(key % 5 >= 2, F.col("o_totalprice").cast("double"))
    return O.chronological_split(read(spark, sf, "orders").select("o_orderkey", price.alias("s")), sort_by="s", tie_by="o_orderkey").select("o_orderkey", "split")


def _trained(family: str):
    def run(spark, sf):
        train, val, test = _vectors(spark, sf)
        results, models = K.train_grid(train, val, "quality", families={family: K.GRID[family]}, depth=8)
        return results.unionByName(K.score_best(results, models, test, "quality"))
    run.__doc__ = f"Every {family} configuration scored on train and validation, the best one on test."
    return run


for _family in K.GRID:
    query(f"train_{_family}")(_trained(_family))
