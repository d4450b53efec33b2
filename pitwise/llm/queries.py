"""Registered queries of this subpackage, each over its whole table, next to the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.llm import decontam, divergence, imatch, interactions, langid, licenses, lines, minhash, mixing, quality, secrets, toxicity, urls
from pitwise.llm.common import fold, held_out, labelled_sample, read, sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_decontaminate", r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0)),
grams AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM grams JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN named ON dw.doc_id = named.doc_id""")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(read(spark, sf_dir, "documents"))


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85, bands=25, rows=5)


@query("op4_line_dedup", r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i AS pos, a[i] || chr(10) || a[i + 1] || chr(10) || a[i + 2] AS g FROM (SELECT doc_id, a, unnest(range(1, len(a) - 1)) AS i FROM l)),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS k FROM w),
cover AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS p FROM r WHERE k > 1),
lines AS (SELECT doc_id, a[p] AS line, p FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS p FROM l)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS t FROM lines ANTI JOIN cover USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(l.a), 0) AS n_lines, coalesce(len(l.a), 0) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = lines.mark_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), window=3)
    return marked.select("doc_id", "n_lines", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256"))


#: Target shares of the tokens. A labelled document is toxic, else good or poor by its quality.
DOMAIN_WEIGHTS = {"good": 0.94, "poor": 0.03, "toxic": 0.03}

#: Labelled rows that any classifier of this subpackage learns from, at most (about).
MAX_LABELLED = 12_000
MAX_LABELLED_TOXIC = 30_000       # toxic ones are few


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where("quality is not null and toxic is not null")
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    return labelled_sample(labels.withColumn("domain", domain), "domain", F.lit(True), MAX_LABELLED).withColumnRenamed("label", "domain")


@query("op5_mix_to_targets")
def op5_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_ids(read(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), DOMAIN_WEIGHTS)
    return mixed.select("doc_id", "n_tokens", *[F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAIN_WEIGHTS)], "rate", "copies")


URL_RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]


@query("op6_filter_urls", r"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
o AS (SELECT host, good FROM p JOIN lab ON TRY_CAST(regexp_extract(path, '/([0-9]+)(\.html|/)?$', 1) AS BIGINT) = lab.doc_id),
h AS (SELECT host, array_to_string(list_reverse(list_reverse(string_split(host, '.'))[1:2]), '.') AS domain, string_split(host, '.')[-1] AS suffix, count(good) AS n, coalesce(sum(good), 0) AS y
      FROM (SELECT DISTINCT host FROM p) LEFT JOIN o USING (host) GROUP BY host),
e AS (SELECT (sum(y) + 0.5) / (sum(n) + 1.0) AS m FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(y) AS y, (SELECT m FROM e) AS m FROM h GROUP BY suffix),
s1 AS (SELECT least(greatest(coalesce(sum(n * pow(y / n::DOUBLE - m, 2) - m * (1 - m)) / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.999) AS rho FROM s0 WHERE n > 0),
s AS (SELECT suffix, m, m * (1 - m) / (n + k + 1) AS v FROM (SELECT suffix, n, (1 - rho) / rho AS k, (y + (1 - rho) / rho * m) / (n + (1 - rho) / rho) AS m FROM s0, s1)),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y, any_value(s.m) AS m, any_value(s.v) AS v FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
d1 AS (SELECT least(greatest(coalesce(sum(n * pow(y / n::DOUBLE - m, 2) - m * (1 - m)) / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.999) AS rho FROM d0 WHERE n > 0),
d AS (SELECT domain, suffix, m, m * (1 - m) / (n + k + 1) + pow(k / (n + k), 2) * v AS v FROM (SELECT domain, suffix, n, v, (1 - rho) / rho AS k, (y + (1 - rho) / rho * m) / (n + (1 - rho) / rho) AS m FROM d0, d1)),
h0 AS (SELECT host, n, y, d.m, d.v FROM h JOIN d USING (domain, suffix)),
h1 AS (SELECT least(greatest(coalesce(sum(n * pow(y / n::DOUBLE - m, 2) - m * (1 - m)) / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.999) AS rho FROM h0 WHERE n > 0),
r AS (SELECT host, g, g * (1 - g) / (n + k + 1) + pow(k / (n + k), 2) * v AS v FROM (SELECT host, (1 - rho) / rho AS k, n, v, (y + (1 - rho) / rho * m) / (n + (1 - rho) / rho) AS g FROM h0, h1)),
ruled AS (SELECT page_id, host, path, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN g + 1.645 * sqrt(v) < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(g, 9) AS good_rate
FROM ruled JOIN r USING (host)""")
def op6_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").where("doc_id is not null and quality is not null and toxic is not null")
    good = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    document = F.expr("try_cast(regexp_extract(path, '/([0-9]+)([.]html|/)?$', 1) as bigint)")     # a page's path ends with its document
    parsed = pages.select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
    outcomes = parsed.select("host", document.alias("doc_id")).join(good, "doc_id").select("host", "good")
    return urls.filter_urls(pages, outcomes, URL_RULES).withColumn("good_rate", F.round("good_rate", 9))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_sample(read(spark, sf_dir, "labels"), "toxic", fold(5) != 0, MAX_LABELLED_TOXIC)
    scores = toxicity.toxicity_scores(read(spark, sf_dir, "documents"), labelled)
    return scores.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_find_licenses", licenses.report_sql(best=True))
def op8_find_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read(spark, sf_dir, "documents"), best=True)


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_sample(read(spark, sf_dir, "labels"), "quality", fold(4) != 2, MAX_LABELLED)
    scores = quality.quality_scores(read(spark, sf_dir, "documents"), labelled)
    return scores.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.secret_digest(docs, secrets.fit(docs))


@query("op11_languages", langid.languages_sql())
def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = langid.predict_languages(docs, langid.fit_profiles(docs.where(~held_out(3, 1))))
    return predicted.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


@query("op12_filter_audit", interactions.audit_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), read(spark, sf_dir, "labels"))


@query("op13_source_divergence", divergence.divergence_sql())
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents").select("text", "lang", "source"))
