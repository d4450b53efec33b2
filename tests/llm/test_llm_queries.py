"""Registered queries of the subpackage against their SQL, and the pipeline's stages, on the smallest tables."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import compare, connect  # noqa: E402
from pitwise.llm import mixing  # noqa: E402
from pitwise.llm.queries import DOMAIN_WEIGHTS, ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    verdict, _, _ = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert verdict == "ok", verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.count() == got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_queries_are_registered():
    import __spark_entry__ as entry
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in QUERIES) != 1] == []


def test_pipeline_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, before = documents, documents.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).cache()
        after = out.count()
        assert 0 < after <= before, name
        assert (out.columns == documents.columns) == (k < len(corpus_pipeline.STAGES) - 1), name
        assert out.select("doc_id").join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        docs, before = out.select(documents.columns), after
    assert out.where("copies < 1 or rate < 0").count() == 0


def test_mix_keeps_clean_documents_when_few_are_toxic(spark, monkeypatch):
    texts = [(i, " ".join(f"w{(i * 31 + j * j) % 500}" for j in range(40)) + (" vile nasty" if i % 100 == 0 else "")) for i in range(1000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "toxic" if i % 100 == 0 else "good") for i in range(1000)], "doc_id long, domain string")
    monkeypatch.setattr(corpus_pipeline, "labelled_domains", lambda spark, sf_dir: labelled)
    out = {r.doc_id: r for r in corpus_pipeline.mix_to_targets(spark, docs, SF).collect()}
    assert {i for i in range(1000) if i % 100} <= set(out) and min(out[i].rate for i in out if i % 100) >= 1


def test_last_stage_keeps_columns_of_its_own_names(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"rate": F.lit("mine"), "Copies": F.lit(7), "posterior": F.lit(None), "draw": F.lit(0)})
    out = corpus_pipeline.mix_to_targets(spark, documents, SF)
    assert out.columns == [*documents.columns, "_rate", "_copies"]
    assert out.where("rate <> 'mine' or Copies <> 7 or _copies < 1").count() == 0


@pytest.mark.skipif(not Path(LARGER).exists(), reason="test tables are not here")
def test_mix_hits_its_targets(spark):
    scored = QUERIES["op5_mix_to_targets"](spark, LARGER).withColumn("posterior", F.array(*[f"p_{d}" for d in DOMAIN_WEIGHTS]))
    totals = mixing.domain_totals(scored, DOMAIN_WEIGHTS).collect()
    assert [r.domain for r in totals] == list(DOMAIN_WEIGHTS) and max(abs(r.miss) for r in totals) < 0.01


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x" * 20_000, None, None, 5)]])
def test_stages_survive_odd_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("rate_", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, SF).count() <= len(rows), name
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).count() <= len(rows)
