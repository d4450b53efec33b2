import json

import pytest
from pyspark.sql import functions as F

from pitwise.operators import linkage as L
from pitwise.operators import profile as P
from pitwise.operators import quality as Q
from pitwise.sources import feed


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, 5, "a", "2020-01-01"), (2, 50, "b", "2020-13-01"), (3, None, None, None), (4, 700, "zz", "01.02.2020")], "k int, v int, t string, d string")


def test_rules_and_samples(frame):
    rules = [Q.between("v", 0, 100, name="range"), Q.in_set("t", ["a", "b"], name="set"), Q.matches_regex("t", "^[a-z]$", name="pattern"), Q.matches_layout("d", "%Y-%m-%d", name="layout"),
             Q.not_null("v"), Q.predicate("pair", ["k", "v"], F.col("k") > F.col("v"), applicable=F.col("v").isNotNull(), sample=["k"]), Q.not_null("gone", name="gone")]
    got = {r["check_name"]: r for r in Q.run_checks(frame, rules, table="t", dimension="d", order_by=["k"]).collect()}
    assert {n: (r["status"], r["applicable_rows"], r["failed_rows"], r["failed_pct"]) for n, r in got.items()} == {
        "range": ("failed", 4, 1, 25.0), "set": ("failed", 4, 1, 25.0), "pattern": ("failed", 4, 1, 25.0), "layout": ("failed", 4, 2, 50.0), "v_required": ("failed", 4, 1, 25.0),
        "pair": ("passed", 3, 0, 0.0), "gone": ("skipped", 4, None, None)}
    assert json.loads(got["layout"]["sample_unexpected_values"]) == ["2020-13-01", "01.02.2020"] and got["gone"]["missing_columns"] == "gone"
    assert got["pair"]["sample_unexpected_values"] == "[]"


def test_samples_are_bounded(spark):
    df = spark.range(1000).withColumn("v", F.lit(-1))
    row = Q.run_checks(df, [Q.between("v", 0, name="x")], table="t", dimension="d", order_by=["id"]).first()
    assert row["failed_rows"] == 1000 and len(json.loads(row["sample_unexpected_values"])) == 5


def test_order_and_empty(spark, frame):
    out = Q.finalize([Q.run_checks(frame, [Q.not_null("k"), Q.not_null("v"), Q.matches_layout("d", "%Y-%m-%d", name="a")], table="t", dimension="d")], "d")
    assert [r["check_name"] for r in out.collect()] == ["a", "v_required", "k_required"]
    empty = Q.finalize([], "accuracy", spark).first()
    assert (empty["check_name"], empty["status"], empty["applicable_rows"]) == ("no_checks_ran", "skipped", 0)


def test_constant_and_tiny_profiles(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (4.0, 5.0, None), (9.0, 5.0, None)], "a double, b double, c double")
    got = {r["column_name"]: r for r in P.numeric_profile(df, ["a", "b", "c"]).collect()}
    import pandas as pd
    s = pd.Series([1.0, 2.0, 4.0, 9.0])
    assert (got["a"]["std"], got["a"]["skew"], got["a"]["kurtosis"]) == (round(s.std(), 4), round(s.skew(), 4), round(s.kurt(), 4))
    assert (got["b"]["std"], got["b"]["skew"], got["b"]["kurtosis"]) == (0.0, 0.0, 0.0)
    assert (got["c"]["std"], got["c"]["skew"], got["c"]["kurtosis"], got["c"]["missing_count"]) == (0.0, None, None, 3)


def test_histogram_edges_follow_right_closed_bins(spark):
    import pandas as pd
    values = [float(v) for v in [0, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 89]]
    got = [(r["bin_start"], r["bin_end"], r["count"]) for r in P.histogram(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).orderBy("bin").collect()]
    want = pd.cut(pd.Series(values), bins=8).value_counts(sort=False)
    assert got == [(round(i.left, 4), round(i.right, 4), n) for i, n in want.items()]


def test_guarded_correlation(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(-i)) for i in range(120)], "a double, b double, c double")
    assert P.correlation_pair(df, "a", "b").first()["pearson"] is None
    row = P.correlation_pair(df, "a", "c").first()
    assert (row["pearson"], row["spearman"], row["direction"], row["strength"]) == (-1.0, -1.0, "negative", "very_high")
    assert P.correlation_pair(df.limit(99), "a", "c").count() == 0


def test_fuzzy_duplicates_equal_brute_force(spark):
    from difflib import SequenceMatcher
    import random
    rng = random.Random(1)
    people = [(i, "".join(rng.choice("abc ") for _ in range(8)).strip() or "x", f"d{i % 40}") for i in range(400)] + [(1000 + i, f"name {i}", "big") for i in range(25)] + [(7, "abc abc a", "d7"), (7, "abc abc b", "d7")]
    df = spark.createDataFrame(people, "id long, name string, born string")
    found, oversized = L.fuzzy_duplicates(df, block="born", key="id", name="name", threshold=0.7)
    got = {(r["left_key"], r["left_name"], r["right_key"], r["right_name"]): r["similarity"] for r in found.collect()}
    want = {}
    for d in {p[2] for p in people}:
        block = sorted((i, n, " ".join(n.split())) for i, n, b in people if b == d)
        for k, (a, n, x) in enumerate(block):
            for b, m, y in block[k + 1:]:
                if x != y and (r := SequenceMatcher(a=x, b=y).ratio()) >= 0.7:
                    want[(a, n, b, m)] = round(r, 4)
    assert got == want and want
    assert any(a == b for a, _, b, _ in want)        # one key, two names
    assert [tuple(r) for r in oversized.collect()] == [("big", 25)]


def test_map_entity(spark):
    pool = spark.createDataFrame([("A1", "Premier Liga", "pl", "England"), ("B1", "First Division", "fd", "England"), ("C1", "Serie A", "sa", "Italy")], "id string, name string, code string, land string")
    seen = spark.createDataFrame([("Premier League", "England")] * 3 + [("Other", "Italy")], "league string, country string")
    args = dict(name="league", country="country", candidate_id="id", candidate_names=["name", "code"], candidate_country="land")
    assert L.map_entity(seen, pool, **args).first()["id"] == "A1"
    assert L.map_entity(seen.withColumn("league", F.lit("FD")), pool, **args).first()["id"] == "B1"
    with pytest.raises(ValueError):
        L.map_entity(seen.withColumn("league", F.lit("qqqqqq")), pool, **args)


def test_loose_json_fields(spark):
    texts = ['{"a": "x", "b": "", "c": null}', '["  p ", "", "q"]', "[]", None, '"plain"', '[{"K": 1}, {"K": 2, "m": "z"}]']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    errors = [r["x"] for r in df.select("i", feed.normalize_errors("t").alias("x")).collect()]
    assert errors[:5] == [["a: x"], ["p", "q"], [], [], ["plain"]]
    params = [r["x"] for r in df.select("i", feed.normalize_parameters("t").alias("x")).collect()]
    assert params[0]["a"] == "x" and params[2] == {} and params[3] == {} and params[5] == {"K": "2", "m": "z"}
    assert df.select("i", feed.lower_keys(feed.normalize_parameters("t")).alias("x")).collect()[5]["x"] == {"k": "2", "m": "z"}


def test_large_blocks_lose_no_pair(spark):
    from pitwise.operators import joins as J
    df = spark.range(300).select(F.col("id"), F.lit("hot").alias("b"))
    pairs = J.block_pairs(df, block="b", order_by="id", columns=["id"], cell=40)
    got = sorted(tuple(r) for r in pairs.select("left_id", "right_id").collect())
    assert got == [(i, j) for i in range(300) for j in range(i + 1, 300)]
