"""Shared counts, correlations of several pairs, and the binned density, against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitwise.operators import cleaning as C
from pitwise.operators import profile as P
from pitwise.operators.counts import count_store


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 5 == 0 else float(rng.choice([1, 2, 2, 3, 50])), None if i % 7 == 0 else i % 4, rng.choice(["a", "b", None])) for i in range(200)]
    rows.append((200, float("nan"), 3, "b"))
    return spark.createDataFrame(rows, "k long, v double, w int, t string")


def test_facts(mixed):
    store = count_store(mixed, ["v", "w"], ["t", "w"])
    pdf = mixed.toPandas()
    v = pdf["v"].dropna()
    f = store.numbers["v"]
    assert (f["rows"], f["missing"], f["n"], f["distinct"], f["min"], f["max"]) == (200, 40, 160, v.nunique(), v.min(), v.max())     # NaN is neither
    assert f["mean"] == pytest.approx(v.mean())
    best = pdf["t"].value_counts()
    assert store.texts["t"]["mode"] == best.index[0] and store.texts["t"]["missing"] == int(pdf["t"].isna().sum())
    assert store.numbers["w"]["missing"] == store.texts["w"]["missing"] == 29 and store.texts["w"]["distinct"] == 4
    for small in (1_000_000, 2):
        q = count_store(mixed, ["v", "w"], small=small).fitted({"q1": 0.25, "q3": 0.75}, ["v"])["v"]
        assert (q["q1"], q["q3"]) == (v.quantile(0.25), v.quantile(0.75))


@pytest.mark.parametrize("fill", [2.0, 7.5])
def test_moving_missing_cells_equals_counting_the_filled_table(mixed, fill):
    moved = count_store(mixed, ["v", "w"]).with_missing_as({"v": fill, "t": "a", "w": None})
    again = count_store(mixed.withColumn("v", F.coalesce("v", F.lit(fill))), ["v", "w"])
    for c in ("v", "w"):
        assert {k: pytest.approx(x) for k, x in again.numbers[c].items()} == moved.numbers[c]
        assert moved.fitted({"q1": 0.25, "m": 0.5, "q3": 0.75}, [c]) == again.fitted({"q1": 0.25, "m": 0.5, "q3": 0.75}, [c])


def test_empty_table_and_no_columns(spark, mixed):
    empty = count_store(mixed.limit(0), ["v"], ["t"])
    assert (empty.numbers, empty.texts) == ({}, {}) and empty.moments().count() == 0 and empty.fitted({"m": 0.5}, ["v"]) == {}
    assert count_store(mixed, []).number_counts().count() == 0
    assert P.numeric_profile(mixed.limit(0), ["v"]).count() == 0 and P.histogram(mixed.limit(0), ["v"]).count() == 0
    assert C.clip_bounds(mixed.limit(0), ["v"]) == {}


def test_profiles_of_a_table_read_it_once(spark, mixed):
    reads = spark.sparkContext.accumulator(0)

    def seen(v):
        reads.add(1)
        return v

    counted = mixed.withColumn("v", F.udf(seen, "double").asNondeterministic()("v"))
    store = P.field_counts(counted, ["v"], ["t"])
    frames = [P.numeric_profile(counted, ["v"], store=store), P.histogram(counted, ["v"], store=store), P.categorical_profile(counted, ["t"], store=store)]
    alone = [P.numeric_profile(mixed, ["v"]), P.histogram(mixed, ["v"]), P.categorical_profile(mixed, ["t"])]
    for got, want in zip(frames, alone):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert reads.value == 201


def test_clean_table_clips_at_the_bounds_of_the_filled_column(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 6 == 0 else float(rng.randint(0, 9)) if i % 50 else 900.0, f"t{i}") for i in range(300)]
    out = C.clean_table(spark.createDataFrame(rows, "pos long, score double, team string"), order_by="pos").toPandas()
    s = pd.Series([r[1] for r in rows], dtype=float)
    s = s.fillna(s.median())
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    want = s.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert out.sort_values("pos")["score"].tolist() == want.tolist()


@pytest.mark.parametrize("small", [1_000_000, 20])
def test_pairs_equal_pandas(spark, small):
    rng = np.random.default_rng(11)
    n = 600
    pdf = pd.DataFrame({"a": rng.normal(size=n).round(1), "b": rng.integers(0, 9, n).astype(float), "c": rng.normal(size=n) * 1e6 + 1e9, "d": np.full(n, 0.1)})
    pdf["c"] += pdf["a"] * 2e6
    pdf.loc[::3, "a"] = 0.0                                        # a hot value
    pdf.loc[5:90, "b"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, d double")
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("a", "d"), ("a", "a")]
    got = {(r["left_column"], r["right_column"]): r for r in P.correlation_pairs(df, pairs, small=small).collect()}
    for x, y in pairs:
        both = pd.DataFrame({"x": pdf[x], "y": pdf[y]}).dropna()
        r = got[x, y]
        assert r["shared_rows"] == len(both)
        if y == "d":
            assert r["pearson"] is None and r["spearman"] is None
            continue
        assert r["pearson"] == pytest.approx(both["x"].corr(both["y"]), abs=6e-5)
        assert r["spearman"] == pytest.approx(both["x"].rank().corr(both["y"].rank()), abs=6e-5)
    assert P.correlation_pairs(df.limit(99), pairs).count() == 0 and P.correlation_pairs(df.limit(0), pairs).count() == 0
    with pytest.raises(ValueError, match="at least one pair"):
        P.correlation_pairs(df, [])


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).normal(size=2000)), [0.0] * 500 + [1.0] * 3 + [1e4], list(np.random.default_rng(2).exponential(size=800)) + [0.5] * 400, [1.0, 2.0]])
def test_density_equals_the_full_sum(spark, values):
    v = np.array(values, dtype=float)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double")
    got = P.kde_grid(df, "v", 120).orderBy("point").toPandas()
    h = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 120)
    want = np.exp(-((grid[:, None] - v[None, :]) / h) ** 2 / 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.allclose(got["x"], grid) and len(got) == 120
    assert np.abs(got["density"] - want).max() < 2e-12 / (h * math.sqrt(2 * math.pi))
