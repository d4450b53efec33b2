"""Exact order statistics, splits and fills; small limits force the bucketed path."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitwise.operators import ordering as O


def values(n=3000, seed=3):
    rng = random.Random(seed)
    # a third of all rows share one value and one group
    return [(i, "hot" if i % 3 == 0 else rng.choice("ab"), 7.0 if i % 3 == 0 else rng.choice([None, float("nan"), round(rng.gauss(0, 1e3), 2), float(rng.randrange(20))]))
            for i in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(values(), "id long, g string, v double").cache()


@pytest.mark.parametrize("small", [10**6, 0])
def test_quantiles_are_exact(frame, small):
    p = {"q1": 0.25, "m": 0.5, "q9": 0.9}
    clean = np.array([v for _, _, v in values() if v is not None and v == v])
    row = O.quantiles(frame, ["v"], p, small=small, edges=16).first()
    assert row["n"] == len(clean)
    assert [row[k] for k in p] == pytest.approx(list(np.quantile(clean, list(p.values()))))


@pytest.mark.parametrize("small", [10**6, 0])
def test_grouped_quantiles(frame, small):
    got = {r["g"]: (r["n"], r["m"]) for r in O.quantiles(frame, ["v"], {"m": 0.5}, by=["g"], small=small, edges=16).collect()}
    for g in ("hot", "a", "b"):
        clean = [v for _, k, v in values() if k == g and v is not None and v == v]
        assert got[g] == (len(clean), pytest.approx(np.median(clean)))


@pytest.mark.parametrize("small", [10**6, 0])
def test_average_ranks(frame, small):
    want = pd.Series([v for _, _, v in values()]).dropna()
    ranks = dict(zip(want, want.rank()))
    got = {r["value"]: r["rank"] for r in O.average_ranks(frame, ["v"], small=small, edges=16).collect()}
    assert got == pytest.approx(ranks)


@pytest.mark.parametrize("small", [10**6, 0])
def test_split_positions(frame, small):
    df = frame.select("id", F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int"))).alias("d"))
    got = {r["id"]: r["split"] for r in O.chronological_split(df, sort_by="d", tie_by="id", small=small, edges=16).collect()}
    rows = df.toPandas().sort_values(["d", "id"], kind="stable", na_position="last")["id"].tolist()
    first, second = O.split_bounds(len(rows))
    assert [got[i] for i in rows] == ["train"] * first + ["val"] * (second - first) + ["test"] * (len(rows) - second)


@pytest.mark.parametrize("small", [10**6, 0])
def test_split_of_keys_beyond_doubles_and_missing_values(spark, small):
    df = spark.createDataFrame([(2**60 + i, 1) for i in range(100)], "k long, d int").repartition(3)
    got = [r["split"] for r in O.chronological_split(df, sort_by="d", tie_by="k", small=small, edges=8).orderBy("k").collect()]
    assert got == ["train"] * 70 + ["val"] * 15 + ["test"] * 15
    values = [float("inf"), float("nan"), None, 3.0, -1.0, 3.0, float("-inf"), None, float("nan"), 7.0]
    df = spark.createDataFrame(list(enumerate(values)), "k long, d double")
    got = {r["k"]: r["split"] for r in O.chronological_split(df, sort_by="d", tie_by="k", train_ratio=0.5, val_ratio=0.3, small=small, edges=4).collect()}
    order = [6, 4, 3, 5, 9, 0, 1, 2, 7, 8]
    assert [got[k] for k in order] == ["train"] * 5 + ["val"] * 3 + ["test"] * 2
    assert O.order_statistic(spark.createDataFrame([(2**60 + i,) for i in range(5)], "k long"), "k", [2], small=small)[2][1] == 2**60 + 2


def test_split_bounds_and_errors():
    assert O.split_bounds(6, 0.50, 0.25) == (3, 4)
    assert O.split_bounds(100) == (70, 85)
    for total, ratios in ((0, (0.7, 0.15)), (2, (0.7, 0.15)), (10, (0, 0.5)), (10, (0.8, 0.2))):
        with pytest.raises(ValueError):
            O.split_bounds(total, *ratios)


def test_small_split_keeps_order(spark):
    days = ["2020-03-01", "2020-01-01", "2020-05-01", "2020-02-01", "2020-06-01", "2020-04-01"]
    df = spark.createDataFrame(list(enumerate(days)), "id long, d string").withColumn("d", F.to_date("d"))
    out = O.chronological_split(df, sort_by="d", tie_by="id", train_ratio=0.5, val_ratio=0.25)
    assert [r["split"] for r in out.orderBy("d").collect()] == ["train"] * 3 + ["val"] + ["test"] * 2
    assert {r["split"]: r["rows"] for r in O.split_summary(out, sort_by="d").collect()} == {"train": 3, "val": 1, "test": 2}


def test_forward_fill(spark):
    rng = random.Random(5)
    rows = [(i, None if i < 4 or rng.random() < 0.4 else i, i if i % 5 == 0 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "pos long, v int, sparse int").repartition(5)
    out = O.forward_fill(df, ["v", "sparse"], order_by="pos", bucket_rows=37).orderBy("pos").toPandas()
    want = pd.DataFrame(rows, columns=["pos", "v", "sparse"])
    pd.testing.assert_series_equal(out["v"].astype("float"), want["v"].ffill().astype("float"))
    assert out["sparse"].isna().sum() == 400     # more than half missing: not filled


def test_forward_fill_over_sparse_positions(spark):
    rows = [(i * 10_000_000, None if i % 3 else i) for i in range(2000)]
    out = O.forward_fill(spark.createDataFrame(rows, "pos long, v int").repartition(4), ["v"], order_by="pos", max_missing=0.9, bucket_rows=100)
    assert [r["v"] for r in out.orderBy("pos").collect()] == [i - i % 3 for i in range(2000)]


def test_seeded_sample_is_reproducible(frame):
    a, b, c = (sorted(r["id"] for r in O.seeded_sample(frame.repartition(n), key="id", n=20, seed=s).collect()) for n, s in ((2, 1), (7, 1), (2, 2)))
    assert a == b and a != c and len(a) == 20


@pytest.mark.parametrize("range_rows", [1_000_000, 40])
def test_row_positions(spark, range_rows):
    """Mixed directions, nulls last both ways, a value that half of the rows hold, and rows that agree in the whole key."""
    rows = [(i, None if i % 11 == 0 else 7 if i % 2 else i % 5, None if i % 7 == 0 else "xyz"[i % 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a int, b string")
    got = {r["k"]: r["position"] for r in O.row_positions(df.repartition(3), [("a", "desc"), ("b", "asc"), ("k", "desc")], range_rows=range_rows).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or "", -r[0]))
    assert [got[r[0]] for r in want] == list(range(1, 401))
    tied = [O.row_positions(df.repartition(n), [("a", "asc")], range_rows=range_rows) for n in (2, 5)]
    first, second = ({r["k"]: r["position"] for r in t.collect()} for t in tied)
    assert first == second and sorted(first.values()) == list(range(1, 401))
    assert O.row_positions(df.limit(0), [("a", "asc")]).count() == 0
