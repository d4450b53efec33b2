import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pitwise.operators import features as M
from pitwise.operators import models as K


@pytest.fixture(scope="module")
def parts(spark):
    schema = "row long, transfer_date timestamp, player_id long, position string, league string, age double, value long, target_minutes long, success int"
    day = dt.datetime(2020, 1, 1)
    train = spark.createDataFrame([(0, day, 1, "Attack", "A", 20.0, 10, 1, 1), (1, day, 2, "Defender", "B", None, 20, 2, 0), (2, day, 3, None, "A", 30.0, 30, 3, 1)], schema)
    test = spark.createDataFrame([(3, day, 4, "Goalkeeper", "A", 40.0, None, 1, 0)], schema)
    return train, test


def test_columns_and_unseen_category(parts):
    train, test = parts
    fitted = M.fit_preprocessor(train, target="success", excluded=["row", "player_id"])
    assert fitted.feature_columns == ["position", "league", "age", "value"]
    assert fitted.feature_names == ["numeric__age", "numeric__value", "categorical__position_Attack", "categorical__position_Defender", "categorical__league_A", "categorical__league_B"]
    rows = fitted.transform(train, keep=["row"]).orderBy("row").toPandas()
    age = np.array([20.0, 25.0, 30.0])
    assert rows["numeric__age"].tolist() == pytest.approx(((age - age.mean()) / age.std()).tolist())
    assert rows["categorical__position_Attack"].tolist() == [1.0, 0.0, 1.0]     # a gap takes the smallest of tied modes
    new = fitted.transform(test).first().asDict()
    assert new["categorical__position_Attack"] == new["categorical__position_Defender"] == 0.0 and new["numeric__value"] == 0.0


def test_save_load_and_vector_form(parts, tmp_path):
    train, test = parts
    fitted = M.fit_preprocessor(train, target="success", excluded=["row", "player_id"])
    fitted.save(str(tmp_path / "p"))
    again = M.Preprocessor.load(str(tmp_path / "p"))
    assert again.feature_names == fitted.feature_names and again.transform(test).first() == fitted.transform(test).first()
    vector = M.fit_preprocessor(train, target="success", excluded=["row", "player_id"], form="vector").transform(test).first()["features"].toArray()
    assert vector.tolist() == list(fitted.transform(test).first())


def test_no_usable_columns(parts):
    with pytest.raises(ValueError):
        M.fit_preprocessor(parts[0].select("success", F.lit(None).cast("double").alias("x")), target="success")


def test_names_with_quotes(spark):
    train = spark.createDataFrame([("it's", 1), ("a`b\\c", 0)], "`odd name` string, y int")
    out = M.fit_preprocessor(train, target="y").transform(train, keep=["y"])
    assert sorted(out.columns) == ["categorical__odd name_a`b\\c", "categorical__odd name_it's", "y"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1.0, 0.0), (1, 0.0, 1.0)]


def test_splits_end_to_end(spark):
    df = spark.createDataFrame([(i, dt.date(2020, 1, 1) + dt.timedelta(days=i % 7), "ab"[i % 2], float(i), i % 2) for i in range(40)], "id long, day date, kind string, v double, y int")
    out = M.build_feature_splits(df, target="y", sort_by="day", tie_by="id")
    assert [out[n].count() for n in ("train", "val", "test")] == [28, 6, 6]
    assert out["train"].agg(F.max("day")).first()[0] <= out["test"].agg(F.min("day")).first()[0]
    assert out["features_val"].columns == ["id", "y", "numeric__v", "categorical__kind_a", "categorical__kind_b"]


def test_frequency_encoding(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, k string")
    assert {r["i"]: r["k"] for r in M.frequency_encode(new, train, ["k"]).collect()} == {1: 0.5, 2: 0.0, 3: 0.0}


def test_metrics_with_empty_denominators(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert tuple(K.class_metrics(df, label="y", prediction="p").first()) == (0, 0, 1, 1, 0.5, 0.0, 0.0, 0.0)
    base = K.majority_baseline(spark.createDataFrame([(1,), (0,)], "y int"), df, "y")
    assert {r["prediction"] for r in base.collect()} == {0}


def points(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i % 10 == 0), *map(float, rng.normal(5 * (i % 10 == 0), 1, 2))) for i in range(600)]
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "key long, y int, a double, b double")).select("key", "y", "features")


def test_oversampling(spark):
    df = points(spark)
    out = K.oversample_minority(df, label="y", key="key").cache()
    counts = {(r["y"], r["synthetic"]): r["n"] for r in out.groupBy("y", "synthetic").agg(F.count("*").alias("n")).collect()}
    assert counts == {(0, False): 540, (1, False): 60, (1, True): 270 - 60}
    real = np.array([r["features"].toArray() for r in df.where("y = 1").collect()])
    made = np.array([r["features"].toArray() for r in out.where("synthetic").collect()])
    assert (made >= real.min(axis=0) - 1e-9).all() and (made <= real.max(axis=0) + 1e-9).all()
    again = K.oversample_minority(df.repartition(3), label="y", key="key")
    redone = sorted(tuple(r["features"].toArray()) for r in again.where("synthetic").collect())
    assert np.allclose(redone, sorted(map(tuple, made)))


@pytest.mark.parametrize("cell_rows", [100_000, 20])
def test_neighbours_against_brute_force(spark, cell_rows):
    df = points(spark).where("y = 1")
    real = {r["key"]: r["features"].toArray() for r in df.collect()}
    hits = 0
    for r in K.near_neighbours(df, "key", "features", k=5, cell_rows=cell_rows).collect():
        others = sorted(np.linalg.norm(real[r["key"]] - v) for k, v in real.items() if k != r["key"])[:5]
        got = [np.linalg.norm(real[r["key"]] - np.array(v)) for v in r["neighbours"]]
        assert got == sorted(got) and len(got) == 5
        hits += sum(d <= others[-1] + 1e-9 for d in got)
    assert hits == 5 * len(real)


def test_neighbours_are_exact_at_any_size(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(19_000, 10)), np.tile(rng.normal(size=(1, 10)), (1_000, 1))])
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["key", *[f"f{j}" for j in range(10)]])
    df = VectorAssembler(inputCols=[f"f{j}" for j in range(10)], outputCol="features").transform(rows)
    got = {r["key"]: np.array(r["neighbours"]) for r in K.near_neighbours(df, "key", "features", k=5).collect()}
    assert len(got) == len(x)
    for i in range(0, len(x), 100):
        d = np.sort(((x - x[i]) ** 2).sum(axis=1))[1:6]
        assert np.allclose(((got[i] - x[i]) ** 2).sum(axis=1), d, atol=1e-9)


def test_cells_are_found_by_descent(spark):
    """What a cell meets equals a comparison of all boxes, without a plan that compares them all; cells of equal rows and a lone cell included."""
    rng = np.random.default_rng(4)
    depth, rows = 6, []
    for leaf in range(1 << depth):
        if leaf % 9 == 4:
            continue                                    # an empty leaf
        for salt in range(1 + leaf % 2):
            low = rng.uniform(0, 100, 2)
            far = 0.0 if leaf % 5 == 0 else float("inf") if leaf == 17 else float(rng.uniform(0, 400))
            rows.append(((leaf + (1 << depth) - 1, salt), low.tolist(), (low + rng.uniform(0, 9, 2)).tolist(), far))
    boxes = spark.createDataFrame(rows, "cell struct<leaf: long, salt: long>, low array<double>, high array<double>, far double")
    want = set()
    for a, low_a, high_a, far in rows:
        for b, low_b, high_b, _ in rows:
            gap = np.maximum(np.maximum(np.array(low_a) - high_b, np.array(low_b) - high_a), 0)
            if a == b or (gap ** 2).sum() < far:
                want.add((a, b))
    found = K._meeting_cells(boxes, depth, 2)
    assert {(tuple(r["cell_a"]), tuple(r["cell_b"])) for r in found.collect()} == want
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_oversampling_with_repeated_keys_makes_what_was_asked(spark):
    rows = [(i, 0, float(i % 13), 1.0) for i in range(100)] + [(1000 + i // 2, 1, float(i), float(i % 3)) for i in range(20)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "key long, y int, a double, b double"))
    out = K.oversample_minority(df, label="y", key="key")
    assert out.where("synthetic").count() == 50 - 20
    alone = df.where("y = 0 or key = 1000").dropDuplicates(["key"])
    assert K.oversample_minority(alone, label="y", key="key").where("synthetic").count() == 0          # nothing lies near a lone row


def test_trees_of_unsupported_depth_are_refused():
    with pytest.raises(ValueError):
        K.make_classifier("gradient_boosting", "y", depth=41)


def test_grid_and_best(spark):
    df = points(spark)
    grid = {"decision_tree": K.GRID["decision_tree"][:2], "logistic_regression": K.GRID["logistic_regression"][:1]}
    results, models = K.train_grid(df.where("key % 3 > 0"), df.where("key % 3 = 0"), "y", families=grid, depth=4)
    assert results.count() == 6 and len(models) == 3
    best = K.best_configurations(results)
    assert {r["model"] for r in best.collect()} == set(grid)
    scored = K.score_best(results, models, df.where("key % 3 = 0"), "y")
    assert min(r["f1_score"] for r in scored.collect()) > 0.9


def test_linear_models_are_fitted_on_few_tasks(spark, monkeypatch):
    df = points(spark).repartition(6)
    monkeypatch.setattr(K, "ROWS_PER_TASK", 10)
    make, tasks = K.make_classifier, []

    class Watched:
        def __init__(self, family, inner):
            self.family, self.inner = family, inner

        def fit(self, data):
            tasks.append((self.family, data.rdd.getNumPartitions()))
            return self.inner.fit(data)
    monkeypatch.setattr(K, "make_classifier", lambda family, *a, **p: Watched(family, make(family, *a, **p)))
    results, _ = K.train_grid(df, df, "y", families={"linear_svm": [{"c": 1.0, "max_iter": 5}], "decision_tree": [{"min_split": 5}]}, depth=2)
    assert results.count() == 4 and tasks == [("linear_svm", 1), ("decision_tree", 6)]


def test_neighbours_of_rows_that_share_points(spark, monkeypatch):
    """Few points hold most rows: each row's neighbours are its copies and then the nearest others, and cells are made of points, not of rows."""
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.integers(0, 3, (300, 2)), draw.integers(0, 40, (60, 2))]).astype(float)
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame([(i, *v) for i, v in enumerate(x.tolist())], "key long, a double, b double"))
    cells, meeting = [], K._meeting_cells
    monkeypatch.setattr(K, "_meeting_cells", lambda boxes, *a: cells.append(boxes.count()) or meeting(boxes, *a))
    got = {r["key"]: (r["x"], r["neighbours"]) for r in K.near_neighbours(df, "key", "features", k=5, cell_rows=20).collect()}
    assert len(got) == len(x) and cells[0] <= 8
    for i, (own, near) in got.items():
        d = np.sort(np.delete(((x - x[i]) ** 2).sum(axis=1), i))[:5]
        assert own == x[i].tolist() and np.allclose(((np.array(near) - x[i]) ** 2).sum(axis=1), d)
