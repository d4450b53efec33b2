import datetime as dt
import random

from pitwise.operators import models as K
from pitwise.plans.cleaning import clean_directory
from pitwise.plans.modelling import train_and_score


def test_clean_directory(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "games.csv").write_text("game_date,minutes,note\n2020-01-01,90,\n2020-01-01,90,\nbad,,\n2020-01-03,60,x\n")
    (raw / "none.csv").write_text("a,b\n")
    paths = clean_directory(spark, str(raw), str(tmp_path / "out"))
    assert list(paths) == ["games"]
    rows = spark.read.option("header", True).csv(paths["games"]).collect()
    assert len(rows) == 3 and rows[0].asDict().keys() == {"game_date", "minutes"}
    assert sorted((r["game_date"][:10], float(r["minutes"])) for r in rows) == [("2020-01-01", 75.0), ("2020-01-01", 90.0), ("2020-01-03", 60.0)]
    assert clean_directory(spark, str(tmp_path / "missing"), str(tmp_path / "out2")) == {}


def test_train_and_score(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        good = int(rng.random() < 0.2)
        rows.append((i, dt.date(2020, 1, 1) + dt.timedelta(days=i // 3), rng.gauss(3 * good, 1) if i % 17 else None, rng.choice("ab") if good else rng.choice("bc"),
                     None if i % 3 else 1.0, good, float(good)))
    df = spark.createDataFrame(rows, "id long, day date, x double, kind string, sparse double, y int, target_leak double")
    grid = {"logistic_regression": K.GRID["logistic_regression"][:1], "decision_tree": K.GRID["decision_tree"][:1]}
    out = train_and_score(df, target="y", sort_by="day", tie_by="id", families=grid, depth=4)
    assert out["features"] == ["x", "kind"]
    scores = {r["model"]: r.asDict() for r in out["test_results"].collect()}
    assert set(scores) == {"logistic_regression", "decision_tree", "majority"} and scores["majority"]["f1_score"] == 0.0
    assert scores["logistic_regression"]["f1_score"] > 0.6 and sum(scores["majority"][k] for k in ("tp", "fp", "fn", "tn")) == 90


def test_prepare_features_keeps_ids_names_and_dates_out(spark, tmp_path):
    from pitwise.operators.features import Preprocessor
    from pitwise.plans.features import EXCLUDED, prepare_features
    from pitwise.plans.modelling import LEAKING
    rows = [(f"t{i}", f"2020-{1 + i % 12:02d}-{1 + i % 28:02d}", i, f"name {i}", f"club {i % 7}", float(i % 13), "left" if i % 3 else "right", "why", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "transfer_key string, transfer_date string, player_id int, player_name string, source_club_name string, fee double, foot string, target_failure_reason string, transfer_success int")
    from pyspark.sql import functions as F
    df = df.withColumn("transfer_date", F.to_date("transfer_date")).withColumn("order_key", F.substring("transfer_key", 2, 9).cast("long"))
    out = prepare_features(df, str(tmp_path), tie_by="order_key")
    assert set(out["preprocessor"].feature_columns) == {"fee", "foot"}
    assert {"exclusion_reason", "source_competition_name", "destination_country_name", "transfer_season", "source_api_cache_file", *EXCLUDED[:-2]} <= set(LEAKING)
    sizes = {n: spark.read.parquet(out["paths"][n]).count() for n in ("train", "val", "test", "features_train", "features_val", "features_test")}
    assert sizes == {"train": 42, "val": 9, "test": 9, "features_train": 42, "features_val": 9, "features_test": 9}
    assert Preprocessor.load(out["paths"]["preprocessor"]).feature_columns == out["preprocessor"].feature_columns


def test_features_of_the_modelling_table_with_defaults(spark, tmp_path):
    import football
    from pyspark.sql import functions as F
    from pitwise.plans import features, transfers
    from pitwise.sources import feed
    from pitwise.sources.tables import load_tables
    raw, feeds = football.build(tmp_path)
    table = transfers.build_modeling_dataset(load_tables(spark, raw), feed.read_feed(spark, feed.feed_paths(spark, feeds)))["modeling_dataset"]
    assert features.TARGET in table.columns
    out = features.prepare_features(table.withColumn("position_in_file", F.col("player_id").cast("long")), str(tmp_path / "out"), tie_by="position_in_file")
    chosen = set(out["preprocessor"].feature_columns)
    assert features.TARGET not in chosen and not chosen & set(features.EXCLUDED) and not [c for c in chosen if c.startswith("target_")]
    assert {"age_at_transfer", "pre_transfer_market_value", "player_minutes_180d_pre"} <= chosen
    total = sum(spark.read.parquet(out["paths"][n]).count() for n in ("train", "val", "test"))
    assert total == table.count()
