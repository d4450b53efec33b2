"""The whole modelling table from files, with planted cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import football
from pitwise.plans import transfers as T
from pitwise.sources import feed
from pitwise.sources.tables import load_tables


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    raw, feeds = football.build(tmp_path_factory.mktemp("world"))
    return {n: t.cache() for n, t in load_tables(spark, raw).items()}, feed.read_feed(spark, feed.feed_paths(spark, feeds))


@pytest.fixture(scope="module")
def outputs(world):
    return T.build_modeling_dataset(*world)


def rows(df, key="player_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_exclusion_reasons(outputs):
    got = sorted((r["player_id"], r["exclusion_reason"]) for r in outputs["excluded_transfers"].collect())
    assert got == [(100, "duplicate_transfer_business_key"), (201, "after_modeling_window"), (202, "destination_not_big_five"),
                   (203, "missing_transfer_date"), (204, "before_modeling_window;missing_destination_competition")]


def test_labels_and_failures(outputs):
    model = rows(outputs["modeling_dataset"])
    assert {p: r["transfer_success"] for p, r in model.items()} == {100 + i: i % 2 for i in range(10)}
    failed = {p: r["target_failure_reason"] for p, r in rows(outputs["label_eligibility_failures"]).items()}
    assert failed == {200: "no_market_value_inside_follow_up_window", 205: "missing_pre_transfer_market_value;incomplete_follow_up_window"}


def test_nothing_after_the_window_counts(outputs):
    r = rows(outputs["modeling_dataset"])[100]
    assert (r["target_destination_matches_24m"], r["target_destination_minutes_24m"], r["target_end_market_value"]) == (5, 400, 1_000_000)


def test_point_in_time_features(outputs):
    r = rows(outputs["modeling_dataset"])[101]
    assert (r["pre_transfer_market_value"], r["market_value_180d_prior"], r["market_value_365d_prior"]) == (1_500_000, 1_000_000, 800_000)
    assert (r["market_value_change_180d"], r["market_value_change_365d"], r["transfer_fee_minus_market_value"]) == (500_000, 700_000, -600_000)
    assert r["transfer_fee_to_market_value_ratio"] == pytest.approx(0.6) and r["pre_transfer_market_value_source"] == "valuation_history"
    # matches 100, 200 and 300 days earlier; the one on the transfer day does not count
    assert (r["player_matches_180d_pre"], r["player_matches_365d_pre"], r["player_minutes_180d_pre"], r["player_goals_per90_180d_pre"]) == (1, 3, 90, 1.0)
    assert (r["age_at_transfer"], r["season_start_year"], r["is_same_league_move"], r["is_same_country_move"]) == (26, 2018, 0, 0)


def test_club_form_equals_brute_force(outputs, world):
    games = {g["game_id"]: g["date"] for g in world[0]["games"].collect()}
    results = world[0]["club_games"].collect()
    for r in outputs["modeling_dataset"].collect():
        low, high = r["transfer_date"] - dt.timedelta(days=365), r["transfer_date"] - dt.timedelta(days=1)
        for role in ("source", "destination"):
            mine = [x for x in results if x["club_id"] == r[f"{role}_club_id"] and low < dt.date.fromisoformat(str(games[x["game_id"]])) <= high]
            assert r[f"{role}_matches_365d_pre"] == len(mine)
            if mine:
                points = sum(3 * x["is_win"] + (x["own_goals"] == x["opponent_goals"]) for x in mine)
                assert r[f"{role}_points_per_match_365d_pre"] == pytest.approx(points / len(mine))
            else:
                assert r[f"{role}_win_rate_365d_pre"] is None


def test_feed_context_later_file_wins(outputs):
    r = rows(outputs["modeling_dataset"])[100]      # season from the date: January 2019 is season 2018
    assert (r["destination_api_cached_matches"], r["destination_api_cached_win_rate"], r["destination_api_cached_goal_diff_per_match"]) == (2, 0.5, 0.5)
    assert r["destination_api_context_matched"] == 1 and r["source_api_context_matched"] == 0
    assert rows(outputs["modeling_dataset"])[101]["destination_api_context_matched"] == 1      # league known by name


def test_columns_summary_and_files(outputs, world, tmp_path):
    model = outputs["modeling_dataset"]
    assert model.columns[:len(T.output_columns())] == T.output_columns() and len(T.output_columns()) == 77
    dates = [r["transfer_date"] for r in model.collect()]
    assert dates == sorted(dates)
    summary = {r["metric"]: r["value"] for r in outputs["audit_summary"].collect()}
    assert [summary[k] for k in ("raw_transfers", "candidate_transfers", "modeling_rows", "excluded_rows", "label_ineligible_rows", "positive_class_rate")] == [
        "17", "12", "10", "5", "2", "0.5"]
    from pitwise.sources.tables import write_bundle
    paths = write_bundle(outputs, str(tmp_path), T.OUTPUT_NAMES)
    assert set(paths) == set(T.OUTPUT_NAMES)
    assert model.sparkSession.read.option("header", True).csv(paths["modeling_dataset"]).count() == 10


def test_useless_feed_is_an_error(world, spark):
    tables, payloads = world
    with pytest.raises(ValueError, match="no usable rows"):
        T.build_modeling_dataset(tables, payloads.where("file_name = 'nothing'"))
    shifted = payloads.withColumn("response", F.transform("response", lambda x: x.withField("league.season", F.lit(1990).cast("long"))))
    with pytest.raises(ValueError, match="does not match"):
        T.build_modeling_dataset(tables, shifted)


def test_missing_table_is_an_error(world):
    tables = {k: v for k, v in world[0].items() if k != "games"}
    with pytest.raises(FileNotFoundError, match="games"):
        T.build_modeling_dataset(tables, world[1])


@pytest.mark.parametrize("weighted", [True, False])
def test_three_year_labels(world, weighted):
    got = {(r["player_id"], str(r["transfer_date"])): r["transfer_success"] for r in T.three_year_labels(world[0], weighted=weighted).collect()}
    # odd players: 2000 minutes and a higher value; even ones: 5 assists (both limits) and the sub-position
    # limit of no goals, which is 3 of 6 plain votes but only 3 of 5 points needed
    assert got[(101, "2019-03-11")] == 1 and got[(102, "2019-05-10")] == (0 if weighted else 1)
    # player 100 has late minutes, goals and value inside three years
    assert got[(100, "2019-01-10")] == 1


def test_label_job_writes_both_kinds(world, tmp_path, spark):
    paths = T.label_job(world[0], str(tmp_path))
    assert {k: p.rsplit("/", 1)[1] for k, p in paths.items()} == T.LABEL_NAMES
    for kind, path in paths.items():
        back = spark.read.option("header", True).csv(path)
        want = sorted((str(r["player_id"]), str(r["transfer_success"])) for r in T.three_year_labels(world[0], weighted=kind == "weighted").collect())
        assert sorted((r["player_id"], r["transfer_success"]) for r in back.collect()) == want
