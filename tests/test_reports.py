"""Quality reports over the small world."""

import json

import pytest
from pyspark.sql import functions as F

import football
from pitwise.plans import feed_report, primary_report
from pitwise.sources import feed
from pitwise.sources.tables import load_tables


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    raw, feeds = football.build(tmp_path_factory.mktemp("world"))
    return {n: t.cache() for n, t in load_tables(spark, raw).items()}, feed.read_feed(spark, feed.feed_paths(spark, feeds))


def verdicts(checks):
    return {(r["table_name"], r["check_name"]): (r["status"], r["applicable_rows"], r["failed_rows"]) for r in checks.collect()}


def test_primary_report(world):
    tables = dict(world[0])
    tables["appearances"] = tables["appearances"].withColumn("minutes_played", F.when(F.col("appearance_id") == "100-b0", 500).otherwise(F.col("minutes_played")))
    report = primary_report.run_report(tables, "2021-01-01")
    acc = verdicts(report["accuracy"]["checks"])
    assert acc[("appearances", "minutes_played_between_0_and_130")][0::2] == ("failed", 1)
    assert acc[("appearances", "yellow_cards_between_0_and_2")][0] == "skipped"
    assert acc[("players", "age_at_last_season_between_15_and_50")] == ("passed", 16, 0)
    con = verdicts(report["consistency"]["checks"])
    assert con[("players", "date_of_birth_uses_datetime_format")][0] == "passed" and con[("players", "contract_expiration_date_uses_datetime_format")][0] == "skipped"
    assert con[("transfers", "transfer_season_uses_nn_nn_format")][0] == "passed" and con[("clubs", "average_age_uses_one_decimal_place")][0] == "passed"
    need = verdicts(report["completeness"]["required_field_checks"])
    assert need[("transfers", "transfer_date_required")] == ("failed", 17, 1) and need[("clubs", "domestic_competition_id_required")] == ("failed", 7, 1)
    patterns = {(r["table_name"], r["column_name"]): r["pattern"] for r in report["completeness"]["missing_patterns"].collect()}
    assert patterns[("transfers", "transfer_season")] == "high_missingness" and patterns[("transfers", "transfer_date")] == "some_missingness"
    exact = {r["table_name"]: r["exact_duplicate_rows"] for r in report["uniqueness"]["exact_duplicates"].collect()}
    assert exact["transfers"] == 1 and exact["games"] == 0
    subset = {r["table_name"]: (r["status"], r["duplicate_count"], r["duplicate_groups"]) for r in report["uniqueness"]["subset_duplicate_checks"].collect()}
    assert subset["transfers"] == ("failed", 1, 1) and subset["game_lineups" if "game_lineups" in subset else "club_games"][0] == "passed"
    assert report["uniqueness"]["fuzzy_duplicate_candidates"].count() > 0
    time = verdicts(report["timeliness"]["checks"])
    assert time[("transfers", "date_values_are_parseable")] == ("failed", 17, 1)
    assert time[("player_valuations", "no_future_dates")][0] == "failed" and time[("appearances", "date_matches_games_date")][0] == "passed"
    assert time[("transfers", "transfer_season_matches_transfer_date")] == ("passed", 5, 0)
    assert time[("transfers", "no_duplicate_time_keys")][2] == 1
    cover = {r["table_name"]: r.asDict() for r in report["timeliness"]["coverage"].collect()}
    assert cover["transfers"]["invalid_dates"] == 1 and cover["player_valuations"]["max_date"].isoformat() == "2023-06-30"
    rel = verdicts(report["relationships"]["dependency_checks"])
    assert {v[0] for v in rel.values()} == {"passed"} and len(rel) == 3
    shapes = {(r["table_name"], r["column_name"]): r for r in report["distribution"]["numeric_profiles"].collect()}
    assert shapes[("appearances", "goals")]["distribution_type"] == "exact_frequency" and shapes[("games", "attendance")]["distribution_type"] == "equal_width_bins"
    assert report["outliers"]["summary"].count() > 0 and report["distribution"]["summary"].count() > 0
    strong = {(r["left_column"], r["right_column"]) for r in report["relationships"]["correlations"].collect()}
    assert ("own_goals", "is_win") in strong and ("minutes_played", "goals") in strong


def test_feed_report(world):
    one = world[1].where("file_name like '%_b.json'")
    report = feed_report.feed_report(one, {"league": 39, "season": 2018, "status": "FT-AET-PEN"}, now="2024-01-01")
    got = verdicts(report["checks"])
    assert got[("api_wrapper", "echoed_parameters_match_request")] == ("failed", 3, 1)      # the status is not echoed
    others = {k: v[0] for k, v in got.items() if v[0] != "passed"}
    assert set(others) == {("api_wrapper", "echoed_parameters_match_request")}
    assert len([k for k in got if k[1].startswith("wrapper_field_")]) == 6 and len([k for k in got if k[1].endswith("_not_missing")]) == 14
    assert {r["dimension"] for r in report["report"].collect()} == {
        "accuracy", "completeness", "consistency", "distribution", "outliers", "relationships", "timeliness", "uniqueness"}
    assert report["coverage"].first()["unique_days"] == 2 and report["duplicate_rows"].count() == 0
    lines = {r["dimension"]: r["status"] for r in report["report"].collect()}
    assert lines.pop("consistency") == "failed" and set(lines.values()) == {"passed"}
    came = report["request_metadata"].first()
    assert came["status_code"] == 200 and json.loads(came["request_params"])["season"] == 2018 and came["fixture_rows"] == report["fixtures"].count()
    u = report["uniqueness_summary"].first()
    assert (u["table_name"], u["rows"], u["exact_duplicate_rows"], u["duplicate_fixture_ids"], u["duplicate_business_keys"]) == ("api_fixtures", came["fixture_rows"], 0, 0, 0)


def test_feed_report_finds_planted_errors(world):
    bad = world[1].where("file_name like '%_b.json'").withColumn("response", F.concat("response", F.transform(F.slice("response", 1, 1), lambda x: x), F.transform(
        F.slice("response", 1, 1), lambda x: x.withField("fixture.id", F.lit(-5).cast("long")).withField("goals.home", F.lit(-1).cast("long")).withField("fixture.timestamp", F.lit(0).cast("long"))
        .withField("fixture.status.long", F.lit(None).cast("string"))))).withColumn("results", F.lit("7"))
    report = feed_report.feed_report(bad, {"season": 2018}, now="2019-03-01", fetch={"endpoint": "/fixtures", "headers": {"X-RateLimit-Remaining": "9"}})
    got = verdicts(report["checks"])
    u, came = report["uniqueness_summary"].first(), report["request_metadata"].first()
    assert (u["exact_duplicate_rows"], u["duplicate_fixture_ids"]) == (1, 2) and (came["endpoint"], came["minute_requests_remaining"]) == ("/fixtures", "9")
    failed = {k[1] for k, v in got.items() if v[0] == "failed"}
    assert failed == {"results_matches_response_count", "fixture_ids_are_positive", "goals_are_non_negative", "fixture_timestamp_matches_fixture_date",
                      "status_fields_are_populated_together", "no_exact_duplicate_rows", "fixture_id_is_unique", "fixture_business_key_is_unique",
                      "completed_fixtures_are_not_future_dated", "status_long_not_missing", "away_winner_matches_score_difference"}
    assert got[("api_fixtures", "no_exact_duplicate_rows")][2] == 1 and got[("api_fixtures", "fixture_id_is_unique")][2] == 2


def test_feed_guard(world):
    one = world[1].where("file_name like '%_b.json'")
    with pytest.raises(RuntimeError):
        feed_report.guard(one, 500)
    with pytest.raises(ValueError, match="token: bad"):
        feed_report.guard(one.withColumn("errors", F.lit('{"token": "bad"}')), 200)
    with pytest.raises(ValueError, match="no rows"):
        feed_report.guard(one.withColumn("response", F.slice("response", 1, 0)), 200)


def test_merged_report(world, spark):
    tables, payloads = world
    flat = feed.flatten_feed(payloads.where("file_name like '%_b.json'"))
    games = spark.createDataFrame([
        (1, "GB1", 2018, "2019-02-10", 1, 9, 2, 0, "Wolverhampton Wanderers", "Other FC", 500), (2, "GB1", 2018, "2019-03-10", 9, 1, 1, 1, "Other", "Wolves", 600),
        (3, "GB1", 2018, "2019-04-10", 9, 1, 1, 1, "Other", "Wolves", 700), (4, "ES1", 2018, "2019-04-10", 9, 1, 1, 1, "Other", "Wolves", 700)],
        "game_id long, competition_id string, season long, date string, home_club_id long, away_club_id long, home_club_goals long, away_club_goals long, home_club_name string, away_club_name string, attendance long")
    report = feed_report.merged_report(flat, games, tables["competitions"], now="2024-01-01")
    s = report["summary"].first()
    assert (s["competition_id"], s["matched_rows"], s["left_rows"], s["right_rows"], s["right_unmatched_rows"], s["right_match_rate_pct"]) == ("GB1", 2, 2, 3, 1, 66.6667)
    failed = {k[1]: v for k, v in verdicts(report["checks"]).items() if v[0] == "failed"}
    assert set(failed) == {"api_away_goals_match_kaggle_away_goals", "all_kaggle_games_were_matched"}
    assert [r["game_id"] for r in report["unmatched_games"].collect()] == [3]
    assert len([k for k in verdicts(report["checks"]) if k[1].endswith("_present_and_populated")]) == 22
