"""Quality report over the nested feed, and over the feed matched with the games table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pitwise.functions.scalars import date_only, differs, differs_by_more_than, eq, epoch_to_timestamp, missing_mask, parse_datetime, to_number
from pitwise.functions.text import normalize_text
from pitwise.operators import linkage as L
from pitwise.operators import profile as P
from pitwise.operators import quality as Q
from pitwise.operators.cleaning import fitted_modes
from pitwise.operators.joins import mark_all_copies
from pitwise.session import materialize
from pitwise.sources import feed
from pitwise.sources.tables import with_row_order

# Wrapper fields, required flat fields and finished states.
WRAPPER_FIELDS = ("get", "parameters", "errors", "results", "paging", "response")
REQUIRED_FIELDS = (
    "fixture_id", "fixture_date", "fixture_timestamp", "status_short", "status_long", "league_id", "league_name", "season", "home_team_id", "home_team_name",
    "away_team_id", "away_team_name", "home_goals", "away_goals")
FINISHED = ("FT", "AET", "PEN")

# Words that carry no identity in team names, and whole-name aliases.
STOPWORDS = ("football", "club", "fc", "afc", "association", "sporting", "hotspur", "town", "city", "united", "wanderers", "albion", "hove", "and", "s", "a", "d")
ALIASES = {"wolves": "wolverhampton"}

# Required columns of the matched table.
MERGED_REQUIRED = (
    "game_id", "competition_id", "season", "date", "home_club_id", "away_club_id", "home_club_name", "away_club_name", "home_club_goals", "away_club_goals",
    "api_fixture_id", "api_fixture_date", "api_league_id", "api_league_name", "api_home_team_id", "api_away_team_id", "api_home_team_name", "api_away_team_name",
    "api_home_goals", "api_away_goals", "api_status_short", "api_status_long")
MERGED_NUMERIC = ("home_club_goals", "away_club_goals", "attendance")
MERGED_CATEGORICAL = ("api_status_short", "competition_type", "home_club_formation", "away_club_formation")
TABLE = "api_fixtures"


def _checks(df: DataFrame, rules: Sequence[Q.Rule], table: str, dimension: str, order_by: Sequence[str] = ()) -> DataFrame:
    return Q.run_checks(df, rules, table=table, dimension=dimension, order_by=order_by)


def _not_positive(c: str) -> Column:
    n = to_number(c)
    return n.isNull() | (n <= 0)


def _dated(df: DataFrame, column: str = "fixture_date") -> DataFrame:
    return df.withColumn("__at", parse_datetime(column))


def guard(payloads: DataFrame, status_code: int) -> None:
    """A feed that failed, reports errors or holds nothing is an error, not a report."""
    if status_code != 200:
        raise RuntimeError(f"the feed returned status {status_code}")
    row = payloads.agg(F.max(F.when(F.size(feed.normalize_errors("errors")) > 0, F.array_join(feed.normalize_errors("errors"), "; "))).alias("e"),
                       F.coalesce(F.sum(F.greatest(F.size("response"), F.lit(0))), F.lit(0)).alias("n")).first()
    if row["e"]:
        raise ValueError(f"the feed reports errors: {row['e']}")
    if not row["n"]:
        raise ValueError("the feed holds no rows")


def _same_key_rows(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    return mark_all_copies(df, keys, position, "__copy")


def feed_report(payloads: DataFrame, request: Mapping[str, object], *, status_code: int = 200, now: str | None = None,
                fetch: Mapping[str, object] | None = None) -> dict[str, DataFrame]:
    """All check records of the feed, the flat rows, coverage, profiles, the request's metadata and the report lines.

    ``request`` holds the submitted parameters; ``now`` (ISO text) bounds the future check. ``fetch`` says how the payload came in:
    ``endpoint``, ``source``, ``elapsed_seconds``, ``request_url`` and ``headers``, all of which may be absent.
    """
    guard(payloads, status_code)
    flat = materialize(with_row_order(feed.flatten_feed(payloads), "__row"))
    season = int(request["season"])
    clock = F.to_timestamp(F.lit(now)) if now else F.current_timestamp()
    finished = [s for s in str(request.get("status", "")).split("-") if s] or list(FINISHED)
    params = feed.normalize_parameters("parameters")
    wrapper = payloads.select("*", F.size(feed.normalize_errors("errors")).alias("__errors"), F.greatest(F.size("response"), F.lit(0)).alias("__rows"),
                              F.regexp_replace(F.trim(F.coalesce("get", F.lit(""))), "^/+|/+$", "").alias("__get"), params.alias("__params"))
    parts = []

    # accuracy
    parts.append(_checks(wrapper, [
        Q.predicate("http_status_is_200", ["get"], F.lit(status_code != 200)), Q.predicate("errors_array_is_empty", ["errors"], F.col("__errors") > 0),
        Q.predicate("get_field_is_fixtures", ["get"], F.col("__get") != "fixtures"),
        Q.predicate("results_matches_response_count", ["results"], differs(to_number("results"), F.col("__rows").cast("double"))),
        Q.predicate("season_parameter_echoes_request", ["parameters"], differs(F.try_element_at("__params", F.lit("season")), F.lit(str(season)))),
    ], "api_wrapper", "accuracy"))
    goals = [to_number(c) for c in ("home_goals", "away_goals")]
    parts.append(_checks(flat, [
        Q.predicate("fixture_season_matches_request", ["season"], differs(to_number("season"), F.lit(float(season)))),
        Q.predicate("fixture_ids_are_positive", ["fixture_id"], _not_positive("fixture_id")),
        Q.predicate("league_ids_are_positive", ["league_id"], _not_positive("league_id")),
        Q.predicate("team_ids_are_positive", ["home_team_id", "away_team_id"], _not_positive("home_team_id") | _not_positive("away_team_id")),
        Q.predicate("goals_are_non_negative", ["home_goals", "away_goals"], F.coalesce(goals[0] < 0, F.lit(False)) | F.coalesce(goals[1] < 0, F.lit(False))),
    ], TABLE, "accuracy", ["__row"]))

    # consistency
    echoed = payloads.select(F.explode(F.array(*[F.struct(F.lit(str(k)).alias("parameter"), F.lit(str(v)).alias("requested"),
                                                          F.try_element_at(params, F.lit(str(k))).alias("echoed")) for k, v in request.items()])).alias("p")).select("p.*")
    parts.append(_checks(echoed, [Q.predicate("echoed_parameters_match_request", ["parameter", "requested", "echoed"], differs("requested", "echoed"))],
                         "api_wrapper", "consistency", ["parameter"]))
    timed = _dated(flat).withColumn("__epoch", epoch_to_timestamp("fixture_timestamp"))
    blank = {c: missing_mask(c) for c in ("status_short", "status_long", "home_team_id", "home_team_name", "away_team_id", "away_team_name")}
    parts.append(_checks(timed, [
        Q.predicate("fixture_date_is_parseable", ["fixture_date"], F.col("__at").isNull()),
        Q.predicate("fixture_timestamp_matches_fixture_date", ["fixture_date", "fixture_timestamp"], differs_by_more_than("__at", "__epoch", 60),
                    applicable=F.col("__at").isNotNull() & F.col("__epoch").isNotNull()),
        Q.predicate("status_fields_are_populated_together", ["status_short", "status_long"], blank["status_short"] != blank["status_long"]),
        Q.predicate("home_and_away_team_structure_is_complete", ["home_team_id", "home_team_name", "away_team_id", "away_team_name"],
                    blank["home_team_id"] | blank["home_team_name"] | blank["away_team_id"] | blank["away_team_name"]),
    ], TABLE, "consistency", ["__row"]))

    # completeness
    parts.append(_checks(payloads, [Q.predicate(f"wrapper_field_{c}_present", [c], F.col(c).isNull()) for c in WRAPPER_FIELDS]
                         + [Q.predicate("response_contains_rows", ["response"], F.greatest(F.size("response"), F.lit(0)) == 0)], "api_wrapper", "completeness"))
    parts.append(_checks(flat, [Q.predicate(f"{c}_not_missing", [c], missing_mask(c)) for c in REQUIRED_FIELDS], TABLE, "completeness", ["__row"]))

    # uniqueness
    columns = [n for n, _ in feed.FLAT_FIELDS]
    copies = mark_all_copies(flat, columns, "__row", "__exact").withColumn("__id_known", F.col("fixture_id").isNotNull())
    copies = mark_all_copies(copies, ["fixture_id"], "__row", "__same_id")
    surplus = flat.groupBy(*columns).agg(F.min("__row").alias("__keep"))
    later = flat.join(surplus.select("__keep"), flat["__row"] == surplus["__keep"], "left").withColumn("__later", F.col("__keep").isNull())
    parts.append(_checks(later, [Q.predicate("no_exact_duplicate_rows", ["fixture_id", "fixture_date"], F.col("__later"))], TABLE, "uniqueness", ["__row"]))
    same = F.col("__same_id") & F.col("__id_known")
    parts.append(_checks(copies, [Q.predicate("fixture_id_is_unique", ["fixture_id"], same), Q.predicate("fixture_business_key_is_unique", ["fixture_id"], same)],
                         TABLE, "uniqueness", ["__row"]))

    # timeliness
    year, at = F.year("__at"), F.col("__at")
    complete = F.coalesce("status_short", F.lit("")).isin(*finished) & at.isNotNull()
    days = timed.agg(F.count_distinct(F.to_date("__at")).alias("unique_days"))
    parts.append(_checks(timed, [
        Q.predicate("fixture_dates_are_parseable", ["fixture_date"], at.isNull()),
        Q.predicate("fixture_dates_fall_in_requested_season_window", ["fixture_date"], ~year.isin(season, season + 1), applicable=at.isNotNull()),
        Q.predicate("completed_fixtures_are_not_future_dated", ["fixture_date", "status_short"], at > clock, applicable=complete),
    ], TABLE, "timeliness", ["__row"]))
    parts.append(_checks(days, [Q.predicate("sample_spans_multiple_match_days", ["unique_days"], F.col("unique_days") < 2)], TABLE, "timeliness"))

    # relationships
    parts.append(_checks(flat, _winner_rules("", "home_goals", "away_goals", "home_winner", "away_winner"), TABLE, "relationships", ["__row"]))

    checks = materialize(_union(parts))
    rows = flat.drop("__row")
    came = {"endpoint": "", "source": "", "elapsed_seconds": 0.0, "request_url": "", **(fetch or {})}
    named = payloads if "file_name" in payloads.columns else payloads.withColumn("file_name", F.lit(None).cast("string"))
    metadata = feed.request_metadata(named, status_code=status_code, request_params=json.dumps(dict(request), default=str), **came)
    twice = F.lit(copies.agg(F.count_if(same)).scalar())
    unique = later.agg(F.count(F.lit(1)).alias("rows"), F.count_if("__later").alias("exact_duplicate_rows")).select(
        F.lit(TABLE).alias("table_name"), "*", twice.alias("duplicate_fixture_ids"), twice.alias("duplicate_business_keys"))
    s, e = P.iqr_outliers(flat, ["home_goals", "away_goals", "status_elapsed"], row_id="fixture_id", label="home_team_name", table=TABLE, k=10)
    categories = P.categorical_profile(rows, ["status_short", "status_long", "league_name"], TABLE)
    return {"fixtures": rows, "checks": checks.orderBy("dimension", "status", F.col("failed_pct").desc_nulls_last(), "table_name", "check_name"),
            "summary": Q.summarize(checks), "report": _report(checks, s, categories, "status_short"), "field_missingness": Q.field_completeness(rows, TABLE, REQUIRED_FIELDS),
            "request_metadata": metadata, "uniqueness_summary": unique,
            "duplicate_rows": copies.where(F.col("__exact") | same).select(*columns),
            "coverage": P.date_coverage(timed.withColumn("day", F.to_date("__at")), "day", table=TABLE), "outliers": s, "outlier_examples": e,
            "numeric_profiles": P.numeric_profile(rows, ["home_goals", "away_goals", "status_elapsed"], TABLE),
            "categorical_profiles": categories}


def _winner_rules(prefix: str, home: str, away: str, home_won: str, away_won: str) -> list[Q.Rule]:
    h, a = to_number(home), to_number(away)
    known = h.isNotNull() & a.isNotNull()
    yes = {c: eq(F.col(c), F.lit(True)) for c in (home_won, away_won)}
    shown = [home, away, home_won, away_won]
    return [Q.predicate(f"{prefix}home_winner_matches_score_difference", shown, (h > a) & ~yes[home_won], applicable=known & (h != a)),
            Q.predicate(f"{prefix}away_winner_matches_score_difference", shown, (a > h) & ~yes[away_won], applicable=known & (h != a)),
            Q.predicate("draws_do_not_mark_both_teams_as_winners", shown, yes[home_won] & yes[away_won], applicable=known & (h == a))]


def _report(checks: DataFrame, outliers: DataFrame, categories: DataFrame, status: str) -> DataFrame:
    """Eight lines: six judged dimensions, and outliers and distribution as a description."""
    count = F.coalesce(F.sum("outlier_count"), F.lit(0)).cast("string")
    top = F.coalesce(F.max(F.when(F.col("column_name") == status, F.col("mode_value"))), F.lit("none"))
    lines = [Q.report_lines(checks), Q.profile_line("outliers", F.concat(F.lit("outliers: "), count, F.lit(" values lie outside the interquartile bounds.")), outliers),
             Q.profile_line("distribution", F.concat(F.lit("distribution: the most frequent status is "), top, F.lit(".")), categories)]
    return _union(lines).orderBy("dimension")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- feed matched with games -------------------------------------------------------------------

def match_feed_with_games(flat: DataFrame, games: DataFrame, competitions: DataFrame) -> dict[str, DataFrame]:
    """Map the feed league to one competition, then match on day, season and both team keys."""
    league = L.map_entity(flat, competitions, name="league_name", country="league_country", candidate_id="competition_id",
                          candidate_names=["name", "competition_code"], candidate_country="country_name")
    chosen = league.select("competition_id", "name", "country_name").first()
    seasons = [int(r["s"]) for r in flat.select(to_number("season").alias("s")).where("s is not null").distinct().collect()]
    if not seasons:
        raise ValueError("the feed holds no season")
    renamed = flat.withColumn("match_date", date_only(parse_datetime("fixture_date")))
    renamed = L.with_entity_keys(renamed, {"home_team_key": "home_team_name", "away_team_key": "away_team_name"}, STOPWORDS, ALIASES)
    keep = ("season", "match_date", "home_team_key", "away_team_key")
    renamed = renamed.select(*keep, F.col("season").alias("api_season"), *[F.col(c).alias(f"api_{c}") for c, _ in feed.FLAT_FIELDS if c != "season"])
    left = renamed.withColumn("season", F.col("season").cast("long"))
    right = games.where((F.col("competition_id").cast("string") == chosen["competition_id"]) & to_number("season").isin([float(s) for s in seasons]))
    right = right.withColumns({"match_date": date_only(parse_datetime("date")), "season": F.col("season").cast("long")})
    right = L.with_entity_keys(right, {"home_team_key": "home_club_name", "away_team_key": "away_club_name"}, STOPWORDS, ALIASES)
    out = L.match_sources(left, right, ["match_date", "season", "home_team_key", "away_team_key"])
    merged = out["matched"].withColumns({"mapped_competition_name": F.lit(chosen["name"]), "mapped_competition_country": F.lit(chosen["country_name"])})
    modes = fitted_modes(flat, ["league_name", "league_country"])
    summary = out["summary"].select(
        F.lit(modes.get("league_name", "")).alias("league_name"), F.lit(modes.get("league_country", "")).alias("league_country"),
        F.lit(chosen["competition_id"]).alias("competition_id"), F.lit(chosen["name"]).alias("competition_name"),
        F.lit(", ".join(str(s) for s in sorted(seasons))).alias("season_values"), "*",
        F.lit(sum(c.startswith("api_") for c in merged.columns)).alias("added_api_features"),
        F.lit(", ".join(f"{a}->{b}" for a, b in ALIASES.items()) or "none").alias("name_aliases_used"))
    return {"merged": merged, "unmatched_feed": out["unmatched_left"], "unmatched_games": out["unmatched_right"], "summary": summary, "competition": league}


def merged_report(flat: DataFrame, games: DataFrame, competitions: DataFrame, *, now: str | None = None) -> dict[str, DataFrame]:
    """All check records over the matched rows, with match summary, profiles and report lines."""
    found = match_feed_with_games(flat, games, competitions)
    merged = materialize(with_row_order(found["merged"], "__row"))
    table, clock = "merged_fixtures", (F.to_timestamp(F.lit(now)) if now else F.current_timestamp())
    work = merged.withColumns({"__at": parse_datetime("api_fixture_date"), "__day": parse_datetime("date")})
    day_a, day_b = date_only("__at"), date_only("__day")
    parts = [_checks(work, [
        Q.mismatch("api_home_goals_match_kaggle_home_goals", to_number("api_home_goals"), to_number("home_club_goals"), ["api_home_goals", "home_club_goals"]),
        Q.mismatch("api_away_goals_match_kaggle_away_goals", to_number("api_away_goals"), to_number("away_club_goals"), ["api_away_goals", "away_club_goals"]),
        Q.mismatch("api_fixture_date_matches_kaggle_game_date", day_a, day_b, ["api_fixture_date", "date"]),
        Q.mismatch("api_season_matches_kaggle_season", to_number("api_season"), to_number("season"), ["api_season", "season"]),
        Q.mismatch("api_league_name_matches_kaggle_competition_mapping", normalize_text("api_league_name"), normalize_text("mapped_competition_name"),
                   ["api_league_name", "mapped_competition_name"]),
        Q.mismatch("api_league_country_matches_kaggle_competition_country", normalize_text("api_league_country"), normalize_text("mapped_competition_country"),
                   ["api_league_country", "mapped_competition_country"]),
    ], table, "accuracy", ["__row"])]

    def paired(name, a, b):
        return Q.predicate(name, [a, b], missing_mask(a) != missing_mask(b))

    parts.append(_checks(work, [
        paired("api_status_fields_are_populated_together", "api_status_short", "api_status_long"),
        paired("api_home_team_id_and_name_are_paired", "api_home_team_id", "api_home_team_name"),
        paired("api_away_team_id_and_name_are_paired", "api_away_team_id", "api_away_team_name")], table, "consistency", ["__row"]))
    one = work.agg(F.count_distinct("competition_id").alias("competitions"), F.count_distinct("api_league_name").alias("leagues"),
                   F.count_distinct(F.to_date("__at")).alias("unique_days"))
    parts.append(_checks(one, [Q.predicate("merged_slice_contains_one_competition", ["competitions"], F.col("competitions") != 1),
                               Q.predicate("merged_slice_contains_one_api_league", ["leagues"], F.col("leagues") != 1)], table, "consistency"))
    parts.append(_checks(work, [Q.predicate(f"{c}_present_and_populated", [c], missing_mask(c)) for c in MERGED_REQUIRED], table, "completeness", ["__row"]))
    parts.append(_matched(found["summary"], "all_api_fixtures_were_matched", "left", table))
    parts.append(_matched(found["summary"], "all_kaggle_games_were_matched", "right", table))

    columns = [c for c in merged.columns if not c.startswith("__")]
    natural = ["season", "match_date", "home_team_key", "away_team_key"]
    exact = merged.groupBy(*columns).agg(F.min("__row").alias("__keep")).select("__keep")
    marked = merged.join(exact, merged["__row"] == exact["__keep"], "left").withColumn("__later", F.col("__keep").isNull()).drop("__keep")
    for name, keys in (("__game", ["game_id"]), ("__fixture", ["api_fixture_id"]), ("__natural", natural)):
        marked = mark_all_copies(marked, keys, "__row", name)
    game, fixture = F.col("__game") & F.col("game_id").isNotNull(), F.col("__fixture") & F.col("api_fixture_id").isNotNull()
    parts.append(_checks(marked, [
        Q.predicate("merged_rows_are_not_exact_duplicates", ["game_id", "api_fixture_id"], F.col("__later")), Q.predicate("game_id_is_unique", ["game_id"], game),
        Q.predicate("api_fixture_id_is_unique", ["api_fixture_id"], fixture), Q.predicate("match_business_key_is_unique", natural, F.col("__natural"))],
        table, "uniqueness", ["__row"]))

    year, season = F.year("__at"), to_number("season")
    complete = F.coalesce("api_status_short", F.lit("")).isin(*FINISHED) & F.col("__at").isNotNull()
    parts.append(_checks(work, [
        Q.predicate("kaggle_game_dates_are_parseable", ["date"], F.col("__day").isNull()), Q.predicate("api_fixture_dates_are_parseable", ["api_fixture_date"], F.col("__at").isNull()),
        Q.mismatch("api_and_kaggle_dates_are_aligned", day_a, day_b, ["date", "api_fixture_date"]),
        Q.predicate("api_fixture_dates_fall_in_season_window", ["season", "api_fixture_date"], ~F.coalesce((year == season) | (year == season + 1), F.lit(False))),
        Q.predicate("completed_fixtures_are_not_future_dated", ["api_fixture_date", "api_status_short"], F.col("__at") > clock, applicable=complete),
    ], table, "timeliness", ["__row"]))
    parts.append(_checks(one, [Q.predicate("merged_sample_spans_multiple_match_days", ["unique_days"], F.col("unique_days") < 2)], table, "timeliness"))
    parts.append(_checks(work, _winner_rules("api_", "home_club_goals", "away_club_goals", "api_home_winner", "api_away_winner"), table, "relationships", ["__row"]))

    checks = materialize(_union(parts))
    rows = merged.drop("__row")
    numbers = [c for c in MERGED_NUMERIC if c in rows.columns]
    labels = [c for c in MERGED_CATEGORICAL if c in rows.columns]
    s, e = P.iqr_outliers(rows, numbers, row_id="game_id", label="home_club_name", table=table, k=10)
    categories = P.categorical_profile(rows, labels, table)
    return {**found, "merged": rows, "checks": checks.orderBy("dimension", "status", F.col("failed_pct").desc_nulls_last(), "check_name"),
            "check_summary": Q.summarize(checks), "report": _report(checks, s, categories, "api_status_short"), "field_missingness": Q.field_completeness(rows, table, MERGED_REQUIRED),
            "duplicate_rows": marked.where(F.col("__later") | game | fixture | F.col("__natural")).select(*columns),
            "outliers": s, "outlier_examples": e, "numeric_profiles": P.numeric_profile(rows, numbers, table), "categorical_profiles": categories}


def _matched(summary: DataFrame, name: str, side: str, table: str) -> DataFrame:
    from pitwise.plans.primary_report import _record
    counted = summary.select(F.col(f"{side}_rows").alias("applicable_rows"), F.col(f"{side}_unmatched_rows").alias("failed_rows"))
    return _record(counted, table, name, "completeness")
