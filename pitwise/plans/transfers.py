"""Point-in-time modelling table for player transfers: cohort, features, feed context, label, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from pitwise.functions.scalars import age_at, map_values, match_flag, parse_date, safe_divide, same_flag, season_start_year, to_number
from pitwise.functions.text import normalize_text
from pitwise.operators import cohort as C
from pitwise.operators.timeline import LastValue, Totals, answers, attach, point_in_time
from pitwise.operators.joins import keep_last, lookup, role_lookup
from pitwise.session import materialize
from pitwise.sources import feed
from pitwise.sources.tables import require_tables, with_row_order, write_bundle

# Inputs, cohort window, leagues, label rule and look-back lengths.
REQUIRED_TABLES = ("transfers", "players", "player_valuations", "appearances", "games", "club_games", "clubs", "competitions")
START_DATE, END_DATE = "2018-07-01", "2022-06-30"
FOLLOW_UP_MONTHS, MINUTES_THRESHOLD = 24, 1800
LEAGUES = ("GB1", "ES1", "IT1", "L1", "FR1")
FEED_LEAGUE_IDS = {39: "GB1", 140: "ES1", 135: "IT1", 78: "L1", 61: "FR1"}
PLAYER_WINDOWS, CLUB_WINDOW = (180, 365), 365

# Column groups of the modelling table, in output order.
PLAYER_PROFILE = ("position", "sub_position", "foot", "height_in_cm", "country_of_citizenship")
CLUB_PROFILE = ("squad_size", "average_age", "foreigners_percentage", "national_team_players", "stadium_seats")
FORM_RATES = ("matches", "win_rate", "points_per_match", "goal_diff_per_match")
FEED_COLUMNS = ("matches", "win_rate", "goal_diff_per_match")
TARGET_METRICS = ("matches", "minutes", "goals", "assists")
ROLES = ("source", "destination")

# Names of the written outputs.
OUTPUT_NAMES = {
    "modeling_dataset": "transfer_modeling_dataset", "labeled_transfer_cohort": "transfer_labeled_cohort", "excluded_transfers": "transfer_excluded_audit",
    "label_eligibility_failures": "transfer_label_failures", "audit_summary": "transfer_modeling_summary"}


def output_columns() -> list[str]:
    """Leading columns of the modelling table."""
    out = ["transfer_key", "player_id", "player_full_name", "transfer_date", "transfer_season"]
    for r in ROLES:
        out += [f"{r}_club_id", f"{r}_club_name", f"{r}_competition_id", f"{r}_competition_name"]
    out += ["age_at_transfer", *PLAYER_PROFILE, "transfer_fee", "market_value_in_eur", "pre_transfer_market_value", "pre_transfer_market_value_source"]
    out += [f"market_value_{w}d_prior" for w in PLAYER_WINDOWS] + [f"market_value_change_{w}d" for w in PLAYER_WINDOWS]
    out += ["transfer_fee_to_market_value_ratio", "transfer_fee_minus_market_value"]
    for w in PLAYER_WINDOWS:
        out += [f"player_{m}_{w}d_pre" for m in (*TARGET_METRICS, "goals_per90", "assists_per90")]
    out += [f"{r}_{c}" for r in ROLES for c in CLUB_PROFILE]
    out += [f"{r}_{c}_{CLUB_WINDOW}d_pre" for r in ROLES for c in FORM_RATES]
    for r in ROLES:
        out += [f"{r}_api_cached_{c}" for c in FEED_COLUMNS] + [f"{r}_api_context_matched"]
    out += ["is_same_league_move", "is_same_country_move", "season_start_year"]
    out += [f"target_destination_{m}_24m" for m in TARGET_METRICS] + ["target_end_market_value", "target_market_value_delta_24m", "transfer_success"]
    return out


def _dated(df: DataFrame, column: str) -> DataFrame:
    kind = dict(df.dtypes)[column]
    return df.withColumn(column, parse_date(column) if kind == "string" else F.to_date(column))


def audit_transfers(transfers: DataFrame, clubs: DataFrame, *, start: str, end: str, leagues: Sequence[str], order_by: str) -> DataFrame:
    """Transfers with destination league, business key and all exclusion reasons."""
    t = _dated(transfers, "transfer_date").withColumnsRenamed({
        "from_club_id": "source_club_id", "to_club_id": "destination_club_id", "from_club_name": "source_club_name", "to_club_name": "destination_club_name"})
    t = lookup(t, clubs, on={"destination_club_id": "club_id"}, take={"domestic_competition_id": "destination_competition_id", "name": "destination_club_dataset_name"})
    t = t.withColumn("transfer_key", C.entity_date_key("player_id", "transfer_date", "source_club_id", "destination_club_id"))
    league = F.col("destination_competition_id")
    rules = C.window_rules("transfer_date", start, end, missing="missing_transfer_date", before="before_modeling_window", after="after_modeling_window") + [
        ("missing_destination_competition", league.isNull()), ("destination_not_big_five", ~league.isin(*leagues))]
    return C.audit(t, rules, duplicate_keys=["player_id", "transfer_date", "source_club_id", "destination_club_id"], order_by=order_by,
                   duplicate_reason="duplicate_transfer_business_key")


def enrich(included: DataFrame, players: DataFrame, clubs: DataFrame, competitions: DataFrame) -> DataFrame:
    """Player, club and league columns for both roles, age, season and same-place flags."""
    out = lookup(included, _dated(players, "date_of_birth"), on={"player_id": "player_id"}, take={
        "name": "player_full_name", "date_of_birth": "date_of_birth", **{c: c for c in PLAYER_PROFILE},
        "highest_market_value_in_eur": "highest_market_value_in_eur", "market_value_in_eur": "player_current_market_value"})
    out = role_lookup(out, clubs, key="club_id", roles={r: f"{r}_club_id" for r in ROLES}, take=CLUB_PROFILE)
    out = lookup(out, clubs, on={"source_club_id": "club_id"}, take={"name": "source_club_dataset_name", "domestic_competition_id": "source_competition_id"})
    places = competitions.select("competition_id", F.col("name").alias("competition_name"), "country_name")
    out = role_lookup(out, places, key="competition_id", roles={r: f"{r}_competition_id" for r in ROLES}, take=["competition_name", "country_name"])
    return out.withColumns({
        "age_at_transfer": age_at("transfer_date", "date_of_birth"), "season_start_year": season_start_year("transfer_season", "transfer_date"),
        "is_same_league_move": same_flag("source_competition_id", "destination_competition_id"),
        "is_same_country_move": same_flag("source_country_name", "destination_country_name")})


def _valuation_questions(order_by: str) -> list[LastValue]:
    """Value, club and league at the transfer, and the values some days earlier."""
    value, ties = F.col("market_value_in_eur"), [F.col(order_by)]
    at_transfer = {"__v_value": value, "pre_transfer_market_value_club_id": F.col("current_club_id"), "pre_transfer_market_value_league_id": F.col("player_club_domestic_competition_id")}
    return [LastValue("valuations", "day", at_transfer, ties, dated="pre_transfer_market_value_date"),
            *[LastValue("valuations", f"d{w}", {f"market_value_{w}d_prior": value}, ties, dated=f"market_value_{w}d_prior_date") for w in PLAYER_WINDOWS]]


def _valued(cohort: DataFrame) -> DataFrame:
    """Value at the transfer (the transfer's own where there is none before it), changes, and fee against value."""
    known, own, value = F.col("__v_value"), F.col("market_value_in_eur"), F.col("pre_transfer_market_value")
    out = cohort.withColumns({
        "pre_transfer_market_value": F.coalesce(known, own),
        "pre_transfer_market_value_source": F.when(known.isNull() & own.isNotNull(), "transfer_row_market_value").otherwise("valuation_history")}).drop("__v_value")
    return out.withColumns({
        **{f"market_value_change_{w}d": value - F.col(f"market_value_{w}d_prior") for w in PLAYER_WINDOWS},
        "transfer_fee_to_market_value_ratio": safe_divide("transfer_fee", "pre_transfer_market_value"), "transfer_fee_minus_market_value": F.col("transfer_fee") - value})


def _activity():
    """Per appearance: one match, and minutes, goals and assists with missing counted as nothing."""
    return {"matches": F.lit(1), "minutes": F.col("minutes_played"), "goals": F.col("goals"), "assists": F.col("assists")}


def _form_questions() -> list[Totals]:
    return [Totals("activity", f"d{w}", "before", {f"player_{m}_{w}d_pre": e for m, e in _activity().items()}) for w in PLAYER_WINDOWS]


def _rated(cohort: DataFrame) -> DataFrame:
    """Goals and assists per 90 minutes."""
    return cohort.withColumns({f"player_{m}_per90_{w}d_pre": safe_divide(F.col(f"player_{m}_{w}d_pre") * 90, f"player_minutes_{w}d_pre")
                               for w in PLAYER_WINDOWS for m in ("goals", "assists")})


def club_results(club_games: DataFrame, games: DataFrame) -> DataFrame:
    """One row per club and game with its date, win, draw, points and goal difference."""
    dated = lookup(club_games, _dated(games, "date"), on={"game_id": "game_id"}, take={"date": "date"})
    wins = F.coalesce(to_number("is_win"), F.lit(0.0))
    draws = F.coalesce((wins == 0) & (F.col("own_goals") == F.col("opponent_goals")), F.lit(False)).cast("double")
    diff = F.coalesce(to_number("own_goals"), F.lit(0.0)) - F.coalesce(to_number("opponent_goals"), F.lit(0.0))
    return dated.select("club_id", "date", wins.alias("wins"), draws.alias("draws"), (wins * 3 + draws).alias("points"), diff.alias("goal_diff"))


def add_club_form(cohort: DataFrame, results: DataFrame, *, points: DataFrame | None = None) -> DataFrame:
    """Form of both clubs over the year before the transfer day, from one timeline of clubs."""
    points = cohort if points is None else points
    metrics = {"__matches": F.lit(1), "__wins": F.col("wins"), "__points": F.col("points"), "__goal_diff": F.col("goal_diff")}
    asked = points.select(F.explode(F.array(*[f"{r}_club_id" for r in ROLES])).alias("club_id"), "transfer_date")
    form = answers(asked, by=["club_id"], on=["transfer_date"], instants={"year": F.date_sub("transfer_date", CLUB_WINDOW), "before": F.date_sub("transfer_date", 1)},
                   sources={"results": (results, F.col("date"))}, probes=[Totals("results", "year", "before", metrics)])
    for role in ROLES:
        cohort = attach(cohort, form, keys={f"{role}_club_id": "club_id", "transfer_date": "transfer_date"}, totals=list(metrics))
        end = f"_{CLUB_WINDOW}d_pre"
        cohort = cohort.withColumns({
            f"{role}_matches{end}": F.col("__matches"), f"{role}_win_rate{end}": safe_divide("__wins", "__matches"),
            f"{role}_points_per_match{end}": safe_divide("__points", "__matches"),
            f"{role}_goal_diff_per_match{end}": safe_divide("__goal_diff", "__matches")}).drop(*metrics)
    return cohort


def feed_context(payloads: DataFrame, leagues: Sequence[str]) -> DataFrame:
    """Team-season totals of the feed per league; a later file replaces an earlier one."""
    flat = feed.flatten_feed(payloads, "file_name")
    by_name = F.when(F.col("league_name").isin(*leagues), F.col("league_name"))
    flat = flat.withColumn("competition_id", map_values(F.col("league_id").cast("int"), FEED_LEAGUE_IDS, by_name)).where(F.col("competition_id").isin(*leagues))
    rows = feed.team_rows(flat, "file_name", "competition_id", "season").withColumn("team_key", normalize_text("team_name"))
    totals = rows.groupBy("competition_id", "season", "team_key", "file_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("won").alias("w"), F.coalesce(F.sum("goals_for"), F.lit(0)).alias("gf"), F.coalesce(F.sum("goals_against"), F.lit(0)).alias("ga"))
    totals = totals.where(F.col("season").isNotNull()).select(
        "competition_id", "season", "team_key", F.col("n").alias("api_cached_matches"), safe_divide("w", "n").alias("api_cached_win_rate"),
        safe_divide(F.col("gf") - F.col("ga"), "n").alias("api_cached_goal_diff_per_match"), F.col("file_name").alias("api_cache_file"))
    return keep_last(totals, ["competition_id", "season", "team_key"], ["api_cache_file"])


def add_feed_context(cohort: DataFrame, context: DataFrame) -> DataFrame:
    values = [c for c in context.columns if c.startswith("api_")]
    for role in ROLES:
        keyed = cohort.withColumn("__team", normalize_text(f"{role}_club_name"))
        cohort = lookup(keyed, context, on={"__team": "team_key", "season_start_year": "season", f"{role}_competition_id": "competition_id"},
                        take={c: f"{role}_{c}" for c in values}).drop("__team")
    return cohort


def add_player_history(cohort: DataFrame, appearances: DataFrame, valuations: DataFrame, *, months: int, minutes: int, order_by: str,
                       points: DataFrame | None = None) -> DataFrame:
    """Values, form and follow-up label of each transfer's player, all from one timeline of players.

    Success: enough minutes at the destination and an end value not below the value at the transfer.
    """
    history = _dated(valuations, "date").select("player_id", "date", "market_value_in_eur", "current_club_id", "player_club_domestic_competition_id", order_by)
    activity = _dated(appearances, "date").withColumnRenamed("player_club_id", "destination_club_id")
    judged = C.FollowUp(
        entity="player_id", place="destination_club_id", date="transfer_date", activity=activity, activity_on="date", metrics=_activity(), threshold_metric="minutes",
        threshold=minutes, valuations=history, value_on="date", value="market_value_in_eur", baseline="pre_transfer_market_value", months=months, value_ties=[order_by])
    instants = {**judged.instants(), "day": F.col("transfer_date"), **{f"d{w}": F.date_sub("transfer_date", w) for w in PLAYER_WINDOWS}}
    answered = point_in_time(cohort, by=["player_id"], within=["destination_club_id"], on=["transfer_date"], instants=instants, sources=judged.sources(),
                             probes=[*judged.probes(), *_valuation_questions(order_by), *_form_questions()], points=points)
    out = judged.judge(_rated(_valued(answered)), {
        "baseline": "missing_pre_transfer_market_value", "end": "missing_follow_up_market_value", "inside": "no_market_value_inside_follow_up_window"})
    return out.withColumnsRenamed({
        "target_end_value": "target_end_market_value", "target_end_value_date": "target_end_market_value_date",
        "target_value_delta": "target_market_value_delta_24m", "success": "transfer_success", **{f"target_{m}": f"target_destination_{m}_24m" for m in TARGET_METRICS}})


def finalize(labelled: DataFrame, order_by: str) -> DataFrame:
    """Eligible rows, feed match flags, fixed column order, sorted by date."""
    rows = labelled.where("target_is_eligible").withColumns({f"{r}_api_context_matched": match_flag(f"{r}_api_cached_matches") for r in ROLES})
    first = [c for c in output_columns() if c in rows.columns]
    return rows.select(*first, *[c for c in rows.columns if c not in first]).orderBy("transfer_date", order_by)


def build_modeling_dataset(
    tables: Mapping[str, DataFrame],
    payloads: DataFrame,
    *,
    start: str = START_DATE,
    end: str = END_DATE,
    months: int = FOLLOW_UP_MONTHS,
    leagues: Sequence[str] = LEAGUES,
    minutes: int = MINUTES_THRESHOLD,
    order_by: str | None = None,
    output_dir: str | None = None,
) -> dict[str, DataFrame]:
    """The five outputs: modelling table, labelled cohort, excluded transfers, label failures, audit summary.

    ``order_by`` names a unique position column of ``transfers`` and ``player_valuations``; without it, file
    positions are fixed once in a checkpoint. The labelled cohort is checkpointed: every output reads it.
    """
    require_tables(tables, REQUIRED_TABLES)
    transfers, valuations = tables["transfers"], tables["player_valuations"]
    if order_by is None:
        order_by = "row_order"
        transfers, valuations = materialize(with_row_order(transfers)), materialize(with_row_order(valuations))
    audited = materialize(audit_transfers(transfers, tables["clubs"], start=start, end=end, leagues=leagues, order_by=order_by))
    points = C.included(audited)
    cohort = enrich(points, tables["players"], tables["clubs"], tables["competitions"])
    cohort = add_player_history(cohort, tables["appearances"], valuations, months=months, minutes=minutes, order_by=order_by, points=points)
    cohort = add_club_form(cohort, club_results(tables["club_games"], tables["games"]), points=points)
    context = materialize(feed_context(payloads, leagues))
    if context.isEmpty():
        raise ValueError("the feed holds no usable rows")
    cohort = add_feed_context(cohort, context)
    labelled = materialize(cohort)

    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.count("source_api_cached_matches").alias("s"), F.count("destination_api_cached_matches").alias("d"),
                          F.count_if(F.col("target_is_eligible")).alias("eligible"),
                          F.round(F.avg(F.when(F.col("target_is_eligible"), F.col("transfer_success"))), 4).alias("rate")).first()
    if counts["n"] and not counts["s"] and not counts["d"]:
        raise ValueError("the feed does not match the cohort by league, season and team name")
    sizes = audited.agg(F.count(F.lit(1)).alias("n"), F.count("exclusion_reason").alias("x")).first()
    summary = [("raw_transfers", sizes["n"]), ("candidate_transfers", counts["n"]), ("modeling_rows", counts["eligible"]), ("excluded_rows", sizes["x"]),
               ("label_ineligible_rows", counts["n"] - counts["eligible"]), ("positive_class_rate", counts["rate"]), ("start_date", start), ("end_date", end),
               ("follow_up_months", months), ("minutes_threshold", minutes), ("big_five_leagues", ",".join(leagues))]
    outputs = {
        "modeling_dataset": finalize(labelled, order_by), "labeled_transfer_cohort": labelled, "excluded_transfers": C.excluded(audited),
        "label_eligibility_failures": labelled.where("not target_is_eligible"),
        "audit_summary": audited.sparkSession.createDataFrame([(k, None if v is None else str(v)) for k, v in summary], "metric string, value string")}
    if output_dir is not None:
        write_bundle(outputs, output_dir, OUTPUT_NAMES)
    return outputs


# -- three-year labels -------------------------------------------------------------------------

# Minimum goals and assists per position and sub-position.
POSITION_LIMITS = (("Attack", 6, 2), ("Goalkeeper", 0, 2), ("Defender", 0, 2), ("Midfield", 0, 6), ("Missing", 0, 0))
SUB_POSITION_LIMITS = (
    ("Centre-Forward", 0, 4), ("Goalkeeper", 0, 2), ("Centre-Back", 0, 4), ("Left-Back", 0, 4), ("Attacking Midfield", 2, 3), ("Central Midfield", 0, 4),
    ("Defensive Midfield", 0, 2), ("Left Midfield", 0, 3), ("Left Winger", 1, 3), ("Right-Back", 0, 4), ("Second Striker", 3, 2), ("Right Winger", 1, 3),
    ("Right Midfield", 0, 4))


def three_year_labels(tables: Mapping[str, DataFrame], *, weighted: bool = True) -> DataFrame:
    """Vote on minutes, assists and goals against position limits, and value growth, within three years.

    The weighted vote counts 3 for minutes and value and 1 for the rest, 5 points are a success, and two
    same-day moves of a player share their statistics. The plain vote needs 3 of 6 at the own club.
    """
    spark = tables["transfers"].sparkSession
    moves = _dated(tables["transfers"], "transfer_date")
    work = moves.withColumnRenamed("market_value_in_eur", "__own")
    stats = C.window_scores(
        work, _dated(tables["appearances"], "date"), _dated(tables["player_valuations"], "date"), entity="player_id", place="to_club_id", date="transfer_date",
        activity_on="date", activity_place="player_club_id", sums={"minutes": F.col("minutes_played"), "goals": F.col("goals"), "assists": F.col("assists")},
        value_on="date", value_place="current_club_id", value="market_value_in_eur", pool_places=weighted)
    out = lookup(stats, tables["players"], on={"player_id": "player_id"}, take={"position": "position", "sub_position": "sub_position"})
    for name, limits in (("position", POSITION_LIMITS), ("sub_position", SUB_POSITION_LIMITS)):
        table = spark.createDataFrame(limits, "k string, g int, a int")
        out = lookup(out, table, on={name: "k"}, take={"g": f"__{name}_goals", "a": f"__{name}_assists"})
    heavy, need = (3, 5) if weighted else (1, 3)
    criteria = [(F.col("minutes") >= MINUTES_THRESHOLD, heavy)]
    for name in ("position", "sub_position"):
        criteria += [(F.col("assists") >= F.col(f"__{name}_assists"), 1), (F.col("goals") >= F.col(f"__{name}_goals"), 1)]
    criteria.append((F.col("new_value") > F.col("__own"), heavy))
    out = C.score_label(out, criteria, need, name="transfer_success")
    return out.drop(*[f"__{n}_{m}" for n in ("position", "sub_position") for m in ("goals", "assists")]).withColumnRenamed("__own", "market_value_in_eur")


# File names of the two kinds of labels.
LABEL_NAMES = {"weighted": "labeled_transfers.csv", "plain": "transfers_labeled.csv"}


def label_job(tables: Mapping[str, DataFrame], output_dir: str, *, fmt: str = "csv") -> dict[str, str]:
    """Write the weighted and the plain three-year labels and return their paths."""
    bundle = {kind: three_year_labels(tables, weighted=kind == "weighted") for kind in LABEL_NAMES}
    return write_bundle(bundle, output_dir, LABEL_NAMES, fmt=fmt)
