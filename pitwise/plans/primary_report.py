"""Eight-dimension quality report over the raw transfer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pitwise.functions.scalars import age_at_season, pct, season_pair, short_year_to_full, stringify, stringify_1dp, to_number
from pitwise.operators import profile as P
from pitwise.operators import quality as Q
from pitwise.operators.joins import parent_consistency
from pitwise.operators.linkage import fuzzy_duplicates

Tables = Mapping[str, DataFrame]

# Columns that must be filled.
REQUIRED = {
    "competitions": ("competition_id", "name", "type"),
    "clubs": ("club_id", "name", "domestic_competition_id"),
    "games": ("game_id", "competition_id", "season", "date", "home_club_id", "away_club_id", "home_club_goals", "away_club_goals"),
    "players": ("player_id", "name", "last_season", "current_club_id", "date_of_birth", "position"),
    "appearances": ("appearance_id", "game_id", "player_id", "date", "minutes_played"),
    "club_games": ("game_id", "club_id", "opponent_id", "hosting", "is_win"),
    "game_events": ("game_event_id", "game_id", "date", "minute", "type"),
    "game_lineups": ("game_lineups_id", "game_id", "player_id", "date", "club_id", "player_name"),
    "player_valuations": ("player_id", "date", "market_value_in_eur"),
    "transfers": ("player_id", "transfer_date", "from_club_id", "to_club_id"),
}

# Columns that must be unique, columns that may be, and key combinations.
STRICT_UNIQUE = {
    "players": ("player_id", "url"), "clubs": ("club_id", "club_code", "url"), "competitions": ("competition_id", "url"), "games": ("game_id", "url"),
    "appearances": ("appearance_id",), "game_events": ("game_event_id",), "game_lineups": ("game_lineups_id",)}
MAYBE_UNIQUE = {"players": ("name", "player_code"), "clubs": ("name",), "competitions": ("name", "competition_code")}
UNIQUE_KEYS = {
    "player_valuations": ("player_id", "date"), "transfers": ("player_id", "transfer_date", "from_club_id", "to_club_id"),
    "club_games": ("game_id", "club_id"), "appearances": ("game_id", "player_id"), "game_lineups": ("game_id", "player_id", "club_id"),
    "games": ("competition_id", "season", "date", "home_club_id", "away_club_id")}
TIME_KEYS = {
    "games": ("competition_id", "season", "date", "home_club_id", "away_club_id"), "appearances": ("game_id", "player_id", "date"),
    "game_lineups": ("game_id", "player_id", "club_id", "date"), "player_valuations": ("player_id", "date"),
    "transfers": ("player_id", "transfer_date", "from_club_id", "to_club_id")}

# Date column per table, tables with a seasonal rhythm, and children of games.
TIME_COLUMNS = {"games": "date", "appearances": "date", "game_events": "date", "game_lineups": "date", "player_valuations": "date", "transfers": "transfer_date"}
SEASONAL = ("games", "appearances", "game_events", "game_lineups")
CHILDREN = ("appearances", "game_events", "game_lineups")

# Allowed ranges, both ends included, as (table, column, low, high, check name).
RANGES = (
    ("players", "age_at_last_season", 15, 50, "age_at_last_season_between_15_and_50"),
    ("players", "height_in_cm", 140, 230, "height_in_cm_between_140_and_230"),
    ("players", "market_value_in_eur", 0, None, "market_value_in_eur_non_negative"),
    ("players", "highest_market_value_in_eur", 0, None, "highest_market_value_in_eur_non_negative"),
    ("clubs", "squad_size", 1, None, "squad_size_greater_than_zero"),
    ("clubs", "average_age", 15, 45, "average_age_between_15_and_45"),
    ("clubs", "foreigners_percentage", 0, 100, "foreigners_percentage_between_0_and_100"),
    ("clubs", "stadium_seats", 1, None, "stadium_seats_greater_than_zero"),
    ("games", "home_club_goals", 0, None, "home_goals_non_negative"),
    ("games", "away_club_goals", 0, None, "away_goals_non_negative"),
    ("games", "attendance", 0, None, "attendance_non_negative"),
    ("appearances", "minutes_played", 0, 130, "minutes_played_between_0_and_130"),
    ("appearances", "goals", 0, None, "goals_non_negative"),
    ("appearances", "assists", 0, None, "assists_non_negative"),
    ("appearances", "yellow_cards", 0, 2, "yellow_cards_between_0_and_2"),
    ("appearances", "red_cards", 0, 1, "red_cards_between_0_and_1"),
    ("club_games", "own_goals", 0, None, "own_goals_non_negative"),
    ("club_games", "opponent_goals", 0, None, "opponent_goals_non_negative"),
    ("player_valuations", "market_value_in_eur", 0, None, "market_value_non_negative"),
    ("transfers", "transfer_fee", 0, None, "transfer_fee_non_negative"),
    ("transfers", "market_value_in_eur", 0, None, "market_value_non_negative"),
    ("game_events", "minute", 0, 130, "minute_between_0_and_130"),
    ("game_lineups", "shirt_number_numeric", 1, 99, "shirt_number_between_1_and_99"),
)
# Allowed sets.
SETS = (
    ("club_games", "hosting", ("Home", "Away"), "hosting_is_home_or_away"),
    ("club_games", "is_win", (0, 1), "is_win_is_binary"),
    ("game_lineups", "team_captain", (0, 1), "team_captain_is_binary"),
)
# Text layouts, a date layout or a regular expression.
FOUR_DIGITS, ONE_DECIMAL, SEASON = r"^\d{4}$", r"^\d{1,2}\.\d$", r"^\d{2}/\d{2}$"
LAYOUTS = (
    ("players", "date_of_birth", "%Y-%m-%d %H:%M:%S", "date_of_birth_uses_datetime_format"),
    ("players", "contract_expiration_date", "%Y-%m-%d %H:%M:%S", "contract_expiration_date_uses_datetime_format"),
    ("players", "last_season_text", FOUR_DIGITS, "last_season_uses_four_digit_year"),
    ("clubs", "last_season_text", FOUR_DIGITS, "last_season_uses_four_digit_year"),
    ("clubs", "average_age_text", ONE_DECIMAL, "average_age_uses_one_decimal_place"),
    ("games", "date", "%Y-%m-%d", "date_uses_iso_date_format"),
    ("games", "season_text", FOUR_DIGITS, "season_uses_four_digit_year"),
    ("appearances", "date", "%Y-%m-%d", "date_uses_iso_date_format"),
    ("game_events", "date", "%Y-%m-%d", "date_uses_iso_date_format"),
    ("game_lineups", "date", "%Y-%m-%d", "date_uses_iso_date_format"),
    ("player_valuations", "date", "%Y-%m-%d", "date_uses_iso_date_format"),
    ("transfers", "transfer_date", "%Y-%m-%d", "transfer_date_uses_iso_date_format"),
    ("transfers", "transfer_season", SEASON, "transfer_season_uses_nn_nn_format"),
)

# Profiled columns.
OUTLIERS = {
    "players": ("age_at_last_season", "height_in_cm", "market_value_in_eur", "highest_market_value_in_eur"),
    "clubs": ("squad_size", "average_age", "national_team_players", "stadium_seats"), "games": ("attendance",),
    "player_valuations": ("market_value_in_eur",), "transfers": ("market_value_in_eur",)}
NUMERIC = {
    "players": ("height_in_cm", "market_value_in_eur", "highest_market_value_in_eur"),
    "clubs": ("squad_size", "average_age", "foreigners_percentage", "national_team_players", "stadium_seats"),
    "games": ("home_club_goals", "away_club_goals", "home_club_position", "away_club_position", "attendance"),
    "appearances": ("minutes_played", "goals", "assists", "yellow_cards", "red_cards"),
    "club_games": ("own_goals", "opponent_goals", "own_position", "opponent_position"), "game_events": ("minute",),
    "player_valuations": ("market_value_in_eur",), "transfers": ("transfer_fee", "market_value_in_eur")}
CATEGORICAL = {
    "competitions": ("type", "sub_type", "confederation", "is_major_national_league"), "players": ("position", "sub_position", "foot"),
    "clubs": ("domestic_competition_id",), "games": ("competition_type", "home_club_formation", "away_club_formation"), "appearances": ("competition_id",),
    "club_games": ("hosting", "is_win"), "game_events": ("type",), "game_lineups": ("type", "position"),
    "player_valuations": ("player_club_domestic_competition_id",), "transfers": ("transfer_season",)}
CORRELATIONS = {
    "players": (("market_value_in_eur", "highest_market_value_in_eur"),),
    "clubs": (("foreigners_number", "foreigners_percentage"), ("squad_size", "national_team_players")),
    "games": (("home_club_goals", "home_club_position"), ("away_club_goals", "away_club_position"), ("attendance", "home_club_position")),
    "appearances": (("minutes_played", "goals"), ("minutes_played", "assists"), ("minutes_played", "yellow_cards")),
    "club_games": (("own_goals", "is_win"), ("opponent_goals", "is_win"), ("own_position", "is_win")),
    "transfers": (("transfer_fee", "market_value_in_eur"),)}
FOREIGNERS_TOLERANCE = 1.0


def derived(table: str, df: DataFrame) -> DataFrame:
    """Columns that the rules need beside the raw ones."""
    names = set(df.columns)
    if table == "players" and {"last_season", "date_of_birth"} <= names:
        df = df.withColumn("age_at_last_season", age_at_season("last_season", P.parse_or_date(df, "date_of_birth")))
    if table in ("players", "clubs") and "last_season" in names:
        df = df.withColumn("last_season_text", stringify("last_season"))
    if table == "clubs" and "average_age" in names:
        df = df.withColumn("average_age_text", stringify_1dp("average_age"))
    if table == "games" and "season" in names:
        df = df.withColumn("season_text", stringify("season"))
    if table == "game_lineups" and "number" in names:
        df = df.withColumn("shirt_number_numeric", to_number("number"))
    return df


class Filled(dict):
    """Tables with rows and their derived columns, looked at once for all dimensions."""


def _filled(tables: Tables) -> Filled:
    if isinstance(tables, Filled):
        return tables
    return Filled({n: derived(n, df) for n, df in sorted(tables.items()) if not df.isEmpty()})


def _any(tables: Tables) -> DataFrame:
    return next(iter(tables.values()))


def _finish(parts: list[DataFrame], dimension: str, tables: Tables) -> dict[str, DataFrame]:
    checks = Q.finalize(parts, dimension, _any(tables).sparkSession)
    return {"checks": checks, "summary": Q.summarize(checks)}


def accuracy(tables: Tables) -> dict[str, DataFrame]:
    parts = []
    for name, df in _filled(tables).items():
        rules = [Q.between(c, low, high, name=check) for t, c, low, high, check in RANGES if t == name]
        rules += [Q.in_set(c, values, name=check) for t, c, values, check in SETS if t == name]
        if rules:
            parts.append(Q.run_checks(df, rules, table=name, dimension="accuracy"))
    return _finish(parts, "accuracy", tables)


def consistency(tables: Tables) -> dict[str, DataFrame]:
    parts = []
    for name, df in _filled(tables).items():
        rules = [(Q.matches_layout if layout in Q.LAYOUTS else Q.matches_regex)(c, layout, name=check) for t, c, layout, check in LAYOUTS if t == name]
        if rules:
            parts.append(Q.run_checks(df, rules, table=name, dimension="consistency"))
    return _finish(parts, "consistency", tables)


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def completeness(tables: Tables, filled: Filled | None = None) -> dict[str, DataFrame]:
    filled = _filled(tables) if filled is None else filled
    whole = _union([Q.table_completeness(df, n) for n, df in sorted(tables.items())])
    fields = _union([Q.field_completeness(df, n, REQUIRED.get(n, ())) for n, df in sorted(tables.items())])
    required = Q.finalize([Q.run_checks(df, [Q.not_null(c) for c in REQUIRED[n]], table=n, dimension="completeness")
                           for n, df in filled.items() if n in REQUIRED], "completeness", _any(tables).sparkSession)
    return {
        "table_summary": whole.orderBy("size_status", F.col("missing_cells_pct").desc(), "table_name"),
        "field_completeness": fields.orderBy(F.col("missing_pct").desc(), "table_name", "column_name"),
        "required_field_checks": required, "required_field_issues": required.where("status <> 'passed'"),
        "missing_patterns": Q.missing_patterns(fields)}


def uniqueness(tables: Tables) -> dict[str, DataFrame]:
    spark = _any(tables).sparkSession
    unique_schema = "table_name string, column_name string, status string, duplicate_count long, duplicate_pct double"
    exact = _union([Q.exact_duplicates(df, n) for n, df in sorted(tables.items())])
    strict = _union([Q.unique_fields(df, n, STRICT_UNIQUE[n]) for n, df in sorted(tables.items()) if n in STRICT_UNIQUE])
    maybe = _union([Q.unique_fields(df, n, [c for c in MAYBE_UNIQUE[n] if c in df.columns], strict=False) for n, df in sorted(tables.items())
                    if n in MAYBE_UNIQUE and any(c in df.columns for c in MAYBE_UNIQUE[n])])
    subset = _union([Q.unique_key(df, n, UNIQUE_KEYS[n]) for n, df in sorted(tables.items()) if n in UNIQUE_KEYS])
    strict = strict if strict is not None else spark.createDataFrame([], unique_schema)
    maybe = maybe if maybe is not None else spark.createDataFrame([], unique_schema)
    subset = subset if subset is not None else spark.createDataFrame(
        [], "table_name string, key_fields string, status string, duplicate_count long, duplicate_groups long, duplicate_pct double")
    players = tables.get("players")
    if players is not None and {"player_id", "name", "date_of_birth"} <= set(players.columns):
        fuzzy, oversized = fuzzy_duplicates(players, block="date_of_birth", key="player_id", name="name")
    else:
        fuzzy = spark.createDataFrame([], "date_of_birth string, left_key long, left_name string, right_key long, right_name string, similarity double")
        oversized = spark.createDataFrame([], "date_of_birth string, members long")
    return {"summary": Q.uniqueness_summary(exact, strict, subset, fuzzy), "exact_duplicates": exact, "strict_unique_checks": strict,
            "candidate_field_reviews": maybe, "subset_duplicate_checks": subset, "fuzzy_duplicate_candidates": fuzzy.orderBy(F.col("similarity").desc(), "left_name"),
            "large_fuzzy_blocks": oversized}


def outliers(tables: Tables) -> dict[str, DataFrame]:
    summaries, examples = [], []
    for name, df in _filled(tables).items():
        columns = [c for c in OUTLIERS.get(name, ()) if c in df.columns]
        if columns:
            key = next((c for c in ("player_id", "club_id", "game_id") if c in df.columns), df.columns[0])
            label = next((c for c in ("name", "player_name", "home_club_name") if c in df.columns), None)
            s, e = P.iqr_outliers(df, columns, row_id=key, label=label, table=name, k=5)
            summaries.append(s)
            examples.append(e)
    return {"summary": _union(summaries), "examples": _union(examples)}


def timeliness(tables: Tables, today: str) -> dict[str, DataFrame]:
    """Dates, coverage, rhythm, parents, seasons and time keys; ``today`` bounds the future check."""
    limit = F.to_date(F.lit(today))
    filled = _filled(tables)
    parts, coverage, rhythm, volume = [], [], [], None
    for name, column in TIME_COLUMNS.items():
        df = filled.get(name)
        if df is None:
            continue
        if column not in df.columns:
            parts.append(Q.run_checks(df, [Q.predicate("time_column_exists", [column], F.lit(False))], table=name, dimension="timeliness"))
            continue
        parts.append(Q.run_checks(df, Q.timeliness_rules(column, limit, dict(df.dtypes)[column]), table=name, dimension="timeliness"))
        coverage.append(P.date_coverage(df, column, table=name))
        if name in SEASONAL:
            profile = P.monthly_profile(df, column, table=name)
            rhythm.append(profile)
            parts.append(Q.profile_verdicts(profile, table=name))
    games = filled.get("games")
    if games is not None and {"game_id", "date"} <= set(games.columns):
        parent = games.select("game_id", P.parse_or_date(games, "date").alias("__game_date"))
        for name in CHILDREN:
            df = filled.get(name)
            if df is None:
                continue
            if not {"game_id", "date"} <= set(df.columns):
                parts.append(Q.run_checks(df, [Q.predicate("date_matches_games_date", ["game_id", "date"], F.lit(False))], table=name, dimension="timeliness"))
                continue
            counted = parent_consistency(df.select("game_id", P.parse_or_date(df, "date").alias("__date")), parent, on={"game_id": "game_id"},
                                         child_col="__date", parent_col="__game_date")
            parts.append(_record(counted, name, "date_matches_games_date"))
        if "season" in games.columns:
            season, year = to_number("season"), F.year(P.parse_or_date(games, "date"))
            parts.append(Q.run_checks(games, [Q.predicate("season_matches_date_year", ["season", "date"], ~((year == season) | (year == season + 1)),
                                                          applicable=season.isNotNull() & year.isNotNull(), sample=("game_id", "season", "date"))],
                                      table="games", dimension="timeliness"))
            volume = P.season_volume(games.withColumn("season", season.cast("long")), "season")
            done = F.col("season") < F.lit(volume.agg(F.max("season")).scalar())
            parts.append(Q.run_checks(volume, [Q.predicate("season_volume_within_expected_range", ["volume_status"], F.col("volume_status") == "failed",
                                                           applicable=done, sample=("season", "row_count"))],
                                      table="games", dimension="timeliness", order_by=["season"]))
    moves = filled.get("transfers")
    if moves is not None and {"transfer_date", "transfer_season"} <= set(moves.columns):
        year, pair = F.year(P.parse_or_date(moves, "transfer_date")), season_pair("transfer_season")
        first, last = short_year_to_full(pair["start"]), short_year_to_full(pair["end"])
        known = year.isNotNull() & pair["start"].isNotNull()
        parts.append(Q.run_checks(moves, [Q.predicate("transfer_season_matches_transfer_date", ["transfer_date", "transfer_season"],
                                                      ~((year == first) | (year == last)), applicable=known)], table="transfers", dimension="timeliness"))
    for name, keys in TIME_KEYS.items():
        if name in filled:
            parts.append(Q.unique_key_check(filled[name], keys, table=name, dimension="timeliness", name="no_duplicate_time_keys"))
    out = _finish(parts, "timeliness", tables)
    patterns = _union(rhythm)
    out.update({"coverage": _union(coverage), "seasonal_patterns": patterns, "season_volume": volume,
                "unexpected_gaps": None if patterns is None else patterns.where("gap_status = 'failed'")})
    return out


def _record(counted: DataFrame, table: str, name: str, dimension: str = "timeliness") -> DataFrame:
    return counted.select(
        F.lit(dimension).alias("dimension"), F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.lit("").alias("description"),
        F.lit("predicate").alias("expectation_type"), F.when(F.col("failed_rows") == 0, "passed").otherwise("failed").alias("status"),
        "applicable_rows", "failed_rows", pct("failed_rows", "applicable_rows").alias("failed_pct"), F.lit("").alias("missing_columns"),
        F.lit("[]").alias("sample_unexpected_values"))


def distribution(tables: Tables) -> dict[str, DataFrame]:
    numeric, categorical = [], []
    for name, df in _filled(tables).items():
        numbers = [c for c in NUMERIC.get(name, ()) if c in df.columns]
        labels = [c for c in CATEGORICAL.get(name, ()) if c in df.columns]
        store = P.field_counts(df, numbers, labels)
        if numbers:
            shapes = P.histogram_json(P.histogram(df, numbers, store=store))
            numeric.append(P.numeric_profile(df, numbers, name, store).join(shapes, "column_name"))
        if labels:
            categorical.append(P.categorical_profile(df, labels, name, store=store))
    a, b = _union(numeric), _union(categorical)
    return {"numeric_profiles": a, "categorical_profiles": b, "summary": Q.profile_summary(a, b) if a is not None and b is not None else None}


def _numbers(*columns: str) -> tuple[list[Column], Column]:
    values = [to_number(c) for c in columns]
    known = values[0].isNotNull()
    for v in values[1:]:
        known = known & v.isNotNull()
    return values, known


def relationships(tables: Tables) -> dict[str, DataFrame]:
    pairs, parts = [], []
    filled = _filled(tables)
    for name, df in filled.items():
        chosen = [(a, b) for a, b in CORRELATIONS.get(name, ()) if {a, b} <= set(df.columns)]
        if chosen:
            pairs.append(P.correlation_pairs(df, chosen, table=name))
    clubs = filled.get("clubs")
    if clubs is not None and {"squad_size", "foreigners_number", "foreigners_percentage"} <= set(clubs.columns):
        (size, foreign, share), known = _numbers("squad_size", "foreigners_number", "foreigners_percentage")
        failed = F.abs(share - F.try_divide(foreign, size) * 100) > FOREIGNERS_TOLERANCE
        parts.append(Q.run_checks(clubs, [Q.predicate("foreigners_percentage_matches_counts", ["squad_size", "foreigners_number", "foreigners_percentage"], failed,
                                                      applicable=known & (size > 0))], table="clubs", dimension="relationships"))
    results = filled.get("club_games")
    if results is not None and {"own_goals", "opponent_goals", "is_win"} <= set(results.columns):
        (own, other, win), known = _numbers("own_goals", "opponent_goals", "is_win")
        parts.append(Q.run_checks(results, [Q.predicate("is_win_matches_scoreline", ["own_goals", "opponent_goals", "is_win"], win != (own > other).cast("double"),
                                                        applicable=known)], table="club_games", dimension="relationships"))
    players = filled.get("players")
    if players is not None and {"market_value_in_eur", "highest_market_value_in_eur"} <= set(players.columns):
        (now, peak), known = _numbers("market_value_in_eur", "highest_market_value_in_eur")
        parts.append(Q.run_checks(players, [Q.predicate("current_value_not_above_highest_value", ["market_value_in_eur", "highest_market_value_in_eur"], now > peak,
                                                        applicable=known)], table="players", dimension="relationships"))
    checks = Q.finalize(parts, "relationships", _any(tables).sparkSession)
    correlations = _union(pairs)
    strong = None if correlations is None else correlations.where(F.greatest(F.abs("pearson"), F.abs("spearman")) >= 0.6)
    return {"correlations": correlations, "strong_correlations": strong, "dependency_checks": checks,
            "summary": None if correlations is None else Q.relationship_summary(correlations, checks)}


def run_report(tables: Tables, today: str) -> dict[str, dict[str, DataFrame]]:
    """All eight dimensions; every value is a frame that is computed when it is read."""
    filled = _filled(tables)
    if not filled:
        raise ValueError("no table holds any rows")
    return {"accuracy": accuracy(filled), "consistency": consistency(filled), "completeness": completeness(tables, filled), "uniqueness": uniqueness(tables),
            "outliers": outliers(filled), "timeliness": timeliness(filled, today), "distribution": distribution(filled), "relationships": relationships(filled)}
