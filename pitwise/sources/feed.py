"""Nested JSON feed: reading payload files, flattening, request metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pitwise.functions.scalars import col
from pitwise.sources.tables import list_files

# Nested layout of one feed element and of its wrapper.
TEAM = "struct<id: bigint, name: string, winner: boolean>"
ITEM = ("struct<fixture: struct<id: bigint, date: string, timestamp: bigint, status: struct<short: string, long: string, elapsed: bigint>>, "
        "league: struct<id: bigint, name: string, country: string, season: bigint>, "
        f"teams: struct<home: {TEAM}, away: {TEAM}>, goals: struct<home: bigint, away: bigint>>")
WRAPPER = f"get string, parameters string, errors string, results string, paging struct<current: bigint, total: bigint>, response array<{ITEM}>"
ENVELOPE = WRAPPER + f", payload struct<get: string, parameters: string, errors: string, results: string, paging: struct<current: bigint, total: bigint>, response: array<{ITEM}>>"

# Flat columns and where they come from.
FLAT_FIELDS = (
    ("fixture_id", "fixture.id"), ("fixture_date", "fixture.date"), ("fixture_timestamp", "fixture.timestamp"),
    ("status_short", "fixture.status.short"), ("status_long", "fixture.status.long"), ("status_elapsed", "fixture.status.elapsed"),
    ("league_id", "league.id"), ("league_name", "league.name"), ("league_country", "league.country"), ("season", "league.season"),
    ("home_team_id", "teams.home.id"), ("home_team_name", "teams.home.name"), ("home_winner", "teams.home.winner"),
    ("away_team_id", "teams.away.id"), ("away_team_name", "teams.away.name"), ("away_winner", "teams.away.winner"),
    ("home_goals", "goals.home"), ("away_goals", "goals.away"))


def feed_paths(spark: SparkSession, directory: str, pattern: str = "api_football*.json", fallback: str = "api_football") -> list[str]:
    """Payload files of a directory, or of its fallback sub-directory."""
    try:
        paths = list_files(spark, directory, pattern)
    except FileNotFoundError:
        paths = []
    if not paths:
        try:
            paths = list_files(spark, f"{directory.rstrip('/')}/{fallback}", pattern)
        except FileNotFoundError:
            paths = []
    if not paths:
        raise FileNotFoundError(f"no feed file matching {pattern} in {directory}")
    return paths


def read_feed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per readable payload with its file name; raw payloads and ``{"payload": …}`` envelopes.

    Unreadable files and files that do not hold an object are left out.
    """
    schema = ENVELOPE + ", _broken string"
    raw = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
           .json(paths).select("*", F.col("_metadata.file_name").alias("file_name")))
    names = ("get", "parameters", "errors", "results", "paging", "response")
    wrapped = F.col("payload").isNotNull()
    return raw.where(F.col("_broken").isNull()).select(
        "file_name", *[F.when(wrapped, F.col("payload")[n]).otherwise(F.col(n)).alias(n) for n in names])


def flatten_feed(payloads: DataFrame, *keep: str) -> DataFrame:
    """One row per feed element with 18 flat columns; a missing branch gives nulls.

    The outer form keeps Spark from adding a size filter below, which would parse JSON text twice.
    """
    items = payloads.select(*keep, F.explode_outer("response").alias("item")).where(F.col("item").isNotNull())
    return items.select(*keep, *[F.col(f"item.{path}").alias(name) for name, path in FLAT_FIELDS])


# -- loosely typed wrapper fields --------------------------------------------------------------

def normalize_errors(text) -> Column:
    """Errors given as an object, a list or a scalar: always an array of non-blank texts."""
    text = F.trim(col(text))
    as_map = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    as_list = F.from_json(text, T.ArrayType(T.StringType()))
    blank = ("", "[]", "{}")
    pairs = F.transform(F.filter(F.map_entries(as_map), lambda e: e["value"].isNotNull() & ~e["value"].isin(*blank)),
                        lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    items = F.filter(F.transform(as_list, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    none = F.array().cast("array<string>")
    return (F.when(text.isNull() | text.isin("", "null", "[]", "{}"), none).when(text.startswith("{"), F.coalesce(pairs, none))
            .when(text.startswith("["), F.coalesce(items, none)).otherwise(F.array(F.trim(F.regexp_replace(text, r'^"|"$', "")))))


def normalize_parameters(text) -> Column:
    """Parameters given as an object or a list of objects: always one string map, later keys win."""
    text = F.trim(col(text))
    kind = T.MapType(T.StringType(), T.StringType())
    merged = F.aggregate(F.from_json(text, T.ArrayType(kind)), F.create_map().cast(kind),
                         lambda acc, m: F.map_concat(F.map_filter(acc, lambda k, v: ~F.coalesce(F.map_contains_key(m, k), F.lit(False))),
                                                     F.coalesce(m, F.create_map().cast(kind))))
    empty = F.create_map().cast(kind)
    return F.when(text.startswith("{"), F.coalesce(F.from_json(text, kind), empty)).when(
        text.startswith("["), F.coalesce(merged, empty)).otherwise(empty)


def lower_keys(m) -> Column:
    return F.transform_keys(col(m), lambda k, v: F.lower(k))


def request_metadata(payloads: DataFrame, *, endpoint: str, source: str, status_code: int, elapsed_seconds: float, request_url: str,
                     request_params: str, headers: dict[str, str] | None = None) -> DataFrame:
    """One row per payload that describes the request and what came back."""
    h = {str(k).lower(): str(v) for k, v in (headers or {}).items()}
    count = F.coalesce(F.size("response"), F.lit(0))
    return payloads.select(
        F.lit(endpoint).alias("endpoint"), F.lit(source).alias("source"), F.col("file_name").alias("cache_path"),
        F.lit(status_code).alias("status_code"), F.lit(float(elapsed_seconds)).alias("elapsed_seconds"), F.lit(request_url).alias("request_url"),
        F.lit(request_params).alias("request_params"), F.to_json(normalize_parameters("parameters")).alias("echoed_parameters"),
        F.col("results").try_cast("long").alias("results"), count.alias("response_count"),
        F.col("paging.current").alias("paging_current"), F.col("paging.total").alias("paging_total"),
        F.lit(h.get("x-ratelimit-requests-remaining")).alias("daily_requests_remaining"),
        F.lit(h.get("x-ratelimit-remaining")).alias("minute_requests_remaining"), count.alias("fixture_rows"))


# -- team totals -------------------------------------------------------------------------------

def team_rows(flat: DataFrame, *keep: str) -> DataFrame:
    """Two rows per element, one per team, from one pass without a union."""
    def side(me: str, other: str):
        return F.struct(F.col(f"{me}_team_id").alias("team_id"), F.col(f"{me}_team_name").alias("team_name"), F.col(f"{me}_goals").alias("goals_for"),
                        F.col(f"{other}_goals").alias("goals_against"), F.coalesce(F.col(f"{me}_winner").cast("int"), F.lit(0)).alias("won"))
    return flat.select(*keep, F.inline(F.array(side("home", "away"), side("away", "home"))))
