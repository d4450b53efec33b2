"""Nested feed: parsing, flattening and team totals, over feed elements derived from shipments and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise.functions.scalars import map_values, safe_divide
from pitwise.functions.text import normalize_text
from pitwise.operators.joins import keep_last
from pitwise.queries import query, read
from pitwise.session import spread
from pitwise.sources import feed


def payloads(spark, sf):
    """One JSON payload per shipment: supplier plays customer nation, quantities are goals."""
    lines = spread(read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"))
    goals_home, goals_away = F.col("l_linenumber").cast("long"), (F.col("l_quantity") % 7).cast("long")
    item = F.struct(
        F.struct(F.col("l_orderkey").alias("id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                 F.struct(F.when(F.col("l_linestatus") == "F", "FT").otherwise("NS").alias("short")).alias("status")).alias("fixture"),
        F.struct((F.col("l_suppkey") % 4).alias("id"), F.concat(F.lit("League "), (F.col("l_suppkey") % 6).cast("string")).alias("name"),
                 F.year("l_shipdate").alias("season")).alias("league"),
        F.when(F.col("l_returnflag") != "R", F.struct(
            F.struct(F.col("l_suppkey").alias("id"), F.concat(F.lit("Club "), F.col("l_suppkey").cast("string")).alias("name"), (goals_home > goals_away).alias("winner")).alias("home"),
            F.struct(F.col("l_partkey").alias("id"), F.concat(F.lit("Club "), (F.col("l_partkey") % 100).cast("string")).alias("name"), (goals_home < goals_away).alias("winner")).alias("away"))).alias("teams"),
        F.struct(goals_home.alias("home"), goals_away.alias("away")).alias("goals"))
    text = F.to_json(F.struct(F.lit("fixtures").alias("get"), F.lit(1).alias("results"), F.array(item).alias("response")))
    parsed = F.from_json(text, feed.WRAPPER)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", parsed.alias("p")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "p.response")


FLAT_SQL = """
SELECT l_orderkey AS fixture_id, strftime(l_shipdate, '%Y-%m-%d') AS fixture_date, CASE l_linestatus WHEN 'F' THEN 'FT' ELSE 'NS' END AS status_short,
  l_suppkey % 4 AS league_id, 'League ' || (l_suppkey % 6) AS league_name, year(l_shipdate) AS season, l_returnflag,
  CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS home_team_id, CASE WHEN l_returnflag <> 'R' THEN 'Club ' || l_suppkey END AS home_team_name,
  CASE WHEN l_returnflag <> 'R' THEN l_linenumber > CAST(floor(l_quantity % 7) AS BIGINT) END AS home_winner,
  CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS away_team_id, CASE WHEN l_returnflag <> 'R' THEN 'Club ' || (l_partkey % 100) END AS away_team_name,
  CASE WHEN l_returnflag <> 'R' THEN l_linenumber < CAST(floor(l_quantity % 7) AS BIGINT) END AS away_winner,
  CAST(l_linenumber AS BIGINT) AS home_goals, CAST(floor(l_quantity % 7) AS BIGINT) AS away_goals FROM lineitem"""


@query("json_flatten", f"SELECT * EXCLUDE (l_returnflag), CAST(home_winner AS INTEGER) AS home_won, CAST(away_winner AS INTEGER) AS away_won FROM ({FLAT_SQL})".replace(
    "EXCLUDE (l_returnflag)", "EXCLUDE (l_returnflag, home_winner, away_winner)"))
def json_flatten(spark, sf):
    """Nested payload text parsed and flattened; a missing branch gives nulls."""
    flat = feed.flatten_feed(payloads(spark, sf))
    return flat.select("fixture_id", "fixture_date", "status_short", "league_id", "league_name", "season", "home_team_id", "home_team_name",
                       "away_team_id", "away_team_name", "home_goals", "away_goals", F.col("home_winner").cast("int").alias("home_won"),
                       F.col("away_winner").cast("int").alias("away_won"))


@query("feed_team_totals", f"""
WITH f AS (SELECT *, CASE league_id WHEN 0 THEN 'A1' WHEN 1 THEN 'B1' WHEN 2 THEN 'C1' ELSE CASE WHEN league_name IN ('League 1', 'League 3') THEN league_name END END AS comp FROM ({FLAT_SQL})),
t AS (SELECT l_returnflag AS file, comp, season, home_team_name AS team, home_goals AS gf, away_goals AS ga, COALESCE(CAST(home_winner AS INTEGER), 0) AS won FROM f WHERE comp IS NOT NULL
  UNION ALL SELECT l_returnflag, comp, season, away_team_name, away_goals, home_goals, COALESCE(CAST(away_winner AS INTEGER), 0) FROM f WHERE comp IS NOT NULL),
a AS (SELECT file, comp, season, COALESCE(lower(team), '') AS team_key, COUNT(*) AS m, SUM(won) AS w, SUM(gf) AS gf, SUM(ga) AS ga FROM t GROUP BY ALL),
l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY comp, season, team_key ORDER BY file DESC) = 1)
SELECT comp, season, team_key, m AS matches, CAST(w AS BIGINT) AS wins, CAST(gf AS BIGINT) AS goals_for, CAST(ga AS BIGINT) AS goals_against,
  ROUND(CAST(w AS DOUBLE) / m, 4) AS win_rate, ROUND(CAST(gf - ga AS DOUBLE) / m, 4) AS goal_diff_per_match, file FROM l""")
def feed_team_totals(spark, sf):
    """Team-season totals per file; a later file replaces an earlier one."""
    flat = feed.flatten_feed(payloads(spark, sf), "l_returnflag").withColumn("comp", map_values(
        "league_id", {0: "A1", 1: "B1", 2: "C1"}, F.when(F.col("league_name").isin("League 1", "League 3"), F.col("league_name"))))
    totals = team_totals(flat.where("comp is not null"), "l_returnflag")
    return keep_last(totals, ["comp", "season", "team_key"], ["file"]).select(
        "comp", "season", "team_key", "matches", "wins", "goals_for", "goals_against", "win_rate", "goal_diff_per_match", "file")


def team_totals(flat, file: str):
    rows = feed.team_rows(flat, F.col(file).alias("file"), "comp", "season").withColumn("team_key", normalize_text("team_name"))
    out = rows.groupBy("file", "comp", "season", "team_key").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("won").alias("wins"), F.sum("goals_for").alias("goals_for"), F.sum("goals_against").alias("goals_against"))
    return out.withColumns({"win_rate": F.round(safe_divide("wins", "matches"), 4),
                            "goal_diff_per_match": F.round(safe_divide(F.col("goals_for") - F.col("goals_against"), "matches"), 4)})


@query("json_properties", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'k: ' || json_extract_string(props, '$.k') AS error_text,
  upper(event_type) || '=' || json_extract_string(props, '$.k') AS parameter FROM events""")
def json_properties(spark, sf):
    """Loosely typed JSON objects as maps and as error lists."""
    t = read(spark, sf, "events")
    params = feed.normalize_parameters("props")
    return t.select("event_id", F.element_at(feed.lower_keys(params), "k").cast("long").alias("k"),
                    F.element_at(feed.normalize_errors("props"), 1).alias("error_text"),
                    F.concat_ws("=", F.upper("event_type"), F.element_at(params, "k")).alias("parameter"))


@query("error_forms", """
WITH e AS (SELECT event_id, event_id % 5 AS form, event_type, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, CASE form WHEN 0 THEN 'k: ' || k WHEN 1 THEN event_type || '; e' || event_id WHEN 2 THEN event_type ELSE '' END AS errors,
  CAST(CASE form WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS INTEGER) AS n_errors,
  CASE form WHEN 0 THEN k WHEN 1 THEN event_type END AS k, CAST(CASE form WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS n_parameters FROM e""")
def error_forms(spark, sf):
    """Errors and parameters as an object, a list, a scalar, empty and missing, made from the events."""
    form, kind = F.col("event_id") % 5, F.col("event_type")
    quote = F.lit('"')
    listed = F.concat(F.lit('["'), kind, F.lit('", " ", null, "e'), F.col("event_id").cast("string"), F.lit('"]'))
    merged = F.concat(F.lit('[{"a": "1", "k": "old"}, {"k": "'), kind, F.lit('"}]'))
    t = read(spark, sf, "events").select(
        "event_id", F.when(form == 0, F.col("props")).when(form == 1, listed).when(form == 2, F.concat(quote, kind, quote)).when(form == 3, "[]").alias("errors"),
        F.when(form == 0, F.col("props")).when(form == 1, merged).when(form == 2, F.concat(quote, kind, quote)).when(form == 3, "{}").alias("parameters"))
    errors, params = feed.normalize_errors("errors"), feed.normalize_parameters("parameters")
    return t.select("event_id", F.array_join(errors, "; ").alias("errors"), F.size(errors).alias("n_errors"),
                    F.try_element_at(params, F.lit("k")).alias("k"), F.size(params).alias("n_parameters"))
