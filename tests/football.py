"""A small transfer world with planted cases, written as CSV tables and JSON feed files."""

import csv
import datetime as dt
import json
from pathlib import Path

LEAGUES = [("GB1", "Premier League", "England"), ("ES1", "LaLiga", "Spain"), ("IT1", "Serie A", "Italy"), ("L1", "Bundesliga", "Germany"),
           ("FR1", "Ligue 1", "France"), ("NL1", "Eredivisie", "Netherlands")]
CLUBS = [(1, "Wolves", "GB1"), (2, "Málaga Norte", "ES1"), (3, "Torino Verde", "IT1"), (4, "Rhein Stars", "L1"), (5, "Lille Bleu", "FR1"), (6, "Delta Boys", "NL1"),
         (7, "Nowhere", None)]
START = dt.date(2019, 1, 10)


def day(d):
    return d.isoformat() if d else ""


def build(root) -> tuple[str, str]:
    """Ten ordinary moves from club 6 into leagues 1-5; odd players succeed, even ones fail."""
    moves, values, games, results, played = [], [], [], [], []
    game = 0

    def match(when, home, away, goals, season):
        nonlocal game
        game += 1
        games.append([game, "GB1", season, day(when), home, away, goals[0], goals[1], dict((c[0], c[1]) for c in CLUBS)[home], dict((c[0], c[1]) for c in CLUBS)[away], 100 + game % 50])
        for me, other, mine, theirs, side in ((home, away, goals[0], goals[1], "Home"), (away, home, goals[1], goals[0], "Away")):
            results.append([game, me, other, mine, theirs, side, int(mine > theirs)])
        return game

    for i in range(10):
        player, when, to = 100 + i, START + dt.timedelta(days=60 * i), 1 + i % 5
        moves.append([player, day(when), "", 6, to, "Delta Boys", CLUBS[to - 1][1], 900_000, 1_400_000])
        values += [[player, day(when - dt.timedelta(days=400)), 800_000, 6, "NL1"], [player, day(when - dt.timedelta(days=200)), 1_000_000, 6, "NL1"],
                   [player, day(when), 1_500_000, 6, "NL1"], [player, day(when + dt.timedelta(days=300)), 2_000_000 if i % 2 else 1_000_000, to, CLUBS[to - 1][2]]]
        for n in range(4):      # before the move, one of them on the day itself
            g = match(when - dt.timedelta(days=100 * n), 6, to, (n, 1), 2018)
            played.append([f"{player}-b{n}", g, player, 6, day(when - dt.timedelta(days=100 * n)), 90, 1, 0])
        for n in range(25 if i % 2 else 5):
            g = match(when + dt.timedelta(days=7 * n + 1), to, 6, (2, 1), 2019)
            played.append([f"{player}-a{n}", g, player, to, day(when + dt.timedelta(days=7 * n + 1)), 80, 0, 1])
    # evidence after the window must not count for player 100
    late = START + dt.timedelta(days=760)
    values.append([100, day(late), 9_000_000, 1, "GB1"])
    for n in range(30):
        played.append([f"100-l{n}", match(late + dt.timedelta(days=n), 1, 2, (1, 0), 2021), 100, 1, day(late + dt.timedelta(days=n)), 90, 1, 1])
    moves += [[200, "2020-03-01", "19/20", 6, 1, "Delta Boys", "Wolves", 1, 5], [201, "2022-08-01", "22/23", 6, 1, "Delta Boys", "Wolves", 1, 5],
              [202, "2020-03-01", "19/20", 1, 6, "Wolves", "Delta Boys", 1, 5], [203, "", "19/20", 6, 1, "Delta Boys", "Wolves", 1, 5],
              [204, "2017-01-01", "16/17", 6, 7, "Delta Boys", "Nowhere", 1, 5], [205, "2022-06-01", "21/22", 6, 2, "Delta Boys", "Málaga Norte", 1, ""],
              list(moves[0])]
    values += [[200, "2020-01-01", 50, 6, "NL1"], [205, "2022-07-01", 60, 2, "ES1"], [999, "2023-06-30", 1, 1, "GB1"]]

    root = Path(root)
    raw, feed = root / "raw", root / "feed"
    for p in (raw, feed):
        p.mkdir(parents=True, exist_ok=True)

    def table(name, header, rows):
        with open(raw / f"{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([header.split(), *rows])

    table("competitions", "competition_id competition_code name type sub_type country_name confederation is_major_national_league url",
          [[c, n.lower().replace(" ", "-"), n, "domestic_league", "first_tier", land, "europa", "true", f"u/{c}"] for c, n, land in LEAGUES])
    table("clubs", "club_id club_code name domestic_competition_id squad_size average_age foreigners_number foreigners_percentage national_team_players stadium_seats last_season url",
          [[c, n.lower(), n, league or "", 20 + c, 25.5, 10, round(1000 / (20 + c), 1), c, 20000 + c, 2024, f"c/{c}"] for c, n, league in CLUBS])
    table("players", "player_id name date_of_birth position sub_position foot height_in_cm country_of_citizenship highest_market_value_in_eur market_value_in_eur last_season current_club_id player_code url",
          [[p, f"Player Number {p}", f"199{p % 3}-05-0{1 + p % 2} 00:00:00", "Attack", "Centre-Forward", "right", 180 + p % 5, "Brazil", 3_000_000, 1_000_000, 2022, 1, f"pl-{p}", f"p/{p}"]
           for p in [*range(100, 110), *range(200, 206)]])
    table("transfers", "player_id transfer_date transfer_season from_club_id to_club_id from_club_name to_club_name transfer_fee market_value_in_eur", moves)
    table("player_valuations", "player_id date market_value_in_eur current_club_id player_club_domestic_competition_id", values)
    table("games", "game_id competition_id season date home_club_id away_club_id home_club_goals away_club_goals home_club_name away_club_name attendance", games)
    table("club_games", "game_id club_id opponent_id own_goals opponent_goals hosting is_win", results)
    table("appearances", "appearance_id game_id player_id player_club_id date minutes_played goals assists", played)

    def item(n, season, home, away, goals, league=(39, "Premier League", "England"), date="2019-02-10"):
        won = None if goals[0] == goals[1] else goals[0] > goals[1]
        return {"fixture": {"id": n, "date": f"{date}T15:00:00+00:00", "timestamp": int(dt.datetime.fromisoformat(f"{date}T15:00:00+00:00").timestamp()),
                            "status": {"short": "FT", "long": "Match Finished", "elapsed": 90}},
                "league": {"id": league[0], "name": league[1], "country": league[2], "season": season},
                "teams": {"home": {"id": 1, "name": home, "winner": won}, "away": {"id": 2, "name": away, "winner": None if won is None else not won}},
                "goals": {"home": goals[0], "away": goals[1]}}

    def payload(items):
        return {"get": "fixtures", "parameters": {"league": "39", "season": "2018"}, "errors": [], "results": len(items), "paging": {"current": 1, "total": 1}, "response": items}

    old = [item(1, 2018, "Wolves", "Other", (0, 3))]
    new = [item(1, 2018, "Wolves", "Other", (2, 1)), item(2, 2018, "Other", "Wolves", (1, 1), date="2019-03-10")]
    (feed / "api_football_GB1_a.json").write_text(json.dumps(payload(old)))
    (feed / "api_football_GB1_b.json").write_text(json.dumps({"payload": payload(new), "status_code": 200}))
    (feed / "api_football_x_broken.json").write_text("{not json")
    (feed / "api_football_y_list.json").write_text("[1, 2]")
    (feed / "api_football_z_other.json").write_text(json.dumps(payload([item(9, 2018, "Málaga Norte", "X", (1, 0), league=(999, "ES1", "Spain")), item(10, 2018, "Delta Boys", "X", (1, 0), league=(88, "NL", "NL"))])))
    return str(raw), str(feed)
