"""Game operators on small scenarios with known results."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import sequence, shocks, teams, travel, windows

SCHEMA = "game_id string, period int, event_idx int, clock_ms_remaining long, seconds_elapsed double, event_type string, team_tricode string, shot_made boolean, shot_value int, description string, player1_name_slug string, player2_name_slug string, player3_name_slug string, is_transition boolean, is_early_clock boolean"


def event(idx, sec, kind, team, made=None, value=None, text=None, player=None, period=1, transition=False, early=False):
    length = 720 if period <= 4 else 300
    return ("g", period, idx, int((length - sec) * 1000), float(sec), kind, team, made, value, text, player, None, None, transition, early)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def metrics(spark, rows, **more):
    return windows.window_team_metrics(frame(spark, rows), **more).collect()


def test_shooting(spark):
    rows = [event(1, 10, "SHOT_MADE", "BOS", True, 2), event(2, 20, "SHOT_MISSED", "BOS", False, 3), event(3, 30, "SHOT_MADE", "LAL", True, 3), event(4, 40, "FREE_THROW_MADE", "LAL", True, 1)]
    (r,) = metrics(spark, rows)
    assert (r.home_team_tricode, r.home_efg_actual, r.away_efg_actual) == ("BOS", 0.5, 1.5)


def test_bonus_and_pace(spark):
    rows = [event(i, s, "FOUL", "LAL") for i, s in enumerate((60, 120, 150, 180, 220))] + [event(9, 230, "SHOT_MADE", "BOS", True, 2)]
    (r,) = metrics(spark, rows)
    assert (r.bonus_time_home_sec, r.bonus_time_away_sec) == (0.0, 60.0)
    rows = [event(1, 10, "SHOT_MADE", "BOS", True, 2), event(2, 20, "TURNOVER", "LAL"), event(3, 30, "REBOUND", "BOS", text="Defensive"), event(4, 40, "SHOT_MADE", "LAL", True, 2)]
    (r,) = metrics(spark, rows)
    assert (r.possessions_elapsed, r.pace48_actual) == (4, 48.0)


def test_rebounds(spark):
    kinds = [("BOS", "Offensive")] * 1 + [("BOS", "Defensive")] * 3 + [("LAL", "Offensive")] * 2 + [("LAL", "Defensive")] * 4
    (r,) = metrics(spark, [event(i, 5 * i + 1, "REBOUND", t, text=d) for i, (t, d) in enumerate(kinds)])
    assert (r.home_orb_pct, r.home_drb_pct, r.away_orb_pct) == (0.2, 0.6, 0.4) and r.away_drb_pct == pytest.approx(0.8)


def test_one_team_or_three_give_no_row(spark):
    assert metrics(spark, [event(1, 10, "SHOT_MADE", "BOS", True, 2)]) == []
    assert metrics(spark, [event(i, 10 + i, "SHOT_MADE", t, True, 2) for i, t in enumerate(("BOS", "LAL", "DEN"))]) == []
    assert metrics(spark, []) == []


def test_home_by_games(spark):
    rows = [event(1, 10, "SHOT_MADE", "BOS", True, 2), event(2, 20, "SHOT_MISSED", "LAL", False, 2)]
    games = spark.createDataFrame([("g", "LAL", "BOS")], "game_id string, home_team_tricode string, away_team_tricode string")
    (r,) = metrics(spark, rows, games=games)
    assert (r.home_team_tricode, r.home_efg_actual, r.away_efg_actual) == ("LAL", 0.0, 1.0)


def test_dedups(spark):
    e = event(1, 10, "FOUL", None)
    rows = [e, e[:2] + (2,) + e[3:], event(3, 20, "FOUL", "BOS"), e[:2] + (4,) + e[3:]]
    idx = lambda d: sorted(r.event_idx for r in d.collect())
    assert idx(sequence.dedup_consecutive(frame(spark, rows))) == [1, 3, 4]
    assert idx(sequence.dedup_first_seen(frame(spark, rows))) == [1, 3]


def test_two_fouls(spark):
    rows = [event(10, 300, "FOUL", "BOS", player="A"), event(15, 310, "SHOT_MADE", "LAL", True, 2), event(20, 330, "FOUL", "BOS", player="A"), event(21, 335, "SUBSTITUTION", "BOS", player="A"), event(30, 400, "FOUL", "BOS", player="B"), event(31, 410, "FOUL", "BOS", player="B")]
    (r,) = shocks.early_shocks(frame(spark, rows)).collect()
    assert (r.shock_type, r.event_idx_start, r.event_idx_end, r.notes, r.immediate_sub, r.poss_since_event, r.severity) == ("TWO_PF_EARLY", 10, 20, "2 PF in 330.0s", True, 0, "MEDIUM")


def test_technical_flagrant_and_injury(spark):
    rows = [event(1, 5, "TECHNICAL_FOUL", None), event(2, 6, "FOUL", "BOS", text="Flagrant 2 foul", player="A"), event(3, 7, "TURNOVER", "LAL", text="twisted ankle", player="C")]
    rows += [event(10 + i, 20 + i, "SHOT_MADE", "BOS", True, 2, player="A") for i in range(6)]
    got = {r.shock_type: r for r in shocks.early_shocks(frame(spark, rows)).collect()}
    assert set(got) == {"TECH", "FLAGRANT", "INJURY_LEAVE"}
    assert (got["TECH"].team_tricode, got["TECH"].player_slug) == ("UNK", "TEAM")
    assert (got["FLAGRANT"].notes, got["FLAGRANT"].severity) == ("Flagrant 2", "HIGH")
    assert (got["INJURY_LEAVE"].notes, got["INJURY_LEAVE"].event_idx_end) == ("Absent 6 possessions", None)


def lead_changes_of(rows):
    scores, leader, out = {}, None, {}
    for idx, team, points in rows:
        scores[team] = scores.get(team, 0) + points
        now = max(scores, key=scores.__getitem__)
        out[idx] = int(leader is not None and now != leader)
        leader = now
    return out


def test_lead_changes(spark):
    import random

    rng = random.Random(4)
    for _ in range(3):
        rows = [(i, rng.choice("ABC"), rng.choice((1, 2, 3))) for i in range(30)]
        e = spark.createDataFrame([("g", 1, i, t, p) for i, t, p in rows], "game_id string, period int, event_idx int, team_tricode string, points int")
        assert {r.event_idx: r.lead_change for r in windows.with_lead_changes(e).collect()} == lead_changes_of(rows)


def test_possession(spark):
    rows = [event(1, 1, "JUMP_BALL", "BOS"), event(2, 2, "SHOT_MADE", "BOS", True, 2), event(3, 3, "TURNOVER", "LAL"), event(4, 4, "REBOUND", "LAL", text="Defensive rebound"), event(5, 5, "REBOUND", "BOS", text="Offensive rebound"), event(6, 6, "FOUL", None)]
    got = sequence.track_possession(frame(spark, rows)).orderBy("event_idx").collect()
    assert [r.possession for r in got] == ["BOS", "LAL", "BOS", "LAL", "LAL", "LAL"]
    assert [r.possession_change for r in got] == [1, 0, 1, 1, 0, 0] and got[-1].possession_unknown == 1


VENUES = [("LAL", "America/Los_Angeles", 34.0430, -118.2675, 89.0), ("BOS", "America/New_York", 42.3662, -71.0621, 5.0), ("DEN", "America/Denver", 39.7487, -105.0077, 1609.0)]


def test_travel(spark):
    games = [("1", "LAL", "BOS", datetime(2024, 1, 1, 20)), ("2", "DEN", "LAL", datetime(2024, 1, 3, 20)), ("3", "DEN", "BOS", datetime(2024, 1, 4, 20)), ("4", "XXX", "BOS", datetime(2024, 1, 5, 20))]
    g = spark.createDataFrame(games, "game_id string, home_team_tricode string, away_team_tricode string, game_date_utc timestamp")
    v = spark.createDataFrame(VENUES, "team_id string, arena_tz string, lat double, lon double, altitude_m double")
    got = {(r.game_id, r.team_tricode): r for r in travel.schedule_travel(g, v).collect()}
    assert set(got) == {("2", "LAL"), ("3", "DEN"), ("3", "BOS")}
    r = got["2", "LAL"]
    assert (r.timezone_shift_hours, r.altitude_change_m, r.days_rest, r.is_back_to_back) == (1.0, 1520.0, 1, False)
    assert got["3", "DEN"].is_back_to_back and got["3", "DEN"].distance_km == 0
    dense = travel.with_rest(travel.team_schedule(g)).where("team_tricode = 'BOS' and game_id = '4'").first()
    assert dense.is_back_to_back and not dense.is_5_in_7


def test_team_figures(spark):
    games = spark.createDataFrame([("g", "BOS", "LAL", 48.0)], "game_id string, home_team_id string, away_team_id string, duration_minutes double")
    e = frame(spark, [event(1, 1, "SHOT_MADE", "BOS", True, 3), event(2, 2, "TURNOVER", "LAL"), event(3, 3, "FOUL", None)]).withColumn("team_id", F.col("team_tricode")).withColumn("rebound_type", F.lit(None).cast("string"))
    got = {r.team_id: r for r in teams.with_efficiency(teams.with_advanced(teams.team_game_stats(games, e))).collect()}
    assert (got["BOS"].points, got["BOS"].effective_fg_pct, got["BOS"].offensive_rating, got["BOS"].defensive_rating) == (3, 1.5, 300.0, 0.0)
    assert got["LAL"].personal_fouls == 1 and got["LAL"].net_z == pytest.approx(-got["BOS"].net_z)
