"""Scalar and source operators that no query uses."""

import json
from datetime import date

from pyspark.sql import functions as F

from tallyframe.functions import clock, codes, dates, numbers, text
from tallyframe.operators import seasons, shots, upsert
from tallyframe.sources import game_books, raw_tree, result_sets
from tests.test_functions import values


def test_more_dates(spark):
    assert values(spark, dates.season_from_game_id_lenient(F.col("g")), [("0022300001",), ("00x",), (None,)], "g string") == ["2023-24", None, None]
    assert values(spark, dates.season_in_range(F.col("s"), F.lit(date(2024, 1, 1))), [("2023-24",), ("1945-46",), ("2035-36",), ("x",)], "s string") == [True, False, False, False]
    assert values(spark, dates.in_season(F.to_date("d"), F.lit("2023-24")), [("2023-08-01",), ("2024-08-01",)], "d string") == [True, False]
    rows = [("2024-01-01", "2024-01-02 03:00:00", None), (None, "2024-01-02 03:00:00", "America/Denver"), (None, "2024-01-02 03:00:00", None), (None, None, None)]
    got = values(spark, dates.date_with_source(F.to_date("l"), F.to_timestamp("u"), F.col("z")), rows, "l string, u string, z string")
    assert [(str(x.day), x.source) for x in got] == [("2024-01-01", "local"), ("2024-01-01", "local"), ("2024-01-02", "utc"), ("None", None)]
    got = values(spark, dates.resolve_game_date(F.col("c"), F.col("i"), F.lit(None).cast("string")), [("2024-01-05T00:00:00", "2024-01-02 03:00:00"), (None, "2024-01-02 03:00:00")], "c string, i string")
    assert [str(x) for x in got] == ["2024-01-05", "2024-01-01"]
    assert [str(x) for x in values(spark, dates.yesterday_eastern(F.to_timestamp("u")), [("2024-01-02 03:00:00",)], "u string")] == ["2023-12-31"]


def test_more_scalars(spark):
    assert [x and tuple(x) for x in values(spark, clock.split_clock(F.col("t")), [("2:30.5",), ("2:75",), ("x",)], "t string")] == [(2, 30.5), None, None]
    assert values(spark, codes.injury_status(F.col("t")), [("doubtful",), ("Out",), (None,)], "t string") == ["QUESTIONABLE", "OUT", "ACTIVE"]
    assert values(spark, numbers.money_or_percent(F.col("t")), [("$1,200",), ("5%",), ("x",)], "t string") == [1200.0, 5.0, None]
    assert values(spark, numbers.id_or_null(F.col("t")), [("12",), ("null",), ("",), ("x",)], "t string") == [12, None, None, None]
    assert values(spark, text.box_page_id_of_url(F.col("t")), [("http://x/boxscores/202401010BOS.html",), ("x",)], "t string") == ["202401010BOS", None]
    assert values(spark, text.tricode(F.col("t"), {"BKN": "BRK"}), [(" bkn ",), ("bos",), ("b0s",)], "t string") == ["BRK", "BOS", None]


def body(*sets):
    return json.dumps({"resultSets": [{"name": n, "headers": h, "rowSet": r} for n, h, r in sets]})


def test_more_result_sets(spark):
    df = lambda *b: spark.createDataFrame([(x,) for x in b], "body string")
    head = ("GameHeader", ["GAME_ID", "SEASON_TYPE"], [["a", 2], ["b", "Playoffs"], [None, 2]])
    assert result_sets.scoreboard(df(body(head))).count() == 2 and result_sets.scoreboard(df(body(head)), regular_only=True).count() == 1
    shot = ("Shot_Chart_Detail", ["GAME_ID", "GAME_EVENT_ID", "PLAYER_ID", "LOC_X", "SHOT_MADE_FLAG"], [["a", 1, 5, 7, 1], ["a", 1, 6, None, 0], ["a", 2, None, 1, 1], ["a", 3, 5, 1, 4]])
    got = result_sets.shots_by_event(result_sets.shots(df(body(shot)))).collect()
    assert [(r.GAME_EVENT_ID, r.PLAYER_ID, r.LOC_X, r.LOC_Y) for r in got] == [(1, 6, 0, 0)]
    players = ("PlayerStats", ["PLAYER_NAME", "START_POSITION"], [["A", "G"], ["B", ""], ["C", None]])
    assert [r.PLAYER_NAME for r in result_sets.starters(df(body(players))).collect()] == ["A"]
    usage = ("sqlPlayersUsage", ["GAME_ID", "PLAYER_ID", "USG_PCT"], [["a", 1, 0.25]])
    (r,) = result_sets.rates(df(body(usage)), "sqlPlayersUsage", result_sets.USAGE).collect()
    assert (r.player_id, r.usage_pct, r.pct_points) == ("1", 0.25, None)
    summary = ("GameSummary", ["GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID"], [["a", "2024-01-01", 1, 2], ["b", None, 1, 2]])
    assert [r.GAME_ID for r in result_sets.games(df(body(summary))).collect()] == ["a"]


def test_more_books_and_files(spark, tmp_path):
    short, long = "x", "Referee crew official Ann Able " * 40
    got = values(spark, game_books.text_confidence(F.col("t")), [(short,), (long,)], "t string")
    assert got[0] == 0 and 0.9 < got[1] <= 1.0
    parsed = spark.createDataFrame([("g", ["A B", "C D"])], "game_id string, alternates array<string>")
    assert game_books.alternate_rows(parsed).count() == 2
    people = spark.createDataFrame([("g", "A", 2), ("g", "A", 1)], "game_id string, name string, position int")
    assert [r.position for r in game_books.first_by_name(people).collect()] == [1]
    files = raw_tree.with_sha1(spark.createDataFrame([("2024-01-01", "g", "playbyplay", "{}")], "day string, game_id string, endpoint string, body string"))
    raw_tree.write(files, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().sha1 == files.first().sha1


def test_more_writes(spark):
    rows = spark.createDataFrame([("g", 1, 1, 2, 3, 4, 5)] * 2, "GAME_ID string, PLAYER_ID int, PERIOD int, MINUTES_REMAINING int, SECONDS_REMAINING int, LOC_X int, LOC_Y int")
    assert upsert.drop_duplicate_shots(rows).count() == 1
    one = spark.createDataFrame([(1, 2)], "k int, v int")
    assert {r._action: r.n_rows for r in upsert.action_counts(upsert.upsert(one, one, ["k"])).collect()} == {"unchanged": 1}


def test_more_seasons(spark):
    games = spark.createDataFrame([("g", "FINAL"), ("h", "LIVE")], "game_id string, status string")
    wanted = spark.createDataFrame([("g",), ("h",), ("i",)], "game_id string")
    assert {r.game_id for r in seasons.to_reprocess(wanted, games).collect()} == {"h", "i"} and seasons.to_reprocess(wanted, games, True).count() == 3
    stints = spark.createDataFrame([("g", "A", 1)] * 5 + [("g", "B", 1)] * 4, "game_id string, team_id string, period int")
    assert [r.team_id for r in shots.lineup_sizes(stints).collect()] == ["B"]
