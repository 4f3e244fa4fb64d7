"""Odd rows of sources by kind: shapes of plays, injuries, starters, games of pages, ids, words of codes, matchups, reports."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import codes, text
from tallyframe.operators import crosswalk, manifest
from tallyframe.sinks import partitioned
from tallyframe.sources import result_sets, silver


def values(spark, column, rows, schema):
    return [r.x for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


def test_loose_plays(spark):
    head = ["EVENTNUM", "PERIOD", "PCTIMESTRING"]
    one = lambda key, name, rows: json.dumps({key: [{"name": name, "headers": head, "rowSet": rows}]})
    bodies = [one("resultSets", "PlayByPlay", [[1, 1, "11:00"], [2, 1], [None, 1, "x"], [3, None, "x"]]), one("ResultSets", "XPlayByPlayY", [[4, 2, None]]), json.dumps([{"EVENTNUM": 5}, {"PERIOD": 1}]), "[]", "[1", "{}", "", None, one("resultSets", "Other", [[9, 9, "x"]])]
    got = result_sets.loose_plays(spark.createDataFrame([(f"g{k}", b) for k, b in enumerate(bodies)], "game_id string, body string"))
    assert sorted((r.game_id, r.EVENTNUM, r.PERIOD) for r in got.collect()) == [("g0", 1, 1), ("g1", 4, 2), ("g2", 5, None)]


def test_people(spark):
    people = "array<struct<name:string,status:string,injury:string,player_id:long>>"
    rows = silver.injuries(spark.createDataFrame([("g", "bos", [("Ann Able", None, "", 7), (None, "day_to_day", "knee", None)]), ("h", None, []), ("i", "x", None)], f"game_id string, team_tricode string, people {people}"), "reports").collect()
    assert [(r.team_tricode, r.player_display_name, r.player_id, r.status, r.reason) for r in rows] == [("BOS", "Ann Able", "7", "ACTIVE", None), ("BOS", "", None, "QUESTIONABLE", "knee")]
    stats = spark.createDataFrame([("g", "BOS", "Ann Able", 1, "forward"), ("g", "BOS", None, None, None), ("g", "BOS", "Bob Baker", 2, "sf")], "game_id string, team_tricode string, PLAYER_NAME string, PLAYER_ID long, START_POSITION string")
    assert [(r.player_display_name, r.position) for r in silver.starters(stats, "stats").collect()] == [("Ann Able", "F"), ("", None), ("Bob Baker", "SF")]
    for make in (silver.injuries, silver.starters):
        with pytest.raises(ValueError):
            make(stats.withColumn("people", F.array(F.struct(F.lit(1).alias("name")))), "nowhere")


def test_page_games(spark):
    at, day = datetime.datetime(2024, 1, 2, 3, 0), lambda d: datetime.date(2024, 1, d)
    rows = [("a", "2023-24", at, None, None, " bos", "lal ", "p"), ("b", "2023", at, day(1), None, "x", "y", "p"), ("c", "2023-24", at, day(3), "America/New_York", "x", "y", "p"), ("d", "2023-24", at, day(2), None, "x", "y", "p"), ("e", "2023-24", None, None, None, None, None, None)]
    good, bad = silver.page_games(spark.createDataFrame(rows, "game_id string, season string, game_date_utc timestamp, game_date_local date, arena_tz string, home_team string, away_team string, page_id string"))
    assert {r.game_id: (r.game_date_local, r.odds_join_key, r.home_team_tricode) for r in good.collect()} == {"a": (day(1), "20240101", "BOS"), "d": (day(2), "20240102", "X"), "e": (None, None, None)}
    assert {r.game_id: r.problem for r in bad.collect()} == {"b": "season", "c": "date"}


def test_ids(spark):
    urls = spark.createDataFrame([("a", "http://x/boxscores/202401010BOS.html"), ("b", "other"), ("c", None)], "game_id string, url string")
    assert [(r.page_id, r.other, r.source) for r in crosswalk.id_rows(urls, ["other"], "url").collect()] == [("202401010BOS", None, "url"), ("other", None, "url"), (None, None, "url")]


def test_crosswalk_spans(spark):
    """The nearest page within the days, the earlier one of two; pages of other teams and of no day are none."""
    games = spark.createDataFrame([("a", datetime.date(2024, 1, 10), "bos"), ("b", datetime.date(2024, 1, 10), "LAL"), ("c", None, "BOS"), ("d", datetime.date(2024, 2, 20), "BOS")], "game_id string, game_date_local date, home_team_tricode string")
    pages = spark.createDataFrame([(x,) for x in ("202401030BOS", "202401170BOS", "202401020BOS", "202401100LAL", "202413990BOS", "nonsense", "202402280BOS", "202401030BOS")], "page_id string")
    got = {r.game_id: (r.page_id, r.confidence) for r in crosswalk.crosswalk(games, pages).collect()}
    assert got == {"a": ("202401030BOS", 0.8), "b": ("202401100LAL", 1.0), "c": ("UNRESOLVED_c", 0.0), "d": ("UNRESOLVED_d", 0.0)}


def test_words(spark):
    words = [("in_progress",), (" Final ",), (None,), ("",), ("half time",)]
    assert values(spark, codes.status(F.col("t"), "shown"), words, "t string") == ["In_Progress", "Final", "Scheduled", "Scheduled", "Half Time"]
    assert values(spark, codes.status(F.col("t"), "rows"), words, "t string") == ["LIVE", "FINAL", "SCHEDULED", "SCHEDULED", "SCHEDULED"]
    assert values(spark, codes.unknown(F.col("t"), codes.STATUS["rows"]), words, "t string") == [False, False, False, False, True]
    assert values(spark, codes.injury_status(F.col("t")), [(3,), (9,), (None,)], "t int") == ["OUT", "ACTIVE", "ACTIVE"]
    pairs = values(spark, text.split_matchup(F.col("t")), [("New York @ Los Angeles",), ("A vs. B v C",), ("A v B",), ("A-B",), (None,)], "t string")
    assert [(p.home, p.away) for p in pairs] == [("Los Angeles", "New York"), ("A", "B v C"), ("A", "B"), (None, None), (None, None)]


def test_reports(spark, tmp_path):
    stats = spark.createDataFrame([("a", 1, 2.0), ("b", 3, 1.0), ("c", 3, 0.5)], "query_hash string, n_runs long, max_sec double")
    assert [(r.query_hash, r["rank"]) for r in manifest.top_queries(stats, "n_runs", 2).orderBy("rank").collect()] == [("b", 1), ("c", 2)]
    with pytest.raises(ValueError):
        manifest.top_queries(stats, "sql")
    path = f"file://{tmp_path}/q"
    partitioned.quarantine(stats, path, "one", F.lit("bad"), F.lit("2024-01-01"))
    partitioned.quarantine(spark.createDataFrame([(None,)], "x string"), path, "two", F.lit(None), F.lit(None))
    assert sorted((r.stage, r.reason, json.loads(r.row).get("query_hash")) for r in spark.read.parquet(path).collect() if r.stage == "one") == [("one", "bad", x) for x in "abc"] and spark.read.parquet(path).count() == 4
