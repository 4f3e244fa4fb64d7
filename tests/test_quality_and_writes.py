"""Checks, upserts, sources and streams."""

import json

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import crosswalk, integrity, manifest, upsert
from tallyframe.sources import dimensions, game_books, pages, raw_tree, result_sets
from tallyframe.streaming import incremental


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "n", 0.0)], "k int, t string, v double")
    new = spark.createDataFrame([(2, "b", None), (3, "c", 4.0), (4, "d", 5.0), (None, "n", 0.0)], "k int, t string, v double")
    got = {r.k: (r.v, r._action) for r in upsert.upsert(old, new, ["k"]).collect()}
    assert got == {1: (1.0, "kept"), 2: (None, "unchanged"), 3: (4.0, "update"), 4: (5.0, "insert"), None: (0.0, "unchanged")}
    once = upsert.upsert(old, new, ["k"]).drop("_action")
    assert {r._action for r in upsert.upsert(once, new, ["k"]).collect()} == {"kept", "unchanged"}


def test_load_derived(spark):
    old = spark.createDataFrame([("g1", 1)], "game_id string, v int")
    new = spark.createDataFrame([("g1", 2), ("g2", 3), ("g3", None), ("g4", 5)], "game_id string, v int")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "game_id string")
    got = upsert.load_derived(old, new, ["game_id"], ["v"], ids("g1", "g2", "g3"), ids("g1", "g2"))
    assert {r.game_id: (r.v, r._action) for r in got.collect()} == {"g1": (2, "update"), "g2": (3, "insert")}
    good, bad = upsert.require(new, ["v"])
    assert good.count() == 3 and [(r.game_id, r.missing) for r in bad.collect()] == [("g3", ["v"])]


def test_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    r = integrity.fk_check(child, parent, "k", "t").first()
    assert (r.total, r.invalid, r.issues) == (4, 2, "2")
    empty = integrity.summary(integrity.fk_check(child.limit(0), parent, "k", "t")).first()
    assert (empty.total, empty.score, empty.is_valid) == (0, 1.0, True)
    rows = spark.createDataFrame([("g", 1, 0.0), ("g", 2, 9.0), ("g", 5, 3.0)], "g string, i int, t double")
    assert [r.gap_size for r in integrity.index_gaps(rows, ["g"], "i").collect()] == [3]
    assert [r.time_diff for r in integrity.clock_regressions(rows, ["g"], "i", "t").collect()] == [-6.0]
    miss = integrity.missing_from(spark.createDataFrame([(1,), (2,)], "k int"), {"a": parent, "b": child}, "k").collect()
    assert [(r.k, r.missing) for r in miss] == [(2, "a")]


def test_manifest(spark):
    schema = f"game_id string, endpoints {manifest.ENDPOINTS}, errors array<string>"
    old = spark.createDataFrame([("g", {"a": (True, 1), "b": (False, 2)}, ["x"])], schema)
    new = spark.createDataFrame([("g", {"b": (True, 3)}, []), ("h", {"a": (True, 1)}, [])], schema)
    got = {r.game_id: r for r in manifest.merge_manifest(old, new).collect()}
    assert got["g"].endpoints["b"].ok and got["g"].errors == ["x"]
    merged = manifest.merge_manifest(old, new)
    assert [manifest.rollup(merged, k).first().n_good for k in ("harvest", "report", "manifest")] == [1, 0, 1]


def payload(rows, name="PlayByPlay", key="resultSets"):
    return json.dumps({key: [{"name": "Other", "headers": [], "rowSet": []}, {"name": name, "headers": ["EVENTNUM", "PERIOD", "PCTIMESTRING", "VISITORDESCRIPTION", "NEW"], "rowSet": rows}]})


def test_result_sets(spark):
    bodies = [("a", payload([[1, 1, "11:00", "x", 0], [2, 11, "1:00", None, 0], [3, 1]])), ("b", payload([[7, None, None, None, 1]], key="ResultSets")), ("c", "no json"), ("d", None)]
    got = result_sets.plays(spark.createDataFrame(bodies, "game_id string, body string")).orderBy("game_id").collect()
    assert [(r.game_id, r.event_num, r.period, r.clock, r.description) for r in got] == [("a", 1, 1, "11:00", "x"), ("b", 7, 1, "12:00", None)]
    ids = spark.createDataFrame([("1, 2,3,4,5",), ("1,x,2",), (None,)], "t string").select(result_sets.lineup_ids(F.col("t")).alias("x")).collect()
    assert [r.x for r in ids] == [[1, 2, 3, 4, 5], None, None]


def test_raw_tree(spark, tmp_path):
    for name, body in (("2024-01-01/g1/playbyplay.json", payload([[1, 1, "11:00", "x", 0]])), ("2024-01-01/g1/boxscoresummaryv2.json", "{"), ("2024-01-02/g2/playbyplay.json", "{}"), ("2024-01-02/__x/playbyplay.json", "{}")):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
    files = raw_tree.read(spark, str(tmp_path))
    assert {(r.day, r.game_id, r.endpoint) for r in files.collect()} == {("2024-01-01", "g1", "playbyplay"), ("2024-01-01", "g1", "boxscoresummary"), ("2024-01-02", "g2", "playbyplay")}
    assert raw_tree.endpoint(files, "boxscoresummary").count() == 0
    assert result_sets.plays(raw_tree.endpoint(files, "playbyplay").select("game_id", "body")).count() == 1


def test_dimensions(spark, tmp_path):
    (tmp_path / "v.csv").write_text("team_id,arena_name,arena_tz,lat,lon,altitude_m\nBOS,Hall,America/New_York,42.3,-71,5\nLAL,Hall,x,no,1,2\n")
    assert [r.team_id for r in dimensions.venues(spark, str(tmp_path / "v.csv")).collect()] == ["BOS"]
    (tmp_path / "a.yaml").write_text('teams:\n  BRK:\n    canonical: "BRK"\n    feed: ["BKN", "BROOKLYN"]\n    aliases: ["NETS"]\n  BOS:\n    aliases: ["CELTICS"]\n')
    got = {(r.canonical, r.source, r.alias) for r in dimensions.team_aliases(spark, str(tmp_path / "a.yaml")).collect()}
    assert {("BRK", "feed", "BKN"), ("BRK", "aliases", "NETS"), ("BOS", "aliases", "CELTICS"), ("BOS", "canonical", "BOS")} <= got
    rows = spark.createDataFrame([("nets",), ("Celtics ",), ("x",)], "t string")
    found, lost = crosswalk.resolve_aliases(rows, "t", dimensions.team_aliases(spark, str(tmp_path / "a.yaml")))
    assert {r.canonical for r in found.collect()} == {"BRK", "BOS"} and lost.count() == 1


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_fuzzy(spark):
    names, known = ["Scott Foster", "scot foster", "Tony Brothers", "Zed", "Al"], ["Scott Foster", "Tony Brother", "Marc Davis", "al"]
    got = {r.name: (r.match, r.score) for r in crosswalk.fuzzy_match(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(n,) for n in known], "known string")).collect()}
    want = {}
    for n in names:
        s, k = max((200 * lcs(n.lower(), k.lower()) / (len(n) + len(k)), k) for k in known)
        if s >= 85:
            want[n] = (k, pytest.approx(s))
    assert got == want


def test_pages(spark):
    html = '<table id="box-A"><tbody><tr><th data-stat="player">Ann Able*</th><td data-stat="pos">G</td></tr><tr><th data-stat="player">Bob</th></tr></tbody></table><table id="box-H"><tr class="starter"><th data-stat="player">Cy</th></tr></table><p>Inactive: Dan Dean (ankle) - out</p><div>Attendance: 19,156</div>'
    p = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [(r.side, r.player, r.position) for r in pages.starters(p).collect()] == [("away", "Ann Able", "G"), ("home", "Cy", None)]
    assert [(r.player, r.reason, r.status) for r in pages.injury_notes(p).collect()] == [("Dan Dean", "ankle", "OUT")]
    assert pages.game_metadata(p).where("page_id = 1").first().attendance == 19156
    none = pages.line_score(p).where("page_id = 2").first()
    assert none.away_q1 is None and none.ot_periods is None


def test_game_books(spark):
    body = "OFFICIAL GAME BOOK 0022300001\nCrew Chief: Ann Able\nReferee: Bob Baker\nReferee: Ann Able\nAlternates: Cy Cole, Ann Able\n\nTechnical Foul: Dan Dean\nArena: Big Hall, Town\n"
    p = game_books.parse(spark.createDataFrame([("0022300001", body)], "game_id string, text string"))
    r = p.first()
    assert [(x.name, x.role) for x in r.refs] == [("Ann Able", "CREW_CHIEF"), ("Bob Baker", "REFEREE")]
    assert r.alternates == ["Cy Cole"] and r.technical_fouls == ["Dan Dean"] and r.arena == "Big Hall" and r.parsing_confidence == pytest.approx(0.6)
    assert game_books.quality(p).first().is_valid and game_books.referee_rows(p).count() == 2
    books = spark.createDataFrame([("g", [("BOS", ["PLAYER", "MIN", "PTS"], [["Ann", "12:00", "1,0"], ["Bob", "DNP", "DNP"], ["TOTALS", "", "10"]])])], "game_id string, player_stats_tables array<struct<team:string,headers:array<string>,rows:array<array<string>>>>")
    assert [(x.player, x.pts, x.is_total) for x in game_books.player_rows(books).collect()] == [("Ann", 10, False), ("Bob", None, False), ("TOTALS", 10, True)]


def test_watermarks(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    marks = incremental.set_watermark(spark.createDataFrame([], incremental.WATERMARKS), "s", "k", F.lit("a"), F.lit("2024-01-01").cast("timestamp"))
    marks = incremental.set_watermark(marks, "s", "k", F.lit("b"), F.lit("2024-01-02").cast("timestamp"))
    assert [r.value for r in marks.collect()] == ["b"]
    assert [r.k for r in incremental.after_watermark(rows, "k", marks, "s", "k").collect()] == ["c"]
    assert incremental.after_watermark(rows, "k", marks, "other", "k").count() == 3


def test_stream_equals_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = incremental.deduplicated(incremental.event_stream(spark, str(tmp_path / "in"), batch.schema), "ts", ["event_id"], "40 days")
    incremental.run_available(stream, str(tmp_path / "cp"), lambda df, i: seen.extend(df.select("event_id").collect()))
    assert sorted(r.event_id for r in seen) == sorted(r.event_id for r in batch.select("event_id").collect())
    incremental.run_available(stream, str(tmp_path / "cp"), lambda df, i: seen.extend(df.select("event_id").collect()))
    assert len(seen) == batch.count()
