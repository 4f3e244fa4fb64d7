"""Versioned loads, partitioned and bucketed tables, ledgers of streams, the raw tree, drift, the health suite and the gram index."""

import datetime
import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyframe.operators import crosswalk, drift, integrity
from tallyframe.operators.upsert import require_any
from tallyframe.plans import adapters
from tallyframe.sinks import bucketed, partitioned
from tallyframe.sinks.versioned import VersionedTables, into, last_day, load_day
from tallyframe.sources import game_books, raw_tree
from tallyframe.streaming import incremental

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions(spark, tmp_path):
    t = VersionedTables(spark, f"file://{tmp_path}/t")
    assert t.record() is None and t.history().count() == 0
    with pytest.raises(KeyError):
        t.read("a")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert t.publish({"a": a, "b": a}) == 1
    assert t.upsert("a", spark.createDataFrame([(2, "z"), (3, "n"), (1, "x")], "k int, v string"), ["k"]) == 2
    assert rows(t.read("a")) == [(1, "x"), (2, "z"), (3, "n")] and rows(t.read("a", 1)) == rows(a) == rows(t.read("b"))
    last = t.history().where("seq = 2").first()
    assert (last.n_before, last.n_after, last.n_insert, last.n_update, last.n_unchanged) == (2, 3, 1, 1, 1)
    broken = a.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        t.publish({"b": a.limit(0), "a": broken})
    # The first table was written before the second one failed: neither counts, and nothing is left of it.
    assert t.record().seq == 2 and rows(t.read("b")) == rows(a) and len(os.listdir(tmp_path / "t" / "b")) == 1
    t.delete(["b", "a"], "k", spark.createDataFrame([(1,)], "k int"))
    assert rows(t.read("a")) == [(2, "z"), (3, "n")] and rows(t.read("b")) == [(2, "y")]
    t.roll_back(2)
    assert rows(t.read("a")) == [(1, "x"), (2, "z"), (3, "n")] and rows(t.read("b")) == rows(a)
    t.roll_back(3, "after all")
    assert rows(t.read("a")) == [(2, "z"), (3, "n")] and t.has_note("after all") and not t.has_note("x")
    old = t.vacuum(1)
    assert len(old) == 3 and rows(t.read("a")) == [(2, "z"), (3, "n")] and rows(t.read("b")) == [(2, "y")]
    with pytest.raises(PySparkException):  # a second writer of one record
        t._append("load", None, {}, [], t.record(4))


def test_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    partitioned.append(spark.createDataFrame([(k, k * 1.0, f"d{k % 4}") for k in range(40)], "k int, v double, day string"), path, ["day"])
    before = {(r.day, r.file) for r in partitioned.files(spark, path, ["day"]).collect()}
    new = spark.createDataFrame([(0, -1.0, "d0"), (1, -1.0, "d9"), (100, 1.0, "d0")] + [(k, 0.0, "d8") for k in range(2, 40, 4)], "k int, v double, day string")
    assert partitioned.overwrite_keys(spark, path, new, ["k"], ["day"]) == {"touched": 5, "emptied": 1}
    got = {r.k: (r.v, r.day) for r in spark.read.parquet(path).collect()}
    assert len(got) == spark.read.parquet(path).count() == 41
    assert got[0] == (-1.0, "d0") and got[1] == (-1.0, "d9") and got[2] == (0.0, "d8") and got[5] == (5.0, "d1") and got[3] == (3.0, "d3") and got[100] == (1.0, "d0")
    after = {(r.day, r.file) for r in partitioned.files(spark, path, ["day"]).collect()}
    assert {x for x in after if x[0] == "d3"} == {x for x in before if x[0] == "d3"} and not any(x[0] == "d2" for x in after)
    assert partitioned.overwrite_keys(spark, path, new.limit(0), ["k"], ["day"]) == {"touched": 0, "emptied": 0}
    partitioned.append(new.limit(0), path, ["day"])
    assert spark.read.parquet(path).count() == 41


def above_scan(plan, table):
    """The operators on the way from a table's scan to the plan's root."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
    out, d = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < d:
            out.append(line.lstrip(" :+-*|"))
            d = depth(line)
    return out


def test_buckets(spark, tmp_path):
    t = bucketed.BucketedTable.of(spark, "advanced_player_stats", f"file://{tmp_path}/b", "stats_here", 4)
    old = spark.createDataFrame([("g", 1, 1.0), ("g", 2, None), ("h", 1, 3.0), (None, 1, 0.0)], "game_id string, player_id long, v double")
    t.create(old)
    assert [r.missing for r in t.rejected(old).collect()] == [["game_id"]]
    new = spark.createDataFrame([("g", 1, 1.0), ("g", 2, 5.0), ("i", 1, 7.0), ("x", None, 0.0)], "game_id string, player_id long, v double")
    got = {(r.game_id, r.player_id): (r.v, r._action) for r in t.merged(new).collect()}
    assert got == {("g", 1): (1.0, "unchanged"), ("g", 2): (5.0, "update"), ("h", 1): (3.0, "kept"), ("i", 1): (7.0, "insert")}
    assert {r._action for r in t.merged(new, always=True).where("game_id = 'g'").collect()} == {"update"}
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = t.merged(new)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was[0])
        spark.conf.set("spark.sql.adaptive.enabled", was[1])
    way = above_scan(plan, "stats_here_v1")
    assert any("Join" in x for x in way) and not any("Exchange" in x for x in way) and "Exchange" in plan
    t.upsert(new)
    assert rows(spark.table("stats_here")) == [("g", 1, 1.0), ("g", 2, 5.0), ("h", 1, 3.0), ("i", 1, 7.0)]
    assert not os.path.exists(tmp_path / "b" / "v1")
    broken = new.withColumn("v", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(PySparkException):
        t.upsert(broken)
    assert spark.table("stats_here").count() == 4 and not spark.catalog.tableExists("stats_here_v3")
    t.drop()
    assert not [x.name for x in spark.catalog.listTables() if "stats_here" in x.name]


def test_ledger(spark, tmp_path):
    """Three deliveries, a restart, a lost checkpoint: as one batch. Late news don't replace newer ones."""
    e = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    root = f"file://{tmp_path}"
    t = VersionedTables(spark, f"{root}/t")
    each = into(t, "latest", ["user_id"], [F.col("ts"), F.col("event_id")], "s")
    run = lambda c: incremental.run_available(incremental.event_stream(spark, f"{root}/in/*", e.schema), f"{root}/{c}", each)
    for k in (2, 0, 1):
        e.where(F.col("event_id") % 3 == k).coalesce(1).write.parquet(f"{root}/in/d={k}")
        run("c")
    want = rows(e.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id", "m.ts"))
    assert rows(t.read("latest").select("user_id", "event_id", "ts")) == want and t.log().count() == 3
    run("c")
    run("other")  # batch 0 again, now with all files: it was loaded, so it isn't again
    assert rows(t.read("latest").select("user_id", "event_id", "ts")) == want and t.log().count() == 3


def test_daily(spark, tmp_path):
    """A day is loaded once; a run that fails leaves the mark."""
    at = lambda x: datetime.datetime.fromisoformat(x)
    rows_ = spark.createDataFrame([(1, at("2024-01-02 04:59:00"), 1.0), (1, at("2024-01-02 05:00:00"), 2.0), (2, at("2024-01-03 04:00:00"), 3.0)], "k int, ts timestamp, v double")
    t = VersionedTables(spark, f"file://{tmp_path}/d")
    load = lambda now, r=rows_: load_day(t, "x", r, "ts", at(now), ["k"], [F.col("ts")])
    assert last_day(t).first().day is None
    assert load("2024-01-02 12:00:00") == 1 and rows(t.read("x").select("k", "v")) == [(1, 1.0)]
    with pytest.raises(PySparkException):
        load("2024-01-03 12:00:00", rows_.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("v"))))
    assert last_day(t).first().day == "2024-01-01"
    assert load("2024-01-04 04:59:00") == 2 and load("2024-01-03 12:00:00") is None
    assert rows(t.read("x").select("k", "v")) == [(1, 2.0), (2, 3.0)] and last_day(t).first().day == "2024-01-02"


def test_raw_tree(spark, tmp_path):
    root = tmp_path / "raw"
    for name, body in {"2024-01-01/g1/playbyplay.json": '{"a": 1}', "2024-01-01/g1/boxscoresummaryv2.json": "{", "2024-01-01/g2/playbyplay.json": " ", "2024-01-02/g1/playbyplay.json": "[]", "2024-01-02/__x/playbyplay.json": "{}", "2024-01-02/.x/playbyplay.json": "{}", "2024-01-02/manifest.json": "{}"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    (root / "2024-01-01/g1/playbyplay.json.gz").write_bytes(gzip.compress(b'{"a": 1}'))
    (root / "2024-01-02/g3").mkdir()
    (root / "2024-01-02/g3/shotchart.json.gz").write_bytes(gzip.compress(b'{"s": 1}'))
    got = raw_tree.scan(spark, f"file://{root}")
    assert {(r.day, r.game_id, r.endpoint): r.error for r in got.collect()} == {
        ("2024-01-01", "g1", "playbyplay"): None, ("2024-01-01", "g1", "boxscoresummary"): "no JSON", ("2024-01-01", "g2", "playbyplay"): "empty", ("2024-01-02", "g1", "playbyplay"): None, ("2024-01-02", "g3", "shotchart"): None,
    }
    assert got.count() == 5 and {r.body for r in got.where("endpoint = 'shotchart'").collect()} == {'{"s": 1}'}
    some = raw_tree.scan(spark, f"file://{root}", ["2024-01-01"], ["boxscoresummary"])
    assert [r.game_id for r in some.collect()] == ["g1"] and len(some.inputFiles()) <= 2 and all("2024-01-01" in f and "boxscore" in f for f in some.inputFiles())
    assert raw_tree.scan(spark, f"file://{root}", ["2030-01-01"]).count() == 0 and raw_tree.scan(spark, f"file://{tmp_path}/none").count() == 0


def test_raw_store(spark, tmp_path):
    files = spark.createDataFrame([(f"2024-01-0{d}", f"g{g}", e, "{" if g == 3 else "{}") for d in (1, 2, 3) for g in range(5) for e in ("playbyplay", "shotchart")], "day string, game_id string, endpoint string, body string")
    path = f"file://{tmp_path}/s"
    raw_tree.write(files, path)
    raw_tree.write(files.withColumn("day", F.lit("2024-02-01")), path)
    assert raw_tree.stored(spark, path).count() == 60
    one = raw_tree.stored(spark, path, ["2024-01-02"], ["shotchart"])
    assert sorted((r.game_id, r.error, r.n_bytes, len(r.sha1)) for r in one.collect()) == [(f"g{g}", "no JSON" if g == 3 else None, 1 if g == 3 else 2, 40) for g in range(5)]
    plan = one._jdf.queryExecution().executedPlan()
    while plan.nodeName() != "Scan json ":
        plan = plan.children().head()
    listed = plan.selectedPartitions().filePartitionIterator().toList()
    assert listed.size() == 1 and "PartitionFilters: [day" in plan.toString().replace("isnotnull(day", "day")


def test_drift(spark):
    bodies = [('{"a": 1, "b": {"c": "x"}, "l": [1, 2]}',), ('{"a": "1", "b": null, "l": [], "new": true}',), ("no",), (None,), ('{"a": 2, "b": {"c": 1.5}, "l": [1, "x"]}',)]
    expected = spark.createDataFrame([("$.a", "BIGINT"), ("$.b", "OBJECT"), ("$.b.c", "STRING"), ("$.l", "ARRAY"), ("$.l[]", "BIGINT")], "path string, type string")
    got = {(r.path, r.problem, r.found): r.n_rows for r in drift.payload_drift(spark.createDataFrame(bodies, "body string"), "body", expected).collect()}
    assert got == {
        ("$", "new", "INVALID"): 2, ("$.a", "retyped", "STRING"): 1, ("$.a", "absent", None): 2, ("$.b", "absent", None): 2, ("$.b.c", "absent", None): 3, ("$.b.c", "retyped", "DECIMAL"): 1, ("$.l", "absent", None): 2, ("$.l[]", "absent", None): 3,
        ("$.l[]", "retyped", "STRING"): 1, ("$.new", "new", "BOOLEAN"): 1,
    }
    none = drift.payload_drift(spark.createDataFrame([], "body string"), "body", expected)
    assert none.count() == 0


def test_required_groups(spark):
    data = spark.createDataFrame([(1, "a", None, "x"), (2, None, "b", ""), (3, "", None, "x"), (4, None, None, None)], "k int, t string, h string, s string")
    good, bad = require_any(data, [[["t"], ["h", "s"]], [["k"]]])
    assert [r.k for r in good.collect()] == [1] and {r.k: r.missing for r in bad.collect()} == {2: ["t or h, s"], 3: ["t or h, s"], 4: ["t or h, s"]}


def test_health_suite_plan(spark):
    """One scan and two exchanges for all dimensions."""
    e = adapters.events(spark, SF).withColumn("day", F.lit("2024-01-01").cast("date")).withColumn("season", F.lit(None).cast("string"))
    plan = integrity.health_suite(e, ["day"])._jdf.queryExecution().sparkPlan().toString()
    full = integrity.health_suite(e, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and full.count("Exchange ") == 2


def test_health_suite_odd(spark):
    cols = "game_id string, event_idx int, team_tricode string, event_type string, period int, player1_name_slug string, seconds_elapsed double, shot_x double, shot_y double, season string, day string"
    data = [("0022300001", 1, "A", "SHOT_MADE", 1, "p", 1.0, None, 2.0, "2023-24", "x"), ("0022300001", 1, None, "FOUL", 1, None, None, None, None, "2022-23", "x"), ("bad", 1, None, "FOUL", 2, "q", None, None, None, None, None)]
    got = {(r.dimension, r.value): r for r in integrity.health_suite(spark.createDataFrame(data, cols), ["day"], 2, 5, 1).collect()}
    every = got["all", None]
    assert (every.n_games, every.n_events, every.thin_games, every.repeated, every.no_team, every.no_clock, every.n_shots, every.no_place, every.bad_ids, every.other_season, every.no_season, every.bad_lineups) == (2, 3, 1, 1, 2, 2, 1, 1, 1, 1, 1, 0)
    assert got["day", None].n_games == 1 and got["day", "x"].n_events == 2 and got["team_tricode", "A"].n_games == 1 and got["team_tricode", None].n_games == 2 and got["game_id", "bad"].clock_pct == 0 and got["game_id", "bad"].place_pct is None
    assert integrity.health_suite(spark.createDataFrame(data, cols).limit(0), ["day"]).count() == 0


def test_gram_index(spark):
    """No pair of the least score is lost, and few others are compared."""
    s = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet")
    known = s.select(F.col("s_name").alias("known"))
    names = s.select(F.concat(F.substring("s_name", 1, 4), F.lit("x"), F.substr("s_name", F.lit(6))).alias("name"))
    a, b = crosswalk.ordered_grams(names, known)
    compared = crosswalk.candidates(a, b, 97.0).count() + crosswalk.candidates(a, b, 93.0).count()
    assert compared < names.count() * known.count() / 10
    words = ["anna", "annabel", "anabel", "bannana", "aaaa", "aaaab", "ab", "a", "b", "ba", "Annabell", "annabelle", "x" * 30, "x" * 29 + "y", "xy" * 15, "", "äöü", "äöü "]
    w = spark.createDataFrame([(x,) for x in words], "name string")
    for least in (85.0, 70.0):
        pairs = w.crossJoin(w.withColumnRenamed("name", "known")).withColumn("score", crosswalk.ratio(F.lower("name"), F.lower("known"))).where(F.col("score") >= least)
        a, b = crosswalk.ordered_grams(w, w.withColumnRenamed("name", "known"))
        met = set(rows(crosswalk.candidates(a, b, least).select("name", "known")))
        assert set(rows(pairs.select("name", "known"))) - met <= {("", "")}


def test_book_scanner(spark):
    book = "OFFICIALS\nCrew Chief: Ann Able\nTechnical Fouls:\nHOME TEAM: Bears\nT1: Bob Baker (BOS) - 1:05 Q4\nVisiting: Wolves\nT: Bench technical (NYK) - 10:00 Q1\nComments:\nT2: Cy Cole (LAL) - 2:00 Q2 - Delay of game\nT1: Bob Baker (BOS) - 1:05 Q4"
    got = game_books.technicals(spark.createDataFrame([("g", book), ("h", ""), ("i", None)], "game_id string, text string")).orderBy("at").collect()
    assert [(r.section, r.heading, r.player, r.team, r.period, r.clock, r.kind, r.reason, r.pattern) for r in got] == [
        ("technicals", "Bears", "Bob Baker", "BOS", 4, "1:05", "player", None, "plain"), ("technicals", "Wolves", "Bench technical", "NYK", 1, "10:00", "bench", None, "bench"), ("notes", None, "Cy Cole", "LAL", 2, "2:00", "player", "Delay of game", "reason"),
    ]
    ids = spark.createDataFrame([("Game ID: 0022300001",), ("0012345678 then id: ABCD1234",), ("nothing",), (None,)], "t string").select(game_books.found_id(F.col("t"), "0022").alias("f"))
    assert [(r.f.value, r.f.pattern) if r.f else None for r in ids.collect()] == [("0022300001", "labelled"), ("ABCD1234", "id"), None, None]


def test_fuzzy_by_cuts(spark, monkeypatch):
    """Short names are matched without pairs; with long ones the best of all pairs is found."""
    import random

    def brute(names, known, least):
        out = {}
        for n in names:
            s, k = min((-crosswalk._ratio(n.lower(), k.lower()) if n or k else -100.0, k) for k in known)
            if -s >= least:
                out[n] = (k, round(-s, 9))
        return out

    def run(names, known, least):
        frame = lambda v, c: spark.createDataFrame([(x,) for x in v], f"{c} string")
        return {r.name: (r.match, round(r.score, 9)) for r in crosswalk.fuzzy_match(frame([*names, None], "name"), frame([*known, None], "known"), least).collect()}

    draw = random.Random(3)
    some = lambda n, a, b: ["".join(draw.choice("abAé ") for _ in range(draw.randint(a, b))) for _ in range(n)]
    names, known = [*some(40, 0, 12), "", "Supplier#000000017"], [*some(40, 1, 12), "Supplier#000000018", "suppLier#00000001"]
    long_names, long_known = [*names, *some(20, 40, 60)], [*known, *some(20, 40, 60)]
    long_names += [x[:20] + x[22:] for x in long_known[-10:]]
    for least in (85.0, 70.0):
        assert run(long_names, long_known, least) == brute(long_names, long_known, least)

    def pairs(*_, **__):
        raise AssertionError("pairs of short names")

    monkeypatch.setattr(crosswalk, "candidates", pairs)
    assert run(names, known, 85.0) == brute(names, known, 85.0)
