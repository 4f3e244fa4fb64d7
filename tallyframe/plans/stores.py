"""Loads, folders, buckets, ledgers and the raw tree: each query writes the benchmark tables below the session's checkpoint folder, changes them there and reads them back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, teams
from ..operators.upsert import require, require_any
from ..sinks import bucketed, partitioned
from ..sinks.places import work_folder
from ..sinks.versioned import VersionedTables, into, last_day, load_day
from ..sources import raw_tree, result_sets
from ..streaming import incremental
from .adapters import G_SQL, Queries, games, table
from .feeds import collected, payload, result_set

Q = Queries()


@Q.add("""WITH g AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 5 = 0) AS ins, count(*) FILTER (o_orderkey % 4 = 0) AS upd, count(*) FILTER (o_orderkey % 10 = 0) AS del FROM orders), l AS (SELECT count(*) AS n, count(*) FILTER (l_orderkey % 10 = 0) AS del FROM lineitem)
SELECT 1 AS seq, 'load' AS action, NULL AS note, 'games' AS "table", 0 AS n_before, n AS n_after, NULL::BIGINT AS n_insert, NULL::BIGINT AS n_update, NULL::BIGINT AS n_unchanged FROM g
UNION ALL SELECT 1, 'load', NULL, 'lines', 0, n, NULL, NULL, NULL FROM l UNION ALL SELECT 2, 'upsert', 'daily', 'games', n, n + ins, ins, upd, n - upd FROM g
UNION ALL SELECT 3, 'delete', 'bad games', 'lines', n, n - del, NULL, NULL, NULL FROM l UNION ALL SELECT 3, 'delete', 'bad games', 'games', n + ins, n + ins - del, NULL, NULL, NULL FROM g
UNION ALL SELECT 4, 'roll back', 'to 2', 'lines', n - del, n, NULL, NULL, NULL FROM l UNION ALL SELECT 4, 'roll back', 'to 2', 'games', n + ins - del, n + ins, NULL, NULL, NULL FROM g""")
def versioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a load of two tables, an upsert, a load that fails half-way and leaves no trace, a deletion from both, and a rollback of it."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    games = orders.select(F.col("o_orderkey").alias("game_id"), F.col("o_orderstatus").alias("status"), "o_totalprice")
    lines = lines.select(F.col("l_orderkey").alias("game_id"), "l_linenumber", "l_quantity")
    t = VersionedTables(spark, work_folder(spark, "versioned"))
    t.publish({"games": games, "lines": lines})
    changed = games.withColumn("status", F.when(F.col("game_id") % 4 == 0, "X").otherwise(F.col("status")))
    t.upsert("games", changed.unionByName(games.where("game_id % 5 = 0").withColumn("game_id", -1 - F.col("game_id"))), ["game_id"], "daily")
    fails = F.when(F.col("game_id") % 10 == 3, F.raise_error(F.lit("broken source")).cast("double")).otherwise(F.col("o_totalprice"))
    try:
        t.publish({"lines": lines.where("l_linenumber = 1"), "games": games.withColumn("o_totalprice", fails)}, "load", "half")
    except PySparkException as e:
        if "broken source" not in str(e):
            raise
    t.delete(["lines", "games"], "game_id", games.where("game_id % 10 = 0"), "bad games")
    t.roll_back(2)
    return t.history()


@Q.add("""WITH n AS (SELECT CASE WHEN p = 4 THEN 14 WHEN p = 5 AND o_orderkey % 7 = 1 THEN 15 ELSE p END AS part, CASE WHEN p = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS q FROM (SELECT *, o_custkey % 10 AS p FROM orders))
SELECT CAST(part AS INT) AS part, count(*) AS n_rows, round(sum(q), 2) AS price, part NOT IN (3, 5, 14, 15) AS files_kept FROM n GROUP BY part""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in ten folders after a load that changes the rows of one, moves all rows of another and some of a third: rows by folder, and whether a folder's files are the same as before."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 10).cast("int").alias("part"))
    path = work_folder(spark, "partitioned")
    partitioned.append(rows, path, ["part"])
    before = partitioned.files(spark, path, ["part"]).groupBy("part").agg(F.array_sort(F.collect_set("file")).alias("was"))
    before.write.parquet(f"{path}-files")
    changed = rows.where("part = 3").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    moved = rows.where("part = 4 or part = 5 and o_orderkey % 7 = 1").withColumn("part", F.col("part") + 10)
    partitioned.overwrite_keys(spark, path, changed.unionByName(moved), ["o_orderkey"], ["part"])
    now = spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    after = partitioned.files(spark, path, ["part"]).groupBy("part").agg(F.array_sort(F.collect_set("file")).alias("is"))
    same = after.join(spark.read.parquet(f"{path}-files"), "part", "left").select("part", F.col("was").eqNullSafe(F.col("is")).alias("files_kept"))
    return now.join(same, "part")


@Q.add("""SELECT o_orderkey, o_orderpriority, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'update' ELSE 'unchanged' END AS _action FROM orders WHERE o_custkey % 2 = 0
UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus, 'kept' FROM orders WHERE o_custkey % 2 = 1 UNION ALL SELECT o_orderkey, 'new', o_totalprice, o_orderstatus, 'insert' FROM orders WHERE o_orderstatus = 'F'""")
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders after a load that brings every second customer's again, a third of these changed, and new ones: the table in buckets stays where it is."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus", "o_custkey")
    t = bucketed.BucketedTable(spark, f"orders_{uuid.uuid4().hex}", work_folder(spark, "bucketed"), ["o_orderkey", "o_orderpriority"], 16)
    try:
        t.create(rows.drop("o_custkey"))
        again = rows.where("o_custkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0))
        more = rows.where("o_orderstatus = 'F'").withColumn("o_orderpriority", F.lit("new"))
        out = work_folder(spark, "merged")
        t.merged(again.unionByName(more).drop("o_custkey")).write.parquet(out)
    finally:
        t.drop()
    return spark.read.parquet(out)


@Q.add("""SELECT user_id, event_id, value, 3 AS n_batches FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, from a stream of three deliveries, each read by a run of its own, with a run without news and every batch once more; and how many batches were loaded."""
    root = work_folder(spark, "ledger")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    t = VersionedTables(spark, f"{root}/tables")
    each = into(t, "latest", ["user_id"], [F.col("ts"), F.col("event_id")], "events")
    stream = lambda: incremental.event_stream(spark, f"{root}/in/*", events.schema)
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.parquet(f"{root}/in/delivery={k}")
        incremental.run_available(stream(), f"{root}/checkpoint", each)
    incremental.run_available(stream(), f"{root}/checkpoint", each)
    for k in range(3):
        each(spark.read.parquet(f"{root}/in/delivery={k}"), k)
    return t.read("latest").select("user_id", "event_id", "value").crossJoin(t.log().agg(F.count("*").cast("int").alias("n_batches")))


@Q.add("""WITH e AS (SELECT *, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS d FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM e)
SELECT user_id, event_id, value, (SELECT CAST(max(d) AS VARCHAR) FROM e) AS loaded_to, 3 AS n_loads FROM k WHERE k = 1""")
def daily_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event after a backfill and the runs of two days, the second of which runs twice; the last day loaded and the number of loads."""
    zone = "America/New_York"
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    day = F.to_date(F.from_utc_timestamp("ts", zone))
    last = events.agg(F.max(day)).first()[0]
    noon = lambda d: datetime(d.year, d.month, d.day, 17)
    t, keys, order = VersionedTables(spark, work_folder(spark, "daily")), ["user_id"], [F.col("ts"), F.col("event_id")]
    old = events.where(day < F.lit(last - timedelta(days=1)))
    t.publish({"latest": old.groupBy("user_id").agg(F.max_by(F.struct(*old.columns), F.struct(*order)).alias("r")).select("r.*")}, "backfill")
    for as_of in (last, last + timedelta(days=1), last + timedelta(days=1)):
        load_day(t, "latest", events, "ts", noon(as_of), keys, order)
    marks = last_day(t).select(F.col("day").alias("loaded_to")).crossJoin(t.log().agg(F.count("*").cast("int").alias("n_loads")))
    return t.read("latest").select("user_id", "event_id", "value").crossJoin(F.broadcast(marks))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A play-by-play and a summary for each user and day; of every seventh user the plays' file breaks off, of every eleventh it is empty."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    key = F.struct("day", "user_id")
    cells = lambda c: {"EVENTNUM": c("event_id") + 1, "PERIOD": F.lit(1), "PCTIMESTRING": F.lit("11:00"), "VISITORDESCRIPTION": c("event_type")}
    plays = collected(events, key, "PlayByPlay", cells, "event_id").select("game_id.day", "game_id.user_id", F.lit("playbyplay").alias("endpoint"), "body")
    cut = F.when(F.col("user_id") % 11 == 0, "").when(F.col("user_id") % 7 == 0, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    summary = events.select("day", "user_id").distinct().select("day", "user_id", F.lit("boxscoresummary").alias("endpoint"), payload(result_set("GameSummary", {"GAME_ID": F.col("user_id")})).alias("body"))
    both = plays.withColumn("body", cut).unionByName(summary)
    return both.select("day", F.col("user_id").cast("string").alias("game_id"), "endpoint", "body")


@Q.add("""WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id AS u, count(*) AS n FROM events GROUP BY 1, 2)
SELECT day, 'playbyplay' AS endpoint, count(*) AS n_files, count(*) FILTER (u % 11 = 0) AS n_empty, count(*) FILTER (u % 11 > 0 AND u % 7 = 0) AS n_bad, coalesce(sum(n) FILTER (u % 11 > 0 AND u % 7 > 0), 0)::BIGINT AS n_plays FROM d GROUP BY day
UNION ALL SELECT day, 'boxscoresummary', count(*), 0, 0, 0 FROM d GROUP BY day""")
def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written by day and endpoint and read back: good ones, those that are no JSON, empty ones, and the plays in them."""
    path = work_folder(spark, "raw")
    raw_tree.write(_files(spark, sf_dir), path)
    files = raw_tree.stored(spark, path)
    counts = files.groupBy("day", "endpoint").agg(F.count("*").alias("n_files"), F.count_if(F.col("error").eqNullSafe("empty")).alias("n_empty"), F.count_if(F.col("error").eqNullSafe("no JSON")).alias("n_bad"))
    plays = result_sets.plays(raw_tree.stored(spark, path, endpoints=["playbyplay"]).where("error is null").select("day", "game_id", "body"))
    found = plays.groupBy("day").agg(F.count("*").alias("n")).withColumn("endpoint", F.lit("playbyplay"))
    return counts.join(found, ["day", "endpoint"], "left").select("day", "endpoint", "n_files", "n_empty", "n_bad", F.coalesce("n", F.lit(0)).alias("n_plays"))


@Q.add("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 13 = 0 THEN 'game_id' END, CASE WHEN o_orderkey % 3 = 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 5 = 0) THEN 'team_tricode or home_team_tricode, away_team_tricode' END, CASE WHEN o_orderkey % 11 = 0 THEN 'source' END) AS missing
FROM orders WHERE o_orderkey % 13 = 0 OR (o_orderkey % 3 = 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 5 = 0)) OR o_orderkey % 11 = 0""")
def required_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id, without a team or both sides, or without a source: what each lacks. An empty text is as good as none."""
    k, t = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        k, F.when(k % 13 > 0, k.cast("string")).otherwise("").alias("game_id"), F.when(k % 3 > 0, t).alias("team_tricode"), F.when(k % 2 == 1, t).alias("home_team_tricode"), F.when(k % 5 > 0, t).alias("away_team_tricode"), F.when(k % 11 > 0, t).alias("source"),
    )
    _, bad = require_any(rows, [[["game_id"]], [["team_tricode"], ["home_team_tricode", "away_team_tricode"]], [["source"]]])
    return bad.select("o_orderkey", F.array_join("missing", ",").alias("missing"))


@Q.add("""WITH o AS (SELECT o_orderkey AS k FROM orders), n AS (SELECT count(*) AS n, count(*) FILTER (k % 5 = 0) AS f5, count(*) FILTER (k % 3 = 0) AS f3, count(*) FILTER (k % 7 = 0) AS f7, count(*) FILTER (k % 4 = 0) AS f4, count(*) FILTER (k % 11 = 0) AS bad,
  count(*) FILTER (k % 11 > 0 AND k % 5 = 0) AS g5, count(*) FILTER (k % 11 > 0 AND k % 3 = 0) AS g3, count(*) FILTER (k % 11 > 0 AND k % 7 = 0) AS g7, count(*) FILTER (k % 11 > 0 AND k % 4 = 0) AS g4 FROM o)
SELECT '$.status' AS path, 'STRING' AS expected, 'BIGINT' AS found, 'retyped' AS problem, g5 AS n_rows FROM n UNION ALL SELECT '$.date', 'STRING', NULL, 'absent', g3 + bad FROM n UNION ALL SELECT '$.detail.extra', NULL, 'BOOLEAN', 'new', g7 FROM n UNION ALL SELECT '$.lines[].n', 'BIGINT', 'STRING', 'retyped', g4 FROM n
UNION ALL SELECT '$.gone', 'STRING', NULL, 'absent', n FROM n UNION ALL SELECT '$', NULL, 'INVALID', 'new', bad FROM n UNION ALL SELECT p, t, NULL, 'absent', bad FROM n, (VALUES ('$.id', 'BIGINT'), ('$.status', 'STRING'), ('$.detail', 'OBJECT'), ('$.detail.price', 'DECIMAL'), ('$.lines', 'ARRAY'), ('$.lines[]', 'OBJECT'), ('$.lines[].n', 'BIGINT')) v(p, t)""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payloads of which some lack a key, have one more, or have one of another type; nulls drift from no type; some are no JSON."""
    k = F.col("o_orderkey")
    t = lambda c: c.cast("string")
    status = F.when(k % 5 == 0, t(k)).when(k % 5 == 1, "null").otherwise('"open"')
    date = F.when(k % 3 > 0, F.concat(F.lit(', "date": "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"'))).otherwise("")
    lines = F.concat(F.lit('[{"n": 1}, {"n": '), F.when(k % 4 == 0, '"two"').otherwise("2"), F.lit("}]"))
    body = F.concat(F.lit('{"id": '), t(k), F.lit(', "status": '), status, date, F.lit(', "detail": {"price": '), t(k), F.lit(".5"), F.when(k % 7 == 0, ', "extra": true').otherwise(""), F.lit('}, "lines": '), lines, F.when(k % 11 > 0, "}").otherwise(""))
    expected = [("$.id", "BIGINT"), ("$.status", "STRING"), ("$.date", "STRING"), ("$.detail", "OBJECT"), ("$.detail.price", "DECIMAL"), ("$.lines", "ARRAY"), ("$.lines[]", "OBJECT"), ("$.lines[].n", "BIGINT"), ("$.gone", "STRING")]
    return drift.payload_drift(table(spark, sf_dir, "orders").select(body.alias("body")), "body", spark.createDataFrame(expected, "path string, type string"))


@Q.add("""SELECT 'lines' AS stage, m AS reason, count(*) AS n_rows, CAST(sum(k) AS BIGINT) AS keys FROM (SELECT l_orderkey AS k, concat_ws(',', CASE WHEN l_partkey % 4 = 0 THEN 'part' END, CASE WHEN l_suppkey % 3 = 0 THEN 'supplier' END) AS m FROM lineitem) WHERE m <> '' GROUP BY 2
UNION ALL SELECT 'orders', 'date', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 6 = 0""")
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines and orders in one table, read back by stage and reason."""
    path, at = work_folder(spark, "quarantine"), F.lit("2024-01-01 00:00:00")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 4 > 0, F.col("l_partkey")).alias("part"), F.when(F.col("l_suppkey") % 3 > 0, F.col("l_suppkey")).alias("supplier"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 6 > 0, F.col("o_orderdate")).alias("date"))
    for stage, rows, fields in (("lines", li, ["part", "supplier"]), ("orders", orders, ["date"])):
        _, bad = require(rows, fields)
        partitioned.quarantine(bad, path, stage, F.array_join("missing", ","), at)
    key = F.coalesce(F.get_json_object("row", "$.l_orderkey"), F.get_json_object("row", "$.o_orderkey")).cast("long")
    return spark.read.parquet(path).groupBy("stage", "reason").agg(F.count("*").alias("n_rows"), F.sum(key).alias("keys"))


@Q.add(f"""WITH {G_SQL}, n AS (SELECT game_id, home_team_id, away_team_id, home_score + CASE WHEN CAST(game_id AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS h, away_score AS a FROM g WHERE status = 'FINAL')
SELECT game_id, CAST(h AS INT) AS final_home_points, CAST(a AS INT) AS final_away_points, h > a AS home_win, CAST(h - a AS INT) AS margin, 2 AS n_loads FROM n""")
def outcomes_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of all finished games after a load of some and an upsert of all, with corrected scores."""
    g, t = games(spark, sf_dir), VersionedTables(spark, work_folder(spark, "outcomes"))
    n = F.col("game_id").cast("long")
    t.publish({"outcomes": teams.outcomes(g.where(n % 2 == 0))})
    t.upsert("outcomes", teams.outcomes(g.withColumn("home_score", F.col("home_score") + F.when(n % 3 == 0, 1).otherwise(0))), ["game_id"])
    loads = t.log().agg(F.count("*").cast("int").alias("n_loads"))
    return t.read("outcomes").select("game_id", "final_home_points", "final_away_points", "home_win", "margin").crossJoin(F.broadcast(loads))
