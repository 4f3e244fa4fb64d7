"""Shots, seasons and thresholds on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import seasons, shots
from .adapters import E_SQL, G_SQL, Queries, events, games, rounded, table

Q = Queries()
_zone = "CASE WHEN {d} <= 4 THEN 'RIM' WHEN {d} <= 10 THEN 'SHORT_MID' WHEN {d} <= 23 THEN 'LONG_MID' WHEN {d} IS NOT NULL THEN 'THREE' END"


@Q.add(f"""WITH {E_SQL}, s AS (SELECT game_id, CASE WHEN event_idx % 3 = 0 THEN -1 - event_idx ELSE event_idx END AS event_idx, event_idx % 200 AS x, event_idx % 90 AS y FROM e), j AS (SELECT e.game_id, e.event_idx, CASE WHEN event_type LIKE 'SHOT%' THEN s.x::DOUBLE END AS shot_x, CASE WHEN event_type LIKE 'SHOT%' THEN s.y::DOUBLE END AS shot_y FROM e LEFT JOIN s ON e.game_id = s.game_id AND e.event_idx = s.event_idx)
SELECT game_id, event_idx, shot_x, shot_y, round(sqrt(shot_x * shot_x + shot_y * shot_y) / 10, 6) AS shot_distance_ft, {_zone.format(d="(sqrt(shot_x * shot_x + shot_y * shot_y) / 10)")} AS shot_zone FROM j""")
def shot_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shot for each event; a third of them name an event that isn't there."""
    e = events(spark, sf_dir)
    number = F.when(F.col("event_idx") % 3 == 0, -1 - F.col("event_idx")).otherwise(F.col("event_idx"))
    s = e.select("game_id", number.alias("event_num"), (F.col("event_idx") % 200).alias("loc_x"), (F.col("event_idx") % 90).alias("loc_y"), F.lit(0).alias("shot_ordinal"))
    return rounded(shots.enrich(e, s).select("game_id", "event_idx", "shot_x", "shot_y", "shot_distance_ft", "shot_zone"))


@Q.add(f"""WITH {E_SQL}, z AS (SELECT *, {_zone.format(d="shot_distance_ft")} AS shot_zone FROM e WHERE event_type LIKE 'SHOT%')
SELECT shot_value, shot_zone, count(*) AS attempts, count(*) FILTER (event_type = 'SHOT_MADE') AS makes, round(avg(shot_distance_ft), 6) AS avg_distance_ft, round(100.0::DOUBLE * count(*) FILTER (event_type = 'SHOT_MADE') / count(*), 2) AS fg_pct FROM z GROUP BY 1, 2""")
def shot_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.numbers import shot_zone

    return rounded(shots.shares(events(spark, sf_dir).withColumn("shot_zone", shot_zone(F.col("shot_distance_ft"))), "shot_value", "shot_zone"))


@Q.add(f"""WITH {E_SQL}, g AS (SELECT game_id, count(*) AS n, count(*) FILTER (shot_x IS NOT NULL AND shot_y IS NOT NULL) AS p FROM e WHERE event_type LIKE 'SHOT%' GROUP BY 1) SELECT count(*) AS n_games, CAST(sum(n) AS BIGINT) AS n_shots, CAST(sum(p) AS BIGINT) AS n_placed, round(avg(p / n), 6) AS avg_share, round(min(p / n), 6) AS min_share FROM g""")
def shot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shots.coordinate_coverage(events(spark, sf_dir)))


@Q.add(f"""WITH {E_SQL}, g AS (SELECT game_id, count(*) FILTER (event_type = 'SUBSTITUTION') AS n FROM e GROUP BY 1) SELECT count(*) AS n_games, min(n) AS min_subs, round(avg(n), 6) AS avg_subs, max(n) AS max_subs FROM g""")
def substitution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shots.substitutions(events(spark, sf_dir)))


@Q.add("""SELECT l_orderkey AS game_id, l_suppkey % 3 AS team_id, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 5""")
def lineup_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots.lineup_sizes(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"), (F.col("l_suppkey") % 3).alias("team_id"), F.lit(1).alias("period")))


#: The query's own dependencies: what can be made from which type of event.
_NEEDS = "VALUES ('activity', 'view'), ('activity', 'click'), ('funnel', 'purchase'), ('health', 'error'), ('opening', 'signup'), ('opening', 'view')"


@Q.add(f"""SELECT CAST(user_id AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR) AS game_id, coalesce(string_agg(DISTINCT n.t, ',' ORDER BY n.t), '') AS tables FROM events LEFT JOIN ({_NEEDS}) n(t, s) ON event_type = n.s GROUP BY 1""")
def derivable_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day as a game, each of its events as a fetched source."""
    e = table(spark, sf_dir, "events")
    needs = spark.sql(f"SELECT * FROM {_NEEDS} AS n(table, source)")
    game = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.day("ts").cast("string"))
    return seasons.derivable_tables(e.select(game.alias("game_id"), F.col("event_type").alias("source")), needs)


_season = "CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0')"


@Q.add(f"""WITH o AS (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END AS y, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AS a, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40) AS b FROM orders)
SELECT {_season} AS season, count(*) AS n_games, count(*) FILTER (a) AS n_late, count(*) FILTER (b) AS n_large, count(*) FILTER (a AND b) AS n_complete, round(100.0 * count(*) FILTER (a AND b) / count(*), 6)::DOUBLE AS complete_pct FROM o GROUP BY 1""")
def season_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id"), dates.season_from_date(F.col("o_orderdate")).alias("season"))
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "game_id")
    return rounded(seasons.season_completeness(g, {"late": li.where("l_returnflag = 'A'"), "large": li.where("l_quantity > 40")}))


@Q.add(f"""WITH {G_SQL}, w AS (SELECT game_id FROM g UNION SELECT 'new' || CAST(n_nationkey AS VARCHAR) FROM nation) SELECT w.game_id, status FROM w LEFT JOIN g USING (game_id) WHERE status IS NULL OR status IN ('SCHEDULED', 'LIVE')""")
def reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir)
    wanted = g.select("game_id").unionByName(table(spark, sf_dir, "nation").select(F.concat(F.lit("new"), F.col("n_nationkey").cast("string")).alias("game_id")))
    return seasons.to_reprocess(wanted, g)


@Q.add(f"""WITH {E_SQL}, x AS (SELECT game_id, count(*) AS n, count(seconds_elapsed) AS t, max((period = 1)::INT) AS q1 FROM e GROUP BY 1), f AS (SELECT avg(q1)::DOUBLE AS a, 1.0::DOUBLE AS b, (sum(t) / sum(n))::DOUBLE AS c, NULL::DOUBLE AS d FROM x)
SELECT 'q1_share' AS metric, round(a, 6) AS value, 0.8::DOUBLE AS least, a >= 0.8 AS passes FROM f UNION ALL SELECT 'game_share', b, 0.9, b >= 0.9 FROM f UNION ALL SELECT 'time_share', round(c, 6), 0.95, c >= 0.95 FROM f UNION ALL SELECT 'score', 0.0, 0.95, false FROM f""")
def quality_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.integrity import coverage

    c = coverage(events(spark, sf_dir)).select("q1_share", F.lit(1.0).alias("game_share"), "time_share", F.lit(None).cast("double").alias("score"))
    return rounded(seasons.thresholds(c))


@Q.add("""SELECT CAST(c_nationkey AS VARCHAR) AS game_id, count(*) AS n_rows, count(*) FILTER (c_custkey % 3 = 0) AS n_failed, 2 * count(*) FILTER (c_custkey % 3 = 0) <= count(*) AS is_valid FROM customer GROUP BY 1""")
def minutes_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.element_at(F.array(F.lit("DNP"), F.lit("12:60"), F.lit("PT5M"), k.cast("string")), (k % 4 + 1).cast("int"))).when(k % 3 == 1, F.concat((k % 75).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"))).otherwise(F.when(k % 2 == 0, "0:00").otherwise(""))
    return seasons.minutes_valid(table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("game_id"), raw.alias("min")))


@Q.add(f"""WITH {G_SQL} SELECT game_id AS "GAME_ID", o AS home_team_id, a AS away_team_id, CASE WHEN k % 4 > 0 THEN '2024-01-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') END AS game_date_est, nullif(concat_ws(',', CASE WHEN k % 4 = 0 THEN 'date' END), '') AS missing FROM (SELECT game_id, CAST(substr(home_team_id, 2) AS BIGINT) AS o, CAST(substr(away_team_id, 2) AS BIGINT) AS a, CAST(game_id AS BIGINT) AS k FROM g)""")
def game_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads written from the games, every fourth without a summary, read back through the fallback chain."""
    from ..sources import result_sets

    g = games(spark, sf_dir)
    number = lambda c: F.expr(f"substring({c}, 2)")
    sets = lambda name, heads, rows: F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, heads)).alias("headers"), rows.alias("rowSet"))
    summary = sets("GameSummary", ["GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID"], F.array(F.array(F.col("game_id"), F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("game_id").cast("long") % 28).cast("string"), 2, "0")), number("home_team_id"), number("away_team_id"))))
    stats = sets("TeamStats", ["GAME_ID", "TEAM_ID"], F.array(F.array(F.col("game_id"), number("away_team_id")), F.array(F.col("game_id"), number("home_team_id"))))
    both, one = F.to_json(F.struct(F.array(summary, stats).alias("resultSets"))), F.to_json(F.struct(F.array(stats).alias("resultSets")))
    body = F.when(F.col("game_id").cast("long") % 4 == 0, one).otherwise(both)
    m = result_sets.game_meta(g.select(body.alias("body")))
    return m.select("GAME_ID", "home_team_id", "away_team_id", F.col("GAME_DATE_EST").alias("game_date_est"), F.nullif(F.array_join("missing", ","), F.lit("")).alias("missing"))
