"""Data-quality checks and keyed writes on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import integrity, manifest, sequence, teams, upsert
from ..streaming import incremental
from .adapters import E_SQL, G_SQL, Queries, events, games, rounded, table

Q = Queries()


def _half(df: DataFrame, key: str) -> DataFrame:
    """A parent table that lacks every fifth key, so that the checks have something to find."""
    return df.where(F.col(key) % 5 != 0)


_fk = lambda name, child, key, parent, pk: f"""SELECT '{name}' AS "table", count(*) AS total, count(*) FILTER (p.k IS NULL AND c.{key} IS NOT NULL) AS invalid, coalesce((SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) FROM (SELECT DISTINCT {key} AS x FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} % 5 <> 0) ORDER BY x LIMIT 10)), '') AS issues
FROM {child} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent} WHERE {pk} % 5 <> 0) p ON c.{key} = p.k"""  # noqa: E731
_FKS = [("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("orders", "orders", "o_custkey", "customer", "c_custkey"), ("supplier", "supplier", "s_nationkey", "nation", "n_nationkey")]


@Q.add(" UNION ALL ".join(_fk(*x) for x in _FKS))
def fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [integrity.fk_check(table(spark, sf_dir, c), _half(table(spark, sf_dir, p), pk), k, n, pk) for n, c, k, p, pk in _FKS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@Q.add("WITH c AS (" + " UNION ALL ".join(_fk(*x) for x in _FKS) + """) SELECT "table", total, invalid, round(greatest(0, 1 - coalesce(invalid / nullif(total, 0), 0)), 6)::DOUBLE AS score, greatest(0, 1 - coalesce(invalid / nullif(total, 0), 0)) >= 0.95 AS is_valid FROM c""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(integrity.summary(fk_check(spark, sf_dir)))


@Q.add("""SELECT 'lineitem' AS "table", l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY 2""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.orphans(table(spark, sf_dir, "lineitem"), _half(table(spark, sf_dir, "orders"), "o_orderkey").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "lineitem")


@Q.add("""SELECT * FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40) THEN 'large' END, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') THEN 'late' END) AS missing FROM orders) WHERE missing <> ''""")
def missing_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return integrity.missing_from(table(spark, sf_dir, "orders").select("o_orderkey"), {"late": li.where("l_returnflag = 'A'"), "large": li.where("l_quantity > 40")}, "o_orderkey")


@Q.add("""SELECT user_id, event_type, count(*) AS n_rows, string_agg(DISTINCT CAST(day(ts) AS VARCHAR), ', ' ORDER BY CAST(day(ts) AS VARCHAR)) AS days FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.expr("listagg(DISTINCT cast(day(ts) AS string), ', ') WITHIN GROUP (ORDER BY cast(day(ts) AS string))").alias("days")
    return integrity.duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"], days)


@Q.add("""SELECT * FROM (SELECT l_orderkey, lag(l_linenumber) OVER w AS prev_index, l_linenumber, l_linenumber - lag(l_linenumber) OVER w AS gap_size FROM (SELECT l_orderkey, l_linenumber + CASE WHEN (l_orderkey + l_suppkey) % 3 = 0 THEN 10 ELSE 0 END AS l_linenumber FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)) WHERE gap_size > 1""")
def index_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, a third of them with a number that is ten too high."""
    shifted = F.col("l_linenumber") + F.when((F.col("l_orderkey") + F.col("l_suppkey")) % 3 == 0, 10).otherwise(0)
    return integrity.index_gaps(table(spark, sf_dir, "lineitem").select("l_orderkey", shifted.alias("l_linenumber")), ["l_orderkey"], "l_linenumber")


@Q.add("""SELECT user_id, event_id, p AS prev_value, value, d AS time_diff FROM (SELECT user_id, event_id, value, lag(value) OVER w AS p, value - lag(value) OVER w AS d FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE d < -5""")
def clock_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.clock_regressions(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value")


@Q.add(f"""WITH {E_SQL}, b AS (SELECT game_id, period, min(event_idx) AS first_index, max(event_idx) AS last_index FROM e WHERE period BETWEEN 1 AND 4 GROUP BY 1, 2) SELECT a.game_id, a.period, a.last_index, b.first_index AS next_first FROM b a JOIN b ON a.game_id = b.game_id AND b.period = a.period + 1 AND a.last_index >= b.first_index""")
def period_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.boundary_overlaps(events(spark, sf_dir), ["game_id"], "period", "event_idx")


@Q.add("""SELECT c.c_nationkey AS nationkey, c.n AS l_n, s.n AS r_n FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON c.c_nationkey = s.s_nationkey WHERE c.n <> s.n""")
def mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda t, k: table(spark, sf_dir, t).groupBy(F.col(k).alias("nationkey")).agg(F.count("*").alias("n"))
    return integrity.mismatches(n("customer", "c_nationkey"), n("supplier", "s_nationkey"), "nationkey", ["n"])


@Q.add(f"""WITH {E_SQL}, x AS (SELECT game_id, count(*) AS n, count(seconds_elapsed) AS t, max((period = 1)::INT) AS q1, max((period = 4)::INT) AS q4 FROM e GROUP BY 1)
SELECT count(*) AS n_games, CAST(sum(n) AS BIGINT) AS n_events, round(sum(t) / sum(n), 6) AS time_share, round(avg(q1), 6) AS q1_share, round(avg(q4), 6) AS q4_share, round(avg(n), 6) AS events_per_game FROM x""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(integrity.coverage(events(spark, sf_dir)))


@Q.add(f"""WITH {E_SQL}, x AS (SELECT game_id, count(*) AS n_events, avg((seconds_elapsed IS NOT NULL)::INT) AS elapsed_share, avg((shot_x IS NOT NULL AND shot_y IS NOT NULL)::INT) FILTER (event_type LIKE 'SHOT%') AS coordinate_share FROM e GROUP BY 1)
SELECT game_id, n_events, round(elapsed_share, 6) AS elapsed_share, round(coordinate_share, 6) AS coordinate_share, n_events >= 400 AND elapsed_share >= 0.75 AND coalesce(coordinate_share >= 0.8, true) AS passes FROM x""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    shots = e.where("event_type in ('SHOT_MADE', 'SHOT_MISSED')").select("game_id", F.col("shot_x").alias("loc_x"), F.col("shot_y").alias("loc_y"))
    return rounded(integrity.complete_games(e, shots))


@Q.add("""SELECT 'events' AS "table", max(ts) AS latest, count(*) FILTER (ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS) AS n_recent, max(ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOURS AS is_fresh FROM events
UNION ALL SELECT 'orders', max(o_orderdate), count(*) FILTER (o_orderdate > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS), max(o_orderdate) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOURS FROM orders""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, o = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp_ntz")), table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp_ntz"))
    return integrity.freshness({"events": (e, "at"), "orders": (o, "at")}, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


@Q.add(f"""WITH {E_SQL}, h AS (SELECT 'games' AS "check", count(DISTINCT game_id) AS n FROM e UNION ALL SELECT 'thin_games', count(*) FROM (SELECT game_id FROM e GROUP BY 1 HAVING count(*) < 70) UNION ALL SELECT 'no_team', count(*) FROM e WHERE team_tricode IS NULL UNION ALL SELECT 'no_clock', count(*) FROM e WHERE clock_ms_remaining IS NULL UNION ALL SELECT 'bad_ids', count(*) FROM e WHERE NOT regexp_matches(game_id, '^\\d{{10}}$')
UNION ALL SELECT 'duplicate_idx', count(*) FROM (SELECT 1 FROM e GROUP BY game_id, event_idx HAVING count(*) > 1)) SELECT * FROM h""")
def health_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.health(events(spark, sf_dir), 70)


@Q.add("""SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_games FROM orders GROUP BY 1""")
def health_games_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n_games"))


_figures = """count(*) AS n_events, count(*) FILTER (nth = 2) AS repeated, count(*) FILTER (team_tricode IS NULL) AS no_team, count(*) FILTER (seconds_elapsed IS NULL) AS no_clock, count(*) FILTER (shot) AS n_shots, count(*) FILTER (shot AND shot_x IS NULL) AS no_place, 0 AS bad_ids,
  count(*) FILTER (season NOT IN ('2023-24', 'UNKNOWN')) AS other_season, count(*) FILTER (season IS NULL OR season = 'UNKNOWN') AS no_season"""
_sides = "(SELECT game_id, day, status, team_tricode, count(DISTINCT player1_name_slug) FILTER (period = 1) AS players FROM s WHERE team_tricode IS NOT NULL GROUP BY 1, 2, 3, 4)"
_sizes = "(SELECT game_id, day, status, count(*) AS n FROM s GROUP BY 1, 2, 3)"
_part = lambda name, key: f"""SELECT '{name}' AS dimension, f.value, f.* EXCLUDE (value), (SELECT count(*) FROM {_sides} x WHERE x.players <> 5 AND {key.format('x')}) AS bad_lineups, (SELECT count(*) FROM {_sizes} z WHERE {key.format('z')}) AS n_games, (SELECT count(*) FROM {_sizes} z WHERE z.n < 60 AND {key.format('z')}) AS thin_games, (SELECT count(*) FROM {_sizes} z WHERE z.n > 70 AND {key.format('z')}) AS dense_games"""


@Q.add(f"""WITH {E_SQL}, d AS (SELECT *, CAST(right(game_id, 5) AS INT) AS u FROM e), s AS (SELECT *, DATE '2024-01-01' + u % 30 AS day, CASE u % 3 WHEN 0 THEN 'FINAL' WHEN 1 THEN 'LIVE' ELSE 'Final' END AS status, CASE u % 5 WHEN 0 THEN '2022-23' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN NULL ELSE '2023-24' END AS season, event_type IN ('SHOT_MADE', 'SHOT_MISSED') AS shot,
  row_number() OVER (PARTITION BY game_id, event_idx ORDER BY event_idx) AS nth FROM d),
t AS (SELECT team_tricode AS value, {_figures} FROM s GROUP BY 1), n AS (SELECT game_id, count(*) AS n FROM s GROUP BY 1), tg AS (SELECT DISTINCT game_id, team_tricode FROM s)
{_part("all", "true")} FROM (SELECT NULL AS value, {_figures} FROM s) f UNION ALL {_part("day", "CAST({}.day AS VARCHAR) = f.value")} FROM (SELECT CAST(day AS VARCHAR) AS value, {_figures} FROM s GROUP BY 1) f
UNION ALL {_part("status", "{}.status = f.value")} FROM (SELECT status AS value, {_figures} FROM s GROUP BY 1) f UNION ALL {_part("game_id", "{}.game_id = f.value")} FROM (SELECT game_id AS value, {_figures} FROM s GROUP BY 1) f
UNION ALL SELECT 'team_tricode', t.value, t.* EXCLUDE (value), (SELECT count(*) FROM {_sides} x WHERE x.players <> 5 AND x.team_tricode = t.value), (SELECT count(*) FROM tg WHERE tg.team_tricode IS NOT DISTINCT FROM t.value), (SELECT count(*) FROM tg JOIN n USING (game_id) WHERE n.n < 60 AND tg.team_tricode IS NOT DISTINCT FROM t.value), (SELECT count(*) FROM tg JOIN n USING (game_id) WHERE n.n > 70 AND tg.team_tricode IS NOT DISTINCT FROM t.value) FROM t""")
def health_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check's figures by day, status, game and team. Games of two statuses and seasons of three kinds; some casings and seasons are wrong on purpose."""
    u = F.substring("game_id", 6, 5).cast("int")
    e = events(spark, sf_dir).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), u % 30)).withColumn("status", F.when(u % 3 == 0, "FINAL").when(u % 3 == 1, "LIVE").otherwise("Final"))
    e = e.withColumn("season", F.when(u % 5 == 0, "2022-23").when(u % 5 == 1, "UNKNOWN").when(u % 5 > 2, "2023-24"))
    return integrity.health_suite(e, ["day", "status"], 60, 70).drop("clock_pct", "place_pct")


@Q.add(f"""WITH {E_SQL}, c AS (SELECT game_id, round(100.0 * count(seconds_elapsed) / count(*), 2)::DOUBLE AS coverage_pct, count(*) AS n_events FROM e GROUP BY 1) SELECT * FROM c ORDER BY coverage_pct, n_events DESC, game_id LIMIT 20""")
def health_worst_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty games with the worst clocks: a report."""
    c = events(spark, sf_dir).groupBy("game_id").agg(F.round(100.0 * F.count("seconds_elapsed") / F.count("*"), 2).alias("coverage_pct"), F.count("*").alias("n_events"))
    return c.orderBy("coverage_pct", F.desc("n_events"), "game_id").limit(20)


@Q.add(f"""WITH {E_SQL}, f AS (SELECT *, event_type IN ('SHOT_MADE', 'SHOT_MISSED') AS shot FROM e),
x AS (SELECT game_id, count(*) AS total_events, count(*) FILTER (shot) AS shot_events, CASE WHEN count(*) FILTER (shot) > 0 THEN 100.0 * count(*) FILTER (shot AND shot_x IS NOT NULL AND shot_y IS NOT NULL) / count(*) FILTER (shot) ELSE 0 END::DOUBLE AS cc,
  bool_or(shot AND shot_distance_ft IS NULL) AS f0, bool_or(shot AND shot_x IS NULL) AS f1, bool_or(team_tricode IS NULL) AS f2, bool_or(player1_name_slug IS NULL) AS f3 FROM f GROUP BY 1)
SELECT game_id, total_events, shot_events, round(cc, 6) AS coordinate_coverage, concat_ws('; ', CASE WHEN f3 THEN 'Missing player attribution' END, CASE WHEN f1 THEN 'Missing shot coordinates' END, CASE WHEN f0 THEN 'Missing shot distance' END, CASE WHEN f2 THEN 'Missing team attribution' END) AS missing_data_flags,
  round(greatest(0, least(100, (100.0::DOUBLE - 10 * (f0::INT + f1::INT + f2::INT + f3::INT)) * cc / 100 * CASE WHEN total_events < 200 THEN 0.8 ELSE 1 END * CASE WHEN shot_events < 50 THEN 0.9 ELSE 1 END)), 6)::DOUBLE AS quality_score FROM x""")
def game_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(integrity.game_quality(events(spark, sf_dir)))


@Q.add(f"""WITH {E_SQL}, c AS (SELECT event_type, count(*) AS n_rows FROM e GROUP BY 1) SELECT event_type, n_rows, round(100.0 * n_rows / sum(n_rows) OVER (), 6)::DOUBLE AS pct, round(avg(n_rows) OVER (), 6)::DOUBLE AS avg_rows FROM c""")
def pct_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(integrity.percent_of_total(events(spark, sf_dir), "event_type"))


@Q.add(f"""WITH {E_SQL} SELECT game_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS types, coalesce(array_to_string(list_sort(list_distinct(list(player1_name_slug) FILTER (event_type = 'FOUL' AND player1_name_slug IS NOT NULL))), ','), '') AS foulers FROM e GROUP BY 1""")
def string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).groupBy("game_id").agg(F.expr("listagg(DISTINCT event_type, ', ') WITHIN GROUP (ORDER BY event_type)").alias("types"), F.expr("collect_set(player1_name_slug) FILTER (WHERE event_type = 'FOUL')").alias("p"))
    return e.select("game_id", "types", F.array_join(F.array_sort("p"), ",").alias("foulers"))


@Q.add(f"""WITH {E_SQL}, p AS (SELECT game_id, team_tricode, count(*) FILTER (event_type = 'REBOUND') AS reb, CAST(coalesce(sum(shot_value) FILTER (event_type = 'SHOT_MADE'), 0) AS BIGINT) AS pts FROM e WHERE team_tricode IS NOT NULL AND player1_name_slug IS NOT NULL GROUP BY 1, 2),
t AS (SELECT game_id, team_tricode, count(*) FILTER (event_type = 'REBOUND') AS reb, CAST(coalesce(sum(shot_value) FILTER (event_type = 'SHOT_MADE'), 0) AS BIGINT) AS pts FROM e WHERE team_tricode IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT game_id, team_tricode, 'reb' AS stat, p.reb::DOUBLE AS players_sum, t.reb::DOUBLE AS team_total FROM p JOIN t USING (game_id, team_tricode) UNION ALL SELECT game_id, team_tricode, 'pts', p.pts::DOUBLE, t.pts::DOUBLE FROM p JOIN t USING (game_id, team_tricode)) WHERE abs(players_sum - team_total) > 1""")
def box_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("team_tricode is not null")
    stats = [F.count_if(F.col("event_type") == "REBOUND").alias("reb"), F.coalesce(F.sum(F.when(F.col("event_type") == "SHOT_MADE", F.col("shot_value"))), F.lit(0)).alias("pts")]
    players = e.where("player1_name_slug is not null").groupBy("game_id", "team_tricode", "player1_name_slug").agg(*stats)
    return integrity.box_mismatch(players, e.groupBy("game_id", "team_tricode").agg(*stats), ["game_id", "team_tricode"], ["reb", "pts"])


def _changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    old = c.where("c_custkey % 7 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal")))
    return old, c.where("c_custkey % 3 = 0")


@Q.add("""WITH o AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
  CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'kept' WHEN o.c_name IS DISTINCT FROM n.c_name OR o.c_acctbal IS DISTINCT FROM n.c_acctbal THEN 'update' ELSE 'unchanged' END AS _action FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(*_changed(spark, sf_dir), ["c_custkey"])


@Q.add("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 3 = 0""")
def upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.overwrite_keys(*_changed(spark, sf_dir), ["c_custkey"])


@Q.add("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""")
def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.keep_latest(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderdate")


@Q.add("""SELECT 'lineitem' AS "table", count(*) AS n_before, count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 0)) AS n_after FROM lineitem UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_custkey % 10 <> 0) FROM orders""")
def delete_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    _, counts = upsert.delete_cascade({"lineitem": table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key"), "orders": o}, "key", o.where("o_custkey % 10 = 0"))
    return counts


@Q.add(f"""WITH {G_SQL} SELECT game_id, home_team_id, status FROM g WHERE status = 'FINAL' AND game_date_local BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND (home_team_id IN ('C1', 'C2', 'C3', 'C4') OR away_team_id IN ('C1', 'C2', 'C3', 'C4'))""")
def game_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import date

    return teams.select_games(games(spark, sf_dir), teams=["C1", "C2", "C3", "C4"], since=date(1996, 1, 1), until=date(1997, 12, 31)).select("game_id", "home_team_id", "status")


def _manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("game_id"), "event_type", (F.col("event_id") % 3 != 0).alias("ok"), F.col("event_id").alias("size"), (F.col("event_id") % 2).alias("part"))
    def build(part: int) -> DataFrame:
        g = e.where(F.col("part") == part).groupBy("game_id", "event_type").agg(F.max("ok").alias("ok"), F.sum("size").alias("bytes"))
        got = F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", F.struct("ok", "bytes").alias("v")))))
        return g.groupBy("game_id").agg(got.alias("endpoints"), F.when(F.count("*") < 5, F.array(F.lit("short"))).otherwise(F.array().cast("array<string>")).alias("errors"))
    return build(0), build(1)


_man = """x AS (SELECT CAST(user_id AS VARCHAR) AS game_id, event_type, event_id % 2 AS part, bool_or(event_id % 3 <> 0) AS ok, CAST(sum(event_id) AS BIGINT) AS bytes FROM events GROUP BY 1, 2, 3),
m AS (SELECT game_id, event_type, max_by(ok, part) AS ok, max_by(bytes, part) AS bytes FROM x GROUP BY 1, 2),
er AS (SELECT game_id, sum((k < 5)::INT) AS n_err FROM (SELECT game_id, part, count(*) AS k FROM x GROUP BY 1, 2) GROUP BY 1)"""


@Q.add(f"""WITH {_man}, g AS (SELECT game_id, count(*) FILTER (ok) AS n_ok, sum(bytes) AS b FROM m GROUP BY 1) SELECT count(*) AS n_games, count(*) FILTER (n_ok >= 2 AND n_err = 0) AS n_good, CAST(sum(b) AS BIGINT) AS n_bytes, round(count(*) FILTER (n_ok >= 2 AND n_err = 0) / count(*), 6)::DOUBLE AS success_rate FROM g JOIN er USING (game_id)""")
def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(manifest.rollup(manifest.merge_manifest(*_manifests(spark, sf_dir))))


@Q.add(f"WITH {_man} SELECT event_type AS endpoint, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed, CAST(sum(bytes) AS BIGINT) AS n_bytes FROM m GROUP BY 1")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.by_endpoint(manifest.merge_manifest(*_manifests(spark, sf_dir)))


@Q.add("""SELECT event_id, user_id FROM events WHERE lpad(CAST(event_id AS VARCHAR), 12, '0') > lpad(CAST((SELECT max(event_id) FROM events WHERE day(ts) <= 10) AS VARCHAR), 12, '0')""")
def watermark_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("mark_key", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    marks = e.where("day(ts) <= 10").agg(F.max("mark_key").alias("value")).select(F.lit("daily").alias("stage"), F.lit("events").alias("key"), "value")
    return incremental.after_watermark(e, "mark_key", marks, "daily", "events").select("event_id", "user_id")


@Q.add("""SELECT CAST(d AS DATE) AS first_day, least(CAST(d AS DATE) + 6, CAST(hi AS DATE)) AS last_day FROM (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events), generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY) t(d)""")
def backfill_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    return r.select(F.explode(incremental.chunks(F.col("lo"), F.col("hi"), 7)).alias("c")).select(F.col("c.first").alias("first_day"), F.col("c.last").alias("last_day"))


@Q.add("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n_rows, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY 1, 2""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming aggregate on a batch of all events; tests run it as a stream."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rounded(incremental.windowed_counts(e, "ts", "event_type"), 4).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
