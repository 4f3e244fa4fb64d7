"""Sources whose rows are read as a whole: team and rate sets, every shape of plays, venue and alias files, injury reports. The benchmark tables are written as the source would be and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crosswalk
from ..sinks.places import work_folder
from ..sources import dimensions, result_sets, silver
from .adapters import Queries, rounded, table
from .feeds import payload, result_set

Q = Queries()


@Q.add("""SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_custkey + k AS team_id, CASE k WHEN 0 THEN 'AAA' ELSE 'BBB' END AS team_abbreviation, CAST(80 + (o_orderkey + k) % 50 AS INT) AS pts, CAST((o_orderkey + k) % 40 AS INT) AS fgm, CAST(40 + (o_orderkey + k) % 50 AS INT) AS fga, CAST((o_orderkey + k) % 15 AS INT) AS fg3m, CAST(15 + (o_orderkey + k) % 20 AS INT) AS fg3a,
CAST((o_orderkey + k) % 20 AS INT) AS ftm, CAST(20 + (o_orderkey + k) % 10 AS INT) AS fta, CAST((o_orderkey + k) % 12 AS INT) AS oreb, CAST((o_orderkey + k) % 33 AS INT) AS dreb, CAST((o_orderkey + k) % 31 AS INT) AS ast, CASE WHEN o_orderkey % 6 > 0 THEN CAST((o_orderkey + k) % 11 AS INT) END AS stl, CAST((o_orderkey + k) % 9 AS INT) AS blk, CAST((o_orderkey + k) % 18 AS INT) AS "to", NULL::INT AS pf FROM orders, range(2) r(k)""")
def resultset_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both teams' statistics of each order as a game; a cell that is no number and a header that isn't there are null."""
    k = F.col("o_orderkey")
    heads = ["GAME_ID", "TEAM_ID", "TEAM_ABBREVIATION", "PTS", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "AST", "STL", "BLK", "TO"]
    def row(i: int):
        n = k + i
        cells = [k, F.col("o_custkey") + i, F.lit("AAA" if i == 0 else "BBB"), 80 + n % 50, n % 40, 40 + n % 50, n % 15, 15 + n % 20, n % 20, 20 + n % 10, n % 12, n % 33, n % 31, F.when(k % 6 > 0, (n % 11).cast("string")).otherwise("-"), n % 9, n % 18]
        return F.array(*[c.cast("string") for c in cells])
    o = table(spark, sf_dir, "orders").withColumn("rows", F.array(row(0), row(1)))
    t = result_sets.team_stats(o.select(payload(result_set("TeamStats", dict.fromkeys(heads), "rows")).alias("body")))
    return t.select(*[F.col(c).alias(c.lower()) for c in result_sets.TEAMS])


_pct = lambda a, m: f"round((c_custkey * {a} % {m}) / 1000.0, 6)::DOUBLE"


@Q.add(f"""SELECT CAST(c_nationkey AS VARCHAR) AS game_id, CAST(c_custkey % 30 AS VARCHAR) AS team_id, CAST(c_custkey AS VARCHAR) AS player_id, {_pct(7, 1000)} AS offensive_rating, {_pct(11, 1000)} AS defensive_rating, round({_pct(7, 1000)} - {_pct(11, 1000)}, 6) AS net_rating, CASE WHEN c_custkey % 5 > 0 THEN {_pct(13, 900)} END AS assist_pct, {_pct(17, 900)} AS assist_turnover_ratio, {_pct(19, 900)} AS offensive_rebound_pct,
{_pct(23, 900)} AS defensive_rebound_pct, {_pct(29, 900)} AS effective_fg_pct, {_pct(31, 900)} AS true_shooting_pct, {_pct(37, 900)} AS usage_pct, NULL::DOUBLE AS pace FROM customer""")
def resultset_advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advanced rates of each customer as a player."""
    return rounded(result_sets.rates(_rates(spark, sf_dir, "sqlPlayersAdvanced", True), "PlayersAdvanced", result_sets.ADVANCED))


@Q.add(f"""SELECT CAST(c_nationkey AS VARCHAR) AS game_id, CAST(c_custkey % 30 AS VARCHAR) AS team_id, {_pct(7, 1000)} AS offensive_rating, {_pct(11, 1000)} AS defensive_rating, round({_pct(7, 1000)} - {_pct(11, 1000)}, 6) AS net_rating, CASE WHEN c_custkey % 5 > 0 THEN {_pct(13, 900)} END AS assist_pct, {_pct(17, 900)} AS assist_turnover_ratio, {_pct(19, 900)} AS offensive_rebound_pct,
{_pct(23, 900)} AS defensive_rebound_pct, {_pct(29, 900)} AS effective_fg_pct, {_pct(31, 900)} AS true_shooting_pct, {_pct(37, 900)} AS usage_pct, NULL::DOUBLE AS pace FROM customer""")
def resultset_team_advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advanced rates by team."""
    return rounded(result_sets.rates(_rates(spark, sf_dir, "sqlTeamsAdvanced", False), "TeamsAdvanced", result_sets.ADVANCED, ("GAME_ID", "TEAM_ID")))


@Q.add("""SELECT CAST(c_nationkey AS VARCHAR) AS game_id, CAST(c_custkey % 30 AS VARCHAR) AS team_id, CAST(c_custkey AS VARCHAR) AS player_id, (c_custkey % 9)::DOUBLE AS points_off_turnovers, (c_custkey % 8)::DOUBLE AS second_chance_points, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END::DOUBLE AS fast_break_points, (c_custkey % 40)::DOUBLE AS points_in_paint FROM customer""")
def resultset_misc(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    cells = {"GAME_ID": F.col("c_nationkey"), "TEAM_ID": k % 30, "PLAYER_ID": k, "PTS_OFF_TOV": k % 9, "PTS_2ND_CHANCE": k % 8, "PTS_FB": F.when(k % 4 > 0, k % 7), "PTS_PAINT": k % 40, "NEW": k}
    return result_sets.rates(table(spark, sf_dir, "customer").select(payload(result_set("sqlPlayersMisc", cells)).alias("body")), "PlayersMisc", result_sets.MISC)


def _rates(spark: SparkSession, sf_dir: str, name: str, by_player: bool) -> DataFrame:
    k = F.col("c_custkey")
    pct = lambda a, m: ((k * a) % m) / 1000
    cells = {"GAME_ID": F.col("c_nationkey"), "TEAM_ID": k % 30} | ({"PLAYER_ID": k} if by_player else {})
    cells |= {"OFF_RATING": pct(7, 1000), "DEF_RATING": pct(11, 1000), "NET_RATING": F.round(pct(7, 1000) - pct(11, 1000), 6), "AST_PCT": F.when(k % 5 > 0, pct(13, 900))}
    cells |= {h: pct(a, 900) for h, a in (("AST_TOV", 17), ("OREB_PCT", 19), ("DREB_PCT", 23), ("EFG_PCT", 29), ("TS_PCT", 31), ("USG_PCT", 37))}
    return table(spark, sf_dir, "customer").select(payload(result_set(name, cells)).alias("body"))


@Q.add("""SELECT o_orderkey AS game_id, CAST(o_orderkey % 100 AS INT) AS event_num, CASE WHEN o_orderkey % 5 <> 3 THEN CAST(1 + o_orderkey % 4 AS INT) END AS period, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE '0' || CAST(o_orderkey % 10 AS VARCHAR) || ':00' END AS clock FROM orders
WHERE o_orderkey % 7 > 0 AND (o_orderkey % 4 = 3 OR o_orderkey % 5 <> 3) AND o_orderkey % 4 <> 2""")
def play_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays under either spelling, under a longer name, in rows that are too short, as a plain list, and some without a number or a period."""
    k = F.col("o_orderkey")
    t = lambda c: c.cast("string")
    number, period = F.when(k % 7 > 0, k % 100), F.when(k % 5 != 3, 1 + k % 4)
    clock = F.concat(F.lit("0"), t(k % 10), F.lit(":00"))
    cells = F.array(t(number), t(period), clock)
    heads = F.array(*map(F.lit, ("EVENTNUM", "PERIOD", "PCTIMESTRING")))
    one = lambda name, row: F.array(F.struct(F.lit(name).alias("name"), heads.alias("headers"), F.array(row).alias("rowSet")))
    shape = (
        F.when(k % 4 == 0, F.to_json(F.struct(one("PlayByPlay", cells).alias("resultSets")))).when(k % 4 == 1, F.to_json(F.struct(one("LivePlayByPlay2", cells).alias("ResultSets"))))
        .when(k % 4 == 2, F.to_json(F.struct(one("PlayByPlay", F.slice(cells, 1, 2)).alias("resultSets")))).otherwise(F.to_json(F.array(F.struct(number.alias("EVENTNUM"), period.alias("PERIOD")))))
    )
    p = result_sets.loose_plays(table(spark, sf_dir, "orders").select(k.alias("game_id"), shape.alias("body")))
    return p.select("game_id", F.col("EVENTNUM").alias("event_num"), F.col("PERIOD").alias("period"), F.col("PCTIMESTRING").alias("clock"))


@Q.add("""SELECT 'C' || CAST(c_custkey AS VARCHAR) AS team_id, c_name AS arena_name, 'America/Denver' AS arena_tz, (25 + c_custkey % 24)::DOUBLE AS lat, (-122.5 + c_custkey % 50)::DOUBLE AS lon, (c_custkey % 1800)::DOUBLE AS altitude_m FROM customer WHERE c_custkey % 6 > 0""")
def venue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues from a CSV file; a sixth of them without a number where one must be."""
    k = F.col("c_custkey")
    t = lambda c: c.cast("string")
    v = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), t(k)).alias("team_id"), F.col("c_name").alias("arena_name"), F.lit("America/Denver").alias("arena_tz"), F.when(k % 12 == 0, "north").otherwise(t(25 + k % 24)).alias("lat"), t(k % 50 - 122.5).alias("lon"), F.when(k % 12 != 6, t(k % 1800)).alias("altitude_m"))
    path = work_folder(spark, "venues")
    v.write.option("header", True).csv(path)
    return dimensions.venues(spark, path)


@Q.add("""SELECT n AS canonical, 'canonical' AS source, n AS alias FROM (SELECT 'N' || chr(CAST(65 + n_nationkey AS INT)) || 'X' AS n FROM nation) UNION ALL SELECT 'N' || chr(CAST(65 + n_nationkey AS INT)) || 'X', 'feed', n_name FROM nation UNION ALL SELECT 'N' || chr(CAST(65 + n_nationkey AS INT)) || 'X', 'feed', 'R' || CAST(n_regionkey AS VARCHAR) FROM nation""")
def alias_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team aliases from a text file of keys and lists, one key for each nation. The file is one row by nature."""
    key = F.concat(F.lit("N"), F.char(65 + F.col("n_nationkey")), F.lit("X"))
    part = F.concat(F.lit("  "), key, F.lit(":\n    feed: [\""), F.col("n_name"), F.lit("\", \"R"), F.col("n_regionkey").cast("string"), F.lit("\"]"))
    text = table(spark, sf_dir, "nation").agg(F.concat(F.lit("teams:\n"), F.array_join(F.array_sort(F.collect_list(part)), "\n"), F.lit("\n")).alias("value"))
    path = work_folder(spark, "aliases")
    text.write.text(path)
    return dimensions.team_aliases(spark, path)


@Q.add("""SELECT s_nationkey AS game_id, 'T' || CAST(s_suppkey % 30 AS VARCHAR) AS team_tricode, 'Ann ' || CASE s_suppkey % 3 WHEN 0 THEN 'Able' WHEN 1 THEN 'Baker' ELSE 'Cole' END AS player_display_name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS player_id, CASE s_suppkey % 5 WHEN 0 THEN 'QUESTIONABLE' WHEN 1 THEN 'OUT' WHEN 2 THEN 'DNP' WHEN 3 THEN 'ACTIVE' ELSE 'PROBABLE' END AS status,
CASE WHEN s_suppkey % 4 > 1 THEN 'knee ' || CAST(s_suppkey AS VARCHAR) END AS reason, CASE s_suppkey % 2 WHEN 0 THEN 'team_report' ELSE 'page_notes' END AS source, 'Ann' || CASE s_suppkey % 3 WHEN 0 THEN 'Able' WHEN 1 THEN 'Baker' ELSE 'Cole' END AS player_name_slug FROM supplier""")
def injury_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Injured players from teams' reports and from pages' notes."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    name = F.concat(F.lit("Ann "), F.when(k % 3 == 0, "Able").when(k % 3 == 1, "Baker").otherwise("Cole"))
    status = F.when(k % 5 == 0, "doubtful").when(k % 5 == 1, "Injured").when(k % 5 == 2, "4").when(k % 5 == 4, "2")
    reason = F.when(k % 4 > 1, F.concat(F.lit("knee "), k.cast("string"))).otherwise("")
    ids = [F.col("s_nationkey").alias("game_id"), F.concat(F.lit("t"), (k % 30).cast("string")).alias("team_tricode")]
    reports = s.where("s_suppkey % 2 = 0").select(*ids, F.array(F.struct(name.alias("name"), status.alias("status"), reason.alias("injury"), k.alias("player_id"))).alias("people"))
    notes = s.where("s_suppkey % 2 = 1").select(*ids, F.array(F.struct(name.alias("player"), status.alias("status"), reason.alias("reason"))).alias("people"))
    return silver.injuries(reports, "reports").unionByName(silver.injuries(notes, "notes"))


_page = """p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'twenty' ELSE '2023-24' END AS season, o_orderdate + INTERVAL 3 HOUR AS utc, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 3 = 0 THEN 'America/Los_Angeles' END AS tz FROM orders),
q AS (SELECT *, coalesce(tz, 'America/New_York') AS zone, CAST((utc AT TIME ZONE 'UTC') AT TIME ZONE coalesce(tz, 'America/New_York') AS DATE) AS derived FROM p), r AS (SELECT *, CASE k % 4 WHEN 0 THEN derived WHEN 1 THEN d ELSE d - CAST(k % 4 AS INT) END AS local FROM q),
s AS (SELECT *, CASE WHEN season = 'twenty' THEN 'season' WHEN abs(date_diff('day', derived, local)) > 1 THEN 'date' END AS problem FROM r)"""


def _page_games(spark: SparkSession, sf_dir: str):
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    t = F.col("o_orderdate").cast("timestamp_ntz").cast("timestamp") + F.expr("INTERVAL 3 HOURS")
    local = F.when(k % 4 == 1, d).when(k % 4 > 1, F.date_sub(d, (k % 4).cast("int")))
    rows = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("game_id"), F.when(k % 7 == 0, "twenty").otherwise("2023-24").alias("season"), t.alias("game_date_utc"), local.alias("game_date_local"), F.when(k % 3 == 0, "America/Los_Angeles").alias("arena_tz"),
        F.lit(" bos").alias("home_team"), F.lit("LAL").alias("away_team"), F.concat(F.date_format(d, "yyyyMMdd"), F.lit("0BOS")).alias("page_id"),
    )
    return silver.page_games(rows)


@Q.add(f"""WITH {_page} SELECT CAST(k AS VARCHAR) AS game_id, season, local AS game_date_local, zone AS arena_tz, 'BOS' AS home_team_tricode, 'LAL' AS away_team_tricode, strftime(d, '%Y%m%d') || '0BOS' AS page_id, strftime(local, '%Y%m%d') AS odds_join_key FROM s WHERE problem IS NULL""")
def page_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games from pages whose local date is given, missing, or off by a day."""
    return _page_games(spark, sf_dir)[0].drop("game_date_utc")


@Q.add(f"""WITH {_page} SELECT CAST(k AS VARCHAR) AS game_id, problem FROM s WHERE problem IS NOT NULL""")
def page_games_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games from pages without a season, or with a date that can't be right."""
    return _page_games(spark, sf_dir)[1].select("game_id", "problem")


@Q.add("""SELECT CAST(p_partkey AS VARCHAR) AS game_id, CASE p_partkey % 3 WHEN 0 THEN '20240101' || CAST(p_partkey AS VARCHAR) || 'BOS' WHEN 1 THEN 'http://x/teams/' || CAST(p_partkey AS VARCHAR) ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS page_id, CASE WHEN p_partkey % 3 = 2 THEN 'S' || CAST(p_size AS VARCHAR) END AS stats_id, NULL::VARCHAR AS other_id, CASE WHEN p_partkey % 3 = 2 THEN 'mapping' ELSE 'url' END AS source FROM part""")
def crosswalk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids across sources from a mapping, and from urls with and without an id."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    t = lambda c: c.cast("string")
    url = F.when(k % 3 == 0, F.concat(F.lit("http://x/boxscores/20240101"), t(k), F.lit("BOS.html"))).otherwise(F.concat(F.lit("http://x/teams/"), t(k)))
    urls = crosswalk.id_rows(p.where("p_partkey % 3 < 2").select(t(k).alias("game_id"), url.alias("url")), ["stats_id", "other_id"], "url")
    mapped = crosswalk.id_rows(p.where("p_partkey % 3 = 2").select(t(k).alias("game_id"), F.concat(F.lit("P"), t(k)).alias("page_id"), F.concat(F.lit("S"), t(F.col("p_size"))).alias("stats_id")), ["stats_id", "other_id"])
    return urls.unionByName(mapped)


@Q.add("""SELECT c_nationkey AS game_id, 'BOS' AS team_tricode, c_name AS player_display_name, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS player_id, CASE WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 10 WHEN 0 THEN 'PG' WHEN 2 THEN 'G' WHEN 4 THEN 'C' WHEN 6 THEN 'F' END ELSE CASE c_custkey % 3 WHEN 0 THEN 'SF' END END AS position, CASE WHEN c_custkey % 2 = 0 THEN 'stats' ELSE 'pages' END AS source FROM customer""")
def starter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starters from statistics, with positions in letters and in words, and from pages."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    at = F.when(k % 10 == 0, "pg").when(k % 10 == 2, "Guard").when(k % 10 == 4, "center").when(k % 10 == 6, "FORWARD").otherwise("wing")
    ids = [F.col("c_nationkey").alias("game_id"), F.lit("BOS").alias("team_tricode")]
    stats = silver.starters(c.where("c_custkey % 2 = 0").select(*ids, F.col("c_name").alias("PLAYER_NAME"), k.alias("PLAYER_ID"), at.alias("START_POSITION")), "stats")
    pages = silver.starters(c.where("c_custkey % 2 = 1").select(*ids, F.col("c_name").alias("player"), F.when(k % 3 == 0, "SF").otherwise("bench").alias("pos")), "pages")
    return stats.unionByName(pages).drop("player_name_slug")
