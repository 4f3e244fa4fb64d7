"""Sources by entity, books, codes, dates and increments on the benchmark tables: each row is written as its source would write it and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock, codes, dates, numbers, text
from ..operators import integrity, seasons, teams, upsert
from ..sources import dimensions, game_books, pages, result_sets, silver
from ..streaming import incremental
from .adapters import E_SQL, G_SQL, Queries, events, games, rounded, spread, table

Q = Queries()


def result_set(name: str, cells: dict[str, Column], rows: str | None = None) -> Column:
    """A result set of one row of cells, or of the rows that were collected in column rows."""
    row = F.array(F.array(*[c.cast("string") for c in cells.values()])) if rows is None else F.col(rows)
    return F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, cells)).alias("headers"), row.alias("rowSet"))


def payload(*sets: Column) -> Column:
    return F.to_json(F.struct(F.array(*sets).alias("resultSets")))


def collected(rows: DataFrame, key: Column, name: str, cells: Callable[[Callable[[str], Column]], dict[str, Column]], order: str) -> DataFrame:
    """(game_id, body): one payload for each key. cells: the cells of a row by the columns that it asks for; only those columns move, and texts are made where a payload's rows have met."""
    used = [order]
    heads = list(cells(lambda c: used.append(c) or F.col(c)))
    each = rows.select(key.alias("game_id"), *dict.fromkeys(used)).repartition("game_id").groupBy("game_id").agg(F.collect_list(F.struct(*dict.fromkeys(used))).alias("rs"))
    texts = F.transform("rs", lambda x: F.struct(x[order].alias("o"), F.array(*[c.cast("string") for c in cells(lambda c: x[c]).values()]).alias("r")))
    return each.select("game_id", F.transform(F.array_sort(texts), lambda x: x["r"]).alias("rs")).select("game_id", payload(result_set(name, dict.fromkeys(heads), "rs")).alias("body"))


@Q.add("""SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(year(o_orderdate) AS VARCHAR) AS season, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS game_date_est, o_custkey AS home_team_id, o_custkey + 1 AS away_team_id, CASE WHEN o_orderkey % 5 = 0 THEN 'Unknown' ELSE o_orderstatus END AS status,
CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 40 END AS INT) AS home_team_wins, 0 AS home_team_losses, 0 AS away_team_wins, 0 AS away_team_losses, o_orderpriority AS arena_name, CAST(o_orderkey % 20000 AS INT) AS attendance, NULL::VARCHAR AS game_time FROM orders WHERE o_orderkey % 11 <> 0""")
def silver_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cells = {
        "GAME_ID": F.when(k % 11 != 0, k), "SEASON": F.year("o_orderdate"), "GAME_DATE_EST": F.when(k % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")), "HOME_TEAM_ID": F.col("o_custkey"), "VISITOR_TEAM_ID": F.col("o_custkey") + 1,
        "GAME_STATUS_TEXT": F.when(k % 5 != 0, F.col("o_orderstatus")), "HOME_TEAM_WINS": F.when(k % 3 != 0, k % 40), "ARENA_NAME": F.col("o_orderpriority"), "ATTENDANCE": k % 20000,
    }
    return silver.project(table(spark, sf_dir, "orders").select(payload(result_set("GameSummary", cells)).alias("body")), "games")


@Q.add("""SELECT l_orderkey AS game_id, l_linenumber AS event_num, CAST(l_linenumber % 4 + 1 AS INT) AS period, CAST(l_suppkey % 12 AS VARCHAR) || ':00' AS clock, CAST(l_suppkey % 20 AS INT) AS event_type, CAST(l_partkey % 7 AS INT) AS event_subtype, l_partkey AS player1_id, l_returnflag AS player1_name, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END AS player2_id, l_linestatus AS player2_name, NULL::BIGINT AS player3_id,
'P' || CAST(l_linenumber AS VARCHAR) AS player3_name, l_suppkey AS team_id, CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS home_description, CASE WHEN l_linestatus <> 'O' THEN l_returnflag END AS away_description, NULL::VARCHAR AS neutral_description, CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' - ' || CAST(l_linenumber AS VARCHAR) AS score, CASE WHEN l_suppkey % 3 = 0 THEN 'TIE' ELSE CAST(l_linenumber AS VARCHAR) END AS score_margin FROM lineitem WHERE l_linenumber % 4 <> 0""")
def silver_pbp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of plays, two of which the source doesn't have."""
    t = lambda c: c.cast("string")
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        n, s = c("l_linenumber"), c("l_suppkey")
        return {
            "EVENTNUM": F.when(n % 4 != 0, n), "PERIOD": n % 4 + 1, "PCTIMESTRING": F.concat(t(s % 12), F.lit(":00")), "EVENTMSGTYPE": s % 20, "EVENTMSGACTIONTYPE": c("l_partkey") % 7, "PLAYER1_ID": c("l_partkey"), "PLAYER1_NAME": c("l_returnflag"), "PLAYER2_ID": F.when(s % 2 == 0, s), "PLAYER2_NAME": c("l_linestatus"),
            "PLAYER3_NAME": F.concat(F.lit("P"), t(n)), "PLAYER1_TEAM_ID": s, "HOMEDESCRIPTION": F.when(c("l_linestatus") == "O", c("l_returnflag")), "VISITORDESCRIPTION": F.when(c("l_linestatus") != "O", c("l_returnflag")), "SCORE": F.concat(t(c("l_quantity").cast("int")), F.lit(" - "), t(n)), "SCOREMARGIN": F.when(s % 3 == 0, "TIE").otherwise(t(n)),
        }

    return silver.project(collected(table(spark, sf_dir, "lineitem"), F.col("l_orderkey"), "PlayByPlay", cells, "l_linenumber"), "pbp")


@Q.add("""SELECT l_orderkey AS game_id, l_partkey AS player_id, l_returnflag AS player_name, l_suppkey AS team_id, 'Team ' || CAST(l_suppkey % 30 AS VARCHAR) AS team_name, l_linenumber AS period, CAST(l_suppkey % 12 AS INT) AS minutes_remaining, CAST(l_partkey % 60 AS INT) AS seconds_remaining, 'Made Shot' AS event_type, 'Jump' AS action_type, CASE WHEN l_suppkey % 3 = 0 THEN '3PT' ELSE '2PT' END AS shot_type, l_linestatus AS shot_zone_basic, NULL::VARCHAR AS shot_zone_area,
CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' ft.' AS shot_zone_range, CAST(l_quantity AS INT) AS shot_distance, CAST(l_partkey % 500 - 250 AS INT) AS loc_x, CAST(l_suppkey % 400 - 50 AS INT) AS loc_y, CAST((l_returnflag = 'A')::INT AS INT) AS shot_made_flag, CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE 1 END AS shot_attempted_flag, l_linestatus AS htm, 'V' || CAST(l_suppkey % 30 AS VARCHAR) AS vtm FROM lineitem WHERE l_partkey % 9 <> 0""")
def silver_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of shots, one of which the source doesn't have, and one with a default."""
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        pk, s, q = c("l_partkey"), c("l_suppkey"), c("l_quantity").cast("int")
        return {
            "PLAYER_ID": F.when(pk % 9 != 0, pk), "PLAYER_NAME": c("l_returnflag"), "TEAM_ID": s, "TEAM_NAME": F.concat(F.lit("Team "), (s % 30).cast("string")), "PERIOD": c("l_linenumber"), "MINUTES_REMAINING": s % 12, "SECONDS_REMAINING": pk % 60, "EVENT_TYPE": F.lit("Made Shot"), "ACTION_TYPE": F.lit("Jump"),
            "SHOT_TYPE": F.when(s % 3 == 0, "3PT").otherwise("2PT"), "SHOT_ZONE_BASIC": c("l_linestatus"), "SHOT_ZONE_RANGE": F.concat(q.cast("string"), F.lit(" ft.")), "SHOT_DISTANCE": q, "LOC_X": pk % 500 - 250, "LOC_Y": s % 400 - 50, "SHOT_MADE_FLAG": (c("l_returnflag") == "A").cast("int"), "SHOT_ATTEMPTED_FLAG": F.when(s % 4 == 0, 0),
            "HTM": c("l_linestatus"), "VTM": F.concat(F.lit("V"), (s % 30).cast("string")),
        }

    return silver.project(collected(table(spark, sf_dir, "lineitem"), F.col("l_orderkey"), "Shot_Chart_Detail", cells, "l_linenumber"), "shots")


_official = "SELECT s_nationkey AS game_id, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS official_id, 'A' AS first_name, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS last_name, CAST(s_suppkey % 90 AS VARCHAR) AS jersey_num FROM supplier WHERE {}(s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0)"


def _officials(spark: SparkSession, sf_dir: str) -> DataFrame:
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        k = c("s_suppkey")
        return {"OFFICIAL_ID": F.when(k % 3 != 0, k), "FIRST_NAME": F.lit("A"), "LAST_NAME": F.when(k % 2 == 0, c("s_name")), "JERSEY_NUM": k % 90}

    return collected(table(spark, sf_dir, "supplier"), F.col("s_nationkey"), "Officials", cells, "s_suppkey")


@Q.add(_official.format(""))
def silver_officials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.project(_officials(spark, sf_dir), "officials")


@Q.add(_official.format("NOT "))
def silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Officials without id and last name, for a quarantine table."""
    return silver.rejected(_officials(spark, sf_dir), "officials")


@Q.add("""SELECT c_nationkey AS game_id, CAST(c_custkey % 2 AS BIGINT) AS team_id, c_mktsegment AS team_city, c_custkey AS player_id, c_name AS player_name, CASE WHEN c_custkey % 5 <> 0 THEN 'G' END AS position, c_acctbal AS age FROM customer WHERE c_custkey % 7 <> 0""")
def silver_starters(spark: SparkSession, sf_dir: str) -> DataFrame:
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        k = c("c_custkey")
        return {"TEAM_ID": F.when(k % 7 != 0, k % 2), "TEAM_CITY": c("c_mktsegment"), "PLAYER_ID": k, "PLAYER_NAME": c("c_name"), "POSITION": F.when(k % 5 != 0, "G"), "AGE": c("c_acctbal")}

    p = collected(table(spark, sf_dir, "customer"), F.col("c_nationkey"), "StartingLineup", cells, "c_custkey")
    return silver.project(p, "starters").select("game_id", "team_id", "team_city", "player_id", "player_name", "position", "age")


@Q.add("""SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_orderkey % 4 AS INT) AS status_id, o_custkey AS home_team_id FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderkey % 2 = 0""")
def scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games of the regular season, told by number or by name; those without an id are no games."""
    k = F.col("o_orderkey")
    cells = {"GAME_ID": F.when(k % 6 != 0, k), "GAME_STATUS_ID": k % 4, "HOME_TEAM_ID": F.col("o_custkey"), "SEASON_TYPE": F.when(k % 4 == 0, "2").when(k % 4 == 2, "Regular Season").otherwise("Playoffs")}
    s = result_sets.scoreboard(table(spark, sf_dir, "orders").select(payload(result_set("GameHeader", cells)).alias("body")), regular_only=True)
    return s.select(F.col("GAME_ID").alias("game_id"), F.col("GAME_STATUS_ID").alias("status_id"), F.col("HOME_TEAM_ID").alias("home_team_id"))


@Q.add("""SELECT CAST(o_orderkey AS VARCHAR) AS game_id, strftime(o_orderdate, '%Y-%m-%d') AS game_date, o_custkey AS home_team_id FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 10 <> 0""")
def resultset_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cells = {"GAME_ID": k, "GAME_DATE_EST": F.when(k % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")), "HOME_TEAM_ID": F.col("o_custkey"), "VISITOR_TEAM_ID": F.when(k % 10 != 0, F.lit(5))}
    g = result_sets.games(table(spark, sf_dir, "orders").select(payload(result_set("GameSummary", cells)).alias("body")))
    return g.select(F.col("GAME_ID").alias("game_id"), F.col("GAME_DATE_EST").alias("game_date"), F.col("HOME_TEAM_ID").alias("home_team_id"))


@Q.add("""SELECT c_nationkey AS nation, c_custkey AS player_id, c_name AS player_name, substr(c_mktsegment, 1, 1) AS position FROM customer WHERE c_custkey % 3 = 1""")
def resultset_starters(spark: SparkSession, sf_dir: str) -> DataFrame:
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        k = c("c_custkey")
        return {"PLAYER_ID": k, "PLAYER_NAME": c("c_name"), "START_POSITION": F.when(k % 3 == 0, "").when(k % 3 == 1, F.substring(c("c_mktsegment"), 1, 1))}

    p = collected(table(spark, sf_dir, "customer"), F.col("c_nationkey"), "sqlPlayerStats", cells, "c_custkey")
    s = result_sets.starters(p.withColumnRenamed("game_id", "nation"))
    return s.select("nation", F.col("PLAYER_ID").alias("player_id"), F.col("PLAYER_NAME").alias("player_name"), F.col("START_POSITION").alias("position"))


@Q.add("""SELECT game_id, event_id, p AS player_id, x AS loc_x, y AS loc_y FROM (SELECT CAST(l_orderkey AS VARCHAR) AS game_id, CAST(l_linenumber // 2 AS INT) AS event_id, l_partkey AS p, CAST(l_suppkey AS INT) AS x, CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_linenumber END AS INT) AS y, row_number() OVER (PARTITION BY l_orderkey, l_linenumber // 2 ORDER BY l_linenumber DESC, CAST(l_partkey AS VARCHAR) DESC, CAST(l_suppkey % 5 AS VARCHAR) DESC, CAST(l_suppkey AS VARCHAR) DESC) AS k FROM lineitem WHERE l_partkey % 8 <> 0 AND l_suppkey % 5 <= 1) WHERE k = 1""")
def resultset_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last shot of each event; a player is required, flags are 0 or 1, and places default to 0."""
    def cells(c: Callable[[str], Column]) -> dict[str, Column]:
        pk, n = c("l_partkey"), c("l_linenumber")
        return {"GAME_ID": c("l_orderkey"), "GAME_EVENT_ID": F.floor(n / 2), "PLAYER_ID": F.when(pk % 8 != 0, pk), "SHOT_MADE_FLAG": c("l_suppkey") % 5, "LOC_X": c("l_suppkey"), "LOC_Y": F.when(n % 3 != 0, n)}

    p = collected(table(spark, sf_dir, "lineitem"), F.col("l_orderkey"), "Shot_Chart_Detail", cells, "l_linenumber").drop("game_id")
    s = result_sets.shots_by_event(result_sets.shots(p))
    return s.select(F.col("GAME_ID").alias("game_id"), F.col("GAME_EVENT_ID").alias("event_id"), F.col("PLAYER_ID").alias("player_id"), F.col("LOC_X").alias("loc_x"), F.col("LOC_Y").alias("loc_y"))


@Q.add("""SELECT CAST(p_partkey AS VARCHAR) AS game_id, CAST(p_size AS VARCHAR) AS player_id, round(p_retailprice / 1000, 6) AS usage_pct, CASE WHEN p_partkey % 4 <> 0 THEN round(p_size / 100.0, 6)::DOUBLE END AS pct_points FROM part""")
def resultset_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {"GAME_ID": F.col("p_partkey"), "PLAYER_ID": F.col("p_size"), "USG_PCT": F.col("p_retailprice") / 1000, "PCT_PTS": F.when(F.col("p_partkey") % 4 == 0, "n/a").otherwise((F.col("p_size") / 100).cast("string"))}
    p = table(spark, sf_dir, "part").select(payload(result_set("sqlPlayersUsage", cells)).alias("body"))
    return rounded(result_sets.rates(p, "PlayersUsage", result_sets.USAGE, ("GAME_ID", "PLAYER_ID")).select("game_id", "player_id", "usage_pct", "pct_points"))


@Q.add("""WITH i AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN [o_custkey, 2, 3, 4, 5] WHEN 1 THEN [o_orderkey, 12, 13, 14, 15] END AS l FROM orders)
SELECT o_orderkey, array_to_string(l, ',') AS ids, CASE WHEN l IS NOT NULL THEN md5(array_to_string(l, ',')) END AS lineup_hash FROM i""")
def lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineups as a list, as one column for each player, and too short."""
    k, s = F.col("o_orderkey"), lambda x: F.lit(str(x))
    listed = F.when(k % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(", 2,x,3,4 ,5"))).when(k % 3 == 2, "1,2,3")
    slots = [F.when(k % 3 == 1, c) for c in (k.cast("string"), s(12), s(13), s(14), s(15))]
    ids = table(spark, sf_dir, "orders").select("o_orderkey", result_sets.lineup_ids(listed, slots).alias("l"))
    return ids.select("o_orderkey", F.array_join("l", ",").alias("ids"), text.lineup_hash(F.col("l")).alias("lineup_hash"))


@Q.add("""WITH r AS (SELECT l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 22 AS c, l_suppkey % 44 AS a, CASE l_partkey % 3 WHEN 0 THEN 'Mid-Range' WHEN 1 THEN 'Backcourt' END AS z, CASE l_partkey % 4 WHEN 0 THEN 'pg' WHEN 1 THEN 'X' WHEN 2 THEN '' END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE c WHEN 1 THEN 'shot' WHEN 2 THEN 'shot' WHEN 3 THEN 'free_throw' WHEN 4 THEN 'rebound' WHEN 5 THEN 'turnover' WHEN 6 THEN 'foul' WHEN 7 THEN 'violation' WHEN 8 THEN 'substitution' WHEN 9 THEN 'timeout' WHEN 10 THEN 'jump_ball' WHEN 11 THEN 'ejection' WHEN 12 THEN 'period_start' WHEN 13 THEN 'period_end' WHEN 18 THEN 'technical' WHEN 19 THEN 'flagrant' WHEN 20 THEN 'instant_replay' END AS event_type,
  CASE c WHEN 1 THEN 'make' WHEN 2 THEN 'miss' END AS shot_result, CASE WHEN c = 4 THEN CASE a WHEN 0 THEN 'off' WHEN 1 THEN 'def' END END AS rebound_type,
  CASE WHEN c IN (6, 18, 19) THEN CASE a WHEN 1 THEN 'personal' WHEN 2 THEN 'shooting' WHEN 3 THEN 'loose_ball' WHEN 4 THEN 'offensive' WHEN 5 THEN 'inbound' WHEN 6 THEN 'away_from_play' WHEN 7 THEN 'punch' WHEN 8 THEN 'clear_path' WHEN 9 THEN 'double' WHEN 10 THEN 'technical' WHEN 11 THEN 'flagrant1' WHEN 12 THEN 'flagrant2' WHEN 13 THEN 'defensive' WHEN 14 THEN 'take' WHEN 15 THEN 'transition_take' END END AS foul_type,
  CASE WHEN c = 5 THEN CASE a WHEN 1 THEN 'bad_pass' WHEN 2 THEN 'lost_ball' WHEN 3 THEN 'traveling' WHEN 4 THEN 'double_dribble' WHEN 5 THEN 'shot_clock' WHEN 6 THEN 'kicked_ball' WHEN 7 THEN 'lane_violation' WHEN 8 THEN 'offensive_foul' WHEN 9 THEN 'discontinued_dribble' WHEN 10 THEN 'backcourt' WHEN 11 THEN 'palming' WHEN 40 THEN 'step_out_of_bounds' WHEN 41 THEN 'out_of_bounds' WHEN 42 THEN 'steal' END END AS turnover_type,
  CASE WHEN z = 'Mid-Range' THEN 'long2' END AS shot_zone, CASE p WHEN 'pg' THEN 'G' WHEN 'X' THEN 'X' END AS position FROM r""")
def conditional_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = F.col("l_partkey")
    code, action = (F.col("l_orderkey") + F.col("l_linenumber")) % 22, F.col("l_suppkey") % 44
    zone, position = F.when(pk % 3 == 0, "Mid-Range").when(pk % 3 == 1, "Backcourt"), F.when(pk % 4 == 0, "pg").when(pk % 4 == 1, "X").when(pk % 4 == 2, "")
    fields = codes.conditional_fields(code.cast("string"), action.cast("string"), zone, position)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fields.alias("f")).select("l_orderkey", "l_linenumber", "f.*")


@Q.add("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'FINAL' WHEN 2 THEN 'LIVE' WHEN 3 THEN 'CANCELLED' ELSE 'SCHEDULED' END AS status, CASE o_orderkey % 4 WHEN 0 THEN 'QUESTIONABLE' WHEN 1 THEN 'OUT' WHEN 2 THEN 'PROBABLE' ELSE 'ACTIVE' END AS injury,
  CASE o_orderkey % 3 WHEN 1 THEN 'JUMP_BALL' WHEN 2 THEN 'TECHNICAL_FOUL' ELSE CASE o_orderkey % 20 WHEN 1 THEN 'SHOT_MADE' WHEN 2 THEN 'SHOT_MISSED' WHEN 3 THEN 'FREE_THROW_MADE' WHEN 4 THEN 'FREE_THROW_MISSED' WHEN 5 THEN 'REBOUND' WHEN 6 THEN 'FOUL' WHEN 7 THEN 'FOUL' WHEN 8 THEN 'SUBSTITUTION' WHEN 9 THEN 'TIMEOUT' WHEN 10 THEN 'JUMP_BALL' WHEN 11 THEN 'EJECTION' WHEN 12 THEN 'PERIOD_BEGIN' WHEN 13 THEN 'PERIOD_END' WHEN 18 THEN 'INSTANT_REPLAY' END END AS event_type FROM orders""")
def code_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = F.when(k % 5 == 0, "ppd").when(k % 5 == 1, " Final").when(k % 5 == 2, "2").when(k % 5 == 3, "cancelled").otherwise("who knows")
    i = F.when(k % 4 == 0, "Doubtful").when(k % 4 == 1, "out").when(k % 4 == 2, "PROBABLE ").otherwise("x")
    e = F.when(k % 3 == 0, (k % 20).cast("string")).when(k % 3 == 1, "Jump_Ball").otherwise("technical")
    return table(spark, sf_dir, "orders").select("o_orderkey", codes.status(s).alias("status"), codes.injury_status(i).alias("injury"), codes.event_type(e, "enum").alias("event_type"))


_spelt = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (k % len(words) + 1).cast("int"))


@Q.add("""WITH s(i, status_rows, status_enum, status_bridge, status_shown) AS (VALUES
  (0, 'FINAL', 'FINAL', 'FINAL', 'Final'), (1, 'FINAL', 'FINAL', 'SCHEDULED', 'Final'), (2, 'FINAL', 'FINAL', 'SCHEDULED', 'Final'), (3, 'LIVE', 'LIVE', 'LIVE', 'Live'), (4, 'LIVE', 'IN_PROGRESS', 'LIVE', 'In_Progress'), (5, 'LIVE', 'SCHEDULED', 'SCHEDULED', 'Live'),
  (6, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Scheduled'), (7, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Upcoming'), (8, 'POSTPONED', 'POSTPONED', 'POSTPONED', 'Postponed'), (9, 'CANCELLED', 'CANCELLED', 'POSTPONED', 'Cancelled'), (10, 'CANCELLED', 'CANCELLED', 'SCHEDULED', 'Canceled'),
  (11, 'SUSPENDED', 'SUSPENDED', 'SCHEDULED', 'Suspended'), (12, 'RESCHEDULED', 'RESCHEDULED', 'SCHEDULED', 'Rescheduled'), (13, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', '1'), (14, 'SCHEDULED', 'LIVE', 'SCHEDULED', '2'), (15, 'SCHEDULED', 'FINAL', 'SCHEDULED', '3'),
  (16, 'SCHEDULED', 'LIVE', 'SCHEDULED', 'Active'), (17, 'SCHEDULED', 'SCHEDULED', 'POSTPONED', 'Ppd'), (18, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Scheduled'), (19, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Live'), (20, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Who Knows'), (21, 'SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'Scheduled')),
n(i, injury) AS (VALUES (0, 'OUT'), (1, 'QUESTIONABLE'), (2, 'PROBABLE'), (3, 'ACTIVE'), (4, 'DNP'), (5, 'INACTIVE'), (6, 'ACTIVE'), (7, 'ACTIVE'), (8, 'QUESTIONABLE'), (9, 'QUESTIONABLE'), (10, 'OUT'), (11, 'ACTIVE'), (12, 'QUESTIONABLE'), (13, 'PROBABLE'), (14, 'OUT'), (15, 'DNP'), (16, 'INACTIVE'), (17, 'ACTIVE'), (18, 'ACTIVE')),
p(i, position) AS (VALUES (0, 'PG'), (1, 'SG'), (2, 'SF'), (3, 'PF'), (4, 'C'), (5, 'G'), (6, 'F'), (7, 'PG'), (8, 'SG'), (9, 'SF'), (10, 'PF'), (11, 'C'), (12, 'G'), (13, 'F'), (14, 'PG'), (15, 'SG'), (16, 'SF'), (17, 'PF'), (18, 'C'), (19, 'G'), (20, 'G')),
r(i, role_rows, role_enum, role_books) AS (VALUES (0, 'CREW_CHIEF', 'CREW_CHIEF', 'CREW_CHIEF'), (1, 'CREW_CHIEF', 'CREW_CHIEF', 'CREW_CHIEF'), (2, 'CREW_CHIEF', 'CREW_CHIEF', 'REFEREE'), (3, 'REFEREE', 'REFEREE', 'REFEREE'), (4, 'REFEREE', 'REFEREE', 'REFEREE'), (5, 'UMPIRE', 'UMPIRE', 'UMPIRE'), (6, 'UMPIRE', 'UMPIRE', 'REFEREE'), (7, 'OFFICIAL', 'OFFICIAL', 'REFEREE'),
  (8, 'CREW_CHIEF', 'CREW_CHIEF', 'REFEREE'), (9, 'REFEREE', 'REFEREE', 'REFEREE'), (10, 'UMPIRE', 'UMPIRE', 'REFEREE'), (11, 'REFEREE', 'OFFICIAL', 'REFEREE'), (12, 'REFEREE', 'REFEREE', 'REFEREE'), (13, 'REFEREE', 'REFEREE', 'REFEREE'), (14, 'REFEREE', 'REFEREE', 'REFEREE'), (15, 'REFEREE', 'REFEREE', 'REFEREE'))
SELECT o_orderkey, status_rows, status_enum, status_bridge, status_shown, injury, position, role_rows, role_enum, role_books, o_orderkey % 19 = 18 AS injury_unknown
FROM orders JOIN s ON s.i = o_orderkey % 22 JOIN n ON n.i = o_orderkey % 19 JOIN p ON p.i = o_orderkey % 21 JOIN r ON r.i = o_orderkey % 16""")
def code_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word and number of the status, injury, position and role maps, some that are in none, by each profile."""
    k = F.col("o_orderkey")
    s = _spelt(["final", " Finished", "COMPLETED", "live ", "in_progress", "In Progress", "scheduled", "upcoming", "Postponed", "cancelled", "canceled", "suspended", "rescheduled", "1", "2", "3", "active", "ppd", "pregame", "halftime", "who knows", ""], k)
    i = _spelt(["out", "Questionable", "probable", "active ", "dnp", "Inactive", "available", "healthy", "Doubtful", "day_to_day", "injured", "0", "1", "2", "3", "4", "5", "", "resting"], k)
    p = _spelt(["pg", "SG", "sf", "pf", " C", "g", "f", "point_guard", "Shooting_Guard", "small_forward", "power_forward", "center", "guard", "forward", "1", "2", "3", "4", "5", "", "9"], k)
    r = _spelt(["crew_chief", "Crew Chief", "chief", "referee", "ref", "umpire", "ump", "official", "1", "2", "3", "4", "official_1", "official_2", "official_3", "timekeeper"], k)
    named = {f"status_{x}": codes.status(s, x) for x in ("rows", "enum", "bridge", "shown")} | {"injury": codes.injury_status(i), "position": codes.lineup_position(p)}
    named |= {f"role_{x}": codes.role(r, x) for x in ("rows", "enum", "books")} | {"injury_unknown": codes.unknown(i, codes.INJURY)}
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(n) for n, v in named.items()])


@Q.add(f"""WITH {E_SQL}, t AS (SELECT event_idx, period, time_remaining AS t, clock_ms_remaining / 1000.0 AS left_sec, least(seconds_elapsed, 720) AS el, event_idx % 4 = 0 AS odd FROM e),
c AS (SELECT *, CASE WHEN regexp_matches(t, '^\\d+:\\d') THEN try_cast(split_part(t, ':', 1) AS INT) END AS m, CASE WHEN regexp_matches(t, '^\\d+:\\d') THEN try_cast(split_part(t, ':', 2) AS DOUBLE) END AS s, CASE WHEN el IS NULL THEN '00:00:00' ELSE printf('00:%02d:%02d', CAST(floor((720 - el) / 60) AS INT), CAST(floor((720 - el) % 60) AS INT)) END AS h FROM t)
SELECT event_idx, m AS minutes, s AS seconds, m * 60 + CAST(floor(s) AS INT) AS whole_seconds, t IS NOT NULL AND t <> 'bad' AS looks, coalesce(left_sec BETWEEN 0 AND CASE WHEN period <= 4 THEN 720 ELSE 300 END, false) AS in_bounds, CASE WHEN odd THEN '12:00' ELSE substr(h, 4) END AS short, CASE WHEN odd THEN 0 ELSE 720 - CAST(substr(h, 4, 2) AS INT) * 60 - CAST(substr(h, 7, 2) AS INT) END::DOUBLE AS elapsed FROM c""")
def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("time_remaining")
    e = events(spark, sf_dir).withColumn("h", F.when(F.col("event_idx") % 4 == 0, "no clock").otherwise(clock.clock_text(F.least(F.col("seconds_elapsed"), F.lit(720.0)))))
    return e.select("event_idx", clock.split_clock(t).alias("c"), clock.clock_to_seconds(t).alias("whole_seconds"), clock.looks_like_clock(t).alias("looks"), clock.clock_in_bounds(F.col("period"), F.col("clock_ms_remaining") / 1000).alias("in_bounds"), clock.short_clock(F.col("h")).alias("short"), clock.elapsed_of_clock_text(F.col("h")).alias("elapsed")).select("event_idx", "c.minutes", "c.seconds", "whole_seconds", "looks", "in_bounds", "short", "elapsed")


_s = "CAST({y} AS VARCHAR) || '-' || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')"


@Q.add(f"""WITH d AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_orderdate + INTERVAL 3 HOUR AS t, CASE WHEN o_orderkey % 3 = 0 THEN 'America/Denver' END AS z, CASE WHEN o_orderkey % 2 = 0 THEN 'America/Los_Angeles' END AS tz, o_orderkey % 4 = 0 AS has FROM orders),
l AS (SELECT *, CAST((t AT TIME ZONE 'UTC') AT TIME ZONE coalesce(z, tz, 'America/New_York') AS DATE) AS bridge, CAST((t AT TIME ZONE 'UTC') AT TIME ZONE coalesce(z, 'America/New_York') AS DATE) AS arena FROM d)
SELECT k AS o_orderkey, CASE WHEN has THEN d WHEN z IS NOT NULL THEN arena ELSE CAST(t AS DATE) END AS day, CASE WHEN has OR z IS NOT NULL THEN 'local' ELSE 'utc' END AS source, CASE WHEN has THEN d ELSE arena END AS resolved, CASE WHEN has THEN d ELSE bridge END AS bridged, CASE WHEN has THEN 'local' ELSE 'derived' END AS used,
  CASE abs(d - (d + CAST(k % 3 AS INT))) WHEN 0 THEN 'ok' WHEN 1 THEN 'warn' ELSE 'error' END AS gap, CASE k % 3 WHEN 2 THEN NULL ELSE d END AS id_day, CAST((t AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) - 1 AS yesterday,
  {_s.format(y="(2000 + k % 90)")} AS lenient, k % 4 = 0 AND year(d) BETWEEN 1946 AND 2034 AS in_range, d >= make_date(1996, 8, 1) AND d <= make_date(1997, 7, 31) AS in_season, CASE k % 4 WHEN 0 THEN {_s.format(y="year(d)")} WHEN 1 THEN {_s.format(y="year(d)")} ELSE 'x' END AS expanded, k % 4 IN (0, 2) AS is_date FROM l""")
def date_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    t = F.col("o_orderdate").cast("timestamp_ntz").cast("timestamp") + F.expr("INTERVAL 3 HOURS")
    z, tz, has = F.when(k % 3 == 0, "America/Denver"), F.when(k % 2 == 0, "America/Los_Angeles"), k % 4 == 0
    local, iso = F.when(has, d), F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    ids = F.when(k % 3 == 0, F.concat(F.date_format(d, "yyyyMMdd"), F.lit("0BOS"))).when(k % 3 == 1, F.concat(F.lit("game-"), d.cast("string"))).otherwise("none")
    season = F.when(k % 4 == 0, dates.season_name(F.year(d))).when(k % 4 == 1, F.year(d).cast("string")).otherwise("x")
    raw = F.when(k % 4 == 0, d.cast("string")).when(k % 4 == 1, F.concat(F.year(d).cast("string"), F.lit("-02-30"))).when(k % 4 == 2, F.lit("2024-02-29")).otherwise("2024-2-9")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.date_with_source(local, t, z).alias("w"), dates.resolve_game_date(F.when(has, F.concat(d.cast("string"), F.lit("T00:00:00"))), iso, z).alias("resolved"), dates.bridged_date(local, t, z, tz).alias("b"),
        dates.date_gap(d, F.date_add(d, (k % 3).cast("int"))).alias("gap"), dates.date_in_id(ids).alias("id_day"), dates.yesterday_eastern(t).alias("yesterday"), dates.season_from_game_id_lenient(F.concat(F.lit("002"), F.lpad((k % 90).cast("string"), 2, "0"))).alias("lenient"),
        dates.season_in_range(season, F.lit("2024-06-01").cast("date")).alias("in_range"), dates.in_season(d, F.lit("1996-97")).alias("in_season"), dates.expand_season(season).alias("expanded"), dates.valid_date_text(raw).alias("is_date"),
    )
    return o.select("o_orderkey", "w.day", "w.source", "resolved", F.col("b.day").alias("bridged"), F.col("b.used").alias("used"), "gap", "id_day", "yesterday", "lenient", "in_range", "in_season", "expanded", "is_date")


@Q.add("""WITH r AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '$1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') WHEN 1 THEN CAST(p_size AS VARCHAR) || '%' WHEN 2 THEN 'null' ELSE CAST(p_size AS VARCHAR) END AS raw, p_size AS z FROM part)
SELECT k AS p_partkey, try_cast(replace(replace(replace(raw, '$', ''), ',', ''), '%', '') AS DOUBLE) AS money, try_cast(nullif(raw, 'null') AS BIGINT) AS id, CASE WHEN k % 4 = 0 THEN 'B' || z || ' City' WHEN k % 4 < 3 THEN 'Los A' || z END AS home, CASE WHEN k % 4 = 0 THEN 'Los A' || z WHEN k % 4 < 3 THEN 'B' || z || ' City' END AS away,
CASE WHEN k % 2 = 0 THEN '20240101' || '0T' || CAST(k AS VARCHAR) END AS page_id, CASE k % 3 WHEN 0 THEN 'BRK' WHEN 1 THEN 'BOS' END AS tricode, CASE k % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 END AS shot_value FROM r""")
def text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size").cast("string")
    raw = F.when(k % 4 == 0, F.concat(F.lit("$1,"), F.lpad(s, 3, "0"))).when(k % 4 == 1, F.concat(s, F.lit("%"))).when(k % 4 == 2, "null").otherwise(s)
    mark = F.when(k % 4 == 0, "  @  ").when(k % 4 == 1, " vs. ").when(k % 4 == 2, " v ").otherwise("-")
    m = text.split_matchup(F.concat(F.lit("Los A"), s, mark, F.lit("B"), s, F.lit(" City")))
    url = F.concat(F.when(k % 2 == 0, "http://x/boxscores/202401010T").otherwise("http://x/teams/T"), k.cast("string"), F.lit(".html"))
    kind = F.when(k % 5 < 2, "SHOT_MISSED").when(k % 5 == 2, "FREE_THROW_MADE").otherwise("FOUL")
    return table(spark, sf_dir, "part").select(
        "p_partkey", numbers.money_or_percent(raw).alias("money"), numbers.id_or_null(raw).alias("id"), m["home"].alias("home"), m["away"].alias("away"), text.box_page_id_of_url(url).alias("page_id"),
        text.tricode(F.when(k % 3 == 0, " bkn").when(k % 3 == 1, "bos").otherwise("b0s"), {"BKN": "BRK"}).alias("tricode"), text.shot_value(kind, F.when(k % 5 == 0, "26' 3PT Jump Shot")).alias("shot_value"),
    )


@Q.add("""WITH v(id, c) AS (VALUES (1610612737, 'ATL'), (1610612738, 'BOS'), (1610612751, 'BRK'), (1610612766, 'CHA'), (1610612741, 'CHI'), (1610612739, 'CLE'), (1610612742, 'DAL'), (1610612743, 'DEN'), (1610612765, 'DET'), (1610612744, 'GSW'), (1610612745, 'HOU'), (1610612754, 'IND'), (1610612746, 'LAC'), (1610612747, 'LAL'), (1610612763, 'MEM'), (1610612748, 'MIA'), (1610612749, 'MIL'), (1610612750, 'MIN'), (1610612740, 'NOP'), (1610612752, 'NYK'), (1610612760, 'OKC'), (1610612753, 'ORL'), (1610612755, 'PHI'), (1610612756, 'PHX'), (1610612757, 'POR'), (1610612758, 'SAC'), (1610612759, 'SAS'), (1610612761, 'TOR'), (1610612762, 'UTA'), (1610612764, 'WAS')), m AS (SELECT s_suppkey, c FROM supplier LEFT JOIN v ON v.id = 1610612736 + s_suppkey % 40)
SELECT s_suppkey, coalesce(c, 'UNK') AS tricode, CASE WHEN c IN ('LAL', 'LAC', 'GSW', 'SAC', 'POR') THEN 'America/Los_Angeles' WHEN c IN ('DEN', 'UTA') THEN 'America/Denver' WHEN c = 'PHX' THEN 'America/Phoenix' WHEN c = 'DET' THEN 'America/Detroit' WHEN c = 'TOR' THEN 'America/Toronto' WHEN c IN ('CHI', 'DAL', 'HOU', 'MEM', 'MIL', 'MIN', 'NOP', 'OKC', 'SAS') THEN 'America/Chicago' ELSE 'America/New_York' END AS arena_zone,
CASE c WHEN 'BRK' THEN 'NJN,BKN' WHEN 'OKC' THEN 'SEA' WHEN 'CHA' THEN 'CHO' WHEN 'PHX' THEN 'PHO' ELSE coalesce(c, 'UNK') END AS others FROM m""")
def team_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "supplier").select("s_suppkey", dimensions.tricode_of_id(F.lit(1610612736) + F.col("s_suppkey") % 40).alias("tricode"))
    return t.select("s_suppkey", "tricode", dimensions.arena_zone(F.col("tricode")).alias("arena_zone"), F.array_join(dimensions.variations(F.col("tricode")), ",").alias("others"))


@Q.add("""WITH g AS (SELECT o_orderkey, o_custkey % 25 AS h, o_orderkey % 25 AS a FROM orders) SELECT o_orderkey, hn.n_name AS home_canonical, an.n_name AS away_canonical, nullif(concat_ws(',', CASE WHEN hn.n_name IS NULL THEN 'n' || h END, CASE WHEN an.n_name IS NULL THEN 'n' || a END), '') AS problem
FROM g LEFT JOIN nation hn ON hn.n_nationkey = h AND h % 6 <> 0 LEFT JOIN nation an ON an.n_nationkey = a AND a % 6 <> 0""")
def tricode_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda c: F.concat(F.lit("n"), c.cast("string"))
    known = table(spark, sf_dir, "nation").where("n_nationkey % 6 <> 0").select(n(F.col("n_nationkey")).alias("alias"), F.col("n_name").alias("canonical"))
    g = table(spark, sf_dir, "orders").select("o_orderkey", n(F.col("o_custkey") % 25).alias("home"), n(F.col("o_orderkey") % 25).alias("away"))
    return dimensions.valid_pair(g, known).select("o_orderkey", "home_canonical", "away_canonical", "problem")


_first = ["Adam", "Bert", "Carl", "Dora", "Ella", "Fred", "Gina"]
_name = lambda k, a: "CASE {} % 7 {} END || ' ' || CASE {} % 5 {} END".format(k, " ".join(f"WHEN {i} THEN '{_first[(i + a) % 7]}'" for i in range(7)), k, " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(["Able", "Baker", "Cole", "Dean", "Early"])))


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book for each customer, with one to three officials of names that vary, some without an id of their own."""
    c = spread(spark, sf_dir, "customer", "c_custkey").select("c_custkey", *[F.expr(_name("c_custkey", a)).alias(f"n{a}") for a in (0, 2, 4)])
    k = F.col("c_custkey")
    found = F.concat(F.lit("00"), F.lpad(k.cast("string"), 8, "0"))
    body = F.concat(F.lit("OFFICIAL GAME BOOK\nGame "), found, F.lit("\nCrew Chief: "), F.col("n0"), F.lit("\n"), F.when(k % 3 > 0, F.concat(F.lit("Referee: "), F.col("n2"), F.lit("\n"))).otherwise(""), F.when(k % 3 > 1, F.concat(F.lit("Umpire: "), F.col("n4"), F.lit("\n"))).otherwise(""), F.when(k % 2 == 0, "Arena: Big Hall, Town. Attendance 12345. Officials and crew were on time.\n").otherwise(""), F.lit("Alternates: "), F.col("n4"), F.lit("\n\n"))
    return c.select("c_custkey", F.when(k % 4 > 0, found).when(k % 8 == 0, F.lit("")).alias("game_id"), body.alias("text"))


@Q.add(f"""WITH b AS (SELECT c_custkey AS k, {_name("c_custkey", 0)} AS n0, {_name("c_custkey", 2)} AS n2, {_name("c_custkey", 4)} AS n4 FROM customer)
SELECT k AS c_custkey, n0 AS name, 'CREW_CHIEF' AS role, 1 AS position FROM b UNION ALL SELECT k, n2, 'REFEREE', 2 FROM b WHERE k % 3 > 0 UNION ALL SELECT k, n4, 'UMPIRE', 3 FROM b WHERE k % 3 > 1""")
def book_referees(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = game_books.parse(_books(spark, sf_dir).withColumn("game_id", F.col("c_custkey")))
    return game_books.first_by_name(game_books.referee_rows(parsed)).withColumnRenamed("game_id", "c_custkey")


@Q.add(f"""SELECT c_custkey, {_name("c_custkey", 4)} AS name FROM customer WHERE c_custkey % 3 <= 1""")
def book_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternates who are no referees of the book."""
    return game_books.alternate_rows(game_books.parse(_books(spark, sf_dir).withColumn("game_id", F.col("c_custkey")))).withColumnRenamed("game_id", "c_custkey")


@Q.add("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '0022' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') WHEN 1 THEN '0022' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') WHEN 2 THEN 'AB' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 3 THEN 'XY' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 4 THEN '20240105B' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') END AS game_id,
  CASE c_custkey % 6 WHEN 0 THEN 'labelled' WHEN 1 THEN 'digits' WHEN 2 THEN 'game' WHEN 3 THEN 'id' WHEN 4 THEN 'date' END AS pattern FROM customer""")
def book_id_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in each way that books give them, with what looks like one before; the pattern that found it."""
    k = F.col("c_custkey")
    n = lambda w: F.lpad(k.cast("string"), w, "0")
    body = F.concat(F.lit("Ref 0012345678 of the book\n"), F.when(k % 6 == 0, F.concat(F.lit("seen 0022999999, Game Number: 0022"), n(6))).when(k % 6 == 1, F.concat(F.lit("no. 0022"), n(6))).when(k % 6 == 2, F.concat(F.lit("Game: AB"), n(7))).when(k % 6 == 3, F.concat(F.lit("ID: XY"), n(7))).when(k % 6 == 4, F.concat(F.lit("on 20240105B"), F.lpad((k % 100).cast("string"), 2, "0"))).otherwise("none"))
    return spread(spark, sf_dir, "customer", "c_custkey").select("c_custkey", game_books.found_id(body, "0022").alias("f")).select("c_custkey", F.col("f.value").alias("game_id"), "f.pattern")


@Q.add(f"""WITH b AS (SELECT c_custkey AS k, {_name("c_custkey", 2)} AS n2, {_name("c_custkey", 4)} AS n4 FROM customer)
SELECT k AS c_custkey, n2 AS name, CASE k % 5 WHEN 0 THEN 'section' WHEN 1 THEN 'alternate' WHEN 2 THEN 'standby' WHEN 3 THEN 'backup' ELSE 'substitute' END AS pattern FROM b UNION ALL SELECT k, n4, CASE k % 5 WHEN 0 THEN 'section' ELSE 'substitute' END FROM b WHERE k % 5 IN (0, 2)""")
def book_standby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternates by section or by each word that names one, without the referee who is named again."""
    k = F.col("c_custkey")
    word = F.when(k % 5 == 1, "Alternate").when(k % 5 == 2, "Standby").when(k % 5 == 3, "Backups").otherwise("Substitute")
    other = F.concat(F.lit("Alternate"), F.when(k % 5 == 1, F.concat(F.lit(": "), F.col("n2"))).otherwise(F.concat(F.lit(" - none\n\n"), word, F.lit(": "), F.col("n2"))), F.lit(" -\nstandby: "), F.col("n0"), F.when(k % 5 == 2, F.concat(F.lit(" -\nsubstitute: "), F.col("n4"))).otherwise(""))
    body = F.concat(F.lit("Crew Chief: "), F.col("n0"), F.lit(" -\n"), F.when(k % 5 == 0, F.concat(F.lit("Alternates:\n"), F.col("n2"), F.lit("\n"), F.col("n4"), F.lit("\n\nEnd"))).when(k % 5 == 1, F.concat(F.lit("1 alternate"), F.col("n2"), F.lit(" -\nstandby: "), F.col("n0"))).otherwise(other))
    c = spread(spark, sf_dir, "customer", "c_custkey").select("c_custkey", *[F.expr(_name("c_custkey", a)).alias(f"n{a}") for a in (0, 2, 4)])
    return c.select("c_custkey", F.explode(game_books.alternates(body, F.array("n0"))).alias("a")).select("c_custkey", "a.name", "a.pattern")


@Q.add(f"""WITH b AS (SELECT c_custkey AS k, {_name("c_custkey", 0)} AS n0, {_name("c_custkey", 2)} AS n2, CASE c_custkey % 3 WHEN 0 THEN 'Bears' WHEN 1 THEN 'Lions' ELSE 'Big Hawks' END AS h FROM customer)
SELECT k AS c_custkey, 5 AS at, 'technicals' AS section, h AS heading, n0 AS player, 'BOS' AS team, CAST(k % 4 + 1 AS INT) AS period, '10:3' || CAST(k % 10 AS VARCHAR) AS clock, 'player' AS kind, 'Arguing a call' AS reason, 'reason' AS pattern FROM b
UNION ALL SELECT k, 7, 'technicals', 'Wolves', 'Bench Technical', 'NYK', 2, '5:15', 'bench', NULL, 'bench' FROM b WHERE k % 2 = 0 UNION ALL SELECT k, CASE WHEN k % 2 = 0 THEN 9 ELSE 8 END, 'notes', NULL, n2, 'LAL', 3, '8:45', 'player', NULL, 'plain' FROM b""")
def book_technicals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technical fouls with the section and team heading that they stand under, their team, clock, kind and reason; one that is told twice counts once."""
    k = F.col("c_custkey")
    first = F.concat(F.lit("T1: "), F.col("n0"), F.lit(" (BOS) - 10:3"), (k % 10).cast("string"), F.lit(" Q"), (k % 4 + 1).cast("string"), F.lit("  - Arguing  a call "))
    lines = [F.lit("OFFICIAL GAME BOOK"), F.lit("Officials:"), F.concat(F.lit("Crew Chief: "), F.col("n0")), F.lit("TECHNICAL FOULS"), F.concat(F.lit("HOME TEAM: "), F.when(k % 3 == 0, "Bears").when(k % 3 == 1, "Lions").otherwise("Big Hawks")), first, F.lit("Away: Wolves"), F.when(k % 2 == 0, "T2: Bench Technical (NYK) - 5:15 Q2"), F.lit("Notes"), F.concat(F.lit("T3: "), F.col("n2"), F.lit(" (LAL) - 8:45 Q3")), F.trim(first), F.lit("Talk (of the) town - 1:00")]
    c = spread(spark, sf_dir, "customer", "c_custkey").select("c_custkey", *[F.expr(_name("c_custkey", a)).alias(f"n{a}") for a in (0, 2)])
    return game_books.technicals(c.select("c_custkey", F.array_join(F.array_compact(F.array(*lines)), "\n").alias("text")))


@Q.add("""WITH b AS (SELECT c_custkey AS k, c_custkey % 3 + 1 AS n, least(1.0, (c_custkey % 3 + 1) * 0.3::DOUBLE) AS c, CASE WHEN c_custkey % 4 > 0 THEN 1 WHEN c_custkey % 8 = 0 THEN 0 END AS id, c_custkey % 13 AS p FROM customer),
q AS (SELECT *, c * 0.4 + CASE WHEN n >= 2 THEN 0.2 ELSE 0.1 END + CASE WHEN p >= 10 THEN 0.2 WHEN p > 0 THEN 0.1 ELSE 0 END + CASE WHEN id = 1 THEN 0.2 ELSE 0 END AS s FROM b)
SELECT k AS c_custkey, round(c, 6)::DOUBLE AS confidence, round(s, 6)::DOUBLE AS quality_score, CASE WHEN coalesce(id, 0) = 0 OR s < 0.3999999 THEN 'reject' WHEN s >= 0.6999999 THEN 'accept' ELSE 'accept_with_review' END AS recommended_action, CASE WHEN coalesce(id, 0) = 0 THEN 'Missing game_id' ELSE '' END AS errors,
  concat_ws(',', CASE WHEN n = 1 THEN 'Fewer than 2 referees found' END, CASE WHEN p BETWEEN 1 AND 9 THEN 'Fewer than 10 players found' END, CASE WHEN c < 0.5 THEN 'Low parsing confidence' END) AS warnings, CASE WHEN c >= 0.8 AND p >= 10 THEN 'excellent' WHEN c >= 0.6 AND n >= 2 AND p >= 5 THEN 'good' WHEN c >= 0.4 THEN 'fair' ELSE 'poor' END AS grade FROM q""")
def book_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("c_custkey") % 13
    # Scores of tenths: rounded before they meet their limits, as sums of doubles may fall just short.
    parsed = game_books.parse(_books(spark, sf_dir)).withColumn("parsing_confidence", F.round("parsing_confidence", 9))
    q = game_books.quality(parsed, p)
    return rounded(q.select("c_custkey", F.col("parsing_confidence").alias("confidence"), "quality_score", "recommended_action", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), game_books.grade(F.size("refs"), p, F.col("parsing_confidence")).alias("grade")))


@Q.add("""SELECT c_custkey, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE '00' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS game_id, c_custkey % 8 = 0 AS id_differs FROM customer""")
def book_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book's own id, else the one of its text; an id that isn't the text's is marked."""
    b = game_books.with_fallback_id(game_books.parse(_books(spark, sf_dir)))
    return b.select("c_custkey", "game_id", "id_differs")


@Q.add("""SELECT s_suppkey AS game_id, CASE k WHEN 0 THEN 'H' ELSE 'A' END AS team, CASE WHEN r = 2 THEN 'TOTALS' ELSE 'P' || CAST(s_suppkey + r AS VARCHAR) END AS player, CASE WHEN k = 0 AND r = 1 THEN NULL ELSE s_suppkey % 40 + r END AS pts, CASE WHEN k = 0 THEN s_suppkey % 9 END AS reb, r = 2 AS is_total FROM supplier, range(2) a(k), range(3) b(r)""")
def book_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two player tables of a book, with other headers each, a player who didn't play, and totals."""
    k = F.col("s_suppkey")
    t = lambda c: c.cast("string")
    def one(team: str, heads: list[str], home: bool) -> Column:
        name = lambda r: F.lit("Totals") if r == 2 else F.concat(F.lit(" P"), t(k + r))
        pts = lambda r: F.lit("DNP") if home and r == 1 else t(k % 40 + r)
        rows = [F.array(name(r), *([t(k % 9)] if home else []), pts(r)) for r in range(3)]
        return F.struct(F.lit(team).alias("team"), F.array(*map(F.lit, heads)).alias("headers"), F.array(*rows).alias("rows"))
    books = table(spark, sf_dir, "supplier").select(k.alias("game_id"), F.array(one("H", ["Player", "TOT", "PTS"], True), one("A", ["NAME", "Pts"], False)).alias("player_stats_tables"))
    return game_books.player_rows(books).select("game_id", "team", F.when(F.col("is_total"), F.upper("player")).otherwise(F.col("player")).alias("player"), "pts", "reb", "is_total")


@Q.add("""SELECT s_suppkey AS game_id, CASE s_suppkey % 3 WHEN 0 THEN s_name ELSE 'Ann ' || s_name END AS name, CASE s_suppkey % 3 WHEN 0 THEN 'Chief' WHEN 1 THEN CAST(s_suppkey % 90 AS VARCHAR) ELSE 'Official 1' END AS position, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey % 20 AS INT) END AS years FROM supplier""")
def referees_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    t = lambda c: c.cast("string")
    people = lambda rows, **cells: rows.select(k.alias("game_id"), F.array(F.struct(*[c.alias(n) for n, c in cells.items()])).alias("people"))
    books = silver.referees(people(s.where("s_suppkey % 3 = 0"), name=F.col("s_name"), position=F.lit("Chief"), experience=t(k % 20)), "books")
    stats = silver.referees(people(s.where("s_suppkey % 3 = 1"), FIRST_NAME=F.lit("Ann"), LAST_NAME=F.col("s_name"), JERSEY_NUM=t(k % 90)), "stats")
    pages_ = silver.referees(people(s.where("s_suppkey % 3 = 2"), name=F.concat(F.lit("Ann "), F.col("s_name")), position=F.lit(""), years_experience=F.lit("x")), "pages")
    return books.unionByName(stats).unionByName(pages_)


@Q.add("""SELECT s_suppkey, CASE k WHEN 0 THEN 'away' ELSE 'home' END AS side, 'P ' || CAST(s_suppkey + 10 * k AS VARCHAR) AS player, 'G' AS position FROM supplier, range(2) a(k)""")
def page_starters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two box tables a page, one player of each marked as a starter."""
    n = lambda a: (F.col("s_suppkey") + a).cast("string")
    row = lambda name, star: F.concat(F.lit("<tr><th data-stat=\"player\"><a>P "), name, F.lit(f"{star}</a></th><td data-stat=\"pos\">G</td></tr>"))
    box = lambda t, a: F.concat(F.lit(f'<table id="box-{t}-basic">'), row(n(a), "*"), row(n(a + 1), ""), F.lit("</table>"))
    return pages.starters(table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("<div>"), box("AAA", 0), box("BBB", 10), F.lit("</div>")).alias("html"))).select("s_suppkey", "side", "player", "position")


@Q.add(f"""SELECT s_suppkey, {_name("s_suppkey", 1)} AS player, CASE s_suppkey % 2 WHEN 0 THEN 'knee' ELSE 'left ankle' END AS reason, CASE s_suppkey % 3 WHEN 0 THEN 'OUT' WHEN 1 THEN 'QUESTIONABLE' ELSE 'PROBABLE' END AS status FROM supplier""")
def page_injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    note = F.concat(F.expr(_name("s_suppkey", 1)), F.lit(" ("), F.when(k % 2 == 0, "knee").otherwise("left ankle"), F.lit(") - "), F.when(k % 3 == 0, "out").when(k % 3 == 1, "questionable").otherwise("probable"))
    return pages.injury_notes(table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("<p>Nothing</p><div>"), note, F.lit("</div>")).alias("html"))).select("s_suppkey", "player", "reason", "status")


@Q.add("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN CAST(18000 + s_suppkey % 1000 AS INT) END AS attendance, CASE WHEN s_suppkey % 2 = 0 THEN 'Hall ' || CAST(s_suppkey AS VARCHAR) END AS arena FROM supplier""")
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    crowd = F.when(k % 3 > 0, F.concat(F.lit("<b>Attendance:</b> 18,"), F.lpad((k % 1000).cast("string"), 3, "0"))).otherwise("")
    hall = F.when(k % 2 == 0, F.concat(F.lit("<p>Arena: Hall "), k.cast("string"), F.lit("\n</p>"))).otherwise("")
    return pages.game_metadata(table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(crowd, F.lit(" \n"), hall).alias("html"))).select("s_suppkey", "attendance", "arena")


@Q.add("""SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_orderkey % 30 AS INT) AS q1_home_points, CAST(o_orderkey % 130 AS INT) AS final_home_points, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE CAST(o_orderkey % 110 AS INT) END AS final_away_points, CAST(o_orderkey % 130 + CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 110 END AS INT) AS total_points,
o_orderkey % 130 > CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 110 END AS home_win, CAST(o_orderkey % 130 - CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 110 END AS INT) AS margin, CAST(o_orderkey % 2 AS INT) AS overtime_periods FROM orders""")
def box_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    i = lambda c: c.cast("int")
    b = table(spark, sf_dir, "orders").select(k.cast("string").alias("game_id"), F.lit("AAA").alias("home_team_tricode"), F.lit("BBB").alias("away_team_tricode"), i(k % 30).alias("home_q1"), i(k % 20).alias("away_q1"), i(k % 130).alias("home_final"), i(F.when(k % 9 != 0, k % 110)).alias("away_final"), i(F.when(k % 2 == 1, 1)).alias("ot_periods"))
    return teams.outcomes_of_box(b).select("game_id", "q1_home_points", "final_home_points", "final_away_points", "total_points", "home_win", "margin", "overtime_periods")


@Q.add("""WITH o AS (SELECT c_custkey, c_nationkey AS game_id, c_name AS v FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey, c_nationkey AS game_id, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS v FROM customer WHERE c_custkey % 4 <> 2),
g AS (SELECT * FROM n WHERE v IS NOT NULL AND game_id % 5 <> 0 AND game_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 4 <> 0))
SELECT coalesce(g.c_custkey, o.c_custkey) AS c_custkey, coalesce(g.game_id, o.game_id) AS game_id, CASE WHEN g.c_custkey IS NULL THEN o.v ELSE g.v END AS v, CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN g.c_custkey IS NULL THEN 'kept' WHEN o.v IS DISTINCT FROM g.v THEN 'update' ELSE 'unchanged' END AS _action FROM o FULL JOIN g ON o.c_custkey = g.c_custkey""")
def derived_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert of rows that have their fields, a complete game and a parent."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    old = c.where("c_custkey % 2 = 0").select("c_custkey", F.col("c_nationkey").alias("game_id"), F.col("c_name").alias("v"))
    new = c.where("c_custkey % 4 <> 2").select("c_custkey", F.col("c_nationkey").alias("game_id"), F.when(k % 3 > 0, F.col("c_mktsegment")).alias("v"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("game_id"))
    return upsert.load_derived(old, new, ["c_custkey"], ["v"], n.where("game_id % 5 <> 0"), n.where("game_id % 4 <> 0"))


@Q.add("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_partkey % 4 = 0 THEN 'part' END, CASE WHEN l_suppkey % 3 = 0 THEN 'supplier' END) AS missing FROM lineitem WHERE l_partkey % 4 = 0 OR l_suppkey % 3 = 0""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that lack required fields, with the fields' names."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 4 > 0, F.col("l_partkey")).alias("part"), F.when(F.col("l_suppkey") % 3 > 0, F.col("l_suppkey")).alias("supplier"))
    _, bad = upsert.require(li, ["part", "supplier"])
    return bad.select("l_orderkey", "l_linenumber", F.array_join("missing", ",").alias("missing"))


@Q.add("""SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 0 THEN o_custkey END AS o_custkey FROM orders) WHERE o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)""")
def parent_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose parent is there or isn't named."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 6 > 0, F.col("o_custkey")).alias("c_custkey"), "o_orderkey")
    return upsert.with_parent(o, table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0"), "c_custkey").select("o_orderkey", F.col("c_custkey").alias("o_custkey"))


@Q.add("""SELECT user_id, CAST(d AS DATE) AS first_day, least(CAST(d AS DATE) + 4, hi) AS last_day FROM (SELECT user_id, min(ts)::DATE AS lo, max(ts)::DATE AS hi, CASE WHEN user_id % 3 > 0 THEN min(ts)::DATE + 9 END AS done FROM events GROUP BY 1), generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 5 DAY) t(d) WHERE done IS NULL OR least(CAST(d AS DATE) + 4, hi) > done""")
def backfill_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's chunks of five days that are still to be done after a run that got through ten days, or that never ran."""
    r = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    done = F.when(F.col("user_id") % 3 > 0, F.date_add("lo", 9))
    return r.select("user_id", F.explode(incremental.open_chunks(F.col("lo"), F.col("hi"), 5, done)).alias("c")).select("user_id", F.col("c.first").alias("first_day"), F.col("c.last").alias("last_day"))


@Q.add("""SELECT 'daily' AS stage, CAST(n_nationkey AS VARCHAR) AS "key", CASE WHEN n_nationkey = 7 THEN 'new' ELSE n_name END AS value FROM nation""")
def watermark_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of marks after one of them was moved."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    marks = table(spark, sf_dir, "nation").select(F.lit("daily").alias("stage"), F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"), at.alias("updated_at"))
    return incremental.set_watermark(marks, "daily", "7", F.lit("new"), at).drop("updated_at")


@Q.add("""WITH g AS (SELECT o_orderkey FROM orders, (SELECT CAST(max(o_orderdate) AS DATE) AS hi FROM orders) WHERE CAST(o_orderdate AS DATE) BETWEEN hi - 300 AND hi)
SELECT 'lines' AS "table", count(DISTINCT l_orderkey) AS n_games, count(*) AS n_rows FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM g) UNION ALL SELECT 'returns', count(DISTINCT l_orderkey), count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM g) UNION ALL SELECT 'none', 0, 0""")
def recent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by table of the games of the last 300 days of the orders."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date_local"))
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "game_id")
    o = o.crossJoin(F.broadcast(o.agg(F.max("game_date_local").alias("hi"))))
    return seasons.recent_rollup(o, {"lines": li, "returns": li.where("l_returnflag = 'R'"), "none": li.where("l_quantity < 0")}, F.col("hi"), 300)


_CAN = "VALUES ('click', 'plays', true), ('click', 'games', false), ('view', 'plays', false), ('view', 'people', true), ('purchase', 'games', false), ('error', 'people', false)"


@Q.add(f"""WITH a AS (SELECT DISTINCT CAST(user_id AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR) AS game_id, event_type AS source FROM events), m AS (SELECT *, row_number() OVER (PARTITION BY game_id, data_type ORDER BY p DESC, source) AS k, count(*) OVER (PARTITION BY game_id, data_type) AS n_sources FROM a JOIN ({_CAN}) c(source, data_type, p) USING (source))
SELECT game_id, data_type, source, n_sources FROM m WHERE k = 1""")
def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source gives which data of a user's day."""
    game = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.day("ts").cast("string"))
    can = spark.sql(f"SELECT * FROM {_CAN} AS c(source, data_type, is_preferred)")
    return seasons.chosen_sources(table(spark, sf_dir, "events").select(game.alias("game_id"), F.col("event_type").alias("source")), can)


@Q.add(f"""WITH {E_SQL}, c AS (SELECT game_id, count(*) AS n_events FROM e GROUP BY 1) SELECT game_id, n_events, CASE WHEN n_events < 65 THEN 'few' ELSE 'many' END AS problem FROM c WHERE n_events NOT BETWEEN 65 AND 70""")
def game_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.density(events(spark, sf_dir), 65, 70)


@Q.add("""WITH l AS (SELECT l_orderkey AS g, l_suppkey % 4 AS i, count(*) AS k FROM lineitem GROUP BY 1, 2), w AS (SELECT count(*) AS n_wanted, avg((o_orderkey % 20 > 0)::INT) AS share FROM orders)
, f AS (SELECT n_wanted, share, (SELECT count(DISTINCT g) FROM l WHERE g NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 20 > 0)) AS n_orphans, (SELECT count(*) FROM l WHERE k > 1) AS n_repeated FROM w
UNION ALL SELECT n_wanted, avg((o_orderkey % 50 > 0)::INT), (SELECT count(DISTINCT g) FROM l WHERE g % 50 > 0 AND g NOT IN (SELECT o_orderkey FROM orders)), 0 FROM w, orders GROUP BY n_wanted)
SELECT n_wanted, round(share, 6) AS share, n_orphans, n_repeated, share >= 0.95 AND n_orphans = 0 AND n_repeated = 0 AS passes FROM f""")
def load_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id"))
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"), (F.col("l_suppkey") % 4).alias("event_idx"))
    """Gates of a load that lacks every twentieth game, and of one that lacks every fiftieth and has each event once."""
    once = e.where("game_id % 50 > 0").dropDuplicates()
    return rounded(integrity.load_gates(o, o.where("game_id % 20 > 0"), e).unionByName(integrity.load_gates(o, o.where("game_id % 50 > 0"), once)))


@Q.add("SELECT l_orderkey AS game_id, l_partkey AS player_id FROM lineitem GROUP BY 1, 2")
def shots_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots fetched once for each team of the game."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("GAME_ID"), F.col("l_partkey").alias("PLAYER_ID"), *[F.lit(0).alias(c) for c in ("PERIOD", "MINUTES_REMAINING", "SECONDS_REMAINING", "LOC_X", "LOC_Y")])
    return upsert.drop_duplicate_shots(li.unionByName(li)).select(F.col("GAME_ID").alias("game_id"), F.col("PLAYER_ID").alias("player_id"))


@Q.add(f"""WITH {G_SQL} SELECT status, count(*) AS n_games FROM g GROUP BY 1""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n_games"))
