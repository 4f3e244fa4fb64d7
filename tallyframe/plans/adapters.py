"""The benchmark tables as games, events and venues. Shared SQL text prepares the same rows for Spark and for the oracle; parsing and metrics are written apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock

TEAMS = ["ATL", "BOS", "DEN", "LAL", "MIA"]
_home = "CASE user_id % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TEAMS)) + " END"
_away = "CASE user_id % 5 " + " ".join(f"WHEN {i} THEN '{TEAMS[(i + 1) % 5]}'" for i in range(5)) + " END"

#: A user's events as a game's: half of them in the first period.
EVENTS_SQL = f"""
SELECT game_id, period, event_idx, time_remaining, event_type, team_tricode, team_tricode AS team_id, home_team_tricode, away_team_tricode, event_type IN ('SHOT_MADE', 'FREE_THROW_MADE') AS shot_made,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_type IN ('SHOT_MADE', 'SHOT_MISSED') THEN (CASE WHEN event_id % 3 = 0 THEN 3 ELSE 2 END) WHEN event_type LIKE 'FREE%' THEN 1 END AS shot_value,
  CASE WHEN event_type = 'REBOUND' THEN (CASE WHEN k % 3 = 0 THEN 'Offensive Rebound' ELSE 'DEFENSIVE rebound' END) WHEN event_type = 'FLAGRANT_FOUL' THEN 'Flagrant ' || cast(1 + k % 2 AS string) || ' foul'
    WHEN event_type = 'FOUL' THEN (CASE WHEN k % 7 = 0 THEN 'Unsportsmanlike foul' ELSE 'Personal foul' END) WHEN event_type = 'TECHNICAL_FOUL' THEN 'Technical foul' WHEN event_type = 'TURNOVER' AND k % 4 = 0 THEN 'Collision, injury timeout' END AS description,
  CASE WHEN event_type = 'REBOUND' THEN (CASE WHEN k % 3 = 0 THEN 'OFFENSIVE' ELSE 'DEFENSIVE' END) END AS rebound_type,
  CASE WHEN event_id % 17 <> 0 THEN 'Player' || cast(event_id % 7 AS string) END AS player1_name_slug, CASE WHEN event_id % 5 = 0 THEN 'Player' || cast(event_id % 3 AS string) END AS player2_name_slug, cast(NULL AS string) AS player3_name_slug,
  event_id % 4 = 0 AS is_transition, event_id % 5 = 0 AS is_early_clock, CASE WHEN event_id % 3 = 0 THEN cast(event_id % 300 AS double) END AS elapsed_text,
  CASE WHEN event_type IN ('SHOT_MADE', 'SHOT_MISSED') AND event_id % 10 <> 0 THEN cast(event_id * 7 % 500 - 250 AS double) END AS shot_x, CASE WHEN event_type IN ('SHOT_MADE', 'SHOT_MISSED') AND event_id % 10 <> 0 THEN cast(event_id * 11 % 400 AS double) END AS shot_y
FROM (
  SELECT event_id, cast(event_id AS int) AS event_idx, k, period, '00223' || lpad(cast(user_id % 100000 AS string), 5, '0') AS game_id, {_home} AS home_team_tricode, {_away} AS away_team_tricode,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN {_home} ELSE {_away} END AS team_tricode,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'bad' WHEN event_id % 4 = 0 THEN 'PT' || m || 'M' || s || '.5S' WHEN event_id % 4 = 1 THEN m || ':' || lpad(s, 2, '0') || '.25' ELSE m || ':' || lpad(s, 2, '0') END AS time_remaining,
    CASE event_type WHEN 'view' THEN (CASE WHEN k < 12 THEN 'SHOT_MADE' ELSE 'SHOT_MISSED' END) WHEN 'click' THEN 'REBOUND' WHEN 'purchase' THEN (CASE WHEN k < 12 THEN 'FREE_THROW_MADE' ELSE 'FREE_THROW_MISSED' END)
      WHEN 'error' THEN (CASE WHEN k < 8 THEN 'PERSONAL_FOUL' WHEN k < 15 THEN 'FOUL' WHEN k < 18 THEN 'TECHNICAL_FOUL' ELSE 'FLAGRANT_FOUL' END)
      ELSE (CASE WHEN k < 8 THEN 'TURNOVER' WHEN k < 14 THEN 'SUBSTITUTION' WHEN k < 17 THEN 'JUMP_BALL' ELSE 'ASSIST' END) END AS event_type
  FROM (
    SELECT event_id, user_id, event_type, k, period, cast(cast(floor(left_sec / 60) AS int) AS string) AS m, cast(left_sec % 60 AS string) AS s FROM (
      SELECT event_id, user_id, event_type, (event_id * 31 + user_id * 17) % 20 AS k, period, (event_id * 13 + user_id) % (CASE WHEN period <= 4 THEN 36 ELSE 15 END) * 20 AS left_sec FROM (
        SELECT event_id, user_id, event_type, cast(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 + cast(floor(event_id / 2) AS bigint) % 4 END AS int) AS period FROM {{events}}) q1) q2) q3) q4
"""

#: An order as a game between customers; one that would meet itself meets customer 101.
GAMES_SQL = """
SELECT '00' || lpad(cast(o_orderkey AS string), 8, '0') AS game_id, 'C' || cast(o_custkey AS string) AS home_team_id, 'C' || cast(CASE WHEN o_custkey = 1 + (o_custkey * 7 + o_orderkey) % 100 THEN 101 ELSE 1 + (o_custkey * 7 + o_orderkey) % 100 END AS string) AS away_team_id,
  o_orderdate AS game_date_utc, cast(o_orderdate AS date) AS game_date_local, CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'SCHEDULED' ELSE 'LIVE' END AS status,
  cast(80 + o_orderkey * 13 % 50 AS int) AS home_score, cast(80 + o_orderkey * 29 % 50 AS int) AS away_score, cast(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS int) AS overtime_periods
FROM {orders}
"""

#: A customer as a venue.
VENUES_SQL = """
SELECT 'C' || cast(c_custkey AS string) AS team_id, cast(25 + c_custkey * 37 % 24 AS double) AS lat, cast(-122 + c_custkey * 53 % 50 AS double) AS lon, cast(c_custkey * 71 % 1800 AS double) AS altitude_m,
  CASE c_custkey % 6 WHEN 0 THEN 'America/Los_Angeles' WHEN 1 THEN 'America/Denver' WHEN 2 THEN 'America/Chicago' WHEN 3 THEN 'America/New_York' WHEN 4 THEN 'America/Phoenix' ELSE 'Europe/Paris' END AS arena_tz
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """table() dealt out by its key over as many tasks as an exchange has: a narrow table of few row groups, each of whose rows takes long to work on, is else read and worked on by a few tasks."""
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def _prepared(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name)})


def settled(df: DataFrame) -> DataFrame:
    """df behind a Generate of one row: what prepares its columns, long CASE texts here, isn't repeated in each filter above it. Stored tables need none."""
    return df.select(F.inline(F.array(F.struct("*"))))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = settled(_prepared(spark, sf_dir, EVENTS_SQL, "events"))
    e = settled(e.withColumn("clock_ms_remaining", clock.parse_clock_ms(F.col("time_remaining"), F.col("period"))))
    return e.withColumn("seconds_elapsed", F.coalesce(clock.seconds_elapsed_in_period(F.col("clock_ms_remaining"), F.col("period")), F.col("elapsed_text"))).withColumn("shot_distance_ft", F.sqrt(F.col("shot_x") * F.col("shot_x") + F.col("shot_y") * F.col("shot_y")) / 10)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir, GAMES_SQL, "orders")


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir, VENUES_SQL, "customer")


COLON, DURATION = r"^(\d{1,2}):(\d{2})(?:\.(\d{1,3}))?$", r"^PT(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$"


def clock_ms_sql(t: str, period: str) -> str:
    """The oracle's clock parser."""
    g = lambda p, k: f"regexp_extract({t}, '{p}', {k})"
    colon = f"CASE WHEN try_cast({g(COLON, 2)} AS BIGINT) < 60 THEN (try_cast({g(COLON, 1)} AS BIGINT) * 60 + try_cast({g(COLON, 2)} AS BIGINT)) * 1000 + try_cast(rpad(coalesce(nullif({g(COLON, 3)}, ''), '0'), 3, '0') AS BIGINT) END"
    seconds = f"coalesce(try_cast({g(DURATION, 2)} AS DOUBLE), 0.0)"
    iso = f"CASE WHEN {seconds} < 60 THEN CAST(round((coalesce(try_cast({g(DURATION, 1)} AS BIGINT), 0) * 60 + {seconds}) * 1000) AS BIGINT) END"
    raw = f"CASE WHEN regexp_matches({t}, '{COLON}') THEN {colon} WHEN regexp_matches({t}, '{DURATION}') THEN {iso} END"
    length = f"CASE WHEN {period} BETWEEN 1 AND 4 THEN 720000 ELSE 300000 END"
    return f"CASE WHEN ({raw}) <= {length} THEN ({raw}) END"


E_SQL = f"""e0 AS ({EVENTS_SQL.replace("{events}", "events")}),
e1 AS (SELECT *, {clock_ms_sql("time_remaining", "period")} AS clock_ms_remaining FROM e0),
e AS (SELECT *, coalesce(((CASE WHEN period BETWEEN 1 AND 4 THEN 720000 ELSE 300000 END) - clock_ms_remaining) / 1000.0::DOUBLE, elapsed_text) AS seconds_elapsed, sqrt(shot_x * shot_x + shot_y * shot_y) / 10 AS shot_distance_ft FROM e1)"""
G_SQL = f"g AS ({GAMES_SQL.replace('{orders}', 'orders')})"
V_SQL = f"v AS ({VENUES_SQL.replace('{customer}', 'customer')})"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to digits places, for comparison across engines."""
    return df.select(*[(F.round(c, digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


class Queries:
    """Collects name -> query and name -> oracle SQL."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        def keep(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return keep
