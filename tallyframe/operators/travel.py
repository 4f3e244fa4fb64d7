"""Schedules: rest, density and travel of each team between games."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, numbers


def team_schedule(games: DataFrame) -> DataFrame:
    """games once for each of the two teams: game_id, team_tricode, home_team_tricode, game_date_utc."""
    one = lambda c: games.select("game_id", F.col(c).alias("team_tricode"), "home_team_tricode", "game_date_utc")
    return one("home_team_tricode").unionByName(one("away_team_tricode"))


def with_rest(schedule: DataFrame, team: str = "team_tricode", at: str = "game_date_utc", tie: str = "game_id") -> DataFrame:
    """days_rest and density flags from the team's earlier games; null rest at its first game."""
    order = Window.partitionBy(team).orderBy(at, tie)
    day = F.to_date(at)
    back = {k: F.datediff(day, F.lag(day, k).over(order)) for k in (1, 2, 4)}
    flag = lambda c: F.coalesce(c, F.lit(False))
    return (
        schedule.withColumn("days_rest", back[1] - 1).withColumn("is_back_to_back", flag(back[1] == 1))
        .withColumn("is_3_in_4", flag(back[2] + 1 <= 4)).withColumn("is_5_in_7", flag(back[4] + 1 <= 7))
    )


def schedule_travel(games: DataFrame, venues: DataFrame) -> DataFrame:
    """A row for each team's game after its first, where both legs' venues are known. venues (team_id, arena_tz, lat, lon, altitude_m) has a row for each team."""
    order = Window.partitionBy("team_tricode").orderBy("game_date_utc", "game_id")
    legs = with_rest(team_schedule(games)).withColumn("prev_home", F.lag("home_team_tricode").over(order)).where("days_rest is not null")
    place = lambda p: venues.select(F.col("team_id").alias(f"{p}_team"), *[F.col(c).alias(f"{p}_{c}") for c in ("arena_tz", "lat", "lon", "altitude_m")])
    legs = legs.join(place("here"), F.col("home_team_tricode") == F.col("here_team")).join(place("prev"), F.col("prev_home") == F.col("prev_team"))
    legs = legs.withColumn("distance_km", numbers.haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("here_lat"), F.col("here_lon")))
    legs = legs.withColumn("timezone_shift_hours", dates.timezone_shift(F.col("prev_arena_tz"), F.col("here_arena_tz"))).withColumn("altitude_change_m", F.col("here_altitude_m") - F.col("prev_altitude_m"))
    index = numbers.circadian_index(F.col("timezone_shift_hours"), F.col("distance_km"), F.col("altitude_change_m"), F.col("days_rest"), F.hour("game_date_utc"))
    return legs.select("game_id", "team_tricode", "is_back_to_back", "is_3_in_4", "is_5_in_7", "days_rest", "timezone_shift_hours", "distance_km", "altitude_change_m", index.alias("circadian_index"))
