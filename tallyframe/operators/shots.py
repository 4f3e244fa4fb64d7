"""Shots: places and zones attached to events, shares by type and zone, lineups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers


def enrich(events: DataFrame, shots: DataFrame) -> DataFrame:
    """events with shot_x, shot_y, shot_distance_ft and shot_zone of shots (game_id, event_num, loc_x, loc_y), on shot events only; the last shot of an event wins."""
    last = shots.groupBy("game_id", F.col("event_num").alias("event_idx")).agg(F.max_by(F.struct("loc_x", "loc_y"), F.struct("shot_ordinal")).alias("at"))
    out = events.drop("shot_x", "shot_y", "shot_distance_ft", "shot_zone").join(last, ["game_id", "event_idx"], "left")
    shot = F.col("event_type").isin("SHOT_MADE", "SHOT_MISSED")
    out = out.withColumn("shot_x", F.when(shot, F.col("at.loc_x").cast("double"))).withColumn("shot_y", F.when(shot, F.col("at.loc_y").cast("double"))).drop("at")
    out = out.withColumn("shot_distance_ft", numbers.shot_distance_ft(F.col("shot_x"), F.col("shot_y")))
    return out.withColumn("shot_zone", numbers.shot_zone(F.col("shot_distance_ft")))


def shares(events: DataFrame, *by: str) -> DataFrame:
    """Attempts, makes and their share by columns."""
    shot = events.where(F.col("event_type").isin("SHOT_MADE", "SHOT_MISSED"))
    g = shot.groupBy(*by).agg(F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "SHOT_MADE").alias("makes"), F.avg("shot_distance_ft").alias("avg_distance_ft"))
    return g.withColumn("fg_pct", F.round(100.0 * F.col("makes") / F.col("attempts"), 2))


def coordinate_coverage(events: DataFrame) -> DataFrame:
    """Over games: shots, shots with places, and the share as the mean of games' shares (two levels)."""
    shot = events.where(F.col("event_type").isin("SHOT_MADE", "SHOT_MISSED"))
    g = shot.groupBy("game_id").agg(F.count("*").alias("n"), F.count_if(F.col("shot_x").isNotNull() & F.col("shot_y").isNotNull()).alias("placed"))
    return g.agg(F.count("*").alias("n_games"), F.sum("n").alias("n_shots"), F.sum("placed").alias("n_placed"), F.avg(F.col("placed") / F.col("n")).alias("avg_share"), F.min(F.col("placed") / F.col("n")).alias("min_share"))


def lineup_sizes(stints: DataFrame, size: int = 5) -> DataFrame:
    """First-period lineups that don't have exactly that many rows for a game and team."""
    return stints.where("period = 1").groupBy("game_id", "team_id").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") != size)


def substitutions(events: DataFrame) -> DataFrame:
    """Substitutions of each game, over games: least, mean and greatest number."""
    g = events.groupBy("game_id").agg(F.count_if(F.col("event_type") == "SUBSTITUTION").alias("n"))
    return g.agg(F.count("*").alias("n_games"), F.min("n").alias("min_subs"), F.avg("n").alias("avg_subs"), F.max("n").alias("max_subs"))
