"""Seasons and pipelines: completeness by season, which derived tables can be made, reprocessing, quality thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .integrity import MIN_GAMES, MIN_Q1, MIN_SCORE, MIN_TIME

def derivable_tables(sources: DataFrame, needs: DataFrame) -> DataFrame:
    """sources (game_id, source), needs (table, source: any one of a table's sources will do) -> game_id and the derived tables that can
    be made, sorted and comma-joined; none: empty. needs is a small dimension, which Spark broadcasts by its own size check."""
    have = sources.select("game_id", "source").distinct()
    can = have.join(needs.select("source", "table").distinct(), "source", "left").groupBy("game_id").agg(F.collect_set("table").alias("tables"))
    return can.select("game_id", F.array_join(F.array_sort("tables"), ",").alias("tables"))


def season_completeness(games: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """By season: games, games with each part, and the percentage with all. A part's rows count once for a game."""
    for name, rows in parts.items():
        games = games.join(rows.select("game_id").distinct().withColumn(f"has_{name}", F.lit(True)), "game_id", "left")
    has = {n: F.coalesce(F.col(f"has_{n}"), F.lit(False)) for n in parts}
    every = F.lit(True)
    for c in has.values():
        every = every & c
    out = games.groupBy("season").agg(F.count("*").alias("n_games"), *[F.count_if(c).alias(f"n_{n}") for n, c in has.items()], F.count_if(every).alias("n_complete"))
    return out.withColumn("complete_pct", F.coalesce(F.try_divide(F.col("n_complete") * 100.0, F.col("n_games")), F.lit(0.0)))


def to_reprocess(wanted: DataFrame, games: DataFrame, force: bool = False) -> DataFrame:
    """Ids of wanted whose game is missing, SCHEDULED or LIVE; all if forced."""
    met = wanted.select("game_id").distinct().join(games.select("game_id", "status"), "game_id", "left")
    return met if force else met.where("status is null or status in ('SCHEDULED', 'LIVE')")


def thresholds(figures: DataFrame) -> DataFrame:
    """figures (one row: q1_share, game_share, time_share, score) as (metric, value, least, passes); nulls count as 0."""
    limits = {"q1_share": MIN_Q1, "game_share": MIN_GAMES, "time_share": MIN_TIME, "score": MIN_SCORE}
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias("value"), F.lit(v).alias("least")) for n, v in limits.items()])
    return figures.select(F.explode(rows).alias("r")).select("r.*").withColumn("passes", F.col("value") >= F.col("least"))


def minutes_valid(rows: DataFrame, text: str = "min") -> DataFrame:
    """By game: rows, rows whose minutes can't be read, and whether at most half fail."""
    from ..functions.clock import minutes_played

    failed = minutes_played(F.col(text))["seconds"].isNull()
    return rows.groupBy("game_id").agg(F.count("*").alias("n_rows"), F.count_if(failed).alias("n_failed")).withColumn("is_valid", F.col("n_failed") * 2 <= F.col("n_rows"))


def recent_rollup(games: DataFrame, parts: dict[str, DataFrame], as_of: Column, days_back: int = 3) -> DataFrame:
    """(table, n_games, n_rows) of each part's rows of the games from days_back days before as_of up to it; parts without any are there with 0."""
    recent = games.where(F.col("game_date_local").between(F.date_sub(as_of, days_back), as_of)).select("game_id").distinct()
    one = lambda name, rows: rows.join(recent, "game_id", "left_semi").groupBy("game_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("n_games"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).select(F.lit(name).alias("table"), "n_games", "n_rows")
    return reduce(DataFrame.unionByName, [one(n, r) for n, r in parts.items()])


def chosen_sources(available: DataFrame, capabilities: DataFrame) -> DataFrame:
    """available (game_id, source), capabilities (source, data_type, is_preferred: a small dimension) -> for each game and data type that a source
    of its own gives: source, the preferred one, else the first in order, and n_sources."""
    met = available.select("game_id", "source").distinct().join(capabilities, "source")
    first = F.min(F.struct((~F.coalesce("is_preferred", F.lit(False))).alias("later"), "source"))
    return met.groupBy("game_id", "data_type").agg(first.alias("f"), F.count("*").alias("n_sources")).select("game_id", "data_type", F.col("f.source").alias("source"), "n_sources")
