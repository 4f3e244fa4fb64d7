"""Clock-window metrics of games: the opening window, its events, and the first minutes of each period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock, numbers
from .sequence import dedup_consecutive, dedup_first_seen, described, in_order, track_possession

#: Expected effective field-goal share and team fouls that give the bonus.
EXPECTED_EFG, BONUS_FOULS = 0.52, 4


def in_window(period: int, start_sec: float, end_sec: float) -> Column:
    """Events of a period's window: by clock where there is one, else by seconds elapsed."""
    length = clock.REGULATION_MS if period <= 4 else clock.OVERTIME_MS
    by_clock = clock.in_clock_window(F.col("clock_ms_remaining"), int(length - end_sec * 1000), int(length - start_sec * 1000))
    return (F.col("period") == period) & F.when(F.col("clock_ms_remaining").isNotNull(), by_clock).otherwise(F.coalesce(F.col("seconds_elapsed").between(start_sec, end_sec), F.lit(False)))


def window_team_metrics(events: DataFrame, games: DataFrame | None = None, period: int = 1, start_sec: float = 0, end_sec: float = 240, expected_pace: float = 100.0) -> DataFrame:
    """One row for each game whose window has exactly two teams.

    games (game_id, home_team_tricode, away_team_tricode) tells home from away; without it events' own columns of these names do,
    and without those the first in the alphabet is home. One exchange by game: dedup and the team windows share their key, then one conditional aggregate.
    """
    e = dedup_consecutive(events.where(in_window(period, start_sec, end_sec)))
    e = e.withColumn("team", F.nullif("team_tricode", F.lit("")))
    every = Window.partitionBy("game_id")
    low, high = F.min("team").over(every), F.max("team").over(every)
    odd = F.max(((F.col("team") != low) & (F.col("team") != high)).cast("int")).over(every)
    e = e.withColumn("low", low).withColumn("high", high).withColumn("odd", odd).where("low <> high and coalesce(odd, 0) = 0")
    if games is None and "home_team_tricode" not in events.columns:
        e = e.withColumn("home", F.col("low")).withColumn("away", F.col("high"))
    else:
        # A game has one row, and the window keeps the key of the exchange.
        if games is None:
            e = e.withColumn("g_home", F.max("home_team_tricode").over(every)).withColumn("g_away", F.max("away_team_tricode").over(every))
        else:
            known = games.select("game_id", F.col("home_team_tricode").alias("g_home"), F.col("away_team_tricode").alias("g_away"))
            e = e.drop("home_team_tricode", "away_team_tricode").join(known, "game_id", "left")
        swapped = (F.col("g_home") == F.col("high")) & (F.col("g_away") == F.col("low"))
        e = e.withColumn("home", F.when(swapped, F.col("high")).otherwise(F.col("low"))).withColumn("away", F.when(swapped, F.col("low")).otherwise(F.col("high")))
    kind, made = F.col("event_type"), F.coalesce(F.col("shot_made"), F.lit(False))
    shot, free = kind.isin("SHOT_MADE", "SHOT_MISSED"), kind.isin("FREE_THROW_MADE", "FREE_THROW_MISSED")
    foul = kind.isin("FOUL", "PERSONAL_FOUL")
    fouls = F.sum(foul.cast("int")).over(in_order("team").rowsBetween(Window.unboundedPreceding, 0))
    e = e.withColumn("fouls", fouls).withColumn("offensive", described("offensive"))
    side = {"home": F.col("team") == F.col("home"), "away": F.col("team") == F.col("away")}
    three = F.coalesce(F.col("shot_value") == 3, F.lit(False))
    count = lambda c: F.count_if(c)
    aggs = [F.first("home").alias("home_team_tricode"), F.first("away").alias("away_team_tricode"), count(kind.isin("SHOT_MADE", "TURNOVER", "REBOUND")).alias("possessions_elapsed")]
    for s, mine in side.items():
        aggs += [
            count(mine & shot).alias(f"{s}_fga"), count(mine & shot & made).alias(f"{s}_fgm"), count(mine & shot & made & three).alias(f"{s}_3pm"), count(mine & free).alias(f"{s}_fta"),
            count(mine & (kind == "REBOUND") & F.col("offensive")).alias(f"{s}_oreb"), count(mine & (kind == "REBOUND") & ~F.col("offensive")).alias(f"{s}_dreb"), count(mine & (kind == "TURNOVER")).alias(f"{s}_tov"),
            F.min_by(F.when(mine & (F.col("fouls") >= BONUS_FOULS) & F.col("seconds_elapsed").isNotNull(), F.col("seconds_elapsed")), F.when(mine & (F.col("fouls") >= BONUS_FOULS) & F.col("seconds_elapsed").isNotNull(), F.col("event_idx"))).alias(f"{s}_bonus_at"),
        ]
    aggs += [F.avg(F.coalesce(F.col("is_transition"), F.lit(False)).cast("double")).alias("transition_rate"), F.avg(F.coalesce(F.col("is_early_clock"), F.lit(False)).cast("double")).alias("early_clock_rate")]
    g = e.groupBy("game_id").agg(*aggs)
    minutes, c = (end_sec - start_sec) / 60.0, F.col
    each = F.greatest(F.lit(1), F.floor(c("possessions_elapsed") / 2))
    out = [
        c("game_id"), c("home_team_tricode"), c("away_team_tricode"), c("possessions_elapsed"),
        (c("possessions_elapsed") / F.lit(minutes) * 48.0).alias("pace48_actual"), F.lit(float(expected_pace)).alias("pace48_expected"),
    ]
    for s in side:
        out += [numbers.effective_fg(c(f"{s}_fgm"), c(f"{s}_3pm"), c(f"{s}_fga")).alias(f"{s}_efg_actual"), F.lit(EXPECTED_EFG).alias(f"{s}_efg_expected"), numbers.divide(c(f"{s}_tov"), each).alias(f"{s}_to_rate"), numbers.divide(c(f"{s}_fta"), c(f"{s}_fga")).alias(f"{s}_ft_rate")]
    for s, o in (("home", "away"), ("away", "home")):
        out += [numbers.rebound_share(c(f"{s}_oreb"), c(f"{o}_dreb")).alias(f"{s}_orb_pct"), numbers.rebound_share(c(f"{s}_dreb"), c(f"{o}_oreb")).alias(f"{s}_drb_pct")]
        out += [F.coalesce(F.greatest(F.lit(0.0), F.lit(float(end_sec)) - c(f"{s}_bonus_at")), F.lit(0.0)).alias(f"bonus_time_{s}_sec")]
    return g.select(*out, "transition_rate", "early_clock_rate")


def window_events(events: DataFrame, minutes: int = 4) -> DataFrame:
    """First-period events of the first minutes, deduplicated, with possession."""
    first = dedup_first_seen(events.where("period = 1"))
    kept = first.where(clock.valid_period_event(F.col("period"), F.col("clock_ms_remaining")) & clock.in_first_minutes(F.col("period"), F.col("clock_ms_remaining"), minutes))
    return track_possession(kept)


def early_period_stats(events: DataFrame, minutes: int = 4) -> DataFrame:
    """A row for each game, period and team of the periods' first minutes, with lead changes and net rating.

    All windows and the aggregate are keyed by (game, period).
    """
    ms = F.col("clock_ms_remaining")
    e = events.where(clock.valid_period_event(F.col("period"), ms) & clock.in_first_minutes(F.col("period"), ms, minutes))
    e = dedup_first_seen(e).where("team_tricode is not null and team_tricode <> ''")
    kind = F.col("event_type")
    points = F.when(kind == "SHOT_MADE", F.coalesce(F.nullif("shot_value", F.lit(0)), F.lit(2))).when(kind == "FREE_THROW_MADE", 1).otherwise(0)
    e = with_lead_changes(e.withColumn("points", points))
    oreb = (kind == "REBOUND") & described("offensive")
    g = e.groupBy("game_id", "period", "team_tricode").agg(
        F.sum("points").alias("points_for"), F.count_if(kind.isin("SHOT_MADE", "SHOT_MISSED")).alias("fga"), F.count_if(kind.isin("FREE_THROW_MADE", "FREE_THROW_MISSED")).alias("fta"),
        F.count_if(oreb).alias("oreb"), F.count_if(kind == "TURNOVER").alias("tov"), F.sum("lead_change").alias("lead_changes"), F.count("*").alias("n_events"),
    )
    against = F.sum("points_for").over(Window.partitionBy("game_id", "period")) - F.col("points_for")
    poss = numbers.estimated_possessions(F.col("fga"), F.col("fta"), F.col("oreb"), F.col("tov"))
    g = g.withColumn("points_against", against).withColumn("possessions", poss)
    return g.withColumn("net_rating", (F.col("points_for") - F.col("points_against")) / F.col("possessions") * 100)


def with_lead_changes(events: DataFrame) -> DataFrame:
    """lead_change: 1 where a score changes the leader of its game and period; of equal scores, the team that scored first leads.

    Running scores per team are compared by carrying each of the two teams' latest (score, first score) forward, for any
    number of teams through a map of at most as many entries as there are teams.
    """
    scored = F.col("points") > 0
    team = in_order("period", "team_tricode").rowsBetween(Window.unboundedPreceding, 0)
    e = events.withColumn("score", F.sum("points").over(team)).withColumn("first_idx", F.min(F.when(scored, F.col("event_idx"))).over(team))
    # The leader's score only grows: whoever has the greatest running score seen so far, first scorer first, leads.
    mine = F.struct(F.col("score"), (-F.col("first_idx")).alias("early"), F.col("team_tricode"))
    best = F.max(F.when(scored, mine)).over(in_order("period").rowsBetween(Window.unboundedPreceding, 0))
    e = e.withColumn("leader", best["team_tricode"])
    before = F.last(F.when(scored, F.col("leader")), ignorenulls=True).over(in_order("period").rowsBetween(Window.unboundedPreceding, -1))
    return e.withColumn("lead_change", F.when(scored & before.isNotNull() & (before != F.col("leader")), 1).otherwise(0)).drop("score", "first_idx")
