"""Operators on ordered events. All windows are keyed by game (and finer), so one exchange by game serves a whole chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What makes two events the same for dedup.
SAME = ["period", "clock_ms_remaining", "event_type", "team_tricode"]
#: Events that change possession for the shock operators.
POSSESSION_CHANGES = ["PERIOD_BEGIN", "JUMP_BALL", "SHOT_MADE", "REBOUND", "TURNOVER"]


def in_order(*more: str):
    return Window.partitionBy("game_id", *more).orderBy("event_idx")


def so_far(*more: str):
    return in_order(*more).rowsBetween(Window.unboundedPreceding, 0)


def described(word: str) -> Column:
    return F.coalesce(F.lower("description").contains(word), F.lit(False))


def dedup_consecutive(events: DataFrame) -> DataFrame:
    """Without events that equal the one before them in the game, null = null."""
    key = F.struct(*SAME)
    return events.withColumn("before", F.lag(key).over(in_order())).where(F.col("before").isNull() | ~F.col("before").eqNullSafe(key)).drop("before")


def dedup_first_seen(events: DataFrame) -> DataFrame:
    """The first of all equal events of a game."""
    first = Window.partitionBy("game_id", *SAME).orderBy("event_idx")
    return events.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")


def keep_latest(rows: DataFrame, keys: list[str], by: str, tie: str) -> DataFrame:
    """The latest row of each key."""
    latest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(by), F.desc(tie))
    return rows.withColumn("nth", F.row_number().over(latest)).where("nth = 1").drop("nth")


def nth_event(events: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n-th event of each game and keys."""
    return events.withColumn("nth", F.row_number().over(in_order(*keys))).where(F.col("nth") == n).drop("nth")


def with_possession_counts(events: DataFrame) -> DataFrame:
    """changes: possession changes of the game up to and with the event; changes_after: those after it."""
    change = F.col("event_type").isin(POSSESSION_CHANGES).cast("int")
    running = F.sum(F.coalesce(change, F.lit(0))).over(so_far())
    total = F.sum(F.coalesce(change, F.lit(0))).over(Window.partitionBy("game_id"))
    return events.withColumn("changes", running).withColumn("changes_after", total - running)


def with_immediate_sub(shocks: DataFrame, events: DataFrame) -> DataFrame:
    """shocks (game_id, event_idx, player_slug, changes) with immediate_sub: a later substitution of the player within one possession change."""
    subs = events.where((F.col("event_type") == "SUBSTITUTION") & F.col("player1_name_slug").isNotNull())
    subs = subs.select(F.col("game_id").alias("s_game"), F.col("player1_name_slug").alias("s_player"), F.col("event_idx").alias("s_idx"), F.col("changes").alias("s_changes"))
    met = (F.col("game_id") == F.col("s_game")) & (F.col("player_slug") == F.col("s_player")) & (F.col("s_idx") > F.col("event_idx")) & (F.col("s_changes") - F.col("changes") <= 1)
    near = shocks.select("game_id", "event_idx", "player_slug", "changes").distinct().join(subs, met, "left_semi")
    near = near.select("game_id", "event_idx", "player_slug", F.lit(True).alias("found"))
    return shocks.join(near, ["game_id", "event_idx", "player_slug"], "left").withColumn("immediate_sub", F.coalesce("found", F.lit(False))).drop("found")


def last_appearance(shocks: DataFrame, events: DataFrame) -> DataFrame:
    """shocks (game_id, event_idx, player_slug) with last_seen: the last later event with the player in any of three places."""
    slots = F.array("player1_name_slug", "player2_name_slug", "player3_name_slug")
    seen = events.select("game_id", "event_idx", F.explode(slots).alias("player_slug")).where("player_slug is not null").groupBy("game_id", "player_slug").agg(F.max("event_idx").alias("last_idx"))
    out = shocks.join(seen, ["game_id", "player_slug"], "left")
    return out.withColumn("last_seen", F.when(F.col("last_idx") > F.col("event_idx"), F.col("last_idx"))).drop("last_idx")


def with_opponent(events: DataFrame, *more: str) -> DataFrame:
    """opponent: the other of the game's two teams; null unless there are two."""
    all_ = Window.partitionBy("game_id", *more)
    low, high = F.min("team_tricode").over(all_), F.max("team_tricode").over(all_)
    other = F.when(F.col("team_tricode") == low, high).when(F.col("team_tricode") == high, low)
    return events.withColumn("opponent", F.when(low != high, other))


def track_possession(events: DataFrame, *more: str) -> DataFrame:
    """possession (the team that has the ball after the event), possession_change (0 or 1) and possession_unknown (0 or 1).

    Each event may assign the ball; what was assigned last is carried forward in a struct, so that an assigned null differs
    from none.
    """
    events = with_opponent(events, *more)
    team, opponent, kind = F.col("team_tricode"), F.col("opponent"), F.col("event_type")
    none = F.lit(None).cast("struct<team:string>")
    given = lambda c: F.struct(c.alias("team"))
    rebound = (kind == "REBOUND") & described("defensive")
    assigned = (
        F.when(team.isNull(), none)
        .when(kind.isin("SHOT_MADE", "FREE_THROW_MADE", "TURNOVER", "PERSONAL_FOUL"), given(opponent))
        .when(rebound | (kind == "JUMP_BALL"), given(team)).otherwise(none)
    )
    before = in_order(*more).rowsBetween(Window.unboundedPreceding, -1)
    events = events.withColumn("assigned", assigned).withColumn("held", F.last("assigned", ignorenulls=True).over(before)["team"])
    held = F.col("held")
    change = (
        F.when(team.isNull(), 0)
        .when(kind.isin("SHOT_MADE", "FREE_THROW_MADE"), (held.isNotNull() & (held != team)).cast("int"))
        .when(rebound | (kind == "JUMP_BALL"), (~held.eqNullSafe(team)).cast("int"))
        .when(kind.isin("TURNOVER", "PERSONAL_FOUL"), (opponent.isNotNull() & ~held.eqNullSafe(opponent)).cast("int")).otherwise(0)
    )
    now = F.coalesce(F.col("assigned"), F.when(held.isNotNull(), F.struct(held.alias("team"))))["team"]
    return events.withColumn("possession_change", change).withColumn("possession_unknown", team.isNull().cast("int")).withColumn("possession", now).drop("assigned", "held")
