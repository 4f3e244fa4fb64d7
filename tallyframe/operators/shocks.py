"""Early disruptions of the first period: two quick fouls, technicals, flagrants, injuries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock, codes, text
from .sequence import described, in_order, so_far, with_possession_counts

#: Words that tell of an injury.
INJURY_WORDS = ["injury", "hurt", "twisted", "sprain", "strain", "collision"]
NEEDED = ["game_id", "event_idx", "event_type", "team_tricode", "description", "seconds_elapsed", "player1_name_slug", "player2_name_slug", "player3_name_slug"]


def early_shocks(events: DataFrame, foul_limit_sec: float = 360.0, absent_possessions: int = 6) -> DataFrame:
    """A row for each shock of the first period. One event can be several shocks.

    One exchange by game: every window is keyed by game or finer, and what an event is goes into an array that is taken
    apart at the end. Substitutions and last appearances come from a row for each player that an event names.
    """
    c = F.col
    yes = lambda x: F.coalesce(x, F.lit(False))
    e = with_possession_counts(events.where("period = 1").select(*NEEDED))
    others = F.filter(F.array("player2_name_slug", "player3_name_slug"), lambda p: p.isNotNull())
    named = F.concat(F.array(F.struct(c("player1_name_slug").alias("who"), F.lit(True).alias("own"))), F.transform(others, lambda p: F.struct(p.alias("who"), F.lit(False).alias("own"))))
    e = e.select("*", F.inline(named))
    of_player = Window.partitionBy("game_id", "who")
    later = of_player.orderBy("event_idx").rowsBetween(1, Window.unboundedFollowing)
    e = e.withColumn("next_sub", F.first(F.when(c("own") & (c("event_type") == "SUBSTITUTION"), c("changes")), ignorenulls=True).over(later))
    e = e.withColumn("last", F.max(F.struct("event_idx", "changes_after")).over(of_player)).where("own")

    kind, elapsed = c("event_type"), F.coalesce("seconds_elapsed", F.lit(0.0))
    has = (F.coalesce("player1_name_slug", F.lit("")) != "") & (F.coalesce("team_tricode", F.lit("")) != "")
    odd = described("technical") | described("flagrant") | described("unsportsmanlike")
    e = e.withColumn("is_foul", yes((kind == "FOUL") & has & (c("seconds_elapsed") <= foul_limit_sec) & ~odd))
    e = e.withColumn("is_flagrant", yes(((kind == "FLAGRANT_FOUL") | described("flagrant")) & has))
    e = e.withColumn("is_technical", yes((kind == "TECHNICAL_FOUL") | described("technical")))
    e = e.withColumn("is_injury", yes(F.lower("description").rlike("|".join(INJURY_WORDS)) & has))
    pair = ("team_tricode", "player1_name_slug")
    before = in_order(*pair).rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("nth_foul", F.sum(c("is_foul").cast("int")).over(so_far(*pair))).withColumn("first_foul", F.last(F.when(c("is_foul"), c("event_idx")), ignorenulls=True).over(before))
    e = e.withColumn("nth_flagrant", F.sum(c("is_flagrant").cast("int")).over(so_far(*pair)))
    e = e.withColumn("t_team", F.coalesce(F.nullif("team_tricode", F.lit("")), F.lit("UNK"))).withColumn("t_player", F.coalesce(F.nullif("player1_name_slug", F.lit("")), F.lit("TEAM")))
    e = e.withColumn("nth_technical", F.sum(c("is_technical").cast("int")).over(so_far("t_team", "t_player")))
    seen_later = (c("last.event_idx") > c("event_idx")) & (c("last.event_idx") != 0)
    e = e.withColumn("absent", F.when(yes(seen_later), c("last.changes_after")).otherwise(c("changes_after")))

    def shock(when, kind_, seq, start, end, notes, since=c("changes_after"), team=c("team_tricode"), player=c("player1_name_slug")):
        cells = {"team_tricode": team, "player_slug": player, "shock_type": F.lit(kind_), "shock_seq": seq.cast("int"), "event_idx_start": start, "event_idx_end": end.cast("int"), "since": since, "notes": notes}
        return F.when(when, F.struct(*[v.alias(k) for k, v in cells.items()]))

    at, none, one = c("event_idx"), F.lit(None), F.lit(1)
    found = F.array_compact(F.array(
        shock(c("is_foul") & (c("nth_foul") == 2), "TWO_PF_EARLY", one, c("first_foul"), at, F.format_string("2 PF in %.1fs", "seconds_elapsed")),
        shock(c("is_technical"), "TECH", c("nth_technical"), at, none, F.lit("Technical foul"), team=c("t_team"), player=c("t_player")),
        shock(c("is_flagrant"), "FLAGRANT", c("nth_flagrant"), at, none, text.flagrant_label(c("description"))),
        shock(c("is_injury") & (c("absent") >= absent_possessions), "INJURY_LEAVE", one, at, F.when(c("last.event_idx") > at, c("last.event_idx")), F.format_string("Absent %d possessions", "absent"), since=c("absent")),
    ))
    soon = yes(c("next_sub") - c("changes") <= 1)
    each = e.select("game_id", elapsed.alias("elapsed"), soon.alias("soon"), F.inline(found))
    return each.select(
        "game_id", "team_tricode", "player_slug", "shock_type", "shock_seq", F.lit(1).alias("period"), clock.clock_text(c("elapsed")).alias("clock_hhmmss"), "event_idx_start", "event_idx_end",
        (c("soon") & (c("player_slug") != "TEAM")).alias("immediate_sub"), c("since").alias("poss_since_event"), "notes",
        codes.severity(c("shock_type"), c("notes")).alias("severity"), F.greatest(F.lit(0.0), 720.0 - c("elapsed")).alias("time_remaining"), c("elapsed").alias("seconds_elapsed"),
    )
