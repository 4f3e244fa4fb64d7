"""Code maps as small dimension tables: (profile, code, value). Unknown codes are null and can be listed as drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Event codes by profile.
EVENT_CODES = {
    "row_model": {1: "SHOT_MADE", 2: "SHOT_MISSED", 3: "FREE_THROW_MADE", 4: "FREE_THROW_MISSED", 5: "REBOUND", 6: "TURNOVER", 7: "FOUL", 8: "SUBSTITUTION", 9: "TIMEOUT", 10: "JUMP_BALL", 11: "EJECTION", 12: "PERIOD_BEGIN", 13: "PERIOD_END", 18: "INSTANT_REPLAY"},
    "enum": {1: "SHOT_MADE", 2: "SHOT_MISSED", 3: "FREE_THROW_MADE", 4: "FREE_THROW_MISSED", 5: "REBOUND", 6: "FOUL", 7: "FOUL", 8: "SUBSTITUTION", 9: "TIMEOUT", 10: "JUMP_BALL", 11: "EJECTION", 12: "PERIOD_BEGIN", 13: "PERIOD_END", 18: "INSTANT_REPLAY"},
    "preprocess": {1: "shot", 2: "shot", 3: "free_throw", 4: "rebound", 5: "turnover", 6: "foul", 7: "violation", 8: "substitution", 9: "timeout", 10: "jump_ball", 11: "ejection", 12: "period_start", 13: "period_end", 18: "technical", 19: "flagrant", 20: "instant_replay"},
}
#: Event words.
EVENT_WORDS = {
    "shot": "SHOT_MADE", "free_throw": "FREE_THROW_MADE", "rebound": "REBOUND", "turnover": "TURNOVER", "foul": "FOUL", "violation": "VIOLATION", "substitution": "SUBSTITUTION", "timeout": "TIMEOUT", "jump_ball": "JUMP_BALL",
    "ejection": "EJECTION", "period_start": "PERIOD_BEGIN", "period_end": "PERIOD_END", "technical": "TECHNICAL_FOUL", "flagrant": "FLAGRANT_FOUL", "instant_replay": "INSTANT_REPLAY",
}
#: Foul, rebound and turnover subcodes, shot zones, positions.
FOUL_CODES = {1: "personal", 2: "shooting", 3: "loose_ball", 4: "offensive", 5: "inbound", 6: "away_from_play", 7: "punch", 8: "clear_path", 9: "double", 10: "technical", 11: "flagrant1", 12: "flagrant2", 13: "defensive", 14: "take", 15: "transition_take"}
REBOUND_CODES = {0: "off", 1: "def"}
TURNOVER_CODES = {1: "bad_pass", 2: "lost_ball", 3: "traveling", 4: "double_dribble", 5: "shot_clock", 6: "kicked_ball", 7: "lane_violation", 8: "offensive_foul", 9: "discontinued_dribble", 10: "backcourt", 11: "palming", 40: "step_out_of_bounds", 41: "out_of_bounds", 42: "steal"}
ZONE_WORDS = {"Restricted Area": "rim", "In The Paint (Non-RA)": "short_mid", "Mid-Range": "long2", "Left Corner 3": "corner3", "Right Corner 3": "corner3", "Above the Break 3": "abovebreak3"}
POSITIONS = {"G": "G", "F": "F", "C": "C", "PG": "G", "SG": "G", "SF": "F", "PF": "F"}
#: Game status by profile: words and numbers of rows, of the enumeration, of the bridge, and those that are shown.
STATUS = {
    "rows": {"FINAL": "FINAL", "FINISHED": "FINAL", "COMPLETED": "FINAL", "LIVE": "LIVE", "IN_PROGRESS": "LIVE", "IN PROGRESS": "LIVE", "SCHEDULED": "SCHEDULED", "UPCOMING": "SCHEDULED", "POSTPONED": "POSTPONED", "CANCELLED": "CANCELLED", "CANCELED": "CANCELLED", "SUSPENDED": "SUSPENDED", "RESCHEDULED": "RESCHEDULED"},
    "enum": {"1": "SCHEDULED", "2": "LIVE", "3": "FINAL", "FINAL": "FINAL", "FINISHED": "FINAL", "COMPLETED": "FINAL", "LIVE": "LIVE", "IN_PROGRESS": "IN_PROGRESS", "ACTIVE": "LIVE", "SCHEDULED": "SCHEDULED", "UPCOMING": "SCHEDULED", "POSTPONED": "POSTPONED", "CANCELLED": "CANCELLED", "CANCELED": "CANCELLED", "SUSPENDED": "SUSPENDED", "RESCHEDULED": "RESCHEDULED"},
    "bridge": {"SCHEDULED": "SCHEDULED", "FINAL": "FINAL", "LIVE": "LIVE", "IN_PROGRESS": "LIVE", "POSTPONED": "POSTPONED", "CANCELLED": "POSTPONED", "PPD": "POSTPONED"},
    "shown": {"FINAL": "Final", "FINISHED": "Final", "COMPLETED": "Final", "SCHEDULED": "Scheduled", "PREGAME": "Scheduled", "IN PROGRESS": "Live", "LIVE": "Live", "HALFTIME": "Live", "POSTPONED": "Postponed", "SUSPENDED": "Suspended"},
}
#: Injury status by word and number.
INJURY = {
    "OUT": "OUT", "QUESTIONABLE": "QUESTIONABLE", "PROBABLE": "PROBABLE", "ACTIVE": "ACTIVE", "DNP": "DNP", "INACTIVE": "INACTIVE", "AVAILABLE": "ACTIVE", "HEALTHY": "ACTIVE", "DOUBTFUL": "QUESTIONABLE", "DAY_TO_DAY": "QUESTIONABLE", "INJURED": "OUT",
    "0": "ACTIVE", "1": "QUESTIONABLE", "2": "PROBABLE", "3": "OUT", "4": "DNP", "5": "INACTIVE",
}
#: Lineup positions by word and number.
LINEUP_POSITIONS = {
    "PG": "PG", "SG": "SG", "SF": "SF", "PF": "PF", "C": "C", "G": "G", "F": "F", "POINT_GUARD": "PG", "SHOOTING_GUARD": "SG", "SMALL_FORWARD": "SF", "POWER_FORWARD": "PF", "CENTER": "C", "GUARD": "G", "FORWARD": "F",
    "1": "PG", "2": "SG", "3": "SF", "4": "PF", "5": "C",
}
#: officials' roles by profile: rows, and what books call them.
ROLES = {
    "rows": {"CREW_CHIEF": "CREW_CHIEF", "CREW CHIEF": "CREW_CHIEF", "CHIEF": "CREW_CHIEF", "REFEREE": "REFEREE", "REF": "REFEREE", "UMPIRE": "UMPIRE", "UMP": "UMPIRE", "OFFICIAL": "OFFICIAL", "1": "CREW_CHIEF", "2": "REFEREE", "3": "UMPIRE"},
    "enum": {"CREW_CHIEF": "CREW_CHIEF", "CREW CHIEF": "CREW_CHIEF", "CHIEF": "CREW_CHIEF", "REFEREE": "REFEREE", "REF": "REFEREE", "UMPIRE": "UMPIRE", "UMP": "UMPIRE", "OFFICIAL": "OFFICIAL", "1": "CREW_CHIEF", "2": "REFEREE", "3": "UMPIRE", "4": "OFFICIAL"},
    "books": {"CREW CHIEF": "CREW_CHIEF", "CREW_CHIEF": "CREW_CHIEF", "REFEREE": "REFEREE", "UMPIRE": "UMPIRE", "OFFICIAL": "REFEREE", "OFFICIAL_1": "REFEREE", "OFFICIAL_2": "REFEREE", "OFFICIAL_3": "REFEREE"},
}


def dimension(spark: SparkSession, maps: dict[str, dict]) -> DataFrame:
    """(profile, code, value) rows, codes as text."""
    return spark.createDataFrame([(p, str(c), v) for p, m in maps.items() for c, v in m.items()], "profile string, code string, value string")


def mapped(code: Column, values: dict) -> Column:
    """The value of a code, null if unknown; for fixed maps as small as these an expression beats a join."""
    known = F.create_map(*[F.lit(x) for c, v in values.items() for x in (str(c), v)])
    return F.try_element_at(known, code.cast("string"))


def event_type(code: Column, profile: str = "row_model") -> Column:
    """By number, by word, or the name of a type itself."""
    names = set(EVENT_CODES["row_model"].values()) | set(EVENT_WORDS.values()) | {"ASSIST", "STEAL", "BLOCK", "PERSONAL_FOUL", "GAME_END"}
    text = F.trim(code.cast("string"))
    return F.coalesce(mapped(text, EVENT_CODES[profile]), mapped(F.lower(text), EVENT_WORDS), F.when(F.upper(text).isin(*sorted(names)), F.upper(text)))


def conditional_fields(code: Column, action: Column, zone: Column, position: Column) -> Column:
    """struct of the fields that depend on the event code: shot_result (1, 2), rebound_type (4), foul_type (6, 18, 19), turnover_type (5);
    and shot_zone and position wherever they are given. What isn't known is null, a position stays as it is."""
    n = code.try_cast("int")
    fields = {
        "event_type": event_type(code, "preprocess"), "shot_result": F.when(n == 1, "make").when(n == 2, "miss"), "rebound_type": F.when(n == 4, mapped(action, REBOUND_CODES)),
        "foul_type": F.when(n.isin(6, 18, 19), mapped(action, FOUL_CODES)), "turnover_type": F.when(n == 5, mapped(action, TURNOVER_CODES)),
        "shot_zone": mapped(zone, ZONE_WORDS), "position": F.nullif(F.coalesce(mapped(F.upper(position), POSITIONS), position), F.lit("")),
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def drift(rows: DataFrame, raw: str, value: str) -> DataFrame:
    """Raw codes that have no value, with how many rows have them."""
    return rows.where(F.col(raw).isNotNull() & F.col(value).isNull()).groupBy(F.col(raw).cast("string").alias("code")).agg(F.count("*").alias("n_rows"))


def _key(text: Column) -> Column:
    return F.upper(F.trim(text.cast("string")))


def status(text: Column, profile: str = "enum") -> Column:
    """Game status by a profile of STATUS; unknown words are scheduled, or shown with capitals. Unknown ones can be listed by unknown()."""
    known = mapped(_key(text), STATUS[profile])
    if profile == "shown":
        # A capital after each character that is no letter, not only after blanks.
        parts = F.transform(F.split(F.trim(text), r"(?<=[^\p{L}])"), F.initcap)
        return F.coalesce(known, F.nullif(F.array_join(parts, ""), F.lit("")), F.lit("Scheduled"))
    return F.coalesce(known, F.lit("SCHEDULED"))


def injury_status(text: Column) -> Column:
    """Injury status; unknown words are active."""
    return F.coalesce(mapped(_key(text), INJURY), F.lit("ACTIVE"))


def lineup_position(text: Column) -> Column:
    """A lineup's position; unknown words are guards."""
    return F.coalesce(mapped(_key(text), LINEUP_POSITIONS), F.lit("G"))


def role(text: Column, profile: str = "rows") -> Column:
    """An official's role by a profile of ROLES; unknown words are referees."""
    return F.coalesce(mapped(_key(text), ROLES[profile]), F.lit("REFEREE"))


def unknown(text: Column, values: dict) -> Column:
    """Whether a word that is there is none of values, so that a default took its place."""
    return F.coalesce(~_key(text).isin(*[str(k) for k in values]), F.lit(False)) & (F.trim(F.coalesce(text.cast("string"), F.lit(""))) != "")


def severity(shock_type: Column, notes: Column) -> Column:
    return (
        F.when(shock_type == "FLAGRANT", F.when(F.coalesce(notes, F.lit("")).contains("Flagrant 2"), "HIGH").otherwise("MEDIUM"))
        .when(shock_type == "INJURY_LEAVE", "HIGH").when(shock_type == "TWO_PF_EARLY", "MEDIUM").when(shock_type == "TECH", "LOW")
    )
