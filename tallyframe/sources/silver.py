"""Result sets as rows of the silver tables: each entity's set, columns, defaults and least fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text
from .result_sets import rows

#: Header, our name and type of each entity's columns.
GAMES = [
    ("GAME_ID", "game_id", "string"), ("SEASON", "season", "string"), ("GAME_DATE_EST", "game_date_est", "string"), ("HOME_TEAM_ID", "home_team_id", "bigint"),
    ("VISITOR_TEAM_ID", "away_team_id", "bigint"), ("GAME_STATUS_TEXT", "status", "string"), ("HOME_TEAM_WINS", "home_team_wins", "int"), ("HOME_TEAM_LOSSES", "home_team_losses", "int"),
    ("VISITOR_TEAM_WINS", "away_team_wins", "int"), ("VISITOR_TEAM_LOSSES", "away_team_losses", "int"), ("ARENA_NAME", "arena_name", "string"), ("ATTENDANCE", "attendance", "int"),
    ("GAMETIME", "game_time", "string"),
]
PBP = [
    ("EVENTNUM", "event_num", "int"), ("PERIOD", "period", "int"), ("PCTIMESTRING", "clock", "string"), ("EVENTMSGTYPE", "event_type", "int"),
    ("EVENTMSGACTIONTYPE", "event_subtype", "int"), ("PLAYER1_ID", "player1_id", "bigint"), ("PLAYER1_NAME", "player1_name", "string"), ("PLAYER2_ID", "player2_id", "bigint"),
    ("PLAYER2_NAME", "player2_name", "string"), ("PLAYER3_ID", "player3_id", "bigint"), ("PLAYER3_NAME", "player3_name", "string"), ("PLAYER1_TEAM_ID", "team_id", "bigint"),
    ("HOMEDESCRIPTION", "home_description", "string"), ("VISITORDESCRIPTION", "away_description", "string"), ("NEUTRALDESCRIPTION", "neutral_description", "string"), ("SCORE", "score", "string"),
    ("SCOREMARGIN", "score_margin", "string"),
]
SHOTS = [
    ("PLAYER_ID", "player_id", "bigint"), ("PLAYER_NAME", "player_name", "string"), ("TEAM_ID", "team_id", "bigint"), ("TEAM_NAME", "team_name", "string"),
    ("PERIOD", "period", "int"), ("MINUTES_REMAINING", "minutes_remaining", "int"), ("SECONDS_REMAINING", "seconds_remaining", "int"), ("EVENT_TYPE", "event_type", "string"),
    ("ACTION_TYPE", "action_type", "string"), ("SHOT_TYPE", "shot_type", "string"), ("SHOT_ZONE_BASIC", "shot_zone_basic", "string"), ("SHOT_ZONE_AREA", "shot_zone_area", "string"),
    ("SHOT_ZONE_RANGE", "shot_zone_range", "string"), ("SHOT_DISTANCE", "shot_distance", "int"), ("LOC_X", "loc_x", "int"), ("LOC_Y", "loc_y", "int"),
    ("SHOT_MADE_FLAG", "shot_made_flag", "int"), ("SHOT_ATTEMPTED_FLAG", "shot_attempted_flag", "int"), ("HTM", "htm", "string"), ("VTM", "vtm", "string"),
]
OFFICIALS = [
    ("OFFICIAL_ID", "official_id", "bigint"), ("FIRST_NAME", "first_name", "string"), ("LAST_NAME", "last_name", "string"), ("JERSEY_NUM", "jersey_num", "string"),
]
STARTERS = [
    ("TEAM_ID", "team_id", "bigint"), ("TEAM_ABBREVIATION", "team_abbreviation", "string"), ("TEAM_CITY", "team_city", "string"), ("PLAYER_ID", "player_id", "bigint"),
    ("PLAYER_NAME", "player_name", "string"), ("JERSEY_NUM", "jersey_num", "string"), ("POSITION", "position", "string"), ("HEIGHT", "height", "string"),
    ("WEIGHT", "weight", "string"), ("BIRTH_DATE", "birth_date", "string"), ("AGE", "age", "double"), ("EXP", "experience", "string"),
    ("SCHOOL", "school", "string"),
]
#: Set and columns of each entity, fields of which one group must be there, and defaults.
ENTITIES = {
    "games": ("GameSummary", GAMES, [["game_id"]], {"status": "Unknown", "home_team_wins": 0, "home_team_losses": 0, "away_team_wins": 0, "away_team_losses": 0}),
    "pbp": ("PlayByPlay", PBP, [["game_id", "event_num"]], {}),
    "shots": ("Shot_Chart_Detail", SHOTS, [["game_id", "player_id"]], {"shot_attempted_flag": 1}),
    "officials": ("Officials", OFFICIALS, [["game_id", "official_id"], ["game_id", "last_name"]], {}),
    "starters": ("StartingLineup", STARTERS, [["game_id", "player_id", "team_id"]], {}),
}


def project(payloads: DataFrame, entity: str, body: str = "body") -> DataFrame:
    """Rows of an entity from payloads (game_id, body). A game is the first row of its set and has its own game_id; cells that aren't there
    are the default or null; rows without the least fields are dropped (see rejected())."""
    return _marked(payloads, entity, body).where("is_complete").drop("is_complete")


def rejected(payloads: DataFrame, entity: str, body: str = "body") -> DataFrame:
    """The rows that project() drops, for a quarantine table."""
    return _marked(payloads, entity, body).where("not is_complete").drop("is_complete")


def _marked(payloads: DataFrame, entity: str, body: str) -> DataFrame:
    name, columns, least, defaults = ENTITIES[entity]
    source = payloads.select(body) if entity == "games" else payloads.select("game_id", body)
    found = rows(source, body, name, {h: t for h, _, t in columns})
    if entity == "games":
        found = found.where("ordinal = 0")
    value = {n: F.coalesce(F.col(h), F.lit(defaults[n])) if n in defaults else F.col(h) for h, n, _ in columns}
    out = found.select(*([] if entity == "games" else ["game_id"]), *[v.alias(n) for n, v in value.items()])
    there = [reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group]) for group in least]
    return out.withColumn("is_complete", reduce(lambda a, b: a | b, there))


def injuries(payloads: DataFrame, source: str) -> DataFrame:
    """Rows of injured players from payloads (game_id, team_tricode, people: array of structs) by source: 'notes' of pages (player, status, reason) or
    'reports' of teams (name, status, injury, player_id). The status is one of codes.INJURY; an empty reason is none."""
    each = payloads.select("game_id", "team_tricode", F.explode("people").alias("p"))
    if source == "notes":
        name, reason, player_id, label = F.col("p.player"), F.col("p.reason"), F.lit(None).cast("string"), "page_notes"
    elif source == "reports":
        name, reason, player_id, label = F.col("p.name"), F.col("p.injury"), F.col("p.player_id").cast("string"), "team_report"
    else:
        raise ValueError(f"injuries: unknown source {source}")
    named = each.select("game_id", F.upper("team_tricode").alias("team_tricode"), F.coalesce(name, F.lit("")).alias("player_display_name"), player_id.alias("player_id"), codes.injury_status(F.col("p.status")).alias("status"), F.nullif(reason, F.lit("")).alias("reason"), F.lit(label).alias("source"))
    return named.withColumn("player_name_slug", text.name_slug(F.col("player_display_name")))


def starters(players: DataFrame, source: str) -> DataFrame:
    """Rows of starters from players by source: 'stats' (game_id, team_tricode, PLAYER_NAME, PLAYER_ID, START_POSITION) or 'pages' (game_id, team_tricode,
    player, pos). A position is one of PG, SG, SF, PF, C, G, F, by name where stats spell it out, else null."""
    if source == "stats":
        name, player_id, at = F.col("PLAYER_NAME"), F.col("PLAYER_ID").cast("string"), F.upper("START_POSITION")
        position = F.when(at.isin("PG", "SG", "SF", "PF", "C", "G", "F"), at).when(at == "GUARD", "G").when(at == "FORWARD", "F").when(at == "CENTER", "C")
    elif source == "pages":
        name, player_id = F.col("player"), F.lit(None).cast("string")
        position = F.when(F.col("pos").isin("PG", "SG", "SF", "PF", "C", "G", "F"), F.col("pos"))
    else:
        raise ValueError(f"starters: unknown source {source}")
    named = players.select("game_id", "team_tricode", F.coalesce(name, F.lit("")).alias("player_display_name"), player_id.alias("player_id"), position.alias("position"), F.lit(source).alias("source"))
    return named.withColumn("player_name_slug", text.name_slug(F.col("player_display_name")))


def page_games(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Games from pages (game_id, season, game_date_utc, game_date_local, arena_tz, home_team, away_team, page_id), and those that are rejected with problem:
    'season' (not YYYY-YY) or 'date' (the local date is more than a day off the one that time and zone give). A missing zone is New York's, a missing local
    date the one that time and zone give; odds_join_key is the local date's digits."""
    zone = F.coalesce("arena_tz", F.lit("America/New_York"))
    derived = F.to_date(F.from_utc_timestamp(F.col("game_date_utc"), zone))
    local = F.coalesce("game_date_local", derived)
    problem = F.when(~F.coalesce(F.col("season").rlike(r"^\d{4}-\d{2}$"), F.lit(False)), "season").when(F.abs(F.datediff(local, derived)) > 1, "date")
    out = rows.select("game_id", "season", "game_date_utc", local.alias("game_date_local"), zone.alias("arena_tz"), F.upper(F.trim("home_team")).alias("home_team_tricode"), F.upper(F.trim("away_team")).alias("away_team_tricode"), "page_id", F.date_format(local, "yyyyMMdd").alias("odds_join_key"), problem.alias("problem"))
    return out.where("problem is null").drop("problem"), out.where("problem is not null")


def referees(payloads: DataFrame, source: str) -> DataFrame:
    """game_id, name, position, years from payloads (game_id, people: array of structs) by source: 'pages' (name, position, years_experience),
    'stats' (FIRST_NAME, LAST_NAME, JERSEY_NUM), 'books' (name, position, experience). A missing position is Official k."""
    each = payloads.select("game_id", F.posexplode("people").alias("k", "p"))
    if source == "stats":
        name, at, years = F.concat_ws(" ", F.coalesce("p.FIRST_NAME", F.lit("")), F.coalesce("p.LAST_NAME", F.lit(""))), F.col("p.JERSEY_NUM"), F.lit(None)
    elif source in ("pages", "books"):
        name, at, years = F.col("p.name"), F.col("p.position"), F.col("p.years_experience" if source == "pages" else "p.experience")
    else:
        raise ValueError(f"referees: unknown source {source}")
    at = F.coalesce(F.nullif(at, F.lit("")), F.concat(F.lit("Official "), (F.col("k") + 1).cast("string")))
    return each.select("game_id", name.alias("name"), at.alias("position"), years.try_cast("int").alias("years"))
