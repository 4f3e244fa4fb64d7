"""Payloads of result sets: {"resultSets": [{"name", "headers": [...], "rowSet": [[...]]}]} to typed rows, without a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SET = "array<struct<name:string,headers:array<string>,rowSet:array<array<string>>>>"


def sets(body: Column) -> Column:
    """The payload's result sets under either spelling; null if it isn't JSON."""
    return F.coalesce(*[F.from_json(body, f"struct<{name}:{SET}>", {"mode": "PERMISSIVE"})[name] for name in ("resultSets", "ResultSets")])


def pick(all_: Column, name: str, how: str = "exact") -> Column:
    """The first set by name: exact, contains, or fuzzy (any of the words in name, else the first set of all)."""
    if how == "exact":
        return F.get(F.filter(all_, lambda s: s["name"] == name), F.lit(0))
    if how == "contains":
        return F.get(F.filter(all_, lambda s: F.contains(s["name"], F.lit(name))), F.lit(0))
    return F.coalesce(F.get(F.filter(all_, lambda s: F.lower(s["name"]).rlike(name)), F.lit(0)), F.get(all_, F.lit(0)))


def settled(df: DataFrame) -> DataFrame:
    """df behind a Generate of one row, so that payloads are parsed once, not again in each filter above."""
    return df.select(F.inline(F.array(F.struct("*"))))


def rows(payloads: DataFrame, body: str, name: str, columns: dict[str, str], how: str = "exact", strict: bool = False) -> DataFrame:
    """A row for each row of the named set: the other columns of payloads, ordinal, and columns (header -> type).

    A header that isn't there gives null. strict drops rows whose length isn't the headers'; otherwise short rows end in nulls.
    """
    others = [c for c in payloads.columns if c != body]
    found = settled(payloads.select(*others, pick(sets(F.col(body)), name, how).alias("rs")))
    # Where each column stands, looked up once for a payload; a header that isn't there gives -1, at which a row has nothing.
    at = F.transform(F.array(*map(F.lit, columns)), lambda h: (F.array_position("rs.headers", h) - 1).cast("int"))
    each = found.where("rs is not null").select(*others, "rs.rowSet", F.size("rs.headers").alias("n_headers"), at.alias("at"))
    each = each.select(*others, "n_headers", "at", F.posexplode("rowSet").alias("ordinal", "row"))
    if strict:
        each = each.where(F.size("row") == F.col("n_headers"))
    each = settled(each.select(*others, "ordinal", F.transform("at", lambda i: F.get("row", i)).alias("cells")))
    return each.select(*others, "ordinal", *[F.get("cells", F.lit(i)).try_cast(t).alias(h) for i, (h, t) in enumerate(columns.items())])


#: Columns of the sets that the silver tables take.
PLAYS = {"EVENTNUM": "int", "EVENTMSGTYPE": "int", "EVENTMSGACTIONTYPE": "int", "PERIOD": "int", "PCTIMESTRING": "string", "SCORE": "string", "HOMEDESCRIPTION": "string", "NEUTRALDESCRIPTION": "string", "VISITORDESCRIPTION": "string", "PLAYER1_ID": "bigint", "PLAYER2_ID": "bigint", "PLAYER3_ID": "bigint", "PLAYER1_TEAM_ABBREVIATION": "string"}
SHOTS = {"GAME_ID": "string", "GAME_EVENT_ID": "int", "PLAYER_ID": "bigint", "TEAM_ID": "bigint", "PERIOD": "int", "MINUTES_REMAINING": "int", "SECONDS_REMAINING": "int", "SHOT_MADE_FLAG": "int", "LOC_X": "int", "LOC_Y": "int", "SHOT_DISTANCE": "int"}
PLAYERS = {"GAME_ID": "string", "TEAM_ID": "bigint", "TEAM_ABBREVIATION": "string", "PLAYER_ID": "bigint", "PLAYER_NAME": "string", "START_POSITION": "string", "MIN": "string", "PTS": "int"}
SUMMARY = {"GAME_ID": "string", "SEASON": "string", "GAME_DATE_EST": "string", "HOME_TEAM_ID": "bigint", "VISITOR_TEAM_ID": "bigint", "GAME_STATUS_TEXT": "string"}


def plays(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Foundation play rows: clock and description chains, rows without an event number or a period from 1 to 10 dropped."""
    r = rows(payloads, body, "PlayByPlay", PLAYS, strict=True)
    described = F.coalesce("HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION")
    out = r.select(*[c for c in payloads.columns if c != body], F.coalesce("EVENTNUM", F.lit(0)).alias("event_num"), F.coalesce("PERIOD", F.lit(1)).alias("period"), F.coalesce("PCTIMESTRING", F.lit("12:00")).alias("clock"), F.col("EVENTMSGTYPE").alias("event_code"), "SCORE", described.alias("description"), "PLAYER1_ID")
    return out.where("event_num >= 1 and period between 1 and 10")


def loose_plays(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Events of any of the shapes that plays come in: a set whose name holds PlayByPlay, under either spelling of the sets, in rows as long as their headers
    with a number and a period; or a list of events that have a number. Other payloads give none."""
    others, columns = [c for c in payloads.columns if c != body], ["EVENTNUM", "PERIOD", "PCTIMESTRING", "EVENTMSGTYPE"]
    listed = F.from_json(body, "array<struct<" + ",".join(f"{c}:{PLAYS[c]}" for c in columns) + ">>")
    sets_ = rows(payloads, body, "PlayByPlay", {c: PLAYS[c] for c in columns}, how="contains", strict=True).where("EVENTNUM is not null and PERIOD is not null")
    flat = payloads.where(F.ltrim(body).startswith("[")).select(*others, F.posexplode(listed).alias("ordinal", "e")).select(*others, "ordinal", "e.*").where("EVENTNUM is not null")
    return sets_.unionByName(flat)


def shots(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Shot rows, places default to 0; a player is required, flags are 0 or 1."""
    r = rows(payloads, body, "shot|chart", SHOTS, how="fuzzy")
    return r.where("PLAYER_ID is not null and coalesce(SHOT_MADE_FLAG, 0) in (0, 1)").withColumns({"LOC_X": F.coalesce("LOC_X", F.lit(0)), "LOC_Y": F.coalesce("LOC_Y", F.lit(0))})


def shots_by_event(shots_: DataFrame) -> DataFrame:
    """The last shot row of each event."""
    last = F.max_by(F.struct(*[c for c in shots_.columns if c not in ("GAME_ID", "GAME_EVENT_ID")]), F.col("ordinal"))
    return shots_.groupBy("GAME_ID", "GAME_EVENT_ID").agg(last.alias("s")).select("GAME_ID", "GAME_EVENT_ID", "s.*")


def starters(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Players with a start position."""
    return rows(payloads, body, "PlayerStats", PLAYERS, how="contains").where("coalesce(START_POSITION, '') <> ''")


def games(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Games with a date and both teams; callers quarantine the rest by anti join."""
    return rows(payloads, body, "GameSummary", SUMMARY).where("GAME_DATE_EST is not null and HOME_TEAM_ID is not null and VISITOR_TEAM_ID is not null")


def five(ids: Column) -> Column:
    """Five ids of an array, else null; what is no number is dropped first."""
    got = F.filter(F.transform(ids, lambda x: F.trim(x.cast("string")).try_cast("bigint")), lambda x: x.isNotNull())
    return F.when(F.size(got) == 5, got)


def lineup_ids(ids: Column, slots: list[Column] | None = None) -> Column:
    """Five ids of a comma-separated list, else of slots (one column for each player), else null."""
    listed = five(F.split(F.coalesce(ids, F.lit("")), ","))
    return F.coalesce(listed, five(F.array(*[c.cast("string") for c in slots]))) if slots else listed


HEADER = {"GAME_ID": "string", "GAME_DATE_EST": "string", "GAME_STATUS_ID": "int", "HOME_TEAM_ID": "bigint", "VISITOR_TEAM_ID": "bigint", "SEASON": "string", "SEASON_TYPE": "string"}
TEAMS = {"GAME_ID": "string", "TEAM_ID": "bigint", "TEAM_ABBREVIATION": "string", "PTS": "int", "FGM": "int", "FGA": "int", "FG3M": "int", "FG3A": "int", "FTM": "int", "FTA": "int", "OREB": "int", "DREB": "int", "AST": "int", "STL": "int", "BLK": "int", "TO": "int", "PF": "int"}
#: Statistics of the advanced, miscellaneous and usage sets: header -> our name.
ADVANCED = {"OFF_RATING": "offensive_rating", "DEF_RATING": "defensive_rating", "NET_RATING": "net_rating", "AST_PCT": "assist_pct", "AST_TOV": "assist_turnover_ratio", "OREB_PCT": "offensive_rebound_pct", "DREB_PCT": "defensive_rebound_pct", "EFG_PCT": "effective_fg_pct", "TS_PCT": "true_shooting_pct", "USG_PCT": "usage_pct", "PACE": "pace"}
MISC = {"PTS_OFF_TOV": "points_off_turnovers", "PTS_2ND_CHANCE": "second_chance_points", "PTS_FB": "fast_break_points", "PTS_PAINT": "points_in_paint"}
USAGE = {"USG_PCT": "usage_pct", "PCT_FGM": "pct_fgm", "PCT_FGA": "pct_fga", "PCT_PTS": "pct_points"}


def scoreboard(payloads: DataFrame, body: str = "body", regular_only: bool = False) -> DataFrame:
    """Games of a day; of the regular season only, told by its type (2 or its name)."""
    r = rows(payloads, body, "GameHeader", HEADER).where("GAME_ID is not null")
    return r.where("SEASON_TYPE in ('2', 'Regular Season')") if regular_only else r


def team_stats(payloads: DataFrame, body: str = "body") -> DataFrame:
    return rows(payloads, body, "TeamStats", TEAMS)


def rates(payloads: DataFrame, name: str, headers: dict[str, str], ids: tuple[str, ...] = ("GAME_ID", "TEAM_ID", "PLAYER_ID"), body: str = "body") -> DataFrame:
    """A set of rates by player or team: ids in lower case, headers under our names, as doubles."""
    r = rows(payloads, body, name, {**dict.fromkeys(ids, "string"), **dict.fromkeys(headers, "double")}, how="contains")
    return r.select(*[F.col(i).alias(i.lower()) for i in ids], *[F.col(h).alias(n) for h, n in headers.items()])


def game_meta(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row a game: ids and date of GameSummary, else the teams of TeamStats' rows 0 (away) and 1 (home); missing lists what neither has."""
    s = games_any(payloads, body)
    t = team_stats(payloads, body).groupBy("GAME_ID").agg(F.max(F.when(F.col("ordinal") == 0, F.col("TEAM_ID"))).alias("away"), F.max(F.when(F.col("ordinal") == 1, F.col("TEAM_ID"))).alias("home"))
    m = s.join(t, "GAME_ID", "full_outer")
    m = m.select("GAME_ID", F.coalesce("HOME_TEAM_ID", "home").alias("home_team_id"), F.coalesce("VISITOR_TEAM_ID", "away").alias("away_team_id"), "GAME_DATE_EST")
    return m.withColumn("missing", F.array_compact(F.array(F.when(F.col("GAME_DATE_EST").isNull(), "date"), F.when(F.col("home_team_id").isNull() | F.col("away_team_id").isNull(), "team"))))


def games_any(payloads: DataFrame, body: str = "body") -> DataFrame:
    return rows(payloads, body, "GameSummary", SUMMARY).select("GAME_ID", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "GAME_DATE_EST")
