"""Team metrics of games: box score, advanced shares, efficiency against the league, head to head, outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers


def select_games(games: DataFrame, status: str | None = "FINAL", season: str | None = None, teams: list[str] | None = None, since=None, until=None, force: bool = False) -> DataFrame:
    """games by status (unless force), season, teams of either side and dates; each filter reaches the scan."""
    if status and not force:
        games = games.where(F.col("status") == status)
    if season:
        games = games.where(F.col("season") == season)
    if teams:
        games = games.where(F.col("home_team_id").isin(teams) | F.col("away_team_id").isin(teams))
    if since is not None:
        games = games.where(F.col("game_date_local") >= F.lit(since))
    return games if until is None else games.where(F.col("game_date_local") <= F.lit(until))


def team_game_stats(games: DataFrame, events: DataFrame) -> DataFrame:
    """Box score of each game and side. games (game_id, home_team_id, away_team_id, duration_minutes); an event of neither team counts for away.

    Events are summed up by game and team before they meet the games, so the join moves a few rows a game.
    """
    kind, value = F.col("event_type"), F.col("shot_value")
    shot, fg = kind.isin("SHOT_MADE", "SHOT_MISSED"), F.col("shot_value").isin(2, 3)
    made = kind == "SHOT_MADE"
    n = lambda c: F.count_if(c)
    sums = events.groupBy("game_id", "team_id").agg(
        F.sum(F.when(made & value.isin(1, 2, 3), value).when(kind == "FREE_THROW_MADE", 1).otherwise(0)).cast("long").alias("points"),
        n(made & fg).alias("field_goals_made"), n(shot & fg).alias("field_goals_attempted"), n(made & (value == 3)).alias("three_pointers_made"), n(shot & (value == 3)).alias("three_pointers_attempted"),
        n(kind == "FREE_THROW_MADE").alias("free_throws_made"), n(kind.isin("FREE_THROW_MADE", "FREE_THROW_MISSED")).alias("free_throws_attempted"),
        n((kind == "REBOUND") & (F.col("rebound_type") == "OFFENSIVE")).alias("offensive_rebounds"), n((kind == "REBOUND") & (F.col("rebound_type") == "DEFENSIVE")).alias("defensive_rebounds"),
        n(kind == "ASSIST").alias("assists"), n(kind == "TURNOVER").alias("turnovers"), n(kind == "STEAL").alias("steals"), n(kind == "BLOCK").alias("blocks"), n(kind == "FOUL").alias("personal_fouls"),
    )
    names = [c for c in sums.columns if c not in ("game_id", "team_id")]
    met = games.select("game_id", "home_team_id", "away_team_id", "duration_minutes").join(sums, "game_id", "left")
    side = F.when(F.col("team_id") == F.col("home_team_id"), F.col("home_team_id")).otherwise(F.col("away_team_id"))
    out = met.groupBy("game_id", side.alias("team_id"), "duration_minutes").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).where("team_id is not null")
    out = out.withColumn("possessions_estimated", F.greatest(F.lit(1), F.col("field_goals_attempted") + F.col("turnovers")))
    return out.withColumn("pace", F.when(F.col("duration_minutes") > 0, F.col("possessions_estimated") * 48.0 / F.col("duration_minutes")).otherwise(0.0)).withColumn("offensive_rating", F.col("points") * 100.0 / F.col("possessions_estimated"))


def with_advanced(stats: DataFrame) -> DataFrame:
    """Shares with 0 where there is nothing to divide by."""
    c = F.col
    rebounds = c("offensive_rebounds") + c("defensive_rebounds")
    return (
        stats.withColumn("effective_fg_pct", F.coalesce(numbers.effective_fg(c("field_goals_made"), c("three_pointers_made"), c("field_goals_attempted")), F.lit(0.0)))
        .withColumn("true_shooting_pct", F.coalesce(numbers.divide(c("points"), 2 * (c("field_goals_attempted") + 0.44 * c("free_throws_attempted"))), F.lit(0.0)))
        .withColumn("assist_turnover_ratio", F.when(c("turnovers") > 0, c("assists") / c("turnovers")).otherwise(c("assists").cast("double")))
        .withColumn("rebound_pct_estimated", F.when(rebounds > 0, rebounds / F.greatest(F.lit(1), rebounds * 2)).otherwise(0.0))
    )


def with_opponents(rows: DataFrame, value: str, name: str) -> DataFrame:
    """rows (game_id, value) with what the game's other rows have together: a window in place of a self-join."""
    return rows.withColumn(name, F.sum(value).over(Window.partitionBy("game_id")) - F.col(value))


def with_efficiency(stats: DataFrame) -> DataFrame:
    """defensive_rating from the opponent, net_rating and z-scores against all rows.

    The opponent's rating is the game's sum less one's own where the game has two teams: a window in place of a self-join.
    The league's figures are one row, broadcast.
    """
    game = Window.partitionBy("game_id")
    two = F.count("*").over(game) == 2
    stats = stats.withColumn("defensive_rating", F.when(two, F.sum("offensive_rating").over(game) - F.col("offensive_rating")))
    stats = stats.withColumn("net_rating", F.col("offensive_rating") - F.col("defensive_rating"))
    kinds = ("offensive", "defensive", "net")
    # Counting whole rows keeps all columns in this branch too, so that both take the same exchange.
    league = stats.agg(F.count(F.struct(*stats.columns)).alias("league_rows"), *[f(f"{k}_rating").alias(f"{k}_{n}") for k in kinds for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])
    out = stats.crossJoin(F.broadcast(league))
    for k in kinds:
        gap = F.col(f"{k}_rating") - F.col(f"{k}_mean")
        gap = -gap if k == "defensive" else gap
        out = out.withColumn(f"{k}_z", F.when(F.col(f"{k}_sd") > 0, F.coalesce(gap / F.col(f"{k}_sd"), F.lit(0.0))).otherwise(0.0))
    return out.drop("league_rows", *[f"{k}_{n}" for k in kinds for n in ("mean", "sd")])


def head_to_head(games: DataFrame, last_n: int | None = None) -> DataFrame:
    """Each pair of teams (team1 < team2): games, wins, average points and margin; of the last_n games of each pair only, if given. Ties count for team2."""
    c = F.col
    g = games.where("home_score is not null and away_score is not null").withColumn("team1", F.least("home_team_id", "away_team_id")).withColumn("team2", F.greatest("home_team_id", "away_team_id"))
    g = g.withColumn("points1", F.when(c("team1") == c("home_team_id"), c("home_score")).otherwise(c("away_score"))).withColumn("points2", F.when(c("team1") == c("home_team_id"), c("away_score")).otherwise(c("home_score")))
    if last_n:
        g = g.withColumn("nth", F.row_number().over(Window.partitionBy("team1", "team2").orderBy(F.desc("game_date_local"), F.desc("game_id")))).where(c("nth") <= last_n)
    out = g.groupBy("team1", "team2").agg(F.count("*").alias("total_games"), F.count_if(c("points1") > c("points2")).alias("team1_wins"), F.avg("points1").alias("avg_points1"), F.avg("points2").alias("avg_points2"), F.avg(F.abs(c("points1") - c("points2"))).alias("avg_margin"))
    return out.withColumn("team2_wins", c("total_games") - c("team1_wins"))


def outcomes_of_box(boxes: DataFrame) -> DataFrame:
    """The same of box scores (game_id, home_team_tricode, away_team_tricode, home_q1, away_q1, home_final, away_final, ot_periods): points that aren't there are 0."""
    c = F.col
    home, away = (F.coalesce(c(f"{s}_final"), F.lit(0)) for s in ("home", "away"))
    return boxes.select(
        "game_id", "home_team_tricode", "away_team_tricode", c("home_q1").alias("q1_home_points"), c("away_q1").alias("q1_away_points"), home.alias("final_home_points"), away.alias("final_away_points"), (home + away).alias("total_points"),
        (home > away).alias("home_win"), (home - away).alias("margin"), F.coalesce(c("ot_periods"), F.lit(0)).alias("overtime_periods"),
    )


def outcomes(games: DataFrame) -> DataFrame:
    """Result of each finished game with scores: signed and absolute margin, overtime."""
    c = F.col
    g = games.where((c("status") == "FINAL") & c("home_score").isNotNull() & c("away_score").isNotNull())
    return g.select(
        "game_id", "home_team_id", "away_team_id", c("home_score").alias("final_home_points"), c("away_score").alias("final_away_points"), (c("home_score") + c("away_score")).alias("total_points"),
        (c("home_score") > c("away_score")).alias("home_win"), (c("home_score") - c("away_score")).alias("margin"), F.abs(c("home_score") - c("away_score")).alias("abs_margin"), (F.coalesce(c("overtime_periods"), F.lit(0)) > 0).alias("overtime"),
    )
