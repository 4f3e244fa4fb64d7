"""Data-quality checks. Each returns rows that break a rule, or one summary row; counts are exact, lists of examples are bounded and ordered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import season_from_game_id

#: Ids that a report shows at most, in order.
SHOWN = 10
#: Thresholds of the quality report and of a complete game.
MIN_SCORE, MIN_Q1, MIN_GAMES, MIN_TIME = 0.95, 0.80, 0.90, 0.95
MIN_EVENTS, MIN_ELAPSED, MIN_COORDINATES = 400, 0.75, 0.80


def fk_check(child: DataFrame, parent: DataFrame, key: str, name: str, parent_key: str | None = None) -> DataFrame:
    """One row: table, total, invalid (rows whose key has no parent; null keys are no violation), issues (the smallest such keys).

    Totals and smallest keys take the same columns of the same join, so Spark scans and exchanges each table once.
    """
    parents = parent.select(F.col(parent_key or key).alias("p_key")).where("p_key is not null").distinct()
    counts = child.groupBy(F.col(key).alias("c_key")).agg(F.count("*").alias("n"))
    met = counts.join(parents, F.col("c_key") == F.col("p_key"), "left")
    bad = F.col("c_key").isNotNull() & F.col("p_key").isNull()
    totals = met.agg(F.sum("n").alias("total"), F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("invalid"))
    shown = met.where(bad).orderBy("c_key", "n").limit(SHOWN).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_key", "n"))), lambda x: x["c_key"].cast("string")), ",").alias("issues"))
    return totals.crossJoin(F.broadcast(shown)).select(F.lit(name).alias("table"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("invalid", F.lit(0)).alias("invalid"), "issues")


def orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """table, key and number of rows of each key without a parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti").groupBy(key).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), key, "n_rows")


def missing_from(rows: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows that some of the other tables have no row for, with missing: those tables' names, sorted."""
    for name, other in others.items():
        rows = rows.join(other.select(key).distinct().withColumn(f"has_{name}", F.lit(True)), key, "left")
    missing = F.array_compact(F.array(*[F.when(F.col(f"has_{n}").isNull(), F.lit(n)) for n in sorted(others)]))
    return rows.withColumn("missing", F.array_join(missing, ",")).where("missing <> ''").drop(*[f"has_{n}" for n in others])


def duplicates(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Keys that more than one row has, with n_rows and other aggregates."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *more).where("n_rows > 1")


def index_gaps(rows: DataFrame, keys: list[str], index: str) -> DataFrame:
    """prev_index, index and gap_size where the index skips within its keys."""
    order = Window.partitionBy(*keys).orderBy(index)
    return rows.withColumn("prev_index", F.lag(index).over(order)).withColumn("gap_size", F.col(index) - F.col("prev_index")).where("gap_size > 1").select(*keys, "prev_index", index, "gap_size")


def clock_regressions(rows: DataFrame, keys: list[str], index: str, at: str, tolerance: float = 5.0) -> DataFrame:
    """Rows whose time is more than tolerance before that of the row before; null times are left out first."""
    order = Window.partitionBy(*keys).orderBy(index)
    t = rows.where(F.col(at).isNotNull()).withColumn("prev_value", F.lag(at).over(order)).withColumn("time_diff", F.col(at) - F.col("prev_value"))
    return t.where(F.col("time_diff") < -tolerance).select(*keys, index, "prev_value", at, "time_diff")


def boundary_overlaps(rows: DataFrame, keys: list[str], period: str, index: str, last_period: int = 4) -> DataFrame:
    """Neighbouring periods whose index ranges overlap."""
    ends = rows.where(F.col(period).between(1, last_period)).groupBy(*keys, period).agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"))
    order = Window.partitionBy(*keys).orderBy(period)
    ends = ends.withColumn("next_period", F.lead(period).over(order)).withColumn("next_first", F.lead("first_index").over(order))
    return ends.where((F.col("next_period") == F.col(period) + 1) & (F.col("last_index") >= F.col("next_first"))).select(*keys, period, "last_index", "next_first")


def mismatches(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Pairs of rows of a key that differ in a column; null is not reported."""
    j = left.alias("l").join(right.alias("r"), key)
    differs = reduce(lambda a, b: a | b, [F.col(f"l.{c}") != F.col(f"r.{c}") for c in columns])
    return j.where(differs).select(key, *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for c in columns for s in "lr"])


def coverage(events: DataFrame) -> DataFrame:
    """One row: games, events, and the shares of events with a time and of games with first and fourth period."""
    games = events.groupBy("game_id").agg(F.count("*").alias("n"), F.count("seconds_elapsed").alias("timed"), F.max((F.col("period") == 1).cast("int")).alias("q1"), F.max((F.col("period") == 4).cast("int")).alias("q4"))
    return games.agg(F.count("*").alias("n_games"), F.sum("n").alias("n_events"), (F.sum("timed") / F.sum("n")).alias("time_share"), F.avg("q1").alias("q1_share"), F.avg("q4").alias("q4_share"), F.avg("n").alias("events_per_game"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: Column, max_hours: int = 48) -> DataFrame:
    """table, latest, n_recent (last 24 hours) and is_fresh of tables given with their time column."""
    def one(name, rows, at):
        t = F.col(at)
        out = rows.agg(F.max(t).alias("latest"), F.count_if(t > as_of - F.expr("INTERVAL 24 HOURS")).alias("n_recent"))
        return out.select(F.lit(name).alias("table"), "latest", "n_recent", F.coalesce(F.col("latest") >= as_of - F.expr(f"INTERVAL {max_hours} HOURS"), F.lit(False)).alias("is_fresh"))
    return reduce(DataFrame.unionByName, [one(n, r, a) for n, (r, a) in tables.items()])


def summary(checks: DataFrame) -> DataFrame:
    """table -> score = max(0, 1 - invalid / total) and is_valid; an empty table scores 1."""
    score = F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(F.col("invalid").cast("double"), F.col("total").cast("double")), F.lit(0.0)))
    return checks.select("table", "total", "invalid", score.alias("score"), (score >= MIN_SCORE).alias("is_valid"))


def complete_games(events: DataFrame, shots: DataFrame | None = None) -> DataFrame:
    """game_id, n_events, elapsed_share, coordinate_share, passes: enough events, with times, and coordinates for most shots (if any)."""
    e = events.groupBy("game_id").agg(F.count("*").alias("n_events"), F.avg(F.col("seconds_elapsed").isNotNull().cast("double")).alias("elapsed_share"))
    if shots is None:
        e = e.withColumn("coordinate_share", F.lit(None).cast("double"))
    else:
        e = e.join(shots.groupBy("game_id").agg(F.avg((F.col("loc_x").isNotNull() & F.col("loc_y").isNotNull()).cast("double")).alias("coordinate_share")), "game_id", "left")
    ok = (F.col("n_events") >= MIN_EVENTS) & (F.col("elapsed_share") >= MIN_ELAPSED) & F.coalesce(F.col("coordinate_share") >= MIN_COORDINATES, F.lit(True))
    return e.withColumn("passes", ok)


def percent_of_total(rows: DataFrame, key: str) -> DataFrame:
    """Each key's rows and their percentage of all: the total is one row, broadcast, not a window over everything."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("n_all"), F.avg("n_rows").alias("avg_rows"))
    return counts.crossJoin(F.broadcast(total)).select(key, "n_rows", (100.0 * F.col("n_rows") / F.col("n_all")).alias("pct"), "avg_rows")


def box_mismatch(players: DataFrame, totals: DataFrame, keys: list[str], stats: list[str], tolerance: int = 1) -> DataFrame:
    """Statistics whose players' sum is off the team's total by more than tolerance."""
    long = lambda d, n: d.selectExpr(*keys, f"stack({len(stats)}, " + ", ".join(f"'{s}', cast({s} as double)" for s in stats) + f") as (stat, {n})")
    sums = long(players.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in stats]), "players_sum")
    return sums.join(long(totals, "team_total"), [*keys, "stat"]).where(F.abs(F.col("players_sum") - F.col("team_total")) > tolerance)


def health(events: DataFrame, thin: int) -> DataFrame:
    """(check, n): games, games of under thin events, events without team or clock, of ids that are none, and (game, index) pairs that repeat. One pass."""
    bad = ~F.coalesce(F.col("game_id").rlike(r"^\d{10}$"), F.lit(False))
    once = events.groupBy("game_id", "event_idx").agg(F.count("*").alias("k"), F.count_if(F.col("team_tricode").isNull()).alias("no_team"), F.count_if(F.col("clock_ms_remaining").isNull()).alias("no_clock"))
    g = once.groupBy("game_id").agg(F.sum("k").alias("k"), F.sum("no_team").alias("no_team"), F.sum("no_clock").alias("no_clock"), F.count_if(F.col("k") > 1).alias("twice"))
    figures = {"games": F.count("game_id"), "thin_games": F.count_if(F.col("k") < thin), "no_team": F.sum("no_team"), "no_clock": F.sum("no_clock"), "bad_ids": F.sum(F.when(bad, F.col("k"))), "duplicate_idx": F.sum("twice")}
    one = g.agg(*[F.coalesce(v, F.lit(0)).alias(k) for k, v in figures.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in figures])))


def health_suite(events: DataFrame, by_game: list[str], thin: int = 300, dense: int = 700, starters: int = 5) -> DataFrame:
    """dimension, value and the suite's figures: for all events, by each column of by_game (one value a game, such as its day or status), by game and by team.

    n_games, n_events; thin_games and dense_games (under or over so many events); repeated (game and index pairs that occur again), no_team, no_clock, n_shots,
    no_place (shots without coordinates), bad_ids (events of ids that are none), other_season (events whose season isn't the id's), no_season; bad_lineups
    (a game's teams that don't have as many players as starters in the first period); clock_pct and place_pct, null without events or shots.

    One scan and two exchanges: events meet by game, and all that needs a whole game, which is bounded, is worked out there;
    what is left, a row for each game and team, is dealt to all dimensions at once by grouping sets.
    """
    shot = F.col("event_type").isin("SHOT_MADE", "SHOT_MISSED")
    bad = ~F.coalesce(F.col("game_id").rlike(r"^\d{10}$"), F.lit(False))
    own = season_from_game_id(F.col("game_id"))
    known = F.coalesce(F.col("season"), F.lit("UNKNOWN")) != "UNKNOWN"
    counts = {
        "n_events": F.lit(True), "repeated": F.col("nth") == 2, "no_team": F.col("team_tricode").isNull(), "no_clock": F.col("seconds_elapsed").isNull(), "n_shots": shot,
        "no_place": shot & (F.col("shot_x").isNull() | F.col("shot_y").isNull()), "bad_ids": bad, "other_season": known & (F.col("season") != own), "no_season": ~known,
    }
    met = events.repartition("game_id").withColumn("nth", F.row_number().over(Window.partitionBy("game_id", "event_idx").orderBy("event_idx")))
    players = F.size(F.collect_set(F.when(F.col("period") == 1, F.col("player1_name_slug"))))
    teams = met.groupBy("game_id", *by_game, "team_tricode").agg(*[F.count_if(c).alias(n) for n, c in counts.items()], players.alias("players"))
    game = Window.partitionBy("game_id")
    teams = teams.withColumn("in_game", F.sum("n_events").over(game)).withColumn("first", F.row_number().over(game.orderBy(F.asc_nulls_first("team_tricode"))) == 1)
    named = F.col("team_tricode").isNotNull()
    figures = {n: F.sum(n) for n in counts} | {"bad_lineups": F.count_if(named & (F.col("players") != starters))}
    dimensions = [*by_game, "game_id", "team_tricode"]
    # A game counts once, with its first row, and once with each of its teams.
    by_team = F.grouping("team_tricode") == 0
    once = lambda c: F.when(by_team, F.count_if(c)).otherwise(F.count_if(F.col("first") & c))
    figures |= {"n_games": once(F.lit(True)), "thin_games": once(F.col("in_game") < thin), "dense_games": once(F.col("in_game") > dense)}
    which = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in dimensions], F.lit("all"))
    value = F.coalesce(*[F.when(F.grouping(d) == 0, F.col(d).cast("string")) for d in dimensions])
    out = teams.groupingSets([[], *[[d] for d in dimensions]], *dimensions).agg(which.alias("dimension"), value.alias("value"), *[v.alias(n) for n, v in figures.items()])
    pct = lambda missing, of: 100.0 * F.try_divide((F.col(of) - F.col(missing)).cast("double"), F.col(of).cast("double"))
    return out.where("n_events > 0").select("dimension", "value", *figures, pct("no_clock", "n_events").alias("clock_pct"), pct("no_place", "n_shots").alias("place_pct"))


def density(events: DataFrame, low: int, high: int) -> DataFrame:
    """game_id and n_events of games with under low or over high events, and which."""
    n = events.groupBy("game_id").agg(F.count("*").alias("n_events"))
    return n.where(~F.col("n_events").between(low, high)).withColumn("problem", F.when(F.col("n_events") < low, "few").otherwise("many"))


def load_gates(wanted: DataFrame, games: DataFrame, events: DataFrame, least_share: float = 0.95) -> DataFrame:
    """One row: games wanted, the share that is there, games without a row of wanted (FK), repeated (game, index) pairs, and whether all gates pass."""
    w = wanted.select("game_id").distinct().join(games.select("game_id").distinct().withColumn("here", F.lit(True)), "game_id", "left")
    w = w.agg(F.count("*").alias("n_wanted"), F.avg(F.col("here").isNotNull().cast("double")).alias("share"))
    fk = events.groupBy("game_id", "event_idx").agg(F.count("*").alias("k")).groupBy("game_id").agg(F.count_if(F.col("k") > 1).alias("twice"))
    fk = fk.join(games.select("game_id").distinct().withColumn("here", F.lit(True)), "game_id", "left").agg(F.count_if(F.col("here").isNull()).alias("n_orphans"), F.coalesce(F.sum("twice"), F.lit(0)).alias("n_repeated"))
    out = w.crossJoin(F.broadcast(fk))
    return out.withColumn("passes", (F.coalesce("share", F.lit(0.0)) >= least_share) & (F.col("n_orphans") == 0) & (F.col("n_repeated") == 0))


def game_quality(events: DataFrame) -> DataFrame:
    """Flags and a 0-100 score for each game."""
    from ..functions.numbers import game_quality_score

    shot = F.col("event_type").isin("SHOT_MADE", "SHOT_MISSED")
    flags = {
        "Missing shot distance": shot & F.col("shot_distance_ft").isNull(), "Missing shot coordinates": shot & F.col("shot_x").isNull(),
        "Missing team attribution": F.col("team_tricode").isNull(), "Missing player attribution": F.col("player1_name_slug").isNull() & ~F.col("event_type").isin("PERIOD_BEGIN", "PERIOD_END"),
    }
    g = events.groupBy("game_id").agg(
        F.count("*").alias("total_events"), F.count_if(shot).alias("shot_events"), F.count_if(shot & F.col("shot_x").isNotNull() & F.col("shot_y").isNotNull()).alias("placed"),
        *[F.max(c).alias(f"f{i}") for i, c in enumerate(flags.values())],
    )
    listed = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"f{i}"), F.lit(n)) for i, n in enumerate(flags)])))
    g = g.withColumn("coordinate_coverage", F.when(F.col("shot_events") > 0, 100.0 * F.col("placed") / F.col("shot_events")).otherwise(0.0)).withColumn("flags", listed)
    score = game_quality_score(F.col("total_events"), F.col("shot_events"), F.col("coordinate_coverage"), F.size("flags"))
    return g.select("game_id", "total_events", "shot_events", "coordinate_coverage", F.array_join("flags", "; ").alias("missing_data_flags"), score.alias("quality_score"))
