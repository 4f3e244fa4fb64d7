"""Game analytics on the benchmark tables: windows, shocks, possessions, schedules, teams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sequence, shocks, teams, travel, windows
from .adapters import E_SQL, G_SQL, Queries, V_SQL, events, games, rounded, table, venues

Q = Queries()
_same = "period, clock_ms_remaining, event_type, team_tricode"


@Q.add(f"""WITH {E_SQL}, d AS (SELECT game_id, event_idx, row_number() OVER w AS n, {', '.join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c} AS s{i}" for i, c in enumerate(_same.split(', ')))} FROM e WINDOW w AS (PARTITION BY game_id ORDER BY event_idx))
SELECT game_id, event_idx FROM d WHERE n = 1 OR NOT (s0 AND s1 AND s2 AND s3)""")
def dedup_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.dedup_consecutive(events(spark, sf_dir)).select("game_id", "event_idx")


@Q.add(f"""WITH {E_SQL} SELECT game_id, min(event_idx) AS event_idx FROM e GROUP BY game_id, {_same}""")
def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.dedup_first_seen(events(spark, sf_dir)).select("game_id", "event_idx")


def _opening_sql(period: int, start: int, end: int, length: int, alpha: bool, columns: str) -> str:
    lo, hi = length - end * 1000, length - start * 1000
    side = "low AS home, high AS away" if alpha else "CASE WHEN home_team_tricode = high THEN high ELSE low END AS home, CASE WHEN home_team_tricode = high THEN low ELSE high END AS away"
    agg = []
    for s in ("home", "away"):
        f = lambda cond, s=s: f"count(*) FILTER (team_tricode = {s} AND {cond})"
        agg += [f"{f("event_type IN ('SHOT_MADE', 'SHOT_MISSED')")} AS {s}_fga", f"{f("event_type = 'SHOT_MADE'")} AS {s}_fgm", f"{f("event_type = 'SHOT_MADE' AND shot_value = 3")} AS {s}_3pm", f"{f("event_type LIKE 'FREE%'")} AS {s}_fta", f"{f("event_type = 'TURNOVER'")} AS {s}_tov"]
        agg += [f"{f("event_type = 'REBOUND' AND description LIKE 'Off%'")} AS {s}_or", f"{f("event_type = 'REBOUND' AND description LIKE 'DEF%'")} AS {s}_dr", f"min_by(seconds_elapsed, event_idx) FILTER (team_tricode = {s} AND fouls >= 4 AND seconds_elapsed IS NOT NULL) AS {s}_at"]
    minutes = (end - start) / 60
    out = []
    for s in ("home", "away"):
        o = "away" if s == "home" else "home"
        out += [f"round(({s}_fgm + 0.5 * {s}_3pm) / nullif({s}_fga, 0), 6)::DOUBLE AS {s}_efg_actual", f"0.52::DOUBLE AS {s}_efg_expected", f"round({s}_tov / greatest(1, n // 2), 6)::DOUBLE AS {s}_to_rate", f"round({s}_fta / nullif({s}_fga, 0), 6)::DOUBLE AS {s}_ft_rate", f"round({s}_or / nullif({s}_or + {o}_dr, 0), 6)::DOUBLE AS {s}_orb_pct", f"round({s}_dr / nullif({s}_dr + {o}_or, 0), 6)::DOUBLE AS {s}_drb_pct", f"round(coalesce(greatest(0, {end} - {s}_at), 0), 6)::DOUBLE AS bonus_time_{s}_sec"]
    return f"""WITH {E_SQL}, w AS (SELECT * FROM e WHERE period = {period} AND CASE WHEN clock_ms_remaining IS NOT NULL THEN clock_ms_remaining <= {hi} AND (clock_ms_remaining = {lo} OR clock_ms_remaining >= {lo + 1000}) ELSE seconds_elapsed BETWEEN {start} AND {end} END),
p AS (SELECT *, lag(struct_pack(a := coalesce(period, -1), b := coalesce(clock_ms_remaining, -1), c := coalesce(event_type, ''), d := coalesce(team_tricode, ''))) OVER (PARTITION BY game_id ORDER BY event_idx) AS before, struct_pack(a := coalesce(period, -1), b := coalesce(clock_ms_remaining, -1), c := coalesce(event_type, ''), d := coalesce(team_tricode, '')) AS own FROM w),
d AS (SELECT * FROM p WHERE before IS NULL OR before <> own),
t AS (SELECT *, min(team_tricode) OVER (PARTITION BY game_id) AS low, max(team_tricode) OVER (PARTITION BY game_id) AS high, count(*) FILTER (event_type IN ('FOUL', 'PERSONAL_FOUL')) OVER (PARTITION BY game_id, team_tricode ORDER BY event_idx) AS fouls FROM d),
s AS (SELECT *, {side} FROM t WHERE low <> high),
g AS (SELECT game_id, any_value(home) AS home_team_tricode, any_value(away) AS away_team_tricode, count(*) FILTER (event_type IN ('SHOT_MADE', 'TURNOVER', 'REBOUND')) AS n, {', '.join(agg)}, avg(is_transition::INT) AS tr, avg(is_early_clock::INT) AS ec FROM s GROUP BY game_id)
SELECT {columns or "game_id, home_team_tricode, away_team_tricode, n AS possessions_elapsed, round(n / " + str(minutes) + " * 48, 6)::DOUBLE AS pace48_actual, 100.0::DOUBLE AS pace48_expected, " + ', '.join(out) + ", round(tr, 6) AS transition_rate, round(ec, 6) AS early_clock_rate"} FROM g"""


@Q.add(_opening_sql(1, 0, 240, 720_000, False, ""))
def window_team_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: metrics of the opening window of each game, home and away by the games."""
    return rounded(windows.window_team_metrics(events(spark, sf_dir)))


@Q.add(_opening_sql(2, 360, 600, 720_000, True, ""))
def window_second_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another period and other bounds; the first in the alphabet is home."""
    return rounded(windows.window_team_metrics(events(spark, sf_dir).drop("home_team_tricode", "away_team_tricode"), None, 2, 360, 600))


_change = "event_type IN ('PERIOD_BEGIN', 'JUMP_BALL', 'SHOT_MADE', 'REBOUND', 'TURNOVER')"


@Q.add(f"""WITH {E_SQL} SELECT game_id, event_idx, CAST(count(*) FILTER ({_change}) OVER (PARTITION BY game_id ORDER BY event_idx) AS BIGINT) AS changes, CAST(count(*) FILTER ({_change}) OVER (PARTITION BY game_id ORDER BY event_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS BIGINT) AS changes_after FROM e""")
def possessions_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.with_possession_counts(events(spark, sf_dir)).select("game_id", "event_idx", "changes", "changes_after")


@Q.add(f"""WITH {E_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY game_id, player1_name_slug ORDER BY event_idx) AS k FROM e WHERE event_type = 'FOUL' AND player1_name_slug IS NOT NULL) SELECT game_id, player1_name_slug, event_idx FROM n WHERE k = 2""")
def second_foul(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("event_type = 'FOUL' and player1_name_slug is not null")
    return sequence.nth_event(e, 2, "player1_name_slug").select("game_id", "player1_name_slug", "event_idx")


_sub = "EXISTS (SELECT 1 FROM c AS s WHERE s.game_id = x.game_id AND s.event_type = 'SUBSTITUTION' AND s.player1_name_slug = x.player_slug AND s.event_idx > x.event_idx AND s.n - x.n <= 1)"


@Q.add(f"""WITH {E_SQL}, c AS (SELECT *, count(*) FILTER ({_change}) OVER (PARTITION BY game_id ORDER BY event_idx) AS n, count(*) FILTER ({_change}) OVER (PARTITION BY game_id) AS total, lower(coalesce(description, '')) AS d FROM e WHERE period = 1),
pf AS (SELECT *, row_number() OVER w AS k, lag(event_idx) OVER w AS f FROM c WHERE event_type = 'FOUL' AND player1_name_slug IS NOT NULL AND team_tricode IS NOT NULL AND seconds_elapsed <= 360 AND NOT regexp_matches(d, 'technical|flagrant|unsportsmanlike') WINDOW w AS (PARTITION BY game_id, team_tricode, player1_name_slug ORDER BY event_idx)),
te AS (SELECT *, coalesce(team_tricode, 'UNK') AS tt, coalesce(player1_name_slug, 'TEAM') AS pp FROM c WHERE event_type = 'TECHNICAL_FOUL' OR d LIKE '%technical%'),
fl AS (SELECT * FROM c WHERE (event_type = 'FLAGRANT_FOUL' OR d LIKE '%flagrant%') AND player1_name_slug IS NOT NULL AND team_tricode IS NOT NULL),
inj AS (SELECT i.*, (SELECT max(o.event_idx) FROM c o WHERE o.game_id = i.game_id AND o.event_idx > i.event_idx AND (o.player1_name_slug = i.player1_name_slug OR o.player2_name_slug = i.player1_name_slug)) AS seen FROM c i WHERE regexp_matches(d, 'injury|hurt|twisted|sprain|strain|collision') AND player1_name_slug IS NOT NULL AND team_tricode IS NOT NULL),
ab AS (SELECT inj.*, coalesce((SELECT o.total - o.n FROM c o WHERE o.game_id = inj.game_id AND o.event_idx = inj.seen), inj.total - inj.n) AS away FROM inj),
x AS (SELECT game_id, event_idx, n, total - n AS since, team_tricode AS team, player1_name_slug AS player_slug, 'TWO_PF_EARLY' AS shock_type, 1 AS seq, seconds_elapsed AS el, f AS s0, event_idx AS s1, printf('2 PF in %.1fs', seconds_elapsed) AS notes, 'MEDIUM' AS severity FROM pf WHERE k = 2
UNION ALL SELECT game_id, event_idx, n, total - n, tt, pp, 'TECH', row_number() OVER (PARTITION BY game_id, tt, pp ORDER BY event_idx), coalesce(seconds_elapsed, 0), event_idx, NULL, 'Technical foul', 'LOW' FROM te
UNION ALL SELECT game_id, event_idx, n, total - n, team_tricode, player1_name_slug, 'FLAGRANT', row_number() OVER (PARTITION BY game_id, team_tricode, player1_name_slug ORDER BY event_idx), coalesce(seconds_elapsed, 0), event_idx, NULL, CASE WHEN d LIKE '%flagrant 2%' THEN 'Flagrant 2' WHEN d LIKE '%flagrant 1%' THEN 'Flagrant 1' ELSE 'Flagrant' END, CASE WHEN d LIKE '%flagrant 2%' THEN 'HIGH' ELSE 'MEDIUM' END FROM fl
UNION ALL SELECT game_id, event_idx, n, away, team_tricode, player1_name_slug, 'INJURY_LEAVE', 1, coalesce(seconds_elapsed, 0), event_idx, seen, 'Absent ' || away || ' possessions', 'HIGH' FROM ab WHERE away >= 6)
SELECT game_id, team AS team_tricode, player_slug, shock_type, CAST(seq AS INT) AS shock_seq, 1 AS period, printf('00:%02d:%02d', CAST(floor(greatest(0, 720 - el) / 60) AS INT), CAST(floor(greatest(0, 720 - el) % 60) AS INT)) AS clock_hhmmss, CAST(s0 AS INT) AS event_idx_start, CAST(s1 AS INT) AS event_idx_end,
  player_slug <> 'TEAM' AND {_sub} AS immediate_sub, CAST(since AS BIGINT) AS poss_since_event, notes, severity, round(greatest(0, 720 - el), 6)::DOUBLE AS time_remaining, round(el, 6)::DOUBLE AS seconds_elapsed FROM x""")
def early_shocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shocks.early_shocks(events(spark, sf_dir)))


@Q.add(f"""WITH {E_SQL}, c AS (SELECT *, count(*) FILTER ({_change}) OVER (PARTITION BY game_id ORDER BY event_idx) AS n FROM e), x AS (SELECT game_id, event_idx, n, player1_name_slug AS player_slug FROM c WHERE event_type = 'FOUL' AND player1_name_slug IS NOT NULL) SELECT game_id, event_idx, {_sub} AS immediate_sub FROM x""")
def immediate_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = sequence.with_possession_counts(events(spark, sf_dir))
    fouls = e.where("event_type = 'FOUL' and player1_name_slug is not null").select("game_id", "event_idx", "changes", F.col("player1_name_slug").alias("player_slug"))
    return sequence.with_immediate_sub(fouls, e).select("game_id", "event_idx", "immediate_sub")


_poss = f"""o AS (SELECT *, CASE WHEN mn <> mx THEN CASE WHEN team_tricode = mn THEN mx WHEN team_tricode = mx THEN mn END END AS opp FROM (SELECT *, min(team_tricode) OVER (PARTITION BY game_id) AS mn, max(team_tricode) OVER (PARTITION BY game_id) AS mx FROM src)),
a AS (SELECT *, team_tricode IS NOT NULL AND (event_type IN ('SHOT_MADE', 'FREE_THROW_MADE', 'TURNOVER', 'PERSONAL_FOUL', 'JUMP_BALL') OR (event_type = 'REBOUND' AND description LIKE 'DEF%')) AS gives, CASE WHEN event_type IN ('JUMP_BALL', 'REBOUND') THEN team_tricode ELSE opp END AS given FROM o),
h AS (SELECT *, last_value(CASE WHEN gives THEN coalesce(given, '-') END IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY event_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held0 FROM a),
h2 AS (SELECT *, nullif(held0, '-') AS held FROM h)
SELECT game_id, event_idx, CAST(CASE WHEN NOT gives THEN 0 WHEN event_type IN ('SHOT_MADE', 'FREE_THROW_MADE') THEN coalesce(held <> team_tricode, false)::INT WHEN event_type IN ('JUMP_BALL', 'REBOUND') THEN (held IS DISTINCT FROM team_tricode)::INT ELSE (opp IS NOT NULL AND held IS DISTINCT FROM opp)::INT END AS INT) AS possession_change,
  CAST((team_tricode IS NULL)::INT AS INT) AS possession_unknown, CASE WHEN gives THEN given ELSE held END AS possession FROM h2"""


@Q.add(f"WITH {E_SQL}, src AS (SELECT * FROM e), {_poss}")
def possession_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.track_possession(events(spark, sf_dir)).select("game_id", "event_idx", "possession_change", "possession_unknown", "possession")


@Q.add(f"""WITH {E_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY game_id, {_same} ORDER BY event_idx) AS k FROM e WHERE period = 1), src AS (SELECT * FROM f WHERE k = 1 AND clock_ms_remaining BETWEEN 0 AND 720000 AND (clock_ms_remaining = 480000 OR clock_ms_remaining >= 481000)), {_poss}""")
def opening_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_events(events(spark, sf_dir)).select("game_id", "event_idx", "possession_change", "possession_unknown", "possession")


_len = "CASE WHEN period BETWEEN 1 AND 4 THEN 720000 ELSE 300000 END"


@Q.add(f"""WITH {E_SQL}, f AS (SELECT *, {_len} AS len FROM e WHERE period BETWEEN 1 AND 10 AND clock_ms_remaining BETWEEN 0 AND {_len}),
k AS (SELECT *, row_number() OVER (PARTITION BY game_id, {_same} ORDER BY event_idx) AS k FROM f WHERE clock_ms_remaining = len - 240000 OR clock_ms_remaining >= len - 239000),
p AS (SELECT *, CASE event_type WHEN 'SHOT_MADE' THEN coalesce(nullif(shot_value, 0), 2) WHEN 'FREE_THROW_MADE' THEN 1 ELSE 0 END AS pts FROM k WHERE k = 1 AND team_tricode IS NOT NULL),
q AS (SELECT *, min(team_tricode) OVER w AS t1, max(team_tricode) OVER w AS t2 FROM p WINDOW w AS (PARTITION BY game_id, period)),
r AS (SELECT *, sum(CASE WHEN team_tricode = t1 THEN pts ELSE 0 END) OVER w AS s1, sum(CASE WHEN team_tricode = t2 AND t1 <> t2 THEN pts ELSE 0 END) OVER w AS s2, min(CASE WHEN team_tricode = t1 AND pts > 0 THEN event_idx END) OVER w AS f1, min(CASE WHEN team_tricode = t2 AND pts > 0 THEN event_idx END) OVER w AS f2 FROM q WINDOW w AS (PARTITION BY game_id, period ORDER BY event_idx)),
l AS (SELECT *, CASE WHEN s1 > s2 THEN t1 WHEN s2 > s1 THEN t2 WHEN coalesce(f1, 2000000000) <= coalesce(f2, 2000000000) THEN t1 ELSE t2 END AS leader FROM r),
m AS (SELECT *, last_value(CASE WHEN pts > 0 THEN leader END IGNORE NULLS) OVER (PARTITION BY game_id, period ORDER BY event_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM l),
g AS (SELECT game_id, period, team_tricode, CAST(sum(pts) AS BIGINT) AS points_for, count(*) FILTER (event_type LIKE 'SHOT%') AS fga, count(*) FILTER (event_type LIKE 'FREE%') AS fta, count(*) FILTER (event_type = 'REBOUND' AND description LIKE 'Off%') AS oreb, count(*) FILTER (event_type = 'TURNOVER') AS tov,
  count(*) FILTER (pts > 0 AND was IS NOT NULL AND was <> leader) AS lead_changes, count(*) AS n_events FROM m GROUP BY 1, 2, 3),
x AS (SELECT *, CAST(sum(points_for) OVER (PARTITION BY game_id, period) - points_for AS BIGINT) AS points_against, CAST(greatest(1, fga + floor(0.44 * fta) - oreb + tov) AS BIGINT) AS possessions FROM g)
SELECT *, round((points_for - points_against) / possessions * 100, 6)::DOUBLE AS net_rating FROM x""")
def early_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.early_period_stats(events(spark, sf_dir)))


@Q.add(f"""WITH {E_SQL}, p AS (SELECT *, CASE event_type WHEN 'SHOT_MADE' THEN coalesce(shot_value, 2) ELSE 0 END AS pts FROM e WHERE team_tricode IS NOT NULL), q AS (SELECT *, min(team_tricode) OVER w AS t1, max(team_tricode) OVER w AS t2 FROM p WINDOW w AS (PARTITION BY game_id, period)),
r AS (SELECT *, sum(CASE WHEN team_tricode = t1 THEN pts ELSE 0 END) OVER w AS s1, sum(CASE WHEN team_tricode = t2 AND t1 <> t2 THEN pts ELSE 0 END) OVER w AS s2, min(CASE WHEN team_tricode = t1 AND pts > 0 THEN event_idx END) OVER w AS f1, min(CASE WHEN team_tricode = t2 AND pts > 0 THEN event_idx END) OVER w AS f2 FROM q WINDOW w AS (PARTITION BY game_id, period ORDER BY event_idx)),
l AS (SELECT *, CASE WHEN s1 > s2 THEN t1 WHEN s2 > s1 THEN t2 WHEN f1 IS NULL AND f2 IS NULL THEN NULL WHEN coalesce(f1, 2000000000) <= coalesce(f2, 2000000000) THEN t1 ELSE t2 END AS leader FROM r),
m AS (SELECT *, last_value(CASE WHEN pts > 0 THEN leader END IGNORE NULLS) OVER (PARTITION BY game_id, period ORDER BY event_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM l)
SELECT game_id, period, event_idx, leader, CAST(pts > 0 AND was IS NOT NULL AND was <> leader AS INT) AS lead_change FROM m""")
def lead_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("team_tricode is not null").withColumn("points", F.expr("CASE event_type WHEN 'SHOT_MADE' THEN coalesce(shot_value, 2) ELSE 0 END"))
    return windows.with_lead_changes(e).select("game_id", "period", "event_idx", "leader", "lead_change")


_rest = """s AS (SELECT game_id, home_team_id AS team, home_team_id AS home, game_date_utc AS t FROM g UNION ALL SELECT game_id, away_team_id, home_team_id, game_date_utc FROM g),
r AS (SELECT *, CAST(t AS DATE) - lag(CAST(t AS DATE), 1) OVER w AS b1, CAST(t AS DATE) - lag(CAST(t AS DATE), 2) OVER w AS b2, CAST(t AS DATE) - lag(CAST(t AS DATE), 4) OVER w AS b4, lag(home) OVER w AS prev FROM s WINDOW w AS (PARTITION BY team ORDER BY t, game_id))"""
_flags = "coalesce(b1 = 1, false) AS is_back_to_back, coalesce(b2 + 1 <= 4, false) AS is_3_in_4, coalesce(b4 + 1 <= 7, false) AS is_5_in_7, CAST(b1 - 1 AS INT) AS days_rest"


@Q.add(f"WITH {G_SQL}, {_rest} SELECT game_id, team AS team_tricode, {_flags} FROM r")
def rest_and_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir).withColumnsRenamed({"home_team_id": "home_team_tricode", "away_team_id": "away_team_tricode"})
    return travel.with_rest(travel.team_schedule(g)).select("game_id", "team_tricode", "is_back_to_back", "is_3_in_4", "is_5_in_7", "days_rest")


_off = "CASE {}.arena_tz WHEN 'America/Los_Angeles' THEN -8 WHEN 'America/Denver' THEN -7 WHEN 'America/Phoenix' THEN -7 WHEN 'America/Chicago' THEN -6 WHEN 'America/New_York' THEN -5 ELSE 0 END"


@Q.add(f"""WITH {G_SQL}, {V_SQL}, {_rest},
l AS (SELECT r.*, {_off.format("h")} - {_off.format("p")} AS shift, h.altitude_m - p.altitude_m AS climb, hour(t) AS hr, 2 * 6371.0 * asin(sqrt(least(pow(sin(radians(h.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(h.lat)) * pow(sin(radians(h.lon - p.lon) / 2), 2), 1.0))) AS km FROM r JOIN v h ON r.home = h.team_id JOIN v p ON r.prev = p.team_id WHERE b1 IS NOT NULL),
b AS (SELECT *, (least(abs(shift) / 3.0::DOUBLE, 1.0) * CASE WHEN shift > 0 THEN 1.5 ELSE 1 END + CASE WHEN km > 1000 THEN least(km / 5000, 0.3) ELSE 0 END) * CASE WHEN b1 = 1 THEN 1.5 WHEN b1 = 2 THEN 1.0 WHEN b1 >= 4 THEN 0.5 ELSE 0.8 END * CASE WHEN shift > 0 AND hr >= 22 THEN 1.2 ELSE 1 END AS x FROM l)
SELECT game_id, team AS team_tricode, {_flags}, shift::DOUBLE AS timezone_shift_hours, round(km, 6) AS distance_km, climb AS altitude_change_m, round(greatest(0, least(1, x + CASE WHEN climb > 1000 THEN least(climb / 2000, 0.2) ELSE 0 END))::DOUBLE, 6) AS circadian_index FROM b""")
def schedule_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir).withColumnsRenamed({"home_team_id": "home_team_tricode", "away_team_id": "away_team_tricode"})
    return rounded(travel.schedule_travel(g, venues(spark, sf_dir)))


@Q.add(f"""WITH {G_SQL} SELECT game_id, home_team_id, away_team_id, home_score AS final_home_points, away_score AS final_away_points, home_score + away_score AS total_points, home_score > away_score AS home_win, home_score - away_score AS margin, abs(home_score - away_score) AS abs_margin, overtime_periods > 0 AS overtime FROM g WHERE status = 'FINAL'""")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return teams.outcomes(games(spark, sf_dir))


def _h2h(source: str) -> str:
    return f"""p AS (SELECT *, least(home_team_id, away_team_id) AS team1, greatest(home_team_id, away_team_id) AS team2, CASE WHEN home_team_id < away_team_id THEN home_score ELSE away_score END AS a, CASE WHEN home_team_id < away_team_id THEN away_score ELSE home_score END AS b FROM g),
n AS (SELECT *, row_number() OVER (PARTITION BY team1, team2 ORDER BY game_date_local DESC, game_id DESC) AS k FROM p)
SELECT team1, team2, count(*) AS total_games, count(*) FILTER (a > b) AS team1_wins, round(avg(a), 6) AS avg_points1, round(avg(b), 6) AS avg_points2, round(avg(abs(a - b)), 6) AS avg_margin, count(*) - count(*) FILTER (a > b) AS team2_wins FROM n {source} GROUP BY 1, 2"""


@Q.add(f"WITH {G_SQL}, {_h2h('')}")
def head_to_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(teams.head_to_head(games(spark, sf_dir)))


@Q.add(f"WITH {G_SQL}, {_h2h('WHERE k <= 2')}")
def head_to_head_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each pair's last two games: the limit is the feature."""
    return rounded(teams.head_to_head(games(spark, sf_dir), 2))


_stats = f"""{E_SQL}, gm AS (SELECT DISTINCT game_id, home_team_tricode AS h, away_team_tricode AS a FROM e),
s AS (SELECT gm.game_id, CASE WHEN team_id = h THEN h ELSE a END AS team_id, CAST(coalesce(sum(CASE WHEN event_type = 'SHOT_MADE' AND shot_value IN (1, 2, 3) THEN shot_value WHEN event_type = 'FREE_THROW_MADE' THEN 1 ELSE 0 END), 0) AS BIGINT) AS points,
  count(*) FILTER (event_type = 'SHOT_MADE' AND shot_value IN (2, 3)) AS field_goals_made, count(*) FILTER (event_type LIKE 'SHOT%' AND shot_value IN (2, 3)) AS field_goals_attempted, count(*) FILTER (event_type = 'SHOT_MADE' AND shot_value = 3) AS three_pointers_made, count(*) FILTER (event_type LIKE 'SHOT%' AND shot_value = 3) AS three_pointers_attempted,
  count(*) FILTER (event_type = 'FREE_THROW_MADE') AS free_throws_made, count(*) FILTER (event_type LIKE 'FREE%') AS free_throws_attempted, count(*) FILTER (rebound_type = 'OFFENSIVE') AS offensive_rebounds, count(*) FILTER (rebound_type = 'DEFENSIVE') AS defensive_rebounds,
  count(*) FILTER (event_type = 'ASSIST') AS assists, count(*) FILTER (event_type = 'TURNOVER') AS turnovers, count(*) FILTER (event_type = 'STEAL') AS steals, count(*) FILTER (event_type = 'BLOCK') AS blocks, count(*) FILTER (event_type = 'FOUL') AS personal_fouls FROM gm LEFT JOIN e USING (game_id) GROUP BY 1, 2),
st AS (SELECT *, greatest(1, field_goals_attempted + turnovers) AS poss FROM s)"""


@Q.add(f"WITH {_stats} SELECT * EXCLUDE (poss), 48.0::DOUBLE AS duration_minutes, poss AS possessions_estimated, round(poss * 48.0 / 48, 6)::DOUBLE AS pace, round(points * 100.0 / poss, 6)::DOUBLE AS offensive_rating FROM st")
def team_game_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_team_stats(spark, sf_dir))


def _team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    g = e.select("game_id", F.col("home_team_tricode").alias("home_team_id"), F.col("away_team_tricode").alias("away_team_id"), F.lit(48.0).alias("duration_minutes")).distinct()
    return teams.team_game_stats(g, e)


@Q.add(f"""WITH {_stats} SELECT game_id, team_id, round(coalesce((field_goals_made + 0.5 * three_pointers_made) / nullif(field_goals_attempted, 0), 0), 6)::DOUBLE AS effective_fg_pct, round(coalesce(points / nullif(2 * (field_goals_attempted + 0.44 * free_throws_attempted), 0), 0), 6)::DOUBLE AS true_shooting_pct,
round(CASE WHEN turnovers > 0 THEN assists / turnovers ELSE assists END, 6)::DOUBLE AS assist_turnover_ratio, CASE WHEN offensive_rebounds + defensive_rebounds > 0 THEN 0.5 ELSE 0 END::DOUBLE AS rebound_pct_estimated FROM st""")
def team_advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(teams.with_advanced(_team_stats(spark, sf_dir)).select("game_id", "team_id", "effective_fg_pct", "true_shooting_pct", "assist_turnover_ratio", "rebound_pct_estimated"))


_z = lambda k, sign="": f"round(CASE WHEN sd_{k} > 0 THEN coalesce({sign}({k} - m_{k}) / sd_{k}, 0) ELSE 0 END, 6)::DOUBLE + 0.0 AS"


@Q.add(f"""WITH {_stats}, r AS (SELECT game_id, team_id, points * 100.0::DOUBLE / poss AS o FROM st), d AS (SELECT r.*, (SELECT x.o FROM r x WHERE x.game_id = r.game_id AND x.team_id <> r.team_id) AS d FROM r), n AS (SELECT *, o - d AS n FROM d),
z AS (SELECT avg(o) AS m_o, stddev(o) AS sd_o, avg(d) AS m_d, stddev(d) AS sd_d, avg(n) AS m_n, stddev(n) AS sd_n FROM n)
SELECT game_id, team_id, round(o, 6) AS offensive_rating, round(d, 6) AS defensive_rating, round(n, 6) + 0.0 AS net_rating, {_z("o")} offensive_z, {_z("d", "-")} defensive_z, {_z("n")} net_z FROM n, z""")
def team_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(teams.with_efficiency(_team_stats(spark, sf_dir)).select("game_id", "team_id", "offensive_rating", "defensive_rating", "net_rating", "offensive_z", "defensive_z", "net_z"))


@Q.add("""WITH x AS (SELECT l_orderkey AS game_id, l_suppkey AS team_id, sum(l_extendedprice)::DOUBLE AS v FROM lineitem GROUP BY 1, 2), t AS (SELECT *, sum(v) OVER (PARTITION BY game_id) - v AS o FROM x)
SELECT game_id, team_id, round(v, 2) AS own_value, round(o, 2) + 0.0 AS opponents_value FROM t""")
def opponent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier of an order against the order's other suppliers: a window in place of a self-join."""
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id")).agg(F.sum("l_extendedprice").alias("own_value"))
    return rounded(teams.with_opponents(x, "own_value", "opponents_value"), 2)
