"""Scalar functions on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock, codes, dates, numbers, text
from .adapters import E_SQL, G_SQL, Queries, events, games, rounded, table

Q = Queries()
_len = "CASE WHEN period BETWEEN 1 AND 4 THEN 720000 ELSE 300000 END"


@Q.add(f"""WITH {E_SQL} SELECT event_idx, period, time_remaining, clock_ms_remaining, round(CASE WHEN period <= 4 THEN (period - 1) * 720 + 720 - clock_ms_remaining / 1000.0 ELSE 2880 + (period - 5) * 300 + 300 - clock_ms_remaining / 1000.0 END::DOUBLE, 6) AS game_seconds,
CASE WHEN clock_ms_remaining IS NULL THEN NULL ELSE clock_ms_remaining <= 720000 AND (clock_ms_remaining = 480000 OR clock_ms_remaining >= 481000) END AS in_opening FROM e""")
def clock_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.col("clock_ms_remaining")
    e = events(spark, sf_dir).select("event_idx", "period", "time_remaining", "clock_ms_remaining", clock.seconds_elapsed_in_game(F.col("period"), ms / 1000).alias("game_seconds"), clock.in_clock_window(ms, 480_000, 720_000).alias("in_opening"))
    return rounded(e)


@Q.add(f"""WITH {E_SQL}, w AS (SELECT *, {_len} AS len FROM e WHERE period BETWEEN 1 AND 10 AND clock_ms_remaining BETWEEN 0 AND {_len})
SELECT game_id, period, event_idx, clock_ms_remaining FROM w WHERE clock_ms_remaining <= len AND (clock_ms_remaining = len - 240000 OR clock_ms_remaining >= len - 239000)""")
def clock_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the first four minutes of any period."""
    p, ms = F.col("period"), F.col("clock_ms_remaining")
    return events(spark, sf_dir).where(clock.valid_period_event(p, ms) & clock.in_first_minutes(p, ms)).select("game_id", "period", "event_idx", "clock_ms_remaining")


@Q.add(f"""WITH {E_SQL}, s AS (SELECT event_idx, time_remaining AS t, CASE WHEN time_remaining LIKE 'PT%' THEN coalesce(try_cast(regexp_extract(time_remaining, '^PT(\\d+)M', 1) AS DOUBLE), 0) * 60 + coalesce(try_cast(regexp_extract(time_remaining, '^PT(?:\\d+M)?(\\d+(?:\\.\\d+)?)S', 1) AS DOUBLE), 0)
  WHEN regexp_matches(time_remaining, '^\\d+:\\d+') THEN try_cast(split_part(time_remaining, ':', 1) AS DOUBLE) * 60 + try_cast(split_part(time_remaining, ':', 2) AS DOUBLE) ELSE try_cast(time_remaining AS DOUBLE) END AS seconds FROM e)
SELECT event_idx, seconds, CAST(floor(seconds / 60) AS BIGINT) || ':' || CASE WHEN seconds % 60 = floor(seconds % 60) THEN lpad(CAST(CAST(seconds % 60 AS BIGINT) AS VARCHAR), 2, '0') ELSE lpad(printf('%.1f', seconds % 60), 4, '0') END AS normalized FROM s""")
def clock_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("time_remaining")
    return events(spark, sf_dir).select("event_idx", clock.parse_game_clock(t).alias("seconds"), clock.normalize_clock(t).alias("normalized"))


_season = "CAST({y} AS VARCHAR) || '-' || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')"
_y10, _y8 = "(year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END)", "(year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END)"


@Q.add(f"SELECT o_orderkey, {_season.format(y=_y10)} AS season, {_season.format(y=_y8)} AS bridge_season FROM orders")
def season_from_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.season_from_date(d).alias("season"), dates.season_from_date(d, 8).alias("bridge_season"))


@Q.add(f"""WITH s AS (SELECT DISTINCT {_season.format(y=_y10)} AS season, {_y10} AS y FROM orders)
SELECT season, make_date(y, 10, 1) AS first_day, make_date(y + 1, 9, 30) AS last_day, make_date(y + 1, 4, 30) AS last_game_day, CAST(make_date(y + 1, 4, 30) - make_date(y, 10, 1) + 1 AS INT) AS n_days FROM s""")
def season_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.incremental import season_days

    s = table(spark, sf_dir, "orders").select(dates.season_from_date(F.col("o_orderdate")).alias("season")).distinct()
    b, r = dates.season_bounds(F.col("season")), dates.season_bounds(F.col("season"), 4, 30)
    return s.select("season", b["start"].alias("first_day"), b["end"].alias("last_day"), r["end"].alias("last_game_day"), F.size(season_days(F.col("season"))).alias("n_days"))


@Q.add(f"""WITH {G_SQL}, s AS (SELECT game_id, regexp_extract(game_id, '^00[1-9](\\d{{2}})\\d{{5}}$', 1) AS yy, game_date_local AS d FROM g)
SELECT game_id, coalesce(CASE WHEN yy <> '' THEN '20' || yy || '-' || lpad(CAST((CAST(yy AS INT) + 1) % 100 AS VARCHAR), 2, '0') END, {_season.format(y="(year(d) - CASE WHEN month(d) < 10 THEN 1 ELSE 0 END)")}) AS season,
  regexp_matches(game_id, '^\\d{{10}}$') AS is_id, strftime(d, '%Y%m%d') AS odds_key FROM s""")
def season_smart(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("game_date_local")
    return games(spark, sf_dir).select("game_id", dates.season_or_unknown(F.col("game_id"), d, F.lit(None).cast("string")).alias("season"), text.valid_game_id(F.col("game_id"), False).alias("is_id"), dates.odds_key(d).alias("odds_key"))


@Q.add("""SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS local_date,
CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE CASE WHEN event_id % 2 = 0 THEN 'America/Denver' ELSE 'America/New_York' END AS DATE) AS arena_date FROM events""")
def local_game_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", dates.local_date(ts).alias("local_date"), dates.local_date(ts, F.when(F.col("event_id") % 2 == 0, "America/Denver")).alias("arena_date"))


@Q.add("""WITH t AS (SELECT o_orderkey, o_orderdate AS d, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE 'no date' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 2 AND year(d) < 2000 THEN CAST(d AS DATE) + INTERVAL 100 YEAR ELSE CAST(d AS DATE) END::DATE AS parsed FROM t""")
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in four ways; two-digit years are 2000 to 2099."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 5
    d = F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy")).when(k == 2, F.date_format(d, "MM/dd/yy")).when(k == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("no date"))
    o = o.select("o_orderkey", raw.alias("raw"))
    return o.withColumn("parsed", dates.parse_date(F.col("raw")))


_raws = "CASE p_partkey % 8 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size AS VARCHAR) || '.75' WHEN 2 THEN '1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') WHEN 3 THEN ' N/A ' WHEN 4 THEN CAST(p_size AS VARCHAR) || '.5%' WHEN 5 THEN '--' WHEN 6 THEN 'yes' ELSE 'DNP' END"


@Q.add(f"""WITH t AS (SELECT p_partkey, {_raws} AS raw FROM part)
SELECT p_partkey, raw, CAST(trunc(try_cast(replace(raw, ',', '') AS DOUBLE)) AS BIGINT) AS as_long, try_cast(replace(replace(raw, ',', ''), '%', '') AS DOUBLE) AS as_double, CASE WHEN raw IN ('1', 'yes') THEN true WHEN raw = '0' THEN false END AS as_bool,
  CASE WHEN trim(raw) NOT IN ('N/A', '--') THEN trim(raw) END AS as_text, try_cast(regexp_extract(raw, '-?\\d+(?:\\.\\d+)?') AS DOUBLE) AS first_number FROM t""")
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k, s = table(spark, sf_dir, "part"), F.col("p_partkey") % 8, F.col("p_size").cast("string")
    raw = F.when(k == 0, s).when(k == 1, F.concat(s, F.lit(".75"))).when(k == 2, F.concat(F.lit("1,"), F.lpad(s, 3, "0"))).when(k == 3, " N/A ").when(k == 4, F.concat(s, F.lit(".5%"))).when(k == 5, "--").when(k == 6, "yes").otherwise("DNP")
    r = F.col("raw")
    return p.select("p_partkey", raw.alias("raw")).select("p_partkey", "raw", numbers.to_long(r).alias("as_long"), numbers.to_double(r).alias("as_double"), numbers.to_bool(r).alias("as_bool"), numbers.text_or_null(r).alias("as_text"), numbers.first_number(r).alias("first_number"))


@Q.add("""SELECT s_suppkey, 'Supplier' || CAST(s_suppkey AS VARCHAR) || 'Iii' AS pascal_slug, lower(regexp_replace('O''Neil-' || s_name || ' Jr.', '\\s+', '', 'g')) AS lower_slug, trim(regexp_replace(s_name, '\\s+', ' ', 'g')) AS cleaned FROM supplier""")
def name_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    pascal = text.name_slug(F.concat(F.lit("SUPPLIER "), F.col("s_suppkey").cast("string"), F.lit(" i'II")))
    low = text.name_slug(F.concat(F.lit("O'Neil-"), F.col("s_name"), F.lit(" Jr.")), "lower")
    return table(spark, sf_dir, "supplier").select("s_suppkey", pascal.alias("pascal_slug"), low.alias("lower_slug"), text.clean_player_name(F.concat(F.col("s_name"), F.lit("  Jr"))).alias("cleaned"))


@Q.add(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20-\x7E\n]', ' ', 'g'), ' *\n\s*', chr(10), 'g'), ' +', ' ', 'g'))) AS ascii_md5,
md5(regexp_replace(regexp_replace(trim(coalesce(text, '')), '[ \t\n\x0B\f\r]+', ' ', 'g'), '([.!?]){2,}', '\1', 'g')) AS described_md5 FROM documents""")
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_text(t)).alias("ascii_md5"), F.md5(F.coalesce(text.normalize_description(t), F.lit(""))).alias("described_md5"))


@Q.add(r"""WITH m AS (SELECT page_id, 'GET ' || coalesce(url, '') || CASE page_id % 4 WHEN 0 THEN ' failed' WHEN 1 THEN ' timed out' WHEN 2 THEN ' was refused' ELSE ' is gone' END || ' for 0022300' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || ' on 2024-01-0' || CAST(1 + page_id % 9 AS VARCHAR) || ' from 10.0.0.' || CAST(page_id % 200 AS VARCHAR) AS message FROM pages),
n AS (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(message), '\b00\d{8}\b', '[GAME_ID]', 'g'), '\d{4}-\d{2}-\d{2}', '[DATE]', 'g'), 'https?://[^\s]+', '[URL]', 'g'), '\b\d+\.\d+\.\d+\.\d+\b', '[IP]', 'g') AS t FROM m)
SELECT trim(CASE WHEN length(t) > 100 THEN substr(t, 1, 100) || '...' ELSE t END) AS error, count(*) AS n_rows FROM n GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def error_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent errors: a report."""
    from ..operators.manifest import top_errors

    k = F.col("page_id")
    message = F.concat(F.lit("GET "), F.coalesce("url", F.lit("")), F.when(k % 4 == 0, " failed").when(k % 4 == 1, " timed out").when(k % 4 == 2, " was refused").otherwise(" is gone"), F.lit(" for 0022300"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(" on 2024-01-0"), (1 + k % 9).cast("string"), F.lit(" from 10.0.0."), (k % 200).cast("string"))
    return top_errors(table(spark, sf_dir, "pages").select(message.alias("message")), "message")


@Q.add("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props IS NOT NULL AND json_valid(props) AS is_json FROM events""")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"), parsed.isNotNull().alias("is_json"))


@Q.add("""WITH c AS (SELECT event_id, CAST(event_id % 21 AS INT) AS code FROM events)
SELECT event_id, code, CASE code WHEN 1 THEN 'SHOT_MADE' WHEN 2 THEN 'SHOT_MISSED' WHEN 3 THEN 'FREE_THROW_MADE' WHEN 4 THEN 'FREE_THROW_MISSED' WHEN 5 THEN 'REBOUND' WHEN 6 THEN 'TURNOVER' WHEN 7 THEN 'FOUL' WHEN 8 THEN 'SUBSTITUTION' WHEN 9 THEN 'TIMEOUT' WHEN 10 THEN 'JUMP_BALL'
  WHEN 11 THEN 'EJECTION' WHEN 12 THEN 'PERIOD_BEGIN' WHEN 13 THEN 'PERIOD_END' WHEN 18 THEN 'INSTANT_REPLAY' END AS event_type,
  CASE code WHEN 0 THEN 'off' WHEN 1 THEN 'def' END AS rebound, CASE code WHEN 1 THEN 'SCHEDULED' WHEN 2 THEN 'LIVE' WHEN 3 THEN 'FINAL' ELSE 'SCHEDULED' END AS status FROM c""")
def code_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("code")
    return table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 21).cast("int").alias("code")).select("event_id", "code", codes.event_type(c).alias("event_type"), codes.mapped(c, codes.REBOUND_CODES).alias("rebound"), codes.status(c.cast("string")).alias("status"))


@Q.add("""SELECT CAST(event_id % 21 AS VARCHAR) AS code, count(*) AS n_rows FROM events WHERE event_id % 21 IN (0, 14, 15, 16, 17, 19, 20) GROUP BY 1""")
def code_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("event_id") % 21).cast("int").alias("code"))
    return codes.drift(rows.withColumn("known", codes.event_type(F.col("code"))), "code", "known")


@Q.add("""SELECT n_nationkey, round(2 * 6371.0 * asin(sqrt(least(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2), 1.0))), 6) AS km, round(sqrt(lat1 * lat1 + lon1 * lon1) / 10, 6) AS feet
FROM (SELECT n_nationkey, (n_nationkey * 7 % 60)::DOUBLE AS lat1, (n_nationkey * 13 % 170)::DOUBLE AS lon1, (n_nationkey * 11 % 60)::DOUBLE AS lat2, (n_nationkey * 17 % 170)::DOUBLE AS lon2 FROM nation)""")
def travel_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    a, b, c, d = ((k * m % n).cast("double") for m, n in ((7, 60), (13, 170), (11, 60), (17, 170)))
    return rounded(table(spark, sf_dir, "nation").select("n_nationkey", numbers.haversine_km(a, b, c, d).alias("km"), numbers.shot_distance_ft(a, b).alias("feet")))


@Q.add("""WITH t AS (SELECT n_nationkey, n_name, (n_nationkey % 7 - 3)::DOUBLE AS shift, (n_nationkey * 300)::DOUBLE AS km, (n_nationkey * 100 - 500)::DOUBLE AS climb, n_nationkey % 5 - 1 AS rest, n_nationkey AS hour FROM nation),
b AS (SELECT *, (least(abs(shift) / 3, 1.0) * CASE WHEN shift > 0 THEN 1.5 ELSE 1 END + CASE WHEN km > 1000 THEN least(km / 5000, 0.3) ELSE 0 END) * CASE WHEN rest = 0 THEN 1.5 WHEN rest = 1 THEN 1.0 WHEN rest >= 3 THEN 0.5 ELSE 0.8 END AS x FROM t)
SELECT n_nationkey, round(greatest(0, least(1, x * CASE WHEN shift > 0 AND hour >= 22 THEN 1.2 ELSE 1 END + CASE WHEN climb > 1000 THEN least(climb / 2000, 0.2) ELSE 0 END))::DOUBLE, 6) AS circadian FROM b""")
def circadian(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return rounded(table(spark, sf_dir, "nation").select("n_nationkey", numbers.circadian_index((k % 7 - 3).cast("double"), (k * 300).cast("double"), (k * 100 - 500).cast("double"), k % 5 - 1, k).alias("circadian")))


@Q.add("""SELECT o_orderkey, least(a, b) || '_' || greatest(a, b) AS pair, CAST(CAST(o_orderkey % 90 AS BIGINT) AS INT) AS home, CAST(o_orderkey % 77 AS INT) AS away, b AS matchup_home, a AS matchup_away, md5(CAST(o_orderkey % 9 AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR)) AS lineup
FROM (SELECT o_orderkey, o_custkey, 'T' || CAST(o_custkey % 50 AS VARCHAR) AS a, 'T' || CAST(o_orderkey % 50 AS VARCHAR) AS b FROM orders)""")
def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, matchups, symmetric keys and lineup hashes from text."""
    s = lambda c: c.cast("string")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    a, b = F.concat(F.lit("T"), s(c % 50)), F.concat(F.lit("T"), s(k % 50))
    score, game = text.split_score(F.concat(s(k % 90), F.lit(" - "), s(k % 77))), text.split_matchup(F.concat(a, F.lit(" @ "), b))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.pair_key(a, b).alias("pair"), score["home"].alias("home"), score["away"].alias("away"), game["home"].alias("matchup_home"), game["away"].alias("matchup_away"), text.lineup_hash(F.array(s(k % 9), s(c))).alias("lineup"))


@Q.add(r"""WITH q AS (SELECT 'SELECT * FROM ' || CASE p_partkey % 3 WHEN 0 THEN 'games' WHEN 1 THEN 'events' ELSE 'shots  s' END || ' WHERE id IN (' || CAST(p_partkey AS VARCHAR) || ', 2) AND name = ''' || p_brand || ''' -- note' AS sql, p_size / 10.0 AS sec FROM part),
n AS (SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(sql, '--.*$', '', 'g'), '''[^'']*''', '''?''', 'g'), '\b\d+\b', '?', 'g'), 'IN\s*\([^)]+\)', 'IN (?)', 'gi'), '\s+', ' ', 'g')) AS t, sec FROM q)
SELECT substr(md5(t), 1, 16) AS query_hash, count(*) AS n_runs, round(sum(sec)::DOUBLE, 6) AS total_sec, min(sec)::DOUBLE AS min_sec, max(sec)::DOUBLE AS max_sec, round(avg(sec)::DOUBLE, 6) AS avg_sec, count(*) FILTER (sec > 1) AS n_slow FROM n GROUP BY 1""")
def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.manifest import query_stats

    sql = F.concat(F.lit("SELECT * FROM "), F.when(F.col("p_partkey") % 3 == 0, "games").when(F.col("p_partkey") % 3 == 1, "events").otherwise("shots  s"), F.lit(" WHERE id IN ("), F.col("p_partkey").cast("string"), F.lit(", 2) AND name = '"), F.col("p_brand"), F.lit("' -- note"))
    return rounded(query_stats(table(spark, sf_dir, "part").select(sql.alias("sql"), (F.col("p_size") / 10.0).cast("double").alias("seconds"))))


@Q.add(r"""WITH q AS (SELECT 'SELECT * FROM ' || CASE p_partkey % 3 WHEN 0 THEN 'games' WHEN 1 THEN 'events' ELSE 'shots  s' END || ' WHERE id IN (' || CAST(p_partkey AS VARCHAR) || ', 2) AND name = ''' || p_brand || ''' -- note' AS sql, p_size / 10.0 AS sec FROM part),
n AS (SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(sql, '--.*$', '', 'g'), '''[^'']*''', '''?''', 'g'), '\b\d+\b', '?', 'g'), 'IN\s*\([^)]+\)', 'IN (?)', 'gi'), '\s+', ' ', 'g')) AS t, sec FROM q), x AS (SELECT substr(md5(t), 1, 16) AS query_hash, count(*) AS n_runs, round(sum(sec)::DOUBLE, 6) AS total_sec, min(sec)::DOUBLE AS min_sec, max(sec)::DOUBLE AS max_sec, round(avg(sec)::DOUBLE, 6) AS avg_sec, count(*) FILTER (sec > 1) AS n_slow FROM n GROUP BY 1) SELECT *, row_number() OVER (ORDER BY max_sec DESC, query_hash) AS rank FROM x ORDER BY max_sec DESC, query_hash LIMIT 2""")
def top_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two statements that took longest once: a report."""
    from ..operators.manifest import query_stats, top_queries

    k = F.col("p_partkey")
    sql = F.concat(F.lit("SELECT * FROM "), F.when(k % 3 == 0, "games").when(k % 3 == 1, "events").otherwise("shots  s"), F.lit(" WHERE id IN ("), k.cast("string"), F.lit(", 2) AND name = '"), F.col("p_brand"), F.lit("' -- note"))
    stats = query_stats(table(spark, sf_dir, "part").select(sql.alias("sql"), (F.col("p_size") / 10.0).cast("double").alias("seconds")))
    return rounded(top_queries(stats, "max_sec", 2))
