"""Result sets, pages, game books and names on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crosswalk
from ..sources import game_books, pages, result_sets
from .adapters import E_SQL, G_SQL, Queries, events, games, rounded, spread, table

Q = Queries()


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload a game, made from the events: game_id, body."""
    e = events(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    row = F.array(text("event_idx"), F.lit("1"), text("period"), F.coalesce(F.col("time_remaining"), F.lit("12:00")), F.col("description"))
    g = e.groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("event_idx", row.alias("r")))).alias("rs"))
    heads = F.array(*[F.lit(h) for h in ("EVENTNUM", "EVENTMSGTYPE", "PERIOD", "PCTIMESTRING", "HOMEDESCRIPTION")])
    one = F.struct(F.lit("PlayByPlay").alias("name"), heads.alias("headers"), F.transform("rs", lambda x: x["r"]).alias("rowSet"))
    return g.select("game_id", F.to_json(F.struct(F.array(one).alias("resultSets"))).alias("body"))


@Q.add(f"""WITH {E_SQL} SELECT game_id, event_idx AS event_num, period, coalesce(time_remaining, '12:00') AS clock, 1 AS event_code, description FROM e WHERE event_idx >= 1""")
def resultset_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_sets.plays(payloads(spark, sf_dir)).select("game_id", "event_num", "period", "clock", "event_code", "description")


@Q.add(r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, CAST(len(regexp_extract_all(html, '(?i)<a\s')) AS INT) AS n_links, CAST(len(regexp_extract_all(html, '(?i)<tr[\s>]')) AS INT) AS n_rows, CAST(length(regexp_replace(html, '<[^>]*>', '', 'g')) AS INT) AS n_text FROM pages""")
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_facts(table(spark, sf_dir, "pages")).select("page_id", "title", "n_links", "n_rows", "n_text")


@Q.add("""SELECT o_orderkey, CAST(o_orderkey % 30 AS INT) AS away_q1, CAST(o_orderkey % 40 AS INT) AS home_q1, CAST(o_orderkey % 130 AS INT) AS away_final, CAST(o_orderkey % 140 AS INT) AS home_final, CAST(o_orderkey % 3 AS INT) AS ot_periods FROM orders""")
def html_line_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line-score table written from each order and read back."""
    k = F.col("o_orderkey")
    n = lambda m: (k % m).cast("string")
    heads = F.concat(F.lit("<thead><tr><th>Team</th><th>1</th><th>2</th><th>3</th><th>4</th>"), F.repeat(F.lit("<th>OT</th>"), (k % 3).cast("int")), F.lit("<th>T</th></tr></thead>"))
    line = lambda t, a, b: F.concat(F.lit(f"<tr><th><a href='/x'>{t}</a></th><td>"), n(a), F.lit("</td><td>1</td><td>2</td><td>3</td>"), F.repeat(F.lit("<td>5</td>"), (k % 3).cast("int")), F.lit("<td><strong>"), n(b), F.lit("</strong></td></tr>"))
    html = F.concat(F.lit('<div><table class="t" id="line_score">'), heads, F.lit("<tbody>"), line("A", 30, 130), line("H", 40, 140), F.lit("</tbody></table></div>"))
    return pages.line_score(table(spark, sf_dir, "orders").select("o_orderkey", html.alias("html"))).select("o_orderkey", "away_q1", "home_q1", "away_final", "home_final", "ot_periods")


_first, _last = ["Adam", "Bert", "Carl", "Dora", "Ella"], ["Able", "Baker", "Cole", "Dean", "Early", "Field", "Green"]
_person = lambda k, a: "CASE {} % 5 {} END || ' ' || CASE {} % 7 {} END".format(k, " ".join(f"WHEN {i} THEN '{_first[(i + a) % 5]}'" for i in range(5)), k, " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_last)))


@Q.add(f"SELECT s_suppkey, {_person('s_suppkey', 0)} || ':CREW_CHIEF,' || {_person('s_suppkey', 3)} || CASE s_suppkey % 2 WHEN 0 THEN ':REFEREE' ELSE ':UMPIRE' END AS refs, 0.6::DOUBLE AS confidence, '00' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS game_id_found, true AS is_valid FROM supplier")
def gamebook_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game book's text written from each supplier and parsed."""
    k = F.col("s_suppkey")
    game = F.concat(F.lit("00"), F.lpad(k.cast("string"), 8, "0"))
    body = F.concat(F.lit("OFFICIAL GAME BOOK\nGame "), game, F.lit("\n"), F.lit("Crew Chief: "), F.expr(_person("s_suppkey", 0)), F.when(k % 2 == 0, "\nReferee: ").otherwise("\nUmpire: "), F.expr(_person("s_suppkey", 3)), F.lit("\nArena: Big Hall, Town\n"))
    parsed = game_books.quality(game_books.parse(spread(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", game.alias("game_id"), body.alias("text"))))
    people = F.array_join(F.transform("refs", lambda r: F.concat(r["name"], F.lit(":"), r["role"])), ",")
    return rounded(parsed.select("s_suppkey", people.alias("refs"), F.col("parsing_confidence").alias("confidence"), "game_id_found", "is_valid"))


@Q.add("SELECT DISTINCT substr(s_name, 1, 4) || 'x' || substr(s_name, 6) AS name, s_name AS match, round(200.0 * (length(s_name) - 1) / (2 * length(s_name)), 6)::DOUBLE AS score FROM supplier")
def fuzzy_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier names with a letter changed against the names themselves. All have one length and none an x, so no name can share more letters than the one that was changed."""
    names = table(spark, sf_dir, "supplier").select(F.concat(F.substring("s_name", 1, 4), F.lit("x"), F.substr("s_name", F.lit(6))).alias("name"))
    return rounded(crosswalk.fuzzy_match(names, table(spark, sf_dir, "supplier").select(F.col("s_name").alias("known"))))


@Q.add(f"""WITH {G_SQL}, p AS (SELECT DISTINCT strftime(game_date_local + CAST((length(game_id) + CAST(right(game_id, 1) AS INT)) % 4 - 1 AS INT), '%Y%m%d') || '0' || home_team_id AS page_id FROM g WHERE CAST(right(game_id, 2) AS INT) % 3 <> 0),
c AS (SELECT game_id, o AS d, strftime(game_date_local + CAST(o AS INT), '%Y%m%d') || '0' || home_team_id AS page_id FROM g, generate_series(-7, 7) t(o)),
m AS (SELECT c.*, row_number() OVER (PARTITION BY game_id ORDER BY abs(d), d) AS k FROM c SEMI JOIN p USING (page_id))
SELECT g.game_id, coalesce(m.page_id, 'UNRESOLVED_' || g.game_id) AS page_id, CASE WHEN d = 0 THEN 1.0 WHEN d IS NOT NULL THEN 0.8 ELSE 0.0 END::DOUBLE AS confidence FROM g LEFT JOIN m ON g.game_id = m.game_id AND k = 1""")
def crosswalk_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir).select("game_id", "game_date_local", F.col("home_team_id").alias("home_team_tricode"))
    shift = (F.length("game_id") + F.substr("game_id", F.lit(-1)).cast("int")) % 4 - 1
    p = g.where("cast(right(game_id, 2) as int) % 3 <> 0").select(F.concat(F.date_format(F.date_add("game_date_local", shift), "yyyyMMdd"), F.lit("0"), F.col("home_team_tricode")).alias("page_id"))
    return crosswalk.crosswalk(g, p)


@Q.add("SELECT s_suppkey, n_name AS canonical FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 6 <> 0")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    aliases = n.where("n_nationkey % 6 <> 0").select(F.concat(F.lit("k"), F.col("n_nationkey").cast("string")).alias("alias"), F.col("n_name").alias("canonical"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit(" K"), F.col("s_nationkey").cast("string"), F.lit(" ")).alias("raw"))
    found, _ = crosswalk.resolve_aliases(rows, "raw", aliases)
    return found.select("s_suppkey", "canonical")
