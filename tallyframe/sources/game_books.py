"""Parsed text of game books: officials by role, alternates, technicals, arena, teams, quality; and player tables. Text comes from an extractor of PDF files outside Spark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.clock import part

#: A person's name, the patterns of each role, general patterns, and what is no name.
NAME = r"[A-Z][a-z]+(?:[ \t]+[A-Z][a-z]*\.?)?[ \t]+[A-Z][a-z]+"
ROLES = [("crew\\s+chief", "CREW_CHIEF"), ("referee", "REFEREE"), ("umpire", "UMPIRE"), ("official", "OFFICIAL")]
GENERAL = [r"([A-Z][a-z]+\s+[A-Z][a-z]+)(?:\s*,\s*|\s*\n\s*)", r":\s*([A-Z][a-z]+\s+[A-Z][a-z]+)", r"\(\s*([A-Z][a-z]+\s+[A-Z][a-z]+)\s*\)"]
NO_NAME = r"game\s+book|official\s+game|report\s+game|book\s+game"
KEYWORDS = ["referee", "official", "crew", "umpire"]
ALIASES = {"PLAYER": "player", "NAME": "player", "MIN": "min", "PTS": "pts", "REB": "reb", "TOT": "reb", "AST": "ast", "STL": "stl", "TO": "tov", "TOV": "tov", "PF": "pf", "BS": "blk", "BLK": "blk"}


#: Patterns of a game's id in their order, of alternates where no section names them, of a technical foul's line (player, team, time, reason), and heads of sections.
GAME_IDS = [
    ("labelled", r"(?i)(?:game\s+id|game\s+number)[:\s]*(\d{10})"),
    ("digits", r"(\d{10})"),
    ("game", r"(?i)game[:\s]*([A-Z0-9]{8,12})"),
    ("id", r"(?i)id[:\s]*([A-Z0-9]{8,12})"),
    ("date", r"(?i)(\d{8}[A-Z0-9]{2,4})"),
]
ALTERNATES = ["alternate", "standby", "backup", "substitute"]
TECHNICALS = [
    ("reason", r"(?i)T\d*[:\s]*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)\s*\(([A-Z]{3})\)\s*-\s*(\d{1,2}:\d{2}\s*Q\d)\s*-\s*([A-Za-z\s]+?)\s*$"),
    ("bench", r"(?i)T\d*[:\s]*(Bench\s+Technical)\s*\(([A-Z]{3})\)\s*-\s*(\d{1,2}:\d{2}\s*Q\d)\s*$()"),
    ("plain", r"(?i)T\d*[:\s]*([A-Z][a-z]+\s+[A-Z][a-z]+)\s*\(([A-Z]{3})\)\s*-\s*(\d{1,2}:\d{2}\s*Q\d)\s*$()"),
]
SECTIONS = {
    "game_info": r"game\s+information|game\s+details",
    "officials": r"officials?|referees?|crew",
    "alternates": r"alternates?",
    "technicals": r"technical(?:\s+foul)?s?",
    "summary": r"game\s+summary|final\s+score",
    "notes": r"notes?|comments?",
}


def first_valid(text: Column, patterns: list[tuple[str, str]], valid) -> Column:
    """struct(value, pattern): the first match of the first pattern that has a valid one, and that pattern's name; null if none has. valid: of a match."""
    found = [(name, F.filter(F.regexp_extract_all(text, F.lit(p), 1), valid)) for name, p in patterns]
    return F.coalesce(*[F.when(F.size(v) > 0, F.struct(v[0].alias("value"), F.lit(name).alias("pattern"))) for name, v in found])


def found_id(text: Column, prefix: str = "00") -> Column:
    """The id of a game in its book's text. Ten digits must begin with prefix (0022: regular season only); else 8 to 12 letters and digits count."""
    return first_valid(text, GAME_IDS, lambda x: F.when(x.rlike(r"^\d{10}$"), x.startswith(prefix)).otherwise(x.rlike("^[A-Za-z0-9]{8,12}$")))


def alternates(text: Column, refs: Column) -> Column:
    """array<struct(name, pattern)> of alternates who are none of refs (names), each once: those of the section, or where it names none, those after
    the words of ALTERNATES, in the words' order."""
    names = lambda found: F.filter(F.transform(found, clean_name), lambda n: n.isNotNull())
    section = names(F.regexp_extract_all(part(text, r"(?is)alternates?[:\s]+(.*?)(?:\n\s*\n|$)", 1), F.lit(rf"({NAME})"), 1))
    listed = lambda ns, label: F.transform(F.coalesce(ns, F.array().cast("array<string>")), lambda n: F.struct(n.alias("name"), F.lit(label).alias("pattern")))
    everyone = F.concat(listed(section, "section"), *[listed(names(F.regexp_extract_all(text, F.lit(rf"(?i:{w}s?)[:\s]*({NAME})"), 1)), w) for w in ALTERNATES])
    # Bound once: what a lambda's variable stands for is worked out one time.
    others = F.transform(F.array(refs), lambda r: F.filter(everyone, lambda p: ~F.array_contains(r, p["name"])))
    chosen = F.transform(others, lambda o: F.when(F.exists(o, lambda p: p["pattern"] == "section"), F.filter(o, lambda p: p["pattern"] == "section")).otherwise(o))
    return once(chosen[0])


def scanned(books: DataFrame, text: str = "text") -> DataFrame:
    """books without the text, with a row for each line (at, line), the section that it stands in and the team heading above it in that section.

    A line that is a section's head opens it until the next head, and a team's heading (HOME TEAM: ..., AWAY: ...) holds until
    the next one or the section's end: islands of lines of one book, which is what is grouped.
    """
    keep = [c for c in books.columns if c != text]
    book = F.xxhash64(*[F.col(c).cast("string") for c in keep], F.col(text))
    each = books.select(*keep, book.alias("_book"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    head = F.coalesce(*[F.when(F.col("line").rlike(rf"(?i)^\s*(?:{p})\s*:?\s*$"), F.lit(n)) for n, p in SECTIONS.items()])
    team = F.nullif(F.trim(F.regexp_extract("line", r"(?i)^\s*(?:HOME|AWAY|VISITING|VISITOR)(?:\s+TEAM)?:\s*(.+)$", 1)), F.lit(""))
    by_book = Window.partitionBy("_book").orderBy("at")
    marked = each.withColumn("_head", head).withColumn("section", F.last("_head", ignorenulls=True).over(by_book)).withColumn("_island", F.count("_head").over(by_book))
    return marked.withColumn("heading", F.last(team, ignorenulls=True).over(Window.partitionBy("_book", "_island").orderBy("at"))).drop("_book", "_head", "_island")


def technicals(books: DataFrame, text: str = "text") -> DataFrame:
    """books without the text, with a row for each technical foul: at, section and heading that it stands under, player, team, period, clock, kind (bench or player), reason and the pattern that told it.
    A line that repeats in a book counts once, where it stands first."""
    keep = [c for c in books.columns if c != text]
    lines = scanned(books, text)
    group = lambda p, k: F.nullif(F.trim(F.regexp_replace(F.regexp_extract("line", p, k), r"\s+", " ")), F.lit(""))
    told = F.coalesce(*[F.when(F.col("line").rlike(p), F.struct(*[group(p, k + 1).alias(n) for k, n in enumerate(("player", "team", "time", "reason"))], F.lit(name).alias("pattern"))) for name, p in TECHNICALS])
    fouls = lines.withColumn("f", told).where("f is not null").withColumn("raw", F.trim("line"))
    nth = F.row_number().over(Window.partitionBy(*keep, "raw").orderBy("at"))
    clock, period = F.regexp_extract("f.time", r"^(\d{1,2}:\d{2})", 1), F.regexp_extract("f.time", r"(\d)$", 1).cast("int")
    kind = F.when(F.lower("f.player").startswith("bench"), "bench").otherwise("player")
    return fouls.withColumn("nth", nth).where("nth = 1").select(*keep, "at", "section", "heading", "f.player", "f.team", period.alias("period"), clock.alias("clock"), kind.alias("kind"), "f.reason", "f.pattern")


def clean_name(name: Column) -> Column:
    """Capitalised words of a plausible name: two words at least, none twice, 3 to 50 characters."""
    t = F.trim(F.regexp_replace(name, r"[^\w\s.]", ""))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    ok = (F.size(words) >= 2) & F.length(t).between(3, 50) & (F.size(F.array_distinct(words)) == F.size(words)) & ~F.lower(t).rlike(NO_NAME)
    return F.when(ok, F.array_join(F.transform(words, F.initcap), " "))


def officials(text: Column) -> Column:
    """array<struct(name, role)> by role, in the order of the roles, each name once; without any, names by the general patterns as OFFICIAL."""
    def found(pattern: str, role: Column | str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda n: F.struct(clean_name(n).alias("name"), (F.lit(role) if isinstance(role, str) else role).alias("role")))

    named = [found(rf"(?i:{word})[:\s]*({NAME})", role) for word, role in ROLES]
    numbered = [found(rf"(?i:official)\s*#?{k}[:\s]*({NAME})", f"OFFICIAL_{k}") for k in (1, 2, 3)]
    # Bound once: what a lambda's variable stands for is worked out one time.
    first = F.array(once(F.concat(*named, *numbered)))
    return F.transform(first, lambda f: F.when(F.size(f) > 0, f).otherwise(once(F.concat(*[found(p, "OFFICIAL") for p in GENERAL]))))[0]


def once(people: Column) -> Column:
    """The first entry of each name."""
    real = F.transform(F.array(people), lambda ps: F.filter(ps, lambda p: p["name"].isNotNull()))
    return F.transform(real, lambda ps: F.filter(ps, lambda p, i: F.array_position(F.transform(ps, lambda q: q["name"]), p["name"]) == i + 1))[0]


def settled(df: DataFrame) -> DataFrame:
    """df behind a Generate of one row, so that long expressions of its columns aren't repeated wherever later columns use them."""
    return df.select(F.inline(F.array(F.struct("*"))))


def parse(books: DataFrame, text: str = "text") -> DataFrame:
    """books with game_id_found, refs, alternates, technical_fouls, arena, teams and parsing_confidence."""
    t = F.col(text)
    refs = officials(t)
    technicals = F.regexp_extract_all(t, F.lit(rf"(?i:technical\s+foul)[:\s-]*({NAME})"), 1)
    out = settled(books.withColumn("refs", refs)).withColumn("game_id_found", found_id(t)["value"])
    out = out.withColumn("alternates", F.transform(alternates(t, F.transform("refs", lambda r: r["name"])), lambda x: x["name"]))
    by_role = F.col("refs")[0]["role"].isNotNull() & ~F.forall("refs", lambda r: r["role"] == "OFFICIAL")
    confidence = F.least(F.lit(1.0), F.size("refs") * F.when(by_role, 0.3).otherwise(0.2))
    return out.withColumn("technical_fouls", F.transform(technicals, clean_name)).withColumn("arena", F.trim(part(t, r"(?i)arena[:\s]+([^\n,]+)", 1))).withColumn("teams", F.struct(part(t, r"(?i)home(?: team)?[:\s]+([^\n]+)", 1).alias("home"), part(t, r"(?i)(?:visitor|away)(?: team)?[:\s]+([^\n]+)", 1).alias("away"))).withColumn("parsing_confidence", confidence)


def text_confidence(text: Column) -> Column:
    """0 to 1 by length, keywords and names."""
    n = F.length(text)
    tier = F.when(n > 1000, 0.4).when(n > 500, 0.3).when(n > 200, 0.2).when(n > 50, 0.1).otherwise(0.0)
    words = reduce(lambda a, b: a + b, [F.contains(F.lower(text), F.lit(k)).cast("int") for k in KEYWORDS])
    return F.least(F.lit(1.0), tier + F.least(F.lit(0.3), words * 0.1) + F.least(F.lit(0.3), F.regexp_count(text, F.lit(r"[A-Z][a-z]+\s+[A-Z][a-z]+")) * 0.02))


def referee_rows(parsed: DataFrame) -> DataFrame:
    """A row for each official: game_id, name, role, position."""
    return parsed.select("game_id", F.posexplode("refs").alias("position", "r")).select("game_id", "r.name", "r.role", (F.col("position") + 1).alias("position"))


def alternate_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select("game_id", F.explode("alternates").alias("name"))


def player_rows(books: DataFrame) -> DataFrame:
    """game_id, team, player, is_total and numbers of player_stats_tables, headers by alias; what is no number is null."""
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    each = books.select("game_id", F.explode("player_stats_tables").alias("t")).select("game_id", "t.team", F.transform("t.headers", lambda h: F.coalesce(F.try_element_at(known, F.upper(F.trim(h))), F.lower(h))).alias("heads"), F.explode("t.rows").alias("row"))
    cell = lambda h: F.when(F.array_contains("heads", h), F.get("row", (F.array_position("heads", h) - 1).cast("int")))
    out = each.select("game_id", "team", F.trim(cell("player")).alias("player"), *[numbers.to_long(cell(s), numbers.NULL_TOKENS + numbers.BOOK_TOKENS).alias(s) for s in ("pts", "reb", "ast", "stl", "blk", "tov", "pf")], cell("min").alias("min"))
    return out.withColumn("is_total", F.coalesce(F.upper("player").rlike("^TOTALS?$"), F.lit(False)))


def quality(parsed: DataFrame, n_players: Column | None = None) -> DataFrame:
    """errors, warnings, quality_score (0 to 1), recommended_action and is_valid of each parsed book. n_players: player rows of the book (default 0)."""
    n, c, players = F.size("refs"), F.col("parsing_confidence"), F.lit(0) if n_players is None else n_players
    has_id = F.coalesce(F.col("game_id"), F.lit("")) != ""
    usual = F.coalesce(F.col("game_id").rlike(r"^00\d{8}$"), F.lit(False))
    errors = F.array_compact(F.array(F.when(~has_id, "Missing game_id"), F.when(n == 0, "No referees found"), F.when(c < 0.2, "Very low parsing confidence")))
    warnings = F.array_compact(F.array(
        F.when(has_id & ~usual, "Unusual game_id format"), F.when(n == 1, "Fewer than 2 referees found"), F.when(n > 5, "More than 5 referees found"),
        F.when(players.between(1, 9), "Fewer than 10 players found"), F.when(players > 30, "More than 30 players found"), F.when((c >= 0.2) & (c < 0.5), "Low parsing confidence"),
    ))
    score = c * 0.4 + F.when(n.between(2, 4), 0.2).when(n >= 1, 0.1).otherwise(0.0) + F.when(players >= 10, 0.2).when(players > 0, 0.1).otherwise(0.0) + F.when(usual, 0.2).otherwise(0.0)
    out = parsed.withColumn("errors", errors).withColumn("warnings", warnings).withColumn("quality_score", F.least(score, F.lit(1.0)))
    valid = has_id & (n > 0) & (F.col("quality_score") >= 0.4)
    return out.withColumn("is_valid", valid).withColumn("recommended_action", F.when(~valid, "reject").when(F.col("quality_score") >= 0.7, "accept").otherwise("accept_with_review"))


def grade(n_refs: Column, n_players: Column, confidence: Column) -> Column:
    """excellent, good, fair, poor or failed."""
    two = n_refs >= 2
    return F.when((confidence >= 0.8) & two & (n_players >= 10), "excellent").when((confidence >= 0.6) & two & (n_players >= 5), "good").when((confidence >= 0.4) & (n_refs >= 1), "fair").when((n_refs >= 1) | (n_players > 0), "poor").otherwise("failed")


def with_fallback_id(parsed: DataFrame) -> DataFrame:
    """game_id, else the one found in the text, else UNKNOWN_ and ten digits of the text's hash; is_error where the text has under 100 characters, id_differs where the text has another id."""
    digits = F.lpad(F.pmod(F.xxhash64("text"), F.lit(10**10)).cast("string"), 10, "0")
    return parsed.withColumn("id_differs", F.coalesce(F.col("game_id") != F.col("game_id_found"), F.lit(False))).withColumn("is_error", F.length(F.coalesce("text", F.lit(""))) < 100).withColumn("game_id", F.coalesce("game_id", "game_id_found", F.concat(F.lit("UNKNOWN_"), digits)))


def first_by_name(people: DataFrame) -> DataFrame:
    """One row for each game and name, the one of the lowest position."""
    w = Window.partitionBy("game_id", "name").orderBy("position")
    return people.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")
