"""Name, description and identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import part


def name_slug(name: Column, style: str = "pascal") -> Column:
    """pascal: words capitalised and joined, punctuation dropped; lower: lower case without white space."""
    if style == "lower":
        return F.regexp_replace(F.lower(name), r"\s+", "")
    words = F.filter(F.split(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[^\w\s]", ""), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")


def clean_player_name(name: Column) -> Column:
    """Without generation suffixes and doubled spaces; null unless a Latin letter is left."""
    t = F.trim(F.regexp_replace(F.regexp_replace(name, r"(?i)\b(Jr\.?|Sr\.?|III?|IV)\b", ""), r"\s+", " "))
    return F.when(t.rlike("[a-zA-Z]"), t)


def normalize_description(text: Column) -> Column:
    t = F.regexp_replace(F.nullif(F.trim(text), F.lit("")), r"\s+", " ")
    return F.regexp_replace(t, r"([.!?]){2,}", "$1")


def clean_text(text: Column) -> Column:
    """Printable ASCII, white space squeezed but for single line ends."""
    t = F.regexp_replace(F.regexp_replace(text, r"[^\x20-\x7E\n]", " "), r" *\n\s*", "\n")
    return F.trim(F.regexp_replace(t, " +", " "))


def error_fingerprint(message: Column) -> Column:
    """Lower case with ids, dates, URLs and addresses as tokens, cut after 100 characters."""
    t = F.lower(message)
    for pattern, token in ((r"\b00\d{8}\b", "[GAME_ID]"), (r"\d{4}-\d{2}-\d{2}", "[DATE]"), (r"https?://[^\s]+", "[URL]"), (r"\b\d+\.\d+\.\d+\.\d+\b", "[IP]")):
        t = F.regexp_replace(t, pattern, token)
    return F.trim(F.when(F.length(t) > 100, F.concat(F.substring(t, 1, 100), F.lit("..."))).otherwise(t))


def sql_fingerprint(sql: Column) -> Column:
    """struct(hash, normalized): comments, literals, numbers and IN lists taken out."""
    t = F.regexp_replace(sql, r"(?m)--.*$", "")
    t = F.regexp_replace(t, "'[^']*'", "'?'")
    t = F.regexp_replace(t, r"\b\d+\b", "?")
    t = F.regexp_replace(t, r"(?i)IN\s*\([^)]+\)", "IN (?)")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.struct(F.substring(F.md5(t), 1, 16).alias("hash"), t.alias("normalized"))


def split_score(score: Column) -> Column:
    """struct(home, away) of '27 - 46'."""
    return F.struct(F.split_part(score, F.lit(" - "), F.lit(1)).try_cast("int").alias("home"), F.split_part(score, F.lit(" - "), F.lit(2)).try_cast("int").alias("away"))


def split_matchup(text: Column) -> Column:
    """struct(home, away): 'A @ B' is played at B, 'A vs. B' and 'A v B' at A; names of any length, cut at the first of these in that order."""
    cut = [(F.instr(text, mark), len(mark), mark == " @ ") for mark in (" @ ", " vs. ", " v ")]
    left = F.coalesce(*[F.when(at > 0, F.trim(F.substr(text, F.lit(1), at - 1))) for at, _, _ in cut])
    right = F.coalesce(*[F.when(at > 0, F.trim(F.substr(text, at + n))) for at, n, _ in cut])
    away_first = F.coalesce(F.instr(text, " @ ") > 0, F.lit(False))
    return F.struct(F.when(away_first, right).otherwise(left).alias("home"), F.when(away_first, left).otherwise(right).alias("away"))


def shot_value(event_type: Column, description: Column) -> Column:
    shot = event_type.isin("SHOT_MADE", "SHOT_MISSED")
    return F.when(shot & F.coalesce(description, F.lit("")).contains("3PT"), 3).when(shot, 2).when(event_type.isin("FREE_THROW_MADE", "FREE_THROW_MISSED"), 1)


def flagrant_label(description: Column) -> Column:
    d = F.lower(F.coalesce(description, F.lit("")))
    return F.when(d.contains("flagrant 2"), "Flagrant 2").when(d.contains("flagrant 1"), "Flagrant 1").when(d.contains("flagrant"), "Flagrant").otherwise("Flagrant foul")


def pair_key(a: Column, b: Column) -> Column:
    """The same for both orders; UNK for null."""
    a, b = F.coalesce(a, F.lit("UNK")), F.coalesce(b, F.lit("UNK"))
    return F.concat(F.least(a, b), F.lit("_"), F.greatest(a, b))


def box_page_id(day: Column, home: Column) -> Column:
    """yyyyMMdd0TRI, the id of a box-score page."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("0"), F.upper(home))


def box_page_id_of_url(url: Column) -> Column:
    return part(url, r"/boxscores/(\w+)\.html", 1)


def valid_game_id(game_id: Column, strict: bool = True) -> Column:
    return F.coalesce(game_id.rlike(r"^0022\d{6}$" if strict else r"^\d{10}$"), F.lit(False))


def lineup_hash(ids: Column) -> Column:
    """MD5 of the ids in their order."""
    return F.md5(F.array_join(ids, ","))


def tricode(text: Column, aliases: dict[str, str]) -> Column:
    """Three upper-case letters, aliases mapped."""
    t = F.upper(F.trim(text))
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.when(t.rlike("^[A-Z]{3}$"), F.coalesce(F.try_element_at(known, t), t))
