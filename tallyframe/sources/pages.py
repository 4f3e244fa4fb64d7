"""Facts from HTML box-score pages with regular expressions in SQL functions: line score, starters, injury notes; and general page facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import part


def texts(html: Column, pattern: str) -> Column:
    """Group 1 of each match, tags taken out and trimmed."""
    return F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", "")))


def line_score(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with away_q1.. away_q4, away_final, the same for home, and ot_periods, of the table with id line_score; null without one."""
    body = part(F.col(html), r"(?is)<table[^>]*id=\"line_score\"[^>]*>(.*?)</table>", 1)
    lines = F.filter(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1), lambda r: F.contains(F.lower(r), F.lit("<td")))
    out = pages.withColumn("ls_body", body).withColumn("ls_lines", lines)
    for k, side in enumerate(("away", "home")):
        cells = texts(F.get("ls_lines", F.lit(k)), r"(?is)<t[dh][^>]*>(.*?)</t[dh]>")
        out = out.withColumn(f"ls_{side}", F.when(F.size(cells) >= 5, cells))
        for q in range(1, 5):
            out = out.withColumn(f"{side}_q{q}", F.get(f"ls_{side}", F.lit(q)).try_cast("int"))
        out = out.withColumn(f"{side}_final", F.get(f"ls_{side}", F.size(f"ls_{side}") - 1).try_cast("int"))
    return out.withColumn("ot_periods", F.regexp_count(F.col("ls_body"), F.lit(r"(?i)<th[^>]*>[^<]*OT[^<]*</th>"))).drop("ls_body", "ls_lines", "ls_away", "ls_home")


def starters(pages: DataFrame, html: str = "html") -> DataFrame:
    """side, player and position of each starter (marked by * or class starter) of the first two box tables; other columns stay."""
    others = [c for c in pages.columns if c != html]
    tables = F.slice(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<table[^>]*id=\"[^\"]*box-[^\"]*\"[^>]*>(.*?)</table>"), 1), 1, 2)
    each = pages.select(*others, F.posexplode(tables).alias("k", "body"))
    each = each.select(*others, "k", F.posexplode(F.regexp_extract_all("body", F.lit(r"(?is)(<tr[^>]*>.*?</tr>)"), 1)).alias("place", "row"))
    name = F.get(texts(F.col("row"), r"(?is)<th[^>]*data-stat=\"player\"[^>]*>(.*?)</th>"), F.lit(0))
    marked = F.contains(name, F.lit("*")) | F.col("row").rlike(r"(?i)class=\"[^\"]*starter")
    position = F.get(texts(F.col("row"), r"(?is)<td[^>]*data-stat=\"pos\"[^>]*>(.*?)</td>"), F.lit(0))
    return each.where(name.isNotNull() & marked).select(*others, F.when(F.col("k") == 0, "away").otherwise("home").alias("side"), "place", F.trim(F.replace(name, F.lit("*"), F.lit(""))).alias("player"), position.alias("position"))


#: Fixed value: 'First Last (reason) - status'.
INJURY = r"(?i)([A-Z][a-z]+\s+[A-Z][a-z]+)[^()]*?\(([^)]+)\)[^-]*?-\s*(\w+)"


def injury_notes(pages: DataFrame, html: str = "html") -> DataFrame:
    """player, reason and status of each note that speaks of inactive, out, questionable or probable players."""
    others = [c for c in pages.columns if c != html]
    notes = F.filter(texts(F.col(html), r"(?is)<(?:div|p)[^>]*>([^<]*)</(?:div|p)>"), lambda t: t.rlike("(?i)(inactive|out|questionable|probable)"))
    each = pages.select(*others, F.explode(notes).alias("note")).select(*others, F.explode(F.regexp_extract_all("note", F.lit(f"({INJURY})"), 1)).alias("m"))
    return each.select(*others, F.trim(F.regexp_extract("m", INJURY, 1)).alias("player"), F.trim(F.regexp_extract("m", INJURY, 2)).alias("reason"), F.upper(F.regexp_extract("m", INJURY, 3)).alias("status"))


def page_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """title, number of links and of table rows, and characters without tags."""
    h = F.col(html)
    return pages.withColumn("title", F.trim(part(h, r"(?is)<title[^>]*>(.*?)</title>", 1))).withColumn("n_links", F.regexp_count(h, F.lit(r"(?i)<a\s"))).withColumn("n_rows", F.regexp_count(h, F.lit(r"(?i)<tr[\s>]"))).withColumn("n_text", F.length(F.regexp_replace(h, "<[^>]*>", "")))


def game_metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    """attendance and arena of a page."""
    bare = F.regexp_replace(F.col(html), "<[^>]*>", " ")
    return pages.withColumn("attendance", F.replace(part(bare, r"(?i)attendance:?\s*([\d,]+)", 1), F.lit(","), F.lit("")).try_cast("int")).withColumn("arena", F.trim(part(bare, r"(?i)arena:\s*([^\n<]+?)(?:\s{2,}|\n|$)", 1)))
