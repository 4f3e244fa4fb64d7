"""Names and ids across sources: fuzzy names, aliases, ids of other sites with a window of days."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import text
from ..sinks.places import work_folder


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 LCS / (m + n) of two strings, the longest common subsequence in bits, all pairs of a batch together; SQL functions have no such distance.

    A column of at most 63 letters a side fits 64 bits; pairs with a longer string take Python's integers one by one.
    """
    out = np.full(len(a), np.nan)
    x, y = a.to_numpy(object), b.to_numpy(object)
    here = np.array([p is not None and q is not None for p, q in zip(x, y, strict=True)], bool)
    m, n = (np.array([len(s) if ok else 0 for s, ok in zip(z, here, strict=True)], np.int64) for z in (x, y))
    short = here & (m < 64) & (n < 64)
    for i in np.flatnonzero(here & ~short).tolist():
        out[i] = _ratio(x[i], y[i])
    i = np.flatnonzero(short)
    if len(i):
        width = max(1, int(max(m[i].max(), n[i].max())))
        left, right = (np.array(z[i].tolist(), f"U{width}").view(np.uint32).reshape(len(i), width) for z in (x, y))
        power = np.uint64(1) << np.arange(width, dtype=np.uint64)
        full = (np.uint64(1) << m[i].astype(np.uint64)) - np.uint64(1)
        row, inside = full.copy(), np.arange(width) < m[i][:, None]
        for k in range(int(n[i].max())):
            hit = row & (((left == right[:, k : k + 1]) & inside) * power).sum(1, dtype=np.uint64)
            row = np.where(k < n[i], (row + hit | row - hit) & full, row)
        common = m[i] - np.bitwise_count(row)
        out[i] = np.where(m[i] + n[i] > 0, 200.0 * common / np.maximum(m[i] + n[i], 1), 100.0)
    return pd.Series(np.where(np.isnan(out), None, out)).astype("Float64") if not here.all() else pd.Series(out)


def _ratio(x: str, y: str) -> float:
    at: dict[str, int] = {}
    for i, ch in enumerate(x):
        at[ch] = at.get(ch, 0) | 1 << i
    row = full = (1 << len(x)) - 1
    for ch in y:
        hit = row & at.get(ch, 0)
        row = (row + hit | row - hit) & full
    return 200.0 * (len(x) - row.bit_count()) / (len(x) + len(y))


#: Scores that names are looked for with first: the higher the score, the fewer letters may be cut, or the fewer grams two names must be compared for.
STAGES = (97.0, 93.0, 89.0)
#: As how many strings a name may be filed for a length of the other and a number of common letters; names that need more meet by grams.
MOST_CUTS = 500


def least_common(la: Column, lb: Column, least: float) -> Column:
    """How many letters two names of la and lb letters must have in common for a score of least; a score that rounding puts just below counts, callers look at the score."""
    return F.ceil(F.lit(least) * (la + lb) / 200.0 - 1e-9).cast("int")


def few_cuts(la: Column, lb: Column, least: float) -> Column:
    """Whether names of these lengths are found by cutting letters: 3 at most on a side, in at most MOST_CUTS ways."""
    def ways(n: Column) -> Column:
        k = n - least_common(la, lb, least)
        return F.when(k <= 0, 1.0).when(k == 1, n * 1.0).when(k == 2, n * (n - 1) / 2.0).when(k == 3, n * (n - 1) * (n - 2) / 6.0)

    return F.coalesce((ways(la) <= MOST_CUTS) & (ways(lb) <= MOST_CUTS), F.lit(False))


def length_pairs(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(la, lb, few): the lengths of a and b (n) that a score of least is possible between."""
    met = a.select(F.col("n").alias("la")).distinct().crossJoin(b.select(F.col("n").alias("lb")).distinct())
    la, lb = F.col("la"), F.col("lb")
    return met.where(least_common(la, lb, least) <= F.least(la, lb)).select("la", "lb", few_cuts(la, lb, least).alias("few"))


def cut(s: Column, n: Column, k: int, start: Column | None = None) -> Column:
    """What is left of s, of n letters, without any k of those from place start on; repeats included."""
    if k == 0:
        return F.array(s)
    one = lambda p: F.concat(F.substr(s, F.lit(1), p - 1), F.substr(s, p + 1))
    places = F.sequence(F.lit(1) if start is None else start, n - k + 1)
    return F.transform(places, one) if k == 1 else F.flatten(F.transform(places, lambda p: cut(one(p), n - 1, k - 1, p)))


def best_by_cuts(a: DataFrame, b: DataFrame, lengths: DataFrame, least: float) -> DataFrame:
    """(name, known, score) of a (name, low, n) and b (known, low, n) at lengths (la, lb): for each name its best known one, of equals the first, or some of its others too.

    Two names have c letters in common, in order, just when both leave the same c letters after some are cut. So names are filed under all that
    they may leave, of known names only the first is kept under each, and no pairs are compared: the rows grow with the names.
    """
    la, lb = F.col("la"), F.col("lb")

    def filed(d: DataFrame, c: str, mine: str) -> DataFrame:
        each = d.select(c, "low", F.col("n").alias(mine)).join(F.broadcast(lengths.select("la", "lb")), mine)
        each = each.withColumn("common", F.explode(F.sequence(least_common(la, lb, least), F.least(la, lb))))
        k, n = F.col(mine) - F.col("common"), F.col(mine)
        left = F.when(k == 0, cut(F.col("low"), n, 0)).when(k == 1, cut(F.col("low"), n, 1)).when(k == 2, cut(F.col("low"), n, 2)).when(k == 3, cut(F.col("low"), n, 3))
        return each.select(c, "la", "lb", F.explode(F.array_distinct(left)).alias("left"))

    first = filed(b, "known", "lb").groupBy("left", "la", "lb").agg(F.min("known").alias("known"))
    score = F.when(la + lb > 0, F.lit(200.0) * F.length("left") / (la + lb)).otherwise(100.0)
    return filed(a, "name", "la").join(first, ["left", "la", "lb"]).select("name", "known", score.alias("score")).where(F.col("score") >= least)


def ordered_grams(names: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, low, grams) and (known, low, grams): each different name in lower case, and its different character pairs, those that fewest names have first."""
    def keyed(d: DataFrame, c: str) -> DataFrame:
        low = F.lower(c)
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))), lambda i: F.substr(low, i, F.lit(2)))
        return d.select(c).where(F.col(c).isNotNull()).distinct().select(c, low.alias("low"), F.array_distinct(F.when(F.length(low) < 2, F.array(low)).otherwise(pairs)).alias("g"))

    a, b = keyed(names, "name"), keyed(known, "known")
    seen = a.select(F.explode("g").alias("gram")).unionAll(b.select(F.explode("g").alias("gram"))).groupBy("gram").agg(F.count("*").alias("n"))
    def ranked(d: DataFrame, c: str) -> DataFrame:
        each = d.select(c, "low", F.explode("g").alias("gram")).join(seen, "gram").groupBy(c, "low").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("r"))
        return each.select(c, "low", F.transform("r", lambda x: x["gram"]).alias("grams"))
    return ranked(a, "name"), ranked(b, "known")


def least_shared(grams: Column, own: Column, other: Column, least: float) -> Column:
    """How many of a name's grams a name of length other must share with it for a score of least: each letter without a partner breaks two of the name's
    own pairs, or one where the other name has it in between; and two letters that stand together in both are never all broken."""
    common = least_common(own, other, least)
    return F.greatest(F.lit(1), grams - (2 * own + other - 3 * common)).cast("int")


def candidates(a: DataFrame, b: DataFrame, least: float, long_only: bool = False) -> DataFrame:
    """Pairs (name, known, low, known_low) of ordered_grams() that may have a score of least: those that share enough grams for their lengths.

    For each length that the other may have, a name is filed under its rarest grams only: of enough shared grams the rarest
    is among them on either side. So two names meet by rare grams, and grams that all names have bring none together.
    Names of few letters share even their rare grams with a part of all the others, so that pairs grow with the square; long_only leaves them to best_by_cuts().
    """
    def filed(d: DataFrame, c: str, mine: str, theirs: str) -> DataFrame:
        n = F.length("low")
        lengths = F.sequence(F.ceil(n * F.lit(least) / (200.0 - least)).cast("int"), F.floor(n * (200.0 - least) / F.lit(least)).cast("int"))
        each = d.select(c, F.col("low").alias(f"{c}_low"), F.col("grams").alias(f"{c}_grams"), n.alias(mine), F.explode(lengths).alias(theirs))
        each = each.where(~few_cuts(F.col("la"), F.col("lb"), least)) if long_only else each
        first = F.slice(f"{c}_grams", F.lit(1), F.greatest(F.lit(1), F.size(f"{c}_grams") - least_shared(F.size(f"{c}_grams"), F.col(mine), F.col(theirs), least) + 1))
        return each.withColumn("gram", F.explode(first))

    left, right = filed(a, "name", "la", "lb"), filed(b, "known", "lb", "la")
    met = left.join(right, ["gram", "la", "lb"])
    shared = F.size(F.array_intersect("name_grams", "known_grams"))
    enough = (shared >= least_shared(F.size("name_grams"), F.col("la"), F.col("lb"), least)) & (shared >= least_shared(F.size("known_grams"), F.col("lb"), F.col("la"), least))
    # Letters that the other name lacks have no partner either.
    held = lambda x, y: F.expr(f"length({x}) - length(translate({x}, {y}, ''))")
    enough &= F.least(held("name_low", "known_low"), held("known_low", "name_low")) >= least_common(F.col("la"), F.col("lb"), least)
    return met.where(enough).select("name", "known", F.col("name_low").alias("low"), "known_low").distinct()


def fuzzy_match(names: DataFrame, known: DataFrame, least: float = 85.0) -> DataFrame:
    """(name, match, score): the best known name, case ignored, of score least or more; of equals the first in order.

    High scores are looked for first (STAGES); names that have found one are done, since all names of such a score were found.
    Lengths at which few letters may be cut are met by what is left (best_by_cuts), the others by grams (candidates).
    Each stage is written below the session's checkpoint folder.
    """
    spark, root = names.sparkSession, work_folder(names.sparkSession, "fuzzy")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    def keyed(d: DataFrame, c: str) -> DataFrame:
        return d.select(c).where(F.col(c).isNotNull()).distinct().select(c, F.lower(c).alias("low"), F.length(F.lower(c)).alias("n"))

    a, b, found = kept(keyed(names, "name"), "names"), kept(keyed(known, "known"), "known"), []
    for k, stage in enumerate([s for s in STAGES if s > least] + [least]):
        lengths = kept(length_pairs(a, b, stage), f"lengths-{k}")
        few, many = lengths.where("few"), lengths.where("not few")
        scored = best_by_cuts(a, b, few, stage)
        if not many.isEmpty():
            long_a, long_b = (d.join(many.select(F.col(c).alias("n")).distinct(), "n", "left_semi") for d, c in ((a, "la"), (b, "lb")))
            long_a, long_b = (kept(d, f"{n}-{k}") for d, n in zip(ordered_grams(long_a, long_b), ("long-names", "long-known"), strict=True))
            pairs = candidates(long_a, long_b, stage, long_only=True).withColumn("score", ratio("low", "known_low")).where(F.col("score") >= stage)
            scored = scored.unionByName(pairs.select("name", "known", "score"))
        best = scored.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("s"), "known")).alias("m"))
        hits = kept(best.select("name", F.col("m.known").alias("match"), (-F.col("m.s")).alias("score")), f"stage-{k}")
        found.append(hits)
        a = a.join(hits.select("name"), "name", "left_anti")
        if a.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def resolve_aliases(rows: DataFrame, column: str, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with canonical from aliases (alias, canonical), a small dimension; and those that resolve to nothing."""
    known = aliases.select(F.upper("alias").alias("a_key"), "canonical").dropDuplicates(["a_key"])
    met = rows.join(known, F.upper(F.trim(F.col(column))) == F.col("a_key"), "left").drop("a_key")
    return met.where("canonical is not null"), met.where("canonical is null")


def id_rows(mapping: DataFrame, ids: list[str], source: str = "mapping") -> DataFrame:
    """game_id, page_id, the other sources' ids (null where a column of ids isn't there) and source, from a table of ids, or from column url of box-score pages:
    the page's id is the one in the url, else the url as it is."""
    page = F.coalesce(F.nullif(text.box_page_id_of_url(F.col("url")), F.lit("")), F.col("url")) if "page_id" not in mapping.columns else F.col("page_id")
    return mapping.select("game_id", page.alias("page_id"), *[F.col(c) if c in mapping.columns else F.lit(None).cast("string").alias(c) for c in ids], F.lit(source).alias("source"))


def id_candidates(games: DataFrame, days: int = 7) -> DataFrame:
    """games (game_id, game_date_local, home_team_tricode) with a candidate page id for each day within days, and the offset."""
    around = games.withColumn("offset", F.explode(F.sequence(F.lit(-days), F.lit(days))))
    return around.withColumn("page_id", text.box_page_id(F.date_add("game_date_local", F.col("offset")), F.col("home_team_tricode")))


def crosswalk(games: DataFrame, pages: DataFrame, days: int = 7) -> DataFrame:
    """(game_id, page_id, confidence): 1.0 for the page of the day itself, 0.8 for the nearest other, 0.0 with UNRESOLVED_<id>; a game_id occurs once. pages: (page_id).

    Spans of 2 * days + 1 days: what a game may meet lies in its own span or a neighbour, two in all, whose pages of its team it is joined with.
    """
    span = 2 * days + 1
    number = lambda day: F.datediff(day, F.lit("1900-01-01").cast("date"))
    place = r"^(\d{8})0(.+)$"
    p = pages.select("page_id").distinct().select("page_id", number(F.try_to_date(F.regexp_extract("page_id", place, 1), "yyyyMMdd")).alias("p_day"), F.regexp_extract("page_id", place, 2).alias("team")).where("p_day is not null")
    p = p.withColumn("span", F.floor(F.col("p_day") / span))
    g = games.select("game_id", number("game_date_local").alias("g_day"), F.upper("home_team_tricode").alias("team"))
    near = F.array_distinct(F.array(F.floor((F.col("g_day") - days) / span), F.floor((F.col("g_day") + days) / span)))
    offset = F.col("p_day") - F.col("g_day")
    met = g.select("*", F.explode_outer(near).alias("span")).join(p, ["team", "span"], "left")
    nearest = F.min(F.when(F.abs(offset) <= days, F.struct(F.abs(offset).alias("gap"), offset.alias("offset"), "page_id"))).alias("near")
    out = met.groupBy("game_id").agg(nearest)
    confidence: Column = F.when(F.col("near.offset") == 0, 1.0).when(F.col("near").isNotNull(), 0.8).otherwise(0.0)
    return out.select("game_id", F.coalesce("near.page_id", F.concat(F.lit("UNRESOLVED_"), F.col("game_id"))).alias("page_id"), confidence.alias("confidence"))
