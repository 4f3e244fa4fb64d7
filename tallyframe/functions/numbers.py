"""Coercions and rates: null for what can't be read, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import part

#: Tokens that stand for a missing value, and those of game-book tables besides.
NULL_TOKENS = ["", "-", "—", "N/A", "NA", "null", "NULL", "None", "NONE", "--"]
BOOK_TOKENS = ["DNP*", "DNP", "DND"]
TRUE_WORDS, FALSE_WORDS = ["true", "1", "yes", "y", "on", "enabled"], ["false", "0", "no", "n", "off", "disabled"]
EARTH_KM = 6371.0


def text_or_null(x: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    t = F.trim(x.cast("string"))
    return F.when(~t.isin(tokens), t)


def to_double(x: Column, drop: str = "[,%]", tokens: list[str] = NULL_TOKENS) -> Column:
    v = F.trim(F.regexp_replace(text_or_null(x, tokens), drop, "")).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def to_long(x: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Cut towards zero."""
    return to_double(x, ",", tokens).try_cast("long")


def to_bool(x: Column) -> Column:
    t = F.lower(text_or_null(x))
    return F.when(t.isin(TRUE_WORDS), True).when(t.isin(FALSE_WORDS), False)


def money_or_percent(x: Column) -> Column:
    return to_double(x, "[,$%]")


def id_or_null(x: Column) -> Column:
    return F.nullif(F.nullif(x.cast("string"), F.lit("")), F.lit("null")).try_cast("long")


def first_number(x: Column) -> Column:
    return part(F.trim(x), r"(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def divide(a: Column, b: Column) -> Column:
    """a / b as double, null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percentage(a: Column, b: Column) -> Column:
    return divide(a, b) * 100


def effective_fg(made: Column, threes: Column, attempts: Column) -> Column:
    return divide(made + 0.5 * threes, attempts)


def rebound_share(own: Column, other: Column) -> Column:
    return divide(own, own + other)


def estimated_possessions(fga: Column, fta: Column, oreb: Column, tov: Column) -> Column:
    return F.greatest(F.lit(1), fga + F.floor(0.44 * fta) - oreb + tov).cast("long")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def shot_distance_ft(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y) / 10


def shot_zone(feet: Column) -> Column:
    return F.when(feet <= 4, "RIM").when(feet <= 10, "SHORT_MID").when(feet <= 23, "LONG_MID").when(feet.isNotNull(), "THREE")


def circadian_index(shift_hours: Column, km: Column, climb_m: Column, days_rest: Column, hour_utc: Column) -> Column:
    """0 (none) to 1: time shift, distance, rest, late games after eastward travel and altitude."""
    east = shift_hours > 0
    shift = F.least(F.abs(shift_hours) / 3, F.lit(1.0)) * F.when(east, 1.5).otherwise(1.0)
    base = shift + F.when(km > 1000, F.least(km / 5000, F.lit(0.3))).otherwise(0.0)
    base = base * F.when(days_rest == 0, 1.5).when(days_rest == 1, 1.0).when(days_rest >= 3, 0.5).otherwise(0.8)
    base = base * F.when(east & (hour_utc >= 22), 1.2).otherwise(1.0)
    base = base + F.when(climb_m > 1000, F.least(climb_m / 2000, F.lit(0.2))).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(base, F.lit(1.0)))


def game_quality_score(events: Column, shots: Column, coordinate_pct: Column, n_flags: Column) -> Column:
    """0 to 100: ten off for each flag, times the coordinates' share, less for few events or shots."""
    score = (100.0 - 10.0 * n_flags) * coordinate_pct / 100.0
    score = score * F.when(events < 200, 0.8).otherwise(1.0) * F.when(shots < 50, 0.9).otherwise(1.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))
