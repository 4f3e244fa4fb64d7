"""Season and calendar expressions. What depends on today takes as_of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import part

SEASON = r"^\d{4}-\d{2}$"
#: Hours from UTC by zone, without daylight saving; other zones count as 0.
STANDARD_OFFSETS = {"America/Los_Angeles": -8, "America/Denver": -7, "America/Phoenix": -7, "America/Chicago": -6, "America/Detroit": -5, "America/New_York": -5, "America/Toronto": -5}


def season_name(start_year: Column) -> Column:
    return F.concat(start_year.cast("string"), F.lit("-"), F.lpad(((start_year + 1) % 100).cast("string"), 2, "0"))


def season_from_date(day: Column, pivot_month: int = 10) -> Column:
    return season_name(F.year(day) - (F.month(day) < pivot_month).cast("int"))


def season_from_game_id(game_id: Column) -> Column:
    """20YY-YY of a ten-digit id 00tYYnnnnn."""
    return season_name(2000 + part(game_id, r"^00[1-9](\d{2})\d{5}$", 1).cast("int"))


def season_from_game_id_lenient(game_id: Column) -> Column:
    """The same from characters 4 and 5 of any id of five characters or more."""
    return F.when(F.length(game_id) >= 5, season_name(2000 + F.substring(game_id, 4, 2).try_cast("int")))


def valid_season(season: Column) -> Column:
    return F.coalesce(season.rlike(SEASON), F.lit(False))


def coalesce_season(*seasons: Column) -> Column:
    return F.coalesce(*[F.when(valid_season(s), s) for s in seasons])


def season_or_unknown(game_id: Column, day: Column, fallback: Column) -> Column:
    return F.coalesce(season_from_game_id(game_id), season_from_date(day), coalesce_season(fallback), F.lit("UNKNOWN"))


def season_in_range(season: Column, as_of: Column) -> Column:
    """Valid, and its start year is from 1946 to ten years from as_of."""
    return valid_season(season) & F.substring(season, 1, 4).try_cast("int").between(1946, F.year(as_of) + 10)


def season_bounds(season: Column, last_month: int = 9, last_day: int = 30) -> Column:
    """struct(start, end): October 1 to September 30, or to another last day."""
    year = F.when(valid_season(season), F.substring(season, 1, 4).cast("int"))
    return F.struct(F.make_date(year, F.lit(10), F.lit(1)).alias("start"), F.make_date(year + 1, F.lit(last_month), F.lit(last_day)).alias("end"))


def in_season(day: Column, season: Column) -> Column:
    """Whether day is from August 1 of the season's first year to July 31 of its second: a flag for checks, not a filter."""
    year = F.when(valid_season(season), F.substring(season, 1, 4).cast("int"))
    return day.between(F.make_date(year, F.lit(8), F.lit(1)), F.make_date(year + 1, F.lit(7), F.lit(31)))


def expand_season(text: Column) -> Column:
    """2023 becomes 2023-24; the rest stays."""
    return F.when(text.rlike(r"^\d{4}$"), season_name(text.try_cast("int"))).otherwise(text)


def parse_date(text: Column) -> Column:
    """The first of yyyy-MM-dd, MM/dd/yyyy, MM/dd/yy and yyyy-MM-dd HH:mm:ss that fits."""
    t = F.trim(text)

    def as_(fmt: str, shape: str) -> Column:
        return F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(fmt))).cast("date")

    return F.coalesce(as_("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"), as_("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$"), as_("MM/dd/yy", r"^\d{2}/\d{2}/\d{2}$"), as_("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"))


def local_date(utc: Column, zone: Column | None = None) -> Column:
    """Calendar date at the arena; New York where the zone is unknown."""
    zone = F.lit("America/New_York") if zone is None else F.coalesce(zone, F.lit("America/New_York"))
    return F.to_date(F.from_utc_timestamp(utc.cast("timestamp"), zone))


def date_with_source(local: Column, utc: Column, zone: Column) -> Column:
    """struct(day, source): the local date, else that of utc in its zone, else that of utc."""
    of_utc = F.to_date(utc)
    return F.struct(F.coalesce(local, F.when(zone.isNotNull(), local_date(utc, zone)), of_utc).alias("day"), F.when(local.isNotNull() | (zone.isNotNull() & utc.isNotNull()), F.lit("local")).when(utc.isNotNull(), F.lit("utc")).alias("source"))


def resolve_game_date(calendar: Column, iso: Column, zone: Column) -> Column:
    """The calendar date before any T wins; else the local date of the ISO time, which counts as UTC."""
    return F.coalesce(parse_date(F.split_part(calendar, F.lit("T"), F.lit(1))), local_date(F.try_to_timestamp(iso), zone))


def bridged_date(local: Column, utc: Column, arena_zone: Column, team_zone: Column) -> Column:
    """struct(day, used): the local date, else that of utc in the arena's zone, the team's zone, or New York; null without both, never today."""
    derived = local_date(utc, F.coalesce(arena_zone, team_zone))
    return F.struct(F.coalesce(local, derived).alias("day"), F.when(local.isNotNull(), "local").when(derived.isNotNull(), "derived").alias("used"))


def valid_date_text(text: Column) -> Column:
    """yyyy-MM-dd of a day that there is."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def date_gap(local: Column, derived: Column) -> Column:
    """ok, warn (a day apart) or error (more)."""
    days = F.abs(F.datediff(local, derived))
    return F.when(days > 1, F.lit("error")).when(days == 1, F.lit("warn")).otherwise(F.lit("ok"))


def date_in_id(text: Column) -> Column:
    """yyyyMMdd at the start or yyyy-MM-dd anywhere."""
    return F.coalesce(F.try_to_timestamp(part(text, r"^(\d{8})", 1), F.lit("yyyyMMdd")).cast("date"), F.try_to_timestamp(part(text, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date"))


def odds_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def yesterday_eastern(as_of: Column) -> Column:
    return F.date_sub(local_date(as_of), 1)


def standard_offset(zone: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in STANDARD_OFFSETS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, zone), F.lit(0)).cast("double")


def timezone_shift(from_zone: Column, to_zone: Column) -> Column:
    """Hours; above 0 is eastward."""
    return standard_offset(to_zone) - standard_offset(from_zone)
