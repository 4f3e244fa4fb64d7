"""Clock and period expressions: pure Column functions, null for what can't be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The two clock formats.
COLON = r"^(\d{1,2}):(\d{2})(?:\.(\d{1,3}))?$"
DURATION = r"^PT(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$"
REGULATION_MS, OVERTIME_MS = 720_000, 300_000


def part(text: Column, pattern: str, group: int) -> Column:
    """A regex group, null where it doesn't match or is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def period_length_ms(period: Column) -> Column:
    return F.when(period.between(1, 4), F.lit(REGULATION_MS)).otherwise(F.lit(OVERTIME_MS)).cast("long")


def parse_clock_ms(text: Column, period: Column) -> Column:
    """Milliseconds left in the period, from M:SS, M:SS.fff or PT#M#S; null unless seconds are below 60 and the period's length holds it."""
    rest = F.substring_index(text, ":", -1)
    seconds = F.substring(rest, 1, 2).try_cast("long")
    plain = (F.substring_index(text, ":", 1).try_cast("long") * 60 + seconds) * 1000 + F.rpad(F.substr(rest, F.lit(4)), 3, "0").try_cast("long")
    body = F.substr(text, F.lit(3))
    iso_minutes = F.when(F.contains(body, F.lit("M")), F.substring_index(body, "M", 1).try_cast("long")).otherwise(F.lit(0))
    iso_seconds = F.coalesce(F.rtrim(F.substring_index(body, "M", -1), F.lit("S")).try_cast("double"), F.lit(0.0))
    # The formats are checked once each; the parts are cut out without a regex, since a filter may repeat this expression.
    found = F.when(text.rlike(COLON), F.when(seconds < 60, plain)).when(text.rlike(DURATION), F.when(iso_seconds < 60, F.round((iso_minutes * 60 + iso_seconds) * 1000).cast("long")))
    return F.when(found <= period_length_ms(period), found)


def parse_game_clock(text: Column) -> Column:
    """Seconds, from PT#M#S (a prefix is enough), m:ss(.f) with seconds below 60, or a bare number of at least 0."""
    t = F.trim(text)
    iso = F.coalesce(part(t, r"^PT(\d+)M", 1).try_cast("double"), F.lit(0.0)) * 60 + F.coalesce(part(t, r"^PT(?:\d+M)?(\d+(?:\.\d+)?)S", 1).try_cast("double"), F.lit(0.0))
    minutes, seconds = part(t, r"^(\d+):(\d+(?:\.\d+)?)", 1).try_cast("double"), part(t, r"^(\d+):(\d+(?:\.\d+)?)", 2).try_cast("double")
    bare = t.try_cast("double")
    return F.when(t.startswith("PT"), iso).when(minutes.isNotNull(), F.when(seconds < 60, minutes * 60 + seconds)).when(bare >= 0, bare)


def tenths(x: Column) -> Column:
    """x >= 0 to one place as a long of tenths: the nearest of its exact binary value, ties to even, as C and Python print it."""
    # 2 ** 58 units hold a fraction's bits; ten times that fits a long.
    units = ((x - F.floor(x)) * float(1 << 58)).cast("long") * 10
    down, rest = F.shiftright(units, 58), units.bitwiseAND(F.lit((1 << 58) - 1))
    up = (rest > 1 << 57) | ((rest == 1 << 57) & (down % 2 == 1))
    return F.floor(x) * 10 + down + up.cast("long")


def normalize_clock(text: Column) -> Column:
    """m:ss, or m:ss.f where there is a fraction; hundredths are rounded by tenths()."""
    s = parse_game_clock(text)
    minutes = F.floor(s / 60)
    left = s - minutes * 60
    t = tenths(left)
    return F.when(s.isNull(), None).when(left == F.floor(left), F.format_string("%d:%02d", minutes, left.cast("long"))).otherwise(F.format_string("%d:%02d.%d", minutes, F.floor(t / 10), t % 10))


def split_clock(text: Column) -> Column:
    """struct(minutes int, seconds double) of m:ss(.f); null unless seconds are below 60."""
    t = F.trim(text)
    minutes, seconds = part(t, r"^(\d+):(\d+(?:\.\d+)?)", 1).try_cast("int"), part(t, r"^(\d+):(\d+(?:\.\d+)?)", 2).try_cast("double")
    return F.when(seconds < 60, F.struct(minutes.alias("minutes"), seconds.alias("seconds")))


def seconds_elapsed_in_period(ms: Column, period: Column) -> Column:
    return (period_length_ms(period) - ms) / F.lit(1000.0)


def seconds_elapsed_in_game(period: Column, remaining: Column) -> Column:
    """Seconds since the game began; regulation periods of 720 s, then overtimes of 300 s."""
    return F.when(period <= 4, (period - 1) * 720 + 720 - remaining).otherwise(2880 + (period - 5) * 300 + 300 - remaining).cast("double")


def clock_in_bounds(period: Column, remaining: Column) -> Column:
    return F.coalesce((period >= 1) & remaining.between(0, period_length_ms(period) / 1000), F.lit(False))


def in_clock_window(ms: Column, low: Column | int, high: Column | int) -> Column:
    """Whether ms is in [low, high] without the second above low: low itself counts, (low, low + 1000) does not."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return (ms <= high) & ((ms == low) | (ms >= low + 1000))


def valid_period_event(period: Column, ms: Column) -> Column:
    return F.coalesce(period.between(1, 10) & ms.between(0, period_length_ms(period)), F.lit(False))


def in_first_minutes(period: Column, ms: Column, minutes: int = 4) -> Column:
    length = period_length_ms(period)
    return in_clock_window(ms, length - minutes * 60_000, length)


def clock_text(elapsed: Column) -> Column:
    """00:MM:SS left of a regulation period."""
    left = F.greatest(F.lit(0.0), F.lit(720.0) - elapsed)
    return F.when(elapsed.isNull(), "00:00:00").otherwise(F.format_string("00:%02d:%02d", F.floor(left / 60), F.floor(left % 60)))


def short_clock(text: Column) -> Column:
    """MM:SS of HH:MM:SS; 12:00 where it can't be read."""
    return F.coalesce(part(text, r"^\d{2}:(\d{2}:\d{2})$", 1), F.lit("12:00"))


def elapsed_of_clock_text(text: Column) -> Column:
    """Seconds of a regulation period that HH:MM:SS leaves behind it; 0 where it can't be read."""
    left = part(text, r"^\d{2}:(\d{2}):\d{2}$", 1).try_cast("int") * 60 + part(text, r"^\d{2}:\d{2}:(\d{2})$", 1).try_cast("int")
    return F.coalesce(F.lit(720.0) - left, F.lit(0.0))


def clock_to_seconds(text: Column) -> Column:
    """Minutes * 60 + whole seconds of m:ss.f, null on any error."""
    return F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int") * 60 + F.floor(F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")).cast("int")


def looks_like_clock(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(r"^(\d{1,2}:\d{2}(\.\d+)?|PT(\d+M)?(\d+(\.\d+)?S)?)$"), F.lit(False))


def minutes_played(text: Column) -> Column:
    """struct(seconds, ms, raw) of MM:SS, where minutes may pass 60; null and 0:00 give 0, what can't be read null."""
    t = F.trim(text)
    seconds = part(t, r"^(\d+):([0-5]\d)$", 1).try_cast("long") * 60 + part(t, r"^(\d+):([0-5]\d)$", 2).try_cast("long")
    seconds = F.when(t.isNull() | (t == ""), F.lit(0)).otherwise(seconds).cast("long")
    return F.struct(seconds.alias("seconds"), (seconds * 1000).alias("ms"), text.alias("raw"))
