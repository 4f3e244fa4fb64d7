"""Goldens of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import clock, codes, dates, numbers, text


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


CLOCKS = [("0:00.5", 1, 500), ("1:23.456", 1, 83_456), ("4:59.999", 5, 299_999), ("PT11M22.3S", 1, 682_300), ("PT5M", 5, 300_000), ("12:00", 1, 720_000), ("12:01", 1, None), ("5:01", 5, None), ("1:60", 1, None), ("bad", 1, None), ("", 1, None), (None, 1, None), ("PT", 1, 0), ("PT61S", 1, None), ("1:5", 1, None)]


def test_parse_clock(spark):
    got = values(spark, clock.parse_clock_ms(F.col("t"), F.col("p")), [(t, p) for t, p, _ in CLOCKS], "t string, p int")
    assert got == [w for *_, w in CLOCKS]


def test_clock_window_boundaries(spark):
    ms = [720_000, 600_000, 481_000, 480_000, 480_999, 480_001, 479_999, 720_001]
    got = values(spark, clock.in_clock_window(F.col("ms"), 480_000, 720_000), [(m,) for m in ms], "ms long")
    assert got == [True] * 4 + [False] * 4


@pytest.mark.parametrize(("raw", "want"), [("12:00", 720.0), ("2:30.5", 150.5), ("PT12M00.00S", 720.0), ("45.5", 45.5), ("-1", None), ("1:75", None), ("x", None), (None, None)])
def test_game_clock(spark, raw, want):
    assert values(spark, clock.parse_game_clock(F.col("t")), [(raw,)], "t string") == [want]


def test_clock_texts(spark):
    assert values(spark, clock.normalize_clock(F.col("t")), [("PT2M5S",), ("1:05.5",), (None,)], "t string") == ["2:05", "1:05.5", None]
    assert values(spark, clock.clock_text(F.col("s")), [(0.0,), (125.0,), (900.0,), (None,)], "s double") == ["00:12:00", "00:09:55", "00:00:00", "00:00:00"]
    assert values(spark, clock.short_clock(F.col("t")), [("00:09:55",), ("x",)], "t string") == ["09:55", "12:00"]
    assert values(spark, clock.elapsed_of_clock_text(F.col("t")), [("00:09:55",), ("x",)], "t string") == [125.0, 0.0]
    assert values(spark, clock.clock_to_seconds(F.col("t")), [("2:30.9",), ("x",), (None,)], "t string") == [150, None, None]
    assert [r and r.seconds for r in values(spark, clock.minutes_played(F.col("t")), [("75:10",), ("0:00",), (None,), ("x",)], "t string")] == [4510, 0, 0, None]
    assert values(spark, clock.looks_like_clock(F.col("t")), [("1:20",), ("PT1M",), ("120",), (None,)], "t string") == [True, True, False, False]


def test_elapsed(spark):
    got = values(spark, clock.seconds_elapsed_in_game(F.col("p"), F.col("r")), [(1, 720.0), (4, 0.0), (5, 300.0), (6, 0.0)], "p int, r double")
    assert got == [0.0, 2880.0, 2880.0, 3480.0]
    assert values(spark, clock.clock_in_bounds(F.col("p"), F.col("r")), [(1, 720.0), (5, 301.0), (None, 1.0)], "p int, r double") == [True, False, False]


def test_seasons(spark):
    assert values(spark, dates.season_from_game_id(F.col("g")), [("0022300001",), ("0000000000",), ("22300001",), (None,)], "g string") == ["2023-24", None, None, None]
    rows = [("2024-08-15",), ("2024-10-01",), ("1999-12-31",)]
    assert values(spark, dates.season_from_date(F.to_date("d")), rows, "d string") == ["2023-24", "2024-25", "1999-00"]
    assert values(spark, dates.season_from_date(F.to_date("d"), 8), rows, "d string") == ["2024-25", "2024-25", "1999-00"]
    assert values(spark, dates.expand_season(F.col("s")), [("2023",), ("2023-24",)], "s string") == ["2023-24", "2023-24"]


def test_dates(spark):
    got = values(spark, dates.parse_date(F.col("d")), [("2024-01-02",), ("01/02/2024",), ("01/02/24",), ("2024-01-02 10:00:00",), ("2024-13-02",), ("x",), (None,)], "d string")
    assert [str(g) if g else None for g in got] == ["2024-01-02"] * 4 + [None] * 3
    got = values(spark, dates.local_date(F.to_timestamp("t")), [("2024-01-02 03:00:00",), ("2024-01-02 06:00:00",)], "t string")
    assert [str(g) for g in got] == ["2024-01-01", "2024-01-02"]
    assert values(spark, dates.timezone_shift(F.col("a"), F.col("b")), [("America/Los_Angeles", "America/New_York"), ("America/New_York", "America/Los_Angeles"), ("Mars", "America/Denver")], "a string, b string") == [3.0, -3.0, -7.0]
    assert values(spark, dates.date_gap(F.to_date("a"), F.to_date("b")), [("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-01-02"), ("2024-01-01", "2024-01-03")], "a string, b string") == ["ok", "warn", "error"]
    assert [str(x) for x in values(spark, dates.date_in_id(F.col("t")), [("202401020BOS",), ("x-2024-01-02",)], "t string")] == ["2024-01-02", "2024-01-02"]


def test_numbers(spark):
    raw = [("1,234",), ("12.9",), ("-3.9",), ("—",), (" N/A ",), ("x",), (None,)]
    assert values(spark, numbers.to_long(F.col("t")), raw, "t string") == [1234, 12, -3, None, None, None, None]
    assert values(spark, numbers.to_double(F.col("t")), [("45.5%",), ("NaN",), ("Infinity",), ("1e3",)], "t string") == [45.5, None, None, 1000.0]
    assert values(spark, numbers.to_bool(F.col("t")), [("Yes",), ("off",), ("2",), (None,)], "t string") == [True, False, None, None]
    km = values(spark, numbers.haversine_km(*map(F.col, "abcd")), [(34.0430, -118.2675, 42.3662, -71.0621), (1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    assert 4000 < km[0] < 4500 and km[1] == 0
    assert values(spark, numbers.shot_zone(F.col("f")), [(4.0,), (10.0,), (23.0,), (24.0,), (None,)], "f double") == ["RIM", "SHORT_MID", "LONG_MID", "THREE", None]


def test_text(spark):
    assert values(spark, text.name_slug(F.col("n")), [("LeBron JAMES Jr.",), ("o'neal, shaq",), (None,)], "n string") == ["LebronJamesJr", "OnealShaq", ""]
    assert values(spark, text.clean_player_name(F.col("n")), [("Tim  Hardaway Jr.",), ("123",)], "n string")[1] is None
    assert values(spark, text.normalize_description(F.col("n")), [(" a  b!!! ",), ("",)], "n string") == ["a b!", None]
    assert [tuple(x) for x in values(spark, text.split_matchup(F.col("n")), [("BOS @ LAL",), ("BOS vs. LAL",), ("x",)], "n string")] == [("LAL", "BOS"), ("BOS", "LAL"), (None, None)]
    assert [tuple(x) for x in values(spark, text.split_score(F.col("n")), [("27 - 46",), ("",)], "n string")] == [(27, 46), (None, None)]
    assert values(spark, text.pair_key(F.col("a"), F.col("b")), [("B", "A"), (None, "A")], "a string, b string") == ["A_B", "A_UNK"]
    assert values(spark, text.error_fingerprint(F.col("n")), [("Bad 0022300001 at HTTP://X.y/z on 2024-01-01 from 1.2.3.4",)], "n string") == ["bad [GAME_ID] at [URL] on [DATE] from [IP]"]


def test_codes(spark):
    assert values(spark, codes.event_type(F.col("c")), [("7",), ("foul",), ("STEAL",), ("99",), (None,)], "c string") == ["FOUL", "FOUL", "STEAL", None, None]
    assert values(spark, codes.event_type(F.col("c"), "enum"), [("6",)], "c string") == ["FOUL"]
    assert values(spark, codes.severity(F.col("a"), F.col("b")), [("FLAGRANT", "Flagrant 2"), ("FLAGRANT", "Flagrant 1"), ("INJURY_LEAVE", ""), ("TWO_PF_EARLY", None), ("TECH", None)], "a string, b string") == ["HIGH", "MEDIUM", "HIGH", "MEDIUM", "LOW"]
    assert codes.dimension(spark, codes.EVENT_CODES).where("profile = 'preprocess' and code = '19'").first().value == "flagrant"
