import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hostvane.functions import calendar, scalars

X, Y = F.col("x"), F.col("y")


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2031-02-07T06:10:00.123456", datetime(2031, 2, 7, 6, 10, 0, 123456)),
        ("2031-02-07 15:10:20.654321", datetime(2031, 2, 7, 15, 10, 20, 654321)),
        ("2026", None),
        ("ontem", None),
        (None, None),
    ],
)
def test_parse_timestamp(one, text, parsed):
    assert one(scalars.parse_timestamp(X), "x string", text) == parsed


def test_byte_units(one):
    size = 3 * 1024**3 + 1
    assert one(scalars.whole_gib(X), "x bigint", size) == 3
    assert one(scalars.whole_gib(X), "x bigint", 1024**3 - 1) == 0
    assert one(scalars.bytes_to_gib(X), "x bigint", 1024**3 // 2) == 0.5
    assert one(scalars.bytes_to_mib(X, 2), "x bigint", 1234567) == 1.18


@pytest.mark.parametrize("used, total, share", [(5, 10, 50.0), (0, 0, 0.0), (5, 0, 0.0), (5, None, None)])
def test_used_percent(one, used, total, share):
    assert one(scalars.used_percent(X, Y), "x bigint, y bigint", used, total) == share


def test_free_percent_is_cut_off(one):
    assert one(scalars.free_percent(X, Y), "x bigint, y bigint", 799, 1000) == 79
    assert one(scalars.free_percent(X, Y), "x bigint, y bigint", 1, 0) is None


@pytest.mark.parametrize(
    "number, mac", [(163312212337109, "94:88:16:67:61:d5"), (255, "00:00:00:00:00:ff"), (2**48 + 1, "00:00:00:00:00:01")]
)
def test_mac_text(one, number, mac):
    assert one(scalars.mac_text(X), "x bigint", number) == mac
    assert one(scalars.machine_id(scalars.mac_text(X)), "x bigint", number) == mac.replace(":", "")


@pytest.mark.parametrize(
    "login, first, second, user",
    [
        ("ana", "b", "c", "ana"),
        (None, "b", "c", "b"),
        (None, "", "c", "c"),
        (None, None, "", "desconhecido"),
    ],
)
def test_first_user(one, login, first, second, user):
    column = scalars.first_user(F.col("a"), F.col("b"), F.col("c"))
    assert one(column, "a string, b string, c string", login, first, second) == user


@pytest.mark.parametrize(
    "text, millis",
    [
        ("Resposta de 8.8.8.8: bytes=32 tempo=13ms TTL=118", 13),
        ("64 bytes from 8.8.8.8: icmp_seq=1 ttl=118 time=12.7 ms", 12),
        ("linha\nTempo=7ms\ntime=99 ms", 7),
        ("time=1 ms tempo=8ms", 8),
        ("time=abc ms\ntime=5 ms", 0),
        ("timeout", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_ping_millis(one, text, millis):
    assert one(scalars.ping_millis(X), "x string", text) == millis


def test_truncate_clamp_and_defaults(one):
    assert one(scalars.truncate(X), "x double", -2.7) == -2
    assert one(scalars.clamp(X, 45.0, 88.0), "x double", 12.0) == 45.0
    assert one(scalars.clamp(X, 45.0, 88.0), "x double", 99.0) == 88.0
    assert one(scalars.clamp(X, 45.0, 88.0), "x double", None) is None
    assert one(scalars.round_or_zero(X), "x double", None) == 0.0
    assert one(scalars.round_or_zero(X), "x double", 3600.126) == 3600.13
    assert one(scalars.zero_if_missing(X), "x bigint", None) == 0


@pytest.mark.parametrize("value", [0.0, 12.5, 100.0, 93482342.123, 1234567890123.25, 0.0001, 0.1, -3.75])
def test_number_text_is_plain(one, value):
    assert one(scalars.number_text(X), "x double", value) == repr(value)


def test_fixed_text(one):
    assert one(scalars.fixed_text(X), "x double", 9.12) == "9.1"
    assert one(scalars.fixed_text(X), "x double", None) is None


def test_stamps(one):
    ts = datetime(2026, 4, 6, 9, 5, 7)
    assert one(scalars.upload_stamp(X), "x timestamp", ts) == "2026-04-06T09-05-07"
    assert one(scalars.file_stamp(X), "x timestamp", ts) == "6-4-2026-9-5"
    assert [one(c, "x timestamp", ts) for c in scalars.date_parts(X).values()] == ["2026", "04", "06"]


@pytest.mark.parametrize(
    "ts, factor, services, live, boost",
    [
        (datetime(2026, 4, 5, 12), 0.15, 3, 6, 0.90),  # Sunday
        (datetime(2026, 4, 4, 12), 0.50, 13, 12, 0.90),  # Saturday
        (datetime(2026, 4, 6, 5, 59), 0.30, 7, 8, 0.90),
        (datetime(2026, 4, 6, 6, 0), 1.0, 26, 20, 1.15),
        (datetime(2026, 4, 6, 9, 59), 1.0, 26, 20, 1.15),
        (datetime(2026, 4, 6, 10, 0), 0.75, 19, 16, 1.15),
        (datetime(2026, 4, 6, 15, 59), 0.75, 19, 16, 1.15),
        (datetime(2026, 4, 6, 16, 0), 1.0, 26, 20, 1.15),
        (datetime(2026, 4, 6, 19, 59), 1.0, 26, 20, 1.15),
        (datetime(2026, 4, 6, 20, 0), 0.30, 7, 8, 0.90),
        (None, None, None, None, None),
    ],
)
def test_calendar(one, ts, factor, services, live, boost):
    load = calendar.load_factor(X)
    assert one(load, "x timestamp", ts) == factor
    assert one(calendar.expected_services(load), "x timestamp", ts) == services
    assert one(calendar.live_population(load), "x timestamp", ts) == live
    assert one(calendar.load_multiplier(load), "x timestamp", ts) == boost


@pytest.mark.parametrize("hour, part", [(0, "MADRUGADA"), (6, "MANHA"), (11, "MANHA"), (12, "TARDE"), (18, "NOITE")])
def test_day_part(one, hour, part):
    assert one(calendar.day_part(X), "x timestamp", datetime(2026, 4, 14, hour, 39)) == part


def test_exact_sums_do_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e9,), (-1e9,)] * 50
    up = spark.createDataFrame(values, "x double").repartition(7)
    down = spark.createDataFrame(values[::-1], "x double").coalesce(1)
    totals = {d.agg(scalars.exact_sum(X).alias("s")).first()["s"] for d in (up, down)}
    assert len(totals) == 1 and math.isclose(totals.pop(), 30.0)
    small = spark.range(1_000_000).select(F.lit(4e-7).alias("x")).agg(scalars.exact_sum(X).alias("s")).first()["s"]
    assert small == 0.4
    large = spark.createDataFrame([(1e23,), (1.0,), (-1e23,), (1e300,)], "x double")
    assert large.agg(scalars.exact_sum(X).alias("s")).first()["s"] == 1e300
    assert large.where("x < 1e299").agg(scalars.exact_sum(X).alias("s")).first()["s"] == 1.0
    tiny = spark.createDataFrame([(1e-20,)] * 10, "x double").agg(scalars.exact_sum(X).alias("s")).first()["s"]
    assert math.isclose(tiny, 1e-19)
    empty = spark.createDataFrame([], "x double").agg(scalars.exact_avg(X).alias("m")).first()["m"]
    assert empty is None
