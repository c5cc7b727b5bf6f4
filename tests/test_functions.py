import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.functions import durations as d


def one(spark, value, fn, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(fn(F.col("v")).alias("out")).first().out


@pytest.mark.parametrize(
    "text,seconds",
    [
        ("PT2H", 7_200),
        ("PT1H20M", 4_800),
        ("pt45m", 2_700),
        ("P1DT2H", 93_600),
        ("PT26H", 93_600),
        ("P2D", 172_800),
        ("-PT30M", -1_800),
        ("PT-30M", -1_800),
        ("-PT-30M", 1_800),
        ("PT1.5S", 1.5),
        ("PT-0.5S", -0.5),
        ("PT0S", 0),
        ("PT", None),
        ("P", None),
        ("P1DT", None),
        ("2H", None),
        ("PT2", None),
        ("PT1H2H", None),
        ("P1Y", None),
        ("P1M", None),
        ("P99999999D", None),
        ("", None),
        (None, None),
    ],
)
def test_duration_text(spark, text, seconds):
    micros = one(spark, text, d.parse_duration_micros)
    assert micros == (None if seconds is None else round(seconds * 1_000_000))
    interval = one(spark, text, d.parse_duration)
    assert interval == (None if seconds is None else dt.timedelta(seconds=seconds))


@pytest.mark.parametrize(
    "text,seconds",
    [
        ("PT000000001H", 3_600),
        ("PT123456789H", 123_456_789 * 3_600),
        ("P" + "0" * 40 + "1DT-0000000000000001.5S", 86_398.5),
        ("PT000000000012345678901S", 12_345_678_901),
        ("P9999999D", 9_999_999 * 86_400),
        ("PT9999999999999999999999S", None),
        ("P999999999999D", None),
        ("PT1000000000000S", None),
    ],
)
def test_durations_of_any_digits(spark, text, seconds):
    micros = one(spark, text, d.parse_duration_micros)
    assert micros == (None if seconds is None else round(seconds * 1_000_000))
    assert one(spark, text, d.is_duration)
    as_text = one(spark, text, lambda c: d.parse_duration(c).cast("string"))
    assert (as_text is None) == (seconds is None)


@pytest.mark.parametrize(
    "seconds,text",
    [(0, "PT0S"), (7_200, "PT2H"), (4_800, "PT1H20M"), (93_600, "PT26H"), (61, "PT1M1S"), (-5_400, "PT-1H-30M")],
)
def test_duration_format(spark, seconds, text):
    assert one(spark, seconds, d.format_duration, "long") == text


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2026-04-01T08:00:00", True),
        ("2026-04-01T08:00", True),
        ("2026-04-01t08:00:00", True),
        ("2026-04-01T08:00:00.123456789", True),
        ("2026-04-01T08:00:00.", True),
        ("2024-02-29T00:00", True),
        ("2026-02-29T00:00", False),
        ("2026-04-01T24:00:00", False),
        ("2026-04-01T08:60:00", False),
        ("2026-04-01", False),
        ("2026-04-01 08:00:00", False),
        ("2026-04-01T08:00:00Z", False),
        ("2026-04-01T08:00:00+07:00", False),
        ("2026-4-1T08:00:00", False),
        (" 2026-04-01T08:00:00", False),
    ],
)
def test_local_date_time(spark, text, ok):
    assert (one(spark, text, d.parse_local_date_time) is not None) == ok


def test_local_date_time_value(spark):
    got = one(spark, "2026-04-01T08:00:00.123456789", d.parse_local_date_time)
    assert got == dt.datetime(2026, 4, 1, 8, 0, 0, 123456)
    assert one(spark, "2026-04-01T08:00:00.5", lambda c: d.format_local_date_time(d.parse_local_date_time(c))) == (
        "2026-04-01T08:00:00.5"
    )
