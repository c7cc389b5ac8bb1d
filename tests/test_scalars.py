from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freshet.functions import scalars as S


def value(spark, column, **inputs):
    kinds = {str: "string", int: "bigint", datetime: "timestamp", list: "array<string>", type(None): "string"}
    schema = ", ".join(f"{name} {kinds[type(v)]}" for name, v in inputs.items())
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("PT4M13S", 253), ("PT1H0M1S", 3601), ("P1DT2H", 93600), ("P1W", 604800), ("PT36,5S", 36), ("PT36.5S", 36),
        ("P0D", 0), (None, 0), ("", 0), ("PT", 0), ("P", 0), ("P1DT", 0), ("P1Y", 0), ("-PT1S", 0), ("bad", 0),
        ("1;2;3;4;5", 0), ("P1;2;3;4;5", 0), ("P1W2DT3H4M5S", 604800 + 2 * 86400 + 3 * 3600 + 4 * 60 + 5),
    ],
)
def test_duration(spark, text, seconds):
    assert value(spark, S.iso_duration_seconds("t"), t=text) == seconds


@pytest.mark.parametrize("text, good", [("PT4M13S", True), ("P0D", True), ("PT", False), ("", False), (None, False), ("P1Y", False)])
def test_duration_check(spark, text, good):
    assert value(spark, S.is_iso_duration("t"), t=text) is good


@pytest.mark.parametrize(
    "text, number",
    [
        ("12.7", 12), ("-3.9", -3), ("0.9999999", 0), ("1e3", 1000), (" 15 ", 15), ("", 0), (None, 0), ("x", 0),
        ("1_000", 0), ("1,000", 0), ("0x10", 0), ("true", 0), ("9007199254740993", 9007199254740993), ("inf", 0),
        ("9223372036854775808", 0), ("9223372036854775807", 9223372036854775807), ("nan", 0),
    ],
)
def test_numbers(spark, text, number):
    assert value(spark, S.coerce_bigint("t"), t=text) == number


@pytest.mark.parametrize("text, good", [("12.7", True), ("inf", False), ("9223372036854775808", False), (None, False), ("0", True)])
def test_number_check(spark, text, good):
    assert value(spark, S.is_bigint_text("t"), t=text) is good


@pytest.mark.parametrize(
    "name, stamp",
    [
        ("channel_stats_20260119_213221.csv", datetime(2026, 1, 19, 21, 32, 21)),
        ("channel_stats_SomeName_20260115_120505.csv", datetime(2026, 1, 15, 12, 5, 5)),
        ("a_b_20260119_213221_20260120_010101.csv", datetime(2026, 1, 20, 1, 1, 1)),
        ("channel_stats_20260115.csv", None),
        ("channel_stats_20260119212750.csv", None),
        ("20260119_213221.csv", None),
        ("x_20269999_999999.csv", None),
        ("x_20260230_010101.csv", None),
        ("x_20260119_213221.csv.bak", None),
    ],
)
def test_stamp(spark, name, stamp):
    assert value(spark, S.stamp_ts("n"), n=name) == stamp
    assert value(spark, S.stamp_parts("n")["month"], n=name) == (stamp and f"{stamp:%m}")


def test_date_only_stamp(spark):
    assert value(spark, S.date_stamp_ts("n"), n="channel_stats_20260115.csv") == datetime(2026, 1, 15)
    assert value(spark, S.date_stamp_ts("n"), n="channel_stats_20260119_213221.csv") is None


def test_lake_path(spark):
    name = "channel_stats_20260119_213221.csv"
    key = "youtube-raw-data/2026/01/19/21/" + name
    assert value(spark, S.lake_path("n"), n=name) == key
    assert value(spark, S.lake_path("n", "raw"), n=name) == key.replace("youtube-raw-data", "raw")
    assert value(spark, S.object_uri("b", "n"), n=key) == "s3://b/" + key
    assert value(spark, S.basename("n"), n=key) == name
    assert value(spark, S.basename("n"), n=name) == name
    assert value(spark, S.lake_path("n"), n="video_details_20260115.csv") is None


def test_run_names(spark):
    run = datetime(2026, 1, 29, 17, 25, 0)
    assert value(spark, S.run_stamp("r"), r=run) == "20260129_172500"
    assert value(spark, S.run_file_name("video_details", "r"), r=run) == "video_details_20260129_172500.csv"


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2026-01-29T17:24:58.336039+00:00Z", datetime(2026, 1, 29, 17, 24, 58, 336039)),
        ("2026-01-29T17:24:58Z", datetime(2026, 1, 29, 17, 24, 58)),
        ("2026-01-29T17:24:58", datetime(2026, 1, 29, 17, 24, 58)),
        ("2026-01-29T17:24:58+02:00", datetime(2026, 1, 29, 15, 24, 58)),
        ("junk", None), ("", None), (None, None),
    ],
)
def test_state_timestamp(spark, text, parsed):
    assert value(spark, S.parse_iso_lenient("t"), t=text) == parsed


def test_lookback(spark):
    got = value(spark, S.lookback("t"), t=datetime(2026, 1, 29, 17, 24, 58, 336039))
    assert got == datetime(2026, 1, 29, 17, 14, 58, 336039)


def test_defaults(spark):
    assert value(spark, S.tags_joined("t"), t=["x", "y,z"]) == "x,y,z"
    assert value(spark, S.tags_joined(F.lit(None).cast("array<string>")), t="") == ""
    assert value(spark, S.first_present("a", "b"), a=None, b="fr") == "fr"
    assert value(spark, S.first_present("a", "b"), a="", b="fr") == ""
    assert value(spark, S.first_present("a", "b"), a=None, b=None) == ""
    assert value(spark, S.empty_if_missing("a"), a=None) == ""


@pytest.mark.parametrize("cached, saved", [(0, 0), (1, 1), (49, 1), (50, 2), (101, 3)])
def test_calls_saved(spark, cached, saved):
    assert value(spark, S.calls_saved("n"), n=cached) == saved


def test_documented_quota(spark):
    # 10 channels with 50 videos each: the published 1,530 units.
    assert value(spark, S.quota_units("c", "v"), c=10, v=500) == 1530
