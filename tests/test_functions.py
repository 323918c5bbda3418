from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.functions import geo_time, labels, scalars


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("country", "region", "minutes"),
    [
        ("United States", "Georgia", -300),
        ("Georgia", None, 240),
        ("United States", "Hawaii", -600),
        ("United States", None, -300),
        ("United States", "Nowhere", -300),
        ("Canada", "Newfoundland and Labrador", -210),
        ("Australia", "South Australia", 570),
        ("Spain", "Canary Islands", 0),
        ("Spain", "Madrid", 60),
        ("Nepal", "Hawaii", 345),
        ("Trinidad & Tobago", None, -240),
        ("Myanmar (Burma)", None, 390),
        ("Atlantis", "Hawaii", 0),
        (None, "Hawaii", 0),
        (None, None, 0),
    ],
)
def test_offset(spark, country, region, minutes):
    df = spark.createDataFrame([(country, region)], "country string, region string")
    assert geo_time.with_offset_minutes(df).first()["offset_minutes"] == minutes


def test_offset_tables_have_one_row_per_place(spark):
    countries = geo_time.country_offsets(spark)
    regions = geo_time.region_offsets(spark)
    assert countries.select("offset_country").distinct().count() == countries.count() == 111
    assert regions.count() == regions.drop("region_minutes").distinct().count() == 93


@pytest.mark.parametrize(
    ("minutes", "label"),
    [(0, "UTC+00:00"), (345, "UTC+05:45"), (-210, "UTC-03:30"), (-600, "UTC-10:00")],
)
def test_offset_label(spark, minutes, label):
    assert one(spark, geo_time.offset_label(F.lit(minutes))) == (label,)


@pytest.mark.parametrize(
    ("micros", "minutes", "hour"),
    [
        (0, 0, 0),
        (-1, 0, 23),
        (0, -1, 23),
        (86_400_000_000 - 1, 0, 23),
        (86_400_000_000 - 1, 1, 0),
        (3_600_000_000, -210, 21),
        (20 * 3_600_000_000, 345, 1),
    ],
)
def test_local_hour(spark, micros, minutes, hour):
    got = one(spark, geo_time.local_hour(F.lit(micros), F.lit(minutes)))
    assert got == (hour,)


def test_local_timestamp_ignores_the_session_zone(spark):
    column = geo_time.local_timestamp(F.lit(0), F.lit(-210))
    assert one(spark, column) == (datetime(1969, 12, 31, 20, 30),)


def test_period_borders(spark):
    days = ["20201122", "20201123", "20201130", "20201201", "20201207", "20201218", "20201219"]
    got = one(spark, *[labels.period_label(F.lit(d)) for d in days])
    assert got == (
        "normal", "black_friday", "black_friday", "normal", "christmas", "christmas", "normal",
    )
    calendar = [labels.Period("spring", "20210301", "20210531")]
    assert one(spark, labels.period_label(F.lit("20210401"), calendar)) == ("spring",)
    assert one(spark, labels.period_label(F.lit("20201125"), calendar)) == ("normal",)


def test_tiers_at_their_thresholds(spark):
    values = [labels.value_tier(F.lit(p)) for p in (0.39999, 0.4, 0.69999, 0.7)]
    assert one(spark, *values) == ("저관여", "잠재", "잠재", "고가치")
    risks = [labels.risk_tier(F.lit(p)) for p in (0.6499, 0.65)]
    assert one(spark, *risks) == ("안정", "고위험")


def test_flag_of_null_is_zero(spark):
    assert one(spark, labels.flag(F.lit(None) > 0), labels.flag(F.lit(1) > 0)) == (0, 1)


def test_ratios(spark):
    got = one(
        spark,
        scalars.safe_ratio(F.lit(1), F.lit(0), 4),
        scalars.safe_ratio(F.lit(354077), F.lit(40), 2),
        scalars.safe_ratio(F.lit(-5), F.lit(2), 0),
        scalars.smoothed_ratio(F.lit(3), F.lit(0)),
    )
    assert got == (None, 8851.93, -3.0, 3.0)


def test_date_parsing(spark):
    assert one(spark, scalars.parse_day(F.lit("20201201"))) == (date(2020, 12, 1),)
    assert one(spark, scalars.try_parse_day(F.lit("20201399"))) == (None,)
    with pytest.raises(PySparkException):
        one(spark, scalars.parse_day(F.lit("20201399")))
    got = one(
        spark,
        scalars.month_of_day(F.lit("20201201")),
        scalars.weekday_of_day(F.lit("20201206")),
        scalars.dashed_day(F.lit("20201201")),
    )
    assert got == ("2020-12", "Sunday", "2020-12-01")


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    count = scalars.count_distinct_with_null(F.col("x"))
    assert df.agg(count).first()[0] == 2
    assert df.where("x IS NOT NULL").agg(count).first()[0] == 1
    assert df.where("x IS NULL").agg(count).first()[0] == 1
    assert df.where("false").agg(count).first()[0] == 0
