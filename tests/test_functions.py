import math

import pytest
from pyspark.sql import functions as F

from trackwise.functions import binning, geo, timefmt


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_haversine_one_degree_of_longitude_on_equator(spark):
    d = one(spark, geo.gps_dist("0D", "1D", "0D", "0D"))
    assert d == pytest.approx(2 * math.pi * 6378.178 / 360, abs=1e-9)
    assert round(d, 4) == 111.3202


def test_haversine_zero_for_same_point(spark):
    assert one(spark, geo.gps_dist("30.1D", "120.2D", "30.1D", "120.2D")) == 0.0


@pytest.mark.parametrize("d,expected", [(20, 20), (-340, 20), (340, -20), (180, 180), (-180, -180), (0, 0)])
def test_heading_difference_is_wrapped(spark, d, expected):
    # 350 -> 10 is +20, 10 -> 350 is -20; a change of exactly 180 keeps its sign
    assert one(spark, F.expr(geo.wrap_sql(str(d)))) == expected


@pytest.mark.parametrize("x,y,expected", [(0.0, 1.0, 0.0), (1.0, 0.0, 90.0), (0.0, -1.0, 180.0),
                                          (-1.0, 0.0, 270.0), (1.0, 1.0, 45.0), (-1.0, 1.0, 315.0),
                                          (0.0, 0.0, None)])
def test_heading_of_vector_clockwise_from_north(spark, x, y, expected):
    got = one(spark, F.expr(geo.heading_sql(f"{x!r}D", f"{y!r}D")))
    assert got == pytest.approx(expected) if expected is not None else got is None


def test_circumradius_collinear_cases(spark):
    # straight motion through the origin: D = 0, centre numerators non-zero -> radius infinite -> 0
    v = one(spark, F.expr(geo.normal_acc_over_radius_sql("-1D", "1D", "1D", "-1D", "2D")))
    assert v == 0.0
    # axis-aligned straight motion: a numerator is 0 -> undefined -> NULL
    v = one(spark, F.expr(geo.normal_acc_over_radius_sql("0D", "-1D", "0D", "1D", "1D")))
    assert v is None


def test_circumradius_right_angle(spark):
    # A=(-1,0), B=(0,0), C=(0,1): circle through them has radius sqrt(2)/2
    v = one(spark, F.expr(geo.normal_acc_over_radius_sql("-1D", "0D", "0D", "1D", "1D")))
    assert v == pytest.approx(1 / (math.sqrt(2) / 2))


def test_interval_bounds_modes():
    b = binning.interval_bounds(0, 200, 10, above=True)
    assert len(b) == 21 and b[0] == (0, 10) and b[-1] == (200, math.inf)
    b = binning.interval_bounds(-1, 0, 0.05, below=True)
    assert len(b) == 21 and b[0] == (-math.inf, -1) and b[-1][1] == 0
    b = binning.interval_bounds(0, 1, 0.5, below=True, above=True)
    assert b == [(-math.inf, 0), (0, 0.5), (0.5, 1), (1, math.inf)]
    b = binning.interval_bounds(0, 1, 0.5)
    assert b == [(0, 0.5), (0.5, 1)]
    # sequence arithmetic, not decimal: 3 * 0.05
    assert binning.interval_bounds(0, 1, 0.05)[3][0] == 3 * 0.05


def test_ceil_speed_bins(spark):
    from trackwise.schemas import SIMPLE_SPEED_BINS
    df = spark.createDataFrame([(0.0,), (10.0,), (10.1,), (200.0,), (200.1,), (None,)], "speed double")
    df = df.withColumn("one", F.lit(1))
    row = df.agg(*binning.ceil_bin_counts("speed", "one", SIMPLE_SPEED_BINS)).first().asDict()
    ones = {k for k, v in row.items() if v == 1}
    assert ones == {"speed_0", "speed_0_10", "speed_10_20", "speed_190_200", "speed_200_Inf"}
    assert sum(row.values()) == 5


def test_hour_of_day_utc(spark):
    assert one(spark, timefmt.hour_of_day(F.lit(1704067200 + 5 * 3600 + 59.9))) == 5
    assert one(spark, timefmt.hour_of_day(F.lit(1704067200 + 23 * 3600 + 3599.5))) == 23


def test_day_keys(spark):
    assert one(spark, timefmt.day_keys("2024-01-30", "2024-02-02")) == [
        "20240130", "20240131", "20240201", "20240202"]
    assert one(spark, timefmt.utc_day_key(F.lit(1704067200 + 86399.5))) == "20240101"


def test_hour_of_day_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, timefmt.hour_of_day(F.lit(1704067200 + 60))) == 8
        assert one(spark, timefmt.hour_of_day(F.lit(1704067200 + 60), tz="UTC")) == 0
        assert one(spark, timefmt.hour_of_day(F.lit(1704067200 + 60), tz="Asia/Tokyo")) == 9
        assert one(spark, timefmt.day_string(F.lit(1704067200 - 3600))) == "2024-01-01"
        assert one(spark, timefmt.day_string(F.lit(1704067200 - 3600), tz="UTC")) == "2023-12-31"
        assert one(spark, timefmt.day_string(F.lit(1704067200), tz="America/New_York")) == "2023-12-31"
        text = F.lit("2024-01-01 08:00:00")
        assert one(spark, timefmt.epoch_seconds(text)) == one(spark, timefmt.epoch_seconds(text, tz="Asia/Shanghai")) == 1704067200
        assert one(spark, timefmt.epoch_seconds(text, tz="UTC")) == 1704067200 + 8 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_distance_that_is_no_number_is_null(spark):
    assert one(spark, geo.gps_dist("double('NaN')", "1D", "0D", "0D")) is None
    df = spark.range(200).selectExpr("95D + id / 10D AS la", "180D - (95D + id / 10D) AS lb")
    bad = df.select(geo.gps_dist("la", "0D", "lb", "180D").alias("d")).where("isnan(d)")
    assert bad.count() == 0


def test_bin_index_of_a_value_between_the_bins(spark):
    bounds = [(0.0, 1.0), (1.5, 2.0)]
    df = spark.createDataFrame([(0.5,), (1.2,), (2.0,), (9.0,), (None,)], "x double")
    assert [r[0] for r in df.select(binning.bin_index("x", bounds)).collect()] == [0, -1, 1, -1, None]
