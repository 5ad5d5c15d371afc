"""One test per semantic decision (README "Semantics and decisions")."""

import statistics

import pytest
from pyspark.sql import functions as F

from helpers import T0, TRIP_SCHEMA, points, trip
from trackwise.plans import complex as j2
from trackwise.plans import simple as j1


def zigzag(n=70):
    """Speeds that alternate up and down so both acceleration signs occur."""
    speeds = [10.0 + (3 if i % 3 == 0 else 0) + i * 0.1 for i in range(n)]
    return [(30.0 + i * 1e-4 * (1 + (i % 3 == 0)), 120.0, s, 0, i) for i, s in enumerate(speeds)]


def test_d1_split_sd_carry_their_names(spark):
    rows = zigzag()
    kin = j2.kinematic_rows(j2.clean_rows(points(spark, rows), trip(spark))).select("tan_acc").collect()
    pos = [r[0] for r in kin if r[0] is not None and r[0] > 0]
    neg = [r[0] for r in kin if r[0] is not None and r[0] < 0]
    out = j2.complex_trip_features(points(spark, rows), trip(spark)).first()
    assert len(pos) > 2 and len(neg) > 2
    assert out["acc_pos_sd"] == pytest.approx(statistics.stdev(pos))
    assert out["acc_neg_sd"] == pytest.approx(statistics.stdev(neg))


def test_d3_non_numeric_ids_keep_their_trip(spark):
    rows = [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(61)]
    pts = points(spark, rows).withColumn("imei", F.lit("dev-A"))
    tr = spark.createDataFrame([("dev-A", "trip-x", "veh-y", T0, T0 + 100)], TRIP_SCHEMA)
    out = j2.complex_trip_features(pts, tr).collect()
    assert len(out) == 1 and out[0]["imei"] == "dev-A" and out[0]["vid"] == "veh-y"


def test_d5_equal_time_stamps_have_a_total_order(spark):
    # two distinct positions in the same second: the result does not depend on input order
    rows = [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(40)]
    rows.insert(10, (30.00095, 120.0, 10.0, 0, 9.5))
    a = j1.simple_trip_features(points(spark, rows), trip(spark)).collect()
    b = j1.simple_trip_features(points(spark, list(reversed(rows))).repartition(3), trip(spark)).collect()
    assert a == b


def test_d9_duplicate_cohort_ids_do_not_multiply_rows(spark):
    rows = [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(61)]
    single = spark.createDataFrame([("1",)], "imei string")
    double = spark.createDataFrame([("1",), ("1",), ("1",)], "imei string")
    a = j2.complex_trip_features(points(spark, rows), trip(spark), single).collect()
    b = j2.complex_trip_features(points(spark, rows), trip(spark), double).collect()
    assert a == b and len(a) == 1


def test_d14_jump_filter_only_in_basic_features(spark):
    rows = [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(70)]
    rows[30] = (31.0, 120.0, 10.0, 0, 30)           # 111 km away and back
    simple = j1.simple_trip_features(points(spark, rows), trip(spark)).first()
    complex_ = j2.complex_trip_features(points(spark, rows), trip(spark)).first()
    assert simple["mileage"] < 1.0                     # jumps removed
    assert complex_["mileage"] > 200.0                 # jump distances counted
