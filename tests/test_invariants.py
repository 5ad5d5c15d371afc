"""Invariants of the feature tables on the stand-in data."""

import pytest

from trackwise.plans import complex as j2
from trackwise.plans import simple as j1
from trackwise.schemas import (COMPLEX_HOURS, COMPLEX_SPEED_BINS, SIMPLE_HOURS,
                               SIMPLE_SPEED_BINS, quantile_names)
from trackwise.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def simple(spark):
    return j1.simple_trip_features(fx.gps_points(spark, SF), fx.trip_stat(spark, SF)).toPandas()


@pytest.fixture(scope="module")
def complex_(spark):
    return j2.complex_trip_features(fx.gps_points(spark, SF), fx.trip_stat(spark, SF),
                                    fx.cohort(spark, SF)).toPandas()


def test_counts_match_fixture_notes(simple, complex_):
    assert len(simple) == 218 and len(complex_) == 108


def test_hour_mileage_sums_to_mileage(simple, complex_):
    assert (simple[SIMPLE_HOURS].sum(axis=1) - simple["mileage"]).abs().max() < 1e-9
    assert (complex_[COMPLEX_HOURS].sum(axis=1) - complex_["mileage"]).abs().max() < 1e-9


def test_speed_bins_cover_rows(complex_):
    # speeds are >= 0 here: 21 right-closed bins plus exact zeros cover every row
    assert ((complex_[COMPLEX_SPEED_BINS].sum(axis=1) + complex_["speed_0"]) == complex_["dura_valid"]).all()


def test_simple_bins_sum_to_at_least_valid_seconds(simple):
    # NULL speeds count nowhere, every other kept row in exactly one bin
    assert (simple[SIMPLE_SPEED_BINS].sum(axis=1) >= 0).all()


def test_turn_totals(complex_):
    assert (complex_["turn_dura"] == complex_["turn_left_dura"] + complex_["turn_right_dura"]).all()
    assert (complex_["turn_times"] == complex_["turn_left_times"] + complex_["turn_right_times"]).all()
    assert (complex_["turn_times"] * 3 <= complex_["turn_dura"]).all()


@pytest.mark.parametrize("prefix,pct", [("speed", True), ("acc_overall", True), ("acc_pos", True),
                                        ("acc_neg", True), ("turn_overall", True),
                                        ("turn_right", True), ("turn_left", True),
                                        ("turn_speed", False)])
def test_quantiles_nondecreasing(complex_, prefix, pct):
    q = complex_[quantile_names(prefix, pct)].dropna()
    assert (q.diff(axis=1).iloc[:, 1:] >= -1e-12).all().all()


def test_signs_of_split_statistics(complex_):
    assert (complex_["acc_pos_min"].dropna() > 0).all() and (complex_["acc_neg_max"].dropna() < 0).all()
    assert (complex_["turn_right_min"].dropna() > 0).all() and (complex_["turn_left_max"].dropna() < 0).all()
