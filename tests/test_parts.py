"""Trips in parts: halos, episodes and bin runs over part borders, counted quantiles."""

import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import POINT_SCHEMA, T0, TRIP_SCHEMA, points, trip
from trackwise.operators.parts import HALO, with_halo
from trackwise.operators.quantiles import exact_quantiles
from trackwise.operators.sequence import (added_runs, edge_corrections, edge_neighbours, filtered_run_start,
                                          part_edges)
from trackwise.functions.binning import quantiles_sql
from trackwise.plans import complex as j2
from trackwise.schemas import COMPLEX_COUNT_COLUMNS


def track(rng, n, gaps):
    """A wandering track with turns, stops, speed changes and, at ``gaps``, pauses."""
    rows, t, lat, lon, head = [], 0, 30.0, 120.0, 90.0
    for i in range(n):
        t += rng.choice(gaps)
        head += rng.choice([0, 0, 0, 5, 9, -7, -20, 40])
        step = rng.choice([0, 1e-5, 8e-5, 1.5e-4, 3e-4])
        lat, lon = lat + step * math.cos(math.radians(head)), lon + step * math.sin(math.radians(head))
        rows.append((lat, lon, rng.choice([0.0, 12.5, 40.0, 77.0, 130.0, 220.0]), int(head) % 360, t))
        if rng.random() < 0.05:
            rows.append(rows[-1])
    return rows


def same(a, b, columns):
    for c in columns:
        x, y = a[c], b[c]
        assert x == y or (c not in COMPLEX_COUNT_COLUMNS and isinstance(x, float) and abs(x - y) <= 1e-9 * max(1, abs(x))), (c, x, y)


def fleet(spark, tracks, end):
    """Points and one trip [T0, T0 + end] for every track, a device each."""
    rows = [(str(d), la, lo, sp, h, (T0 + t) * 1000) for d, tr in enumerate(tracks) for la, lo, sp, h, t in tr]
    trips = [(str(d), "t", "v", T0, T0 + end) for d in range(len(tracks))]
    return spark.createDataFrame(rows, POINT_SCHEMA), spark.createDataFrame(trips, TRIP_SCHEMA)


def test_all_columns_equal_with_and_without_parts(spark):
    rng = random.Random(1)
    gaps = [[1, 1, 1, 2, 3], [1, 1, 1, 1, 90], [1], [2, 7]]
    pts, tr = fleet(spark, [track(rng, 220, g) for g in gaps], 20_000)
    whole = {r["imei"]: r for r in j2.complex_trip_features(pts, tr, part_seconds=10 ** 6).collect()}
    assert len(whole) == 4 and sum(r["turn_times"] for r in whole.values()) > 9
    assert all(r["dura_valid"] > 150 for r in whole.values())
    for part_seconds in (1, 25):
        parts = j2.complex_trip_features(pts, tr, part_seconds=part_seconds).collect()
        assert len(parts) == 4
        for r in parts:
            same(whole[r["imei"]], r, r.asDict())


def test_row_level_kinematics_equal(spark):
    pts = points(spark, track(random.Random(9), 150, [1, 1, 2, 40]))
    rows = j2.clean_rows(pts, trip(spark, 0, 20_000))
    columns = [c for c in j2.kinematic_rows(rows).columns if not c.endswith("_run")]
    a = j2.kinematic_rows(rows).orderBy(*j2.ORDER).select(columns).collect()
    b = j2.kinematic_rows_by_part(rows, 13).orderBy(*j2.ORDER).select(columns).collect()
    assert a == b and len(a) > 140


def test_guards_count_over_all_parts(spark):
    line = [(30.0 + i * 1e-4, 120.0, 10.0, 0, i) for i in range(61)]
    few = line[:15] + [line[14]] * 60
    pts, tr = fleet(spark, [line[:60], line, few, [*few, line[15]]], 5_000)
    found = j2.kinematic_rows_by_part(j2.clean_rows(pts, tr), 10).groupBy("imei").count().collect()
    assert {r["imei"]: r["count"] for r in found} == {"1": 61, "3": 16}


def test_long_under_one_of_two_ends(spark):
    """A trip listed with a short and a long end goes one way with all of its rows."""
    trips = spark.createDataFrame([("1", "t1", "v1", T0, T0 + 400), ("1", "t2", "v1", T0, T0 + 40), ("2", "t", "v", T0, T0 + 50)], TRIP_SCHEMA)
    pts = points(spark, track(random.Random(5), 120, [1]))
    rows = j2.clean_rows(pts.unionByName(pts.withColumn("imei", F.lit("2"))), trips, part_seconds=60)
    marks = rows.groupBy("imei", j2.LONG).count().collect()
    assert {(r["imei"], r[j2.LONG]) for r in marks} == {("1", True), ("2", False)}
    assert j2.LONG not in j2.clean_rows(pts, trips, part_seconds=400).columns


def test_short_and_long_trips_together(spark):
    rows, trips = [], []
    for device, (n, gap) in enumerate([(100, 1), (100, 50), (80, 1), (70, 9)]):
        t0 = T0 + 1000
        rows += [(str(device), la, lo, sp, h, (t0 + t) * 1000) for la, lo, sp, h, t in track(random.Random(device), n, [gap])]
        trips.append((str(device), "t", "v", t0, t0 + n * gap + 1))
    pts, tr = spark.createDataFrame(rows, POINT_SCHEMA), spark.createDataFrame(trips, TRIP_SCHEMA)
    a = {r["imei"]: r for r in j2.complex_trip_features(pts, tr, part_seconds=10 ** 6).collect()}
    b = {r["imei"]: r for r in j2.complex_trip_features(pts, tr, part_seconds=300).collect()}
    assert set(a) == set(b) == {"0", "1", "2", "3"}
    for k in a:
        same(a[k], b[k], a[k].asDict())


def test_no_row_window_is_keyed_by_a_long_trip(spark):
    """Windows that shift rows are over (trip, part); only tables of parts are ordered by trip."""
    rows = j2.clean_rows(points(spark, track(random.Random(2), 90, [2])), trip(spark, 0, 9_000))
    plan = j2.kinematic_rows_by_part(rows, 60)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"Window \[", line)]
    shifts = [w for w in windows if "lead(lat" in w or "lag(lat" in w or "turn_state" in w or "row_number" in w]
    assert len(shifts) >= 3
    for w in shifts:
        keys = w.rsplit("], [", 2)[-2]
        assert "_part" in keys, w


def test_halo_reaches_over_short_parts(spark):
    # parts 0, 2, 3 and 9 with 1, 1, 3 and 1 rows
    rows = [("a", 0, 1), ("a", 2, 2), ("a", 3, 3), ("a", 3, 4), ("a", 3, 5), ("a", 9, 6), ("b", 0, 1)]
    df = spark.createDataFrame(rows, "k string, p int, v int")
    out = with_halo(df, ["k"], "p", ["v"], 2, 3, {"n": F.lit(1)}, F.col("n") > 1)
    got = {}
    for r in out.collect():
        got.setdefault((r["k"], r["p"]), []).append((r["v"], r[HALO]))
    halo = {key: (sorted(v for v, h in vs if not h), sorted(v for v, h in vs if h)) for key, vs in got.items()}
    assert halo == {("a", 0): ([1], [2, 3, 4]), ("a", 2): ([2], [1, 3, 4, 5]), ("a", 3): ([3, 4, 5], [1, 2, 6]),
                    ("a", 9): ([6], [4, 5])}


def test_bin_runs_over_parts_against_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for k in range(120):
        part = 0
        for i in range(rng.randint(1, 40)):
            part += rng.choice([0, 0, 0, 0, 1, 1, 4])
            rows.append((k, part, i, rng.choice([None, None, 0, 0, 1, 1, 2, -1])))
    df = spark.createDataFrame(rows, "k int, part int, i int, b int")
    w = Window.partitionBy("k", "part").orderBy("i")
    for threshold in (1, 2):
        kin = df.select("*", filtered_run_start("b", threshold, w).alias("run"), *edge_neighbours("b", w))
        local = kin.groupBy("k").agg(*[F.expr(f"count_if(run AND b = {i})").alias(f"n{i}") for i in range(3)])
        edges = kin.groupBy("k", "part").agg(*part_edges("b"))
        added = edge_corrections(edges, ["k"], "part", {"b": threshold}).groupBy("k").agg(
            *[F.expr(added_runs("b", i)).alias(f"a{i}") for i in range(3)])
        got = {r["k"]: [r[f"n{i}"] + r[f"a{i}"] for i in range(3)] for r in local.join(added, "k").collect()}
        for k in range(120):
            members = [b for kk, _, _, b in rows if kk == k and b is not None]
            want, j = [0, 0, 0], 0
            while j < len(members):
                e = j
                while e < len(members) and members[e] == members[j]:
                    e += 1
                if e - j >= threshold and members[j] >= 0:
                    want[members[j]] += 1
                j = e
            assert got[k] == want, (threshold, k)
    with pytest.raises(ValueError):
        edge_corrections(edges, ["k"], "part", {"b": 3})


def test_quantiles_equal_percentile_bit_for_bit(spark):
    rng = random.Random(12)
    rows = []
    for k in range(40):
        kind = k % 5
        for _ in range(rng.choice([1, 2, 3, 10, 11, 400])):
            x = {0: rng.gauss(0, 1), 1: rng.choice([0.0, -0.0, 1.5, 80.0]), 2: rng.uniform(-1e-6, 200.0),
                 3: None if rng.random() < 0.5 else rng.gauss(0, 1e-3), 4: float(rng.randint(0, 3))}[kind]
            rows.append((k, x))
    rows += [(99, None)] * 3 + [(50, 7.25)] * 5000
    df = spark.createDataFrame(rows, "k int, x double")
    blocks = {"all": "x", "pos": "CASE WHEN x > 0 THEN x END"}
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], blocks).collect()}
    want = df.groupBy("k").agg(*[F.expr(f"{quantiles_sql(x)} AS `{n}`") for n, x in blocks.items()]).collect()
    for r in want:
        for n in blocks:
            g = got[r["k"]][n] if r["k"] in got else None
            assert g == r[n], (r["k"], n)
    assert 99 not in got and got[50]["all"] == [7.25] * 11


def test_points_are_joined_once_for_short_and_long_trips(spark):
    """Both ways read the joined rows from a table: no scan of the points is left in the result's plan."""
    pts = points(spark, [(30.0 + i * 1e-4, 120.0 + (i % 7) * 1e-5, 10.0 + i % 3, (i * 7) % 360, i) for i in range(200)])
    trips = trip(spark, 0, 90).unionByName(trip(spark, 100, 199))
    got = j2.complex_trip_features(pts, trips, part_seconds=95)
    assert got.select("tripnumber").count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan
