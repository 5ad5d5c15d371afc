"""Per-trip kinematic features (284 columns).

Plan (no Python on executors):

  points -> truncate to whole seconds -> drop incomplete rows and no-fix
  points -> cohort semi-join on trips -> bucketed point-in-trip join (a
  broadcast join where the cohort's trips fit, so nothing moves before it)
  -> collapse equal rows of the nine job columns (map-side combine, one
  exchange of the distinct matched rows; the copy count keeps the raw-row
  guard exact) -> exchange on (imei, tripnumber[, stat_date]) -> three
  Window passes with one identical spec (one sort) -> aggregate on the same
  partitioning (no further exchange). Where the trips do not fit a
  broadcast, the points are limited to the cohort and their copies collapsed
  before the shuffle join.

Trips longer than PART_SECONDS go another way from the collapsed rows on: windows
are keyed by parts of a trip (operators.parts), each with a halo of the rows its
stencils and turn episodes reach; the size guards are sums over a table with one
row a part; run counts are corrected from the first and last two members of every
part (operators.sequence); quantiles come from counted values (operators.quantiles).
The kinematic rows of these trips are written once and read by the three aggregates.
No row-level window or value map is keyed by such a trip, and the rows are those of
the other way; a session whose trips are all shorter runs the other way alone.

Row-level definitions, for the rows of one trip sorted by time:

* am: km to the next row, 0 on the last row; hour of each row.
* A, C: planar velocity (m/s) from the previous row / to the next row, in
  the frame of the current row; only rows 2..n-1 have them.
* speed_cal = |C|, heading_cal = heading of C, tan_acc = (|C|-|A|)/9.8,
  norm_acc = sign * speed_cal^2 / R(A, 0, C) / 9.8 (R: circumradius),
  sign negative for a left turn.
* angle_delta / angle_cal_delta: wrapped heading change to the next row per
  second (reported / computed heading), 0 on the last row.
* turn runs: maximal runs of angle_delta > 3 (right) / < -3 (left) with at
  least 3 rows; a NULL breaks a run.
* bin runs: over the subsequence of rows with x > 0 (or x < 0), maximal
  runs of the same bin; counted per bin when at least ``threshold`` long.

Decisions where the definition is ill-posed: dt = 0 gives NULL instead of
Inf/NaN; x/0 ratios are NULL; rejected trips produce no row; ids stay
strings; acc_pos_sd / acc_neg_sd carry the statistic their name says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackwise.functions.binning import (bin_index, count_in_intervals, interval_bounds,
                                         quantile_columns, quantiles_sql, sums_by_value)
from trackwise.functions.geo import (GRAVITY, gps_dist_sql, heading_sql, norm_sql,
                                     normal_acc_over_radius_sql, velocity_sql, wrap_sql)
from trackwise.functions.timefmt import hour_of_day
from trackwise.operators.broadcast import size_checked
from trackwise.operators.copies import collapse_copies
from trackwise.operators.parts import HALO, with_halo
from trackwise.operators.quantiles import exact_quantiles
from trackwise.operators.range_join import DEFAULT_BUCKET_SECONDS, interval_facts, points_in_intervals
from trackwise.operators.sequence import (added_runs, edge_corrections, edge_neighbours, filtered_run_start,
                                          in_run_at_least, part_edges, run_start_at_least)
from trackwise.schemas import (COMPLEX_COLUMNS, COMPLEX_HOURS, COMPLEX_SPEED_BINS,
                               quantile_names, run_bin_names)
from trackwise.sources.sinks import through_staging

# Fixed values of the feature definition.
MIN_RAW_ROWS = 60          # a trip needs more raw rows than this
MIN_CLEAN_ROWS = 15        # ... and more distinct rows than this
TURN_DEG_PER_S = 3.0       # turn-rate threshold
TURN_MIN_ROWS = 3          # minimum rows of a turn episode
ACC_POS_MIN_RUN = 1        # run-length threshold per bin: acceleration > 0
ACC_NEG_MIN_RUN = 2        # acceleration < 0
NORM_MIN_RUN = 1           # normal acceleration, both signs

SPEED_BOUNDS = interval_bounds(0, 200, 10, above=True)
ACC_POS_BOUNDS = interval_bounds(0, 1, 0.05, above=True)
ACC_NEG_BOUNDS = interval_bounds(-1, 0, 0.05, below=True)

ROW_COLS = ["imei", "tid", "vid", "tripnumber", "time_stamp", "lat", "lon", "heading", "speed"]
POINT_COLS = ["imei", "time_stamp", "lat", "lon", "heading", "speed"]
TRIP_KEY = ["imei", "tripnumber"]
ORDER = ["time_stamp", "lat", "lon", "heading", "speed", "tid", "vid"]
#: trips longer than so many seconds are cut into parts of that length; LONG marks their rows
PART_SECONDS, PART, LONG = 4 * 3600, "_part", "_long"
#: bin column -> (run threshold, names of the counts, named from the bin next to 0 outwards)
RUN_FAMILIES = {
    "acc_pos": (ACC_POS_MIN_RUN, "acc_pos", False), "acc_neg": (ACC_NEG_MIN_RUN, "acc_neg", True),
    "norm_pos": (NORM_MIN_RUN, "turn_right", False), "norm_neg": (NORM_MIN_RUN, "turn_left", True),
}


def trip_window(day: list[str] = ()):
    return Window.partitionBy(*TRIP_KEY, *day).orderBy(*[F.asc_nulls_first(c) for c in ORDER])


def truncated_points(points: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """imei, time_stamp (whole seconds), lat, lon, heading, speed."""
    return points.select(
        "imei", (F.col("time_stamp") / F.lit(1000)).cast("int").alias("time_stamp"),
        "lat", "lon", F.col("direction").cast("int").alias("heading"), "speed", *extra)


def cohort_trips(trips: DataFrame, cohort: DataFrame | None) -> DataFrame:
    """Trips of devices in the cohort (semi join: cohort duplicates do not multiply)."""
    if cohort is None:
        return trips
    ids = size_checked(cohort.select(F.col("imei").alias("deviceid")))
    return trips.join(ids, "deviceid", "left_semi")


def trip_points_trunc(points: DataFrame, trips: DataFrame, cohort: DataFrame | None = None, *,
                      by_day: bool = False,
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Point-in-trip rows on whole seconds (every copy kept): the 9 job columns."""
    day = ["stat_date"] if by_day else []
    pts = truncated_points(points, tuple(day))
    return _assign(pts, trips, cohort, by_day, bucket_seconds).select(*ROW_COLS, *day)


def _assign(pts, trips, cohort, by_day, bucket_seconds, before_shuffle=None, part_seconds=None):
    """Bucketed point-in-trip join of the cohort's trips.

    One job measures both broadcast candidates (the cohort's expanded trips, cohort
    ids) and the longest trip. ``before_shuffle`` reduces the points where they
    have to be shuffled for the join. With ``part_seconds`` the rows of trips that are
    longer are marked in the column LONG (left out where no trip is).
    """
    day = ["stat_date"] if by_day else []
    tr = trips.select("tid", "vid", "deviceid", F.col("start").alias("tripnumber"), "s_end",
                      *[F.col(d).alias("trip_day") for d in day])
    mark = F.lit(False).alias(LONG)         # measured with the rows, whether it is used or not
    measure = lambda t, *others: interval_facts(
        t.select("*", mark), "tripnumber", "s_end", *others, bucket_seconds=bucket_seconds)
    if cohort is None:
        facts = measure(tr)
    else:
        ids = cohort.select(F.col("imei").alias("deviceid"))
        facts = measure(tr.join(ids, "deviceid", "left_semi"), ids)
        ids = F.broadcast(ids) if facts.fits[1] else ids.hint("merge")
        tr = tr.join(ids, "deviceid", "left_semi")
        if not facts.fits[0]:
            pts = pts.join(ids.withColumnRenamed("deviceid", "imei"), "imei", "left_semi")
    split = part_seconds is not None and facts.longest > part_seconds
    if split:
        tr = _mark_long(tr, part_seconds)
    if not facts.fits[0] and before_shuffle:
        pts = before_shuffle(pts)
    extra = (("stat_date", "trip_day"),) if day else ()
    joined = points_in_intervals(pts, tr, point_key="imei", interval_key="deviceid",
                                 ts="time_stamp", start="tripnumber", end="s_end",
                                 extra_keys=extra, bucket_seconds=bucket_seconds, facts=facts)
    return joined.drop("deviceid", "s_end", *(["trip_day"] if day else []))


def _mark_long(trips: DataFrame, part_seconds: int) -> DataFrame:
    """Trips with the column LONG: a trip is long under all its ids and ends if it is under one."""
    key = [c for c in ("deviceid", "tripnumber", "trip_day") if c in trips.columns]
    long = trips.where(F.col("s_end") - F.col("tripnumber") > part_seconds).select(*key).distinct()
    long = size_checked(long.withColumn(LONG, F.lit(True)))
    return trips.join(long, key, "left").withColumn(LONG, F.coalesce(LONG, F.lit(False)))


def clean_rows(points: DataFrame, trips: DataFrame, cohort: DataFrame | None = None, *,
               by_day: bool = False, part_seconds: int | None = None,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Distinct complete rows of each trip with their copy count (``copies``); with
    ``part_seconds``, and where some trip is longer, also LONG."""
    day = ["stat_date"] if by_day else []
    pts = (truncated_points(points, tuple(day))
           .dropna(subset=POINT_COLS).where(F.col("lat") != 0))
    trips = trips.dropna(subset=["tid", "vid", "start"])
    rows = _assign(pts, trips, cohort, by_day, bucket_seconds,
                   before_shuffle=lambda p: collapse_copies(p, POINT_COLS + day), part_seconds=part_seconds)
    return collapse_copies(rows, ROW_COLS + day, marks=tuple(c for c in (LONG,) if c in rows.columns))


def kinematic_rows(rows: DataFrame, *, min_raw_rows: int = MIN_RAW_ROWS,
                   min_clean_rows: int = MIN_CLEAN_ROWS, tz: str | None = None,
                   turn_threshold: float = TURN_DEG_PER_S,
                   turn_min_rows: int = TURN_MIN_ROWS) -> DataFrame:
    """Row-level kinematics of the trips passing both size guards."""
    w = trip_window(["stat_date"] if "stat_date" in rows.columns else [])
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guarded = rows.select("*", F.sum("copies").over(whole).alias("raw_rows"), F.count(F.lit(1)).over(whole).alias("clean_rows"))
    return _kinematics(guarded, rows.columns, w, tz, turn_threshold, turn_min_rows,
                       guard=(F.col("raw_rows") > min_raw_rows) & (F.col("clean_rows") > min_clean_rows))


def kinematic_rows_by_part(rows: DataFrame, part_seconds: int = PART_SECONDS, *, min_raw_rows: int = MIN_RAW_ROWS,
                           min_clean_rows: int = MIN_CLEAN_ROWS, tz: str | None = None,
                           turn_threshold: float = TURN_DEG_PER_S, turn_min_rows: int = TURN_MIN_ROWS) -> DataFrame:
    """As :func:`kinematic_rows` with windows over parts of a trip. Bin-run flags are
    those of a part alone; the bins' neighbours in the part are added, from which
    :func:`run_corrections` counts what the parts' edges change."""
    trip = [*TRIP_KEY, *(["stat_date"] if "stat_date" in rows.columns else [])]
    parted = rows.withColumn(PART, F.floor((F.col("time_stamp") - F.col("tripnumber")) / part_seconds))
    # a stencil reaches one row back and two ahead, an episode's slices turn_min_rows - 1 either
    # way, and a row's turn rate one more ahead
    haloed = with_halo(parted, trip, PART, ORDER, before=max(1, turn_min_rows - 1), after=max(2, turn_min_rows),
                       totals={"raw_rows": F.col("copies"), "clean_rows": F.lit(1)},
                       keep=(F.col("raw_rows") > min_raw_rows) & (F.col("clean_rows") > min_clean_rows))
    w = Window.partitionBy(*trip, PART).orderBy(*[F.asc_nulls_first(c) for c in ORDER])
    kin = _kinematics(haloed, haloed.columns, w, tz, turn_threshold, turn_min_rows, in_parts=True)
    return kin.where(~F.col(HALO)).drop(HALO)


def _kinematics(rows: DataFrame, columns: list[str], w, tz, turn_threshold, turn_min_rows, guard=None, in_parts=False):
    """Three passes over the windows ``w``; ``columns`` of the rows are kept."""
    c = F.col
    # pass 1: neighbours (and the guards, where they are windows of the same spec)
    p1 = rows.select(
        "*",
        *[F.lag(x, 1).over(w).alias(f"p_{x}") for x in ("time_stamp", "lat", "lon")],
        *[F.lead(x, 1).over(w).alias(f"n_{x}") for x in ("time_stamp", "lat", "lon", "heading", "speed")],
    )
    if guard is not None:
        p1 = p1.where(guard)

    has_prev, has_next = "p_time_stamp IS NOT NULL", "n_time_stamp IS NOT NULL"
    mid = f"({has_prev} AND {has_next})"
    dt_next = "nullif(n_time_stamp - time_stamp, 0)"
    ax, ay = velocity_sql("p_lat", "p_lon", "lat", "lon", "time_stamp - p_time_stamp")
    cx, cy = velocity_sql("n_lat", "n_lon", "lat", "lon", "n_time_stamp - time_stamp")
    e = F.expr
    k = p1.select(
        *columns,
        "n_time_stamp",
        e(f"NOT {has_prev}").alias("is_first"), e(f"NOT {has_next}").alias("is_last"),
        e(f"CASE WHEN {has_next} THEN {gps_dist_sql('n_lat', 'n_lon', 'lat', 'lon')} ELSE 0D END").alias("am"),
        e(f"CASE WHEN {has_next} THEN (n_speed - speed) / {dt_next} ELSE 0D END").alias("gps_acc"),
        hour_of_day(c("time_stamp"), tz).alias("hour"),
        *[e(f"CASE WHEN {mid} THEN {v} END").alias(n) for n, v in
          (("ax", ax), ("ay", ay), ("cx", cx), ("cy", cy))],
        e(f"CASE WHEN {has_next} THEN {wrap_sql('n_heading - heading')} / {dt_next} ELSE 0D END")
        .alias("angle_delta"),
    ).withColumns({
        "speed_cal": e(norm_sql("cx", "cy")),
        "heading_cal": e(heading_sql("cx", "cy")),
        "tan_acc": e(f"({norm_sql('cx', 'cy')} - {norm_sql('ax', 'ay')}) / {GRAVITY!r}D"),
    })

    # pass 2: computed heading of the next row
    k2 = k.withColumn("n_heading_cal", F.lead("heading_cal", 1).over(w)).withColumn(
        "angle_cal_delta",
        e(f"CASE WHEN {has_next} THEN {wrap_sql('n_heading_cal - heading_cal')} / {dt_next} ELSE 0D END"))
    sign = "CASE WHEN angle_delta < 0 OR (angle_delta = 0 AND angle_cal_delta < 0) THEN -1D ELSE 1D END"
    norm_acc = (f"({normal_acc_over_radius_sql('ax', 'ay', 'cx', 'cy', f'({sign}) * (speed_cal * speed_cal)')})"
                f" / {GRAVITY!r}D")
    t = f"{float(turn_threshold)!r}D"
    k2 = k2.withColumns({
        "norm_acc": e(f"CASE WHEN {norm_acc} = 0 THEN 0D ELSE {norm_acc} END"),
        "turn_state": e(f"CASE WHEN angle_delta > {t} THEN 'R' WHEN angle_delta < -{t} THEN 'L' ELSE 'N' END"),
        "acc_pos_bin": F.when(c("tan_acc") > 0, bin_index("tan_acc", ACC_POS_BOUNDS)),
        "acc_neg_bin": F.when(c("tan_acc") < 0, bin_index("tan_acc", ACC_NEG_BOUNDS)),
    })
    k2 = k2.withColumns({
        "norm_pos_bin": F.when(c("norm_acc") > 0, bin_index("norm_acc", ACC_POS_BOUNDS)),
        "norm_neg_bin": F.when(c("norm_acc") < 0, bin_index("norm_acc", ACC_NEG_BOUNDS)),
    })
    edges = []
    if in_parts:        # rows of the halo are members of their own part's runs
        k2 = k2.withColumns({f"{f}_bin": F.when(~c(HALO), c(f"{f}_bin")) for f in RUN_FAMILIES})
        edges = [x for f in RUN_FAMILIES for x in edge_neighbours(f"{f}_bin", w)]

    # pass 3: episodes and bin runs (lag/lead on the same window)
    return k2.select(
        *[x for x in k2.columns if x not in ("n_time_stamp", "n_heading_cal")],
        in_run_at_least("turn_state", "R", turn_min_rows, w).alias("in_right"),
        in_run_at_least("turn_state", "L", turn_min_rows, w).alias("in_left"),
        run_start_at_least("turn_state", "R", turn_min_rows, w).alias("start_right"),
        run_start_at_least("turn_state", "L", turn_min_rows, w).alias("start_left"),
        *[filtered_run_start(f"{f}_bin", k, w).alias(f"{f}_run") for f, (k, _, _) in RUN_FAMILIES.items()],
        *edges,
    )


def run_corrections(kin: DataFrame) -> DataFrame:
    """Per trip what the edges of its parts add to the run counts (columns named ``+`` and the count)."""
    trip = [*TRIP_KEY, *(["stat_date"] if "stat_date" in kin.columns else [])]
    edges = kin.groupBy(*trip, PART).agg(*[x for f in RUN_FAMILIES for x in part_edges(f"{f}_bin")])
    corrected = edge_corrections(edges, trip, PART, {f"{f}_bin": k for f, (k, _, _) in RUN_FAMILIES.items()})
    return corrected.groupBy(*trip).agg(*[
        F.expr(added_runs(f"{f}_bin", i)).alias(f"+{name}") for f in RUN_FAMILIES for i, name in _numbered_bins(f)])


def _numbered_bins(family: str) -> list[tuple[int, str]]:
    """(bin, name of its run count); the negative families are named from the bin next to 0 outwards."""
    _, prefix, reverse = RUN_FAMILIES[family]
    names = run_bin_names(prefix)
    return [(len(names) - 1 - i if reverse else i, n) for i, n in enumerate(names)]


def _only(cond: str, x: str) -> str:
    return f"CASE WHEN {cond} THEN {x} END"


IN_TURN = "(in_right OR in_left)"
#: quantile block -> (value, names end in _pct)
QUANTILE_BLOCKS = {
    "speed": ("speed", True), "acc_overall": ("tan_acc", True),
    "acc_pos": (_only("tan_acc > 0", "tan_acc"), True), "acc_neg": (_only("tan_acc < 0", "tan_acc"), True),
    "turn_speed": (_only(IN_TURN, "speed"), False), "turn_left_speed": (_only("in_left", "speed"), False),
    "turn_right_speed": (_only("in_right", "speed"), False), "turn_overall": ("norm_acc", True),
    "turn_right": (_only("norm_acc > 0", "norm_acc"), True), "turn_left": (_only("norm_acc < 0", "norm_acc"), True),
}


def _mean_sd(x: str, prefix: str) -> list[str]:
    return [f"avg({x}) AS `{prefix}_mean`", f"stddev_samp({x}) AS `{prefix}_sd`"]


def _trip_aggregates() -> list[str]:
    """All columns but the quantiles, as SQL text (one JVM call each). Every buffer has
    a fixed width, so the rows of a trip may lie in any number of tasks."""
    aggs = [
        f"first({_only('is_first', 'vid')}, true) AS vid",
        "min(time_stamp) AS start_time", "max(time_stamp) AS end_time",
        f"max({_only('is_first', 'lat')}) AS lat_st", f"max({_only('is_first', 'lon')}) AS lon_st",
        f"max({_only('is_last', 'lat')}) AS lat_end", f"max({_only('is_last', 'lon')}) AS lon_end",
        "count(1) AS dura_valid", "sum(am) AS mileage",
        *_mean_sd("speed", "speed"),
        "count_if(speed = 0) AS speed_0",
        f"avg({_only('speed > 0', 'speed')}) AS speed_mean_drive",
        f"stddev_samp({_only('speed > 0', 'speed')}) AS speed_sd_drive",
        *_mean_sd("tan_acc", "acc_overall"),
        "count_if(tan_acc > 0) AS acc_pos_dura", "count_if(tan_acc < 0) AS acc_neg_dura",
        *_mean_sd(_only("tan_acc > 0", "tan_acc"), "acc_pos"), *_mean_sd(_only("tan_acc < 0", "tan_acc"), "acc_neg"),
        *_mean_sd("norm_acc", "turn_overall"),
        *_mean_sd(_only("norm_acc > 0", "norm_acc"), "turn_right"), *_mean_sd(_only("norm_acc < 0", "norm_acc"), "turn_left"),
    ]
    for name, member, start in (("turn", IN_TURN, "(start_right OR start_left)"),
                                ("turn_left", "in_left", "start_left"),
                                ("turn_right", "in_right", "start_right")):
        aggs += [f"count_if({member}) AS {name}_dura", f"count_if({start}) AS {name}_times",
                 *_mean_sd(_only(member, "speed"), f"{name}_speed")]
    return aggs + [f"count_if(`{f}_run` AND `{f}_bin` = {i}) AS `{name}`" for f in RUN_FAMILIES for i, name in _numbered_bins(f)]


def _aggregate(kin: DataFrame, key: list[str], more: list[str]) -> DataFrame:
    return kin.groupBy(*key).agg(
        *sums_by_value("am", "hour", range(24), COMPLEX_HOURS), *[F.expr(a) for a in _trip_aggregates() + more],
        *count_in_intervals("speed", SPEED_BOUNDS, COMPLEX_SPEED_BINS))


def _finish(g: DataFrame, day: list[str]) -> DataFrame:
    """Derived columns, quantile arrays spread, columns in order."""
    fly = gps_dist_sql("lat_st", "lon_st", "lat_end", "lon_end")
    g = g.select(
        "*",
        F.expr("end_time - tripnumber AS dura"),
        F.expr(f"{fly} AS fly_dist"),
        F.expr(f"try_divide(mileage, {fly}) AS curv_overall"),
        *[c for name, (_, pct) in QUANTILE_BLOCKS.items() for c in quantile_columns(f"_q_{name}", quantile_names(name, pct))])
    return g.select(*COMPLEX_COLUMNS, *day)


def aggregate_trips(kin: DataFrame) -> DataFrame:
    """One 284-column row per trip (plus stat_date when present)."""
    day = ["stat_date"] if "stat_date" in kin.columns else []
    quantiles = [f"{quantiles_sql(x)} AS `_q_{name}`" for name, (x, _) in QUANTILE_BLOCKS.items()]
    return _finish(_aggregate(kin, [*TRIP_KEY, *day], quantiles), day)


def aggregate_trips_by_part(kin: DataFrame) -> DataFrame:
    """:func:`aggregate_trips` of rows by part: partial aggregates of any split of the rows, run
    counts corrected at the parts' edges, quantiles from counted values. ``kin`` is read three times."""
    day = ["stat_date"] if "stat_date" in kin.columns else []
    trip = [*TRIP_KEY, *day]
    g = _aggregate(kin, trip, [])
    quantiles = exact_quantiles(kin, trip, {f"_q_{name}": x for name, (x, _) in QUANTILE_BLOCKS.items()})
    g = g.join(run_corrections(kin), trip).join(quantiles, trip, "left")
    counts = [name for f in RUN_FAMILIES for _, name in _numbered_bins(f)]
    return _finish(g.withColumns({n: F.col(n) + F.col(f"+{n}") for n in counts}), day)


def complex_trip_features(points: DataFrame, trips: DataFrame, cohort: DataFrame | None = None,
                          *, by_day: bool = False, tz: str | None = None, part_seconds: int = PART_SECONDS,
                          bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    rows = clean_rows(points, trips, cohort, by_day=by_day, part_seconds=part_seconds, bucket_seconds=bucket_seconds)
    if LONG not in rows.columns:
        return aggregate_trips(kinematic_rows(rows, tz=tz))
    rows = through_staging(rows, "trip_rows")       # joined and collapsed once for both ways
    short = aggregate_trips(kinematic_rows(rows.where(~F.col(LONG)).drop(LONG), tz=tz))
    kin = kinematic_rows_by_part(rows.where(LONG).drop(LONG), part_seconds, tz=tz)
    return short.unionByName(aggregate_trips_by_part(through_staging(kin, "long_trips")))
