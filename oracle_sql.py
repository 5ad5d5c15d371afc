"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark plans and as literally as possible:
plain windows over every row (no copy collapsing), run lengths by
gaps-and-islands over explicitly filtered subsequences, bins by explicit
bounds. Tables ``events`` and ``customer`` are the pre-registered views.
Doubles are rounded to 9 places on output (cross-engine float noise).
"""

from __future__ import annotations

from trackwise.schemas import (COMPLEX_ACC_RUNS, COMPLEX_ACC_STATS, COMPLEX_COLUMNS, COMPLEX_TYPES,
                               COMPLEX_HEAD, COMPLEX_HOURS, COMPLEX_NORM_RUNS,
                               COMPLEX_NORM_STATS, COMPLEX_SPEED_BINS, COMPLEX_SPEED_STATS,
                               COMPLEX_TURN, ROLLUP_COLUMNS, SIMPLE_COLUMNS, SIMPLE_HOURS,
                               SIMPLE_SPEED_BINS, quantile_names, run_bin_names)

# The bins (a, b] of the feature definition. Every end is an
# arithmetic sequence of its own: from + i * by, in double precision.
INF = float("inf")
SPEED_BOUNDS = [(10.0 * i, 10.0 * i + 10.0) for i in range(20)] + [(200.0, INF)]
ACC_POS_BOUNDS = [(0 + i * 0.05, 0.05 + i * 0.05 if i < 19 else 1.0) for i in range(20)] + [(1.0, INF)]
ACC_NEG_BOUNDS = [(-INF, -1.0)] + [(min(-1 + i * 0.05, -0.05), min(-1 + (i + 1) * 0.05, 0.0)) for i in range(20)]

PROBS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


def lit(x: float) -> str:
    """Exact double literal."""
    if x == float("inf"):
        return "'Infinity'::DOUBLE"
    if x == float("-inf"):
        return "'-Infinity'::DOUBLE"
    return f"{x:.17e}"


def present(cols: dict[str, str], src: str) -> str:
    """SELECT with doubles rounded to 9 places (-0 folded to 0).

    Values of magnitude >= 1e6 (epoch seconds) are kept as they are: there
    9 places are below double precision and rounding would only add error."""
    out = []
    for c, t in cols.items():
        if t == "double":
            r = f"(CASE WHEN abs({c}) >= 1e6 THEN {c} ELSE round({c}, 9) END)"
            out.append(f"CASE WHEN {r} = 0 THEN 0.0::DOUBLE ELSE {r} END AS {c}")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


# --------------------------------------------------------------------------
# stand-in inputs
# --------------------------------------------------------------------------
FIXTURES = """
e AS (SELECT event_id, user_id, event_type, value,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events),
c AS (SELECT *,
  CAST(sum((event_id*37)%21-10) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cy,
  CAST(sum((event_id*53)%21-10) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cx,
  CAST(sum((event_id*13)%21-10) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ch FROM e),
gps_points AS (SELECT CAST(user_id AS VARCHAR) AS imei,
  CASE WHEN event_id%103=0 THEN NULL WHEN event_id%101=0 THEN 0e0 WHEN event_id%97=0 THEN 31e0+user_id%500000*1e-2+cy*2e-5 ELSE 30e0+user_id%500000*1e-2+cy*2e-5 END AS lat,
  CASE WHEN event_id%103=0 THEN NULL WHEN event_id%101=0 THEN 0e0 ELSE 120e0+cx*2e-5 END AS lon,
  CASE WHEN event_id%83=0 THEN NULL WHEN event_type='error' THEN 0e0 ELSE value END AS speed,
  CAST((ch+36000)%360 AS INTEGER) AS direction,
  CAST((1704067200+user_id%500000*599+seq)*1000+(event_id%4)*250 AS BIGINT) AS time_stamp
  FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE event_id%89=0 OR event_id%103=0) c2),
trip_stat AS (
  SELECT CAST(user_id AS VARCHAR) AS deviceid, CAST(user_id AS VARCHAR) AS tid, CAST(100000+user_id AS VARCHAR) AS vid,
         CAST(1704067200+user_id%500000*599 AS INTEGER) AS start, CAST(1704067200+user_id%500000*599+66 AS INTEGER) AS s_end
  FROM (SELECT DISTINCT user_id FROM events) u
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), CASE WHEN user_id%7<>3 THEN CAST(500000+user_id AS VARCHAR) END, CAST(100000+user_id AS VARCHAR),
         CAST(1704067200+user_id%500000*599+67 AS INTEGER), CAST(1704067200+user_id%500000*599+400 AS INTEGER)
  FROM (SELECT DISTINCT user_id FROM events) u
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(100000+user_id AS VARCHAR),
         CAST(1704067200+user_id%500000*599 AS INTEGER), CAST(1704067200+user_id%500000*599+CASE user_id%5 WHEN 2 THEN 66 ELSE 50 END AS INTEGER)
  FROM (SELECT DISTINCT user_id FROM events WHERE user_id%5 IN (2, 4)) u),
trip_days AS (SELECT t.*, d.stat_date FROM trip_stat t,
  unnest(list_distinct([strftime(DATE '1970-01-01' + CAST(start // 86400 AS INTEGER), '%Y%m%d'),
                        strftime(DATE '1970-01-01' + CAST(s_end // 86400 AS INTEGER), '%Y%m%d')])) d(stat_date)),
cohort AS (SELECT CAST(c_custkey AS VARCHAR) AS imei FROM customer WHERE c_custkey%10<>3),
validity AS (SELECT CAST(c_custkey AS VARCHAR) AS imei, c_name AS VIN,
   CAST(1704067200+c_custkey%500000*599 AS BIGINT) AS valid_start_utc,
   CAST(1704067200+c_custkey%500000*599+(c_custkey%5)*50 AS BIGINT) AS valid_end_utc
   FROM customer WHERE c_custkey%10<>3)
"""


def gps_dist(lat: str, lon: str, lat0: str, lon0: str) -> str:
    r = lambda x: f"({x}*pi()/180e0)"
    la, lo, la0, lo0 = r(lat), r(lon), r(lat0), r(lon0)
    s1 = f"sin(({lo}-{lo0})/2e0)"
    s2 = f"sin(({la}-{la0})/2e0)"
    inner = f"(cos({la0})*cos({la})*({s1}*{s1})+({s2}*{s2}))"
    return f"(CASE WHEN {inner} BETWEEN 0 AND 1 THEN asin(sqrt({inner}))*2e0*6378.178e0 END)"


def hour(ts: str) -> str:
    return f"CAST(floor((CAST(floor({ts}) AS BIGINT) % 86400) / 3600) AS INTEGER)"


# --------------------------------------------------------------------------
# J1
# --------------------------------------------------------------------------
J1_ROWS = """
j1_join AS (SELECT t.tid, t.vid, t.start AS tripnumber, t.s_end, g.imei, g.lat, g.lon, g.speed,
                   g.direction, g.time_stamp/1000e0 AS time_stamp
            FROM gps_points g JOIN trip_stat t
              ON g.imei = t.deviceid AND g.time_stamp/1000e0 >= t.start AND g.time_stamp/1000e0 <= t.s_end /*day*/
            WHERE t.start > 0),
j1_lead AS (SELECT *,
   lead(lat, 1, 0e0) OVER w AS lat_0, lead(lon, 1, 0e0) OVER w AS lon_0
   FROM j1_join
   WINDOW w AS (PARTITION BY imei, tripnumber ORDER BY time_stamp ASC NULLS FIRST, lat ASC NULLS FIRST,
                lon ASC NULLS FIRST, speed ASC NULLS FIRST, vid ASC NULLS FIRST, tid ASC NULLS FIRST,
                s_end ASC NULLS FIRST)),
j1_dist AS (SELECT *, {am} AS am FROM j1_lead),
j1_kept AS (SELECT * FROM j1_dist WHERE am < 10e0)
""".format(am=gps_dist("lat", "lon", "lat_0", "lon_0"))


def day_key(epoch_s: str, fmt: str = "%Y%m%d") -> str:
    return f"strftime(DATE '1970-01-01' + CAST(floor(({epoch_s})/86400e0) AS INTEGER), '{fmt}')"


def by_day(sql: str) -> str:
    """The same computation, one run per day: trips as listed under a day with the
    points of that day, the day in every partition and group."""
    out = sql.replace("imei, tripnumber", "imei, tripnumber, stat_date").replace(
        "imei, vid, tripnumber", "imei, vid, tripnumber, stat_date")
    return out.replace("t.start AS tripnumber", "t.start AS tripnumber, t.stat_date").replace(
        "trip_stat", "trip_days").replace("/*day*/", "AND " + day_key("g.time_stamp/1000e0") + " = t.stat_date")


def _j1_agg(group: str = "imei, vid, tripnumber") -> str:
    hours = ", ".join(f"sum(CASE WHEN {hour('time_stamp')} = {h} THEN am ELSE 0e0 END) AS {n}"
                      for h, n in enumerate(SIMPLE_HOURS))
    bins = [f"CAST(sum(CASE WHEN ceil(speed/10e0) = {k} THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
            for k, n in enumerate(SIMPLE_SPEED_BINS[:-1])]
    bins.append(f"CAST(sum(CASE WHEN speed > 200e0 THEN 1 ELSE 0 END) AS BIGINT) AS {SIMPLE_SPEED_BINS[-1]}")
    return f"""
j1_ord AS (SELECT *,
   first_value(lat) OVER wf AS f_lat, first_value(lon) OVER wf AS f_lon,
   last_value(lat) OVER wf AS l_lat, last_value(lon) OVER wf AS l_lon
   FROM j1_kept
   WINDOW wf AS (PARTITION BY {group} ORDER BY time_stamp ASC NULLS FIRST, lat ASC NULLS FIRST,
     lon ASC NULLS FIRST, speed ASC NULLS FIRST, tid ASC NULLS FIRST, s_end ASC NULLS FIRST
     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
j1 AS (SELECT {group}, min(time_stamp) AS start_time, max(time_stamp) AS end_time,
   max(s_end) - min(tripnumber) AS dura, CAST(count(DISTINCT time_stamp) AS BIGINT) AS dura_valid,
   any_value(f_lat) AS lat_st, any_value(f_lon) AS lon_st, any_value(l_lat) AS lat_end, any_value(l_lon) AS lon_end,
   sum(am) AS mileage, {hours}, {', '.join(bins)}
   FROM j1_ord GROUP BY {group})
"""


SIMPLE_TYPES = {c: "double" for c in SIMPLE_COLUMNS}
SIMPLE_TYPES.update({"imei": "string", "vid": "string", "tripnumber": "int", "dura": "int",
                     "dura_valid": "long", **{n: "long" for n in SIMPLE_SPEED_BINS}})


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts)


def q_simple_trip_features() -> str:
    return with_ctes(FIXTURES, J1_ROWS, _j1_agg()) + "\n" + present(SIMPLE_TYPES, "j1")


# --------------------------------------------------------------------------
# J2
# --------------------------------------------------------------------------
def _bin_case(x: str, bounds) -> str:
    parts = []
    for i, (a, b) in enumerate(bounds):
        conds = []
        if a != float("-inf"):
            conds.append(f"{x} > {lit(a)}")
        if b != float("inf"):
            conds.append(f"{x} <= {lit(b)}")
        parts.append(f"WHEN {' AND '.join(conds) or 'TRUE'} THEN {i}")
    return "CASE " + " ".join(parts) + " END"


def _wrap(d: str) -> str:
    return f"(CASE WHEN abs({d}) > 180 THEN {d} - sign({d})*360e0 ELSE CAST({d} AS DOUBLE) END)"


def _xy(lat, lon, lat0, lon0, dt):
    x = f"({gps_dist(lat0, lon, lat0, lon0)}*sign({lon}-{lon0})*1000e0/NULLIF({dt}, 0))"
    y = f"({gps_dist(lat, lon0, lat0, lon0)}*sign({lat}-{lat0})*1000e0/NULLIF({dt}, 0))"
    return x, y


_AX, _AY = _xy("p_lat", "p_lon", "lat", "lon", "time_stamp - p_ts")
_CX, _CY = _xy("n_lat", "n_lon", "lat", "lon", "n_ts - time_stamp")
_ORDER2 = ("time_stamp ASC NULLS FIRST, lat ASC NULLS FIRST, lon ASC NULLS FIRST, "
           "heading ASC NULLS FIRST, speed ASC NULLS FIRST, tid ASC NULLS FIRST, vid ASC NULLS FIRST")

J2_ROWS = f"""
j2_join AS (SELECT g.imei, t.tid, t.vid, t.start AS tripnumber,
                   CAST(trunc(g.time_stamp/1000e0) AS INTEGER) AS time_stamp,
                   g.lat, g.lon, g.direction AS heading, g.speed
            FROM gps_points g
            JOIN (SELECT * FROM trip_stat WHERE deviceid IN (SELECT imei FROM cohort)) t
              ON g.imei = t.deviceid AND CAST(trunc(g.time_stamp/1000e0) AS INTEGER) >= t.start
             AND CAST(trunc(g.time_stamp/1000e0) AS INTEGER) <= t.s_end /*day*/),
j2_clean AS (SELECT * FROM j2_join WHERE imei IS NOT NULL AND tid IS NOT NULL AND vid IS NOT NULL
               AND tripnumber IS NOT NULL AND time_stamp IS NOT NULL AND lat IS NOT NULL
               AND lon IS NOT NULL AND heading IS NOT NULL AND speed IS NOT NULL AND lat <> 0),
j2_raw AS (SELECT imei, tripnumber, count(*) AS raw_rows FROM j2_clean GROUP BY imei, tripnumber),
j2_dist AS (SELECT DISTINCT * FROM j2_clean),
j2_cnt AS (SELECT imei, tripnumber, count(*) AS n FROM j2_dist GROUP BY imei, tripnumber),
j2_rows AS (SELECT d.* FROM j2_dist d JOIN j2_raw r USING (imei, tripnumber) JOIN j2_cnt c USING (imei, tripnumber)
            WHERE r.raw_rows > 60 AND c.n > 15),
j2_nb AS (SELECT *, row_number() OVER w AS rn,
     lag(time_stamp) OVER w AS p_ts, lag(lat) OVER w AS p_lat, lag(lon) OVER w AS p_lon,
     lead(time_stamp) OVER w AS n_ts, lead(lat) OVER w AS n_lat, lead(lon) OVER w AS n_lon,
     lead(heading) OVER w AS n_heading, lead(speed) OVER w AS n_speed
   FROM j2_rows WINDOW w AS (PARTITION BY imei, tripnumber ORDER BY {_ORDER2})),
j2_v AS (SELECT *,
     CASE WHEN n_ts IS NULL THEN 0e0 ELSE {gps_dist("n_lat", "n_lon", "lat", "lon")} END AS am,
     CASE WHEN n_ts IS NULL THEN 0e0 ELSE (n_speed - speed)/NULLIF(n_ts - time_stamp, 0) END AS gps_acc,
     {hour("time_stamp")} AS hour,
     CASE WHEN n_ts IS NULL THEN 0e0 ELSE {_wrap("n_heading - heading")}/NULLIF(n_ts - time_stamp, 0) END AS angle_delta,
     CASE WHEN p_ts IS NOT NULL AND n_ts IS NOT NULL THEN {_AX} END AS ax,
     CASE WHEN p_ts IS NOT NULL AND n_ts IS NOT NULL THEN {_AY} END AS ay,
     CASE WHEN p_ts IS NOT NULL AND n_ts IS NOT NULL THEN {_CX} END AS cx,
     CASE WHEN p_ts IS NOT NULL AND n_ts IS NOT NULL THEN {_CY} END AS cy
   FROM j2_nb),
j2_k AS (SELECT *,
     sqrt(cx*cx + cy*cy) AS speed_cal,
     CASE WHEN cx > 0 THEN (pi()/2 - atan(cy/cx))*180e0/pi()
          WHEN cx < 0 THEN (3*pi()/2 - atan(cy/cx))*180e0/pi()
          WHEN cx = 0 AND cy > 0 THEN 0e0*180e0/pi()
          WHEN cx = 0 AND cy < 0 THEN pi()*180e0/pi() END AS heading_cal,
     (sqrt(cx*cx + cy*cy) - sqrt(ax*ax + ay*ay))/9.8e0 AS tan_acc,
     2e0*(ax*(0e0-cy) + 0e0*(cy-ay) + cx*(ay-0e0)) AS d_,
     (ax*ax+ay*ay)*(0e0-cy) + (0e0)*(cy-ay) + (cx*cx+cy*cy)*(ay-0e0) AS nux,
     (ax*ax+ay*ay)*(cx-0e0) + (0e0)*(ax-cx) + (cx*cx+cy*cy)*(0e0-ax) AS nuy
   FROM j2_v),
j2_k2 AS (SELECT *,
     CASE WHEN n_ts IS NULL THEN 0e0
          ELSE {_wrap("lead(heading_cal) OVER (PARTITION BY imei, tripnumber ORDER BY rn) - heading_cal")}/NULLIF(n_ts - time_stamp, 0)
     END AS angle_cal_delta,
     CASE WHEN d_ <> 0 THEN sqrt((ax - nux/d_)*(ax - nux/d_) + (ay - nuy/d_)*(ay - nuy/d_)) END AS radius
   FROM j2_k),
j2_k3 AS (SELECT *,
     CASE WHEN cx IS NULL OR ax IS NULL THEN NULL
          WHEN d_ = 0 THEN (CASE WHEN nux <> 0 AND nuy <> 0 THEN 0e0 END)
          ELSE (CASE WHEN angle_delta < 0 OR (angle_delta = 0 AND angle_cal_delta < 0) THEN -1e0 ELSE 1e0 END)
               * (speed_cal*speed_cal) / NULLIF(radius, 0)
     END / 9.8e0 AS norm_acc0
   FROM j2_k2),
j2_k4 AS (SELECT * EXCLUDE (norm_acc0), CASE WHEN norm_acc0 = 0 THEN 0e0 ELSE norm_acc0 END AS norm_acc,
     CASE WHEN angle_delta > 3 THEN 'R' WHEN angle_delta < -3 THEN 'L'
          WHEN angle_delta IS NULL THEN 'X' ELSE 'N' END AS st
   FROM j2_k3),
j2_isl AS (SELECT *, rn - row_number() OVER (PARTITION BY imei, tripnumber, st ORDER BY rn) AS isl FROM j2_k4),
j2_turn AS (SELECT *,
     count(*) OVER (PARTITION BY imei, tripnumber, st, isl) AS run_len,
     min(rn) OVER (PARTITION BY imei, tripnumber, st, isl) AS run_first
   FROM j2_isl),
j2_kin AS (SELECT *,
     st = 'R' AND run_len >= 3 AS in_right, st = 'L' AND run_len >= 3 AS in_left,
     st = 'R' AND run_len >= 3 AND rn = run_first AS start_right,
     st = 'L' AND run_len >= 3 AND rn = run_first AS start_left
   FROM j2_turn)
"""


def _bin_runs(name: str, x: str, cond: str, bounds, threshold: int, names, reverse: bool) -> str:
    n = len(names)
    cols = ", ".join(
        f"CAST(count_if(b = {n - 1 - i if reverse else i} AND len >= {threshold}) AS BIGINT) AS {nm}"
        for i, nm in enumerate(names))
    return f"""
{name}_f AS (SELECT imei, tripnumber, rn, {_bin_case(x, bounds)} AS b,
               row_number() OVER (PARTITION BY imei, tripnumber ORDER BY rn) AS frn
             FROM j2_kin WHERE {cond}),
{name}_g AS (SELECT *, frn - row_number() OVER (PARTITION BY imei, tripnumber, b ORDER BY rn) AS g FROM {name}_f),
{name}_r AS (SELECT imei, tripnumber, b, g, count(*) AS len FROM {name}_g GROUP BY imei, tripnumber, b, g),
{name} AS (SELECT imei, tripnumber, {cols} FROM {name}_r GROUP BY imei, tripnumber)
"""


def _stats(x: str, prefix: str, where: str | None = None, pct: bool = True) -> list[str]:
    f = f" FILTER (WHERE {where})" if where else ""
    out = [f"avg({x}){f} AS {prefix}_mean", f"stddev_samp({x}){f} AS {prefix}_sd"]
    q = f"quantile_cont({x}, {PROBS}){f}"
    for i, nm in enumerate(quantile_names(prefix, pct)):
        out.append(f"({q})[{i + 1}] AS {nm}")
    return out


def _j2_agg() -> str:
    hours = [f"sum(CASE WHEN hour = {h} THEN am ELSE 0e0 END) AS {n}" for h, n in enumerate(COMPLEX_HOURS)]
    sbins = [f"CAST(count_if(speed > {lit(a)}{'' if b == float('inf') else f' AND speed <= {lit(b)}'}) AS BIGINT) AS {n}"
             for (a, b), n in zip(SPEED_BOUNDS, COMPLEX_SPEED_BINS)]
    cols = [
        "arg_min(vid, rn) AS vid", "min(time_stamp) AS start_time", "max(time_stamp) AS end_time",
        "max(time_stamp) - any_value(tripnumber) AS dura", "CAST(count(*) AS BIGINT) AS dura_valid",
        "arg_min(lat, rn) AS lat_st", "arg_min(lon, rn) AS lon_st",
        "arg_max(lat, rn) AS lat_end", "arg_max(lon, rn) AS lon_end", "sum(am) AS mileage",
        *hours,
        *_stats("speed", "speed"),
        "CAST(count_if(speed = 0) AS BIGINT) AS speed_0",
        "avg(speed) FILTER (WHERE speed > 0) AS speed_mean_drive",
        "stddev_samp(speed) FILTER (WHERE speed > 0) AS speed_sd_drive",
        *sbins,
        *_stats("tan_acc", "acc_overall"),
        "CAST(count_if(tan_acc > 0) AS BIGINT) AS acc_pos_dura",
        "CAST(count_if(tan_acc < 0) AS BIGINT) AS acc_neg_dura",
        "avg(tan_acc) FILTER (WHERE tan_acc > 0) AS acc_pos_mean",
        "avg(tan_acc) FILTER (WHERE tan_acc < 0) AS acc_neg_mean",
        "stddev_samp(tan_acc) FILTER (WHERE tan_acc > 0) AS acc_pos_sd",
        "stddev_samp(tan_acc) FILTER (WHERE tan_acc < 0) AS acc_neg_sd",
        *[c for c in _stats("tan_acc", "acc_pos", "tan_acc > 0")[2:]],
        *[c for c in _stats("tan_acc", "acc_neg", "tan_acc < 0")[2:]],
    ]
    for name, member, start in (("turn", "in_right OR in_left", "start_right OR start_left"),
                                ("turn_left", "in_left", "start_left"),
                                ("turn_right", "in_right", "start_right")):
        cols += [f"CAST(count_if({member}) AS BIGINT) AS {name}_dura",
                 f"CAST(count_if({start}) AS BIGINT) AS {name}_times",
                 *_stats("speed", f"{name}_speed", member, pct=False)]
    cols += [
        *_stats("norm_acc", "turn_overall"),
        "avg(norm_acc) FILTER (WHERE norm_acc > 0) AS turn_right_mean",
        "avg(norm_acc) FILTER (WHERE norm_acc < 0) AS turn_left_mean",
        "stddev_samp(norm_acc) FILTER (WHERE norm_acc > 0) AS turn_right_sd",
        "stddev_samp(norm_acc) FILTER (WHERE norm_acc < 0) AS turn_left_sd",
        *_stats("norm_acc", "turn_right", "norm_acc > 0")[2:],
        *_stats("norm_acc", "turn_left", "norm_acc < 0")[2:],
    ]
    runs = [
        _bin_runs("r_acc_pos", "tan_acc", "tan_acc > 0", ACC_POS_BOUNDS, 1, run_bin_names("acc_pos"), False),
        _bin_runs("r_acc_neg", "tan_acc", "tan_acc < 0", ACC_NEG_BOUNDS, 2, run_bin_names("acc_neg"), True),
        _bin_runs("r_turn_right", "norm_acc", "norm_acc > 0", ACC_POS_BOUNDS, 1, run_bin_names("turn_right"), False),
        _bin_runs("r_turn_left", "norm_acc", "norm_acc < 0", ACC_NEG_BOUNDS, 1, run_bin_names("turn_left"), True),
    ]
    run_cols = [f"COALESCE({n}, 0) AS {n}" for n in COMPLEX_ACC_RUNS + COMPLEX_NORM_RUNS]
    return ",\n".join(r.strip() for r in runs) + f""",
j2_trip AS (SELECT imei, tripnumber, {', '.join(cols)} FROM j2_kin GROUP BY imei, tripnumber),
j2 AS (SELECT t.*, {gps_dist("lat_st", "lon_st", "lat_end", "lon_end")} AS fly_dist,
          t.mileage / NULLIF({gps_dist("lat_st", "lon_st", "lat_end", "lon_end")}, 0) AS curv_overall,
          {', '.join(run_cols)}
       FROM j2_trip t
       LEFT JOIN r_acc_pos USING (imei, tripnumber) LEFT JOIN r_acc_neg USING (imei, tripnumber)
       LEFT JOIN r_turn_right USING (imei, tripnumber) LEFT JOIN r_turn_left USING (imei, tripnumber))
"""


def j2_query(columns: list[str], daily: bool = False) -> str:
    types = {c: COMPLEX_TYPES[c] for c in columns}
    if not daily:
        return with_ctes(FIXTURES, J2_ROWS, _j2_agg()) + "\n" + present(types, "j2")
    return (with_ctes(FIXTURES, by_day(J2_ROWS), by_day(_j2_agg())) + "\n"
            + present({**types, "stat_date": "string"}, "j2"))


ROW_TYPES = {"tid": "string", "vid": "string", "imei": "string", "deviceid": "string",
             "tripnumber": "int", "s_end": "int", "start": "int", "direction": "int", "heading": "int",
             "hour": "int", "stat_date": "string", "VIN": "string", "imei_1": "string", "day": "string",
             "valid_start_utc": "long", "valid_end_utc": "long", "dura": "int", "dura_valid": "long"}


def _types(cols, **override) -> dict[str, str]:
    return {c: override.get(c, ROW_TYPES.get(c, "double")) for c in cols}


def q(ctes: list[str], cols, src: str, **override) -> str:
    return with_ctes(FIXTURES, *ctes) + "\n" + present(_types(cols, **override), src)


TRIP_ROW_COLS = ["tid", "vid", "tripnumber", "s_end", "imei", "lat", "lon", "speed", "direction", "time_stamp"]
DIST_COLS = ["tid", "vid", "tripnumber", "imei", "time_stamp", "lat", "lon", "speed", "lat_0", "lon_0", "am"]
J2_ROW_COLS = ["imei", "tid", "vid", "tripnumber", "time_stamp", "lat", "lon", "heading", "speed"]
TURN_RUN_COLS = [c for c in COMPLEX_TURN if c.endswith("_dura") or c.endswith("_times")]
TURN_SPEED_COLS = [c for c in COMPLEX_TURN if c not in TURN_RUN_COLS]
ROLLUP_TYPES = {c: ("long" if c in SIMPLE_SPEED_BINS else "double") for c in ROLLUP_COLUMNS}
ROLLUP_TYPES.update({"imei": "string", "VIN": "string", "valid_start": "long", "valid_end": "long",
                     "first_time": "int", "last_time": "int", "valid_days": "long", "no_trip": "long",
                     "dura": "long", "dura_valid": "long"})

J3_JOIN = f"""
j3_join AS (SELECT v.imei, v.VIN, v.valid_start_utc, v.valid_end_utc, j1.imei AS imei_1, j1.* EXCLUDE (imei),
              {day_key("j1.tripnumber", "%Y-%m-%d")} AS day
            FROM validity v JOIN j1 ON v.imei = j1.imei AND v.valid_start_utc <= j1.tripnumber
             AND v.valid_end_utc >= j1.end_time),
j3_speed AS (SELECT *,
    ({" + ".join(f"{n}*{10 * k + 5}" for k, n in enumerate(SIMPLE_SPEED_BINS[1:-1]))} + speed_200_Inf*205)
      / NULLIF(dura_valid, 0) AS speed_mean,
    mileage*3600 / NULLIF(end_time - start_time, 0) AS speed
    FROM j3_join),
j3_ok AS (SELECT * FROM j3_speed WHERE speed / NULLIF(speed_mean, 0) <= 1.5e0),
j3 AS (SELECT imei, VIN, min(valid_start_utc) AS valid_start, max(valid_end_utc) AS valid_end,
    min(tripnumber) AS first_time, max(tripnumber) AS last_time,
    CAST(count(DISTINCT day) AS BIGINT) AS valid_days, CAST(count(DISTINCT tripnumber) AS BIGINT) AS no_trip,
    CAST(sum(dura) AS BIGINT) AS dura, CAST(sum(dura_valid) AS BIGINT) AS dura_valid, sum(mileage) AS mileage,
    {", ".join(f"sum({c}) AS {c}" for c in SIMPLE_HOURS)},
    {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in SIMPLE_SPEED_BINS)}
    FROM j3_ok GROUP BY imei, VIN)
"""


def _csv_field(c: str, t: str) -> str:
    if t == "double":
        return f"COALESCE(printf('%.9f', round({c}, 9)), '')"
    return f"COALESCE(CAST({c} AS VARCHAR), '')"


J2_TRUNC_JOIN = """
j2t AS (SELECT g.imei, t.tid, t.vid, t.start AS tripnumber,
               CAST(trunc(g.time_stamp/1000e0) AS INTEGER) AS time_stamp,
               g.lat, g.lon, g.direction AS heading, g.speed
        FROM gps_points g JOIN trip_stat t
          ON g.imei = t.deviceid AND CAST(trunc(g.time_stamp/1000e0) AS INTEGER) >= t.start
         AND CAST(trunc(g.time_stamp/1000e0) AS INTEGER) <= t.s_end)
"""


def oracle_sql() -> dict[str, str]:
    j1_full = [J1_ROWS, _j1_agg()]
    j1_daily = [by_day(J1_ROWS), by_day(_j1_agg())]
    kin = [J2_ROWS]
    return {
        "scan_trips": q([], ["tid", "vid", "deviceid", "start", "s_end", "stat_date"], "trip_days"),
        "trips_per_day": with_ctes(FIXTURES, """r AS (SELECT min(strptime(stat_date, '%Y%m%d')) AS a, max(strptime(stat_date, '%Y%m%d')) AS b FROM trip_days),
d AS (SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y%m%d') AS stat_date FROM r)""")
                         + "\nSELECT d.stat_date, count(t.start) AS trips FROM d LEFT JOIN trip_days t USING (stat_date) GROUP BY ALL",
        "scan_points": q([f"""s AS (SELECT imei, lat, lon, lat AS alat, lon AS alon, speed, direction,
                               0 AS altitude, 1e0 AS pdop, time_stamp, 1 AS protocal_type,
                               {day_key('time_stamp/1000e0')} AS stat_date FROM gps_points)"""],
                         ["imei", "lat", "lon", "alat", "alon", "speed", "direction", "altitude", "pdop",
                          "time_stamp", "protocal_type", "stat_date"], "s",
                         altitude="int", time_stamp="long", protocal_type="int"),
        "date_range_backfill": with_ctes(FIXTURES, *j1_daily) + "\n"
                               + present({**SIMPLE_TYPES, "stat_date": "string"}, "j1"),
        "trip_points": q([J1_ROWS], TRIP_ROW_COLS, "j1_join"),
        "trip_points_trunc": q([J2_TRUNC_JOIN], J2_ROW_COLS, "j2t", time_stamp="int"),
        "trip_points_outer": q([f"""o AS (SELECT t.tid, t.vid, t.start AS tripnumber, t.s_end, g.imei, g.lat, g.lon,
                                      g.speed, g.direction, g.time_stamp/1000e0 AS time_stamp
                                      FROM gps_points g RIGHT JOIN (SELECT * FROM trip_stat WHERE start > 0) t
                                        ON g.imei = t.deviceid AND g.time_stamp/1000e0 >= t.start
                                       AND g.time_stamp/1000e0 <= t.s_end)"""], TRIP_ROW_COLS, "o"),
        "cohort_trips": q(["ct AS (SELECT tid, vid, deviceid, start, s_end FROM trip_stat "
                           "WHERE deviceid IN (SELECT imei FROM cohort))"],
                          ["tid", "vid", "deviceid", "start", "s_end"], "ct"),
        "point_distance": q([J1_ROWS], DIST_COLS, "j1_dist"),
        "jump_filter": q([J1_ROWS], DIST_COLS, "j1_kept"),
        "trip_hour_mileage": q(j1_full, ["imei", "vid", "tripnumber", "mileage", *SIMPLE_HOURS], "j1"),
        "trip_speed_hist": q(j1_full, ["imei", "vid", "tripnumber", *SIMPLE_SPEED_BINS], "j1",
                             **{n: "long" for n in SIMPLE_SPEED_BINS}),
        "simple_trip_features": q_simple_trip_features(),
        "validity_join": q(j1_daily + [J3_JOIN], ["imei", "VIN", "valid_start_utc", "valid_end_utc", "imei_1",
                                                 "vid", "tripnumber", "start_time", "end_time", "dura",
                                                 "dura_valid", "mileage", "day"], "j3_join"),
        "plausible_trips": q(j1_daily + [J3_JOIN], ["imei", "VIN", "imei_1", "tripnumber", "speed_mean", "speed"],
                             "j3_ok"),
        "vehicle_rollup": with_ctes(FIXTURES, *j1_daily, J3_JOIN) + "\n" + present(ROLLUP_TYPES, "j3"),
        "vehicle_csv_line": with_ctes(FIXTURES, *j1_daily, J3_JOIN) + "\nSELECT concat_ws(',', "
                            + ", ".join(_csv_field(c, ROLLUP_TYPES[c]) for c in ROLLUP_COLUMNS)
                            + ") AS df_concat FROM j3",
        "clean_points": q(kin, J2_ROW_COLS, "j2_kin", time_stamp="int"),
        "clean_distance": q(kin, ["imei", "tripnumber", "time_stamp", "lat", "lon", "am", "hour"], "j2_kin",
                            time_stamp="int"),
        "kinematics": q(kin, ["imei", "tripnumber", "time_stamp", "lat", "lon", "speed_cal", "heading_cal",
                              "tan_acc", "norm_acc", "gps_acc"], "j2_kin", time_stamp="int"),
        "turn_rate": q(kin, ["imei", "tripnumber", "time_stamp", "lat", "lon", "angle_delta",
                             "angle_cal_delta"], "j2_kin", time_stamp="int"),
        "complex_trip_head": j2_query(COMPLEX_HEAD),
        "complex_hour_mileage": j2_query(["imei", "tripnumber", *COMPLEX_HOURS]),
        "complex_speed_hist": j2_query(["imei", "tripnumber", *COMPLEX_SPEED_BINS]),
        "speed_stats": j2_query(["imei", "tripnumber", *COMPLEX_SPEED_STATS]),
        "acc_stats": j2_query(["imei", "tripnumber", *COMPLEX_ACC_STATS]),
        "norm_stats": j2_query(["imei", "tripnumber", *COMPLEX_NORM_STATS]),
        "turn_runs": j2_query(["imei", "tripnumber", *TURN_RUN_COLS]),
        "turn_speed_stats": j2_query(["imei", "tripnumber", *TURN_SPEED_COLS]),
        "acc_bin_runs": j2_query(["imei", "tripnumber", *COMPLEX_ACC_RUNS]),
        "norm_bin_runs": j2_query(["imei", "tripnumber", *COMPLEX_NORM_RUNS]),
        "simple_trip_features": q_simple_trip_features(),
        "complex_trip_features": j2_query(COMPLEX_COLUMNS),
        "complex_date_range_backfill": j2_query(COMPLEX_COLUMNS, daily=True),
        "resumed_backfill": with_ctes(FIXTURES, *j1_daily, f"""
day_bounds AS (SELECT min(d) AS a, max(d) AS b FROM (SELECT stat_date AS d FROM trip_days
               UNION ALL SELECT {day_key('time_stamp/1000e0')} FROM gps_points) x),
all_days AS (SELECT strftime(strptime(a, '%Y%m%d') + to_days(CAST(i AS INTEGER)), '%Y%m%d') AS stat_date FROM day_bounds,
             unnest(generate_series(0, date_diff('day', strptime(a, '%Y%m%d'), strptime(b, '%Y%m%d')))) u(i))""")
        + "\nSELECT stat_date, 'done' AS status, (SELECT count(*) FROM j1 WHERE j1.stat_date = all_days.stat_date) AS n_rows FROM all_days",
        "checked_trips": with_ctes(FIXTURES) + "\nSELECT tid, vid, deviceid, start, s_end, stat_date FROM trip_days "
                         "WHERE CAST(deviceid AS BIGINT) % 11 NOT IN (3, 5)",
        "rejected_trips": with_ctes(FIXTURES) + "\nSELECT stat_date, CASE WHEN CAST(deviceid AS BIGINT) % 11 = 3 THEN 'not a number' "
                          "ELSE 'too few fields' END AS reason, count(*) AS n_rows FROM trip_days "
                          "WHERE CAST(deviceid AS BIGINT) % 11 IN (3, 5) GROUP BY 1, 2",
        # computed in parts of a trip, the same result
        "complex_trip_features_split": j2_query(COMPLEX_COLUMNS),
        "complex_date_range_backfill_split": j2_query(COMPLEX_COLUMNS, daily=True),
        "scan_points_positional": q([f"""s AS (SELECT imei, lat, lon, lat AS alat, lon AS alon, speed, direction,
                               0 AS altitude, 1e0 AS pdop, time_stamp, 1 AS protocal_type,
                               {day_key('time_stamp/1000e0')} AS stat_date FROM gps_points)"""],
                         ["imei", "lat", "lon", "alat", "alon", "speed", "direction", "altitude", "pdop",
                          "time_stamp", "protocal_type", "stat_date"], "s",
                         altitude="int", time_stamp="long", protocal_type="int"),
    }
