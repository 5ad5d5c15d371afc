"""Input schemas and the generated output column lists of the three jobs.

Column names are part of the output contract, so they are generated here
once from the naming rules and reused by the jobs, the tests and the oracle.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------

# Trip table: comma-delimited text, one directory per day (stat_date=YYYYMMDD).
TRIP_SCHEMA = T.StructType(
    [T.StructField("deviceid", T.StringType()), T.StructField("tid", T.StringType()),
     T.StructField("vid", T.StringType()), T.StructField("start", T.IntegerType()),
     T.StructField("actual_start", T.IntegerType()), T.StructField("s_end", T.IntegerType()),
     T.StructField("dura", T.DoubleType()), T.StructField("period", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in (
        "lat_st_ori", "lon_st_ori", "lat_en_ori", "lon_en_ori", "m_ori",
        "lat_st_def", "lon_st_def", "lat_en_def", "lon_en_def", "m_def",
        "speed_mean", "gps_speed_sd", "gps_acc_sd")]
)
TRIP_COLUMNS = ["tid", "vid", "deviceid", "start", "s_end"]

# GPS points: parquet, one directory per day; time_stamp in epoch milliseconds.
GPS_SCHEMA = T.StructType([
    T.StructField("imei", T.StringType()), T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()), T.StructField("alat", T.DoubleType()),
    T.StructField("alon", T.DoubleType()), T.StructField("speed", T.DoubleType()),
    T.StructField("direction", T.IntegerType()), T.StructField("altitude", T.IntegerType()),
    T.StructField("pdop", T.DoubleType()), T.StructField("time_stamp", T.LongType()),
    T.StructField("protocal_type", T.IntegerType()),
])
# Positional types applied to a file-schema read (character/numeric/integer).
# time_stamp stays epoch milliseconds here; the kinematic job truncates
# time_stamp / 1000 to whole seconds itself.
GPS_POSITIONAL_TYPES = ["string", "double", "double", "double", "double", "double",
                        "int", "int", "double", "bigint", "int"]

COHORT_SCHEMA = T.StructType([T.StructField("imei", T.StringType())])

# ---------------------------------------------------------------------------
# Name rules
# ---------------------------------------------------------------------------

HOURS = range(24)
DECILES = range(10, 100, 10)


# J1 speed histogram: ceil(speed/10) == 0 .. 20, then > 200.
SIMPLE_SPEED_BINS = ["speed_0"] + [f"speed_{10 * k}_{10 * k + 10}" for k in range(20)] + ["speed_200_Inf"]
SIMPLE_HOURS = [f"m_{h}" for h in HOURS]
SIMPLE_KEYS = ["imei", "vid", "tripnumber", "start_time", "end_time", "dura", "dura_valid",
               "lat_st", "lon_st", "lat_end", "lon_end", "mileage"]
SIMPLE_COLUMNS = SIMPLE_KEYS + SIMPLE_HOURS + SIMPLE_SPEED_BINS  # 58

# J3 vehicle roll-up (57 columns, joined into one text line).
ROLLUP_COLUMNS = (["imei", "VIN", "valid_start", "valid_end", "first_time", "last_time",
                   "valid_days", "no_trip", "dura", "dura_valid", "mileage"]
                  + SIMPLE_HOURS + SIMPLE_SPEED_BINS)


def quantile_names(prefix: str, pct_suffix: bool = True) -> list[str]:
    """min, 10..90 and max names of an 11-point quantile block."""
    mid = [f"{prefix}_{d}_pct" if pct_suffix else f"{prefix}_{d}" for d in DECILES]
    return [f"{prefix}_min"] + mid + [f"{prefix}_max"]


def stat_block(prefix: str, pct_suffix: bool = True) -> list[str]:
    return [f"{prefix}_mean", f"{prefix}_sd"] + quantile_names(prefix, pct_suffix)


def run_bin_names(prefix: str) -> list[str]:
    """21 run-count columns: _00_05 ... _95_100, _100_inf."""
    lo = [f"{v:02d}" for v in range(0, 105, 5)]
    hi = [f"{v:02d}" for v in range(5, 105, 5)] + ["inf"]
    return [f"{prefix}_{a}_{b}" for a, b in zip(lo, hi)]


def turn_block(prefix: str) -> list[str]:
    return [f"{prefix}_dura", f"{prefix}_times"] + stat_block(f"{prefix}_speed", pct_suffix=False)


COMPLEX_HEAD = ["imei", "vid", "tripnumber", "start_time", "end_time", "dura", "dura_valid",
                "lat_st", "lon_st", "lat_end", "lon_end", "fly_dist", "curv_overall", "mileage"]
COMPLEX_HOURS = [f"m_{h}_{h + 1}" for h in HOURS]
COMPLEX_SPEED_STATS = stat_block("speed") + ["speed_0", "speed_mean_drive", "speed_sd_drive"]
COMPLEX_SPEED_BINS = [f"speed_{10 * k}_{10 * k + 10}" for k in range(20)] + ["speed_200_Inf"]
COMPLEX_ACC_STATS = (stat_block("acc_overall")
                     + ["acc_pos_dura", "acc_neg_dura", "acc_pos_mean", "acc_neg_mean",
                        "acc_pos_sd", "acc_neg_sd"]
                     + quantile_names("acc_pos") + quantile_names("acc_neg"))
COMPLEX_ACC_RUNS = run_bin_names("acc_pos") + run_bin_names("acc_neg")
COMPLEX_TURN = turn_block("turn") + turn_block("turn_left") + turn_block("turn_right")
COMPLEX_NORM_STATS = (stat_block("turn_overall")
                      + ["turn_right_mean", "turn_left_mean", "turn_right_sd", "turn_left_sd"]
                      + quantile_names("turn_right") + quantile_names("turn_left"))
COMPLEX_NORM_RUNS = run_bin_names("turn_right") + run_bin_names("turn_left")

COMPLEX_COLUMNS = (COMPLEX_HEAD + COMPLEX_HOURS + COMPLEX_SPEED_STATS + COMPLEX_SPEED_BINS
                   + COMPLEX_ACC_STATS + COMPLEX_ACC_RUNS + COMPLEX_TURN
                   + COMPLEX_NORM_STATS + COMPLEX_NORM_RUNS)  # 284

assert len(SIMPLE_COLUMNS) == 58, len(SIMPLE_COLUMNS)
assert len(ROLLUP_COLUMNS) == 57, len(ROLLUP_COLUMNS)
assert len(COMPLEX_COLUMNS) == 284, len(COMPLEX_COLUMNS)
assert len(set(COMPLEX_COLUMNS)) == 284

# Output types of the kinematic table: ids text, times whole seconds,
# counts BIGINT, everything measured DOUBLE.
COMPLEX_COUNT_COLUMNS = (
    ["dura_valid", "speed_0", "acc_pos_dura", "acc_neg_dura"] + COMPLEX_SPEED_BINS
    + COMPLEX_ACC_RUNS + COMPLEX_NORM_RUNS
    + [f"{p}_{s}" for p in ("turn", "turn_left", "turn_right") for s in ("dura", "times")])


def complex_type(name: str) -> str:
    if name in ("imei", "vid"):
        return "string"
    if name in ("tripnumber", "start_time", "end_time", "dura"):
        return "int"
    if name in COMPLEX_COUNT_COLUMNS:
        return "long"
    return "double"


COMPLEX_TYPES = {c: complex_type(c) for c in COMPLEX_COLUMNS}


def simple_type(name: str) -> str:
    if name in ("imei", "vid"):
        return "string"
    if name in ("tripnumber", "dura"):
        return "int"
    return "long" if name == "dura_valid" or name in SIMPLE_SPEED_BINS else "double"


def _struct(types: dict[str, str]) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(c, kinds[t]) for c, t in types.items()])


#: the feature datasets as written (and read again, with stat_date)
SIMPLE_SCHEMA = _struct({c: simple_type(c) for c in SIMPLE_COLUMNS})
COMPLEX_SCHEMA = _struct(COMPLEX_TYPES)
