"""Geometry and kinematics as Spark SQL expressions.

Each function takes SQL expression text for its inputs (a column name is
valid SQL text) and returns a Column; the ``*_sql`` builders return the text
itself so larger expressions compose without a round trip to the JVM per
node. Everything compiles to JVM expressions (whole-stage codegen); there is
no Python on the executors. Operation order follows the job definitions so
results agree bit-for-bit where only IEEE basic operations are involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feature definitions.
EARTH_RADIUS_KM = 6378.178
GRAVITY = 9.8
PI = math.pi


def _d(v: float) -> str:
    """Exact SQL double literal."""
    return f"{float(v)!r}D"


def rad_sql(x: str) -> str:
    """Degrees to radians as x * pi / 180 (same rounding as the definition)."""
    return f"(({x}) * {_d(PI)} / 180D)"


def gps_dist_sql(lat: str, lon: str, lat0: str, lon0: str) -> str:
    """Great-circle (haversine) distance in km between (lat, lon) and (lat0, lon0):
    2 R asin(sqrt(cos(lat0) cos(lat) sin^2((lon-lon0)/2) + sin^2((lat-lat0)/2))).
    NULL where that is not a number (coordinates out of range, e.g. a latitude over 90)."""
    la, lo, la0, lo0 = rad_sql(lat), rad_sql(lon), rad_sql(lat0), rad_sql(lon0)
    s1 = f"sin(({lo} - {lo0}) / 2D)"
    s2 = f"sin(({la} - {la0}) / 2D)"
    inner = f"cos({la0}) * cos({la}) * ({s1} * {s1}) + ({s2} * {s2})"
    return f"nanvl(asin(sqrt({inner})) * 2D * {_d(EARTH_RADIUS_KM)}, CAST(NULL AS DOUBLE))"


def planar_offset_sql(lat: str, lon: str, lat0: str, lon0: str) -> tuple[str, str]:
    """Local planar offset (km) of (lat, lon) from the origin (lat0, lon0).

    X runs east along the origin's parallel, Y north along its meridian; the
    signs come from the coordinate differences.
    """
    y_dist = gps_dist_sql(lat, lon0, lat0, lon0)
    x_dist = gps_dist_sql(lat0, lon, lat0, lon0)
    return (f"({x_dist} * signum(({lon}) - ({lon0})))",
            f"({y_dist} * signum(({lat}) - ({lat0})))")


def velocity_sql(lat: str, lon: str, lat0: str, lon0: str, dt: str) -> tuple[str, str]:
    """Offset of (lat, lon) from (lat0, lon0) in metres per second of dt;
    dt = 0 yields NULL components (division by zero has no value here)."""
    x, y = planar_offset_sql(lat, lon, lat0, lon0)
    d = f"nullif(CAST(({dt}) AS DOUBLE), 0D)"
    return f"({x} * 1000D / {d})", f"({y} * 1000D / {d})"


def norm_sql(x: str, y: str) -> str:
    return f"sqrt(({x}) * ({x}) + ({y}) * ({y}))"


def heading_sql(x: str, y: str) -> str:
    """Clockwise angle from north in degrees for the vector (x, y); NULL for (0, 0)."""
    angle = (f"CASE WHEN ({x}) > 0 THEN {_d(PI / 2)} - atan(({y}) / ({x}))"
             f" WHEN ({x}) < 0 THEN {_d(3 * PI / 2)} - atan(({y}) / ({x}))"
             f" WHEN ({x}) = 0 AND ({y}) > 0 THEN 0D"
             f" WHEN ({x}) = 0 AND ({y}) < 0 THEN {_d(PI)} END")
    return f"(({angle}) * 180D / {_d(PI)})"


def wrap_sql(d: str) -> str:
    """Heading change folded into [-180, 180]: |d| > 180 -> d - sign(d) * 360."""
    return f"(CASE WHEN abs({d}) > 180 THEN ({d}) - signum({d}) * 360D ELSE CAST(({d}) AS DOUBLE) END)"


def normal_acc_over_radius_sql(ax: str, ay: str, cx: str, cy: str, speed2: str) -> str:
    """speed2 / R for the circle through A, the origin B and C.

    R follows the circumcentre construction. When the three points are
    collinear (D = 0) the radius is infinite if both centre numerators are
    non-zero, giving 0, and undefined otherwise, giving NULL.
    """
    a2 = f"({ax} * {ax} + {ay} * {ay})"
    c2 = f"({cx} * {cx} + {cy} * {cy})"
    # B = (0, 0): the general D / Ux / Uy terms with B's coordinates dropped.
    d = f"(2D * ({ax} * (0D - {cy}) + {cx} * {ay}))"
    num_ux = f"({a2} * (0D - {cy}) + {c2} * {ay})"
    num_uy = f"({a2} * {cx} + {c2} * (0D - {ax}))"
    ux = f"({num_ux} / nullif({d}, 0D))"
    uy = f"({num_uy} / nullif({d}, 0D))"
    radius = f"sqrt(({ax} - {ux}) * ({ax} - {ux}) + ({ay} - {uy}) * ({ay} - {uy}))"
    return (f"(CASE WHEN {d} = 0 THEN (CASE WHEN {num_ux} <> 0 AND {num_uy} <> 0 THEN 0D END)"
            f" ELSE try_divide({speed2}, {radius}) END)")


# --- Column wrappers ----------------------------------------------------------

def gps_dist(lat: str, lon: str, lat0: str, lon0: str) -> Column:
    return F.expr(gps_dist_sql(lat, lon, lat0, lon0))
