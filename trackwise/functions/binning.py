"""Interval bins, conditional-count families and quantile blocks.

Bounds are generated from (min, max, gap) the way an arithmetic sequence
``from + i * by`` (clamped to ``to``) produces them, so bin edges are the
exact doubles of the feature definition, e.g. 3 * 0.05 = 0.15000000000000002.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = math.inf

# Probabilities of the 11-point quantile block: 0, 0.1, ..., 1.
QUANTILE_PROBS = [i / 10 for i in range(11)]


def arith_seq(start: float, stop: float, step: float) -> list[float]:
    """start + i*step for i = 0..n with n = int(span/step + 1e-10), clamped to stop."""
    n = int((stop - start) / step + 1e-10)
    vals = [start + i * step for i in range(n + 1)]
    return [min(v, stop) for v in vals] if step > 0 else [max(v, stop) for v in vals]


def interval_bounds(lo: float, hi: float, gap: float, below: bool = False,
                    above: bool = False) -> list[tuple[float, float]]:
    """Intervals (a, b] of width ``gap`` over [lo, hi]; ``below`` adds (-Inf, lo],
    ``above`` adds (hi, Inf]. Lower and upper ends are two sequences, each between
    its own finite ends, so neighbours may differ by one unit in the last place."""
    lower = arith_seq(lo, hi if above else hi - gap, gap)
    upper = arith_seq(lo if below else lo + gap, hi, gap)
    if below:
        lower = [-INF, *lower]
    if above:
        upper = [*upper, INF]
    return list(zip(lower, upper))


def sql_double(v: float) -> str:
    """Exact SQL text of a double (shortest round-trip digits, D suffix)."""
    return f"{float(v)!r}D"


def interval_sql(x: str, a: float, b: float) -> str:
    """SQL condition x in (a, b]; infinite ends are left open."""
    conds = []
    if a != -INF:
        conds.append(f"`{x}` > {sql_double(a)}")
    if b != INF:
        conds.append(f"`{x}` <= {sql_double(b)}")
    return " AND ".join(conds) or "TRUE"


# The generated families below are built as SQL text: one expression per
# output column is one call into the JVM, where building the same trees
# from Column objects costs one call per node.

def bin_index(x: str, bounds: list[tuple[float, float]]) -> Column:
    """Index of the first interval (a, b] holding column ``x``; -1 when none does
    (the one-ulp gaps between bounds), NULL for NULL."""
    whens = " ".join(f"WHEN {interval_sql(x, a, b)} THEN {i}" for i, (a, b) in enumerate(bounds))
    return F.expr(f"CASE {whens} WHEN `{x}` IS NOT NULL THEN -1 END")


def count_in_intervals(x: str, bounds, names: list[str]) -> list[Column]:
    """One count per interval (a, b] of column ``x``, as BIGINT aggregates."""
    return [F.expr(f"count_if({interval_sql(x, a, b)}) AS `{n}`") for (a, b), n in zip(bounds, names)]


def ceil_bin_counts(x: str, weight: str, names: list[str], width: float = 10.0) -> list[Column]:
    """Counts by ceil(x / width) == k for k = 0..len(names)-2, then x > (len-2)*width.

    NULL x counts nowhere. Column ``weight`` is the number of rows a row stands for.
    """
    top = len(names) - 2
    k = f"ceil(`{x}` / {sql_double(width)})"
    cols = [F.expr(f"CAST(sum(CASE WHEN {k} = {i} THEN `{weight}` ELSE 0 END) AS BIGINT) AS `{n}`")
            for i, n in enumerate(names[:-1])]
    cols.append(F.expr(f"CAST(sum(CASE WHEN `{x}` > {sql_double(top * width)} THEN `{weight}` ELSE 0 END)"
                       f" AS BIGINT) AS `{names[-1]}`"))
    return cols


def sums_by_value(x: str, key: str, values, names: list[str]) -> list[Column]:
    """sum(x where key = v, else 0) for each v: e.g. distance per hour of day."""
    return [F.expr(f"sum(CASE WHEN `{key}` = {v} THEN `{x}` ELSE 0D END) AS `{n}`")
            for v, n in zip(values, names)]


def quantiles_sql(x: str) -> str:
    """SQL text of :func:`quantiles` over the expression ``x``."""
    probs = ", ".join(sql_double(p) for p in QUANTILE_PROBS)
    return f"percentile({x}, array({probs}))"


def quantile_columns(arr: str, names: list[str]) -> list[Column]:
    """Spread the quantile array column ``arr`` into its 11 named columns."""
    return [F.expr(f"`{arr}`[{i}] AS `{n}`") for i, n in enumerate(names)]
