"""Sequence operators over one ordered window (a trip).

All helpers are expressed with lag/lead over the *same* window
specification, so Spark evaluates them after a single exchange and a single
sort; none needs a second partitioning or an island table:

* runs of a state of length >= k: a row is inside one iff some k-row slice
  containing it is all that state (offsets -(k-1) .. k-1);
* runs over a *filtered* subsequence (e.g. only rows with x > 0): lag/lead
  with IGNORE NULLS skip the rows that are not in the subsequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _shift(col: str, k: int, w: WindowSpec, ignore_nulls: bool = False) -> Column:
    """Value k rows later (k > 0) or earlier (k < 0); k = 0 is the row itself."""
    if k == 0:
        return F.col(col)
    fn = "lead" if k > 0 else "lag"
    if ignore_nulls:
        return F.expr(f"{fn}(`{col}`, {abs(k)}) IGNORE NULLS").over(w)
    return (F.lead(col, k) if k > 0 else F.lag(col, -k)).over(w)


def in_run_at_least(state: str, value: str, k: int, w: WindowSpec) -> Column:
    """True on rows whose maximal run of ``state == value`` has >= k rows."""
    is_v = lambda off: _shift(state, off, w).eqNullSafe(F.lit(value))
    slices = []
    for first in range(-(k - 1), 1):
        cond = None
        for off in range(first, first + k):
            c = is_v(off)
            cond = c if cond is None else cond & c
        slices.append(cond)
    any_slice = slices[0]
    for s in slices[1:]:
        any_slice = any_slice | s
    return any_slice


def run_start_at_least(state: str, value: str, k: int, w: WindowSpec) -> Column:
    """True on the first row of each maximal run of ``state == value`` with >= k rows."""
    cond = ~_shift(state, -1, w).eqNullSafe(F.lit(value))
    for off in range(0, k):
        cond = cond & _shift(state, off, w).eqNullSafe(F.lit(value))
    return cond


def filtered_run_start(bin_col: str, k: int, w: WindowSpec) -> Column:
    """Start of a run of equal ``bin_col`` values with >= k members, counted
    over the subsequence of rows where ``bin_col`` is not NULL.

    Rows outside the subsequence (NULL bin) are skipped, so members separated
    only by such rows are adjacent, as when the subsequence is filtered out
    first and then scanned.
    """
    b = F.col(bin_col)
    prev = _shift(bin_col, -1, w, ignore_nulls=True)
    cond = b.isNotNull() & ~prev.eqNullSafe(b)
    for off in range(1, k):
        cond = cond & _shift(bin_col, off, w, ignore_nulls=True).eqNullSafe(b)
    return cond


# --- runs over a filtered subsequence that is cut into parts -----------------
#
# Inside a part :func:`filtered_run_start` sees the part alone. Only a part's first
# and last member can be judged otherwise by the whole sequence, and what that takes
# are the first two and the last two members of every part: run counts are corrected
# from a table with one row a part.

def edge_neighbours(bin_col: str, w: WindowSpec) -> list[Column]:
    """The member before and after a row within its part (NULL at the part's ends)."""
    return [_shift(bin_col, -1, w, ignore_nulls=True).alias(f"{bin_col}_before"),
            _shift(bin_col, 1, w, ignore_nulls=True).alias(f"{bin_col}_after")]


def part_edges(bin_col: str) -> list[Column]:
    """Aggregates over a part: its first two and last two members (NULL: none)."""
    b, before, after = f"`{bin_col}`", f"`{bin_col}_before`", f"`{bin_col}_after`"
    first, last = f"{b} IS NOT NULL AND {before} IS NULL", f"{b} IS NOT NULL AND {after} IS NULL"
    return [F.expr(f"max(CASE WHEN {cond} THEN {x} END)").alias(f"{bin_col}{name}") for cond, x, name in
            ((first, b, "_first"), (first, after, "_second"), (last, b, "_final"), (last, before, "_prior"))]


def edge_corrections(edges: DataFrame, key: list[str], part: str, thresholds: dict[str, int]) -> DataFrame:
    """Per part and bin column what its first and last member add to the run counts of
    their bins (``<bin>_add_first``, ``<bin>_add_final``). ``edges`` has :func:`part_edges`
    of the columns in ``thresholds``, whose runs count from 1 or 2 members on; parts
    without members are passed over."""
    if not set(thresholds.values()) <= {1, 2}:
        raise ValueError("runs of a sequence in parts are counted from 1 or 2 members on")
    w = Window.partitionBy(*key).orderBy(part)
    earlier, later = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    carried = edges.select("*", *[c for b in thresholds for c in (
        F.last(f"{b}_final", ignorenulls=True).over(earlier).alias(f"{b}_carried"),
        F.first(f"{b}_first", ignorenulls=True).over(later).alias(f"{b}_coming"))])
    out = []
    for b, k in thresholds.items():
        goes_on = f"{b}_carried <=> {b}_first"
        if k == 1:
            first, final = f"CASE WHEN {b}_first IS NOT NULL AND {goes_on} THEN -1 ELSE 0 END", "0"
        else:
            first = (f"CASE WHEN {b}_first IS NULL THEN 0 "
                     f"WHEN {b}_second IS NULL THEN IF(NOT ({goes_on}) AND {b}_coming <=> {b}_first, 1, 0) "
                     f"ELSE IF({b}_second = {b}_first AND {goes_on}, -1, 0) END")
            final = f"IF({b}_prior IS NOT NULL AND {b}_prior <> {b}_final AND {b}_coming <=> {b}_final, 1, 0)"
        out += [F.expr(first).alias(f"{b}_add_first"), F.expr(final).alias(f"{b}_add_final")]
    return carried.select("*", *out)


def added_runs(bin_col: str, i: int) -> str:
    """SQL sum of the corrections of bin ``i``."""
    return (f"sum(CASE WHEN `{bin_col}_first` = {i} THEN {bin_col}_add_first ELSE 0 END "
            f"+ CASE WHEN `{bin_col}_final` = {i} THEN {bin_col}_add_final ELSE 0 END)")
