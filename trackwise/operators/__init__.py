"""DataFrame -> DataFrame operators (joins, copies, sequence runs)."""

from trackwise.operators.broadcast import size_checked
from trackwise.operators.copies import collapse_copies, expand_copies
from trackwise.operators.range_join import points_in_intervals, points_in_intervals_outer
from trackwise.operators.sequence import filtered_run_start, in_run_at_least, run_start_at_least

__all__ = ["size_checked", "collapse_copies", "expand_copies", "points_in_intervals",
           "points_in_intervals_outer", "filtered_run_start", "in_run_at_least",
           "run_start_at_least"]
