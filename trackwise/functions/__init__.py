"""Column -> Column building blocks (geometry, bins, time)."""

from trackwise.functions import binning, geo, timefmt

__all__ = ["binning", "geo", "timefmt"]
