"""Competition distance bands (PF8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band upper limits (metres) of the competition report, in order.
DISTANCE_BANDS = (500, 1000, 5000)
BAND_LABELS = ("under 500", "500 to 1000", "1000 to 5000", "5000 and over")


def distance_band(col: str | Column = "competition_distance") -> Column:
    """Chained CASE; a null distance falls in the last band."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c < DISTANCE_BANDS[0], BAND_LABELS[0])
    for limit, label in zip(DISTANCE_BANDS[1:], BAND_LABELS[1:]):
        expr = expr.when(c < limit, label)
    return expr.otherwise(BAND_LABELS[-1])
