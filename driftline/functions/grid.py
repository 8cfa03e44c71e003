"""The threshold grid and the mapping from a score to its grid cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 91 evenly spaced thresholds from 0.05 to 0.95.
GRID_LOW = 0.05
GRID_HIGH = 0.95
GRID_POINTS = 91

_STEP = (GRID_HIGH - GRID_LOW) / (GRID_POINTS - 1)


def grid_value(i: Column) -> Column:
    """i-th threshold, bit-equal to an evenly spaced double grid."""
    return F.lit(GRID_LOW) + i.cast("double") * F.lit(_STEP)


def grid_cell(score: Column) -> Column:
    """Number of grid points <= score (0..GRID_POINTS).

    An arithmetic guess corrected by comparing with the two neighbouring grid points, so the
    result is exact without a join against the grid.
    """
    guess = F.floor((score - F.lit(GRID_LOW)) / F.lit(_STEP)).cast("int")
    guess = F.least(F.greatest(guess, F.lit(-1)), F.lit(GRID_POINTS - 1))
    up = ((guess + 1 < GRID_POINTS) & (grid_value(guess + 1) <= score)).cast("int")
    down = ((guess >= 0) & (grid_value(guess) > score)).cast("int")
    return guess + 1 + up - down
