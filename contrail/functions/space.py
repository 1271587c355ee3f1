"""A sort key for positions: near places get near keys, so sorted files hold small areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16


def _cell(x: Column, low: float, high: float) -> Column:
    """Number of the slice of [low, high] that holds ``x``, the ends' for what lies outside or is missing."""
    slices = 1 << BITS
    at = F.floor((F.coalesce(x, F.lit(low)) - low) / (high - low) * slices)
    return F.greatest(F.least(at, F.lit(slices - 1)), F.lit(0)).cast("bigint")


def _apart(x: Column) -> Column:
    """The 16 bits of ``x`` with a free place before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def space_key(latitude: str | Column = "latitude", longitude: str | Column = "longitude") -> Column:
    """The bits of latitude and longitude in turn (a Z-order curve), about 300 m by 600 m a cell."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (latitude, longitude))
    return F.shiftleft(_apart(_cell(lat, -90.0, 90.0)), 1).bitwiseOR(_apart(_cell(lon, -180.0, 180.0)))
