"""Distance on the sphere as Column expressions (no UDF)."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Earth radius in metres used by the bunching rule.
EARTH_RADIUS_M = 6371000.0


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres, atan2 form of the haversine."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dphi / 2), 2)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2))
    return F.lit(EARTH_RADIUS_M) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def unit_vector(lat, lon) -> list[Column]:
    """(x, y, z) of a point on the unit sphere."""
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def cell_size(radius_m: float) -> float:
    return radius_m / EARTH_RADIUS_M * 1.001


def sphere_cells(lat, lon, radius_m: float) -> list[Column]:
    """Integer cell of a point on a 3-D grid over the unit sphere.

    Two points at most ``radius_m`` apart (great circle) have a chord no longer
    than ``radius_m / R``, so each coordinate of their unit vectors differs by
    no more than that; with cells of that size they lie in the same or
    adjacent cells (3 x 3 x 3 neighbourhood).  Works at any latitude, unlike a
    lat/lon grid.  The cell is padded a little against rounding.
    """
    h = cell_size(radius_m)
    return [F.floor(v / F.lit(h)).cast("long") for v in unit_vector(lat, lon)]


NEIGHBOUR_OFFSETS = [(dx, dy, dz) for dx in (-1, 0, 1)
                     for dy in (-1, 0, 1) for dz in (-1, 0, 1)]
# The cell itself plus the 13 offsets that are lexicographically positive:
# every unordered pair of adjacent cells (c, d) has exactly one of d - c and
# c - d in this set, so joining each point's forward cells to the other
# points' own cells meets every nearby pair once (twice within one cell).
FORWARD_OFFSETS = [o for o in NEIGHBOUR_OFFSETS if o >= (0, 0, 0)]


def neighbour_cells(cx: Column, cy: Column, cz: Column, forward: bool = False) -> Column:
    """Array of neighbour cells as structs (cx, cy, cz, own): all 27, or the
    14 forward ones; ``own`` marks the cell itself."""
    offs = FORWARD_OFFSETS if forward else NEIGHBOUR_OFFSETS
    return F.array(*[F.struct((cx + dx).alias("cx"), (cy + dy).alias("cy"),
                              (cz + dz).alias("cz"),
                              F.lit((dx, dy, dz) == (0, 0, 0)).alias("own"))
                     for dx, dy, dz in offs])


def cell_in_reach(cell: list[Column], at: list[Column], radius_m: float) -> Column:
    """Whether a cell can hold a point of the sphere within the radius of ``at`` (a
    unit vector): it is no further away than a cell's size, and the sphere crosses it."""
    h = cell_size(radius_m)
    gap, least, most = [], [], []
    for c, x in zip(cell, at):
        lo, hi = c * F.lit(h), (c + 1) * F.lit(h)
        gap.append(F.pow(F.greatest(lo - x, x - hi, F.lit(0.0)), 2))
        least.append(F.pow(F.greatest(lo, -hi, F.lit(0.0)), 2))
        most.append(F.pow(F.greatest(-lo, hi), 2))
    return ((gap[0] + gap[1] + gap[2] <= F.lit(h * h))
            & (least[0] + least[1] + least[2] <= F.lit(1 + 1e-12))
            & (most[0] + most[1] + most[2] >= F.lit(1 - 1e-12)))
