"""Hexagonal binning of coordinates in Column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
CELL_AREA_KM2 = 0.737


def hex_cell(lat: Column, lon: Column, area_km2: float = CELL_AREA_KM2) -> Column:
    """Axial id ``q_r`` of the hexagon that holds the point; null when a coordinate is null.

    Coordinates go through the cylindrical equal-area projection, so every cell covers the same
    area; its shape stretches toward the poles. The nearest centre is found with floors only: the
    expression stays small, which matters because filters and join keys repeat it.
    """
    edge = math.sqrt(2 * area_km2 / (3 * math.sqrt(3)))
    u = F.radians(lon) * (EARTH_RADIUS_KM / edge / math.sqrt(3))
    v = F.sin(F.radians(lat)) * (EARTH_RADIUS_KM / edge)
    stripe = F.floor(u + v + 1)
    column = F.floor((F.floor(u * 2 + 1) + stripe) / 3)
    row = F.floor((stripe + F.floor(v - u + 1)) / 3)
    return F.concat((column - row).cast("string"), F.lit("_"), row.cast("string"))
