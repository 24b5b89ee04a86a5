"""Planar geometry on the 100x100 grid (F7) and grid cells for radius joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance."""
    dx = x1 - x2
    dy = y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def grid_cell(v: Column, cell: float) -> Column:
    """Index of the grid cell of width ``cell`` that holds coordinate ``v``."""
    return F.floor(v / F.lit(float(cell))).cast("bigint")
