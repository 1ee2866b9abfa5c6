"""Directions and flow vectors."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from . import fixed
from .numbers import finite


def _pick(names: Sequence[str], index: Column) -> Column:
    picked = F.get(F.array(*[F.lit(name) for name in names]), F.pmod(index, F.lit(len(names))))
    return F.when(index.isNotNull(), picked)


def sector8(degrees: Column, names: Sequence[str] = fixed.COMPASS_8) -> Column:
    return _pick(names, ((finite(degrees) + 22.5) / 45.0).cast("int"))


def sector16(degrees: Column, names: Sequence[str] = fixed.COMPASS_16) -> Column:
    """Sixteen sectors; an angle on a border goes to the even sector."""
    return _pick(names, F.bround(finite(degrees) / 22.5).cast("int"))


def sector16_up(degrees: Column, names: Sequence[str] = fixed.COMPASS_16_JA) -> Column:
    """Sixteen sectors; an angle on a border goes to the next sector."""
    return _pick(names, F.floor(finite(degrees) / 22.5 + 0.5).cast("int"))


def angle_between(a: Column, b: Column) -> Column:
    """Difference of two directions, 0 to 180 degrees."""
    apart = F.abs((a - b + 360.0) % F.lit(360.0))
    return F.when(apart > 180, 360.0 - apart).otherwise(apart)


def flow_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def flow_direction(u: Column, v: Column) -> Column:
    """Heading of a flow: 0 is north, clockwise."""
    return F.pmod(F.degrees(F.atan2(u, v)) + 360.0, F.lit(360.0))


def knots(metres_per_second: Column) -> Column:
    return metres_per_second * fixed.KNOTS_PER_MS
