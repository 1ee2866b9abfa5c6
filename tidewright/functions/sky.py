"""Moon age, moon phase and tide class of a day."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed
from .numbers import one_decimal


def moon_age(day: Column) -> Column:
    """Days since new moon, one decimal."""
    since = (F.unix_date(day).cast("double") + fixed.EPOCH_JULIAN_DAY) - fixed.NEW_MOON_JULIAN_DAY
    return one_decimal(F.pmod(since, F.lit(fixed.SYNODIC_DAYS)))


def moon_phase(age: Column) -> Column:
    return _steps(fixed.MOON_PHASES, lambda bound: age < bound)


def tide_class(age: Column) -> Column:
    return F.when(age >= fixed.SPRING_TIDE_FROM, fixed.TIDE_STEPS[0][1]).otherwise(
        _steps(fixed.TIDE_STEPS, lambda bound: age <= bound))


def _steps(table, holds) -> Column:
    (first, name), *others = table
    chain = F.when(holds(first), name)
    for bound, name in others:
        chain = chain.otherwise(name) if bound is None else chain.when(holds(bound), name)
    return chain
