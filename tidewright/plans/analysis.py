"""All statistics of a catch table, one DataFrame per section."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..operators import profile, score, timeline, trend
from ..operators.enrich import record_export


@dataclass
class Columns:
    """Names of the columns the analysis reads."""

    day: str = "day"
    species: str = "species"
    count: str = "count"
    weight: str = "weight_kg"
    size: str = "size_cm"
    tide: str = "潮汐"
    weather: str = "天気"
    moon: str = "月相"
    method: str = "method"
    water: str = "室戸沖_水温"
    other_water: str = "水温(Open-Meteo)"
    speed: str = "室戸沖_流速kn"
    heading: str = "室戸沖_流向"


def analyse(catch: DataFrame, conditions: DataFrame, current: DataFrame, station: str, point: str,
            columns: Columns = Columns(), metrics: Sequence[str] = tuple(fixed.PROFILE_METRICS)
            ) -> dict[str, DataFrame]:
    """Sections of the analysis, all lazy.

    catch: typed wide rows (``day`` a date, metrics doubles). conditions: station,
    day, water, wave, tide, moon, phase. current: point, day, speed, temp,
    salinity, direction. Both have one row per key.
    """
    c = columns
    group = [c.species]
    numbers = [*metrics, c.size, c.weight, c.count]
    catch = catch.where(F.coalesce(F.col(c.species), F.lit("")) != "")
    headline = profile.headline(catch, c.species, c.day)
    known = catch.join(headline.select(c.species), c.species, "left_semi")

    labels = trend.calendar_trend(conditions, "station", "day", "water")
    speeds = trend.calendar_trend(current, "point", "day", "speed", fixed.SPEED_TREND, 3)
    at_station = labels.where(F.col("station") == station).withColumnRenamed("day", c.day)
    at_point = speeds.where(F.col("point") == point).withColumnRenamed("day", c.day)
    flows = current.withColumnRenamed("day", c.day)

    summaries = profile.summary(profile.metrics_long(known, group, numbers), [*group, "metric"])
    point_numbers, point_sectors = profile.point_profiles(
        known, flows, c.species, c.day, "point", "speed", "temp", "salinity", "direction")
    label_shares = profile.label_shares(known, at_station, c.species, c.day, "label")
    tide_shares = profile.frequency(known, group, c.tide)

    def number(metric: str, name: str):
        return F.max(F.when(F.col("metric") == metric, F.col(name)))

    profiles = summaries.groupBy(*group).agg(
        *[number(c.water, s).alias(f"water_{s}") for s in ("mean", "std", "p25", "p75")],
        number("月齢", "mean").alias("moon_mean"), number("月齢", "std").alias("moon_std"),
        number("最大波高", "p75").alias("wave_p75"))
    shares = tide_shares.withColumnRenamed(c.tide, "tide")
    return {
        "headline": headline,
        "summaries": summaries,
        "tide_shares": tide_shares,
        "weather_shares": profile.frequency(known, group, c.weather),
        "moon_shares": profile.frequency(known, group, c.moon),
        "method_shares": profile.frequency(known, group, c.method),
        "month_totals": profile.month_totals(known, group, c.day, c.count),
        "water_bins": profile.width_bins(known, group, c.water, c.other_water),
        "speed_bins": profile.edge_bins(known, group, c.speed),
        "heading_shares": profile.sector_shares(known, group, c.heading),
        "point_summaries": point_numbers,
        "point_sectors": point_sectors,
        "water_trend_shares": label_shares,
        "speed_trend_shares": profile.label_shares(known, at_point, c.species, c.day, "label"),
        "baseline": profile.summary(profile.metrics_long(catch, [], metrics), ["metric"]),
        "baseline_tides": profile.frequency(catch, [], c.tide),
        "baseline_weather": profile.frequency(catch, [], c.weather),
        "station_water": profile.summary(conditions, ["station"], "water"),
        "predictions": score.suitability(conditions, labels, profiles, label_shares, shares,
                                         "station", "day", c.species, [station],
                                         speeds=current.where(F.col("point") == point).select(
                                             "day", "speed")),
        "timeline": timeline.timeline(
            conditions, current, catch.withColumnRenamed(c.day, "day"), "station", "day", "point",
            station, point, c.species, c.weight),
        "big_thresholds": profile.big_thresholds(catch, c.species, c.weight),
        "monthly": profile.month_means(
            current, "day", "point",
            {"avg_speed_kn": "speed", "avg_temp_c": "temp", "avg_salinity": "salinity",
             "avg_direction": "direction"}, 2, "speed"),
        "records": record_export(catch, at_station, c.species, c.day, c.count, "label"),
        "species": profile.distinct_sorted(catch, c.species),
        "methods": profile.distinct_sorted(catch, c.method),
        "table_counts": profile.table_counts(conditions, "station", "day"),
    }


def for_boats(catch: DataFrame, boats: Sequence[str], boat: str = "boat_id") -> DataFrame:
    """The rows of some boats only."""
    return catch.where(F.col(boat).isin(*boats))
