"""Suitability of days for species, and go / no-go of forecast hours."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import compass, fixed
from ..functions.numbers import finite, js_round, round_columns
from .trend import last_days


def suitability(conditions: DataFrame, labels: DataFrame, profiles: DataFrame,
                label_shares: DataFrame, tide_shares: DataFrame, station: str, day: str,
                species: str, stations: Sequence[str], days: int = 30,
                speeds: DataFrame | None = None) -> DataFrame:
    """Score of every species on each of the last days of some stations.

    conditions: station, day, water, wave, tide, moon; labels: station, day, label,
    change1, change7 (of the water since the day and the week before); speeds: day,
    speed of the current, one row per day; profiles: one row per species with water_mean, water_std, water_p25, water_p75,
    moon_mean, moon_std and wave_p75; the shares are percentages by species and
    label or tide. A mean, deviation or quartile of zero counts as missing.
    """
    keys = [station, day]
    recent = (last_days(conditions.where(F.col(station).isin(*stations)), station, day, days)
              .join(conditions.select(*keys, "water", "wave", "tide", "moon"), keys, "left")
              .join(labels.select(*keys, "label", "change1", "change7"), keys, "left")
              .withColumn("label", F.coalesce("label", F.lit(fixed.UNKNOWN))))
    recent = (recent.withColumn("speed", F.lit(None).cast("double")) if speeds is None
              else recent.join(speeds.select(day, "speed"), day, "left"))
    # Species meet days through station and number of the day, an ordinary equi-join.
    each = (profiles.withColumn(station, F.explode(F.array(*[F.lit(s) for s in stations])))
            .withColumn("_nth", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))))
    rows = (each.join(recent, [station, "_nth"])
            .join(label_shares.select(species, "label", F.col("pct").alias("_label_pct")),
                  [species, "label"], "left")
            .join(tide_shares.select(species, "tide", F.col("pct").alias("_tide_pct")),
                  [species, "tide"], "left"))
    rows = round_columns(rows.withColumns({
        f"_{name}_pts": F.coalesce(F.col(f"_{name}_pct"), F.lit(0.0)) / 100 * 20
        for name in ("label", "tide")}), 1, "_label_pts", "_tide_pts")

    def present(*names: str) -> Column:
        condition = F.lit(True)
        for name in names:
            condition = condition & (F.coalesce(F.col(name), F.lit(0.0)) != 0)
        return condition

    def closeness(value: str, name: str, least_std: float, top: float, slope: float) -> Column:
        z = F.abs(F.col(value) - F.col(f"{name}_mean")) / F.greatest(
            F.col(f"{name}_std"), F.lit(least_std))
        return F.greatest(F.lit(0.0), top - z * slope)

    water = (F.when(F.col("water").isNotNull() & present("water_mean", "water_std"),
                    closeness("water", "water", 0.5, 40.0, 15.0))
             .when(F.col("water").isNotNull() & present("water_p25", "water_p75")
                   & F.col("water").between(F.col("water_p25"), F.col("water_p75")), 30.0)
             .otherwise(0.0))
    moon = F.when(F.col("moon").isNotNull() & present("moon_mean", "moon_std"),
                  closeness("moon", "moon", 1.0, 10.0, 4.0)).otherwise(0.0)
    wave = F.when(F.col("wave").isNotNull() & present("wave_p75")
                  & (F.col("wave") <= F.col("wave_p75")), 10.0).otherwise(0.0)
    score = water + F.col("_label_pts") + F.col("_tide_pts") + moon + wave
    raw = rows.select(station, day, species, score.alias("score"), "water", "tide", "label",
                      "speed", "wave", "change1", "change7")
    return round_columns(round_columns(raw, 1, "score"), 2, "water", "speed", "wave", "change1",
                         "change7")


def go_criteria(document: Mapping | None = None) -> dict:
    """The go / no-go criteria, each one replaced where a document has a value."""
    criteria = dict(fixed.GO_CRITERIA)
    for section, names in fixed.GO_CRITERIA_DOCUMENT.items():
        for key, name in names.items():
            value = ((document or {}).get(section) or {}).get(key)
            if value is not None:
                criteria[name] = value
    return criteria


def go_class(raw: Column, criteria: Mapping) -> Column:
    return (F.when(raw <= criteria["excellent_max"], 3).when(raw <= criteria["good_max"], 2)
            .when(raw <= criteria["caution_max"], 1).otherwise(0))


def go_nogo(forecast: DataFrame, place: str, time: str, criteria: Mapping | None = None
            ) -> DataFrame:
    """Score of forecast hours: ``raw`` (lower is better), class ``score``, ``tags``.

    forecast: place, time, wave, wind, dir, wave_dir, wind_wave. The wind of the
    hour before is the previous row of the same place. Without a known wave ``raw``
    is null and the class the worst. A forecast has a bounded number of hours per
    place, which go to one task.
    """
    c = {**fixed.GO_CRITERIA, **(criteria or {})}
    tag = fixed.GO_TAGS

    def sure(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    def known(column: str) -> Column:
        return finite(F.col(column))

    rows = forecast.withColumn("_wind", known("wind")).withColumn(
        "_before", F.lag("_wind").over(Window.partitionBy(place).orderBy(time)))
    wave, wind, before = known("wave"), F.col("_wind"), F.col("_before")
    heading, wave_dir, wind_wave = known("dir"), known("wave_dir"), known("wind_wave")

    strong = sure(wind > c["wind_speed_threshold"])
    south = sure((heading >= c["south_range_min"]) & (heading <= c["south_range_max"]))
    north = sure((heading >= c["north_range_min"]) | (heading <= c["north_range_max"]))
    from_south = strong & south
    shown_north = north & ~(strong & south)
    from_side = strong & ~south & ~north
    apart = compass.angle_between(heading, wave_dir)
    reverse = sure(apart >= c["reverse_angle_min"])
    cross = sure(apart >= c["cross_angle_min"]) & ~reverse
    against = (reverse | cross) if c["compound_include_cross"] else reverse
    compound = sure(wave > c["wave_height_threshold"]) & from_south & against
    wind_up = sure(wind > before + c["trend_change_threshold"])
    wind_down = sure(wind < before - c["trend_change_threshold"])
    small = sure(wind_wave <= c["ww_good_max"])
    big = sure(wind_wave >= c["ww_bad_min"]) & ~small

    steps = [
        [(from_south, c["south_penalty"], tag["south"]), (shown_north, 0.0, tag["north"]),
         (from_side, c["ew_penalty"], tag["east_west"])],
        [(reverse, c["reverse_penalty"], tag["reverse"]),
         (cross, c["cross_penalty"], tag["cross"])],
        [(compound, c["compound_penalty"], tag["compound"])],
        [(wind_up, c["trend_up_penalty"], tag["wind_up"]),
         (wind_down, -c["trend_down_bonus"], tag["wind_down"])],
        [(small, -c["ww_good_bonus"], tag["small_wind_wave"]),
         (big, c["ww_bad_penalty"], tag["big_wind_wave"])],
    ]
    total, tags = wave, []
    for step in steps:
        total = total + F.coalesce(
            *[F.when(condition, penalty) for condition, penalty, _ in step], F.lit(0.0))
        tags.append(F.coalesce(*[F.when(condition, name) for condition, _, name in step]))
    raw = F.when(wave.isNotNull(), F.greatest(F.lit(0.0), js_round(total, 1)))
    return (rows.withColumn("raw", raw).withColumn("score", go_class(F.col("raw"), c))
            .withColumn("tags", F.array_compact(F.array(*tags))).drop("_wind", "_before"))


def day_scores(scored: DataFrame, place: str, time: str, criteria: Mapping | None = None,
               hours: Sequence[int] = (6, 12)) -> DataFrame:
    """Score of a day: mean of its two main hours, else its first hour.

    ``time`` is text that starts YYYY-MM-DDTHH.
    """
    c = {**fixed.GO_CRITERIA, **(criteria or {})}
    hour = F.substring(time, 12, 2).cast("int")
    days = scored.groupBy(place, F.substring(time, 1, 10).alias("day")).agg(
        F.avg(F.when(hour.isin(*hours), F.col("raw"))).alias("_main"),
        F.min_by("raw", time).alias("_first"))
    known = F.coalesce("_main", "_first")
    raw = F.when(known.isNotNull(), F.greatest(F.lit(0.0), js_round(known, 1)))
    return days.select(place, "day", raw.alias("raw")).withColumn(
        "score", go_class(F.col("raw"), c))


def scored_export(scored: DataFrame, place: str, time: str) -> DataFrame:
    """Scored hours as the twelve text and number columns of the export."""
    def fixed_text(column: str, digits: int) -> Column:
        return F.format_string(f"%.{digits}f", F.col(column))

    def verdict(index: int) -> Column:
        return F.element_at(F.array(*[F.lit(v[index]) for v in fixed.GO_VERDICTS]),
                            F.col("score") + 1)

    return scored.select(
        place, F.col(time).alias("time"),
        fixed_text("wave", 2).alias("wave_m"), fixed_text("wind", 1).alias("wind_ms"),
        F.col("dir").alias("wind_dir_deg"),
        compass.sector16_up(F.col("dir")).alias("wind_dir"),
        F.coalesce(F.col("wave_dir").cast("string"), F.lit("")).alias("wave_dir_deg"),
        F.coalesce(compass.sector16_up(F.col("wave_dir")), F.lit("")).alias("wave_dir"),
        fixed_text("rain", 1).alias("rain_mm"), "score",
        verdict(0).alias("judge"), verdict(1).alias("notif_status"),
        F.array_join("tags", "/").alias("penalties"))
