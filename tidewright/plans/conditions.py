"""Keeping the condition table complete: what to ask for, and what came back."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..operators import coverage, enrich, rollup
from ..operators.latest import keep_last
from ..sources import payload, precedence


def requests(master_days: DataFrame, stored: DataFrame, stations: Sequence[str], as_of: Column,
             longest: int = 60) -> tuple[DataFrame, DataFrame]:
    """(missing station days up to the day before, the same as chunks to ask for)."""
    gaps = coverage.coverage_gaps(master_days, stored, "day", "station", stations,
                                  F.date_sub(as_of, 1))
    return gaps, coverage.date_chunks(gaps, "station", "day", longest)


def daily_conditions(gaps: DataFrame, archive: DataFrame, forecast: DataFrame, marine: DataFrame,
                     water_hourly: DataFrame, water_daily: DataFrame, as_of: Column) -> DataFrame:
    """Condition rows of the missing days from landed payload documents.

    Payloads carry ``station`` and one struct of arrays, ``hourly`` or ``daily``;
    water payloads carry the ``chunk`` they were asked for as well. Archive days
    end some days before ``as_of``; daily water counts only where a chunk has no
    hourly value.
    """
    def weather(documents: DataFrame) -> DataFrame:
        names = ["temperature_2m", "wind_speed_10m", "wind_direction_10m", "precipitation",
                 "weather_code"]
        rows = payload.hourly_rows(documents, ["station"], names)
        return rollup.daily_weather(_dated(rows), "station", "day", "hour", *names)

    daily = precedence.archive_and_forecast(
        weather(archive), weather(forecast), ["station", "day"], "day", as_of).drop("source")
    waves = rollup.daily_waves(
        _dated(payload.hourly_rows(marine, ["station"],
                                   ["wave_height", "wave_direction", "wave_period"])),
        "station", "day", "hour", "wave_height", "wave_direction", "wave_period")
    hourly = payload.hourly_rows(water_hourly, ["station", "chunk"], ["sea_surface_temperature"])
    chunk_of = hourly.select("station", "day", "chunk").distinct()
    by_hour = rollup.daily_water(hourly, "station", "day", "hour", "sea_surface_temperature").join(
        chunk_of, ["station", "day"]).select("station", "chunk", "day", "水温")
    by_day = payload.daily_rows(water_daily, ["station", "chunk"], "sea_surface_temperature_mean",
                                "水温").select("station", "chunk", "day", "水温")
    # Of a day in several chunks the last chunk counts.
    water = keep_last(_dated(precedence.hourly_else_daily(by_hour, by_day, ["station", "chunk"])),
                      ["station", "day"], ["chunk"]).drop("chunk")
    return enrich.condition_rows(gaps, daily, water, waves, "station", "day")


def stored_form(rows: DataFrame, stations=tuple(fixed.STATIONS)) -> DataFrame:
    """Condition rows as the 21 text columns of the stored table."""
    def of_station(index: int) -> Column:
        items = [F.lit(x) for s in stations for x in (s[0], str(s[index]))]
        return F.try_element_at(F.create_map(*items), F.col("station"))

    given = {"日付": F.col("day"), "地点名": F.col("station"), "観測地点名": F.col("station"),
             "緯度": of_station(1), "経度": of_station(2), "県": of_station(3)}
    return rows.select(*[F.coalesce(given.get(c, F.col(c) if c in rows.columns else F.lit(""))
                                    .cast("string"), F.lit("")).alias(c)
                         for c in fixed.CONDITION_COLUMNS])


def compact(stored: DataFrame, seq: str) -> DataFrame:
    """The last stored row of every day and station."""
    return keep_last(stored, ["日付", "地点名"], [seq], keep_null_keys=True)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.col("day").try_cast("date")).where(F.col("day").isNotNull())
