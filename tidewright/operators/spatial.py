"""Stations and current points of places; grid cells of points."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import compass, fixed, geo, text
from ..functions.numbers import round_columns
from ..session import written


def with_station(df: DataFrame, lat: str, lng: str, name: str = "nearest_station",
                 km: str = "distance_km", stations=tuple(fixed.STATIONS),
                 limit_km: float = fixed.STATION_LIMIT_KM) -> DataFrame:
    """Adds the nearest station and its distance; one too far away is named "other"."""
    near = geo.with_nearest(df, lat, lng, stations)
    return near.withColumns({
        name: F.when(F.col("_near.km") > limit_km, fixed.OTHER)
        .when(F.col("_near.km").isNotNull(), F.col("_near.name")),
        km: F.col("_near.km")}).drop("_near")


def with_point(df: DataFrame, lat: str, lng: str, area: str | None = None,
               name: str = "current_point", km: str = "current_distance_km",
               points=tuple(fixed.CURRENT_POINTS), limit_km: float = fixed.POINT_LIMIT_KM
               ) -> DataFrame:
    """Adds the nearest current point and its distance; one too far away is null."""
    near = geo.with_nearest(df, lat, lng, points, area)
    close = F.col("_near.km") <= limit_km
    return near.withColumns({name: F.when(close, F.col("_near.name")),
                             km: F.when(close, F.col("_near.km"))}).drop("_near")


def station_in_text(name: Column, stations: Sequence[str], negatives: Sequence[str] = ()
                    ) -> Column:
    """The longest station name that occurs in a text; the earlier one of a tie.

    A text with a forbidden word in it matches no station.
    """
    longest_first = sorted(stations, key=len, reverse=True)
    hit = F.coalesce(*[F.when(name.contains(s), s) for s in longest_first])
    blocked = F.lit(False)
    for word in negatives:
        blocked = blocked | name.contains(word)
    return F.when(~blocked, hit)


def classify_spots(df: DataFrame, spot: str, lat: str, lng: str,
                   spot_areas: DataFrame | None = None, negatives: Sequence[str] = (),
                   stations=tuple(fixed.STATIONS), points=tuple(fixed.CURRENT_POINTS),
                   normalise: bool = True) -> DataFrame:
    """Canonical name, nearest station and current point of every spot.

    An empty name has no station. Without coordinates the station is looked for
    in the name, and is "unknown" if it is not there. ``spot_areas`` maps
    canonical_spot to sea_area; a spot with an area takes current points of that
    area only.
    """
    out = df.withColumn("canonical_spot",
                        text.canonical_spot(F.col(spot), normalise=normalise))
    area = None
    if spot_areas is not None:
        area = "_area"
        out = out.join(spot_areas.select("canonical_spot", F.col("sea_area").alias(area)),
                       "canonical_spot", "left").select(*out.columns, area)
    out = with_station(out, lat, lng, "_station", "_station_km", stations)
    out = with_point(out, lat, lng, area, "_point", "_point_km", points)
    named = F.col("canonical_spot") != ""
    located = F.col("_station_km").isNotNull()
    by_name = F.coalesce(
        station_in_text(F.col("canonical_spot"), [s[0] for s in stations], negatives),
        F.lit(fixed.UNKNOWN))
    return out.select(
        *df.columns, "canonical_spot",
        F.when(named & located, F.col("_station")).when(named, by_name).alias("nearest_station"),
        F.when(named, F.col("_station_km")).alias("distance_km"),
        F.when(named, F.col("_point")).alias("current_point"),
        F.when(named, F.col("_point_km")).alias("current_distance_km"))


def grid_points(grid: DataFrame, points=tuple(fixed.CURRENT_POINTS), day: str = "day",
                lat: str = "lat", lon: str = "lon", depth: str | None = "depth",
                tolerance: float = fixed.GRID_TOLERANCE_DEG, source: str | None = None
                ) -> DataFrame:
    """Current rows of named points from a gridded field in long form.

    Each day (of each source) has its own grid lines: latitude and longitude are
    each taken from the day's nearest line, depth from its uppermost level. A
    point whose cell the day lacks gives a row of nulls. A point more than the
    tolerance away is kept and flagged.
    """
    keys = [day] if source is None else [source, day]
    named = F.explode(F.array(*[
        F.struct(F.lit(name).alias("point"), F.lit(p_lat).alias("point_lat"),
                 F.lit(p_lon).alias("point_lon")) for name, p_lat, p_lon, _ in points])).alias("_p")

    def lines(axis: str, at: str, name: str) -> DataFrame:
        """The nearest line of an axis, by key and point."""
        near = grid.select(*keys, F.col(axis).alias("_line")).distinct().select(
            *keys, "_line", named).select(*keys, "_line", "_p.*")
        return near.groupBy(*keys, "point", "point_lat", "point_lon").agg(F.min_by(
            "_line", F.struct(F.abs(F.col("_line") - F.col(at)), F.col("_line"))).alias(name))

    wanted = lines(lat, "point_lat", "_lat").join(
        lines(lon, "point_lon", "_lon").drop("point_lat", "point_lon"), [*keys, "point"])
    if depth:
        wanted = wanted.join(grid.groupBy(*keys).agg(F.min(depth).alias("_depth")), keys)
    field = grid.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(lat).alias("_g_lat"),
                        F.col(lon).alias("_g_lon"),
                        *([F.col(depth).alias("_g_depth")] if depth else []),
                        "u", "v", "temp", "salt")
    condition = (F.col("_lat") == F.col("_g_lat")) & (F.col("_lon") == F.col("_g_lon"))
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_k_{key}"))
    if depth:
        condition = condition & (F.col("_depth") == F.col("_g_depth"))
    rows = wanted.join(field, condition, "left")
    return _point_rows(rows, keys, tolerance)


def _point_rows(rows: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Current rows as they are stored, from points with the values of their cell."""
    u, v = F.col("u"), F.col("v")
    speed = compass.flow_speed(u, v)
    off = F.sqrt(F.pow(F.col("_lat") - F.col("point_lat"), F.lit(2.0))
                 + F.pow(F.col("_lon") - F.col("point_lon"), F.lit(2.0)))
    raw = rows.select(
        *keys, "point", F.col("point_lat").alias("lat"), F.col("point_lon").alias("lon"),
        u.alias("u_ms"), v.alias("v_ms"), speed.alias("speed_ms"),
        compass.knots(speed).alias("speed_kn"), compass.flow_direction(u, v).alias("direction"),
        F.col("temp").alias("temp_c"), F.col("salt").alias("salinity"),
        (off > tolerance).alias("too_far"))
    raw = round_columns(raw, 4, "u_ms", "v_ms", "speed_ms", "speed_kn")
    return round_columns(round_columns(round_columns(raw, 1, "direction"), 2, "temp_c"),
                         3, "salinity")


_STEP = 8  # a cell of the next size takes as many on each side


def grid_points_2d(grid: DataFrame, points=tuple(fixed.CURRENT_POINTS), day: str = "day", y: str = "y",
                   x: str = "x", lat: str = "lat", lon: str = "lon", depth: str | None = "depth",
                   tolerance: float = fixed.GRID_TOLERANCE_DEG, source: str | None = None,
                   cell: float = 0.25) -> DataFrame:
    """Current rows of named points from a field on a curvilinear grid: each (y, x) has a position.

    A point takes the grid position with the least sum of squared differences in degrees, of
    equal ones the first by y and x, at its day's uppermost level. Positions are counted into cells of
    ``cell`` degrees and those into cells eight times as large, up to the whole globe, each with the
    box around its positions. The search goes down by size: a cell stays if its box can hold a
    position as near as the worst one that some other cell surely has. So a point meets the
    positions of a few cells, however far it is from the grid. Each day (of each source) is a grid of its
    own; positions without numbers are not there.
    """
    keys = [day] if source is None else [source, day]
    field = grid.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))
    if depth:
        top = field.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.min(depth).alias("_depth"))
        at_top = F.col(depth).eqNullSafe(F.col("_depth"))
        for k in keys:
            at_top = at_top & (F.col(k) == F.col(f"_t_{k}"))
        field = field.join(top, at_top).select(*field.columns)
    field = field.select(*keys, F.col(y).alias("_y"), F.col(x).alias("_x"), F.col(lat).alias("_lat"),
                         F.col(lon).alias("_lon"), "u", "v", "temp", "salt",
                         F.floor(F.col(lat) / cell).alias("_cy"), F.floor(F.col(lon) / cell).alias("_cx"))
    box = [F.min("_lat").alias("_south"), F.max("_lat").alias("_north"),
           F.min("_lon").alias("_west"), F.max("_lon").alias("_east")]
    whole = [F.min("_south").alias("_south"), F.max("_north").alias("_north"),
             F.min("_west").alias("_west"), F.max("_east").alias("_east")]
    sizes = [written(field.groupBy(*keys, "_cy", "_cx").agg(*box), "grid-cells")]
    size = cell
    while size < 360:
        size *= _STEP
        sizes.append(sizes[-1].groupBy(*keys, F.floor(F.col("_cy") / _STEP).alias("_cy"), F.floor(
            F.col("_cx") / _STEP).alias("_cx")).agg(*whole))

    named = F.explode(F.array(*[
        F.struct(F.lit(name).alias("point"), F.lit(float(p_lat)).alias("point_lat"),
                 F.lit(float(p_lon)).alias("point_lon")) for name, p_lat, p_lon, *_ in points])).alias("_p")
    days = sizes[0].select(*keys).distinct()
    wanted = days.select(*keys, named).select(*keys, "_p.*")
    point = [*keys, "point", "point_lat", "point_lon"]

    def square(a: Column, b: Column) -> Column:
        return a * a + b * b

    def possible(cells: DataFrame) -> DataFrame:
        """Cells that may hold a point's nearest position."""
        p, q = F.col("point_lat"), F.col("point_lon")
        zero = F.lit(0.0)
        near = square(F.greatest(F.col("_south") - p, p - F.col("_north"), zero),
                      F.greatest(F.col("_west") - q, q - F.col("_east"), zero))
        far = square(F.greatest(F.abs(p - F.col("_south")), F.abs(p - F.col("_north"))),
                     F.greatest(F.abs(q - F.col("_west")), F.abs(q - F.col("_east"))))
        sure = F.min(far).over(Window.partitionBy(*point))
        return cells.withColumn("_sure", sure).where(near <= F.col("_sure")).select(*point, "_cy", "_cx")

    found = possible(wanted.join(sizes[-1], keys))  # four cells a day at most
    for cells in reversed(sizes[:-1]):
        inner = cells.withColumns({"_py": F.floor(F.col("_cy") / _STEP), "_px": F.floor(F.col("_cx") / _STEP)})
        outer = found.select(*point, F.col("_cy").alias("_py"), F.col("_cx").alias("_px"))
        found = possible(outer.join(inner, [*keys, "_py", "_px"]))
    met = found.join(field, [*keys, "_cy", "_cx"])
    off = square(F.col("_lat") - F.col("point_lat"), F.col("_lon") - F.col("point_lon"))
    value = F.struct("_lat", "_lon", "u", "v", "temp", "salt")
    rows = met.groupBy(*point).agg(F.min_by(value, F.struct(off, "_y", "_x")).alias("_best"))
    return _point_rows(rows.select(*point, "_best.*"), keys, tolerance)
