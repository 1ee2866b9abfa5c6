"""Great-circle distances and nearest places."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written
from . import fixed
from .numbers import finite

FEW = 64  # a list of so many places is not cut into cells
LEAF = 16  # places in a cell that need not be cut further
DEPTH = 10  # times a cell is cut at most, in four along each axis: down to 12 metres
SMALL_LEVEL = 50_000  # cells of a level that is sent to all tasks, about 5 MB
SLACK = 1e-9  # of the sphere's radius: 6 mm, more than ties of six decimals of a kilometre


def _haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1}) / 2D)"
    half_lng = f"sin(radians({lng2} - {lng1}) / 2D)"
    a = (f"({half_lat} * {half_lat} + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* {half_lng} * {half_lng})")
    return f"({fixed.EARTH_RADIUS_KM}D * (2D * atan2(sqrt({a}), sqrt(1D - {a}))))"


def haversine_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Distance of two positions given by column names."""
    return F.expr(_haversine(*[f"`{name}`" for name in (lat1, lng1, lat2, lng2)]))


def places_table(spark: SparkSession, places: DataFrame | Sequence[tuple]) -> DataFrame:
    """Places as a table: name, lat, lng, area."""
    if isinstance(places, DataFrame):
        return places.select("name", "lat", "lng", "area")
    return spark.createDataFrame(list(places), "name string, lat double, lng double, area string")


_AXES = ("x", "y", "z")


def _on_sphere(df: DataFrame, lat: str, lng: str, to: str) -> DataFrame:
    """Adds the position on the unit sphere as columns ``to`` + x, y, z."""
    north, east = F.radians(lat), F.radians(lng)
    return df.withColumns({f"{to}x": F.cos(north) * F.cos(east), f"{to}y": F.cos(north) * F.sin(east),
                           f"{to}z": F.sin(north)})


def _with_cell(df: DataFrame) -> DataFrame:
    """Adds the number of a place's smallest cell: six bits a level, two of each axis, coarsest first."""
    top = 1 << 2 * DEPTH
    df = df.withColumns({f"_w{a}": F.greatest(F.lit(0), F.least(
        F.lit(top - 1), F.floor((F.col(f"_l{a}") + 1.0) * (top / 2.0)))).cast("long") for a in _AXES})
    cell = F.lit(0).cast("long")
    for level in reversed(range(DEPTH)):
        for a in _AXES:
            digit = F.shiftright(F.col(f"_w{a}"), 2 * level).bitwiseAND(F.lit(3))
            cell = F.shiftleft(cell, 2).bitwiseOR(digit)
    return df.withColumn("_cell", cell).drop(*[f"_w{a}" for a in _AXES])


def _square(parts: Sequence[Column]) -> Column:
    x, y, z = parts
    return x * x + y * y + z * z


def _levels(places: DataFrame) -> list[tuple[int, int]]:
    """Of each level of cells: the most places in a cell, and the number of cells."""
    level = F.explode(F.array(*[F.lit(n) for n in range(DEPTH + 1)]))
    cells = places.select("_lg", "_cell", level.alias("_level")).groupBy(
        "_level", "_lg", F.expr(f"shiftright(_cell, 6 * ({DEPTH} - _level))").alias("_key")).count()
    found = cells.groupBy("_level").agg(F.max("count"), F.count(F.lit(1))).collect()  # DEPTH + 1 rows
    return [(most, n) for _, most, n in sorted(found)]


def near_pairs(near: DataFrame, places: DataFrame, few: bool = False) -> DataFrame:
    """Positions (_y, _x, _g) with the places (_lat, _lng, _name, _lg) of their group that may be nearest.

    Cells are cubes around the unit sphere, cut until few places are in each, with the box around
    their places and one of these places. A position first goes down by the nearest box, and the
    places of the cells on its way give a distance within which the nearest is for certain. Then it
    goes down into all cells whose box is not further away. So it meets a few cells a level, however many places
    there are and however far they are; nothing is sorted or grouped on the way.
    """
    pairs = F.col("_g") == F.col("_lg")
    if few:
        return near.join(places, pairs)
    places = written(_with_cell(_on_sphere(places, "_lat", "_lng", "_l")), "places")
    levels = _levels(places)
    depth = next((n for n, (most, _) in enumerate(levels) if most <= LEAF), len(levels) - 1)
    if depth <= 0:
        return near.join(places.select("_lg", "_lat", "_lng", "_name"), pairs)
    level = F.explode(F.array(*[F.lit(n) for n in range(1, depth + 1)]))
    # The three firsts of a cell are read from the same row.
    cells = written(places.withColumn("_level", level).groupBy(
        "_level", "_lg", F.expr(f"shiftright(_cell, 6 * ({DEPTH} - _level))").alias("_key")).agg(
        *[pick(f"_l{a}").alias(name + a) for name, pick in (
            ("_low", F.min), ("_high", F.max), ("_some", F.first)) for a in _AXES]), "place-cells")
    inner = written(cells.groupBy("_level", "_lg", F.shiftright("_key", 6).alias("_outer")).agg(
        F.collect_list(F.struct("_key", *[name + a for name in ("_low", "_high", "_some") for a in _AXES])
                       ).alias("_inner")), "place-cells")

    def of_level(table: DataFrame, n: int) -> DataFrame:
        table = table.where(F.col("_level") == n).drop("_level")
        return F.broadcast(table) if levels[n][1] <= SMALL_LEVEL else table

    def to_box(cell) -> Column:
        return _square([F.greatest(cell(f"_low{a}") - F.col(f"_p{a}"),
                                   F.col(f"_p{a}") - cell(f"_high{a}"), F.lit(0.0)) for a in _AXES])

    def to_place(cell, name: str) -> Column:
        return _square([cell(f"{name}{a}") - F.col(f"_p{a}") for a in _AXES])

    at = [f"_p{a}" for a in _AXES]
    position = ["_y", "_x", "_g", *at]
    step = (F.col("_g") == F.col("_lg")) & (F.col("_at") == F.col("_outer"))
    walk = _on_sphere(near, "_y", "_x", "_p").select(
        *position, F.lit(0).cast("long").alias("_at"), F.lit(float("inf")).alias("_sure"))
    for n in range(1, depth + 1):
        nearest = F.array_min(F.transform("_inner", lambda c: F.struct(
            to_box(c.getField).alias("off"), c["_key"].alias("key"))))
        place = F.array_min(F.transform("_inner", lambda c: to_place(c.getField, "_some")))
        walk = walk.join(of_level(inner, n), step).select(
            *position, nearest["key"].alias("_at"), F.least("_sure", place).alias("_sure"))
    rim = F.sqrt("_sure") + SLACK
    walk = walk.select(*position, F.lit(0).cast("long").alias("_at"), (rim * rim).alias("_sure"))
    for n in range(1, depth + 1):
        boxes = of_level(cells.withColumn("_outer", F.shiftright("_key", 6)), n)
        walk = walk.join(boxes, step & (to_box(F.col) <= F.col("_sure"))).select(
            *position, "_sure", F.col("_key").alias("_at"))
    last = F.shiftright("_cell", 6 * (DEPTH - depth))
    near_enough = to_place(F.col, "_l") <= F.col("_sure")
    return walk.join(places, pairs & (F.col("_at") == last) & near_enough).select(
        "_y", "_x", "_g", "_lat", "_lng", "_name")


def with_nearest(df: DataFrame, lat: str, lng: str, places: DataFrame | Sequence[tuple],
                 area: str | None = None, out: str = "_near") -> DataFrame:
    """Adds ``out``, a struct (rounded, name, km) of the nearest place of any number.

    Distances that agree to six decimals are a tie, won by the smaller name in
    bytes. Where the area column has a value, only places of that area count.
    Without a position, or without any place, the struct is null. Places without
    a position are not there; of those at one position the smallest name counts.
    Distinct positions meet the places that ``near_pairs`` gives.
    """
    few = not isinstance(places, DataFrame) and len(places) <= FEW
    table = places_table(df.sparkSession, places).select(
        F.col("name").alias("_name"), finite(F.col("lat")).alias("_lat"),
        finite(F.col("lng")).alias("_lng"), F.col("area").alias("_area")).where(
        "_name IS NOT NULL AND _lat IS NOT NULL AND _lng IS NOT NULL")
    group = F.lit("")
    given = {"_y": finite(F.col(lat)), "_x": finite(F.col(lng)), "_g": F.lit("")}
    if area is not None:
        given["_g"] = F.coalesce(F.col(area), F.lit(""))
        # A place counts in its area, and for positions without an area.
        group = F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce("_area", F.lit("")))))
    table = table.select("_lat", "_lng", "_name", group.alias("_lg")).groupBy("_lg", "_lat", "_lng").agg(
        F.min("_name").alias("_name"))
    near = df.select(*[column.alias(name) for name, column in given.items()]).where(
        "_y IS NOT NULL AND _x IS NOT NULL").distinct()
    met = near_pairs(near, table, few).withColumn("_km", haversine_km("_y", "_x", "_lat", "_lng"))
    found = met.groupBy("_y", "_x", "_g").agg(F.min(F.struct(
        F.round("_km", 6).alias("rounded"), F.col("_name").alias("name"), F.col("_km").alias("km"))).alias(out))
    found = found.select(*[F.col(k).alias(f"_n{k}") for k in given], out)
    on = F.lit(True)
    for name, column in given.items():
        on = on & (column == F.col(f"_n{name}"))
    return df.join(found, on, "left").select(*df.columns, out)
