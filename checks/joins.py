"""Queries: joins, duplicates, coverage, roll-ups, places, scores."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import fixed, geo
from tidewright.functions.numbers import round_columns
from tidewright.operators import (coverage, enrich, latest, profile, rollup, score, spatial, trend)
from tidewright.sources import dimensions, payload, precedence
from tidewright.sources import grid as fields

from .profiles import _conditions
from .registry import (MOON_AGE, PHASE, TIDE, in_list, query, rounded, sector_sql, share_select,
                       summary_parts, tenth, trend_parts, with_views)
from .views import POINTS, SHIP_DAY, aggregated, table, view

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# ---- joins with conditions ---------------------------------------------------------------


@query(with_views("catch", "cond") + f"""
    SELECT {', '.join('c.' + k for k in KEYS)}, CAST(c.day AS STRING) AS day, c.point,
           {rounded('v', 4)} AS value, cond.degrees AS heading
    FROM catch c LEFT JOIN cond ON c.day = cond.day AND c.point = cond.point""")
def enrich_left(spark, sf):
    out = enrich.with_conditions(view(spark, sf, "catch"), aggregated(spark, sf, "cond"), "day",
                                 "point", "day", "point", {"v": "value", "degrees": "heading"})
    return round_columns(out.select(*KEYS, F.col("day").cast("string").alias("day"), "point",
                                    "value", "heading"), 4, "value")


@query(with_views("catch", "cond", a=f"SELECT * FROM cond WHERE point = '{POINTS[0]}'",
                  b=f"SELECT * FROM cond WHERE point = '{POINTS[1]}'") + f"""
    SELECT {', '.join('c.' + k for k in KEYS)}, c.spot, {rounded('a.v', 4)} AS a_speed,
           a.degrees AS a_heading, {rounded('b.v', 4)} AS b_speed, b.degrees AS b_heading
    FROM catch c LEFT JOIN a ON c.day = a.day AND c.spot LIKE '%室戸%'
    LEFT JOIN b ON c.day = b.day AND c.spot LIKE '%室戸%'""")
def enrich_two_points(spark, sf):
    names = {"v": "speed", "degrees": "heading"}
    out = enrich.with_point_currents(view(spark, sf, "catch"), aggregated(spark, sf, "cond"),
                                     "day", "spot", "day", "point", names, POINTS[:2])
    out = out.withColumnsRenamed({f"{POINTS[i]}_{n}": f"{'ab'[i]}_{n}"
                                  for i in (0, 1) for n in names.values()})
    return round_columns(out.select(*KEYS, "spot", "a_speed", "a_heading", "b_speed", "b_heading"),
                         4, "a_speed", "b_speed")


@query(with_views("catch", "cond", **trend_parts("cond")) + f"""
    SELECT {', '.join('c.' + k for k in KEYS)}, c.species, c.spot,
           CASE WHEN c.count = 0 THEN 1 ELSE c.count END AS count,
           coalesce(t.label, '不明') AS _wt_trend
    FROM catch c LEFT JOIN (SELECT * FROM trend WHERE point = '{POINTS[0]}') t ON c.day = t.day
    WHERE c.species <> ''""")
def record_export(spark, sf):
    labels = trend.calendar_trend(aggregated(spark, sf, "cond").where(F.col("point") == POINTS[0]),
                                  "point", "day", "v")
    out = enrich.record_export(view(spark, sf, "catch"), labels, "species", "day", "count", "label")
    return out.select(*KEYS, "species", "spot", "count", "_wt_trend")


# ---- last rows and duplicates -------------------------------------------------------------

ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"]


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           {SHIP_DAY} AS day FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY {', '.join(c + ' DESC' for c in ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def keep_last(spark, sf):
    last = latest.keep_last(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ORDER)
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                       "l_extendedprice", F.expr(SHIP_DAY).alias("day"))


@query(with_views("hourly") + """
    SELECT first, event_id AS again FROM (SELECT event_id, min(event_id) OVER
        (PARTITION BY user_id, station, day) AS first FROM hourly) WHERE event_id > first""")
def dup_first_anchor(spark, sf):
    return latest.after_first(view(spark, sf, "hourly"), ["user_id", "station", "day"], "event_id")


# All pairs of one day and station within 2, but not the first and a repeat of the same columns.
NEAR = """SELECT a.event_id AS again, min(b.event_id) AS first, count(*) AS partners
          FROM anchored a JOIN anchored b ON a.day = b.day AND a.station = b.station
              AND a.event_id <> b.event_id AND b.value BETWEEN a.value - 2 AND a.value + 2
          WHERE NOT (a.anchor = b.anchor AND (a.event_id = a.anchor OR b.event_id = b.anchor))
          GROUP BY a.event_id"""
ANCHORED = """SELECT *, min(event_id) OVER (PARTITION BY day, station, value, code) AS anchor
              FROM hourly"""


@query(with_views("hourly", anchored=ANCHORED, near=NEAR) + "SELECT * FROM near")
def dup_near(spark, sf):
    return latest.near_duplicates(view(spark, sf, "hourly"), ["day", "station"], "value",
                                  "event_id", ["day", "station", "value", "code"])


def _level(name: str, keys: str) -> str:
    return (f"SELECT '{name}' AS level, first, event_id AS again, 1 AS partners FROM "
            f"(SELECT event_id, min(event_id) OVER (PARTITION BY {keys}) AS first FROM hourly) "
            f"WHERE event_id > first")


@query(with_views("hourly", anchored=ANCHORED, near=NEAR) + " UNION ALL ".join([
    _level("complete", "value, k"), _level("source", "user_id, station, day"),
    _level("pseudo", "day, station, value, code"),
    "SELECT 'near', first, again, partners FROM near"]))
def dup_levels(spark, sf):
    rows = view(spark, sf, "hourly").withColumns({
        "id": F.concat_ws("|", F.col("value").cast("string"), F.col("k").cast("string")),
        "detail": F.concat_ws("|", F.col("user_id").cast("string"), "station",
                              F.col("day").cast("string"))})
    return latest.duplicates(rows, "event_id", "id", "detail", ["day", "station", "value", "code"],
                             ["day", "station"], "value")


# ---- coverage --------------------------------------------------------------------------------


@query(with_views("catch", "cond") + f"""
    SELECT CAST(d.day AS STRING) AS day, s.point FROM
        (SELECT DISTINCT day FROM catch WHERE day <= DATE '2001-06-01') d
        CROSS JOIN (SELECT unnest({POINTS}) AS point) s
    WHERE NOT EXISTS (SELECT 1 FROM cond c WHERE c.day = d.day AND c.point = s.point)""")
def coverage_gaps(spark, sf):
    gaps = coverage.coverage_gaps(view(spark, sf, "catch"), aggregated(spark, sf, "cond"), "day",
                                  "point", POINTS, F.lit("2001-06-01").cast("date"))
    return gaps.select(F.col("day").cast("string").alias("day"), "point")


CHUNKS = """SELECT point, CAST(min(day) AS STRING) AS first_day, CAST(max(day) AS STRING) AS last_day,
    count(*) AS days FROM (SELECT *, (row_number() OVER (PARTITION BY point, run ORDER BY day) - 1)
        // {longest} AS part FROM (SELECT point, day, day - CAST(row_number() OVER
        (PARTITION BY point ORDER BY day) AS INT) AS run FROM {source})) GROUP BY point, run, part"""


@query(with_views("cond") + CHUNKS.format(longest=5, source="cond"))
def date_chunks(spark, sf):
    chunks = coverage.date_chunks(aggregated(spark, sf, "cond"), "point", "day", 5)
    return chunks.select("point", F.col("first_day").cast("string").alias("first_day"),
                         F.col("last_day").cast("string").alias("last_day"), "days")


@query(with_views("cond") + f"""
    SELECT CAST(d.day AS STRING) AS day, coalesce(c.n, 0) AS points FROM
    (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY))
        AS DATE) AS day) d LEFT JOIN (SELECT day, count(*) AS n FROM cond GROUP BY day) c
    ON c.day = d.day WHERE coalesce(c.n, 0) < {len(POINTS)}""")
def calendar_gaps(spark, sf):
    stored = aggregated(spark, sf, "cond").groupBy("day").agg(F.count(F.lit(1)).alias("points"))
    days = coverage.calendar(spark, "1995-01-01", "2001-08-01")
    return (days.join(stored, "day", "left").withColumn("points", F.coalesce("points", F.lit(0)))
            .where(F.col("points") < len(POINTS))
            .select(F.col("day").cast("string").alias("day"), "points"))


# ---- hourly to daily -----------------------------------------------------------------------------

WEATHER_CODES = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in fixed.WEATHER_TEXT.items()) + "}"
S16 = sector_sql(fixed.COMPASS_16, "round_even(dir / 22.5::DOUBLE, 0)")
DAILY = f"""SELECT station, day, {tenth('avg(value)')} AS "気温_平均", {tenth('max(value)')} AS "気温_最高",
    {tenth('min(value)')} AS "気温_最低", {tenth('max(value / 5::DOUBLE)')} AS "風速_最大",
    arg_max(direction, row(value / 5::DOUBLE, -hour, -event_id)) AS dir,
    {tenth('sum(CAST(k AS DOUBLE) / 10::DOUBLE)')} AS "降水量",
    CAST(max(CAST(code AS INT)) AS BIGINT) AS "天気コード"
    FROM hourly WHERE hour IN (0, 6, 12, 18) GROUP BY station, day"""


def _hourly(spark, sf):
    return view(spark, sf, "hourly").withColumns({
        "wind": F.col("value") / 5.0, "rain": F.col("k").cast("double") / 10.0})


@query(with_views("hourly", daily=DAILY) + f"""
    SELECT station, CAST(day AS STRING) AS day, "気温_平均", "気温_最高", "気温_最低", "風速_最大",
           {S16} AS "風向", "降水量", "天気コード", coalesce({WEATHER_CODES}["天気コード"],
           'code' || CAST("天気コード" AS STRING)) AS "天気" FROM daily""")
def daily_rollup(spark, sf):
    out = rollup.daily_weather(_hourly(spark, sf), "station", "day", "hour", "value", "wind",
                               "direction", "rain", "code", ["event_id"])
    return out.withColumns({"day": F.col("day").cast("string"),
                            "天気コード": F.col("天気コード").cast("long")})


@query(with_views("hourly") + """
    SELECT station, CAST(day AS STRING) AS day,
           arg_max(direction, row(value, -hour, -event_id)) AS direction,
           max(value) AS wind FROM hourly WHERE hour IN (0, 6, 12, 18) GROUP BY station, day""")
def wind_argmax(spark, sf):
    rows = rollup.at_hours(view(spark, sf, "hourly"), "hour")
    return rows.groupBy("station", F.col("day").cast("string").alias("day")).agg(
        rollup.at_first_maximum(F.col("direction"), F.col("value"), F.col("hour"),
                                F.col("event_id")).alias("direction"), F.max("value").alias("wind"))


@query(with_views("hourly", w=f"""SELECT station, day, {tenth('max(value / 40::DOUBLE)')} AS high,
    {tenth('avg(direction)')} AS dir, {tenth('avg(CAST(k AS DOUBLE))')} AS period FROM hourly
    WHERE hour IN (0, 6, 12, 18) GROUP BY station, day""") + f"""
    SELECT station, CAST(day AS STRING) AS day, high AS "最大波高", {S16} AS "波向",
           period AS "波周期" FROM w""")
def daily_waves(spark, sf):
    rows = view(spark, sf, "hourly").withColumns({
        "height": F.col("value") / 40.0, "period": F.col("k").cast("double")})
    return rollup.daily_waves(rows, "station", "day", "hour", "height", "direction", "period"
                              ).withColumn("day", F.col("day").cast("string"))


@query(with_views("hourly") + f"""
    SELECT station, CAST(day AS STRING) AS day, {tenth('avg(value)')} AS "水温" FROM hourly
    WHERE hour IN (0, 6, 12, 18) GROUP BY station, day""")
def daily_water(spark, sf):
    return rollup.daily_water(view(spark, sf, "hourly"), "station", "day", "hour", "value"
                              ).withColumn("day", F.col("day").cast("string"))


STATIONS = ["click", "error", "purchase", "signup", "view"]
DAILY_WATER = f"""SELECT station, day, {tenth('avg(value)')} AS water FROM hourly
    WHERE hour IN (0, 6, 12, 18) GROUP BY station, day"""


@query(with_views("hourly", water=DAILY_WATER, waves=f"""SELECT station, day,
        {tenth('max(value / 40::DOUBLE)')} AS high, {tenth('avg(direction)')} AS dir,
        {tenth('avg(CAST(k AS DOUBLE))')} AS period FROM hourly WHERE hour IN (0, 6, 12, 18)
        GROUP BY station, day""",
    temps=f"""SELECT station, day, {tenth('max(value)')} AS top FROM hourly
        WHERE hour IN (0, 6, 12, 18) GROUP BY station, day""",
    days=f"""SELECT d.day, s.station, {MOON_AGE.replace('day -', 'd.day -')} AS moon FROM
        (SELECT DISTINCT day FROM hourly) d CROSS JOIN (SELECT unnest({STATIONS}) AS station) s""")
    + f"""SELECT d.station, CAST(d.day AS STRING) AS day, d.moon AS "月齢", {PHASE} AS "月相",
        {TIDE} AS "潮汐", t.top AS "気温_最高", w.water AS "水温", v.high AS "最大波高",
        v.period AS "波周期"
    FROM days d LEFT JOIN temps t ON t.station = d.station AND t.day = d.day
    LEFT JOIN water w ON w.station = d.station AND w.day = d.day
    LEFT JOIN waves v ON v.station = d.station AND v.day = d.day""")
def condition_rows(spark, sf):
    rows = _hourly(spark, sf).withColumns({
        "height": F.col("value") / 40.0, "period": F.col("k").cast("double")})
    nothing = rows.select("day", "station").where(F.lit(False))
    gaps = coverage.coverage_gaps(rows, nothing, "day", "station", STATIONS,
                                  F.lit("2024-12-31").cast("date"))
    out = enrich.condition_rows(
        gaps,
        rollup.daily_weather(rows, "station", "day", "hour", "value", "wind", "direction", "rain",
                             "code"),
        rollup.daily_water(rows, "station", "day", "hour", "value"),
        rollup.daily_waves(rows, "station", "day", "hour", "height", "direction", "period"),
        "station", "day")
    return out.select("station", F.col("day").cast("string").alias("day"), "月齢", "月相", "潮汐",
                      "気温_最高", "水温", "最大波高", "波周期")


# ---- payloads and sources ---------------------------------------------------------------------------


def _payload(spark, sf):
    """Hourly payload documents: per station and day one struct of arrays."""
    rows = view(spark, sf, "hourly").withColumn(
        "time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    packed = rows.groupBy("station", "user_id", F.col("day").alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "time", "value", "k"))).alias("r"))
    return packed.select("station", "user_id", "doc", F.struct(
        F.col("r.time").alias("time"), F.col("r.value").alias("value"),
        # one array shorter than the others
        F.slice(F.col("r.k"), F.lit(1), F.size("r") - 1).alias("k")).alias("hourly"))


@query(with_views("hourly", p="""SELECT *, row_number() OVER (PARTITION BY station, user_id, day
        ORDER BY event_id DESC) AS back FROM hourly""") + """
    SELECT station, user_id, CAST(day AS STRING) AS day, CAST(hour AS BIGINT) AS hour, value,
           CASE WHEN back = 1 THEN NULL ELSE CAST(k AS DOUBLE) END AS k FROM p
    WHERE hour IN (0, 6, 12, 18)""")
def hourly_unpack(spark, sf):
    rows = payload.hourly_rows(_payload(spark, sf), ["station", "user_id"], ["value", "k"])
    return rows.select("station", "user_id", "day", F.col("hour").cast("long").alias("hour"),
                       "value", F.col("k").cast("double").alias("k"))


FORECAST = f"""SELECT place, time AS t, {rounded('wave_height', 2)} AS wave,
    {rounded('wind_speed_10m', 1)} AS wind, CAST(wind_direction_10m AS BIGINT) AS dir,
    CAST(wave_direction AS BIGINT) AS wave_dir, {rounded('wind_wave_height', 2)} AS wind_wave,
    {rounded('precipitation', 1)} AS rain FROM fc"""


def _forecast(spark, sf):
    rows = aggregated(spark, sf, "fc")
    marine = rows.select("place", "time", "wave_height", "wave_direction", "wind_wave_height")
    weather = rows.select("place", "time", "wind_speed_10m", "wind_direction_10m", "precipitation")
    return payload.forecast_rows(marine, weather, ["place"])


@query(with_views("fc") + FORECAST)
def forecast_join(spark, sf):
    return _forecast(spark, sf).withColumns({"dir": F.col("dir").cast("long"),
                                             "wave_dir": F.col("wave_dir").cast("long")})


@query(with_views("cond") + """
    SELECT CAST(day AS STRING) AS day, point, degrees,
           CASE WHEN point <= '2-HIGH' AND month(day) <= 6 THEN 'jcope_cache'
                WHEN point <= '4-NOT SPECIFIED' AND month(day) >= 4 THEN 'cmems' ELSE 'local' END
           AS source FROM cond WHERE NOT (point > '4-NOT SPECIFIED' AND month(day) > 9)""")
def source_precedence(spark, sf):
    rows = aggregated(spark, sf, "cond").select("day", "point", "degrees")
    month = F.month("day")
    sources = {
        "cmems": rows.where((F.col("point") <= "4-NOT SPECIFIED") & (month >= 4)),
        "jcope_cache": rows.where((F.col("point") <= "2-HIGH") & (month <= 6)),
        "local": rows.where(~((F.col("point") > "4-NOT SPECIFIED") & (month > 9)))}
    order = ["jcope_cache", "cmems", "local"]
    out = precedence.first_source(sources, ["day", "point"], order)
    return out.withColumn("day", F.col("day").cast("string"))


@query(with_views("cond") + f"""
    SELECT CAST(day AS STRING) AS day, point, {rounded('v', 4)} AS v,
           CASE WHEN day <= DATE '1999-12-27' THEN 'archive' ELSE 'forecast' END AS source
    FROM cond""")
def archive_forecast(spark, sf):
    rows = aggregated(spark, sf, "cond").drop("degrees")
    out = precedence.archive_and_forecast(rows, rows, ["day", "point"], "day",
                                          F.lit("2000-01-01").cast("date"))
    return round_columns(out.withColumn("day", F.col("day").cast("string")), 4, "v")


@query(with_views("cond", daily="SELECT point, day, degrees FROM cond",
                  hourly_part="SELECT point, day, degrees FROM cond WHERE point < '3-MEDIUM'") + """
    SELECT 'hourly' AS kind, point, count(*) AS n, CAST(sum(degrees) AS DOUBLE) AS total
    FROM hourly_part GROUP BY point UNION ALL
    SELECT 'daily', point, count(*), CAST(sum(degrees) AS DOUBLE) FROM daily
    WHERE point NOT IN (SELECT point FROM hourly_part) GROUP BY point""")
def hourly_else_daily(spark, sf):
    daily = aggregated(spark, sf, "cond").select(F.lit("daily").alias("kind"), "point", "day",
                                                 "degrees")
    hourly = daily.where(F.col("point") < "3-MEDIUM").withColumn("kind", F.lit("hourly"))
    out = precedence.hourly_else_daily(hourly, daily, ["point"])
    return out.groupBy("kind", "point").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("degrees").alias("total"))


@query(with_views("grid") + f"""
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
           {rounded('a.u', 4)} AS u, {rounded('a.v', 4)} AS v, {rounded('b.temp', 2)} AS temp,
           {rounded('c.salt', 3)} AS salt
    FROM (SELECT * FROM grid WHERE depth < 2) a
    FULL JOIN (SELECT * FROM grid WHERE depth > 0) b ON a.o_orderkey = b.o_orderkey
    FULL JOIN (SELECT * FROM grid) c
    ON coalesce(a.o_orderkey, b.o_orderkey) = c.o_orderkey
    WHERE coalesce(a.o_orderkey, b.o_orderkey) IS NOT NULL""")
def variable_merge(spark, sf):
    grid = view(spark, sf, "grid")
    out = fields.merge_variables([
        grid.where("depth < 2").select("o_orderkey", "u", "v"),
        grid.where("depth > 0").select("o_orderkey", "temp"),
        grid.select("o_orderkey", "salt")], ["o_orderkey"])
    out = round_columns(round_columns(out, 4, "u", "v"), 2, "temp")
    return round_columns(out, 3, "salt")


@query(with_views("grid", g="SELECT * FROM grid WHERE lat BETWEEN 33.0 AND 33.6 AND "
                  "lon BETWEEN 134.0 AND 134.6 AND depth BETWEEN 0.0 AND 1.0") + """
    SELECT CAST(year(day) AS BIGINT) AS year, depth, count(*) AS n,
           sum(CASE WHEN day <= DATE '1998-12-31' THEN 1 ELSE 0 END)::BIGINT AS reanalysis
    FROM g GROUP BY year(day), depth""")
def grid_box(spark, sf):
    grid = view(spark, sf, "grid").withColumnsRenamed(
        {"u": "uo", "v": "vo", "temp": "thetao", "salt": "so", "lat": "latitude"})
    known = fields.in_box(fields.with_known_names(grid))
    rows = fields.by_day(known.withColumn("kind", F.lit("reanalysis")),
                         known.withColumn("kind", F.lit("forecast")), "day", "1998-12-31")
    return rows.groupBy(F.year("day").cast("long").alias("year"), "depth").agg(
        F.count(F.col("u")).alias("n"),
        F.count(F.when(F.col("kind") == "reanalysis", 1)).alias("reanalysis"))


# ---- places --------------------------------------------------------------------------------------------


def _km(lat: str, lng: str, p_lat: float, p_lng: float) -> str:
    a = (f"(pow(sin(radians({p_lat}::DOUBLE - {lat}) / 2), 2) + cos(radians({lat})) "
         f"* cos(radians({p_lat}::DOUBLE)) * pow(sin(radians({p_lng}::DOUBLE - {lng}) / 2), 2))")
    return f"(6371::DOUBLE * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _km_of(lat: str, lng: str, p_lat: str, p_lng: str) -> str:
    """Distance of two positions, all four given as expressions."""
    a = (f"(pow(sin(radians({p_lat} - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({p_lat})) "
         f"* pow(sin(radians({p_lng} - {lng}) / 2), 2))")
    return f"(6371::DOUBLE * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _nearest_sql(places, limit: float, far: str, area: str | None = None) -> str:
    rows = " UNION ALL ".join(
        f"SELECT c_custkey, '{name}' AS name, {_km('lat', 'lng', la, lo)} AS km FROM geo"
        + (f" WHERE {area} = '{ar}'" if area else "") for name, la, lo, ar in places)
    return f"""SELECT c_custkey, CASE WHEN km > {limit} THEN {far} ELSE name END AS name, km FROM
        (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY round(km, 6), encode(name))
         AS rn FROM ({rows})) WHERE rn = 1"""


@query(with_views("geo", near=_nearest_sql(fixed.STATIONS, 100.0, "'その他'"))
       + "SELECT c_custkey, name, round(km, 3) AS km FROM near")
def nearest_station(spark, sf):
    out = spatial.with_station(view(spark, sf, "geo"), "lat", "lng", "name", "km", limit_km=100.0)
    return out.select("c_custkey", "name", F.round("km", 3).alias("km"))


AREA_POINTS = [(name, lat, lng, area) for (name, lat, lng, _), area in
               zip(fixed.CURRENT_POINTS, ["BUILDING", "MACHINERY", "BUILDING", "FURNITURE",
                                          "MACHINERY"])]


@query(with_views("geo", near=_nearest_sql(AREA_POINTS, 1e9, "name", "c_mktsegment")) + """
    SELECT g.c_custkey, CASE WHEN near.km <= 50 THEN near.name END AS name,
           CASE WHEN near.km <= 50 THEN round(near.km, 3) END AS km
    FROM geo g LEFT JOIN near ON near.c_custkey = g.c_custkey""")
def nearest_in_area(spark, sf):
    out = spatial.with_point(view(spark, sf, "geo"), "lat", "lng", "c_mktsegment", "name", "km",
                             AREA_POINTS)
    return out.select("c_custkey", "name", F.round("km", 3).alias("km"))


# Two places for each supplier, over twice the area of the positions; positions far off besides.
MANY = """SELECT 'P' || CAST(s_suppkey * 2 + CAST(k AS BIGINT) AS STRING) AS name,
    32.0E0 + CAST((s_suppkey * 37 + 11 * k) % 301 AS DOUBLE) / 100.0E0 AS lat,
    132.0E0 + CAST((s_suppkey * 53 + 29 * k) % 401 AS DOUBLE) / 100.0E0 AS lng, '' AS area
    FROM supplier, (SELECT 0 AS k UNION ALL SELECT 1 AS k) ks"""
FAR = """CASE c_custkey % 50 WHEN 0 THEN -lat WHEN 1 THEN 89.0E0 ELSE lat END AS lat,
    CASE c_custkey % 50 WHEN 2 THEN lng - 180.0E0 ELSE lng END AS lng"""


@query(with_views("geo", many=MANY, spots=f"SELECT c_custkey, {FAR} FROM geo", near=f"""
        SELECT c_custkey, name, {_km_of('spots.lat', 'spots.lng', 'many.lat', 'many.lng')} AS km FROM spots, many""")
       + """SELECT c_custkey, name, round(km, 3) AS km FROM (SELECT *, row_number() OVER
        (PARTITION BY c_custkey ORDER BY round(km, 6), encode(name)) AS rn FROM near) WHERE rn = 1""")
def nearest_many(spark, sf):
    places = table(spark, sf, "supplier").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    places = places.selectExpr(
        "'P' || CAST(s_suppkey * 2 + CAST(k AS BIGINT) AS STRING) AS name",
        "32.0E0 + CAST((s_suppkey * 37 + 11 * k) % 301 AS DOUBLE) / 100.0E0 AS lat",
        "132.0E0 + CAST((s_suppkey * 53 + 29 * k) % 401 AS DOUBLE) / 100.0E0 AS lng", "'' AS area")
    lat, lng = FAR.split(",\n")
    at = view(spark, sf, "geo").selectExpr("c_custkey", lat, lng.strip())
    out = geo.with_nearest(at, "lat", "lng", places, out="near")
    return out.select("c_custkey", "near.name", F.round("near.km", 3).alias("km"))


# Words of the documents in the part of station names, one inside another.
WORDS = ["teau", "tea", "eri", "ould", "ing", "eaux"]
BLOCKED = ["zz", "schen"]


@query("""SELECT doc_id, CASE WHEN {blocked} THEN NULL {whens} ELSE NULL END AS name
          FROM documents""".format(
    blocked=" OR ".join(f"contains(text, '{w}')" for w in BLOCKED),
    whens=" ".join(f"WHEN contains(text, '{w}') THEN '{w}'"
                   for w in sorted(WORDS, key=len, reverse=True))))
def substring_station(spark, sf):
    name = spatial.station_in_text(F.col("text"), WORDS, BLOCKED)
    return table(spark, sf, "documents").select("doc_id", name.alias("name"))


LINES = " UNION ALL ".join(
    f"SELECT day, '{name}' AS point, {la}::DOUBLE AS point_lat, {lo}::DOUBLE AS point_lon, "
    f"arg_min(lat, row(abs(lat - {la}::DOUBLE), lat)) AS g_lat, "
    f"arg_min(lon, row(abs(lon - {lo}::DOUBLE), lon)) AS g_lon, min(depth) AS g_depth FROM grid "
    f"GROUP BY day"
    for name, la, lo, _ in fixed.CURRENT_POINTS)


@query(with_views("grid", lines=LINES, c="""SELECT g.o_orderkey, l.day, l.point, g.u, g.v, g.temp,
        g.salt, sqrt(g.u * g.u + g.v * g.v) AS s, degrees(atan2(g.u, g.v)) + 360::DOUBLE AS d0,
        sqrt(pow(l.g_lat - l.point_lat, 2) + pow(l.g_lon - l.point_lon, 2)) AS off
        FROM lines l LEFT JOIN grid g ON g.day = l.day AND g.lat = l.g_lat AND g.lon = l.g_lon
        AND g.depth = l.g_depth""",
    e="SELECT *, s * 1.944::DOUBLE AS kn, CASE WHEN d0 >= 360 THEN d0 - 360 ELSE d0 END AS d FROM c")
    + f"""SELECT CAST(day AS STRING) AS day, point, {rounded('u', 4)} AS u_ms, {rounded('v', 4)} AS v_ms,
        {rounded('s', 4)} AS speed_ms, {rounded('kn', 4)} AS speed_kn, {rounded('d', 1)} AS direction,
        {rounded('temp', 2)} AS temp_c, {rounded('salt', 3)} AS salinity, off > 0.15 AS too_far FROM e""")
def grid_points(spark, sf):
    return spatial.grid_points(view(spark, sf, "grid")).drop("lat", "lon").withColumn(
        "day", F.col("day").cast("string"))


# ---- scores ---------------------------------------------------------------------------------------------

GO = """SELECT *, lag(wind) OVER (PARTITION BY place ORDER BY t) AS before,
    wind > 8 AS strong, dir BETWEEN 135 AND 225 AS south, (dir >= 315 OR dir <= 45) AS north,
    CASE WHEN abs((dir - wave_dir + 360) % 360) > 180 THEN 360 - abs((dir - wave_dir + 360) % 360)
         ELSE abs((dir - wave_dir + 360) % 360) END AS apart FROM f"""
GO_SUM = """SELECT *, wave + CASE WHEN strong AND south THEN 0.4::DOUBLE
        WHEN strong AND NOT north THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN apart >= 120 THEN 0.2::DOUBLE WHEN apart >= 90 THEN 0.1::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN wave > 0.8::DOUBLE AND strong AND south AND apart >= 120 THEN 0.1::DOUBLE
        ELSE 0::DOUBLE END
    + CASE WHEN wind > before + 2 THEN 0.2::DOUBLE WHEN wind < before - 2 THEN -0.2::DOUBLE
        ELSE 0::DOUBLE END
    + CASE WHEN wind_wave <= 0.3::DOUBLE THEN -0.3::DOUBLE
        WHEN wind_wave >= 0.7::DOUBLE THEN 0.3::DOUBLE ELSE 0::DOUBLE END AS total,
    concat_ws('/', CASE WHEN strong AND south THEN '南風↑' WHEN north THEN '北風◎'
        WHEN strong THEN '東西風' END,
        CASE WHEN apart >= 120 THEN '逆波' WHEN apart >= 90 THEN '交差波' END,
        CASE WHEN wave > 0.8::DOUBLE AND strong AND south AND apart >= 120 THEN '複合悪化' END,
        CASE WHEN wind > before + 2 THEN '風↑' WHEN wind < before - 2 THEN '風↓' END,
        CASE WHEN wind_wave <= 0.3::DOUBLE THEN '風波小' WHEN wind_wave >= 0.7::DOUBLE THEN '風波大' END)
        AS tags FROM g"""
JS_TENTH = "greatest(0::DOUBLE, floor({0} * 10::DOUBLE + 0.5::DOUBLE) / 10::DOUBLE)"
CLASS = ("CASE WHEN {0} <= 0.8::DOUBLE THEN 3 WHEN {0} <= 1.2::DOUBLE THEN 2 "
         "WHEN {0} <= 1.6::DOUBLE THEN 1 ELSE 0 END")
GO_PARTS = {"f": FORECAST, "g": GO, "h": GO_SUM,
            "scored": f"SELECT *, {JS_TENTH.format('total')} AS raw FROM h"}


@query(with_views("fc", **GO_PARTS) + f"""
    SELECT place, t, raw, CAST({CLASS.format('raw')} AS BIGINT) AS score, tags FROM scored""")
def go_nogo(spark, sf):
    out = score.go_nogo(_forecast(spark, sf), "place", "t")
    return out.select("place", "t", "raw", F.col("score").cast("long").alias("score"),
                      F.array_join("tags", "/").alias("tags"))


# Every seventh wave is not a number, every eleventh infinite, every thirteenth missing.
ODD_WAVE = """CASE WHEN CAST(wave_direction AS INT) % 13 = 0 THEN NULL
    WHEN CAST(wave_direction AS INT) % 7 = 0 THEN CAST('NaN' AS DOUBLE)
    WHEN CAST(wave_direction AS INT) % 11 = 0 THEN CAST('Infinity' AS DOUBLE)
    ELSE wave_height END AS wave_height"""
KNOWN_WAVE = """CAST(wave_direction AS INT) % 13 <> 0 AND CAST(wave_direction AS INT) % 7 <> 0
    AND CAST(wave_direction AS INT) % 11 <> 0"""


@query(with_views("fc", **GO_PARTS, odd=f"SELECT place, time AS t, {KNOWN_WAVE} AS known FROM fc") + f"""
    SELECT s.place, s.t, CASE WHEN known THEN raw END AS raw,
           CAST(CASE WHEN known THEN {CLASS.format('raw')} ELSE 0 END AS BIGINT) AS score
    FROM scored s JOIN odd ON odd.place = s.place AND odd.t = s.t""")
def go_nogo_unknown(spark, sf):
    """Hours without a known wave are of the worst class."""
    rows = _forecast(spark, sf).withColumnRenamed("wave", "wave_height")
    odd = rows.join(aggregated(spark, sf, "fc").select(
        "place", F.col("time").alias("t"), "wave_direction"), ["place", "t"])
    odd = odd.selectExpr("place", "t", "wind", "dir", "wave_dir", "wind_wave", "rain",
                         ODD_WAVE.replace("AS wave_height", "AS wave"))
    out = score.go_nogo(odd, "place", "t")
    return out.select("place", "t", "raw", F.col("score").cast("long").alias("score"))


@query(with_views("fc", **GO_PARTS, d=f"""SELECT place, substr(t, 1, 10) AS day, coalesce(
        avg(CASE WHEN substr(t, 12, 2) IN ('06', '12') THEN raw END), arg_min(raw, t)) AS m
        FROM scored GROUP BY ALL""", e=f"SELECT place, day, {JS_TENTH.format('m')} AS raw FROM d")
       + f"SELECT place, day, raw, CAST({CLASS.format('raw')} AS BIGINT) AS score FROM e")
def day_score(spark, sf):
    out = score.day_scores(score.go_nogo(_forecast(spark, sf), "place", "t"), "place", "t")
    return out.withColumn("score", F.col("score").cast("long"))


S16_UP = "[{0}][CAST(floor({1} / 22.5::DOUBLE + 0.5::DOUBLE) AS INT) % 16 + 1]"
SECTORS_JA = ", ".join(f"'{n}'" for n in fixed.COMPASS_16_JA)


@query(with_views("fc", **GO_PARTS, v=f"SELECT *, {CLASS.format('raw')} AS cls FROM scored") + f"""
    SELECT place, t AS time, printf('%.2f', wave) AS wave_m, printf('%.1f', wind) AS wind_ms,
        dir AS wind_dir_deg, {S16_UP.format(SECTORS_JA, 'dir')} AS wind_dir,
        CAST(wave_dir AS STRING) AS wave_dir_deg, {S16_UP.format(SECTORS_JA, 'wave_dir')} AS wave_dir,
        printf('%.1f', rain) AS rain_mm, CAST(cls AS BIGINT) AS score,
        ['× 出船不可', '△ 未定・要確認', '○ 出船可能', '◎ 釣り日和'][cls + 1] AS judge,
        ['❌ 中止', '⚠ 要確認', '✅ 出船可', '✅ 出船可'][cls + 1] AS notif_status,
        tags AS penalties FROM v""")
def scored_export(spark, sf):
    out = score.scored_export(score.go_nogo(_forecast(spark, sf), "place", "t"), "place", "t")
    return out.withColumns({"score": F.col("score").cast("long"),
                            "wind_dir_deg": F.col("wind_dir_deg").cast("long")})


SUIT = dict(
    env=f"SELECT point AS station, day, v AS water, degrees / 100::DOUBLE AS wave, {MOON_AGE} AS moon "
        f"FROM cond",
    env2=f"SELECT *, {TIDE} AS tide FROM env",
    joined="SELECT c.species, e.water, e.wave, e.moon, e.tide FROM catch c LEFT JOIN env2 e "
           "ON e.day = c.day AND e.station = c.point",
    long="SELECT species, 'water' AS metric, water AS value FROM joined UNION ALL "
         "SELECT species, 'moon', moon FROM joined UNION ALL SELECT species, 'wave', wave FROM joined",
    **summary_parts("long", ["species", "metric"]),
    prof="""SELECT species, max(CASE WHEN metric = 'water' THEN mean END) AS wm,
        max(CASE WHEN metric = 'water' THEN std END) AS ws,
        max(CASE WHEN metric = 'moon' THEN mean END) AS mm,
        max(CASE WHEN metric = 'moon' THEN std END) AS ms,
        max(CASE WHEN metric = 'wave' THEN p75 END) AS vp FROM s_out GROUP BY species""",
    **trend_parts("cond"),
    labelled=f"""SELECT c.species, t.label FROM (SELECT DISTINCT species, day FROM catch) c
        LEFT JOIN (SELECT day, label FROM trend WHERE point = '{POINTS[0]}') t ON c.day = t.day""",
    lshare=share_select("labelled", ["species"], "label"),
    tshare=share_select("joined", ["species"], "tide"),
    span="SELECT station, max(day) AS latest FROM env GROUP BY station",
    days="SELECT station, CAST(unnest(generate_series(latest - 29, latest, INTERVAL 1 DAY)) AS DATE) "
         "AS day FROM span",
    pieces=f"""SELECT d.station, d.day, p.species, e.water, e.wave, e.tide, e.moon,
        coalesce(t.label, '不明') AS label, t.change1, t.change7, sp.v AS speed, p.*EXCLUDE (species), coalesce(l.pct, 0::DOUBLE) / 100 * 20 AS lp,
        coalesce(ts.pct, 0::DOUBLE) / 100 * 20 AS tp
        FROM days d CROSS JOIN prof p
        LEFT JOIN env2 e ON e.station = d.station AND e.day = d.day
        LEFT JOIN trend t ON t.point = d.station AND t.day = d.day
        LEFT JOIN (SELECT day, v FROM cond WHERE point = '{POINTS[1]}') sp ON sp.day = d.day
        LEFT JOIN lshare l ON l.species = p.species AND l.label = coalesce(t.label, '不明')
        LEFT JOIN tshare ts ON ts.species = p.species AND ts.tide = e.tide""",
    total=f"""SELECT *, CASE WHEN water IS NOT NULL THEN greatest(0::DOUBLE, 40 - abs(water - wm)
            / greatest(ws, 0.5::DOUBLE) * 15) ELSE 0::DOUBLE END + {rounded('lp', 1)} + {rounded('tp', 1)}
        + CASE WHEN moon IS NOT NULL THEN greatest(0::DOUBLE, 10 - abs(moon - mm)
            / greatest(ms, 1::DOUBLE) * 4) ELSE 0::DOUBLE END
        + CASE WHEN wave <= vp THEN 10::DOUBLE ELSE 0::DOUBLE END AS s FROM pieces""")


@query(with_views("catch", "cond", **SUIT) + f"""
    SELECT station, CAST(day AS STRING) AS day, species, {rounded('s', 1)} AS score,
           {rounded('water', 2)} AS water, tide, label, {rounded('speed', 2)} AS speed,
           {rounded('wave', 2)} AS wave, change1, change7 FROM total""")
def suitability_30d(spark, sf):
    env = _conditions(spark, sf)
    catch = view(spark, sf, "catch")
    joined = enrich.with_conditions(catch, env, "day", "point", "day", "station",
                                    {c: c for c in ("water", "wave", "moon", "tide")})
    numbers = profile.summary(profile.metrics_long(joined, ["species"], ["water", "moon", "wave"]),
                              ["species", "metric"])
    wanted = {"water": ["mean", "std", "p25", "p75"], "moon": ["mean", "std"], "wave": ["p75"]}
    profiles = numbers.groupBy("species").agg(*[
        F.max(F.when(F.col("metric") == m, F.col(s))).alias(f"{m}_{s}")
        for m, stats in wanted.items() for s in stats])
    labels = trend.calendar_trend(env, "station", "day", "water")
    shares = profile.label_shares(catch, labels.where(F.col("station") == POINTS[0]), "species",
                                  "day", "label")
    tides = profile.frequency(joined, ["species"], "tide")
    speeds = env.where(F.col("station") == POINTS[1]).select("day", F.col("water").alias("speed"))
    out = score.suitability(env, labels, profiles, shares, tides, "station", "day", "species", POINTS,
                            speeds=speeds)
    return out.withColumn("day", F.col("day").cast("string"))


# ---- cache look-up ----------------------------------------------------------------------------------------


@query("""SELECT n.n_nationkey, n.name, CASE WHEN n.name = '' THEN 'empty' WHEN c.name IS NULL THEN 'miss'
        WHEN c.lat IS NULL THEN 'negative_hit' ELSE 'hit' END AS status, c.lat, c.lng,
        CASE WHEN n.name = '' THEN 'empty_spot_name' WHEN c.name IS NULL THEN 'cache_only_miss'
             WHEN c.lat IS NULL THEN coalesce(c.reason, 'negative_cache') END AS reason
    FROM (SELECT c_custkey AS n_nationkey, CASE WHEN c_custkey % 10 = 9 THEN '' ELSE
              'S' || CAST(c_nationkey AS STRING) END AS name FROM customer) n
    LEFT JOIN (SELECT 'S' || CAST(s_nationkey AS STRING) AS name,
            CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS lat,
            CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) * 2 END AS lng,
            CASE WHEN s_nationkey % 8 = 0 THEN 'no_hit' END AS reason
        FROM (SELECT DISTINCT s_nationkey FROM supplier)) c ON c.name = n.name""")
def cache_lookup(spark, sf):
    spots = table(spark, sf, "customer").selectExpr(
        "c_custkey AS n_nationkey", "CASE WHEN c_custkey % 10 = 9 THEN '' ELSE "
        "'S' || CAST(c_nationkey AS STRING) END AS name")
    cache = table(spark, sf, "supplier").select("s_nationkey").distinct().selectExpr(
        "'S' || CAST(s_nationkey AS STRING) AS name",
        "CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS lat",
        "CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) * 2 END AS lng",
        "'nominatim' AS source", "CASE WHEN s_nationkey % 8 = 0 THEN 'no_hit' END AS reason")
    out = dimensions.cached_coordinates(spots, cache, "name")
    return out.select("n_nationkey", "name", "status", "lat", "lng", "reason")
