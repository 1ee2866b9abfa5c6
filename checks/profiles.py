"""Queries: statistics, frequencies, trends, timeline."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import compass, fixed, sky
from tidewright.functions.numbers import py_round, round_columns
from tidewright.operators import latest, profile, timeline as series, trend

from .registry import (MOON_AGE, PHASE, query, rounded, sector_sql, share_select, summary_parts,
                       trend_parts, with_views)
from .views import POINTS, aggregated, view

METRICS = ["count", "size", "weight", "discount"]
LONG = " UNION ALL ".join(
    f"SELECT species, boat, '{m}' AS metric, \"{m}\" AS value FROM catch" for m in METRICS)
S8 = sector_sql(fixed.COMPASS_8, "trunc((degrees + 22.5::DOUBLE) / 45::DOUBLE)")


def day_text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query(with_views("catch", long=LONG, **summary_parts("long", ["species", "metric"]))
       + "SELECT * FROM s_out")
def profile_stats(spark, sf):
    rows = profile.metrics_long(view(spark, sf, "catch"), ["species"], METRICS)
    return profile.summary(rows, ["species", "metric"])


@query(with_views("catch", long="""SELECT species, 'weight' AS metric, CASE WHEN l_partkey % 7 < 3
        THEN NULL ELSE weight END AS value FROM catch""", **summary_parts("long", ["species", "metric"]))
       + "SELECT * FROM s_out")
def profile_nonfinite(spark, sf):
    """Values that are not finite count as missing."""
    rows = view(spark, sf, "catch").withColumn("weight", F.expr("""CASE l_partkey % 7
        WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
        WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE weight END"""))
    return profile.summary(profile.metrics_long(rows, ["species"], ["weight"]), ["species", "metric"])


@query(with_views("catch", long=LONG, **summary_parts("long", ["metric"])) + "SELECT * FROM s_out")
def baseline(spark, sf):
    return profile.summary(profile.metrics_long(view(spark, sf, "catch"), [], METRICS), ["metric"])


@query(with_views("cond", **summary_parts("cond", ["point"], "v")) + "SELECT * FROM s_out")
def station_baseline(spark, sf):
    return profile.summary(aggregated(spark, sf, "cond"), ["point"], "v")


@query(with_views("catch") + share_select("catch", ["species"], "method"))
def freq_pct(spark, sf):
    return profile.frequency(view(spark, sf, "catch"), ["species"], "method")


@query(with_views("catch") + share_select("catch", [], "spot"))
def baseline_freq(spark, sf):
    return profile.frequency(view(spark, sf, "catch"), [], "spot")


@query(with_views(
    "catch", scoped="SELECT 'all' AS boat, species, count AS value FROM catch UNION ALL "
                  "SELECT boat, species, count FROM catch",
    **summary_parts("scoped", ["boat", "species"])) + "SELECT * FROM s_out")
def fleet_and_boat(spark, sf):
    return profile.fleet_and_boat(view(spark, sf, "catch"), "boat", ["species"], "count")


POINT_DAYS = ("SELECT c.species, cond.point, cond.v AS speed, cond.v / 2::DOUBLE AS temp, "
              "cond.v + 20::DOUBLE AS salinity, cond.degrees FROM "
              "(SELECT DISTINCT species, day FROM catch) c JOIN cond ON c.day = cond.day")
POINT_LONG = " UNION ALL ".join(f"SELECT species, point, '{m}' AS metric, {m} AS value FROM pd"
                                for m in ("speed", "temp", "salinity"))


def _currents(spark, sf):
    v = F.col("v")
    return aggregated(spark, sf, "cond").select(
        "day", "point", v.alias("speed"), (v / 2).alias("temp"),
        (v + F.lit(20.0)).alias("salinity"), F.col("degrees"))


def _point_profiles(spark, sf):
    return profile.point_profiles(view(spark, sf, "catch"), _currents(spark, sf), "species", "day",
                                  "point", "speed", "temp", "salinity", "degrees")


@query(with_views("catch", "cond", pd=POINT_DAYS, long=POINT_LONG,
                  **summary_parts("long", ["species", "point", "metric"])) + "SELECT * FROM s_out")
def point_profiles(spark, sf):
    return _point_profiles(spark, sf)[0]


@query(with_views("catch", "cond", pd=POINT_DAYS,
                  sectors=f"SELECT species, point, {S8} AS sector FROM pd")
       + share_select("sectors", ["species", "point"], "sector"))
def point_sectors(spark, sf):
    return _point_profiles(spark, sf)[1]


@query(with_views("catch") + """
    SELECT species, count(*) AS total_records, count(DISTINCT day) AS catch_days,
           CAST(min(day) AS STRING) AS first_day, CAST(max(day) AS STRING) AS last_day
    FROM catch GROUP BY species HAVING count(DISTINCT day) >= 2""")
def headline(spark, sf):
    return day_text(profile.headline(view(spark, sf, "catch"), "species", "day"),
                    "first_day", "last_day")


@query(with_views("cond") + """
    SELECT point, count(*) AS total_records, count(DISTINCT day) AS catch_days,
           CAST(min(day) AS STRING) AS first_day, CAST(max(day) AS STRING) AS last_day
    FROM cond GROUP BY point""")
def table_counts(spark, sf):
    return day_text(profile.table_counts(aggregated(spark, sf, "cond"), "point", "day"),
                    "first_day", "last_day")


@query(with_views("catch") + """
    SELECT s.species, CAST(m.month AS INT) AS month, CAST(coalesce(sum(CASE WHEN c.count IS NULL
           OR c.count = 0 THEN 1 ELSE trunc(c.count) END), 0) AS BIGINT) AS total
    FROM (SELECT DISTINCT species FROM catch) s CROSS JOIN range(1, 13) m(month)
    LEFT JOIN catch c ON c.species = s.species AND month(c.day) = m.month
    GROUP BY s.species, m.month""")
def month_dist(spark, sf):
    return profile.month_totals(view(spark, sf, "catch"), ["species"], "day", "count")


@query(with_views("catch", picked="SELECT species, CASE WHEN count <> 0 THEN count ELSE size END "
                                  "AS x FROM catch") + """
    SELECT species, CAST(CAST(floor(x / 2) * 2 AS BIGINT) AS STRING) || '〜'
           || CAST(CAST(floor(x / 2) * 2 + 2 AS BIGINT) AS STRING) || '℃' AS bin, count(*) AS n
    FROM picked WHERE x IS NOT NULL GROUP BY ALL""")
def width_bins(spark, sf):
    return profile.width_bins(view(spark, sf, "catch"), ["species"], "count", "size")


@query(with_views("catch", x="SELECT species, discount * 12::DOUBLE AS kn FROM catch") + """
    SELECT species, CASE WHEN kn < 0.3::DOUBLE THEN '弱(0〜0.3kn)'
           WHEN kn < 0.6::DOUBLE THEN '中(0.3〜0.6kn)'
           WHEN kn < 1::DOUBLE THEN '強(0.6〜1.0kn)' ELSE '激流(1.0kn+)' END AS bin, count(*) AS n
    FROM x WHERE kn IS NOT NULL GROUP BY ALL""")
def edge_bins(spark, sf):
    rows = view(spark, sf, "catch").withColumn("kn", F.col("discount") * 12.0)
    return profile.edge_bins(rows, ["species"], "kn")


@query(with_views("catch", sectors=f"SELECT species, {S8} AS sector FROM catch")
       + share_select("sectors", ["species"], "sector"))
def sector_dist(spark, sf):
    return profile.sector_shares(view(spark, sf, "catch"), ["species"], "degrees")


MONTHS = """SELECT year(day) AS year, month(day) AS month, point, avg(v) AS a, avg(degrees) AS b,
            max(v) AS c, count(v) AS days FROM cond GROUP BY ALL"""


@query(with_views("cond", m=MONTHS)
       + f"SELECT year, month, point, {rounded('a', 2)} AS avg_speed_kn, "
         f"{rounded('b', 2)} AS avg_direction, days FROM m")
def monthly_summary(spark, sf):
    return profile.month_means(aggregated(spark, sf, "cond"), "day", "point",
                               {"avg_speed_kn": "v", "avg_direction": "degrees"}, 2, "v").withColumns(
        {"year": F.col("year").cast("long"), "month": F.col("month").cast("long")})


@query(with_views("cond", m=MONTHS)
       + f"SELECT year, month, point, {rounded('a', 3)} AS avg_speed_ms, "
         f"{rounded('b', 3)} AS avg_direction, {rounded('c', 3)} AS max_speed_kn, "
         f"days AS count FROM m")
def monthly_summary_max(spark, sf):
    return profile.month_means(
        aggregated(spark, sf, "cond"), "day", "point",
        {"avg_speed_ms": "v", "avg_direction": "degrees"}, 3, "v", {"max_speed_kn": "v"}, "count"
    ).withColumns({"year": F.col("year").cast("long"), "month": F.col("month").cast("long")})


THRESHOLDS = """SELECT species, max(CASE WHEN rk = CAST(floor(n * 0.8::DOUBLE) AS BIGINT)
                THEN weight END) AS threshold FROM (SELECT species, weight,
                count(*) OVER (PARTITION BY species) AS n,
                row_number() OVER (PARTITION BY species ORDER BY weight) - 1 AS rk FROM catch
                WHERE weight IS NOT NULL) GROUP BY species"""


@query(with_views("catch", t=THRESHOLDS)
       + f"SELECT species, {rounded('threshold', 2)} AS threshold FROM t")
def big_threshold(spark, sf):
    return profile.big_thresholds(view(spark, sf, "catch"), "species", "weight")


@query(with_views("catch", t=THRESHOLDS, big="SELECT c.day, c.species FROM catch c JOIN t "
                  "ON c.species = t.species WHERE c.weight >= t.threshold") + """
    SELECT CAST(a.day AS STRING) AS day, a.names AS caught, coalesce(b.names, '') AS big
    FROM (SELECT day, string_agg(DISTINCT species, ',' ORDER BY species) AS names
          FROM catch GROUP BY day) a
    LEFT JOIN (SELECT day, string_agg(DISTINCT species, ',' ORDER BY species) AS names
          FROM big GROUP BY day) b ON a.day = b.day""")
def day_sets(spark, sf):
    catch = view(spark, sf, "catch")
    limits = profile.big_thresholds(catch, "species", "weight", digits=None)
    sets = profile.catch_sets(catch, limits, "day", "species", "weight")
    return sets.select(F.col("day").cast("string").alias("day"),
                       F.array_join("caught", ",").alias("caught"),
                       F.array_join("big", ",").alias("big"))


@query(with_views("catch") + "SELECT DISTINCT method FROM catch WHERE method <> ''")
def distinct_lists(spark, sf):
    return profile.distinct_sorted(view(spark, sf, "catch"), "method")


# ---- trends -------------------------------------------------------------------------


@query(with_views("cond", **trend_parts("cond"))
       + f"SELECT point, CAST(day AS STRING) AS day, ma7, change1, change7, label, "
         f"{rounded('value', 2)} AS value FROM trend")
def calendar_trend(spark, sf):
    out = trend.calendar_trend(aggregated(spark, sf, "cond"), "point", "day", "v")
    return out.select("point", F.col("day").cast("string").alias("day"), "ma7", "change1",
                      "change7", "label", py_round("v", 2).alias("value"))


@query(with_views("cond", **trend_parts("cond", digits=3, speed=True))
       + "SELECT point, CAST(day AS STRING) AS day, ma7, change7, label FROM trend")
def speed_trend(spark, sf):
    out = trend.calendar_trend(aggregated(spark, sf, "cond"), "point", "day", "v",
                               fixed.SPEED_TREND, 3)
    return out.select("point", F.col("day").cast("string").alias("day"), "ma7", "change7", "label")


@query(with_views("catch", "cond", **trend_parts("cond"), labelled=f"""
    SELECT c.species, t.label FROM (SELECT DISTINCT species, day FROM catch) c
    LEFT JOIN (SELECT day, label FROM trend WHERE point = '{POINTS[0]}') t ON c.day = t.day""")
       + share_select("labelled", ["species"], "label"))
def trend_distribution(spark, sf):
    return flagship(spark, sf)


def flagship(spark, sf):
    """Share of catch days by seven-day trend label of one station, per species."""
    daily = aggregated(spark, sf, "cond").where(F.col("point") == POINTS[0])
    labels = trend.calendar_trend(daily, "point", "day", "v")
    return profile.label_shares(view(spark, sf, "catch"), labels, "species", "day", "label")


def _conditions(spark, sf):
    moon = sky.moon_age(F.col("day"))
    return aggregated(spark, sf, "cond").select(
        F.col("point").alias("station"), "day", F.col("v").alias("water"),
        (F.col("degrees") / 100.0).alias("wave"), moon.alias("moon")).withColumns({
            "tide": sky.tide_class(F.col("moon")), "phase": sky.moon_phase(F.col("moon"))})


@query(with_views("catch", "cond", **trend_parts("cond"), t=THRESHOLDS, days=f"""
    SELECT day, v AS water, {MOON_AGE} AS moon FROM cond WHERE point = '{POINTS[0]}'""",
    flow=f"SELECT day, v AS speed, degrees FROM cond WHERE point = '{POINTS[1]}'",
    # the trend view holds the two-decimal form; the speed of the other point has three
    sraw=f"""SELECT day, avg(speed) OVER w AS m, speed - max(speed) OVER (ORDER BY day RANGE
        BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS c7 FROM flow
        WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
    sround=f"SELECT day, {rounded('m', 3)} AS m3, {rounded('c7', 3)} AS c7 FROM sraw",
    caught="SELECT day, string_agg(DISTINCT species, ',' ORDER BY species) AS names "
           "FROM catch GROUP BY day",
    big="SELECT c.day, string_agg(DISTINCT c.species, ',' ORDER BY c.species) AS names "
        "FROM catch c JOIN t ON c.species = t.species WHERE c.weight >= t.threshold "
        "GROUP BY c.day") + f"""
    SELECT CAST(d.day AS STRING) AS day, {rounded('d.water', 2)} AS water, d.moon, {PHASE} AS phase,
        w.ma7 AS water_ma7, w.label AS water_trend, w.change1 AS water_change1,
        {rounded('f.speed', 2)} AS speed, {rounded('s.m3', 2)} AS speed_ma7,
        CASE WHEN s.day IS NULL THEN NULL WHEN s.c7 IS NULL THEN '不明'
             WHEN s.c7 >= 0.2 THEN '流速増加' WHEN s.c7 <= -0.2 THEN '流速減少'
             ELSE '流速安定' END AS speed_trend,
        f.degrees AS direction, coalesce(caught.names, '') AS species_caught,
        coalesce(big.names, '') AS species_big
    FROM days d LEFT JOIN (SELECT * FROM trend WHERE point = '{POINTS[0]}') w ON w.day = d.day
    LEFT JOIN flow f ON f.day = d.day LEFT JOIN sround s ON s.day = d.day
    LEFT JOIN caught ON caught.day = d.day LEFT JOIN big ON big.day = d.day""")
def timeline(spark, sf):
    out = series.timeline(
        _conditions(spark, sf),
        _currents(spark, sf).withColumnRenamed("degrees", "direction"),
        view(spark, sf, "catch"), "station", "day", "point", POINTS[0], POINTS[1],
        "species", "weight")
    return out.withColumns({"day": F.col("day").cast("string"),
                            "species_caught": F.array_join("species_caught", ","),
                            "species_big": F.array_join("species_big", ",")})


@query(with_views("catch") + """
    SELECT species, count(*) AS n, CAST(min(day) AS STRING) AS first_day,
           CAST(max(day) AS STRING) AS last_day FROM catch
    WHERE day BETWEEN DATE '2001-11-04' - INTERVAL 12 MONTH AND DATE '2001-11-04'
    GROUP BY species""")
def trailing_period(spark, sf):
    rows = trend.trailing_period(view(spark, sf, "catch"), "day",
                                 F.lit("2001-11-04").cast("date"), 12)
    return day_text(rows.groupBy("species").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day")), "first_day", "last_day")


@query(with_views("cond") + f"""
    SELECT CAST(day AS STRING) AS day, point, {rounded('v', 2)} AS v FROM
    (SELECT * FROM cond ORDER BY day DESC, point LIMIT 35)""")
def latest_n(spark, sf):
    rows = latest.newest(aggregated(spark, sf, "cond"),
                         [F.col("day").desc(), F.col("point").asc()], 7 * len(POINTS))
    return rows.select(F.col("day").cast("string").alias("day"), "point",
                       py_round("v", 2).alias("v"))


@query(with_views("grid", g="SELECT o_orderkey, sqrt(u * u + v * v) AS s, "
                  "degrees(atan2(u, v)) + 360::DOUBLE AS d0 FROM grid",
                  h="SELECT o_orderkey, s, s * 1.944::DOUBLE AS kn, "
                    "CASE WHEN d0 >= 360 THEN d0 - 360 ELSE d0 END AS d FROM g")
       + f"SELECT o_orderkey, {rounded('s', 4)} AS speed_ms, {rounded('kn', 4)} AS speed_kn, "
         f"{rounded('d', 1)} AS direction, "
         f"{sector_sql(fixed.COMPASS_8_JA, 'trunc((d + 22.5::DOUBLE) / 45::DOUBLE)')} AS sector "
         f"FROM h")
def vector_current(spark, sf):
    u, v = F.col("u"), F.col("v")
    raw = view(spark, sf, "grid").select(
        "o_orderkey", compass.flow_speed(u, v).alias("speed_ms"),
        compass.knots(compass.flow_speed(u, v)).alias("speed_kn"),
        compass.flow_direction(u, v).alias("direction")).withColumn(
            "sector", compass.sector8(F.col("direction"), fixed.COMPASS_8_JA))
    return round_columns(round_columns(raw, 4, "speed_ms", "speed_kn"), 1, "direction")


@query(with_views("hourly", h="SELECT event_id, CAST(k AS DOUBLE) * 11.25::DOUBLE % 360 AS d, "
                  "direction AS e FROM hourly")
       + f"""SELECT event_id, {sector_sql(fixed.COMPASS_16, 'round_even(d / 22.5::DOUBLE, 0)')} AS even,
             {sector_sql(fixed.COMPASS_16_JA, 'floor(d / 22.5::DOUBLE + 0.5::DOUBLE)')} AS up,
             CASE WHEN abs((d - e + 360) % 360) > 180 THEN 360 - abs((d - e + 360) % 360)
                  ELSE abs((d - e + 360) % 360) END AS apart FROM h""")
def sector16(spark, sf):
    degrees = (F.col("k").cast("double") * 11.25) % 360
    return view(spark, sf, "hourly").select(
        "event_id", compass.sector16(degrees).alias("even"),
        compass.sector16_up(degrees).alias("up"),
        compass.angle_between(degrees, F.col("direction")).alias("apart"))


@query(with_views("catch", m=f"SELECT DISTINCT day, {MOON_AGE} AS moon FROM catch") + """
    SELECT CAST(day AS STRING) AS day, moon, """ + PHASE + " AS phase, "
       + "CASE WHEN moon <= 2 OR moon >= 28 THEN '大潮' WHEN moon <= 5 THEN '中潮' "
         "WHEN moon <= 8 THEN '小潮' WHEN moon <= 10 THEN '長潮' WHEN moon <= 12 THEN '若潮' "
         "WHEN moon <= 16 THEN '大潮' WHEN moon <= 19 THEN '中潮' WHEN moon <= 22 THEN '小潮' "
         "WHEN moon <= 24 THEN '長潮' WHEN moon <= 26 THEN '若潮' ELSE '中潮' END AS tide FROM m")
def moon_calendar(spark, sf):
    days = view(spark, sf, "catch").select("day").distinct().withColumn(
        "moon", sky.moon_age(F.col("day")))
    return days.select(F.col("day").cast("string").alias("day"), "moon",
                       sky.moon_phase(F.col("moon")).alias("phase"),
                       sky.tide_class(F.col("moon")).alias("tide"))
