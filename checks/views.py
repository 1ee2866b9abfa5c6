"""The test tables dressed as catch, condition, current and forecast tables.

The same expressions serve Spark and the checking SQL; they keep to what both
dialects read alike. ``TABLES`` gives each view's source and columns.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POINTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _case(value: str, *texts: str, rest: str | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"CASE {value} {whens} ELSE {rest or 'NULL'} END"


def _text(number: str) -> str:
    return f"CAST(CAST({number} AS BIGINT) AS STRING)"


SHIP_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
POINT_OF_SUPPLIER = _case("l_suppkey % 5", *POINTS)
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

CATCH = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "day": "CAST(l_shipdate AS DATE)",
    "species": "l_returnflag || l_linestatus",
    "point": POINT_OF_SUPPLIER,
    "boat": f"'boat' || {_text('l_suppkey % 3')}",
    "spot": _case("l_suppkey % 6", "室戸沖", "高知 室戸沖", "足摺港", "宇和島", "", "甲浦"),
    "method": "CASE WHEN l_linenumber = 5 THEN '' ELSE 'M' || " + _text("l_linenumber") + " END",
    "count": "CASE WHEN l_linenumber = 1 THEN 0.0E0 ELSE l_quantity END",
    "size": "CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity * 2.0E0 END",
    "weight": "l_extendedprice",
    "discount": "l_discount",
    "degrees": "CAST((l_partkey * 7) % 360 AS DOUBLE)",
}

MASTER = {
    "record_id": f"{_text('l_orderkey')} || '-' || {_text('l_linenumber')}",
    "date": f"CASE l_linenumber WHEN 3 THEN replace({SHIP_DAY}, '-', '/') WHEN 7 THEN '' "
            f"ELSE {SHIP_DAY} END",
    "time": f"CASE WHEN l_linenumber = 2 THEN '' ELSE {_text('l_suppkey % 26')} || ':' || "
            f"{_text('l_partkey % 60')} END",
    "species": "CASE WHEN l_linenumber = 6 AND l_discount = 0 THEN '' "
               "ELSE l_returnflag || l_linestatus END",
    "size_cm": _text("floor(l_quantity) * 5"),
    "weight_kg": "CASE WHEN l_linenumber = 4 AND l_discount = 0 THEN 'abc' ELSE "
                 + _text("floor(l_extendedprice / 700.0E0)") + " END",
    "count": _text("l_linenumber - 1"),
    "bait": "''",
    "method": f"'M' || {_text('l_linenumber')}",
    "spot": _case("l_suppkey % 6", "室戸沖", "高知 室戸沖(磯)", "安満地(風裏)", "足摺港",
                  "", "和歌山県"),
    "spot_lat": _text("l_partkey % 100"),
    "spot_lng": _text("l_partkey % 200"),
    "nearest_station": _case("l_suppkey % 9", "室戸岬沖", "高知市沖", "足摺岬沖", "宇和島沖",
                             "松山沖", "来島海峡", "高松沖", "阿南市沖", "室戸"),
    "tide": _case("l_suppkey % 7", "大潮", "中潮", "小潮", "長潮", "若潮", "満ち", ""),
    "weather": _case("l_partkey % 6", "晴れ", "曇り", "雨", "雪", "くもり", ""),
    "temp": "''",
    "water_temp": _text("floor(l_quantity)"),
    "wind": "''",
    "memo": "CASE WHEN l_linenumber = 1 THEN ' note ' ELSE '' END",
    "source": _case("l_partkey % 6", "manual", "instagram", "blog:x", "Manual", "室戸2ブログ",
                    "import:csv_v5.5"),
    "canonical_spot": "''", "sea_area": "''",
    "entered_at": f"{SHIP_DAY} || 'T00:00:00+09:00'",
    "source_detail": f"CASE WHEN l_linenumber = 1 THEN 'post' || {_text('l_orderkey')} ELSE '' END",
    "prompt_version": "''", "confidence": "''",
    "boat_id": f"'boat' || {_text('l_suppkey % 3')}",
    "area_id": f"'area' || {_text('l_suppkey % 2')}",
}

HOURLY = {
    "event_id": "event_id", "user_id": "user_id", "ts": "ts",
    "station": "event_type",
    "day": "CAST(ts AS DATE)",
    "hour": "CAST(extract(hour FROM ts) AS INT)",
    "value": "value", "k": K,
    "direction": f"CAST(({K} * 7) % 360 AS DOUBLE)",
    "code": _case(f"{K} % 8", "0", "1", "2", "3", "45", "61", "62", "95"),
}

GEO = {
    "c_custkey": "c_custkey", "c_name": "c_name", "c_mktsegment": "c_mktsegment",
    "lat": "32.5E0 + CAST(c_custkey % 200 AS DOUBLE) / 100.0E0",
    "lng": "132.5E0 + CAST((c_custkey * 7) % 250 AS DOUBLE) / 100.0E0",
}

GRID = {
    "day": "CAST(o_orderdate AS DATE)",
    "depth": "CAST(o_custkey % 3 AS DOUBLE)",
    "lat": "33.0E0 + CAST(o_orderkey % 13 AS DOUBLE) / 40.0E0",
    "lon": "134.0E0 + CAST(o_custkey % 11 AS DOUBLE) / 40.0E0",
    "u": "(o_totalprice - 250000.0E0) / 250000.0E0",
    "v": "(CAST(o_custkey % 101 AS DOUBLE) - 50.0E0) / 50.0E0",
    "temp": "o_totalprice / 20000.0E0",
    "salt": "30.0E0 + o_totalprice / 100000.0E0",
    "o_orderkey": "o_orderkey",
}

TABLES = {"catch": ("lineitem", CATCH), "master": ("lineitem", MASTER),
          "hourly": ("events", HOURLY), "geo": ("customer", GEO), "grid": ("orders", GRID)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = TABLES[name]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{expression} AS `{column}`" for column, expression in columns.items()])


def view_sql(name: str) -> str:
    source, columns = TABLES[name]
    return f"{name} AS (SELECT " + ", ".join(
        f'{expression} AS "{column}"' for column, expression in columns.items()
    ) + f" FROM {source})"


# Views that need an aggregate: Spark SQL text and checking SQL are the same.
AGGREGATED = {
    # Daily means per point. Decimal sums: the same whatever the order of rows.
    "cond": """
        SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS point,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
                   / CAST(count(*) AS DOUBLE) / 10000.0E0 AS v,
               CAST(max(o_custkey) % 360 AS DOUBLE) AS degrees
        FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority""",
    # Means of the hours 0, 6, 12 and 18 as a forecast.
    "fc": f"""
        SELECT event_type AS place,
               CAST(CAST(ts AS DATE) AS STRING) || 'T'
                   || CASE WHEN extract(hour FROM ts) < 10 THEN '0' ELSE '' END
                   || CAST(extract(hour FROM ts) AS STRING) || ':00' AS time,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
                   / CAST(count(*) AS DOUBLE) / 40.0E0 AS wave_height,
               CAST(min(({K} * 11) % 360) AS DOUBLE) AS wave_direction,
               CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 10.0E0 AS wind_wave_height,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
                   / CAST(count(*) AS DOUBLE) / 5.0E0 AS wind_speed_10m,
               CAST(max(({K} * 7) % 360) AS DOUBLE) AS wind_direction_10m,
               CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 50.0E0 AS precipitation
        FROM events WHERE extract(hour FROM ts) IN (0, 6, 12, 18)
        GROUP BY event_type, CAST(ts AS DATE), extract(hour FROM ts)""",
}


def aggregated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = "orders" if name == "cond" else "events"
    return spark.sql(AGGREGATED[name].replace(f"FROM {source}", "FROM {source}"),
                     source=table(spark, sf_dir, source))


def aggregated_sql(name: str) -> str:
    return f"{name} AS ({AGGREGATED[name]})"
