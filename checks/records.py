"""Queries: normalisation, ids, quality, merges, wide tables, streams."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewright import session
from tidewright.functions import fixed, text
from tidewright.functions.numbers import round_columns
from tidewright.operators import merge, normalise, quality, rollup, spatial
from tidewright.operators.latest import keep_first
from tidewright.plans import ingest, wide
from tidewright.session import fresh_path
from tidewright.sources import dimensions, files, payload, sinks
from tidewright.streaming import jobs

from .joins import DAILY, S16, WEATHER_CODES, _nearest_sql
from .registry import in_list, query, rounded, with_views
from .views import POINTS, SHIP_DAY, TABLES, aggregated, table, view

NAMESPACE = uuid.UUID(fixed.RECORD_ID_NAMESPACE).hex
PREFIXES = "|".join(sorted(fixed.SPOT_PREFIXES, key=len, reverse=True))
CANONICAL = ("regexp_replace(translate(spot, ' 　()（）', ''), '^(?:" + PREFIXES + ")(.+)$', '\\1')")
ALIASES = ("CASE c " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fixed.SPOT_ALIASES.items())
           + " ELSE c END")
SOURCES_OUT = ("CASE WHEN {0} = 'manual' THEN 'Manual' WHEN {0} = 'instagram' THEN 'Instagram' "
               "WHEN {0} = 'other' THEN 'Other' WHEN {0} LIKE 'blog:%' OR {0} LIKE 'import:%' OR "
               "{0} LIKE 'ocr:%' THEN upper({0}[1]) || {0}[2:] ELSE {0} END")
SOURCES_IN = ("CASE {0} WHEN 'Manual' THEN 'manual' WHEN 'Instagram' THEN 'instagram' "
              "WHEN 'Other' THEN 'other' ELSE {0} END")
ISO = "replace(date, '/', '-')"
CLOCK = ("CASE WHEN time = '' THEN '' WHEN CAST(split_part(time, ':', 1) AS INT) < 24 THEN "
         "lpad(split_part(time, ':', 1), 2, '0') || ':' || lpad(split_part(time, ':', 2), 2, '0') "
         "ELSE time END")


def _uuid_sql(seed: str) -> str:
    h = f"sha1(unhex('{NAMESPACE}') || encode({seed}))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


ID_SEED = " || '|' || ".join(["boat_id", *[
    SOURCES_IN.format("source") if c == "source" else f"trim({c})" for c in fixed.RECORD_ID_COLUMNS]])


@query(with_views("master") + f"""SELECT {_uuid_sql(ID_SEED)} AS record_id, date, species,
    {SOURCES_IN.format('source')} AS source,
    CASE WHEN date = '' THEN '' ELSE date || 'T00:00:00+09:00' END AS entered_at, boat_id, area_id
    FROM master""")
def record_id(spark, sf):
    drops = view(spark, sf, "master")
    out = normalise.to_master(drops, F.col("boat_id"), F.col("area_id"))
    return out.select("record_id", "date", "species", "source", "entered_at", "boat_id", "area_id")


@query(with_views("master") + f"""SELECT {_uuid_sql("'fishing_data#' || CASE WHEN length(CAST(event_id AS STRING)) < 4 THEN lpad(CAST(event_id AS STRING), 4, '0') ELSE CAST(event_id AS STRING) END || ':' || day || '||' || event_type || '|'")}
    AS record_id, day || 'T00:00:00+09:00' AS entered_at, event_type AS species
    FROM (SELECT *, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events)""")
def initial_master(spark, sf):
    catch = table(spark, sf, "events").select(
        "event_id", F.to_date("ts").cast("string").alias("date"), F.lit("").alias("time"),
        F.col("event_type").alias("species"), F.lit("").alias("spot"),
        F.lit("Manual").alias("source"))
    out = normalise.initial_master(catch, "event_id", fixed.RECORD_ID_NAMESPACE)
    return out.select("record_id", "entered_at", "species")


def _normal_sql(source: str, date: str = ISO) -> str:
    return f"""SELECT {date} AS date, {CLOCK} AS time, species, spot, size_cm, method,
    CASE WHEN tide IN {in_list(fixed.TIDES)} THEN tide ELSE '' END AS tide,
    CASE WHEN weather IN {in_list(fixed.WEATHERS)} THEN weather ELSE '' END AS weather,
    concat_ws(' / ', nullif(trim(memo), ''),
        CASE WHEN tide NOT IN {in_list(fixed.TIDES)} AND tide <> '' THEN tide END,
        CASE WHEN weather NOT IN {in_list(fixed.WEATHERS)} AND weather <> '' THEN weather END) AS memo,
    '{source}' AS source, source_detail FROM master"""


SHOWN = ["date", "time", "species", "spot", "size_cm", "method", "tide", "weather", "memo", "source",
         "source_detail"]


@query(with_views("master") + _normal_sql("manual"))
def normalise_records(spark, sf):
    out = normalise.normalise_manual(view(spark, sf, "master"), F.lit("2024-01-01T00:00:00+09:00"),
                                     F.col("record_id"))
    return out.select(*SHOWN)


@query(with_views("master") + _normal_sql("instagram").replace(
    "source_detail FROM", "CASE WHEN source_detail <> '' THEN source_detail ELSE entered_at END "
    "AS source_detail FROM"))
def normalise_extracted(spark, sf):
    rows = view(spark, sf, "master").withColumn("post_url", F.col("entered_at"))
    return normalise.normalise_extracted(rows, F.lit("x"), F.col("record_id")).select(*SHOWN)


@query(with_views("master") + """SELECT replace(date, '/', '-') AS date, '' AS time, species,
    spot, weight_kg AS size_cm, 'import:csv_v5.5' AS source, count FROM master""")
def mapped_import(spark, sf):
    rows = view(spark, sf, "master").select(
        F.col("date").alias("釣行日"), F.col("species").alias("魚種"), F.col("spot").alias("場所"),
        F.col("size_cm").alias("サイズ"), F.col("weight_kg").alias("サイズ2"),
        F.col("count").alias("数"))
    mapping = {"釣行日": "date", "魚種": "species", "場所": "spot", "サイズ": "size_cm",
               "サイズ2": "size_cm", "数": "count"}
    out = normalise.normalise_import(rows, mapping, F.lit("x"), F.lit("y"))
    return out.select("date", "time", "species", "spot", "size_cm", "source", "count")


@query(with_views("master", s=f"SELECT {SOURCES_IN.format('source')} AS internal FROM master")
       + f"SELECT internal, {SOURCES_OUT.format('internal')} AS source, count(*) AS n FROM s GROUP BY ALL")
def source_case(spark, sf):
    inner = view(spark, sf, "master").select(text.internal_source(F.col("source")).alias("internal"))
    return inner.select("internal", text.external_source(F.col("internal")).alias("source")
                        ).groupBy("internal", "source").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("master", r="""SELECT CASE nearest_station WHEN '室戸岬沖' THEN '室戸'
    WHEN '高知市沖' THEN '高知' WHEN '足摺岬沖' THEN '足摺' WHEN '宇和島沖' THEN '宇和島'
    WHEN '松山沖' THEN '松山' WHEN '来島海峡' THEN '来島' WHEN '高松沖' THEN '高松'
    WHEN '阿南市沖' THEN '阿南' ELSE nearest_station END AS nearest_station FROM master""")
    + "SELECT nearest_station, count(*) AS n FROM r GROUP BY ALL")
def key_recode(spark, sf):
    return normalise.recode(view(spark, sf, "master"), "nearest_station").groupBy(
        "nearest_station").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("master", c=f"SELECT spot, {CANONICAL} AS c FROM master")
       + f"SELECT spot, {ALIASES} AS canonical_spot, count(*) AS n FROM c GROUP BY ALL")
def name_canonical(spark, sf):
    return view(spark, sf, "master").select(
        "spot", text.canonical_spot(F.col("spot")).alias("canonical_spot")).groupBy(
        "spot", "canonical_spot").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, length(t) AS n_chars, md5(t) AS digest FROM (SELECT doc_id, nfc_normalize(
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS t FROM documents)""")
def nfkc_documents(spark, sf):
    """Whole texts in compatibility form.

    The checking engine has the canonical form, which is the same for these documents.
    """
    clean = text.clean(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.length(clean).alias("n_chars"), F.md5(F.encode(clean, "UTF-8")).alias("digest"))


@query(with_views("master") + f"""SELECT record_id, date, time, species,
    {SOURCES_OUT.format('source')} AS source FROM master""")
def design_sort(spark, sf):
    rows = normalise.design_sorted(view(spark, sf, "master"))
    return rows.select("record_id", "date", "time", "species",
                       text.external_source(F.col("source")).alias("source"))


# ---- places --------------------------------------------------------------------------------

SPOTS = """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN '室戸沖' WHEN 2 THEN '安満地'
    WHEN 3 THEN '足摺港' WHEN 4 THEN '高知県宇和島沖' WHEN 5 THEN '甲浦' ELSE '小笠原沖' END AS spot,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 6 THEN lat - 6.0E0 ELSE lat END AS lat,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lng END AS lng FROM geo"""
AREAS = [("室戸沖", "室戸沖"), ("安満地", "土佐湾"), ("甲浦", "")]


@query(with_views("geo").replace("geo AS (", "geo0 AS (") + ", sp AS ("
       + SPOTS.replace("FROM geo", "FROM geo0") + f"""),
    geo AS (SELECT *, CASE WHEN spot = '室戸沖' THEN '室戸沖' WHEN spot = '安満地' THEN '土佐湾'
        ELSE '' END AS area FROM sp),
    st AS ({_nearest_sql(fixed.STATIONS, 300.0, "'その他'")}),
    pt AS ({_nearest_sql(fixed.CURRENT_POINTS, 1e9, "name")}),
    c AS (SELECT c_custkey, spot, lat, area, {CANONICAL} AS c FROM geo),
    d AS (SELECT *, {ALIASES} AS canonical FROM c)
    SELECT d.c_custkey, d.canonical AS canonical_spot,
        CASE WHEN canonical = '' THEN NULL WHEN lat IS NOT NULL THEN st.name
             WHEN contains(canonical, '宇和島') THEN '宇和島' WHEN contains(canonical, '室戸') THEN '室戸'
             WHEN contains(canonical, '足摺') THEN '足摺' ELSE '不明' END AS nearest_station,
        CASE WHEN canonical <> '' AND lat IS NOT NULL THEN round(st.km, 3) END AS distance_km,
        CASE WHEN canonical <> '' AND lat IS NOT NULL AND pt.km <= 50 AND area IN ('', '室戸沖')
             THEN pt.name END AS current_point
    FROM d LEFT JOIN st ON st.c_custkey = d.c_custkey LEFT JOIN pt ON pt.c_custkey = d.c_custkey""")
def spot_classes(spark, sf):
    spots = spark.sql(SPOTS.replace("FROM geo", "FROM {geo}"), geo=view(spark, sf, "geo"))
    areas = spark.createDataFrame(AREAS, "canonical_spot string, sea_area string")
    out = spatial.classify_spots(spots, "spot", "lat", "lng", areas)
    return out.select("c_custkey", "canonical_spot", "nearest_station",
                      F.round("distance_km", 3).alias("distance_km"), "current_point")


# ---- quality ----------------------------------------------------------------------------------

ISSUES = f"""concat_ws('|',
    CASE WHEN date = '' OR species = '' OR spot = '' THEN 'required_missing:' || concat_ws(',',
        CASE WHEN date = '' THEN 'date' END, CASE WHEN species = '' THEN 'species' END,
        CASE WHEN spot = '' THEN 'spot' END) END,
    CASE WHEN date LIKE '%/%' THEN 'date_format:' || date
         WHEN date <> '' AND date > '2001-06-01' THEN 'date_out_of_range:' || date END,
    CASE WHEN time <> '' AND CAST(split_part(time, ':', 1) AS INT) > 23 THEN 'time_format:' || time END,
    CASE WHEN CAST(size_cm AS INT) > 200 THEN 'size_cm_range:' || size_cm END,
    CASE WHEN TRY_CAST(weight_kg AS INT) > 100 THEN 'weight_kg_range:' || weight_kg END,
    CASE WHEN CAST(count AS INT) < 1 THEN 'count_range:' || count END,
    CASE WHEN CAST(spot_lat AS INT) > 90 THEN 'spot_lat_range:' || spot_lat END,
    CASE WHEN CAST(spot_lng AS INT) > 180 THEN 'spot_lng_range:' || spot_lng END,
    CASE WHEN CAST(water_temp AS INT) > 40 THEN 'water_temp_range:' || water_temp END,
    CASE WHEN tide <> '' AND tide NOT IN {in_list(fixed.TIDES)} THEN 'tide_out_of_set:' || tide END,
    CASE WHEN weather <> '' AND weather NOT IN {in_list(fixed.WEATHERS)}
         THEN 'weather_out_of_set:' || weather END,
    CASE WHEN source NOT IN ('manual', 'instagram', 'other') AND source NOT LIKE 'blog:%'
         AND source NOT LIKE 'import:%' AND source NOT LIKE 'ocr:%' THEN 'source_unknown:' || source END)"""


@query(with_views("master") + f"""
    SELECT record_id, date, time, size_cm, weight_kg, {ISSUES} AS _issues FROM master""")
def quality_split(spark, sf):
    checked = quality.with_issues(view(spark, sf, "master"), F.lit("2001-06-01").cast("date"))
    return checked.select("record_id", "date", "time", "size_cm", "weight_kg", "_issues")


STORED = """SELECT CASE WHEN o_orderkey % 1000 = 0
        THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/')
        ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day,
    o_orderpriority AS point FROM orders"""
CHECKS = ["stored", "payload", "master"]


@query(f"""WITH stored AS ({STORED}), findings AS (
    SELECT 'stored' AS "check", 'bad_date' AS kind, day AS detail FROM stored WHERE day LIKE '%/%'
    UNION ALL SELECT 'stored', 'duplicate_key', day || '|' || point FROM (SELECT day, point,
        row_number() OVER (PARTITION BY day, point) AS rn FROM stored) WHERE rn > 1
    UNION ALL SELECT DISTINCT 'stored', 'unknown_point', point FROM stored WHERE point = '5-LOW'
    UNION ALL SELECT 'payload', 'missing_key', 'z' FROM events)
    SELECT c."check", t.n IS NULL AS ok, coalesce(t.n, 0) AS total_issues, coalesce(d.details, '') AS details
    FROM (SELECT unnest({CHECKS}) AS "check") c
    LEFT JOIN (SELECT "check", count(*) AS n FROM findings GROUP BY "check") t ON t."check" = c."check"
    LEFT JOIN (SELECT "check", string_agg(kind || ' ' || detail, ';' ORDER BY rn) AS details FROM
        (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY kind, detail) AS rn FROM findings)
        WHERE rn <= 50 GROUP BY "check") d ON d."check" = c."check" """)
def quality_report(spark, sf):
    stored = spark.sql(STORED.replace("FROM orders", "FROM {orders}"),
                       orders=table(spark, sf, "orders"))
    events = table(spark, sf, "events")
    findings = (quality.condition_findings(stored, "stored", "day", "point", POINTS[:4])
                .unionByName(quality.missing_json_keys(events, "payload", "props", ["k", "z"]))
                .unionByName(quality.bad_json(events, "payload", "props", "k int", ["event_id"])))
    return quality.report(findings, CHECKS).withColumn("details", F.array_join("details", ";"))


# ---- merges --------------------------------------------------------------------------------------

ROW_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
EXISTING_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
INCOMING_KEY = ("CAST(l_orderkey AS STRING) || '-' || "
                "CAST(l_linenumber + 3 * CAST(l_partkey % 2 AS INT) AS STRING)")
BOAT = "'boat' || CAST(l_suppkey % 3 AS STRING)"


def _keyed_sql(key: str) -> str:
    return (f"SELECT *, {key} AS id, {BOAT} AS boat, row_number() OVER (PARTITION BY {key} ORDER BY "
            f"{', '.join(ROW_ORDER)}) AS rn FROM lineitem")


MERGE = (f"WITH a AS ({_keyed_sql(EXISTING_KEY)}), b AS ({_keyed_sql(INCOMING_KEY)}), "
         "existing AS (SELECT * FROM a WHERE rn = 1), fresh AS (SELECT * FROM b WHERE rn = 1), "
         "added AS (SELECT * FROM fresh WHERE id NOT IN (SELECT id FROM existing)) ")


def _keyed(spark, sf, key):
    return table(spark, sf, "lineitem").withColumns(
        {"id": F.expr(key), "boat": F.expr(BOAT)})


def _existing(spark, sf):
    return keep_first(_keyed(spark, sf, EXISTING_KEY), ["id"], ROW_ORDER)


@query(MERGE + """SELECT s.boat, s.n AS scanned, coalesce(t.n, 0) AS added, s.n - coalesce(t.n, 0) AS skipped
    FROM (SELECT boat, count(*) AS n FROM b GROUP BY boat) s
    LEFT JOIN (SELECT boat, count(*) AS n FROM added GROUP BY boat) t ON t.boat = s.boat""")
def merge_report(spark, sf):
    return merge.add_report(_keyed(spark, sf, INCOMING_KEY), _existing(spark, sf), "id", "boat",
                            ROW_ORDER)


@query(MERGE + "SELECT id, boat, l_partkey FROM existing UNION ALL SELECT id, boat, l_partkey FROM added")
def merge_add(spark, sf):
    out = merge.add_rows(_keyed(spark, sf, INCOMING_KEY), _existing(spark, sf), "id", ROW_ORDER)
    return out.select("id", "boat", "l_partkey")


@query(MERGE + """SELECT id, boat, l_partkey FROM existing WHERE boat <> 'boat1'
    UNION ALL SELECT id, boat, l_partkey FROM fresh WHERE boat = 'boat1'
    UNION ALL SELECT id, boat, l_partkey FROM added WHERE boat <> 'boat1'""")
def merge_replace(spark, sf):
    out = merge.replace_rows(_keyed(spark, sf, INCOMING_KEY), _existing(spark, sf), "id", "boat",
                             ["boat1"], ROW_ORDER)
    return out.select("id", "boat", "l_partkey")


# ---- the ingest job ------------------------------------------------------------------------------

# Catch rows of line items; many agree in all but the tide, which is no part of an id.
DROPPED = {"date": SHIP_DAY, "species": "l_returnflag || l_linestatus",
           "size_cm": "CAST(CAST(l_quantity AS BIGINT) AS STRING)",
           "spot": "CASE l_suppkey % 3 WHEN 0 THEN '室戸沖' WHEN 1 THEN '宇和島' ELSE '甲浦' END",
           "tide": "CASE l_partkey % 4 WHEN 0 THEN '大潮' WHEN 1 THEN '中潮' WHEN 2 THEN '小潮' ELSE '若潮' END",
           "source": "'Manual'"}
DROP_ORDER = ["l_orderkey", "l_linenumber", *ROW_ORDER]
DROP_BOAT = "'boat' || CAST(l_orderkey % 4 AS STRING)"  # boat2 sends a bad file, boat3 is of elsewhere
DROP_OUT = ["boat_id", "date", "species", "size_cm", "spot", "tide", "source"]
_ID = "boat_id, date, species, size_cm, spot"
INGEST = f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY {_ID} ORDER BY {', '.join(DROP_ORDER)}) AS rn
        FROM (SELECT {DROP_BOAT} AS boat_id, {', '.join(f'{e} AS {c}' for c, e in DROPPED.items() if c != 'source')},
              'manual' AS source, {', '.join(DROP_ORDER)} FROM lineitem)),
    kept AS (SELECT * FROM r WHERE l_orderkey % 3 = 0),
    old AS (SELECT * REPLACE (row_number() OVER (PARTITION BY {_ID} ORDER BY {', '.join(DROP_ORDER)}) AS rn)
            FROM kept),
    stored AS (SELECT * FROM old WHERE rn = 1),
    fresh AS (SELECT * FROM r WHERE rn = 1 AND boat_id IN ('boat0', 'boat1')),
    added AS (SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.boat_id = f.boat_id
        AND s.date = f.date AND s.species = f.species AND s.size_cm = f.size_cm AND s.spot = f.spot)) """
_OUT = ", ".join(DROP_OUT)


def _drops(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(*[F.expr(DROPPED.get(c, "''")).alias(c) for c in fixed.CATCH_COLUMNS],
                       F.expr(DROP_BOAT).alias("boat_id"), *DROP_ORDER)


def _ingest(spark, sf, sent, **options):
    """Drop files of some boats written, read strictly and merged into a stored master."""
    rows, inbox = _drops(spark, sf), fresh_path(spark, "inbox")
    for boat in sent:
        own = rows.where(F.col("boat_id") == boat).orderBy(*DROP_ORDER)
        names = [c for c in fixed.CATCH_COLUMNS if (boat, c) != ("boat2", "memo")]
        sinks.write_columns(own, names, f"{inbox}/fishing_data_{boat}.csv")
    boats = spark.createDataFrame([(b, "there" if b == "boat3" else "here") for b in
                                   ("boat0", "boat1", "boat2", "boat3")], "boat_id string, area_id string")
    drops, rejected = ingest.read_drops(spark, f"{inbox}/*.csv", boats, "here")
    old = rows.where("l_orderkey % 3 = 0")
    stored = normalise.to_master(old, F.col("boat_id"), F.lit("here"), passed=DROP_ORDER)
    master = keep_first(stored, ["record_id"], DROP_ORDER).select(*fixed.MASTER_COLUMNS)
    return ingest.ingest(session.written(master, "master"), session.written(drops, "drops"),
                         session.written(rejected, "rejected"), "here", **options)


@query(INGEST + f"SELECT {_OUT} FROM stored UNION ALL SELECT {_OUT} FROM added")
def ingest_job(spark, sf):
    return _ingest(spark, sf, ["boat0", "boat1", "boat2", "boat3"]).rows.select(*DROP_OUT)


@query(INGEST + """SELECT s.boat_id, s.n AS scanned, coalesce(a.n, 0) AS added,
        s.n - coalesce(a.n, 0) AS skipped
    FROM (SELECT boat_id, count(*) AS n FROM r WHERE boat_id IN ('boat0', 'boat1') GROUP BY boat_id) s
    LEFT JOIN (SELECT boat_id, count(*) AS n FROM added GROUP BY boat_id) a ON a.boat_id = s.boat_id""")
def ingest_report(spark, sf):
    return _ingest(spark, sf, ["boat0", "boat1", "boat2", "boat3"]).report


@query("SELECT 'fishing_data_boat2.csv' AS \"_file\", 'header' AS reason UNION ALL "
       "SELECT 'fishing_data_boat3.csv', 'other_area'")
def ingest_rejected(spark, sf):
    return _ingest(spark, sf, ["boat0", "boat2", "boat3"]).rejected


@query(INGEST + f"""SELECT {_OUT} FROM stored WHERE boat_id <> 'boat1'
    UNION ALL SELECT {_OUT} FROM fresh WHERE boat_id = 'boat1'
    UNION ALL SELECT {_OUT} FROM added WHERE boat_id <> 'boat1'""")
def ingest_replace(spark, sf):
    return _ingest(spark, sf, ["boat0", "boat1"], mode="replace",
                   replace_boats=["boat1"]).rows.select(*DROP_OUT)


GUARDED = ["boat0", "boat1", "boat2", "boat9"]


@query(f"""SELECT g.boat, coalesce(e.n, 0) AS existing, coalesce(i.n, 0) AS incoming,
        round_even(coalesce(i.n, 0) / e.n::DOUBLE * 100, 0) / 100 AS ratio,
        CASE WHEN e.n IS NULL THEN true WHEN i.n IS NULL THEN false ELSE i.n / e.n >= 0.5 END AS passed
    FROM (SELECT unnest({GUARDED}) AS boat) g
    LEFT JOIN (SELECT {BOAT} AS boat, count(*) AS n FROM lineitem GROUP BY 1) e ON e.boat = g.boat
    LEFT JOIN (SELECT 'boat' || CAST(o_custkey % 2 AS STRING) AS boat, count(*) AS n FROM orders
               GROUP BY 1) i ON i.boat = g.boat""")
def ratio_guard(spark, sf):
    existing = table(spark, sf, "lineitem").select(F.expr(BOAT).alias("boat"))
    incoming = table(spark, sf, "orders").selectExpr(
        "'boat' || CAST(o_custkey % 2 AS STRING) AS boat")
    return merge.ratio_guard(existing, incoming, "boat", GUARDED)


ADDED_ALIASES = """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'R' || CAST(c_nationkey % 5 AS STRING) ELSE
    'NATION_' || CAST(c_nationkey + 5 * CAST(c_custkey % 3 AS INT) AS STRING) END AS name,
    'R' || CAST(c_nationkey % 5 AS STRING) AS target FROM customer"""


@query(f"""WITH given AS (SELECT DISTINCT * FROM ({ADDED_ALIASES})),
    old AS (SELECT n_name AS name, 'R' || CAST(n_regionkey AS STRING) AS target FROM nation),
    many AS (SELECT name, count(*) AS n FROM given WHERE name <> target GROUP BY name)
    SELECT g.name, g.target, CASE WHEN g.name = g.target THEN 'skipped: self-mapping'
        WHEN o.target = g.target THEN 'skipped: already_exists'
        WHEN o.target IS NOT NULL OR m.n > 1 THEN 'conflict' ELSE 'added' END AS status
    FROM given g LEFT JOIN old o ON o.name = g.name LEFT JOIN many m ON m.name = g.name""")
def alias_merge(spark, sf):
    given = spark.sql(ADDED_ALIASES.replace("FROM customer", "FROM {c}"),
                      c=table(spark, sf, "customer"))
    stored = table(spark, sf, "nation").selectExpr(
        "n_name AS name", "'R' || CAST(n_regionkey AS STRING) AS target")
    return merge.alias_statuses(stored, given, "name", "target")


@query("""SELECT f.c_custkey, CASE WHEN n.n_nationkey IS NULL THEN 'unknown_key'
        WHEN n.n_regionkey <> 2 THEN 'other_area' ELSE 'ok' END AS status
    FROM (SELECT c_custkey, c_nationkey + 10 * (c_custkey % 2) AS nation FROM customer) f
    LEFT JOIN nation n ON n.n_nationkey = f.nation""")
def reference_check(spark, sf):
    files_ = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_nationkey + 10 * (c_custkey % 2) AS nation")
    dims = table(spark, sf, "nation").selectExpr("n_nationkey AS nation",
                                                 "CAST(n_regionkey AS STRING) AS area")
    return merge.check_references(files_, dims, "nation", "area", "2").select("c_custkey", "status")


ACTIVE = ("CASE s_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey % 3 <> 1")
def active_dims(spark, sf):
    dims = table(spark, sf, "supplier").withColumn("active", F.expr(ACTIVE))
    return dimensions.active_only(dims).select("s_suppkey", "s_name")


# ---- files and wide tables ---------------------------------------------------------------------------

MASTER_OUT = ["record_id", "date", "time", "species", "size_cm", "memo", "source", "boat_id", "area_id"]


@query(with_views("master") + "SELECT record_id, date, time, species, size_cm, memo, source, "
       "'' AS boat_id, '' AS area_id FROM master")
def schema_upgrade(spark, sf):
    """A first-version master written as CSV, read back and brought to the present columns."""
    path = fresh_path(spark, "master-v1")
    sinks.write_columns(view(spark, sf, "master"), fixed.MASTER_V1_COLUMNS, path)
    return files.read_master(spark, path).select(*MASTER_OUT)


STATION_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{s[0]}'" for p, s in zip(POINTS, fixed.STATIONS)) + " END"
POINT_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{s[0]}'" for p, s in zip(POINTS, fixed.CURRENT_POINTS)) + " END"


def _stored_table(columns: list[str], keys: dict[str, str]) -> str:
    """Daily rows of orders as a stored text table; the last order of a key counts."""
    values = [f"{keys[c]} AS \"{c}\"" if c in keys else
              f"CAST((max(o_custkey) + {i}) % 97 AS STRING) AS \"{c}\"" for i, c in enumerate(columns)]
    return ("SELECT " + ", ".join(values)
            + " FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority")


CONDITION = _stored_table(fixed.CONDITION_COLUMNS, {
    "日付": "CAST(CAST(o_orderdate AS DATE) AS STRING)", "地点名": STATION_CASE})
CURRENT = _stored_table(fixed.CURRENT_COLUMNS, {
    "date": "CAST(CAST(o_orderdate AS DATE) AS STRING)", "point": POINT_CASE})
RECODED = ("SELECT * REPLACE (CASE nearest_station " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in fixed.STATION_RECODE.items())
    + " ELSE nearest_station END AS nearest_station) FROM master")
CATCH_SQL = ", ".join(
    f"{SOURCES_OUT.format('m.source')} AS source" if c == "source" else f"m.{c}"
    for c in fixed.CATCH_COLUMNS)


def _texts(alias: str, columns: dict[str, str]) -> str:
    return ", ".join(f"coalesce({alias}.\"{c}\", '') AS \"{o}\"" for c, o in columns.items())


@query(with_views("master", m=RECODED, c3=CONDITION) + f"""
    SELECT {CATCH_SQL}, {_texts('c3', fixed.CONDITION_TO_INTEGRATED)}, m.boat_id, m.area_id
    FROM m LEFT JOIN c3 ON c3."日付" = m.date AND c3."地点名" = m.nearest_station""")
def wide_integrated(spark, sf):
    master = normalise.recode(view(spark, sf, "master"), "nearest_station")
    return wide.integrated_table(master, _from_orders(spark, sf, CONDITION))


def _from_orders(spark, sf, sql):
    return spark.sql(sql.replace('"', "`").replace("FROM orders", "FROM {orders}"),
                     orders=table(spark, sf, "orders"))


@query(with_views("master", m=RECODED, c3=CONDITION, c4=CURRENT) + f"""
    SELECT {CATCH_SQL}, {_texts('c3', fixed.CONDITION_TO_TWO_POINT_HEAD)},
        {_texts('a', {c: '室戸沖_' + o for c, o in fixed.CURRENT_TO_TWO_POINT.items()})},
        {_texts('b', {c: '北西_' + o for c, o in fixed.CURRENT_TO_TWO_POINT.items()})},
        {_texts('c3', fixed.CONDITION_TO_TWO_POINT_TAIL)}, m.boat_id, m.area_id
    FROM m LEFT JOIN c3 ON c3."日付" = m.date AND c3."地点名" = m.nearest_station
    LEFT JOIN c4 a ON a.date = m.date AND a.point = '室戸沖' AND m.spot LIKE '%室戸%'
    LEFT JOIN c4 b ON b.date = m.date AND b.point = '北西' AND m.spot LIKE '%室戸%'""")
def wide_two_point(spark, sf):
    master = normalise.recode(view(spark, sf, "master"), "nearest_station")
    return wide.two_point_table(master, _from_orders(spark, sf, CONDITION),
                                _from_orders(spark, sf, CURRENT))


# ---- streams ---------------------------------------------------------------------------------------------


def _event_stream(spark, sf):
    return (spark.readStream.schema(table(spark, sf, "events").schema)
            .option("pathGlobFilter", "events.parquet").parquet(sf))


@query("""SELECT event_id, user_id, event_type, day FROM (SELECT *, CAST(CAST(ts AS DATE) AS STRING) AS day,
        row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS rn
    FROM events) WHERE rn = 1""")
def stream_ingest(spark, sf):
    """New keys of a stream into a table, then the same files once more."""
    path = fresh_path(spark, "ingested")
    key = F.concat_ws("|", F.col("user_id").cast("string"), "event_type", F.to_date("ts").cast("string"))
    for _ in range(2):
        stream = _event_stream(spark, sf).withColumns({"key": key, "day": F.to_date("ts")})
        jobs.ingest_new(stream, path, fresh_path(spark, "checkpoint"), "key", ["event_id"],
                        partition="day").awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type",
                                           F.col("day").cast("string").alias("day"))


@query(with_views("hourly", daily=DAILY) + f"""
    SELECT station, CAST(day AS STRING) AS day, "気温_平均", "気温_最高", "気温_最低", "風速_最大",
           {S16} AS "風向", "降水量", "天気コード", coalesce({WEATHER_CODES}["天気コード"],
           'code' || CAST("天気コード" AS STRING)) AS "天気" FROM daily
    WHERE CAST(day AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_daily(spark, sf):
    """Days that the watermark has closed, with all values of the daily roll-up."""
    path = fresh_path(spark, "daily")
    stream = _event_stream(spark, sf).selectExpr(
        *[f"{expression} AS `{column}`" for column, expression in TABLES["hourly"][1].items()])
    stream = stream.withColumns({"wind": F.col("value") / 5.0, "rain": F.col("k").cast("double") / 10.0})
    values = rollup.weather_values("hour", "value", "wind", "direction", "rain", "code", ["event_id"])
    days = jobs.daily(stream, "ts", "station", values, rows=F.col("hour").isin(0, 6, 12, 18))
    jobs.to_table(rollup.weather_texts(days), path, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).withColumns({
        "day": F.col("day").cast("string"), "天気コード": F.col("天気コード").cast("long")})


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id, event_type, value ORDER BY ts) AS rn FROM events) WHERE rn = 1""")
def stream_distinct(spark, sf):
    """Rows whose key did not come before; every key stays within the watermark here."""
    path = fresh_path(spark, "distinct")
    stream = _event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    jobs.first_rows(stream, path, fresh_path(spark, "checkpoint"), "ts", ["user_id", "event_type", "value"],
                    ["event_id"], "60 days").awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query("SELECT CAST(CAST(ts AS DATE) AS STRING) AS issue, count(*) AS n FROM events GROUP BY 1")
def stream_issues(spark, sf):
    """Every issue in a folder of its own."""
    path = fresh_path(spark, "issues")
    stream = _event_stream(spark, sf).withColumn("issue", F.to_date("ts").cast("string"))
    jobs.archive_issues(stream, path, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).groupBy(F.col("issue").cast("string").alias("issue")).agg(
        F.count(F.lit(1)).alias("n"))


# ---- further sources and sinks ---------------------------------------------------------------------------


@query("SELECT 'Supplier#000000007' AS s_name, '0' AS kind UNION ALL SELECT s_name, '1' FROM "
       "(SELECT s_name FROM supplier WHERE s_nationkey % 3 <> 1 ORDER BY s_suppkey LIMIT 1)")
def default_entry(spark, sf):
    """The entry asked for (made active here), and the first active one where there is none."""
    dims = table(spark, sf, "supplier").withColumn("active", F.expr(ACTIVE))
    named = dims.withColumn("active", F.col("active") | (F.col("s_name") == "Supplier#000000007"))
    return (dimensions.default_entry(named, "s_name", "s_suppkey", "Supplier#000000007")
            .withColumn("kind", F.lit("0")).unionByName(
                dimensions.default_entry(dims, "s_name", "s_suppkey", "none")
                .withColumn("kind", F.lit("1"))))


@query(with_views("master", t=f"""SELECT CASE WHEN date LIKE '%-%' THEN substr(date, 1, 7) END AS month,
        TRY_CAST(weight_kg AS DOUBLE) AS w, CAST(size_cm AS DOUBLE) AS s FROM master""") + """
    SELECT coalesce(month, '') AS month, count(*) AS n, count(w) AS weights,
           coalesce(sum(w), 0) AS weight, coalesce(sum(s), 0) AS size FROM t GROUP BY ALL""")
def typed_master(spark, sf):
    rows = normalise.typed(view(spark, sf, "master"))
    return rows.groupBy(F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count("weight_kg").alias("weights"),
        F.coalesce(F.sum("weight_kg"), F.lit(0.0)).alias("weight"),
        F.coalesce(F.sum("size_cm"), F.lit(0.0)).alias("size"))


@query(with_views("cond") + """
    SELECT point, CAST(day AS STRING) AS day, round_even(v * 10::DOUBLE, 0) / 10::DOUBLE AS "水温"
    FROM cond WHERE degrees >= 36""")
def daily_unpack(spark, sf):
    """Daily payloads, one document per point and year, nulls in their arrays."""
    rows = aggregated(spark, sf, "cond").withColumn(
        "v", F.when(F.col("degrees") >= 36, F.col("v")))
    packed = rows.groupBy("point", F.year("day").alias("year")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("day").cast("string").alias("day"), "v"))).alias("r"))
    documents = packed.select("point", F.struct(
        F.col("r.day").alias("time"), F.col("r.v").alias("mean")).alias("daily"))
    return payload.daily_rows(documents, ["point"], "mean", "水温")


FILE_NAME = ("CASE c_custkey % 5 WHEN 0 THEN 'fishing_data_' || replace(c_name, '#', '') || '.csv' "
             "WHEN 1 THEN '_fishing_data_x.csv' WHEN 2 THEN 'fishing_data_' || c_name || '.csv' "
             "WHEN 3 THEN 'fishing_data_' || c_mktsegment || '.txt' "
             "ELSE 'fishing_data_' || c_mktsegment || '.csv' END")


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN replace(c_name, '#', '')
          WHEN 4 THEN c_mktsegment END AS boat_id FROM customer""")
def inbox_names(spark, sf):
    return table(spark, sf, "customer").withColumn("name", F.expr(FILE_NAME)).select(
        "c_custkey", files.boat_of_file(F.col("name")).alias("boat_id"))


@query(with_views("cond") + f"""
    SELECT CAST(day AS STRING) AS day, point,
        CASE WHEN point >= '2-HIGH' AND month(day) > 3 THEN degrees + 1000 ELSE degrees END AS degrees
    FROM cond WHERE point <= '3-MEDIUM' OR month(day) > 3""")
def upsert_table(spark, sf):
    rows = aggregated(spark, sf, "cond").select("day", "point", "degrees")
    stored = rows.where(F.col("point") <= "3-MEDIUM")
    incoming = rows.where((F.col("point") >= "2-HIGH") & (F.month("day") > 3)).withColumn(
        "degrees", F.col("degrees") + 1000)
    late = rows.where((F.col("point") < "2-HIGH") & (F.month("day") > 3))
    out = sinks.upsert(stored, incoming.unionByName(late), ["day", "point"])
    return out.withColumn("day", F.col("day").cast("string"))
