"""Queries: published tables, sinks read back, dimension documents, guards."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import text
from tidewright.operators import normalise, quality
from tidewright.plans import analysis, conditions, wide
from tidewright.session import fresh_path
from tidewright.sources import dimensions, payload, sinks

from .records import CATCH_SQL
from .registry import query, with_views
from .views import aggregated, table, view

LATE = "CAST(o_orderdate AS DATE) >= DATE '2001-01-01'"
ORDERS = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(with_views("master") + f"SELECT {CATCH_SQL} FROM master m")
def catch_table(spark, sf):
    """The nineteen published columns."""
    return wide.catch_table(view(spark, sf, "master"))


@query(with_views("catch") + "SELECT l_orderkey, l_linenumber, boat FROM catch WHERE boat IN ('boat1', 'boat2')")
def boats_only(spark, sf):
    rows = analysis.for_boats(view(spark, sf, "catch"), ["boat1", "boat2"], "boat")
    return rows.select("l_orderkey", "l_linenumber", "boat")


@query(with_views("catch") + "SELECT l_orderkey, l_linenumber, CAST(day AS STRING) AS day FROM catch")
def day_sorted(spark, sf):
    rows = normalise.day_sorted(view(spark, sf, "catch"), "day", "l_orderkey")
    return rows.select("l_orderkey", "l_linenumber", F.col("day").cast("string").alias("day"))


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def no_unknown_left(spark, sf):
    return quality.require_none(_orders(spark, sf), "o_orderpriority").select(
        "o_orderkey", "o_orderpriority")


@query(f"""SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN {LATE} THEN 'late' ELSE 'early' END
    AS issue FROM orders""")
def issue_archive(spark, sf):
    """Each issue in a folder of its own, read back together."""
    root = fresh_path(spark, "issues")
    orders = table(spark, sf, "orders")
    for issue, rows in (("late", orders.where(LATE)), ("early", orders.where(f"NOT {LATE}"))):
        sinks.write_issue(rows.select("o_orderkey", "o_orderpriority", "o_totalprice"), root, issue)
    return spark.read.parquet(root).withColumn("issue", F.col("issue").cast("string"))


@query(f"{ORDERS} UNION ALL {ORDERS} WHERE {LATE}")
def json_lines(spark, sf):
    """Two batches appended."""
    path = fresh_path(spark, "lines")
    sinks.append_json_lines(_orders(spark, sf), path)
    sinks.append_json_lines(table(spark, sf, "orders").where(LATE).select(
        "o_orderkey", "o_orderpriority", "o_totalprice"), path)
    return spark.read.schema("o_orderkey long, o_orderpriority string, o_totalprice double").json(path)


@query(ORDERS)
def json_documents(spark, sf):
    """A document per row, written as text and parsed again."""
    path = fresh_path(spark, "documents")
    sinks.write_documents(_orders(spark, sf), path)
    found = F.from_json("value", "o_orderkey long, o_orderpriority string, o_totalprice double")
    return spark.read.text(path).select(found.alias("d")).select("d.*")


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN '2024-01-01'
    ELSE '2024-01-02' END AS run_date FROM orders WHERE o_totalprice > 400000""")
def quarantined(spark, sf):
    path = fresh_path(spark, "quarantine")
    bad = _orders(spark, sf).where("o_totalprice > 400000")
    sinks.quarantine(bad.where("o_orderkey % 2 = 0"), path, "2024-01-01")
    sinks.quarantine(bad.where("o_orderkey % 2 = 1"), path, "2024-01-02")
    return spark.read.parquet(path).withColumn("run_date", F.col("run_date").cast("string"))


@query(ORDERS)
def snapshot_copy(spark, sf):
    return spark.read.parquet(sinks.snapshot(_orders(spark, sf), fresh_path(spark, "store"), "s1"))


@query("""SELECT 'boat' || CAST(s_suppkey AS STRING) AS boat_id, 'area' || CAST(s_nationkey % 3 AS STRING)
    AS area_id FROM supplier WHERE s_nationkey % 4 <> 1""")
def dimension_entries(spark, sf):
    """Boats as JSON documents of at most 100 boats by area, read back without those out of use."""
    path = fresh_path(spark, "boats")
    boats = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "'boat' || CAST(s_suppkey AS STRING) AS boat_id", "'area' || CAST(s_nationkey % 3 AS STRING) AS area_id",
        "CASE s_nationkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS active")
    documents = sinks.listed(boats, ["area_id"], "s_suppkey", F.struct("boat_id", "area_id", "active"), "boats", 100)
    sinks.write_documents(documents.withColumnRenamed("area_id", "area"), path, by=["area"], sort_keys=True)
    return dimensions.active_only(dimensions.read_entries(spark, path, "boats", by_line=True)).select(
        "boat_id", "area_id")


WIDE_TEXT = ("translate(text, 'abcdefghij', 'ａｂｃｄｅｆｇｈｉｊ')")


@query(f"""SELECT doc_id, md5(translate(translate(text, 'abcdefghij', 'ａｂｃｄｅｆｇｈｉｊ'),
    'ａｂｃｄｅｆｇｈｉｊ', 'abcdefghij')) AS digest FROM documents""")
def wide_letters(spark, sf):
    """Full-width letters become plain ones in compatibility form."""
    rows = table(spark, sf, "documents").select("doc_id", F.expr(WIDE_TEXT).alias("t"))
    return rows.select("doc_id", F.md5(text.nfkc(F.col("t")).cast("binary")).alias("digest"))


@query("""SELECT "日付", "地点名", o_orderkey, o_custkey FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS STRING)
    AS "日付", o_orderpriority AS "地点名", o_orderkey, o_custkey, row_number() OVER (PARTITION BY
    CAST(o_orderdate AS DATE), o_orderpriority ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def compacted(spark, sf):
    """Two appends of a daily table, then the last row of each day and station, written anew."""
    path = fresh_path(spark, "conditions")
    rows = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("日付"), F.col("o_orderpriority").alias("地点名"),
        "o_orderkey", "o_custkey")
    for part in (0, 1):
        rows.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(path)
    last = conditions.compact(spark.read.parquet(path), "o_orderkey")
    return spark.read.parquet(sinks.write_table(last, "conditions"))


@query(with_views("fc") + """SELECT 'u1' AS updated, place || ' ' || time AS t, wave_height AS wave,
    CAST(wave_direction AS BIGINT) AS wave_dir FROM fc""")
def forecast_document(spark, sf):
    """Forecast rows as stored documents of the site, one for each place and day, read back as rows."""
    path = fresh_path(spark, "forecast")
    row = F.struct(F.concat_ws(" ", "place", "time").alias("t"), F.col("wave_height").alias("wave"),
                   F.col("wave_direction").cast("int").alias("waveDir"))
    rows = aggregated(spark, sf, "fc").groupBy("place", F.left("time", F.lit(10)).alias("day")).agg(
        F.sort_array(F.collect_list(row)).alias("rows"))  # four hours a day
    sinks.write_documents(rows.select("place", F.lit("u1").alias("updated"), "rows"), path, by=["place"])
    found = payload.read_forecast(spark, path, by_line=True)
    return found.select("updated", "t", "wave", F.col("wave_dir").cast("long").alias("wave_dir"))
