"""Queries: tables that change by generations, tables by key, streams into both."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewright import session
from tidewright.functions import fixed
from tidewright.operators import normalise
from tidewright.operators.latest import keep_first
from tidewright.plans import ingest
from tidewright.session import fresh_path
from tidewright.sources import keyed
from tidewright.sources.versions import Versioned
from tidewright.streaming import jobs

from .records import (DROP_BOAT, DROP_ORDER, DROP_OUT, DROPPED, EXISTING_KEY, INCOMING_KEY, INGEST, MERGE,
                      ROW_ORDER, _event_stream, _existing, _keyed, _OUT)
from .registry import query, with_views
from .views import aggregated, table


@query(with_views("cond") + """
    SELECT CAST(day AS STRING) AS day, point,
        CASE WHEN month(day) = 5 THEN degrees + 2000 WHEN month(day) > 3 THEN degrees + 1000
             ELSE degrees END AS degrees
    FROM cond WHERE point <= '3-MEDIUM' OR month(day) > 3""")
def versioned_upsert(spark, sf):
    """Three changes of a table by month, each by generation."""
    rows = aggregated(spark, sf, "cond").select(
        F.date_format("day", "yyyy-MM").alias("month"), F.col("day").cast("string").alias("day"), "point",
        "degrees", F.month("day").alias("m"))
    stored = Versioned(spark, fresh_path(spark, "versions"), "month")
    stored.upsert(rows.where("point <= '3-MEDIUM'").drop("m"), ["day", "point"])
    for low, high, more in ((4, 12, 1000), (5, 5, 2000)):
        later = rows.where(F.col("m").between(low, high)).withColumn("degrees", F.col("degrees") + more)
        stored.upsert(later.drop("m"), ["day", "point"])
    return stored.read().select("day", "point", "degrees")


@query("""WITH k AS (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day FROM orders),
    l AS (SELECT *, row_number() OVER (PARTITION BY day, o_orderpriority ORDER BY o_orderkey DESC) AS rn FROM k)
    SELECT day, o_orderpriority AS point, o_orderkey, (SELECT count(*) FROM l WHERE rn > 1) AS dropped
    FROM l WHERE rn = 1""")
def versioned_compaction(spark, sf):
    """Appends to a table by month, merged to the last row of each day and point."""
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderpriority").alias("point"), "o_orderkey")
    stored = Versioned(spark, fresh_path(spark, "versions"), "month")
    for part in (0, 1):
        stored.append(rows.where(F.col("o_orderkey") % 2 == part))
    dropped = stored.compact(["day", "point"], ["o_orderkey"], 0)
    return stored.read().select("day", "point", "o_orderkey", F.lit(dropped).cast("long").alias("dropped"))


def _changed(spark, sf, mode, boats):
    """A stored master by boat, the rows of two boats brought into it."""
    rows = table(spark, sf, "lineitem").select(
        *[F.expr(DROPPED.get(c, "''")).alias(c) for c in fixed.CATCH_COLUMNS],
        F.expr(DROP_BOAT).alias("boat_id"), *DROP_ORDER)
    old = normalise.to_master(rows.where("l_orderkey % 3 = 0"), F.col("boat_id"), F.lit("here"), passed=DROP_ORDER)
    master = Versioned(spark, fresh_path(spark, "master"), "boat_id")
    master.append(keep_first(old, ["record_id"], DROP_ORDER).select(*fixed.MASTER_COLUMNS))
    sent = rows.where("boat_id IN ('boat0', 'boat1')").withColumn("_place", F.struct(*DROP_ORDER))
    none = spark.createDataFrame([], "_file string, reason string")
    for _ in range(2):  # the second time changes nothing
        found = ingest.ingest(master.read(), session.written(sent, "drops"), none, "here", mode, boats)
        ingest.commit_changes(found, master)
    return master.read().select(*DROP_OUT)


@query(INGEST + f"SELECT {_OUT} FROM stored UNION ALL SELECT {_OUT} FROM added")
def versioned_ingest(spark, sf):
    return _changed(spark, sf, "add", [])


@query(INGEST + f"""SELECT {_OUT} FROM stored WHERE boat_id <> 'boat1'
    UNION ALL SELECT {_OUT} FROM fresh WHERE boat_id = 'boat1'
    UNION ALL SELECT {_OUT} FROM added WHERE boat_id <> 'boat1'""")
def versioned_replace(spark, sf):
    return _changed(spark, sf, "replace", ["boat1"])


@query(MERGE + "SELECT id, boat, l_partkey FROM existing UNION ALL SELECT id, boat, l_partkey FROM added")
def merge_add_keyed(spark, sf):
    """The stored side lies in buckets by id and is not exchanged; the batch is added twice."""
    path = fresh_path(spark, "keyed")
    columns = ["id", "boat", "l_partkey"]
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed.write_keyed(_existing(spark, sf).select(*columns), path, "id", buckets)
    new = session.written(keyed.new_rows(_keyed(spark, sf, INCOMING_KEY), path, ROW_ORDER), "new")
    for _ in range(2):
        found = keyed.add_keyed(new, path, ROW_ORDER)
    return found


@query(f"""SELECT {EXISTING_KEY} AS id, l_partkey FROM lineitem WHERE {EXISTING_KEY} NOT IN
    (SELECT {INCOMING_KEY} FROM lineitem WHERE l_suppkey % 2 = 0)""")
def without_keyed(spark, sf):
    """Stored rows but those of some keys."""
    path = fresh_path(spark, "keyed")
    keyed.write_keyed(_keyed(spark, sf, EXISTING_KEY).select("id", "l_partkey"), path, "id", 16)
    return keyed.without(path, _keyed(spark, sf, INCOMING_KEY).where("l_suppkey % 2 = 0"))


@query("SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events")
def stream_versions(spark, sf):
    """New keys of a stream of several files into a table by generations, all files sent twice."""
    inbox = fresh_path(spark, "inbox")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    events.repartitionByRange(4, "event_id").write.parquet(inbox)
    stored = Versioned(spark, fresh_path(spark, "versions"), "day")
    key = F.concat_ws("|", F.col("user_id").cast("string"), "event_type", "day")
    for _ in range(2):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
        jobs.ingest_versions(stream.withColumn("key", key), stored, fresh_path(spark, "checkpoint"), "key",
                             ["event_id"], most=1).awaitTermination()
    return stored.read().select("user_id", "event_type", "day")


_LAST = """WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS before FROM events),
    s AS (SELECT *, sum(CASE WHEN ts >= before + INTERVAL 12 HOUR OR before IS NULL THEN 1 ELSE 0 END) OVER (
              PARTITION BY user_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS open FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, open ORDER BY ts DESC, event_id DESC) AS rn
          FROM s)
    SELECT event_id, user_id, event_type, value FROM r
    WHERE rn = 1 AND ts + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""


@query(_LAST)
def stream_last(spark, sf):
    """The last row of every key that half a day without a row has closed."""
    path = fresh_path(spark, "last")
    stream = _event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    last = jobs.last_per_key(stream, "ts", ["user_id", "event_type"], ["ts", "event_id"], "12 hours")
    jobs.to_table(last, path, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "value")


_EARLY = "event_id % 3 <> 0 AND user_id % 2 = 0"


@query(f"""WITH e AS (SELECT *, CAST(CAST(ts AS DATE) AS STRING) AS issue FROM events),
    first AS (SELECT DISTINCT issue FROM e WHERE {_EARLY} AND extract(hour FROM ts) < 12)
    SELECT issue, 'kept' AS kind, count(*) AS n FROM e WHERE issue NOT IN (SELECT issue FROM first)
        OR ({_EARLY} AND extract(hour FROM ts) < 12) GROUP BY issue
    UNION ALL SELECT issue, 'late', count(*) FROM e WHERE issue IN (SELECT issue FROM first) GROUP BY issue""")
def stream_sealed(spark, sf):
    """Issues that a first stream brought stay as they are; the rows of a second one are reported."""
    stored = Versioned(spark, fresh_path(spark, "versions"), "issue")
    late = fresh_path(spark, "late")
    stream = _event_stream(spark, sf).withColumn("issue", F.to_date("ts").cast("string"))
    for rows in (stream.where(_EARLY).where("extract(hour FROM ts) < 12"), stream):
        jobs.seal_issues(rows, stored, late, fresh_path(spark, "checkpoint")).awaitTermination()
    late_rows = spark.read.parquet(late).withColumn("kind", F.lit("late")).select("issue", "kind")
    return stored.read().select("issue", F.lit("kept").alias("kind")).unionByName(late_rows).groupBy(
        "issue", "kind").agg(F.count(F.lit(1)).alias("n"))
