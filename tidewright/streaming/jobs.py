"""Stream jobs: files into a table, hourly rows into daily ones, forecast issues."""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import keep_first
from ..operators.merge import not_stored
from ..session import written
from ..sources.versions import Versioned


def ingest_new(stream: DataFrame, table: str, checkpoint: str, key: str, order: Sequence[str],
               prepare: Callable[[DataFrame], DataFrame] | None = None,
               partition: str | None = None) -> StreamingQuery:
    """Append rows with new keys to a Parquet table, batch by batch.

    A batch overwrites its own folder only and compares itself with all other
    folders, so one that runs again after a lost executor or driver gives the
    same table, and files dropped twice add nothing. The folder is named by the
    checkpoint as well, so a new checkpoint never touches older rows. The key
    should be made of the content of a row. With ``partition``, a column that
    follows from the key, rows are stored by it and a batch is compared with the
    stored rows of its own partitions only.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = keep_first(prepare(batch) if prepare else batch, [key], order)
        stored = _stored(spark, table, rows.schema, run, number)
        if stored is not None:
            if partition:
                here = [r[0] for r in rows.select(partition).distinct().collect()]  # of one batch
                stored = stored.where(F.col(partition).isin(here))
            rows = not_stored(rows, stored, key)
        writer = rows.write.mode("overwrite")
        writer = writer.partitionBy(partition) if partition else writer
        writer.parquet(f"{table}/run={run}/batch={number}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_versions(stream: DataFrame, table: Versioned, checkpoint: str, key: str,
                    order: Sequence[str], prepare: Callable[[DataFrame], DataFrame] | None = None,
                    most: int = 8) -> StreamingQuery:
    """Add rows with new keys to a table kept by generations, batch by batch.

    A generation names the last batch of each checkpoint, so a batch that runs again after it got
    into the table does nothing. A partition in more than ``most`` folders is merged into one, and
    folders that the last two generations do not name go, so the files stay bounded however many
    batches there are.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        if number <= table.committed(source):
            return
        table.add_new(prepare(batch) if prepare else batch, key, order, source, number)
        if table.most_folders() > most:
            table.compact([key], order, most)
            table.vacuum(2)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _stored(spark: SparkSession, table: str, schema, run: str, number: int) -> DataFrame | None:
    """Rows of all other batches; None before the first one."""
    fields = T.StructType([*schema.fields, T.StructField("run", T.StringType()),
                           T.StructField("batch", T.LongType())])
    try:
        stored = spark.read.schema(fields).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where((F.col("run") != run) | (F.col("batch") != number))


def daily(stream: DataFrame, time: str, station: str, values: Sequence[Column],
          late: str = "1 hour", rows: Column | None = None) -> DataFrame:
    """Aggregates per day and station; days close behind the watermark.

    Days are those of the session's time zone. ``rows`` chooses the rows that
    count; all of them move the watermark. State is one row per open day and
    station. Rows later than the allowed delay are dropped.
    """
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    # The wall clock as if it were universal time, on which windows of a day are cut.
    clock = F.from_utc_timestamp(F.col(time).cast("timestamp"), zone)
    marked = stream.withColumn("_clock", clock).withWatermark("_clock", late)
    if rows is not None:
        marked = marked.where(rows)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int"))
    found = marked.groupBy(F.window("_clock", "1 day"), station).agg(*values)
    return found.withColumn("day", day).drop("window")


def first_per_key(stream: DataFrame, time: str, keys: Sequence[str], late: str = "1 hour"
                  ) -> DataFrame:
    """Rows whose key did not come before within the watermark; of one batch any of them may stay.

    ``first_rows`` keeps the earliest.
    """
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([*keys])


def first_rows(stream: DataFrame, path: str, checkpoint: str, time: str, keys: Sequence[str],
               order: Sequence[str], late: str = "1 hour") -> StreamingQuery:
    """Append the first row of every key, by ``time`` and then ``order``, to a Parquet table.

    ``first_per_key`` keeps whichever row of a batch reaches its task first, which is not the earliest
    where a batch is read in several tasks. Here a batch is reduced to the first row of each key
    and compared with the rows of all other batches: one whose key has a stored row less than ``late`` before
    it, or any after it, is left out. A batch overwrites its own folder only, so one that runs again gives
    the same table.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = keep_first(batch, keys, [time, *order])
        stored = _stored(spark, path, rows.schema, run, number)
        if stored is not None:
            known = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(time).alias("_k_time"))
            on = F.col("_k_time") + F.expr(f"interval {late}") > F.col(time)
            for key in keys:
                on = on & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
            rows = rows.join(known, on, "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def last_per_key(stream: DataFrame, time: str, keys: Sequence[str], order: Sequence[str],
                 closes: str = "1 day", late: str = "1 hour") -> DataFrame:
    """The last row of every key, once the key is closed.

    A key closes when the watermark has passed ``closes`` after its latest row; its row then is the
    one a batch ``keep_last`` gives. Rows that come after that open the key anew and give a further
    row. State is one row per open key, kept by a session window whose end is the key's timer, so it
    outlives restarts and needs no Python. Rows later than the watermark are dropped.
    """
    rest = [c for c in stream.columns if c not in keys and c not in order]
    found = (stream.withWatermark(time, late).groupBy(F.session_window(time, closes), *keys)
             .agg(F.max(F.struct(*[c for c in order if c not in keys], *rest)).alias("_row")))
    return found.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


def to_table(stream: DataFrame, path: str, checkpoint: str, partition: str | None = None
             ) -> StreamingQuery:
    """Append a stream to a Parquet table; once per row even after a restart."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    if partition:
        writer = writer.partitionBy(partition)
    return writer.trigger(availableNow=True).start()


def seal_issues(stream: DataFrame, table: Versioned, late: str, checkpoint: str) -> StreamingQuery:
    """Keep every forecast issue, a partition of ``table``, as the batch that brought it left it.

    An issue is sealed with the generation that lists it. Rows of a sealed issue change nothing and
    go to the folder ``late``; an issue whose batch did not get that far is not listed and is written
    again. A batch that runs again after its generation does nothing.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        if number <= table.committed(source):
            return
        rows = written(batch, "issues")
        sealed = table.values()
        if sealed is not None:
            again = rows.join(sealed, table.partition, "left_semi")
            again.write.mode("overwrite").parquet(f"{late}/run={source}/batch={number}")
            rows = rows.join(sealed, table.partition, "left_anti").select(*rows.columns)
        table.append(rows, source, number)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def archive_issues(stream: DataFrame, path: str, checkpoint: str, issue: str = "issue"
                   ) -> StreamingQuery:
    """Keep every forecast issue in a folder of its own."""
    return to_table(stream, path, checkpoint, issue)
