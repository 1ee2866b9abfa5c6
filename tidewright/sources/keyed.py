"""Tables laid out by the hash of a key, so that joins by that key leave the stored side where it is.

Rows lie in a fixed number of buckets, each sorted by the key. A join or an anti-join with a batch
deals the batch into the same buckets and reads each stored bucket in place: the work of a merge is
that of its batch and one scan of the stored keys, without an exchange of the stored side. The number
of buckets is chosen once, for the size the table shall grow to, and should not be below the
session's shuffle partitions. The layout is noted beside the data, so a new session can open it.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from ..operators import merge

LAYOUT = "key string, buckets int, schema string"


def _name(path: str) -> str:
    return f"keyed_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _writer(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrameWriter:
    """One file per bucket and write."""
    return (rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
            .option("path", path))


def write_keyed(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Lay a table out anew under a path that nothing lies under."""
    spark = rows.sparkSession
    _writer(rows, path, key, buckets).mode("errorifexists").saveAsTable(_name(path))
    layout = spark.createDataFrame([(key, buckets, rows.schema.json())], LAYOUT)
    layout.coalesce(1).write.mode("errorifexists").json(f"{path}/_layout")
    return spark.table(_name(path))


def _layout(spark: SparkSession, path: str):
    return spark.read.schema(LAYOUT).json(f"{path}/_layout").first()


def open_keyed(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its layout, also one that another session wrote."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        key, buckets, schema = _layout(spark, path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in T.StructType.fromJson(json.loads(schema)))
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def new_rows(incoming: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored, the first of each key."""
    spark = incoming.sparkSession
    key = _layout(spark, path).key
    return merge.new_rows(incoming, open_keyed(spark, path), key, order)


def add_keyed(incoming: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    """Bring new rows into their buckets beside those stored; replays add nothing."""
    spark = incoming.sparkSession
    key, buckets, _ = _layout(spark, path)
    stored = open_keyed(spark, path)
    rows = new_rows(incoming, path, order).select(*stored.columns)
    _writer(rows, path, key, buckets).mode("append").saveAsTable(_name(path))
    return spark.table(_name(path))


def without(path: str, keys: DataFrame) -> DataFrame:
    """Stored rows but those whose key is in ``keys``."""
    spark = keys.sparkSession
    key = _layout(spark, path).key
    return open_keyed(spark, path).join(keys.select(F.col(key)), key, "left_anti")
