"""Partitioned tables that change by generations: what changes is written anew, readers follow a list.

A table is a folder with ``data``, where every write has a folder of its own, and ``generations``. A
generation lists for each partition the folders that hold it, one row each, so the list is as long as
the table has partitions, not rows. Writing a generation is the last step of a change and a single
file, which appears whole or not at all: a job that fails before leaves readers on the generation
they had, a reader that began before goes on with the files it knows. Nothing is overwritten.

A change touches the partitions of the rows that come in and reads no others, so the partition must
follow from the key. One job changes a table at a time; of two that did so at once the one that
finds the other's file beside its own raises and the generation is void.
"""
from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.latest import keep_first, keep_last
from ..operators.merge import not_stored

LIST = "partition string, folder string, schema string, source string, batch long"


class Conflict(RuntimeError):
    """Another job changed the table meanwhile."""


@dataclass(frozen=True)
class Versioned:
    """A table under ``root``, partitioned by one column."""

    spark: SparkSession
    root: str
    partition: str

    # -- files ------------------------------------------------------------------------------------

    def _files(self, path: str):
        """Spark's file system for a path, and the path."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _found(self, pattern: str) -> list[str]:
        files, where = self._files(f"{self.root}/{pattern}")
        return [str(status.getPath().toString()) for status in files.globStatus(where) or []]

    def _folders(self, write: str) -> list[str]:
        """Partition folders of a write."""
        return sorted({path.rsplit("/", 2)[1] for path in self._found(
            f"data/write={write}/{self.partition}=*/part-*")})

    # -- generations ------------------------------------------------------------------------------

    def _lists(self) -> dict[int, list[str]]:
        """Files of every generation, by number."""
        out: dict[int, list[str]] = {}
        for path in self._found("generations/generation=*/part-*"):
            out.setdefault(int(path.rsplit("/", 2)[1].split("=")[1]), []).append(path)
        return out

    def generation(self) -> int:
        """Number of the current generation; 0 before the first."""
        whole = [n for n, files in self._lists().items() if len(files) == 1]
        return max(whole, default=0)

    def entries(self, generation: int | None = None) -> list:
        """Rows of a generation's list: partition, folder, schema, and what stream made it."""
        number = self.generation() if generation is None else generation
        if not number:
            return []
        return self.spark.read.schema(LIST).parquet(
            f"{self.root}/generations/generation={number}").collect()  # as many as partitions

    def _commit(self, base: int, kept: Sequence, writes: Sequence[str], schema: T.StructType,
                source: str = "", batch: int = -1) -> int:
        """Write the list of the next generation after ``base``."""
        fresh = [(folder, f"write={write}/{folder}") for write in writes for folder in self._folders(write)]
        batches = {e.source: e.batch for e in self.entries(base) if e.partition is None and e.source}
        batches |= {source: batch} if source else {}
        heads = [(None, None, schema.json(), s, b) for s, b in {"": -1, **batches}.items()]
        rows = [*heads, *((e.partition, e.folder, None, None, None) for e in kept),
                *((p, f, None, None, None) for p, f in fresh)]
        number = max(self._lists(), default=0) + 1
        if self.generation() != base:
            raise Conflict(f"{self.root} has changed since generation {base}")
        try:
            self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("errorifexists").parquet(
                f"{self.root}/generations/generation={number}")
        except AnalysisException as error:
            raise Conflict(f"{self.root}: generation {number} exists") from error
        if len(self._lists().get(number, [])) != 1:
            raise Conflict(f"{self.root}: another job wrote generation {number}")
        return number

    def committed(self, source: str) -> int:
        """The last batch of a stream that is in the table; -1 if none is."""
        return max((e.batch for e in self.entries() if e.partition is None and e.source == source), default=-1)

    # -- reading ----------------------------------------------------------------------------------

    def _rows(self, entries: Sequence, schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/data/{e.folder}" for e in entries if e.folder]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(
            *paths).select(*schema.names)

    def _schema(self, entries: Sequence) -> T.StructType | None:
        return next((T.StructType.fromJson(json.loads(e.schema)) for e in entries if e.schema), None)

    def read(self, generation: int | None = None) -> DataFrame:
        """The rows of a generation, the current one by default."""
        entries = self.entries(generation)
        schema = self._schema(entries)
        if schema is None:
            raise ValueError(f"{self.root} has no generation yet")
        return self._rows(entries, schema)

    def values(self) -> DataFrame | None:
        """The partition column's values; None before the first generation."""
        entries = self.entries()
        schema = self._schema(entries)
        return None if schema is None else self._rows(entries, schema).select(self.partition).distinct()

    # -- changes ----------------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> str:
        """Write rows to a folder of their own; a large partition comes as several files."""
        write = uuid.uuid4().hex
        rows.hint("rebalance", F.col(self.partition)).write.partitionBy(self.partition).parquet(
            f"{self.root}/data/write={write}")
        return write

    def _drop(self, write: str) -> None:
        """Remove a write that no generation lists."""
        files, where = self._files(f"{self.root}/data/write={write}")
        files.delete(where, True)

    def append(self, rows: DataFrame, source: str = "", batch: int = -1) -> int:
        """Add rows beside those stored; ``source`` and ``batch`` name the stream they come from."""
        base = self.generation()
        entries = self.entries(base)
        write = self._write(rows)
        return self._commit(base, [e for e in entries if e.partition], [write],
                            self._schema(entries) or rows.schema, source, batch)

    def add_new(self, rows: DataFrame, key: str, order: Sequence[str], source: str = "", batch: int = -1
                ) -> int:
        """Add rows whose key is not stored, the first of each key; a replay adds nothing. The keys of
        touched partitions are read; where nothing is stored in those, rows are written just once."""
        base = self.generation()
        entries = self.entries(base)
        schema = self._schema(entries) or rows.schema
        write = staging = self._write(keep_first(rows.select(*schema.names), [key], order))
        touched = set(self._folders(write))
        old = [e for e in entries if e.partition in touched]
        if old:
            staged = self.spark.read.schema(schema).parquet(f"{self.root}/data/write={write}")
            write = self._write(not_stored(staged.select(*schema.names), self._rows(old, schema), key))
        number = self._commit(base, [e for e in entries if e.partition], [write], schema, source, batch)
        if old:
            self._drop(staging)
        return number

    def upsert(self, rows: DataFrame, keys: Sequence[str]) -> int:
        """Stored and incoming rows, the later one of every key; of several rows with one key in a
        batch the largest in the other columns counts. Only touched partitions are read and written."""
        base = self.generation()
        entries = self.entries(base)
        schema = self._schema(entries) or rows.schema
        rows = rows.select(*schema.names)
        write = self._write(rows)  # once, so that the batch is computed once and its partitions known
        touched = set(self._folders(write))
        staged = self.spark.read.schema(schema).parquet(f"{self.root}/data/write={write}")
        old = self._rows([e for e in entries if e.partition in touched], schema)
        both = old.withColumn("_batch", F.lit(0)).unionByName(
            staged.select(*schema.names).withColumn("_batch", F.lit(1)))
        rest = [c for c in schema.names if c not in keys]
        merged = keep_last(both, keys, ["_batch", *rest]).drop("_batch")
        result = self._write(merged)
        number = self._commit(base, [e for e in entries if e.partition and e.partition not in touched],
                              [result], schema)
        self._drop(write)
        return number

    def replace(self, rows: DataFrame, partitions: Sequence[str]) -> int:
        """Exchange whole partitions, named by value, for ``rows``; other partitions gain their rows."""
        base = self.generation()
        entries = self.entries(base)
        gone = {f"{self.partition}={_escaped(self.spark, value)}" for value in partitions}
        write = self._write(rows)
        return self._commit(base, [e for e in entries if e.partition and e.partition not in gone],
                            [write], self._schema(entries) or rows.schema)

    def most_folders(self) -> int:
        """How many folders the most divided partition lies in."""
        return max(Counter(e.partition for e in self.entries() if e.partition).values(), default=0)

    def compact(self, keys: Sequence[str], order: Sequence[str], most: int = 1) -> int:
        """Partitions that lie in more than ``most`` folders are merged into one, with the last row
        of each key in the given order (rows without a key all stay); returns the rows that went."""
        base = self.generation()
        entries = self.entries(base)
        schema = self._schema(entries)
        held = Counter(e.partition for e in entries if e.partition)
        full = [e for e in entries if held[e.partition] > most]
        if not full:
            return 0
        before = self._rows(full, schema)
        write = self._write(keep_last(before, keys, order, keep_null_keys=True))
        after = self.spark.read.schema(schema).parquet(f"{self.root}/data/write={write}")
        names = {e.partition for e in full}
        self._commit(base, [e for e in entries if e.partition and e.partition not in names], [write], schema)
        return before.count() - after.count()

    def vacuum(self, keep: int = 2) -> int:
        """Remove the lists but the last ``keep`` and the folders none of them names; returns how
        many folders went. Readers of older generations must be done."""
        lists = self._lists()
        current = self.generation()
        kept = [n for n in sorted(lists) if n <= current and len(lists[n]) == 1][-keep:]
        named = {e.folder for n in kept for e in self.entries(n) if e.folder}
        gone = [path for path in self._found("data/write=*/*=*")
                if "/".join(path.rsplit("/", 2)[1:]) not in named]
        for n in lists:
            if n not in kept:
                files, where = self._files(f"{self.root}/generations/generation={n}")
                files.delete(where, True)
        for path in gone:
            files, where = self._files(path)
            files.delete(where, True)
        for path in self._found("data/write=*"):
            if not any(folder.startswith(path.rsplit("/", 1)[1] + "/") for folder in named):
                files, where = self._files(path)
                files.delete(where, True)
        return len(gone)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition's value as it stands in a folder's name."""
    catalogue = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return catalogue.escapePathName(str(value))
