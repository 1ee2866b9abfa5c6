"""Writers: ordered columns, immutable issues, quarantine, snapshots, upserts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.latest import keep_last
from ..session import fresh_path


def write_columns(df: DataFrame, columns: Sequence[str], path: str, header: bool = True) -> None:
    """CSV with exactly these columns in this order, nulls as empty texts, CRLF."""
    texts = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                        for c in columns])
    (texts.write.option("header", header).option("lineSep", "\r\n").option("emptyValue", "")
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_issue(df: DataFrame, root: str, issue: str) -> str:
    """A forecast issue of its own; one that exists already is an error."""
    path = f"{root}/issue={issue}"
    df.write.mode("errorifexists").parquet(path)
    return path


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def _by_name(value: Column, kind: T.DataType) -> Column:
    """A value whose structs have their fields in the order of their names."""
    if isinstance(kind, T.StructType):
        fields = [_by_name(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _by_name(x, kind.elementType))
    return value


def write_documents(df: DataFrame, path: str, name: str = "value", by: Sequence[str] = (),
                    sort_keys: bool = False) -> None:
    """One JSON document per row, a line each; with ``by``, in a folder for each value of these
    columns, which are no part of it. Keys stand as the columns do, or sorted at every depth."""
    fields = [f for f in df.schema.fields if f.name not in by]
    if sort_keys:
        fields = sorted(fields, key=lambda f: f.name)
    values = [_by_name(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if sort_keys else F.col(f"`{f.name}`")
              for f in fields]
    writer = df.select(*by, F.to_json(F.struct(*values)).alias(name)).write
    (writer.partitionBy(*by) if by else writer).text(path)


def listed(df: DataFrame, keys: Sequence[str], order: str, entry: Column, name: str, most: int = 1000) -> DataFrame:
    """Rows as lists of at most ``most`` entries, so that no list grows with the table: the keys, ``part``
    and the list in the order of a column of distinct whole numbers; those of equal ``order div most``
    are one list."""
    part = F.expr(f"`{order}` div {most}")
    lists = df.groupBy(*keys, part.alias("part")).agg(F.sort_array(F.collect_list(
        F.struct(F.col(order).alias("_at"), entry.alias("_entry")))).alias("_list"))
    return lists.select(*keys, "part", F.transform("_list", lambda x: x["_entry"]).alias(name))


def quarantine(bad: DataFrame, path: str, run_date: str) -> None:
    """Bad records with their issues, appended under the day of the run."""
    bad.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy(
        "run_date").parquet(path)


def snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """Copy of a table before it is rewritten."""
    path = f"{root}/_backups/{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], batch: str = "_batch"
           ) -> DataFrame:
    """Stored and incoming rows, the later one of every key, in key order.

    Of several rows with one key in a batch the largest in the other columns counts.
    """
    both = (stored.withColumn(batch, F.lit(0)).unionByName(
        incoming.withColumn(batch, F.lit(1)), allowMissingColumns=True))
    rest = [c for c in both.columns if c not in keys and c != batch]
    return keep_last(both, keys, [batch, *rest]).drop(batch).orderBy(*keys)


def write_table(df: DataFrame, name: str) -> str:
    """Write to a new path of the shared folder; the caller then points to it.

    Nothing is overwritten in place, so a lost executor or a failed job leaves
    the table that readers use as it was.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return path
