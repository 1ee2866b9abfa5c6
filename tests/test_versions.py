"""Tables that change by generations."""
import os

import pytest
from pyspark.sql import functions as F

from tidewright.operators.latest import keep_last
from tidewright.sources.versions import Conflict, Versioned


def frame(spark, *rows):
    return spark.createDataFrame(rows, "day string, point string, v int")


def rows_of(df):
    return sorted(map(tuple, df.select("day", "point", "v").collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    out = Versioned(spark, str(tmp_path / "t"), "day")
    out.upsert(frame(spark, ("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3), ("d 3/x", "a", 4)), ["day", "point"])
    return out


def writes(table):
    return set(os.listdir(f"{table.root}/data"))


def test_one_changed_day_writes_one_partition(spark, table):
    before = writes(table)
    old = {e.folder for e in table.entries() if e.folder}
    table.upsert(frame(spark, ("d1", "a", 9), ("d1", "c", 5), ("d1", "c", 7)), ["day", "point"])
    fresh = {e.folder for e in table.entries() if e.folder} - old
    assert len(fresh) == 1 and fresh.pop().endswith("/day=d1")
    assert len(writes(table) - before) == 1
    for name in writes(table) - before:
        assert [f for f in os.listdir(f"{table.root}/data/{name}") if "=" in f] == ["day=d1"]
    assert rows_of(table.read()) == [("d 3/x", "a", 4), ("d1", "a", 9), ("d1", "b", 2), ("d1", "c", 7),
                                     ("d2", "a", 3)]


def test_a_reader_keeps_its_generation(spark, table):
    reading, was = table.read(), rows_of(table.read())
    table.upsert(frame(spark, ("d1", "a", 9)), ["day", "point"])
    table.replace(frame(spark, ("d2", "z", 0)), ["d2", "d 3/x"])
    assert rows_of(reading) == was == rows_of(table.read(1))
    assert rows_of(table.read()) == [("d1", "a", 9), ("d1", "b", 2), ("d2", "z", 0)]


def test_a_failed_job_leaves_the_table(spark, table):
    was = rows_of(table.read())
    bad = frame(spark, ("d1", "a", 9)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad, ["day", "point"])
    assert table.generation() == 1 and rows_of(table.read()) == was


def test_two_writers_conflict(spark, table):
    entries = table.entries()
    write = table._write(frame(spark, ("d9", "a", 1)))
    table.append(frame(spark, ("d8", "a", 1)))
    with pytest.raises(Conflict):
        table._commit(1, entries, [write], table.read().schema)
    assert table.generation() == 2 and ("d9", "a", 1) not in rows_of(table.read())


def test_compaction_says_what_it_dropped(spark, table):
    for v in range(5):
        table.append(frame(spark, ("d1", "a", v + 10), ("d2", "q", v), ("d2", None, v)))
    assert len([e for e in table.entries() if e.folder]) == 3 + 5 * 2
    wanted = rows_of(keep_last(table.read(), ["day", "point"], ["v"], keep_null_keys=True))
    count = table.read().count()
    assert table.compact(["day", "point"], ["v"]) == count - len(wanted) == 9
    assert rows_of(table.read()) == wanted
    assert len([e for e in table.entries() if e.folder]) == 3
    assert table.compact(["day", "point"], ["v"]) == 0
    table.vacuum(1)
    assert rows_of(table.read()) == wanted and len(writes(table)) == 2 and len(table._lists()) == 1


def test_types_and_odd_partitions(spark, tmp_path):
    table = Versioned(spark, str(tmp_path / "t"), "k")
    with pytest.raises(ValueError):
        table.read()
    rows = spark.createDataFrame([("001", None), (None, 2), ("a=b%", 3)], "k string, v long")
    table.append(rows.where("false"))
    assert table.read().count() == 0
    table.upsert(rows, ["k"])
    table.replace(rows.where("false"), ["a=b%"])
    found = table.read()
    assert found.dtypes == [("k", "string"), ("v", "bigint")]
    assert sorted(map(str, map(tuple, found.collect()))) == ["('001', None)", "(None, 2)"]


def test_only_touched_partitions_are_read(spark, table):
    files, where = table._files(next(p for p in table._found("data/write=*/day=d2")))
    files.delete(where, True)
    table.upsert(frame(spark, ("d1", "a", 9)), ["day", "point"])  # day d2 is not looked at
    assert table.generation() == 2


def test_new_rows_are_added_once(spark, table):
    rows = spark.createDataFrame([("d1", "a", 50), ("d1", "n", 7), ("d1", "n", 6), ("d7", "m", 1)],
                                 "day string, point string, v int")
    for _ in range(2):
        table.add_new(rows, "point", ["v"], "stream", 4)
    assert rows_of(table.read()) == [("d 3/x", "a", 4), ("d1", "a", 1), ("d1", "b", 2), ("d1", "n", 6),
                                     ("d2", "a", 3), ("d7", "m", 1)]
    assert table.committed("stream") == 4 and table.committed("other") == -1
    table.append(rows.where("false"), "other", 2)
    assert (table.committed("stream"), table.committed("other")) == (4, 2)
