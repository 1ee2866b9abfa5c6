"""Tables by key and streams into stored tables."""
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewright.operators import merge
from tidewright.operators.latest import keep_last
from tidewright.sources import keyed
from tidewright.sources.versions import Versioned
from tidewright.streaming import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def path_to_join(text, scan):
    """Lines of the operators from a scan up to the first join."""
    lines = text.splitlines()
    start = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if scan in line)
    out, depth = [], start(lines[at])
    for line in reversed(lines[:at]):
        if start(line) < depth:
            depth = start(line)
            if "Join" in line:
                return out
            out.append(line)
    raise AssertionError("no join")


@pytest.fixture
def sort_merge(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_side_is_not_exchanged(spark, tmp_path, sort_merge):
    path = str(tmp_path / "k")
    stored = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("old").alias("v"))
    keyed.write_keyed(stored, path, "id", 8)
    batch = spark.range(4990, 5010).select(F.col("id").cast("string").alias("id"), F.lit("new").alias("v"))
    for frame in (merge.not_stored(batch, keyed.open_keyed(spark, path), "id"),
                  keyed.without(path, batch)):
        names = path_to_join(plan(frame), "Bucketed: true")
        assert not [name for name in names if "Exchange" in name]
    plain = merge.not_stored(batch, spark.read.parquet(path), "id")
    assert plan(plain).count("Exchange hash") > plan(
        merge.not_stored(batch, keyed.open_keyed(spark, path), "id")).count("Exchange hash")


def test_rows_are_added_once_and_opened_again(spark, tmp_path):
    path = str(tmp_path / "k")
    keyed.write_keyed(spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int"), path, "id", 4)
    batch = spark.createDataFrame([("b", 9), ("c", 4), ("c", 3)], "id string, v int")
    for _ in range(2):
        keyed.add_keyed(batch, path, ["v"])
    spark.sql(f"DROP TABLE {keyed._name(path)}")  # as a new session would find it
    found = keyed.open_keyed(spark, path)
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(map(tuple, keyed.without(path, batch).collect())) == [("a", 1)]
    assert "Bucketed: true" in plan(found.groupBy("id").count())
    with pytest.raises(Exception):
        keyed.write_keyed(batch, path, "id", 4)


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_last_rows_as_in_a_batch(spark, tmp_path):
    schema = "ts timestamp, k string, n int, v string"

    def row(hour, k, n, v="x"):
        return {"ts": f"2024-01-{1 + hour // 24:02}T{hour % 24:02}:00:00Z", "k": k, "n": n, "v": v}

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        jobs.to_table(jobs.last_per_key(stream, "ts", ["k"], ["ts", "n"], "6 hours"), str(tmp_path / "out"),
                      str(tmp_path / "cp")).awaitTermination()
        return sorted(((r.k, r.n) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()),
                      key=str)

    land(tmp_path / "in", "1.json", row(0, "a", 1), row(3, "a", 2), row(3, "a", 5), row(3, "b", 1), row(4, None, 7))
    assert run() == []  # nothing is closed yet
    land(tmp_path / "in", "2.json", row(5, "a", 9, "last"), row(2, "b", 8), row(9, "c", 1))
    assert run() == []
    land(tmp_path / "in", "3.json", row(13, "c", 4), row(14, "d", 1))
    assert run() == sorted([(None, 7), ("a", 9), ("b", 1)], key=str)
    land(tmp_path / "in", "4.json", row(60, "e", 1), row(61, "a", 3))
    closed = run()
    everything = spark.read.schema(schema).json(str(tmp_path / "in"))
    batch = keep_last(everything.where("ts < '2024-01-03'"), ["k"], ["ts", "n"])
    assert closed == sorted(((r.k, r.n) for r in batch.collect()), key=str)
    assert run() == closed  # a restart without new rows adds nothing


def test_many_batches_leave_few_files(spark, tmp_path):
    table = Versioned(spark, str(tmp_path / "t"), "day")
    for i in range(8):
        land(tmp_path / "in", f"{i:03}.json", *({"k": f"{d}{i // 2}", "day": d, "v": i} for d in ("x", "y")))

    def run(checkpoint):
        stream = spark.readStream.schema("k string, day string, v int").option("maxFilesPerTrigger", 1).json(
            str(tmp_path / "in"))
        jobs.ingest_versions(stream, table, str(tmp_path / checkpoint), "k", ["v"], most=2).awaitTermination()

    run("a")
    wanted = sorted(f"{d}{i}" for d in "xy" for i in range(4))
    files = [os.path.join(d, f) for d, _, names in os.walk(table.root) for f in names if f.startswith("part-")]
    assert sorted(r.k for r in table.read().collect()) == wanted and table.most_folders() <= 2
    assert len(files) <= 2 * 3 + 2 * 2 + 8
    source = next(e.source for e in table.entries() if e.source)
    assert table.committed(source) == 7
    number = table.generation()
    run("a")
    assert table.generation() == number  # nothing new, nothing written
    run("b")
    assert sorted(r.k for r in table.read().collect()) == wanted


def test_sealed_issues_do_not_change(spark, tmp_path):
    table = Versioned(spark, str(tmp_path / "t"), "issue")
    late = str(tmp_path / "late")

    def run(checkpoint):
        stream = spark.readStream.schema("issue string, v int").option("maxFilesPerTrigger", 1).json(
            str(tmp_path / "in"))
        jobs.seal_issues(stream, table, late, str(tmp_path / checkpoint)).awaitTermination()

    def held():
        return sorted((r.issue, r.v) for r in table.read().collect())

    land(tmp_path / "in", "1.json", {"issue": "i1", "v": 1}, {"issue": "i1", "v": 2})
    run("a")
    run("b")  # the same issue twice gives one copy
    assert held() == [("i1", 1), ("i1", 2)]
    assert sorted(r.v for r in spark.read.parquet(late).collect()) == [1, 2]
    land(tmp_path / "in", "2.json", {"issue": "i1", "v": 3}, {"issue": "i2", "v": 4})
    run("a")
    assert held() == [("i1", 1), ("i1", 2), ("i2", 4)]
    assert sorted(r.v for r in spark.read.parquet(late).collect()) == [1, 2, 3]


def test_an_unfinished_issue_is_written_again(spark, tmp_path, monkeypatch):
    table = Versioned(spark, str(tmp_path / "t"), "issue")
    land(tmp_path / "in", "1.json", {"issue": "i1", "v": 1})

    def run():
        stream = spark.readStream.schema("issue string, v int").json(str(tmp_path / "in"))
        jobs.seal_issues(stream, table, str(tmp_path / "late"), str(tmp_path / "cp")).awaitTermination()

    def lost(*_, **__):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(Versioned, "_commit", lost)  # written, but not listed
        with pytest.raises(Exception):
            run()
    assert table.generation() == 0
    run()
    assert [(r.issue, r.v) for r in table.read().collect()] == [("i1", 1)]
    assert not os.path.exists(tmp_path / "late")
