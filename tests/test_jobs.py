"""Files, ingest, analysis and streams end to end."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewright import session
from tidewright.functions import fixed
from tidewright.plans import analysis, conditions, ingest, wide
from tidewright.sources import dimensions, files, grid, payload, precedence, sinks
from tidewright.streaming import jobs

HEADER = ",".join(fixed.CATCH_COLUMNS)


def catch_line(date="2024-01-05", species="タイ", size="40", memo="", source="Manual"):
    values = dict.fromkeys(fixed.CATCH_COLUMNS, "") | {
        "date": date, "species": species, "size_cm": size, "spot": "室戸沖", "memo": memo, "source": source}
    return ",".join(values.values())


def drop(folder, name, *lines, header=HEADER, bom=True):
    text = ("﻿" if bom else "") + "\r\n".join([header, *lines]) + "\r\n"
    (folder / name).write_text(text, encoding="utf-8", newline="")


@pytest.fixture
def boats(spark):
    return spark.createDataFrame([("b1", "here"), ("b2", "here"), ("far", "there")],
                                 "boat_id string, area_id string")


def no_master(spark):
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in fixed.MASTER_COLUMNS))


def test_ingest_adds_once(spark, boats, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    drop(inbox, "fishing_data_b1.csv", catch_line(), catch_line(size="41"), catch_line())
    drop(inbox, "fishing_data_b2.csv", catch_line(), catch_line() + ",extra")
    drop(inbox, "fishing_data_far.csv", catch_line())
    drop(inbox, "fishing_data_b9.csv", catch_line())
    drop(inbox, "notes.csv", catch_line())
    rows, rejected = ingest.read_drops(spark, f"{inbox}/*.csv", boats, "here")
    assert {(r._file, r.reason) for r in rejected.collect()} == {
        ("fishing_data_b2.csv", "width"), ("fishing_data_far.csv", "other_area"),
        ("fishing_data_b9.csv", "unknown_key")}
    first = ingest.ingest(no_master(spark), rows, rejected, "here")
    assert [(r.boat_id, r.scanned, r.added, r.skipped) for r in first.report.collect()] == [("b1", 3, 2, 1)]
    master = session.written(first.rows, "master")
    assert master.columns == fixed.MASTER_COLUMNS and master.count() == 2
    assert {r.source for r in master.collect()} == {"manual"}
    again = ingest.ingest(master, rows, rejected, "here")
    assert again.rows.count() == 2 and again.report.collect()[0].added == 0
    assert ingest.commit(again, master, str(tmp_path / "store"), "t1") is None
    assert not (tmp_path / "store").exists()


def test_first_row_in_file_order_stays(spark, boats, tmp_path):
    tides = ["長潮", "小潮", "中潮", "大潮"]
    for n in range(3):
        lines = [catch_line(size=str(i)) for i in range(40)]
        drop(tmp_path, "fishing_data_b1.csv", *[line.replace("室戸沖,,,,", f"室戸沖,,,,{tide}")
                                                for tide in tides[n:] + tides[:n] for line in lines])
        rows, rejected = ingest.read_drops(spark, f"{tmp_path}/*.csv", boats, "here")
        spread = rows.repartition(7)
        kept = ingest.ingest(no_master(spark), spread, rejected, "here").rows.collect()
        assert len(kept) == 40 and {r.tide for r in kept} == {tides[n]}


def test_row_order_does_not_change_ids(spark, boats, tmp_path):
    lines = [catch_line(size=str(i)) for i in range(20)]
    ids = []
    for n, order in enumerate([lines, lines[::-1]]):
        inbox = tmp_path / f"in{n}"
        inbox.mkdir()
        drop(inbox, "fishing_data_b1.csv", *order, bom=bool(n))
        rows, rejected = ingest.read_drops(spark, f"{inbox}/*.csv", boats, "here")
        ids.append({r.record_id for r in ingest.ingest(no_master(spark), rows, rejected, "here").rows.collect()})
    assert ids[0] == ids[1] and len(ids[0]) == 20


def test_replace_guards_the_master(spark, boats, tmp_path):
    inbox = tmp_path / "a"
    inbox.mkdir()
    drop(inbox, "fishing_data_b1.csv", *[catch_line(size=str(i)) for i in range(10)])
    drop(inbox, "fishing_data_b2.csv", *[catch_line(size=str(i)) for i in range(4)])
    master = session.written(ingest.ingest(
        no_master(spark), *ingest.read_drops(spark, f"{inbox}/*.csv", boats, "here"), "here").rows, "master")
    second = tmp_path / "b"
    second.mkdir()
    drop(second, "fishing_data_b1.csv", *[catch_line(size=str(i)) for i in range(5, 12)])
    rows, rejected = ingest.read_drops(spark, f"{second}/*.csv", boats, "here")
    done = ingest.ingest(master, rows, rejected, "here", "replace", ["b1"])
    assert {r.boat_id: r["count"] for r in done.rows.groupBy("boat_id").count().collect()} == {"b1": 7, "b2": 4}
    assert done.removed.count() == 10
    assert {(r.boat_id, r.scanned, r.added, r.skipped) for r in done.report.collect()} == {("b1", 7, 7, 0)}
    with pytest.raises(ValueError):  # b2 has no incoming rows at all
        ingest.ingest(master, rows, rejected, "here", "replace", ["b1", "b2"], force=True)
    with pytest.raises(ValueError):
        ingest.ingest(master, rows, rejected, "here", "add", ["b1"])
    path = ingest.commit(done, master, str(tmp_path / "store"), "t1")
    assert spark.read.parquet(path).count() == 11
    assert spark.read.parquet(str(tmp_path / "store/_backups/t1")).count() == 14


def test_header_must_match(spark, boats, tmp_path):
    drop(tmp_path, "fishing_data_b1.csv", catch_line(), header=HEADER.replace("memo", "note"))
    drop(tmp_path, "fishing_data_b2.csv", HEADER, catch_line(), header=catch_line(), bom=False)
    rows, rejected = ingest.read_drops(spark, f"{tmp_path}/*.csv", boats, "here")
    assert rows.count() == 0 and [r.reason for r in rejected.collect()] == ["header", "header"]


def test_dates_are_brought_to_one_form(spark, boats, tmp_path):
    drop(tmp_path, "fishing_data_b1.csv", catch_line(date="2024/1/5"), catch_line(date="2024-01-05"))
    rows, rejected = ingest.read_drops(spark, f"{tmp_path}/*.csv", boats, "here")
    assert ingest.ingest(no_master(spark), rows, rejected, "here", normalise_dates=False).rows.count() == 2
    one = ingest.ingest(no_master(spark), rows, rejected, "here").rows.collect()
    assert [(r.date, r.entered_at) for r in one] == [("2024-01-05", "2024-01-05T00:00:00+09:00")]


def test_lenient_reading(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿a,b,c\r\n1,2\r\n1,2,3,4\r\n\"x, \"\"y\"\"\",,z\r\n", encoding="utf-8")
    rows = files.read_lenient(spark, str(tmp_path / "t.csv"), ["a", "b", "c"]).collect()
    assert {tuple(r) for r in rows} == {("1", "2", ""), ("1", "2", "3"), ('x, "y"', "", "z")}


def test_versions_of_the_master(spark):
    with pytest.raises(ValueError):
        files.master_version(["a"])
    old = spark.createDataFrame([tuple("x" for _ in fixed.MASTER_V1_COLUMNS)],
                                ", ".join(f"{c} string" for c in fixed.MASTER_V1_COLUMNS))
    new = files.upgrade_master(old, "b1", "here").collect()[0]
    assert new.boat_id == "b1" and new.area_id == "here" and len(new) == 28


def test_dimension_documents(spark, tmp_path):
    (tmp_path / "boats.json").write_text(json.dumps({"boats": [
        {"boat_id": "b1", "area_id": "here", "active": True}, {"boat_id": "b2", "area_id": "here"},
        {"boat_id": "b3", "area_id": "here", "active": False}]}))
    boats = dimensions.read_entries(spark, str(tmp_path / "boats.json"), "boats")
    assert {r.boat_id for r in dimensions.active_only(boats).collect()} == {"b1", "b2"}
    (tmp_path / "cache.json").write_text(json.dumps({"entries": {
        "x": {"lat": 1.0, "lng": 2.0, "source": "nominatim"}, "y": {"lat": None, "lng": None, "reason": "no_hit"}}}))
    cache = dimensions.read_geocode_cache(spark, str(tmp_path / "cache.json"))
    spots = spark.createDataFrame([("x",), ("y",), ("z",), ("",)], "spot string")
    out = dimensions.cached_coordinates(spots, cache, "spot")
    assert {(r.spot, r.status, r.reason) for r in out.collect()} == {
        ("x", "hit", None), ("y", "negative_hit", "no_hit"), ("z", "miss", "cache_only_miss"),
        ("", "empty", "empty_spot_name")}
    assert {r.status: r.n for r in dimensions.cache_statistics(out).collect()}["hit"] == 1


HOURLY = ("station string, chunk string, hourly struct<time:array<string>,temperature_2m:array<double>,"
          "wind_speed_10m:array<double>,wind_direction_10m:array<double>,precipitation:array<double>,"
          "weather_code:array<int>,wave_height:array<double>,wave_direction:array<double>,"
          "wave_period:array<double>,sea_surface_temperature:array<double>>")


def documents(spark, *rows):
    names = ["temperature_2m", "wind_speed_10m", "wind_direction_10m", "precipitation", "weather_code",
             "wave_height", "wave_direction", "wave_period", "sea_surface_temperature"]
    return spark.createDataFrame(
        [(s, c, (times, *[values.get(n) or [] for n in names])) for s, c, times, values in rows], HOURLY)


def test_condition_sync(spark):
    as_of = F.lit("2024-01-10").cast("date")
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 9, 10)], "day date")
    stored = spark.createDataFrame([(dt.date(2024, 1, 1), "室戸")], "day date, station string")
    gaps, chunks = conditions.requests(days, stored, ["室戸"], as_of)
    assert {str(r.day) for r in gaps.collect()} == {"2024-01-02", "2024-01-09"}
    assert chunks.count() == 2
    times = [f"2024-01-{d:02d}T{h:02d}:00" for d in (2, 9) for h in (0, 3, 6)] + ["bad"]
    weather = {"temperature_2m": [1.0, 99.0, 2.0, 3.0], "wind_speed_10m": [4.0] * 6,
               "wind_direction_10m": [0.0, 0.0, 90.0, 180.0, 0.0, 0.0], "weather_code": [1, 1, 2, 3, 3, 3]}
    archive = documents(spark, ("室戸", "c", times, weather))
    forecast = documents(spark, ("室戸", "c", times, {**weather, "temperature_2m": [7.0] * 6}))
    sea = documents(spark, ("室戸", "c2", times[:3], {"sea_surface_temperature": [20.0, 0.0, 21.0]}))
    daily = spark.createDataFrame(
        [("室戸", "c2", (["2024-01-02"], [1.0])), ("室戸", "c9", (["2024-01-09", "2024-01-10"], [18.04, None]))],
        "station string, chunk string, daily struct<time:array<string>,sea_surface_temperature_mean:array<double>>")
    marine = documents(spark, ("室戸", "c", times, {"wave_height": [1.0, 9.0, 1.26], "wave_direction": [90.0] * 3,
                                                   "wave_period": [5.0] * 3}))
    rows = conditions.daily_conditions(gaps, archive, forecast, marine, sea, daily, as_of)
    out = {str(r.day): r for r in rows.collect()}
    assert (out["2024-01-02"]["気温_平均"], out["2024-01-02"]["水温"], out["2024-01-02"]["最大波高"]) == (1.5, 20.5, 1.3)
    assert (out["2024-01-09"]["気温_平均"], out["2024-01-09"]["水温"], out["2024-01-09"]["最大波高"]) == (7.0, 18.0, None)
    table = conditions.stored_form(rows)
    assert table.columns == fixed.CONDITION_COLUMNS
    row = {r["日付"]: r for r in table.collect()}["2024-01-09"]
    assert (row["県"], row["緯度"], row["最大波高"], row["潮汐"]) == ("高知", "33.29", "", "中潮")


def test_forecast_rows(spark):
    marine = spark.createDataFrame(
        [("t0", "2024-01-01T00:00", 1.005, 90.9, 0.5), ("t0", "2024-01-01T03:00", 1.0, 0.0, 0.1),
         ("t0", "2024-01-01T06:00", None, 0.0, 0.1), ("t0", "2024-01-01T12:00", 2.0, None, None)],
        "k string, time string, wave_height double, wave_direction double, wind_wave_height double")
    weather = spark.createDataFrame(
        [("t0", f"2024-01-01T{h:02d}:00", 3.25, None, None) for h in (0, 3, 6, 12)],
        "k string, time string, wind_speed_10m double, wind_direction_10m double, precipitation double")
    rows = payload.forecast_rows(marine, weather, ["k"]).orderBy("t").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("2024-01-01T00:00", round(1.005, 2), round(3.25, 1), 0, 90, 0.5, 0.0),
        ("2024-01-01T12:00", 2.0, round(3.25, 1), 0, None, None, 0.0)]


def test_first_source_takes_whole_keys(spark):
    def rows(*items):
        return spark.createDataFrame(items, "day string, v int")
    out = precedence.first_source(
        {"cmems": rows(("d1", 1), ("d2", 2)), "local": rows(("d2", 3), ("d2", 4))}, ["day"])
    assert {(r.day, r.v, r.source) for r in out.collect()} == {("d1", 1, "cmems"), ("d2", 3, "local"),
                                                               ("d2", 4, "local")}


def test_variable_names_and_merge(spark):
    a = spark.createDataFrame([("c1", 1.0), ("c2", None)], "cell string, uo double")
    b = spark.createDataFrame([("c2", 5.0, 9.0), ("c3", 6.0, 8.0)], "cell string, u double, thetao double")
    merged = grid.merge_variables([grid.with_known_names(a), grid.with_known_names(b)], ["cell"])
    assert {tuple(r) for r in merged.select("cell", "u", "temp").collect()} == {
        ("c1", 1.0, None), ("c2", 5.0, 9.0), ("c3", 6.0, 8.0)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", "p", 1.0), ("2024-01-02", "p", None)], "date string, point string, v double")
    sinks.write_issue(df, str(tmp_path), "i1")
    with pytest.raises(Exception):
        sinks.write_issue(df, str(tmp_path), "i1")
    later = spark.createDataFrame([("2024-01-02", "p", 7.0), ("2024-01-03", "p", 8.0)], df.schema)
    out = sinks.upsert(df, later, ["date", "point"]).collect()
    assert [(r.date, r.v) for r in out] == [("2024-01-01", 1.0), ("2024-01-02", 7.0), ("2024-01-03", 8.0)]
    sinks.write_columns(df, ["point", "v", "date"], str(tmp_path / "csv"))
    lines = b"".join(p.read_bytes() for p in sorted((tmp_path / "csv").glob("*.csv")))
    assert b"point,v,date\r\n" in lines and b"p,,2024-01-02\r\n" in lines
    for day in ("2024-01-01", "2024-01-01"):
        sinks.quarantine(df, str(tmp_path / "bad"), day)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 4
    sinks.append_json_lines(df, str(tmp_path / "lines"))
    sinks.append_json_lines(df, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 4


def test_analysis_sections(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    cond = spark.createDataFrame(
        [("室戸", d, 15 + i / 10, 1.0, "大潮" if i % 2 else "小潮", float(i % 29), "満月") for i, d in enumerate(days)],
        "station string, day date, water double, wave double, tide string, moon double, phase string")
    current = spark.createDataFrame(
        [(p, d, 0.5, 16.0, 34.0, 90.0) for d in days for p in ("室戸沖", "北西")],
        "point string, day date, speed double, temp double, salinity double, direction double")
    names = [*fixed.PROFILE_METRICS]
    rows = [(days[i % 20], s, 1.0, float(i), 30.0 + i, "大潮", "晴れ", "満月", "m", "b1" if i % 2 else "b2",
             *[16.0 + i % 3] * len(names)) for i in range(30) for s in ("タイ", "アジ")]
    rows.append((days[0], "一日", 1.0, 1.0, 1.0, "", "", "", "", "b1", *[1.0] * len(names)))
    schema = ("day date, species string, count double, weight_kg double, size_cm double, `潮汐` string, `天気` string, "
              "`月相` string, method string, boat_id string, " + ", ".join(f"`{n}` double" for n in names))
    catch = spark.createDataFrame(rows, schema)
    sections = analysis.analyse(catch, cond, current, "室戸", "室戸沖")
    counts = {name: df.count() for name, df in sections.items()}
    assert all(counts.values()), counts
    assert counts["headline"] == 2 and counts["predictions"] == 60 and counts["timeline"] == 40
    assert counts["records"] == 61 and counts["summaries"] == 2 * 20 and counts["month_totals"] == 24
    best = sections["predictions"].where("species = 'タイ' and label = '上昇'").collect()
    assert best and all(0 <= r.score <= 100 for r in best)
    assert analysis.for_boats(catch, ["b1"]).count() == 31


def test_wide_column_lists():
    assert len(wide.integrated_columns()) == 36 and len(wide.two_point_columns()) == 44


def test_stream_ingest_over_batches_and_restart(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def land(name, *pairs):
        (inbox / name).write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in pairs))

    def run(checkpoint):
        stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).json(str(inbox))
        jobs.ingest_new(stream, str(tmp_path / "table"), str(tmp_path / checkpoint), "k", ["v"]).awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "table")).collect())

    land("a.json", ("x", 2), ("x", 1), ("y", 5))
    land("b.json", ("x", 0), ("z", 1))
    first = run("cp")
    assert [k for k, _ in first] == ["x", "y", "z"]
    land("c.json", ("y", 9), ("w", 1))
    assert [k for k, _ in run("cp")] == ["w", "x", "y", "z"]
    assert run("other checkpoint") == run("cp")


def test_stream_drops_late_rows(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def land(name, *times):
        (inbox / name).write_text("\n".join(json.dumps({"ts": t, "s": "a", "v": 1.0}) for t in times))

    def run():
        stream = spark.readStream.schema("ts timestamp, s string, v double").json(str(inbox))
        jobs.to_table(jobs.daily(stream, "ts", "s", [F.count("v").alias("n")]), str(tmp_path / "out"),
                      str(tmp_path / "cp")).awaitTermination()
        return {str(r.day)[:10]: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    land("a.json", "2024-01-01T05:00:00Z", "2024-01-01T23:00:00Z", "2024-01-02T12:00:00Z")
    assert run() == {"2024-01-01": 2}
    land("b.json", "2024-01-01T06:00:00Z", "2024-01-02T13:00:00Z", "2024-01-04T00:00:00Z")
    assert run() == {"2024-01-01": 2, "2024-01-02": 2}


def test_stream_days_are_of_the_session_zone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    times = ["2024-01-01T14:59:00Z", "2024-01-01T15:01:00Z", "2024-01-02T14:00:00Z", "2024-01-05T00:00:00Z"]
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps({"ts": t, "s": "a"}) for t in times))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stream = spark.readStream.schema("ts timestamp, s string").json(str(tmp_path / "in"))
        jobs.to_table(jobs.daily(stream, "ts", "s", [F.count("s").alias("n")]), str(tmp_path / "out"),
                      str(tmp_path / "cp")).awaitTermination()
        assert {str(r.day): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {
            "2024-01-01": 1, "2024-01-02": 2}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stream_reads_the_partitions_of_a_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for day in ("d1", "d2"):
        (tmp_path / f"in/{day}.json").write_text("\n".join(
            json.dumps({"k": f"{day}{i}", "day": day}) for i in (1, 2, 1)))
    for checkpoint in ("a", "b"):
        stream = spark.readStream.schema("k string, day string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        jobs.ingest_new(stream, str(tmp_path / "t"), str(tmp_path / checkpoint), "k", [],
                        partition="day").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["d11", "d12", "d21", "d22"]


def test_shared_folder_follows_the_session(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert folder is None or session.fresh_path(spark, "t").startswith(folder)
    assert session.fresh_path(spark, "t") != session.fresh_path(spark, "t")


def test_a_hot_day_is_not_one_task(spark):
    rows = spark.range(2000).select(F.lit("d1").alias("day"), F.col("id").alias("cell"))
    other = spark.createDataFrame([("d1", 1), ("d2", 2), (None, 3)], "day string, cell long")
    found = precedence.first_source({"b": other, "a": rows}, ["day"], ["a", "b"])
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.groupBy("source", "day").count().collect().__len__() == 2
    assert found.where("source = 'a'").count() == 2000 and found.where("source = 'b'").collect()[0].day == "d2"


def test_documents_with_sorted_keys_by_folder(spark, tmp_path):
    frame = spark.createDataFrame([(1, "p", (2, [(3, "x")]), None), (2, "q", None, "é")],
                                  "b int, place string, a struct<z:int,y:array<struct<k:int,c:string>>>, c string")
    sinks.write_documents(frame, str(tmp_path / "d"), by=["place"], sort_keys=True)
    lines = sorted(line for path in (tmp_path / "d").glob("place=*/part-*") for line in path.read_text().splitlines())
    assert lines == ['{"a":{"y":[{"c":"x","k":3}],"z":2},"b":1}', '{"b":2,"c":"é"}']


def test_lists_stay_bounded(spark):
    rows = spark.range(250).select(F.lit("k").alias("area"), "id")
    found = sinks.listed(rows, ["area"], "id", F.struct("id"), "boats", 100).orderBy("part").collect()
    assert [len(r.boats) for r in found] == [100, 100, 50] and [x.id for x in found[1].boats] == list(range(100, 200))


def test_rejected_files_are_not_exchanged_by_file(spark, boats, tmp_path):
    drop(tmp_path, "fishing_data_b1.csv", catch_line(), catch_line(size="41"))
    drop(tmp_path, "fishing_data_b2.csv", catch_line() + ",extra")
    drop(tmp_path, "fishing_data_b9.csv")
    rows, rejected = ingest.read_drops(spark, f"{tmp_path}/*.csv", boats, "here")
    assert {(r._file, r.reason) for r in rejected.collect()} == {("fishing_data_b2.csv", "width")}
    assert rows.count() == 2
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning(_file" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ingest_works_ids_out_once(spark, boats, tmp_path):
    drop(tmp_path, "fishing_data_b1.csv", catch_line(), catch_line(size="41"), catch_line())
    rows, rejected = ingest.read_drops(spark, f"{tmp_path}/*.csv", boats, "here")
    found = ingest.ingest(no_master(spark), rows, rejected, "here")
    for frame in (found.rows, found.report, found.changes):
        assert "sha1" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert found.rows.count() == 2


def test_first_rows_are_the_earliest_of_each_key(spark, tmp_path):
    schema = "id long, key string, ts timestamp"
    inbox = str(tmp_path / "in")
    rows = spark.range(4000).selectExpr("id", "cast(id % 50 as string) AS key",
                                        "timestamp_seconds(1700000000 + 4000 - id) AS ts")
    rows.repartition(9).write.parquet(inbox)
    later = spark.createDataFrame([(9000, "1"), (9001, "new")], "id long, key string").selectExpr(
        "*", "timestamp_seconds(1700000000 + 5000) AS ts")
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(inbox)
        jobs.first_rows(stream, path, checkpoint, "ts", ["key"], ["id"], "2 hours").awaitTermination()
        later.write.mode("append").parquet(inbox)
    got = {(r.key, r.id) for r in spark.read.parquet(path).collect()}
    assert got == {(str(i % 50), i) for i in range(3950, 4000)} | {("new", 9001)}
