"""Names as tables, curvilinear grids and findings by line against plain Python."""
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewright.functions import fixed, text
from tidewright.operators import names, quality, spatial
from tidewright.sources import files


def test_names_as_plain(spark, monkeypatch):
    draw = random.Random(4)
    letters = "abé漢😀 "
    known = [("".join(draw.choice(letters) for _ in range(draw.randrange(0, 9))), i) for i in range(120)]
    known += [("abcdefgh" + c, 500 + i) for i, c in enumerate(["", "x", "xy", "é"])] + [(None, 3), known[5]]
    bad = [("漢漢b",), ("",), (None,)]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 40))) for _ in range(200)]
    texts += [None, "", "abcdefghxyz", "zabcdefghé", "abcdefg", "a" * 5000, texts[3], texts[3]]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    table = spark.createDataFrame(known, "name string, rank int")
    wanted = []
    for i, t in enumerate(texts):
        found = sorted((-len(n), r, n) for n, r in known if n and t and n in t)
        blocked = t is not None and any(b and b in t for b, in bad)
        wanted.append((i, t, found[0][2] if found and not blocked else None))
    for bits in (names.FILTER_BITS, 64):  # also with a filter that passes everything
        monkeypatch.setattr(names, "FILTER_BITS", bits)
        got = names.longest_name_in(rows, "t", table, "name", "rank", "hit", spark.createDataFrame(bad, "name string"))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_no_names_and_no_nested_loop(spark):
    rows = spark.createDataFrame([(1, "abc")], "id int, t string")
    none = spark.createDataFrame([], "name string, rank int")
    found = names.longest_name_in(rows, "t", none, "name", "rank", "hit")
    assert found.collect()[0].hit is None
    some = spark.createDataFrame([("b", 1), ("bc", 2)], "name string, rank int")
    found = names.longest_name_in(rows, "t", some, "name", "rank", "hit")
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.collect()[0].hit == "bc"


@pytest.mark.parametrize("most", [names.MOST_SHORT, 0])
def test_what_passes_meets_the_names_without_an_exchange_of_its_own(spark, monkeypatch, most):
    """Whether short names are known to the tasks or only pass the filter; names that are bad as well."""
    monkeypatch.setattr(names, "MOST_SHORT", most)
    texts = ["ab é漢", "abab", "x", "é漢漢", "abcdefghij ab", "", None, "漢b", "abcdefghi", "a\0b", "ab é漢"]
    known = [("ab", 2), ("b", 1), ("é漢", 3), ("é", 0), ("漢", 5), ("abcdefghij", 4), ("a\0", 6), ("abc", 7)]
    bad = ["漢b", "b", "abcdefghij"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = spark.createDataFrame(known, "name string, rank int")
    for words in (bad, bad[:1], []):
        got = names.longest_name_in(rows, "t", table, "name", "rank", "hit",
                                    spark.createDataFrame([(w,) for w in words], "name string"))
        assert "around" not in "".join(re.findall(r"(?:Aggregate\(keys=|Exchange hashpart)[^\n]*",
                                                  got._jdf.queryExecution().executedPlan().toString()))
        for i, t, hit in got.collect():
            found = sorted((-len(n), r, n) for n, r in known if t and n in t)
            assert hit == (found[0][2] if found and not any(w in t for w in words) else None)


def test_tables_give_the_fixed_names(spark):
    spots = ["高知県室戸沖", "高知 室戸沖(磯)", "高知県", "高知", "", None, "ｱｲｳ", *fixed.SPOT_ALIASES, "室戸沖"]
    spots += [p + s for p in fixed.SPOT_PREFIXES for s in ("", "港", "（高知）")]
    rows = spark.createDataFrame([(s,) for s in spots], "spot string")
    aliases = spark.createDataFrame(list(fixed.SPOT_ALIASES.items()), "from string, to string")
    prefixes = spark.createDataFrame([(p,) for p in fixed.SPOT_PREFIXES], "prefix string")
    both = names.canonical_by_table(rows, "spot", aliases, prefixes, "a").withColumn(
        "b", text.canonical_spot(F.col("spot"))).collect()
    assert len(both) == len(spots) and all(r.a == r.b for r in both)
    bare = names.canonical_by_table(rows, "spot", aliases.where("false"), prefixes.where("false"), "a")
    assert bare.count() == len(spots)


@pytest.mark.parametrize("cell", [0.25, 3.0])
def test_curved_grid_as_plain(spark, cell):
    draw = random.Random(6)
    points = [("here", 33.2, 134.1, ""), ("edge", 33.0, 134.0, ""), ("far", -50.0, -170.0, ""), ("pole", 90.0, 0.0, "")]
    rows = []
    for d in ("d1", "d2"):
        for y in range(30):
            for x in range(30):
                lat, lon = 33 + y / 40 + x / 300 * draw.random(), 134 + x / 40 + y / 200
                for depth in ((0.5, 1.5) if d == "d1" else (2.5,)):
                    rows.append((d, depth, y, x, lat, lon, y + 100.0 * x + depth, 1.0, 20.0, 34.0))
    rows += [("d1", 0.5, 99, 0, None, 134.0, 0.0, 0.0, 0.0, 0.0), ("d1", 0.5, 99, 1, float("nan"), 134.0, 0.0, 0.0, 0.0, 0.0),
             ("d2", 2.5, 50, 0, 33.2, 134.1, 7.0, 0.0, None, None), ("d2", 2.5, 49, 9, 33.2, 134.1, 8.0, 0.0, 1.0, 1.0)]
    grid = spark.createDataFrame(rows, "day string, depth double, y int, x int, lat double, lon double, u double, "
                                       "v double, temp double, salt double").repartition(5)
    got = {(r.day, r.point): r for r in spatial.grid_points_2d(grid, points, cell=cell).collect()}
    assert len(got) == 8
    for day in ("d1", "d2"):
        own = [r for r in rows if r[0] == day and r[4] is not None and r[4] == r[4]]
        top = min(r[1] for r in own)
        for name, p, q, _ in points:
            best = min((((r[4] - p) ** 2 + (r[5] - q) ** 2, r[2], r[3]), r[6]) for r in own if r[1] == top)
            found = got[day, name]
            assert found.u_ms == pytest.approx(best[1], abs=1e-4)
            assert found.too_far == (best[0][0] ** 0.5 > 0.15)


def test_lines_of_split_files(spark, tmp_path):
    lines = ["﻿day,point,v"] + [f"2024-01-{i % 28 + 1:02},p{i},{'x' * (i % 50)}" for i in range(2000)]
    lines[7] = ""
    lines[1500] = "2024/01/01,p,1"
    lines[1999] = lines[3]
    lines[2000] = '2024-01-01,"a,""b"",c",1,2'
    (tmp_path / "one.csv").write_text("\r\n".join(lines) + "\r\n", encoding="utf-8", newline="")
    (tmp_path / "two.csv").write_text("day,place,v\n2024-01-01,p9,\n2024-01-01,p9,1", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1500", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        try:
            raw = files.read_lines(spark, str(tmp_path))
            if size == "1500":
                assert raw.rdd.getNumPartitions() > 10
            got = {(r._file, r._line): r.value for r in raw.collect()}
            for n, line in enumerate(lines, 1):
                assert got["one.csv", n].lstrip("﻿") == line.lstrip("﻿")
            assert len(got) == len(lines) + 3
            points = [f"p{i}" for i in range(2000) if i != 11]
            found = quality.line_findings(raw, "c", ["day", "point", "v"], "day", ["day", "point"], points)
            shown = sorted(map(tuple, found.drop("check").collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert shown == [
            ("bad_date", "one.csv", 1501, "2024/01/01"), ("duplicate_key", "one.csv", 2000, "2024-01-03|p2"),
            ("duplicate_key", "two.csv", 3, "2024-01-01|p9"), ("header", "two.csv", 1, "day,place,v"),
            ("unknown_point", "one.csv", 13, "p11"), ("unknown_point", "one.csv", 1501, "p"),
            ("width", "one.csv", 8, "0"), ("width", "one.csv", 2001, "4")]
    reported = quality.report(quality.as_findings(found), ["c", "d"]).collect()
    assert {r.check: (r.ok, r.total_issues) for r in reported} == {"c": (False, 8), "d": (True, 0)}
