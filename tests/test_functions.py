import datetime as dt
import math
import random
import re
import subprocess
import sys
import unicodedata
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewright.functions import compass, fixed, geo, numbers, sky, text
from tidewright.operators import profile


def one(spark, column, **values):
    """Value of an expression on one row of the given columns."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(column.alias("out")).collect()[0].out


def many(spark, rows, schema, *columns):
    out = spark.createDataFrame(rows, schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4])
def test_py_round_is_python_round(spark, digits):
    rng = random.Random(digits)
    values = [round(rng.uniform(-300, 300), k) for k in (1, 2, 3, 4, 5, 6) for _ in range(2000)]
    values += [i / 8 for i in range(-200, 200)] + [2.675, 1.005, 1.115, 0.125, -2.5, 0.0]
    out = many(spark, [(v,) for v in values], "v double", F.col("v"), numbers.py_round("v", digits))
    assert [(v, r) for v, r in out if r != round(v, digits)] == []


def test_js_round(spark):
    out = many(spark, [(0.25,), (-0.25,), (1.05,), (2.35,)], "v double", numbers.js_round(F.col("v"), 1))
    assert [r[0] for r in out] == [math.floor(v * 10 + 0.5) / 10 for v in (0.25, -0.25, 1.05, 2.35)]


def test_to_number_follows_python(spark):
    texts = ["1.5", " 12 ", "1_000", "1.5d", "abc", "", "1e3", "-.5", "inf", "nan", "1.", "0x1", "--1"]

    def python(value):
        try:
            return float(value)
        except ValueError:
            return None

    out = many(spark, [(t,) for t in texts], "t string", numbers.to_number(F.col("t")))
    for raw, (value,) in zip(texts, out):
        wanted = python(raw)
        assert value == wanted or (wanted != wanted and value != value), raw


def test_strip_and_normal_form(spark):
    texts = ["　ＡＢＣ　", " x ", "ｶﾞ ", "plain", "", None, "①\n", "é"]
    out = many(spark, [(t,) for t in texts], "t string", text.clean(F.col("t")))
    assert [o[0] for o in out] == [unicodedata.normalize("NFKC", (t or "").strip()) for t in texts]


def test_several_texts_at_once(spark):
    rows = [("Ａ", "b"), ("a", "b"), (None, "①"), ("x", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    out = text.with_nfkc(df, {"p": text.strip(F.col("a")), "q": text.strip(F.col("b"))})
    assert [(r.p, r.q) for r in out.collect()] == [("A", "b"), ("a", "b"), ("", "1"), ("x", "")]
    assert out.columns == ["a", "b", "p", "q"]


def test_worker_functions_travel_by_value(tmp_path):
    """A process elsewhere, without the package on its path, can run them."""
    code = ("import pickle, sys, pyarrow as pa; f = pickle.loads(sys.stdin.buffer.read()); "
            "assert f(pa.array(['\uff21', None])).to_pylist() == ['A', None]")
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(text._nfkc.func),
                          cwd=tmp_path, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()


def test_dates_and_times(spark):
    dates = {"2024-1-5": "2024-01-05", "2024/01/05": "2024-01-05", "2024.1.5": "2024-01-05",
             "2024-13-5": "2024-13-5", "2024/2/30": "2024/2/30", "2024-1/5": "2024-1/5", "": ""}
    assert many(spark, [(k,) for k in dates], "d string", text.iso_date(F.col("d"))) == [
        (v,) for v in dates.values()]
    times = {"6:5": "06:05", "06:05:59": "06:05", "6時5分": "06:05", "24:00": "24:00", "7:61": "7:61",
             "23:59": "23:59", "": "", "noon": "noon"}
    assert many(spark, [(k,) for k in times], "t string", text.hour_minute(F.col("t"))) == [
        (v,) for v in times.values()]


def test_spot_names(spark):
    names = {"高知県室戸沖（磯）": "室戸沖", "高知 安満地（風裏）": "安満地", "愛媛": "愛媛", "高知県": "県",
             "和歌山県": "県", "小笠原諸島": "小笠原", "高知高知": "高知", "": "", "　": ""}
    assert many(spark, [(k,) for k in names], "s string", text.canonical_spot(F.col("s"))) == [
        (v,) for v in names.values()]


def test_sources(spark):
    shown = {"manual": "Manual", "blog:x": "Blog:x", "import:csv": "Import:csv", "室戸2ブログ": "室戸2ブログ",
             "": "", "Other": "Other"}
    assert many(spark, [(k,) for k in shown], "s string", text.external_source(F.col("s"))) == [
        (v,) for v in shown.values()]


def test_record_id_is_uuid5(spark):
    rows = [(" ａ ", None, "室戸"), ("2024-01-05", "x", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = text.with_record_id(df, "id", F.lit("b1"), [F.col(x) for x in "abc"]).collect()
    space = uuid.UUID(fixed.RECORD_ID_NAMESPACE)
    for row, got in zip(rows, out):
        parts = [unicodedata.normalize("NFKC", (x or "").strip()) for x in row]
        assert got.id == str(uuid.uuid5(space, "|".join(["b1", *parts])))


def test_nearest_places(spark):
    places = [("室戸沖", 33.29, 134.18, ""), ("安満地", 33.47, 133.88, ""), ("小笠原", 27.0, 142.2, "")]
    df = spark.createDataFrame(places, "name string, lat double, lng double, area string")
    rows = geo.with_nearest(geo.with_nearest(df, "lat", "lng", fixed.STATIONS, out="s"), "lat",
                            "lng", fixed.CURRENT_POINTS, out="p").collect()
    found = {r["name"]: r for r in rows}
    assert found["室戸沖"].s.name == "室戸" and found["室戸沖"].s.km == 0
    assert found["室戸沖"].p.name == "北東" and round(found["室戸沖"].p.km, 6) == 10.479817
    assert found["安満地"].s.name == "高知" and round(found["安満地"].s.km, 6) == 33.071152
    assert found["安満地"].p.name == "北西" and round(found["安満地"].p.km, 6) == 33.951827


def test_tie_of_distances_goes_to_smaller_name(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "lat double, lng double")
    near = geo.with_nearest(df, "lat", "lng", [("b", 0.0, 1.0, ""), ("a", 0.0, -1.0, "")], out="n")
    assert near.collect()[0].n.name == "a"


def test_nearest_of_many_places_everywhere(spark):
    """Over poles and the date line, with areas, against all distances."""
    draw = random.Random(8)
    places = [(f"p{i}", draw.uniform(-90, 90), draw.uniform(-180, 180), draw.choice("xyz"))
              for i in range(1500)]
    spots = [(i, draw.choice([draw.uniform(-90, 90), 89.9, -89.9]), draw.choice(
        [draw.uniform(-180, 180), 179.99, -179.99]), draw.choice(["", "x", "none"])) for i in range(150)]
    spots += [(200, None, 1.0, ""), (201, float("nan"), 1.0, ""), spots[0]]

    def km(a, b, c, d):
        h = (math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a))
             * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2)
        return 6371 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    df = spark.createDataFrame(spots, "i long, lat double, lng double, a string")
    found = geo.with_nearest(df, "lat", "lng", places, "a", "n").collect()
    assert len(found) == len(spots)
    for row in found:
        known = row.lat is not None and not math.isnan(row.lat)
        near = [(round(km(row.lat, row.lng, la, lo), 6), name) for name, la, lo, ar in places
                if known and row.a in ("", ar)]
        assert (row.n.name if row.n else None) == (min(near)[1] if near else None)


def test_few_places_are_met_however_dense(spark, monkeypatch):
    """Places of a small area, some at one position, for near and far positions in two areas."""
    draw = random.Random(9)
    places = [(f"p{i}", 33 + draw.randrange(60) / 100, 134 + draw.randrange(60) / 100, "xy"[i % 2])
              for i in range(4000)] + [("nan", float("nan"), 134.0, "x"), ("none", None, 134.0, "y")]
    spots = [(i, draw.choice([33.3, 33.05, -33.3, 89.0, 60.0]), draw.choice([134.2, 134.5, -46.0, 10.0]),
              draw.choice(["", "x", "z"])) for i in range(60)]
    met = []
    pairs = geo.near_pairs
    monkeypatch.setattr(geo, "near_pairs", lambda *a: met.append(pairs(*a)) or met[0])
    df = spark.createDataFrame(spots, "i long, lat double, lng double, a string")
    table = spark.createDataFrame(places, "name string, lat double, lng double, area string")
    found = geo.with_nearest(df, "lat", "lng", table, "a", "n").select(
        "lat", "lng", "a", "n.name", "n.rounded").collect()
    at = spark.createDataFrame([(*row[:3], *place) for row in set(found) for place in places[:4000]
                                if row.a in ("", place[3])],
                               "y double, x double, a string, name string, lat double, lng double, area string")
    at = at.select("y", "x", "a", "name", F.round(geo.haversine_km("y", "x", "lat", "lng"), 6).alias("km"))
    best = {tuple(r[:3]): r.best for r in at.groupBy("y", "x", "a").agg(
        F.min(F.struct("km", "name")).alias("best")).collect()}
    assert len(found) == 60
    for row in found:
        nearest = best.get((row.lat, row.lng, row.a))
        assert (row.rounded, row.name) == (tuple(nearest) if nearest else (None, None))
    assert 0 < met[0].count() < 20 * len(best)


def test_moon_age_by_julian_days(spark):
    def age(day):
        y, m = (day.year - 1, day.month + 12) if day.month <= 2 else (day.year, day.month)
        century = y // 100
        julian = (math.floor(365.25 * (y + 4716)) + math.floor(30.6001 * (m + 1)) + day.day
                  + 2 - century + century // 4 - 1524.5)
        return round((julian - 2451550.1) % 29.530588853 * 10) / 10

    days = [dt.date(1995, 1, 1) + dt.timedelta(days=i) for i in range(0, 12000, 7)]
    out = many(spark, [(d,) for d in days], "d date", F.col("d"), sky.moon_age(F.col("d")))
    assert [d for d, a in out if a != age(d)] == []


def test_tide_classes(spark):
    ages = [0.0, 2.0, 2.1, 5.0, 8.0, 10.0, 12.0, 16.0, 19.0, 22.0, 24.0, 26.0, 27.9, 28.0, 29.5]
    out = many(spark, [(a,) for a in ages], "a double", sky.tide_class(F.col("a")))
    assert [o[0] for o in out] == ["大潮", "大潮", "中潮", "中潮", "小潮", "長潮", "若潮", "大潮", "中潮",
                                   "小潮", "長潮", "若潮", "中潮", "大潮", "大潮"]


def test_sectors(spark):
    degrees = [0.0, 11.25, 33.75, 348.75, 359.9, 22.4, 22.5, 337.5]
    out = many(spark, [(d,) for d in degrees], "d double", compass.sector16(F.col("d")),
               compass.sector16_up(F.col("d"), fixed.COMPASS_16), compass.sector8(F.col("d")))
    for d, (even, up, eight) in zip(degrees, out):
        assert even == fixed.COMPASS_16[round(d / 22.5) % 16]
        assert up == fixed.COMPASS_16[math.floor(d / 22.5 + 0.5) % 16]
        assert eight == fixed.COMPASS_8[int((d + 22.5) / 45) % 8]


def test_weather_text(spark):
    out = many(spark, [(61,), (62,), (None,)], "c int", text.weather_text(F.col("c")))
    assert out == [("弱い雨",), ("code62",), ("",)]


def test_numbers_that_are_not_finite(spark):
    rows = [(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, None), (5, 90.0)]
    df = spark.createDataFrame(rows, "i int, v double")
    out = df.select("i", compass.sector8(F.col("v")).alias("s8"), compass.sector16(F.col("v")).alias("s16"),
                    compass.sector16_up(F.col("v")).alias("up"), profile.amount(F.col("v")).alias("n")).collect()
    assert [(r.s8, r.s16, r.up, r.n) for r in sorted(out)][:4] == [(None, None, None, 1)] * 4
    assert sorted(out)[4].n == 90 and sorted(out)[4].s8 == fixed.COMPASS_8[2]
    whole = spark.createDataFrame([("1" * 30,), ("+7 ",), ("x",)], "t string")
    assert [r[0] for r in whole.select(numbers.to_int(F.col("t"))).collect()] == [int("1" * 30), 7, None]


def test_stable_characters_are_their_own_form():
    inside = re.compile(f"[{text.STABLE}]")
    stable = [c for c in map(chr, range(0x110000)) if inside.match(c)]
    assert len(stable) > 20_000
    for c in stable:
        assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c)
    # Stable beside each other, too: nothing in the ranges joins with what comes before it.
    assert unicodedata.normalize("NFKC", "".join(stable)) == "".join(stable)
    assert unicodedata.normalize("NFKC", "".join(stable[::-1])) == "".join(stable[::-1])


def test_several_texts_in_normal_form(spark):
    import unicodedata
    rows = [("ｱ", "é", None), ("plain", "", "x"), ("①\x1f②", "\x1e0", "\x1e1\x1f"), ("\x1f", "\x1e̸", "ﬁ\x1e"),
            ("", "́ｶﾞ", "́"), (None, None, None), ("\x1e\x1f", "é", "Å")]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    found = text.with_nfkc(frame, {c: F.col(c) for c in "abc"}).collect()
    normal = lambda t: None if t is None else unicodedata.normalize("NFKC", t)
    assert [tuple(r) for r in found] == [tuple(map(normal, r)) for r in rows]


def test_stable_texts_and_seeds_are_worked_out_once(spark):
    texts = ["漢字" * 200_000, "é\n", "あ\n漢a", "", "ｶ", "漢ｱ", "が", "é"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    stable = [r[0] for r in frame.select(text._stable(F.col("t"))).collect()]
    assert stable == [True] * 4 + [False] * 4
    out = text.with_record_id(frame, "id", F.lit("b"), [F.col("t")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws(|, b") == 1


def test_normal_form_goes_by_parts_of_long_texts():
    import pyarrow as pa

    normal = text._normal_form_function().func
    texts = [None, "ｶ" * 2_000_000, "a", "", "Ａ" * 900_000, "ｱ", None, "が" * 500_000]
    out = normal(pa.array(texts))
    assert out.to_pylist() == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
