"""Dedup, near duplicates, quality, sharding, licences and the pipeline against plain versions."""
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import odd
from compare import connect, difference
from tidewright.llm import components, cuckoo, jaccard, licences, quality, queries, sharding
from tidewright.llm.common import one_row_each, raw_digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_rows_as_sql(spark, name):
    left = queries.QUERIES[name](spark, SF).toPandas()
    assert difference(left, connect(SF).execute(queries.SQL[name]).df()) == ""


# Exact dedup

def normal(text):
    return (text or "").translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r")))


def test_dedup(spark):
    found = cuckoo.dedup(odd.docs(spark)).toPandas()
    assert len(found) == len(odd.rows())
    groups = {}
    for i, t, *_ in odd.rows():
        groups.setdefault(hashlib.sha256(normal(t).encode()).hexdigest(), []).append((i, t or ""))
    for key, held in groups.items():
        rows = found[found.text_sha256 == key]
        best = min(held, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        assert (rows.group_size == len(held)).all() and len(rows) == len(held)
        assert rows.kept.sum() == 1
        assert rows.keep_id.fillna(-1).eq(-1 if best[0] is None else best[0]).all()
    assert cuckoo.dedup(odd.none(spark)).count() == 0


def test_survivors_keep_whole_rows(spark):
    frame = odd.docs(spark)
    kept = cuckoo.survivors(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len({normal(t) for _, t, *_ in odd.rows()})


def test_filter_deletes_and_grows():
    index, draw = cuckoo.LiveIndex(2), random.Random(0)
    digests = [draw.randbytes(32) for _ in range(3000)]
    for at, digest in enumerate(digests):
        index.add(digest, 1, at, at)
    assert index.resized > 3 and all(d in index.filter for d in digests)
    assert sum(draw.randbytes(32) in index.filter for _ in range(3000)) < 10
    index.add(digests[5], 9, 7, 7)
    assert index.keys[digests[5]] == [9, 7, 7, 2]
    assert index.remove(digests[5]) and digests[5] in index.keys
    for digest in digests[:1500]:
        assert index.remove(digest)
    assert not index.remove(b"\0" * 32)
    assert len(index.keys) == 1500 and all(d in index.filter for d in digests[1500:])
    back = cuckoo.CuckooFilter.from_bytes(index.filter.to_bytes())
    assert back.marks == index.filter.marks


def test_false_hits_are_verified():
    index = cuckoo.LiveIndex()
    first = bytes(range(32))
    twin = first[:31] + b"\xff"  # the same mark and cells, another key
    index.add(first, 1, 1, 1)
    index.add(twin, 1, 2, 2)
    assert index.false_hits == 1 and len(index.keys) == 2


def test_index_over_batches(spark):
    rows = cuckoo.keys(spark.createDataFrame(
        [(i, f"text {i // 3} " + " " * (i % 3)) for i in range(60)], "doc_id long, text string"))
    old, new = rows.where("doc_id < 40"), rows.where("doc_id >= 40")
    index = cuckoo.insert(cuckoo.empty_index(spark), old, 4)
    index = cuckoo.insert(index, new, 4)
    live = {r.doc_id: r.copies for r in cuckoo.entries(index).collect()}
    assert live == {3 * k + 2: 3 for k in range(20)}
    gone = rows.where("doc_id % 3 = 2 AND doc_id < 30 OR doc_id >= 57")
    index = cuckoo.delete(index, gone, rows.join(gone, "row_id", "left_anti"), 4)
    live = {r.doc_id: r.copies for r in cuckoo.entries(index).collect()}
    assert live == {3 * k + 1: 2 for k in range(10)} | {3 * k + 2: 3 for k in range(10, 19)}


# Near duplicates

def plain_shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    """(doc_id, size, smallest doc_id reached) of rows (doc_id, text)."""
    sets = [plain_shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * len(a & b) >= 3 * len(a | b):
                top[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((-1 if d is None else d, len(sets[i]), least.get(find(i), -1))
                  for i, (d, _) in enumerate(rows))


def family(seed, size, words, edits, vocabulary=400):
    """Copies of one text with some words replaced."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"e{draw.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def found_components(frame):
    found = jaccard.near_duplicates(frame).select("doc_id", "n_shingles", "component_id").toPandas()
    return sorted(map(tuple, found.fillna(-1).astype(int).values.tolist()))


def test_components_of_near_copies(spark):
    draw = random.Random(2)
    texts = []
    for seed in range(12):
        texts += family(seed, draw.randrange(2, 30), draw.randrange(4, 120), draw.randrange(0, 9))
    texts += [" ".join(f"u{draw.randrange(9)}" for _ in range(draw.randrange(12))) for _ in range(80)]
    common = " ".join(f"c{i}" for i in range(40))  # a passage that many texts share
    texts += [common + " " + " ".join(f"r{draw.randrange(10 ** 5)}" for _ in range(draw.randrange(40)))
              for _ in range(60)]
    draw.shuffle(texts)
    rows = [(int(i), t) for i, t in zip(draw.sample(range(10 ** 6), len(texts)), texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_components(rows)
    assert len({c for _, _, c in want}) < len(want) - 100
    assert found_components(frame) == want


def test_components_of_odd_rows(spark):
    assert found_components(odd.docs(spark)) == plain_components([r[:2] for r in odd.rows()])
    assert found_components(odd.none(spark)) == []
    kept = jaccard.one_of_each(odd.docs(spark))
    assert kept.columns == odd.docs(spark).columns


def test_queries_of_near_duplicates_are_short(spark, monkeypatch):
    """The driver plans a query anew after each exchange and holds it, so long ones take its memory."""
    exchanges = []

    def noted(frame):
        exchanges.append(frame._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return frame

    held, possible = jaccard.written, jaccard.possible
    monkeypatch.setattr(jaccard, "written", lambda frame, name: held(noted(frame), name))
    monkeypatch.setattr(jaccard, "possible", lambda *a: noted(possible(*a)))
    noted(jaccard.one_of_each(spark.read.parquet(f"{SF}/documents.parquet")))
    assert len(exchanges) > 5 and max(exchanges) <= 12, exchanges


def test_one_prefix_for_many_sets(spark, monkeypatch):
    """Sets that agree in size and prefix and not elsewhere are one group of several classes."""
    draw = random.Random(4)
    head = " ".join(f"h{i}" for i in range(30))
    rows = [(i, head + " " + " ".join(f"t{draw.randrange(3)}" for _ in range(8))) for i in range(40)]
    # Counts by which the head's shingles are the rarest.
    monkeypatch.setattr(jaccard, "shingle_counts", lambda docs: np.ones(jaccard.CELLS, np.int64))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_components(frame) == plain_components(rows)


def test_labels_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 300)], "a long, b long")
    found = {r.node: r.label for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 500: 300}


# Quality

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op4_quality_classifier(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").toPandas()
    assert len(rows) > 50 and rows.score.between(0, 1).all()
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(rows.doc_id, rows.held_out))


def test_quality_of_odd_rows(spark):
    frame = odd.docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 1), (None, 1), (4, None)],
                                   "doc_id long, quality int")
    for known, one in ((labels, False), (labels.where("quality = 1"), True),
                       (labels.where("false"), True)):
        model = quality.fit(frame, known)
        scored = quality.score(frame, model)
        rows = scored.toPandas()
        assert len(rows) == len(odd.rows()) and rows.score.between(0, 1).all()
        assert scored.columns == [c for c in frame.columns if c != "score"] + ["score"]
        assert not one or rows.score.nunique() == 1
    assert quality.score(odd.none(spark), model).count() == 0


def test_isotonic():
    value = quality.isotonic(np.array([0, 1, 0, 2, 1, 5.0]), np.array([1, 1, 1, 1, 3, 1.0]))
    assert np.allclose(value, [0, 0.5, 0.5, 1.25, 1.25, 5])


# Sharding

def test_shards(spark):
    frame = odd.docs(spark)
    found = sharding.shuffle(frame, 7)
    rows = found.toPandas()
    assert sorted(found.columns) == sorted(frame.columns)
    sizes = rows.groupby("shard").slot.agg(["min", "max", "count", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and sizes["count"].sum() == len(odd.rows())
    assert (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["nunique"]).all()
    assert sorted(map(str, rows.text)) == sorted(str(t) for _, t, *_ in odd.rows())
    assert sharding.shuffle(odd.none(spark), 7).count() == 0


def test_matrix_has_exact_margins(spark):
    parts = {3: 10, 4: 0, 5: 33, 9: 1, 10: 6, 11: 700, 12: 250}
    frame = spark.createDataFrame(list(parts.items()), "p long, n long")
    for seed, shards in ((1, 3), (2, 3), (3, 1), (4, 40)):
        ends = {r.p: r.ends for r in sharding.matrix(frame, len(parts), shards, seed).collect()}
        counts = np.array([np.diff([0, *ends[p]]) for p in parts])
        assert counts.sum(axis=1).tolist() == list(parts.values()) and (counts >= 0).all()
        sizes = counts.sum(axis=0)
        assert len(sizes) == shards and sizes.max() - sizes.min() <= 1 and sizes.sum() == 1000
    again = {r.p: r.ends for r in sharding.matrix(frame, len(parts), 40, 4).collect()}
    assert again == ends


def test_dealt_counts_are_spread_as_a_shuffles(spark):
    rows = F.expr("array(named_struct('p', 1L, 'n', 10L), named_struct('p', 2L, 'n', 33L), "
                  "named_struct('p', 3L, 'n', 7L))")
    place = lambda p, s: sharding._uniform(F.col("id"), p, s)
    found = spark.range(2000).select(sharding._dealt(
        F.expr("array(16L, 17L, 17L)"), rows, place).alias("m")).collect()
    draws = np.array([[part.counts for part in r.m] for r in found])
    assert (draws.sum(axis=2) == [10, 33, 7]).all() and (draws.sum(axis=1) == [16, 17, 17]).all()
    # A cell of a shuffle is hypergeometric: mean n m / N, variance n m (N - n) (N - m) / N^2 (N - 1).
    for i, n in enumerate((10, 33, 7)):
        for j, m in enumerate((16, 17, 17)):
            spread = n * m * (50 - n) * (50 - m) / (50 * 50 * 49)
            assert abs(draws[:, i, j].mean() - n * m / 50) < 4 * (spread / 2000) ** 0.5
            assert abs(draws[:, i, j].var() / spread - 1) < 0.2


def test_hypergeometric_draws_follow_the_exact_probabilities(spark):
    cases = [(5, 0, 3), (0, 9, 4), (9, 4, 0), (6, 5, 4), (30, 70, 90), (300, 900, 80), (2, 5000, 4000)]
    grid = 4000
    at = ((F.col("id") + 0.5) / grid).alias("u")
    for good, bad, taken in cases:
        found = spark.range(grid).select(at).select(sharding.hypergeometric(
            F.col("u"), F.lit(good), F.lit(bad), F.lit(taken)).alias("k")).groupBy("k").count().collect()
        share = {r.k: r["count"] / grid for r in found}
        exact = {k: math.comb(good, k) * math.comb(bad, taken - k) / math.comb(good + bad, taken)
                 for k in range(max(0, taken - bad), min(good, taken) + 1)}
        assert set(share) <= set(exact)
        assert all(abs(share.get(k, 0) - p) <= 1.01 / grid for k, p in exact.items()), (good, bad, taken)
    large = spark.range(60).select(sharding.hypergeometric(
        (F.col("id") + 0.5) / 60, F.lit(10 ** 10), F.lit(3 * 10 ** 10), F.lit(10 ** 7)).alias("k"))
    k = np.array([r.k for r in large.collect()])
    assert abs(k.mean() - 2.5e6) < 100 and abs(k.std() / 1369 - 1) < 0.05


# Licences

def test_licences_inherit_from_the_nearest_directory(spark):
    files = [("a/LICENSE", "Released under the MIT License."),
             ("a/b/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
             ("a/x.c", "int main;"), ("a/b/c/d/y.c", None), ("a/bb/z.c", ""),
             ("a/b/own.c", "code\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
             ("other/q.c", "a licence nobody knows"), ("top.c", "text"), (None, "text"),
             ("a/x.c", "int main;")]
    frame = spark.createDataFrame([(i, p, t, "MIT") for i, (p, t) in enumerate(files)],
                                  "doc_id long, path string, text string, licence string")
    found = {r.doc_id: (r.licence, r.found_in, r.from_path) for r in licences.scan(frame).collect()}
    assert found == {
        0: ("MIT", "file", "a/LICENSE"), 1: ("Apache-2.0", "file", "a/b/COPYING.txt"),
        2: ("MIT", "inherited", "a/LICENSE"), 3: ("Apache-2.0", "inherited", "a/b/COPYING.txt"),
        4: ("MIT", "inherited", "a/LICENSE"), 5: ("GPL-3.0", "header", "a/b/own.c"),
        6: (None, "none", None), 7: (None, "none", None), 8: (None, "none", None),
        9: ("MIT", "inherited", "a/LICENSE")}
    assert licences.scan(frame.where("false")).count() == 0
    assert licences.scan(odd.docs(spark)).count() == len(odd.rows())


DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY ARISING FROM THE SOFTWARE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_TAIL = """
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""


def stated(spark, texts):
    """Own licence, score and all licences of each text as a file of its own folder."""
    frame = spark.createDataFrame([(i, f"{i}/x.c", t) for i, t in enumerate(texts)],
                                  "doc_id long, path string, text string")
    rows = {r.doc_id: (r.licence, r.score, r.licences) for r in licences.scan(frame).collect()}
    return [rows[i] for i in range(len(texts))]


def test_every_template_states_its_own_licence(spark):
    every = licences.TEMPLATES + licences.STANDARD
    for (name, body), found in zip(every, stated(spark, [body for _, body in every])):
        assert (found[0], found[1]) == (name, 1.0), body


def test_standard_texts_state_their_licence(spark):
    text = {name: [b for n, b in licences.STANDARD if n == name] for name in ("MIT", "BSD-3-Clause")}
    mit = "\n\n".join(["MIT License", "Copyright (c) 2020 Some One", *text["MIT"], DISCLAIMER])
    bsd = ("Copyright (c) 2020, Some One\nAll rights reserved.\n\nRedistribution and use in source and "
           "binary forms, with or without\nmodification, are permitted provided that the following "
           "conditions are met:\n" + BSD_TAIL + "\n" + text["BSD-3-Clause"][-1] + "\n\n" + DISCLAIMER)
    header = "".join(f" * {line}\n" for line in bsd.split("\n"))
    texts = [mit, bsd, "/*\n" + header + " */\nint main(void) { return 0; }\n" * 50,
             mit.replace("\n", " "), mit.replace("\n", "\r\n")]
    want = ["MIT", "BSD-3-Clause", "BSD-3-Clause", "MIT", "MIT"]
    assert [f[0] for f in stated(spark, texts)] == want


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0", "CC0-1.0"])
def test_installed_texts_state_their_licence(spark, name):
    path = Path("/usr/share/common-licenses", name)
    if not path.exists():
        pytest.skip("no installed licence texts")
    assert stated(spark, [path.read_text()])[0][0] in (name, f"{name}.0")


def test_other_lines_do_not_hide_a_notice(spark):
    notice, prose = "Licensed under the Apache License, Version 2.0.", "words of plain prose here " * 8
    texts = [f"{notice}\nHe lost his driving license, and no warranty or copyright helped.",
             f"{notice} {prose}", f"{prose.strip()}. {notice} {prose}", prose,
             f"{notice}\n\n{prose}\nReleased under the MIT License.\nAll rights reserved."]
    found = stated(spark, texts)
    assert [f[0] for f in found[:4]] == ["Apache-2.0"] * 3 + [None]
    assert [f[1] for f in found[:2]] == [1.0, 1.0]
    assert found[4][0] in ("Apache-2.0", "MIT")
    assert found[4][2] == ["Apache-2.0", "LicenseRef-proprietary", "MIT"]


def test_single_words_are_no_notice(spark):
    texts = ["Mit.\nSie kam mit ihm. Mit!", "June 1991", "Mozilla 2", "in 29 June 2007", "Reserved."]
    assert stated(spark, texts) == [(None, None, None)] * len(texts)


def test_blocks_without_anchors_are_below_the_limit(spark):
    every = licences.TEMPLATES + licences.STANDARD
    terms = set(licences.anchors())
    bodies = [" ".join(t for t in re.findall("[a-z0-9]+", body.lower())
                       if t not in terms and not re.search(licences.CUE, t)) for _, body in every]
    rows = spark.createDataFrame([(b, b) for b in set(bodies) if b], "notice string, body string")
    assert licences.match(rows).count() == 0


# Rows and pipeline

def test_one_row_each(spark):
    frame = odd.docs(spark)
    chosen = frame.where("doc_id IS NULL OR doc_id = 3").select("doc_id", raw_digest(F.col("text")).alias("digest"))
    kept = one_row_each(frame, chosen)
    assert kept.columns == frame.columns
    assert sorted(str(r.text) for r in kept.collect()) == sorted(
        {str(t) if t else "None" for i, t, *_ in odd.rows() if i in (None, 3)})


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.keep_quality(spark, docs, SF)
    kept = good.toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    known = kept[kept.doc_id.isin(labels.index)]
    assert good.columns == docs.columns and 0 < len(kept) < docs.count()
    assert labels[known.doc_id].mean() > 0.95 and len(known) > 0.95 * labels.sum()
    single = corpus_pipeline.drop_copies(spark, good, SF)
    held = single.toPandas()
    assert single.columns == docs.columns
    assert sorted(map(normal, held.text)) == sorted(set(map(normal, kept.text)))
    near = corpus_pipeline.drop_near_copies(spark, single, SF)
    left = near.toPandas()
    want = {c for _, _, c in plain_components(list(zip(held.doc_id, held.text)))}
    assert near.columns == docs.columns and set(left.doc_id) == want and len(left) == len(want)
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) == want and packed.length.max() <= 2048


def test_pipeline_stages_on_odd_rows(spark, monkeypatch):
    frame = odd.docs(spark)
    own = lambda df: sorted(map(str, df.select("doc_id", "text", *odd.CLASHES).collect()))
    monkeypatch.setattr(corpus_pipeline, "KEEP_FROM", -1.0)
    good = corpus_pipeline.keep_quality(spark, frame, SF)
    assert good.columns == frame.columns and good.dtypes == frame.dtypes and own(good) == own(frame)
    single = corpus_pipeline.drop_copies(spark, frame, SF)
    assert single.columns == frame.columns and single.count() == len({normal(t) for _, t, *_ in odd.rows()})
    assert set(own(single)) <= set(own(frame))
    near = corpus_pipeline.drop_near_copies(spark, frame, SF)
    rows = {(r.doc_id, r.text or "") for r in near.collect()}
    wanted = [r for r in odd.rows() if r[0] is not None and plain_shingles(r[1])]
    components_ = {c for _, _, c in plain_components([r[:2] for r in wanted])}
    assert near.columns == frame.columns and set(own(near)) <= set(own(frame))
    assert components_ <= {i for i, _ in rows}
    assert {i for i, t in rows if i is not None and plain_shingles(t)} == components_
    packed = corpus_pipeline.pack(spark, frame, SF).toPandas()
    assert len(packed[packed.piece == 0]) == len(odd.rows())
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, odd.none(spark), SF)
        assert left.count() == 0


def test_files_without_a_notice_are_dealt_evenly(spark):
    files = spark.createDataFrame([(i, f"d/{i}.txt", "no such thing") for i in range(300)] + [
        (900, "d/LICENSE", "Licensed under the Apache License, Version 2.0.")], "doc_id long, path string, text string")
    found = licences.scan(files)
    assert "spread" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.found_in: r.n for r in found.groupBy("found_in").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "inherited": 300, "file": 1}


def plain_blocks_score(block, templates):
    """Cosine of a block to each template: counts times whole-numbered idf of the templates."""
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    bodies = [(name, words(body)) for name, body in templates]
    count = len(bodies)
    weight = lambda term: round(1000 * (np.log((1 + count) / (1.0 + sum(term in set(b) for _, b in bodies))) + 1))
    vector = lambda ws: {t: ws.count(t) * weight(t) for t in set(ws)}
    own, out = vector(words(block)), {}
    for name, body in bodies:
        other = vector(body)
        dot = sum(v * other.get(t, 0) for t, v in own.items())
        norm = np.sqrt(float(sum(v * v for v in own.values()))) * np.sqrt(float(sum(v * v for v in other.values())))
        out[name] = max(out.get(name, 0.0), round(dot / norm, 6) if norm else 0.0)
    return out


def test_notices_below_cosine_one(spark):
    every = licences.TEMPLATES + licences.STANDARD
    draw, texts = random.Random(8), []
    for name, body in every:
        words = body.split()
        for share in (0.1, 0.25):
            texts.append(" ".join(w for w in words if draw.random() > share) + " and of this work too")
    rows = spark.createDataFrame([(t, t) for t in dict.fromkeys(texts)], "notice string, body string")
    found = {r.notice: (r.licence, r.score) for r in licences.match(rows).collect()}
    below = best_of_all = 0  # a template counts only with enough of its own terms in the block
    for t in dict.fromkeys(texts):
        scores = plain_blocks_score(t, every)
        best = max(scores.values())
        if t in found:
            licence, score = found[t]
            assert licences.LEAST <= score <= best + 2e-6
            below += score < 1
            best_of_all += score == pytest.approx(scores[licence], abs=2e-6)
        else:
            assert best < 0.95
    assert below > 10 and best_of_all > 0.9 * len(found)
