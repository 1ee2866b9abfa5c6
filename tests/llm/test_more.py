"""Line dedup, token links and the filter audit against plain versions."""
import hashlib
import json
import random
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers as public
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import odd
from compare import connect, difference
from tidewright.llm import crosstokens, filteraudit, jaccard, linededup, queries

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


# Line dedup

def plain_lines(rows):
    """(doc_id, text) rows to (doc_id, lines, dropped, text left)."""
    def key(line):
        return line.strip(BLANKS).translate({c: c + 32 for c in range(65, 91)})
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, i), i, key=order)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def line_rows():
    draw = random.Random(5)
    common = ["  A Common Line of all\t", "a common line of ALL", "\x1ca common line of all", "short", "",
              "nine char", "ten chars!", "ÉCOLE DES BEAUX", "éCOLE des beaux", "école des beaux", "ÀÉ　line here　"]
    rows = [(i, "\n".join(draw.choice(common) if draw.random() < .6 else f"own line number {draw.randrange(300)}"
                          for _ in range(draw.randrange(0, 200)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n"), (73, "\n" * 5000 + "a common line of all"), (None, rows[3][1]),
             (None, "own line number 1\nof a null one only"), rows[4], (5, rows[6][1]), (-4, "ten chars!\n" * 3)]
    return rows


def test_lines_as_plain(spark):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = linededup.with_bitmaps(docs).select("document.*", "n_dropped", linededup.kept(
        F.col("document.text"), F.col("words")).alias("left")).collect()
    assert sorted(map(str, ((r.doc_id, r.n_dropped, r.left) for r in found))) == sorted(
        map(str, ((i, n, t) for i, _, n, t in plain_lines(rows))))


def test_common_lines_are_split_off(spark, monkeypatch):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(linededup, "FEW", 20)
    lines = linededup.keyed_lines(docs)
    assert 0 < linededup.common_keys(lines, 20, 16).count() <= lines.count() // 20
    left = linededup.drop_lines(docs)
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(
        map(str, ((i, t if i != 70 else "") for i, _, _, t in plain_lines(rows))))


def test_bitmaps_are_compressed(spark):
    docs = spark.createDataFrame([(1, "the very same line"), (2, "x\n" * 1000 + "the very same line\nlast")],
                                 "doc_id long, text string")
    found = linededup.keep_bitmaps(docs).collect()
    assert [(r.n_dropped, [(w.word, ~w.keep) for w in r.bitmap]) for r in found] == [(1, [(15, 1 << 40)])]


def test_lines_of_odd_tables(spark):
    left = linededup.drop_lines(odd.docs(spark))
    assert left.columns == odd.docs(spark).columns and left.count() == len(odd.rows())
    wanted = plain_lines([(i, t) for i, t, *_ in odd.rows()])
    assert sorted(map(str, map(tuple, left.select("doc_id", "text").collect()))) == sorted(
        map(str, ((i, t) for i, _, _, t in wanted)))
    assert linededup.with_bitmaps(odd.none(spark)).count() == 0


# Token links

def letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + extra)], extra = b, extra + 1
    return out


def plain_links(texts):
    """What align returns for each text, without doc_id."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table, docs = letters(), []
    for t in texts:
        t = t or ""
        x = a.encode(" " + t, add_special_tokens=False) if t else None
        x = list(zip(x.ids, x.tokens)) if t else []
        y = [(i, b.id_to_piece(i)) for i in (b.encode(t) if t else [])]
        bx = [bytes(table[c] for c in p) for _, p in x]
        by = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in y]
        groups = []
        if t and b"".join(bx) == b"".join(by) == (" " + t).encode():
            i = j = at = bt = 0
            ga, gb = [], []
            while i < len(x) or j < len(y):
                if at <= bt:
                    ga.append(x[i][0]); at += len(bx[i]); i += 1  # noqa: E702
                else:
                    gb.append(y[j][0]); bt += len(by[j]); j += 1  # noqa: E702
                if at == bt:
                    groups.append((ga, gb))
                    ga, gb = [], []
        docs.append(groups)
    linked = [Counter((p, q) for ga, gb in g for p in ga for q in gb) for g in docs]
    counts = Counter(pair for d in linked for pair in d)
    top = {}
    for (p, _), n in counts.items():
        top[p] = max(top.get(p, 0), n)
    out = []
    for groups, d in zip(docs, linked):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(d.values()),
                    sum(n for pair, n in d.items() if counts[pair] == top[pair[0]]),
                    sum(n * counts[pair] for pair, n in d.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


ODD_TEXTS = [None, "", " ", "  two  blanks ", "a", "▁low line", "<|endoftext|> and <s> </s> <unk> <0x41>", "ﬁne ½ ①",
             "日本語のテキスト、漢字。", "\x00\x01\x1c ctrl\x85", "naïve café – “quoted” … it's we'll", "emoji 😀👍🏽 ‍ x",
             "tab\tand\nnew\r\nline   \n\n", "é" * 300, "x" * 30_000, "word " * 3000, "ab1234567890.,;:!?" * 40]


def test_links_as_plain(spark):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")
                         .limit(60).collect()] + ODD_TEXTS[4:8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    wanted = {i: w for i, w in enumerate(plain_links(texts))}
    for size in (2000, 1 << 24):  # many runs, one run a task
        found = {r.doc_id: tuple(r)[1:] for r in crosstokens.align(docs, A, B, size).collect()}
        assert found == wanted


def test_lanes_give_the_same_cuts():
    a, b = crosstokens.sides(open(A, "rb").read(), open(B, "rb").read())
    texts = [t for t in ODD_TEXTS if t] + ["", "over the hills and far away " * 50]
    whole, short = (crosstokens.Aligned(texts, a, b, lane) for lane in (1 << 30, 7))
    assert (whole.last_a == short.last_a).all() and (whole.last_b == short.last_b).all()
    assert (np.cumsum(a.length[whole.a])[whole.last_a] == np.cumsum(b.length[whole.b])[whole.last_b]).all()


def test_quick_library_is_taken_for_plain_texts_only():
    a = crosstokens.sides(open(A, "rb").read(), open(B, "rb").read())[0]
    assert a.quick and a.plain(" plain text, naïve") and not a.plain("no break blank")
    rules = json.loads(open(A).read())
    rules["model"]["merges"].reverse()
    assert crosstokens.ByteSide(json.dumps(rules).encode()).quick is None


def test_large_groups_are_counted_in_blocks(monkeypatch):
    monkeypatch.setattr(crosstokens, "BLOCK", 50)
    draw = np.random.default_rng(1)
    sizes = [(1, 1), (90, 70), (3, 2), (1, 4), (100, 60), (2, 2)]
    a, b = (draw.integers(0, 30, sum(s[k] for s in sizes)) for k in (0, 1))
    last_a, last_b = np.cumsum([s[0] for s in sizes]) - 1, np.cumsum([s[1] for s in sizes]) - 1
    at_a = np.array([0, last_a[2] + 1, len(a)])
    groups = crosstokens._groups(last_a, last_b, at_a)
    found = {(int(o), int(p)): int(n) for o, p, n in zip(*crosstokens.links(a, b, groups, 30))}
    wanted = Counter()
    for k, (x, y) in enumerate(sizes):
        fa, fb = last_a[k] + 1 - x, last_b[k] + 1 - y
        wanted.update((int(k > 2), int(p * 30 + q)) for p in a[fa:fa + x] for q in b[fb:fb + y])
    assert found == dict(wanted)


def test_links_of_odd_tables(spark):
    found = crosstokens.align(odd.docs(spark), A, B)
    wanted = plain_links([t for _, t, *_ in odd.rows()])
    got = sorted(map(str, (tuple(r) for r in found.collect())))
    assert got == sorted(map(str, ((i, *w) for (i, *_), w in zip(odd.rows(), wanted))))
    assert crosstokens.align(odd.none(spark), A, B).count() == 0


# Filter audit

def plain_audit(rows, labels):
    def words(t):
        for c in BLANKS:
            t = t.replace(c, " ")
        return [w for w in t.split(" ") if w]
    first = {}
    for i, t, _ in rows:
        t = t or ""
        if i is not None:
            first[t] = min(first.get(t, i), i)
    out = Counter()
    parts = {p or "" for _, _, p in rows}
    for i, t, p in rows:
        t, p = t or "", p or ""
        w = words(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": t in first and (i is None or first[t] < i)}
        good, toxic = (i is not None and any(l[0] == i and l[k] == 1 for l in labels) for k in (1, 2))
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (p, "".join(order), step)
                out[key, "kept"] += not gone and not fails[f]
                out[key, "removed"] += not gone and fails[f]
                out[key, "redundant"] += gone and fails[f]
                out[key, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                out[key, "good_lost"] += good and not gone and fails[f]
                out[key, "toxic_lost"] += toxic and not gone and fails[f]
                out[(p, f), "shapley"] += not gone and fails[f]
                gone = gone or fails[f]
    return {(p, "".join(o), s): tuple(out[(p, "".join(o), s), c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")) + (out[(p, o[s - 1]), "shapley"],)
        for p in parts for o in permutations("ABCDE") for s in range(1, 6)}


def test_audit_as_plain(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["a", "Bee", "sea$", "dOG", "eel", "ÉÀ", "fox", "G", "hen|"][:draw.randrange(2, 10)]
                                  + [f"w{draw.randrange(999)}"] * draw.randrange(9)) for _ in range(draw.randrange(90)))
             for _ in range(60)]
    texts += [None, "", " \n", "A", "\x1cone word\x1c", "a\tb\nc\x0bd\x0ce\rf " * 9]
    rows = [(draw.choice([None, *range(80)]), draw.choice(texts), draw.choice([None, "", "x", "y"]))
            for _ in range(150)]
    rows += [(7, texts[3], "x"), (7, texts[3], "y"), (7, texts[3], "x"), (None, texts[3], "x"), (None, "alone", "x")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 80, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = filteraudit.audit(filteraudit.failures(docs, spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"))).collect()
    wanted = plain_audit(rows, labels)
    assert len(found) == len(wanted)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == wanted


def test_lattice_counts_paths():
    for k in (1, 3, 5):
        edges = filteraudit.lattice(k)
        assert len(edges) == k << (k - 1)
        taken = Counter()
        for order in permutations(range(k)):
            state = 0
            for f in order:
                taken[state, f] += 1
                state |= 1 << f
        assert {(s, f): w for s, f, w in edges} == taken


def test_audit_of_odd_tables(spark):
    labels = spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")
    frame = odd.docs(spark).withColumn("failed", F.lit(1)).withColumn("good", F.lit(True))
    found = filteraudit.audit(filteraudit.failures(frame, labels)).collect()
    wanted = plain_audit([(r[0], r[1], r[3]) for r in odd.rows()], [(3, 1, 1)])
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == wanted
    empty = filteraudit.audit(filteraudit.failures(odd.none(spark), labels))
    assert empty.count() == 0


def test_contract_columns(spark):
    wanted = {"op11_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
              "op12_token_links": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                   "groups_sha256"],
              "op13_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                    "good_lost", "toxic_lost", "shapley"]}
    for name, columns in wanted.items():
        frame = queries.QUERIES[name](spark, SF)
        kinds = dict(frame.dtypes)
        assert frame.columns == columns
        assert all(kinds[c] == "bigint" for c in columns if c not in (
            "kept_sha256", "groups_sha256", "part", "filter_order", "step")) and kinds.get("step", "int") == "int"
        if name in queries.SQL:
            assert difference(frame.toPandas(), connect(SF).execute(queries.SQL[name]).df()) == ""


def test_encoded_ids_and_ends(spark):
    texts = [t for t in ODD_TEXTS if t][:12]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, b = crosstokens.sides(open(A, "rb").read(), open(B, "rb").read())
    for row in crosstokens.encode(docs, A, B).collect():
        here = crosstokens.Aligned([texts[row.doc_id]], a, b)
        assert np.frombuffer(row.a, a.kind).tolist() == here.a.tolist()
        assert np.frombuffer(row.b, b.kind).tolist() == here.b.tolist()
        for bits, last, ids in ((row.a_ends, here.last_a, here.a), (row.b_ends, here.last_b, here.b)):
            marks = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(ids), bitorder="little")
            assert np.flatnonzero(marks).tolist() == last.tolist()


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 1 << 40, 5], np.int64)
    data, at = crosstokens.packed(values)
    assert crosstokens.unpacked(data).tolist() == values.tolist() and len(data) == at[-1] == 1 + 1 + 1 + 2 + 2 + 3 + 6 + 1
    assert len(crosstokens.unpacked(np.empty(0, np.uint8))) == 0


# Signatures of the Jaccard join

def test_signatures_never_lose_a_link():
    draw = np.random.default_rng(3)
    told = 0
    for _ in range(600):
        size = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 1 << 63, size, np.uint64))
        keep = a[draw.random(len(a)) < draw.uniform(.6, 1)]
        b = np.unique(np.concatenate([keep, draw.integers(0, 1 << 63, int(draw.integers(0, 1 + size // 3)), np.uint64)]))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        links = 100 * common >= 75 * (len(a) + len(b) - common)
        may = jaccard._may_link(jaccard._signature(a), jaccard._signature(b), len(a), len(b))
        assert may or not links
        told += not may
    other = [np.unique(draw.integers(0, 1 << 63, 500, np.uint64)) for _ in range(2)]
    assert told > 50 and not jaccard._may_link(*map(jaccard._signature, other), *map(len, other))
