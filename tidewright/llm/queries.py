"""The registered queries of this package and, where SQL can say it, the SQL they equal."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bytebpe, crosstokens, cuckoo, extract, filteraudit, fingerprint, jaccard, licences, linededup,
               packing, quality, repair, sharding)
from .common import table


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a file of a tree source/language/thousand; one that is mostly notice is
    a licence file of one of these three levels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    level = F.array("source", "lang", F.expr("cast(doc_id div 1000 as string)"))
    notice = F.coalesce(F.char_length(licences.notice(F.col("text"))), F.lit(0))
    is_licence = notice * 8 >= F.char_length(F.coalesce("text", F.lit("")))
    is_licence = is_licence & (notice > 0)
    path = F.when(is_licence, F.concat(
        F.array_join(F.slice(level, 1, (F.col("doc_id") % 3 + 1).cast("int")), "/"),
        F.lit("/LICENSE-"), F.col("doc_id").cast("string"))).otherwise(
        F.concat(F.array_join(level, "/"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return licences.scan(docs.select("doc_id", "text", path.alias("path"))).drop("licences")


def op2_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repair.round_trip(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"))
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]', '', 'g')) AS h
           FROM documents),
     w AS (SELECT doc_id, h, count(*) OVER (PARTITION BY h) AS group_size,
                  first_value(doc_id) OVER o AS keep_id, row_number() OVER o = 1 AS kept
           FROM d WINDOW o AS (PARTITION BY h ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, kept, h AS text_sha256 FROM w"""


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.with_next(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256)
                        .alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bytebpe.decode(bytebpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                        "sequence_id", "offset")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffle(table(spark, sf_dir, "documents"), 40)
    data = F.coalesce("text", F.lit("")).cast("binary")
    return rows.select("doc_id", (F.octet_length(data) + 16).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = linededup.with_bitmaps(docs)
    text = linededup.kept(F.col("document.text"), F.col("words"))
    lines = F.size(F.split(F.coalesce("document.text", F.lit("")), "\n", -1)).cast("long")
    return rows.select("document.doc_id", lines.alias("n_lines"), "n_dropped",
                       F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
     k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     m AS (SELECT key, min(doc_id) AS holder FROM k WHERE length(key) >= 10 GROUP BY key),
     j AS (SELECT k.*, holder IS NOT NULL AND holder <> doc_id AS goes FROM k LEFT JOIN m USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstokens.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(filteraudit.failures(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(
               string_split_regex(coalesce(text, ''), '[ 	
]+'), lambda x: x <> '') AS ws FROM documents),
     first AS (SELECT t, min(doc_id) AS first_id FROM w GROUP BY t),
     d AS (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
                  concat(CASE WHEN len(ws) < 50 THEN 'A' END,
                         CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' END,
                         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
                         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                         CASE WHEN doc_id > first_id THEN 'E' END) AS fails
           FROM w JOIN first USING (t) LEFT JOIN labels USING (doc_id)),
     c AS (SELECT part, good, toxic, fails, count(*) AS n FROM d GROUP BY ALL),
     f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS own,
                  filter_order[1:step - 1] AS before FROM o, range(1, 6) AS r(step)),
     r AS (SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS hit,
                  len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> ''
                      AND before <> '' AS gone, fails = own AS only_own FROM c, s),
     g AS (SELECT part, filter_order, step, own,
                  CAST(coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
                  CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed,
                  CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant,
                  CAST(coalesce(sum(n) FILTER (only_own), 0) AS BIGINT) AS unique_fails,
                  CAST(coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS BIGINT) AS good_lost,
                  CAST(coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0) AS BIGINT) AS toxic_lost
           FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g"""


OP1_SQL = rf"""
WITH t AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{name}', '{text}')" for i, (name, text)
                                            in enumerate(licences.TEMPLATES))}) AS x(k, licence, body)),
     tw AS (SELECT k, licence, unnest(string_split_regex(lower(body), '[^a-z0-9]+')) AS term FROM t),
     tf AS (SELECT k, licence, term, count(*) AS n FROM tw WHERE term <> '' GROUP BY ALL),
     idf AS (SELECT term, CAST(round(1000 * (ln((1 + (SELECT count(*) FROM t)) / (1.0 + count(*))) + 1))
                               AS BIGINT) AS w FROM tf GROUP BY term),
     tv AS (SELECT k, licence, term, n * w AS v FROM tf JOIN idf USING (term)),
     tn AS (SELECT k, sum(v * v) AS norm FROM tv GROUP BY k),
     d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text, array_to_string(list_filter(
               string_split(coalesce(text, ''), chr(10)),
               lambda x: regexp_matches(x, '{licences.CUE}')), chr(10)) AS notice FROM documents),
     f AS (SELECT doc_id, nullif(notice, '') AS notice, CASE
               WHEN notice <> '' AND length(notice) * 8 >= length(text)
               THEN concat_ws('/', source, CASE WHEN doc_id % 3 >= 1 THEN lang END,
                              CASE WHEN doc_id % 3 = 2 THEN CAST(doc_id // 1000 AS VARCHAR) END,
                              'LICENSE-' || doc_id)
               ELSE concat_ws('/', source, lang, doc_id // 1000, doc_id || '.txt') END AS path FROM d),
     n AS (SELECT DISTINCT notice FROM f WHERE notice IS NOT NULL),
     nw AS (SELECT notice, unnest(string_split_regex(lower(notice), '[^a-z0-9]+')) AS term FROM n),
     nv AS (SELECT notice, term, count(*) * coalesce(any_value(w), (SELECT CAST(round(1000 * (ln(
                1.0 + (SELECT count(*) FROM t)) + 1)) AS BIGINT))) AS v
            FROM nw LEFT JOIN idf USING (term) WHERE term <> '' GROUP BY ALL),
     nn AS (SELECT notice, sum(v * v) AS norm FROM nv GROUP BY notice),
     c AS (SELECT nv.notice, k, licence, sum(nv.v * tv.v) AS dot
           FROM nv JOIN tv USING (term) GROUP BY ALL),
     s AS (SELECT c.notice, licence, round(CAST(dot AS DOUBLE) / (sqrt(CAST(nn.norm AS DOUBLE))
                  * sqrt(CAST(tn.norm AS DOUBLE))), 6) AS score
           FROM c JOIN nn USING (notice) JOIN tn USING (k)),
     m AS (SELECT notice, arg_max(licence, (score, licence)) AS licence, max(score) AS score
           FROM s GROUP BY notice HAVING max(score) >= {licences.LEAST}),
     own AS (SELECT f.doc_id, f.path, m.licence, m.score,
                    regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS dir,
                    f.path LIKE '%/LICENSE-%' AS is_file FROM f LEFT JOIN m USING (notice)),
     dl AS (SELECT dir, arg_max(licence, (score, path)) AS licence, max(score) AS score,
                   arg_max(path, (score, path)) AS path
            FROM own WHERE is_file AND licence IS NOT NULL GROUP BY dir),
     up AS (SELECT own.doc_id, dl.licence, dl.path, row_number() OVER (
                PARTITION BY own.doc_id ORDER BY length(dl.dir) DESC) AS r
            FROM own JOIN dl ON own.dir = dl.dir OR starts_with(own.dir, dl.dir || '/')
            WHERE own.licence IS NULL)
SELECT own.doc_id, own.path, coalesce(own.licence, up.licence) AS licence, own.score,
       CASE WHEN own.licence IS NULL AND up.licence IS NULL THEN 'none'
            WHEN own.licence IS NULL THEN 'inherited'
            WHEN is_file THEN 'file' ELSE 'header' END AS found_in,
       CASE WHEN own.licence IS NULL THEN up.path ELSE own.path END AS from_path
FROM own LEFT JOIN up ON own.doc_id = up.doc_id AND up.r = 1"""

OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[ \t\n\v\f\r]+'), lambda x: x <> '') AS ws FROM documents),
     s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5
                  THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3),
                  lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
     n AS (SELECT doc_id, len(sh) AS n FROM s),
     e AS (SELECT doc_id, unnest(sh) AS g FROM s),
     r AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
     x AS (SELECT e.* FROM e JOIN r USING (g)),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b
           ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
           WHERE 100 * i >= 75 * (na.n + nb.n - i)),
     c AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT l.a, c.r FROM c JOIN l ON c.doc_id = l.b)
SELECT n.doc_id, n.n AS n_shingles, min(c.r) AS component_id
FROM n JOIN c USING (doc_id) GROUP BY ALL"""

QUERIES = {f.__name__: f for f in (
    op1_license_scans, op2_repair_files, op3_exact_dedup, op4_quality_classifier, op5_main_text,
    op6_fingerprints, op7_byte_bpe, op8_jaccard_join, op9_best_fit_packing, op10_sharding,
    op11_line_dedup, op12_token_links, op13_filter_audit)}
SQL = {"op1_license_scans": OP1_SQL, "op3_exact_dedup": OP3_SQL,
       "op8_jaccard_join": OP8_SQL, "op11_line_dedup": OP11_SQL, "op13_filter_audit": OP13_SQL}
