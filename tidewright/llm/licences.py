"""License scans: notices against templates, then inheritance down the directories (operator 1).

A file's text is cut into blocks: paragraphs, runs of comment lines, lines and sentences. Blocks and
templates are sparse TF-IDF vectors; a block states the licence of the template with the largest
cosine, if that is at least ``LEAST``; without a word of ``CUE`` it must share ``FEWEST`` terms with
the template, too. A file has the licence of its best block, where reserved
rights count after every licence, and ``licences`` lists all that its blocks state. Weights are
whole numbers (a thousandth of the inverse document frequency over the templates), so sums do not
depend on their order. A file without a licence of its own inherits that of the nearest directory
above it that has a licence file.

Only DataFrame functions are used. Blocks that cannot reach ``least`` are left out before the
vectors are made: by Cauchy and Schwarz a block without a cue word and without any of a template's
``anchors`` is below it or shares too few terms.
Texts are read once: paths and remaining blocks are written to the
shared folder for the joins that follow. Equal blocks are compared once. Texts are not shuffled,
only blocks are; the terms of the templates are a fixed table and broadcast. Directories are reduced
to distinct ones before their ancestors are joined; the join back to the files has one row per
directory on the other side, so adaptive execution can split a directory with many files.

Edge cases: a null or empty text has no notice; a null path counts as a file without a name in
the root; repeated files are scanned alike and of several licence files in a directory the one
with the largest cosine, then the last path, counts; without a licence anywhere above, licence is
null and ``found_in`` is none; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

#: Words of notices; lines with one are what ``notice`` takes. Fixed pattern.
CUE = "(?i)licen[cs]e|copyright|spdx|warrant|public domain|rights reserved"
#: Names of licence files.
FILE_NAME = "(?i)^(licen[cs]e|copying|notice|unlicense)([-._].*)?$"
LEAST = 0.6
#: Distinct terms besides ``COMMON`` words that a block without a cue word shares with the template: a
#: word such as the German "Mit." is no notice.
FEWEST = 4
SCALE = 1000
#: Licences by SPDX name and how they are commonly stated. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found "
     "in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
     "rights; this work is in the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-proprietary", "All rights reserved."),
    ("LicenseRef-proprietary", "Copyright. All rights reserved. Unauthorized copying of this file "
     "is strictly prohibited. Proprietary and confidential."),
)


#: Headers, headings and paragraphs of the standard texts, beside ``TEMPLATES``. Fixed values.
STANDARD = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies "
     "or substantial portions of the Software."),
    ("BSD-3-Clause", "Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other materials "
     "provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may "
     "be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
     "ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
     "either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
     "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
     "software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means."),
)
#: Reserves rights without stating a licence: counts only in files that state none.
RESERVED = "LicenseRef-proprietary"
#: Words that prose has everywhere. Fixed values.
COMMON = frozenset(
    "a above after all an and any are as at be been but by can copy do even file following for form "
    "found free from has have how if in is it its later list may name names no not of on one or other "
    "out part person program see shall such terms that the this time to under use used was way whom "
    "with without work you your 0 1 2 3 4 19 29".split())
_COMMENT = r"[ \t]*(?:#|//|/?\*|--|;|%)"


def notice(text: Column) -> Column:
    """The lines of a text that speak of licences; null if there are none."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(CUE))
    return F.when(text.rlike(CUE), F.nullif(F.array_join(lines, "\n"), F.lit("")))


def anchors(templates=TEMPLATES + STANDARD, least: float = LEAST) -> list[str]:
    """Terms of which a text without cue words needs at least one to reach ``least`` with any of the
    templates.

    A text with none of them shares only the other terms of a template, and its cosine is at most the
    root of their share of the template's squared norm, or it shares fewer than ``FEWEST``.
    """
    bodies = [Counter(re.findall("[a-z0-9]+", body.lower())) for _, body in templates]
    having = Counter(term for body in bodies for term in body)
    chosen: set[str] = set()
    for body in bodies:
        square = {t: (n * (math.log((1 + len(bodies)) / (1 + having[t])) + 1)) ** 2
                  for t, n in body.items()}
        bound = (least * 0.99) ** 2 * sum(square.values())
        square = {t: v for t, v in square.items() if not re.search(CUE, t)}
        left, rest = sum(square.values()), len(square.keys() - COMMON)
        for term in sorted(square.keys() - COMMON, key=lambda t: (t not in chosen, -square[t], t)):
            if left < bound or rest < FEWEST:
                break
            rest -= 1
            chosen.add(term)
            left -= square[term]
    return sorted(chosen)


def blocks(text: Column, terms: list[str]) -> Column:
    """Distinct paragraphs, runs of comment lines, lines and sentences of a text that hold a cue word
    or one of ``terms``, as lower-case terms between blanks; null if there are none."""
    has = rf"{CUE.replace(' ', '[^a-z0-9]+')}|(?<![a-z0-9])(?:{'|'.join(terms) or '[^ -~]'})(?![a-z0-9])"
    body = F.regexp_replace(F.lower(text), "\r\n?", "\n")
    runs = F.regexp_replace(body, rf"(?m)^({_COMMENT}[^\n]*)\n(?!{_COMMENT})", "$1\n\n")
    runs = F.regexp_replace(runs, rf"(?m)^(?!{_COMMENT})([^\n]+)\n(?={_COMMENT})", "$1\n\n")
    gap = r"\n[^a-z0-9\n]*\n"
    cut = F.concat(*[F.filter(F.split(whole, at), lambda block: block.rlike(has)) for whole, at in (
        (body, gap), (runs, gap), (body, r"\n"), (body, r"(?<=[.!?:;])\s+"))])
    found = F.array_distinct(F.transform(
        cut, lambda block: F.trim(F.regexp_replace(block, "[^a-z0-9]+", " "))))
    return F.when(F.lower(text).rlike(has), F.when(F.size(found) > 0, found))


def _terms(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    """How often each term occurs, by ``keys``."""
    term = F.explode(F.split(F.lower(F.col(text)), "[^a-z0-9]+")).alias("term")
    return (rows.select(*keys, term).where("term <> ''").groupBy(*keys, "term")
            .agg(F.count(F.lit(1)).alias("n")))


def _idf(templates: int, having: Column) -> Column:
    return F.round(SCALE * (F.log((1 + templates) / (1 + having)) + 1)).cast("long")


def _vectors(spark, templates) -> DataFrame:
    """k, licence, term, weight, value (term count times weight) and norm of each template."""
    rows = json.dumps([{"k": k, "licence": name, "body": body}
                       for k, (name, body) in enumerate(templates)])
    table = spark.range(1).select(F.explode(F.from_json(
        F.lit(rows), "array<struct<k: int, licence: string, body: string>>")).alias("t")).select("t.*")
    terms = _terms(table, "body", "k", "licence")
    weights = terms.groupBy("term").agg(_idf(len(templates), F.count(F.lit(1))).alias("weight"))
    values = terms.join(weights, "term").withColumn("value", F.col("n") * F.col("weight"))
    norms = values.groupBy("k").agg(F.sum(F.col("value") * F.col("value")).alias("t_norm"))
    return values.join(norms, "k").select("k", "licence", "term", "weight", "value", "t_norm")


def match(notices: DataFrame, templates=TEMPLATES + STANDARD, least: float = LEAST) -> DataFrame:
    """notice, licence and score (cosine) of each row of ``notices`` (notice, a key, and its body)
    that matches a template."""
    vectors = _vectors(notices.sparkSession, templates)
    by_term = vectors.groupBy("term").agg(
        F.first("weight").alias("weight"),
        F.collect_list(F.struct("k", "licence", "value", "t_norm")).alias("templates"))
    unknown = _idf(len(templates), F.lit(0))
    terms = _terms(notices.withColumn("cued", F.col("body").rlike(CUE)), "body", "notice", "cued")
    terms = terms.join(F.broadcast(by_term), "term", "left")
    terms = terms.withColumn("own", F.col("n") * F.coalesce("weight", unknown))
    norm = F.sum(F.col("own") * F.col("own"))
    # One row per notice and template it shares a term with, and one without template for the norm.
    none = F.array(F.lit(None).cast("struct<k: int, licence: string, value: bigint, t_norm: bigint>"))
    rare = F.when(~F.col("term").isin(sorted(COMMON)), F.lit(1)).alias("rare")
    sides = terms.select("notice", "cued", rare, "own", F.explode(
        F.concat(none, F.coalesce("templates", F.filter(none, lambda t: F.lit(False))))).alias("t"))
    dots = sides.groupBy("notice", F.col("t.k").alias("k")).agg(
        F.when(F.first("t.k").isNull(), norm).alias("norm"),
        F.sum(F.col("own") * F.col("t.value")).alias("dot"),
        (F.first("cued") | (F.count("rare") >= FEWEST)).alias("stands"),
        F.first("t.licence").alias("licence"), F.first("t.t_norm").alias("t_norm"))
    found = dots.groupBy("notice").agg(
        F.max("norm").alias("norm"),
        F.collect_list(F.when(F.col("k").isNotNull() & F.col("stands"), F.struct("licence", "dot", "t_norm"))
                       ).alias("found"))  # one entry per template at most
    scores = F.transform("found", lambda f: F.struct(
        F.round(f["dot"].cast("double") / (F.sqrt(F.col("norm").cast("double"))
                                           * F.sqrt(f["t_norm"].cast("double"))), 6).alias("score"),
        f["licence"].alias("licence")))
    best = found.select("notice", F.array_max(scores).alias("best"))
    return best.where(F.col("best.score") >= least).select("notice", "best.licence", "best.score")


def scan(files: DataFrame, templates=TEMPLATES + STANDARD, least: float = LEAST) -> DataFrame:
    """For each row of ``files`` (doc_id, path, text): path, licence, score of its own best notice,
    found_in (header, file, inherited, none), from_path, the file that states it, and licences, all
    that its own text states."""
    found = files.select("doc_id", F.coalesce("path", F.lit("")).alias("path"),
                         blocks(F.col("text"), anchors(templates, least)).alias("blocks"))
    read = written(found.withColumn("key", F.sha2(F.array_join("blocks", "\n"), 256)),
                   "licence-notices")
    parts = read.where("key IS NOT NULL").select("key", "blocks").distinct()
    parts = parts.select("key", F.explode("blocks").alias("body"))
    parts = parts.withColumn("notice", F.sha2("body", 256))
    matched = match(parts.select("notice", "body").distinct(), templates, least)
    best = parts.select("key", "notice").join(matched, "notice").groupBy("key").agg(
        F.max(F.struct(F.col("licence") != RESERVED, "score", "licence")).alias("best"),
        F.array_sort(F.collect_set("licence")).alias("licences"))  # one entry per licence at most
    best = best.select("key", "best.licence", "best.score", "licences")
    # Most files state nothing and have no key; numbers, which equal no key, deal them evenly. The join
    # has one column: a second one that is constant on the other side would leave the exchange.
    spread = F.coalesce("key", F.pmod(F.hash("doc_id", "path"), F.lit(1 << 20)).cast("string"))
    own = read.drop("blocks").withColumn("spread", spread).join(
        best.withColumnRenamed("key", "spread"), "spread", "left")
    name = F.element_at(F.split("path", "/"), -1)
    own = own.select(
        "doc_id", "path", "licence", "score", "licences", name.rlike(FILE_NAME).alias("is_file"),
        F.expr("left(path, greatest(0, length(path) - length(element_at(split(path, '/'), -1)) - 1))")
        .alias("dir"))
    stated = own.where("is_file AND licence IS NOT NULL").groupBy(F.col("dir").alias("above")).agg(
        F.max(F.struct("score", "path", "licence")).alias("stated"))
    ancestors = own.select("dir").distinct().withColumn("parts", F.split("dir", "/"))
    ancestors = ancestors.select("dir", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("parts")),
        lambda n: F.array_join(F.slice("parts", 1, n), "/"))).alias("depth", "above"))
    nearest = ancestors.join(stated, "above").groupBy("dir").agg(
        F.max(F.struct("depth", "stated.licence", "stated.path")).alias("near"))
    nearest = nearest.select(F.col("dir").alias("n_dir"), F.col("near.licence").alias("n_licence"),
                             F.col("near.path").alias("n_path"))
    rows = own.join(nearest, F.col("dir") == F.col("n_dir"), "left")
    none = F.col("licence").isNull()
    return rows.select(
        "doc_id", "path", F.coalesce("licence", "n_licence").alias("licence"), "score",
        F.when(none & F.col("n_licence").isNull(), "none").when(none, "inherited")
        .when(F.col("is_file"), "file").otherwise("header").alias("found_in"),
        F.when(none, F.col("n_path")).otherwise(F.col("path")).alias("from_path"), "licences")
