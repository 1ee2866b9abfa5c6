"""Small tables with everything that can go wrong: nulls, empty, long and repeated texts, ties,
columns with names that the operators use themselves."""
import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "shard", "slot", "row", "digest", "ids", "node", "n", "label", "kept", "run",
           "part", "stats", "path", "grp", "prefix", "copies", "first", "second", "place")


def rows():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeéß") for _ in range(draw.randrange(1, 9)))
    prose = [" ".join(word() for _ in range(draw.randrange(1, 60))) for _ in range(30)]
    texts = [None, "", " \n\t ", "a", "one two three four", *prose, prose[0], prose[0] + " ", prose[1],
             "x" * 200_000, " ".join(word() for _ in range(20_000)),
             prose[5] + "\n" + "Licensed under the Apache License, Version 2.0.", "　  ü\x1c漢字 Ⅷ"]
    out = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return out + [(None, prose[2], None, None, None), (None, None, None, None, None), out[3], out[3],
                  out[1], (3, prose[7], "en", "src0", 0)]


def docs(spark):
    """The rows with further columns of clashing names."""
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def none(spark):
    return docs(spark).where("false")
