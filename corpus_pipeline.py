"""From raw documents to packed training sequences, in four stages.

Each stage takes the documents its predecessor kept; all but the last return the columns of
``documents``, further ones included whatever their names. Between stages the rows are written to the
shared folder and read again. A null text counts as an empty one in every stage; a null doc_id comes
after all others. An empty table stays empty.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm import cuckoo, jaccard, packing, quality
from tidewright.llm.common import table
from tidewright.session import written

KEEP_FROM = 0.3  # least quality score
MOST_PIECES = 150_000  # words whose ids a worker holds beside what the stages before left in its memory

#: Scores, digests of exact sets and the tokenizer have no equal in SQL.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is ``KEEP_FROM`` or more.

    Empty and very long texts are scored like all others, repeated rows alike; a column of the
    documents that is named score itself stays as it is.
    """
    own = {n: f"document_{n}" for n in docs.columns if n.lower() == "score"}
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = quality.score(docs.withColumnsRenamed(own), model).where(F.col("score") >= KEEP_FROM)
    return kept.select(*[F.col(f"`{own.get(n, n)}`").alias(n) for n in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text but for white space: the longest, then the
    smallest doc_id, of rows that agree in both any one."""
    return cuckoo.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near duplicates.

    Texts without words are near to nothing and stay, but of rows equal in doc_id and text one.
    """
    return jaccard.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids and the sequences they are packed into; an empty text is its end
    id alone, every row is packed."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), most_pieces=MOST_PIECES)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies),
          ("near_duplicates", drop_near_copies), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
