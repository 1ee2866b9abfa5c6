"""Every query against its SQL on the smallest tables."""
import hashlib
import unicodedata

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    left = entry.queries()[name](spark, SF).toPandas()
    right = duck.execute(entry.oracle_sql()[name]).df()
    assert difference(left, right) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and rows.columns == ["species", "label", "n", "pct"]


def test_documents_in_normal_form(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in entry.queries()["nfkc_documents"](spark, SF).collect()}
    assert len(found) == len(texts)
    for row in texts:
        wanted = unicodedata.normalize("NFKC", row.text.strip())
        assert found[row.doc_id].n_chars == len(wanted)
        assert found[row.doc_id].digest == hashlib.md5(wanted.encode()).hexdigest()
