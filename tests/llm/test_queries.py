"""Every registered query over the smallest tables; those with SQL equal it."""

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from shelfline.llm.queries import ORACLES, QUERIES
from tests.llm import cases
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = connect(SF_DIR)
    for table in ("documents", "benchmark", "embeddings"):
        con.sql(f"create or replace view {table} as select * from '{SF_DIR}/{table}.parquet'")
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], con) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_for_every_document(spark, name):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    got = QUERIES[name](spark, SF_DIR).select("doc_id")
    assert got.distinct().count() == rows and (name == "op2_packing" or got.count() == rows)


def test_pipeline_stages(spark, tmp_path):
    """Every stage keeps the columns and takes away what it finds, and only that."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left.write.parquet(str(tmp_path / f"before-{name}"))
        before = spark.read.parquet(str(tmp_path / f"before-{name}"))
        left = stage(spark, before, SF_DIR)
        assert left.columns == corpus_pipeline.COLUMNS
        kept, had = {r[0] for r in left.select("doc_id").collect()}, {r[0] for r in before.select("doc_id").collect()}
        assert kept <= had and (kept == had) == (name == "secrets")
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == kept
    assert set(entry_point.queries()) >= {"pipeline", *QUERIES}


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "a b c d e"), (None, None)], "item_id long, text string")
    folder = cases.saved(spark, tmp_path, labels=labels, benchmark=items)
    for docs in (cases.documents(spark, 1, 40), cases.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
            docs.count()
