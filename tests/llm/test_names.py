"""Columns of a user's table that are called like an operator's own keep their values."""

import pytest

from shelfline.llm.private_data import replace_entities
from shelfline.llm.quality import classify
from shelfline.llm.secrets import mask_secrets

NAMES = ("_row", "_found", "_spans", "_odds", "_host", "_path", "_n", "_s", "_k", "_bad", "_others", "_host_rate", "_by", "n_entities", "col1", "a.b")
TEXTS = ("Dr. Anna Keller, anna@keller.org, +49 30 1234567", "plain words only", 'password = "aV9xk2LmQ0zz81"', None, "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", f"s{k % 2}", *range(7, 7 + len(NAMES))) for k, t in enumerate(TEXTS * 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in NAMES))


def kept(docs, out, same_rows=True):
    names = [f"`{c}`" for c in docs.columns if c != "text"]
    assert out.columns[: len(docs.columns)] == docs.columns
    got, had = ({tuple(r) for r in d.select(*names).collect()} for d in (out, docs))
    assert got <= had and (got == had or not same_rows)
    return {r.doc_id: r.text for r in out.collect()}


def test_secrets(docs):
    texts = kept(docs, mask_secrets(docs))
    assert "aV9xk2LmQ0zz81" not in texts[2] and texts[1] == TEXTS[1] and texts[3] is None


def test_private_data(docs):
    out = replace_entities(docs, b"key")
    texts = kept(docs, out)
    assert "anna@keller.org" not in texts[0] and texts[1] == TEXTS[1]
    assert {r.doc_id for r in out.where("n_entities_found > 0").collect()} >= {0, 5}


def test_quality(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    kept(docs, classify(docs, labels, whole=True), same_rows=False)
