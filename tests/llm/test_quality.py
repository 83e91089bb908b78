import random

from shelfline.llm.quality import classify
from tests.llm import cases


def labelled(spark, n=900):
    rnd = random.Random(5)
    words = [a + b for a in ("the", "in", "er", "on", "sta") for b in ("re", "ti", "le", "nd", "x")]
    rows, marks = [], []
    for k in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        kind = rnd.random()
        if kind < 0.12:
            w = [x.upper() + "!!" for x in w]
        elif kind < 0.24:
            w.insert(rnd.randrange(len(w)), rnd.choice(["scumx", "idiotx"]))
        rows.append((k, " ".join(w), rnd.choice(["en", "fr"]), rnd.choice(["s0", "s0", f"s{k % 9}"]), 1, 1, 1, 1, 1, 1, "", 0.0))
        marks.append((k, 0 if kind < 0.12 else 1, 1 if 0.12 <= kind < 0.24 else 0))
    return spark.createDataFrame(rows, cases.SCHEMA), marks


def test_held_out_accuracy_and_kept_rows(spark):
    docs, marks = labelled(spark)
    seen = spark.createDataFrame([m for m in marks if m[0] % 3], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.keep for r in classify(docs, seen).collect()}
    bad = {i for i, q, t in marks if q == 0 or t == 1}
    held = [i for i, *_ in marks if i % 3 == 0]
    assert len(got) == len(marks)
    assert sum(got[i] == (i in bad) for i in held) <= 0.01 * len(held)
    assert {r.doc_id for r in classify(docs, seen, whole=True).collect()} == {i for i, k in got.items() if k}


def test_sparse_sites_stay_near_the_rate_above(spark):
    docs, marks = labelled(spark)
    extra = spark.createDataFrame([(5000, " ".join(["INRE!! THETI!! ERRE!! ONTI!! STALE!!"] * 8), "en", "lone", 1, 1, 1, 1, 1, 1, "", 0.0)], cases.SCHEMA)
    marks = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classify(docs.union(extra), marks).collect()}
    assert got[5000].path_rate < 0.5 < got[5000].bad


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None), (None, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = cases.rows()
    assert classify(cases.documents(spark), labels).count() == len(rows)
    assert classify(cases.documents(spark), labels.limit(0), whole=True).count() == len(rows)
    assert classify(cases.empty(spark), labels).count() == 0
