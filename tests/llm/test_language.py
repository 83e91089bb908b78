import random

import numpy as np

from shelfline.llm import language
from tests.llm import cases

SYLLABLES = {"aa": ("the", "ing", "er", "tion"), "bb": ("schö", "ung", "heit", "ver"), "cc": ("ción", "ll", "ñar", "mente")}


def corpus(spark, n=240):
    rnd = random.Random(2)
    rows = []
    for k in range(n):
        lang = rnd.choice(list(SYLLABLES))
        text = " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(5, 150)))
        rows.append((k, text, lang, None, None, 1, 1, 1, 1, 1, "", 0.5))
    return spark.createDataFrame(rows, cases.SCHEMA), rows


def test_held_out_accuracy(spark):
    docs, rows = corpus(spark)
    network = language.fit(docs.where("doc_id % 4 <> 2"), rounds=80)
    got = {r.doc_id: r for r in language.predict(docs, network).collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    rest = [tuple(r) for r in language.predict(cases.documents(spark), network).collect()]
    assert len(rest) == len(cases.rows())
    byid = dict((r[0], r[1:]) for r in rest)
    empties = [r[0] for r in cases.rows() if not (r[1] or "").strip() and r[0]]
    assert empties and all(byid[i] == ("und", 0.0) for i in empties)
    assert language.predict(cases.empty(spark), network).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = language.Network(["a", "b"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.integers(1, 255, (3, language.SEGMENT)).astype(np.uint8)
    used, y = np.array([language.SEGMENT, 50, 7]), np.array([0, 1, 1])
    g, _ = net.gradients(x, used, y)
    for name in net.w:
        flat = np.abs(g[name]).ravel().argmax()
        old = net.w[name].ravel()[flat]
        ends = []
        for d in (0.05, -0.05):
            net.w[name].ravel()[flat] = old + d
            ends.append(net.gradients(x, used, y)[1])
        net.w[name].ravel()[flat] = old
        assert np.isclose((ends[0] - ends[1]) / 0.1, g[name].ravel()[flat], rtol=0.05, atol=1e-4), name


def test_without_labels(spark):
    assert language.fit(cases.empty(spark)) is None
    assert {r.lang_pred for r in language.predict(cases.documents(spark), None).collect()} == {"und"}
