import math
import re
from collections import Counter, defaultdict

import numpy as np

from shelfline.llm import lm_score
from tests.llm import cases


def brute(rows, order=5):
    held = lm_score.held_out_rows([r[0] for r in rows])
    texts = [(r[1] or "").encode() for r in rows]
    counts = defaultdict(Counter)
    for b, h in zip(texts, held):
        if not h:
            s = bytes([0xFE] * order) + b + b"\xff"
            for k in range(order, len(s)):
                for j in range(order + 1):
                    counts[s[k - j:k]][s[k]] += 1

    def length(context, symbol):
        out, gone = 0.0, set()
        for j in range(order, -1, -1):
            have = counts.get(context[order - j:], {})
            here = {s: c for s, c in have.items() if s not in gone}
            if not here:
                continue
            total, kinds = sum(here.values()), len(here)
            if symbol in here:
                return out + math.log10(here[symbol] / (total + kinds))
            out += math.log10(kinds / (total + kinds))
            gone |= set(have)
        return out - math.log10(max(1, 256 - len(counts[b""])))

    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) for r in rows]
    c = Counter()
    for w, h in zip(words, held):
        if not h:
            c.update(w)
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for r, b, w, h in zip(rows, texts, words, held):
        s = bytes([0xFE] * order) + b + b"\xff"
        w = [*w, None]
        out.append((r[0], h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), sum(length(s[k - order:k], s[k]) for k in range(order, len(s)))))
    return out


def test_scores_equal_brute_force(spark, tmp_path):
    rows = [r for r in cases.rows(6, 80) if len(r[1] or "") < 20000]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    want = sorted(brute(rows), key=str)
    for chunk in (lm_score.CHUNK_BYTES, 2000):
        got = lm_score.score_documents(docs.repartition(3), lm_score.fold("doc_id", 7) == 2, chunk).collect()
        got = sorted((tuple(r) for r in got), key=str)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-5)


def test_no_rows_and_no_training(spark):
    assert lm_score.score_documents(cases.empty(spark)).count() == 0
    one = lm_score.score_documents(cases.documents(spark).where("doc_id = 1").withColumn("h", lm_score.F.lit(True)), lm_score.F.col("h")).collect()[0]
    assert one.train_tokens == 0 and one.n_known == 0 and one.score < 0
