import hashlib
import random
from collections import Counter

import numpy as np

from shelfline.llm import suffix_dedup
from tests.llm import cases


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k:k + 200] for _, b in texts for k in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1])), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def planted(seed):
    rnd = random.Random(seed)
    make = lambda n: "".join(rnd.choice("abcdeé ") for _ in range(n))
    shared = [make(n) for n in (150, 199, 200, 201, 260, 900)]
    rows = []
    for k in range(60):
        parts = [make(rnd.randint(0, 250))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randint(0, 30)
            parts += [s[a:] if rnd.random() < 0.5 else s, make(rnd.randint(0, 250))]
        rows.append((k, "".join(parts), *([None] * 10)))
    return rows + [(100, "z" * 450, *([None] * 10)), (101, "ab" * 150, *([None] * 10))] + cases.rows(seed, 60)


def test_removal_equals_brute_force(spark, tmp_path):
    rows = planted(4)
    got = suffix_dedup.op3_suffix_dedup(spark, cases.saved(spark, tmp_path, documents=spark.createDataFrame(rows, cases.SCHEMA))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert suffix_dedup.op3_suffix_dedup(spark, cases.saved(spark, tmp_path, documents=cases.empty(spark))).count() == 0


def test_texts_longer_than_a_window(spark, tmp_path):
    rnd = random.Random(9)
    make = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, edge = make(700), suffix_dedup.WINDOW
    # The passage stands across the border of two windows, after it, and in a short text; one stretch repeats one byte.
    rows = [(1, make(edge - 350) + passage + make(9000) + passage + make(50)), (2, make(99) + passage[100:650] + make(99)),
            (3, make(edge - 100) + "z" * 900 + make(40)), (4, make(edge) + passage[:199])]
    rows = [(*r, *([None] * 10)) for r in rows]
    got = suffix_dedup.op3_suffix_dedup(spark, cases.saved(spark, tmp_path, documents=spark.createDataFrame(rows, cases.SCHEMA))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_anchors_do_not_depend_on_windows(monkeypatch):
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"abc") for _ in range(n)) for n in (0, 5, 199, 200, 201, 640, 3000)] + [b"x" * 900, b"ab" * 400]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    whole = suffix_dedup.anchors(data, offsets)
    monkeypatch.setattr(suffix_dedup, "WINDOW", 57)
    for a, b in zip(whole, suffix_dedup.anchors(data, offsets), strict=True):
        assert a.tolist() == b.tolist()
    # A text alone has the anchors that it has among others.
    at = offsets[6]
    alone = suffix_dedup.anchors(data[at:offsets[7]], np.array([0, 3000]))
    inside = (whole[0] >= at) & (whole[0] < offsets[7])
    assert alone[0].tolist() == (whole[0][inside] - at).tolist() and alone[1].tolist() == whole[1][inside].tolist()
