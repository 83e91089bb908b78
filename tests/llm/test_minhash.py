import random
import re

import numpy as np
import pytest

from shelfline.llm import minhash
from tests.llm import cases


def brute(rows, similarity=85, size=3):
    sets = []
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((i, {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()))
    up = list(range(len(sets)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= similarity * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)), i == least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def got(docs):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_components_equal_brute_force(spark):
    rows = cases.rows(1, 240)
    assert got(cases.documents(spark, 1, 240)) == brute(rows)


def family():
    """Variants of one text around the threshold: to the base, to each other, in chains; and a template that hardly links."""
    rnd = random.Random(4)
    base = [f"w{k}" for k in range(240)]
    rows = [(0, " ".join(base))]
    for c in range(1, 90):
        w = list(base)
        for _ in range(rnd.choice((1, 3, 5, 6, 7, 9))):
            w[rnd.randrange(240)] = f"z{rnd.randrange(40)}"
        rows.append((c, " ".join(w)))
    w = list(base)
    for c in range(100, 140):  # a chain: each close to the one before it
        w = list(w)
        for _ in range(4):
            w[rnd.randrange(240)] = f"c{c}"
        rows.append((c, " ".join(w)))
    template = [f"t{k}" for k in range(150)]
    for c in range(200, 290):  # most pairs below the threshold, some above
        rows.append((c, " ".join(template + [f"own{(c // 2) if c % 3 else c}-{k}" for k in range(26)])))
    rnd.shuffle(rows)
    return rows


def test_pairs_near_the_threshold_beside_hubs(spark, monkeypatch):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert 10 < len({r[2] for r in want}) < 150
    monkeypatch.setattr(minhash, "CHUNK", 8)
    assert got(docs) == want


def test_repeated_keys_with_other_texts(spark):
    """One key on many rows of many texts; every text stands for its own class."""
    rnd = random.Random(2)
    texts = [" ".join(f"v{rnd.randrange(9999)}" for _ in range(30)) for _ in range(12)]
    rows = [(7, t) for t in texts * 3] + [(None, texts[0]), (8, texts[1]), (9, texts[2] + " more"), (None, "x y z w"), (None, None), (3, "")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(
        [(i, n, c, i == c) for i, n, c, _ in brute(rows)], key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_stars_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(130)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 540)] + [(9, 9)]
    up = {n: n for e in edges for n in e}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    labels = {r.node: r.label for r in minhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {n: find(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}


def test_minima_estimate_similarity():
    rnd = np.random.default_rng(3)
    x = rnd.integers(1, 2**64, 1000, dtype=np.uint64)
    y = np.concatenate([x[:925], rnd.integers(1, 2**64, 75, dtype=np.uint64)])
    a, b = minhash.minima(np.concatenate([x, y]), np.array([0, 1000]))
    assert abs((a == b).mean() - 925 / 1075) < 0.1
    assert 95 < minhash.least_agreement() < 115


def test_no_rows(spark):
    assert got(cases.empty(spark)) == []
