import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfline.llm import periodic
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, exponent=3):
    """Every lag scanned; a stretch counts under its smallest period only."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            length = y - x + q
            smaller = any(all(words[i] == words[i + r] for i in range(x, x + length - r)) for r in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                out.append((x, length, q))
            x = y
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed):
    rnd = random.Random(seed)
    for alphabet in (1, 2, 3, 8, 500):
        for _ in range(12):
            body = []
            for _ in range(rnd.randint(1, 5)):
                block = [rnd.randrange(alphabet) for _ in range(rnd.choice((1, 2, 5, 8, 9, 12, 13, 14, 19, 20, 30, 41)))]
                times = rnd.choice((1, 2, 2.9, 3, 3.05, 3.5, 6))
                body += (block * math.ceil(times))[: round(len(block) * times)]
                body += [rnd.randrange(alphabet) for _ in range(rnd.choice((0, 1, 7)))]
            yield body


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_runs_equal_brute_force_alone_and_together(seed):
    all_texts = [np.array(t, np.int64) for t in texts(seed)]
    want = [brute_runs(t.tolist()) for t in all_texts]
    assert sum(map(len, want)) > 60
    assert periodic.runs_of(all_texts) == want
    assert [periodic.runs_of([t])[0] for t in all_texts] == want


def test_every_period_and_phase_is_seeded():
    """Runs of exactly three periods between other words, also where the period holds repeats."""
    rnd = random.Random(5)
    for q in [*range(9, 40), 97, 150, 333]:
        for block in ([rnd.randrange(10**6) for _ in range(q)], [0] * (q - 1) + [1], [k % 4 for k in range(q - 1)] + [9]):
            before = rnd.randrange(50)
            text = np.array([10**7 + k for k in range(before)] + block * 3 + [10**8 + k for k in range(rnd.randrange(50))], np.int64)
            assert (before, 3 * q, q) in [r for r in periodic.runs_of([text])[0]], (q, block[:5])


def brute(key, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(("" if key is None else str(key)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_digest_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in cases.rows(3, 90)]
    rows = [(k, t if not t or len(t) < 5000 else t[:1500]) for k, t in rows]
    rows += [(500 + k, " ".join(f"w{x}" for x in t) + rnd) for k, (t, rnd) in enumerate(zip(texts(9), ["", " ", "\n x"] * 20, strict=True))]
    rows += [(900, "a\x1cb a\x0bb \x0c\x0d" * 40), (901, "à　b " * 30), (902, "\ta b c " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in periodic.digest(periodic.periodic_runs(periodic.planted(docs))).collect()]
    want = [brute(k, t) for k, t in rows]
    assert sum(w[1] > 0 for w in want) > 40
    assert sorted(got, key=str) == sorted(want, key=str)


def test_operator_keeps_words_and_long_texts(spark):
    """The operator leaves texts as they are; a text above one group of texts is one text."""
    line = " ".join(f"x{k}" for k in range(50_000))
    long = f"start {line} {line} {line} end"  # 1 MB, period 50,000
    docs = spark.createDataFrame([(10, "a b"), (11, long), (12, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert got[10].collapsed == "a b" and got[12].n_words == 0 and got[12].collapsed == ""
    assert [tuple(r) for r in got[11].runs] == [(1, 150_000, 50_000)] and got[11].collapsed == f"start {line} end"


def test_no_rows_and_clashing_columns(spark):
    assert periodic.digest(periodic.periodic_runs(periodic.planted(cases.empty(spark)))).count() == 0
    clash = spark.createDataFrame([(5, "a " * 30, 1, 2, 3, 4, 5, 6, 7)], "doc_id long, text string, _h int, g int, w int, n int, a int, e int, p int")
    assert periodic.digest(periodic.periodic_runs(periodic.planted(clash))).first()["n_runs"] == 1
