import re

from shelfline.llm.decontaminate import clean_rows, contained
from tests.llm import cases


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


ITEMS = [(1, None), (2, ""), (3, "one two"), (4, "a b c d e"), (5, "a b c d e"), (None, "q w e r t y"), (7, " ".join(f"i{k}" for k in range(40)))]


def test_all_contained_items_are_found(spark):
    rows = cases.rows(3, 60)
    words = (rows[0][1] or "").split()
    item = " ".join(f"i{k}" for k in range(40))
    rows += [(900, "long " * 3000 + item + " tail" * 50, *rows[0][2:]), (901, "x " + " ".join(f"i{k}" for k in range(33)) + " y", *rows[0][2:]), (902, " ".join(f"i{k}" for k in range(20)), *rows[0][2:])]
    items = [*ITEMS, (8, " ".join(words[:12])), (9, "naïve naïve naïve naïve naïve")]
    docs, bench = spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t, *_ in rows:
        x = sets(t)
        for j, u in items:
            y = sets(u)
            if y and 100 * len(x & y) >= 75 * len(y):
                want.append((i, j, len(x & y), len(y), len(x)))
    for block in (1 << 20, 16):
        assert sorted((tuple(r) for r in contained(docs, bench, block_shingles=block).collect()), key=str) == sorted(want, key=str)
    hit = {w[0] for w in want}
    assert {900, 901} <= hit and 902 not in hit
    assert sorted((r.doc_id for r in clean_rows(docs, bench).collect()), key=str) == sorted((r[0] for r in rows if r[0] not in hit), key=str)


def test_no_rows(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contained(cases.empty(spark), bench).count() == 0
    assert contained(cases.documents(spark), bench.limit(0)).count() == 0


def test_items_of_few_words_are_found_in_longer_documents(spark):
    texts = [
        "the answer is Forty Two indeed, said they", "forty\ttwo", "forty", "two forty three forty", "a forty-two b c d e f", "x y z one two three\nFOUR five six", "one two three", "four one two three",
        "nothing of that here at all", None, "", "one two  three x four forty  two", "Çà ÇA et là bas mon ami", "word " * 20000 + "forty two",
    ]
    items = [(1, "Forty two"), (2, "forty two"), (3, "one two three four"), (4, "là"), (5, "ça et"), (6, None), (7, ""), (8, "nothing"), (9, "two three four five six"), (None, "of that here")]
    rows = [(800 + k, t, *([None] * 10)) for k, t in enumerate(texts)] + cases.rows(3, 30)
    docs, bench = spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(items, "item_id long, text string")

    def split(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    want = []
    for i, t, *_ in rows:
        x, w = sets(t), split(t)
        for j, u in items:
            v, y = split(u), sets(u)
            shared = any(w[k : k + len(v)] == v for k in range(len(w) - len(v) + 1)) if 0 < len(v) < 5 else len(x & y)
            if y and 100 * shared >= 75 * len(y):
                want.append((i, j, int(shared), len(y), len(x)))
    for block in (1 << 20, 3):
        assert sorted((tuple(r) for r in contained(docs, bench, block_shingles=block).collect()), key=str) == sorted(want, key=str)
    hit = {w[0] for w in want}
    assert {i - 800 for i in hit if i >= 800} == {0, 1, 5, 8, 11, 12, 13}
    assert sorted((r.doc_id for r in clean_rows(docs, bench).collect()), key=str) == sorted((r[0] for r in rows if r[0] not in hit), key=str)
