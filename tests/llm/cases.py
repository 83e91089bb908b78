"""Small documents with every awkward case, and extra columns whose names clash with the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, n long, class long, row_id long, part int, label string, score double"


def rows(seed: int = 0, n: int = 120):
    rnd = random.Random(seed)
    words = [a + b for a in ("the", "in", "er", "on", "sta", "mo") for b in ("re", "ti", "le", "nd", "x")]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 90))) for _ in range(n // 3)]
    out = []
    for k in range(n):
        t = rnd.choice(texts).split(" ")
        for _ in range(rnd.choice((0, 0, 1, 1, 2, 5))):
            t[rnd.randrange(len(t))] = rnd.choice(words).upper()
        out.append(" ".join(t))
    out += [None, None, "", "  \t\n", "one", "one", "One two", "Ünïcode çà et là 日本語 テキスト ΑΒΓ", "a b c d e", "a b c d e", "x" * 30000, "naïve " * 9000]
    ids = [*range(1, len(out) + 1)]
    data = [(i, t, rnd.choice(["en", "fr", None]), rnd.choice(["s0", "s0", "s1", None]), None, 1, 2, 3, 4, 5, "l", 0.5) for i, t in zip(ids, out, strict=True)]
    data += [data[3], (None, data[5][1], "en", None, 1, 1, 1, 1, 1, 1, "", 0.0), (None, None, None, None, None, None, None, None, None, None, None, None)]
    return data


def documents(spark, seed: int = 0, n: int = 120):
    return spark.createDataFrame(rows(seed, n), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def saved(spark, folder, **tables):
    """Tables written as the queries read them; returns their folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
