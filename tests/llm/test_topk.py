import duckdb
import numpy as np
import pytest

from shelfline.llm.topk import ORACLE, top_products


def brute(rows, width):
    good = [(i, np.pad(np.floor(64 * np.array(v, float)).astype(int), (0, width - len(v)))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 20 == 0:
            best = sorted((-int(q @ x), j) for j, x in good if j != i)[:20]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    for scale in (0.3, 40.0):
        rows = [(k, (rng.normal(size=8) * rng.choice([0.2, 1, scale])).astype(np.float32).tolist()) for k in range(700)]
        rows += [(k, [0.5] * 8) for k in range(700, 1000)]
        rows += [(1020, None), (1040, [None] * 8), (1060, [float("nan")] * 8), (None, [1.0] * 8), (1081, [3.0] * 3), (1100, [float("inf")] * 8), (1120, [])]
        got = top_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), sample=64, pivots=8, block=20)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, 8)


def test_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_products(few).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_products(few.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 30])
def test_repeated_rows_rank_as_the_check_sql_says(spark, tmp_path, copies):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(1, 121)] * copies
    # One key with the best score on many rows, a query key with two vectors, and equal vectors on a query's own rows and others.
    rows += [(900, [9.0] * 8)] * copies + [(901, [9.0] * 8)] * 3 + [(40, [0.5] * 8)] + [(k, [0.25] * 8) for k in (940, 941, 942)] + [(920, [0.25] * 8)] * copies
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(ORACLE).fetchall())
    assert len(want) == 20 * 9
    for block in (2, 8192):
        got = top_products(vectors, sample=64, pivots=8, block=block)
        assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("value", [1e9, 1e200, 1e308])
def test_scores_beyond_a_long_are_refused(spark, value):
    rows = [(k, [1.0, float(k)]) for k in range(40)] + [(41, [value, 0.0])]
    with pytest.raises(ValueError, match="would not fit a long"):
        top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=64, pivots=8)
