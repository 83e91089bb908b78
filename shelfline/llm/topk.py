"""Exact top-k inner products by a pivot-distance index.

Vectors become integers and get one more component that gives all of them the
same length, so that the largest inner products are the smallest distances. Each
vector is keyed by its nearest pivot and its distance to it, and the index is
sorted by that key: a slice of it is an annulus around a pivot. The triangle
inequality bounds the distance of a query to everything in an annulus, and a query
skips every annulus that can't beat its k-th score so far. Annuli are searched
nearest first.

Pivots come from a bounded sample; so do the first k-th scores, which are valid
bounds because the sample is part of the data. Everything is indexed and every
query is exact. The queries are a stated set and go to the index in blocks of a
fixed size.

Vectors that are null or hold null or non-finite components, and rows without a
key, take no part. Missing components of shorter vectors count as 0. Rows with the
query's own key are not its candidates. Rows are ranked, not keys: a candidate key
that occurs on several rows takes a rank for each, and the candidates of a query key
that occurs on several rows count once for each of these and are ranked together.
Vectors so long that a score might not fit a long are refused with an error.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import materialise


SCALE, TOP, EVERY = 64, 20, 20
#: Bounds of the fitted sample, the pivots, the rows of an annulus, and a block of queries.
SAMPLE, PIVOTS, ANNULUS, QUERIES = 2048, 64, 2048, 8192


def _integers(scale: int):
    def run(batches):
        for batch in batches:
            keys, blobs, norms = [], [], []
            for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                if key is None or vector is None or None in vector:
                    continue
                vector = np.array(vector, np.float64)
                if np.isfinite(vector).all():
                    x = np.floor(scale * vector)
                    keys.append(key)
                    blobs.append(x.tobytes())
                    norms.append(float(x @ x))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary()), pa.array(norms, pa.float64())], names=["vec_id", "v", "norm"])

    return run


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width))
    for k, b in enumerate(blobs):
        x = np.frombuffer(b, np.float64)
        out[k, : len(x)] = x
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, top - (x * x).sum(1)))[:, None]], 1)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)))


def _products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products; by machine floats only where these are exact."""
    return (q @ x.T).astype(np.int64) if exact else q.astype(np.int64) @ x.astype(np.int64).T


class Block:
    """A block of queries and their best rows so far."""

    def __init__(self, keys, vectors, copies, top, pivots, k, exact):
        self.keys, self.vectors, self.copies, self.top, self.k, self.exact = keys, vectors, copies, top, k, exact
        self.to_pivot = _distance(np.concatenate([vectors, np.zeros((len(vectors), 1))], 1), pivots)
        self.square = (vectors * vectors).sum(1)
        self.worst = np.full(len(keys), -(2**62), np.int64)
        self.slack = 1e-9 * (top + (self.square.max() if len(keys) else 0)) + 1

    def start(self, keys, vectors):
        for a in range(0, len(self.keys), 1024):
            scores = _products(self.vectors[a : a + 1024], vectors, self.exact)
            scores[self.keys[a : a + 1024, None] == keys[None]] = -(2**62)
            if len(keys) >= self.k:
                self.worst[a : a + 1024] = np.partition(scores, -self.k, axis=1)[:, -self.k]

    def search(self, annuli, pivots):
        """Search the annuli nearest first; returns query index, key and score of what may be among the best."""
        n = len(self.keys)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n
        bounds = []
        for pivot, low, high, _, _ in annuli:
            near = np.maximum(0, np.maximum(low - self.to_pivot[:, pivot], self.to_pivot[:, pivot] - high))
            bounds.append((self.square + self.top - near * near) / 2 + self.slack)
        worst = self.worst.copy()
        for at in np.argsort([-np.median(b) for b in bounds]) if n else ():
            _, _, _, keys, vectors = annuli[at]
            for some in np.array_split(live := np.flatnonzero(bounds[at] >= worst), max(1, len(live) // 1024)):
                scores = _products(self.vectors[some], vectors, self.exact)
                scores[self.keys[some, None] == keys[None]] = -(2**62)
                hit = scores >= worst[some, None]
                for i in np.flatnonzero(hit.any(1)).tolist():
                    q, new = some[i], hit[i] & (scores[i] > -(2**62))
                    s, x = np.concatenate([best[q][0], scores[i][new]]), np.concatenate([best[q][1], keys[new]])
                    if len(s) > self.k:
                        order = np.lexsort((x, -s))[: self.k]
                        s, x = s[order], x[order]
                        worst[q] = max(worst[q], s[-1])
                    best[q] = (s, x)
        sizes = [len(s) for s, _ in best]
        return np.repeat(np.arange(n), sizes), np.concatenate([x for _, x in best] or [[]]).astype(np.int64), np.concatenate([s for s, _ in best] or [[]]).astype(np.int64)


def _fewest(keys: np.ndarray, vectors: np.ndarray, k: int):
    """Of equal vectors only the first rows by key can be among the best: k of one key, and as many more as may be a query's own."""
    order = np.argsort(keys, kind="stable")
    keys, vectors = keys[order], vectors[order]
    _, group = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")
    new = np.append(True, (np.diff(group[order]) != 0) | (np.diff(keys[order]) != 0))
    order = order[np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1] < k]
    first = np.searchsorted(group[order], group[order], "left")
    keep = order[np.arange(len(order)) - first < 2 * k]
    return keys[keep], vectors[keep]


def top_products(vectors: DataFrame, scale: int = SCALE, k: int = TOP, every: int = EVERY, sample: int = SAMPLE, pivots: int = PIVOTS, block: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best ``k`` for each row whose key is divisible by ``every``."""
    spark = vectors.sparkSession
    ready = materialise(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_integers(scale), "vec_id long, v binary, norm double"), "vectors")
    facts = ready.agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.max(F.length("v")).alias("bytes")).first()
    queries = ready.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
    queries = materialise(queries, "queries")
    if not (n_queries := queries.count()):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if facts["top"] >= 2.0**62:
        raise ValueError(f"a vector of squared length {facts['top']:g} after scaling: scores would not fit a long")
    width, top, exact = facts["bytes"] // 8, facts["top"], facts["top"] < 2.0**52
    share = min(1.0, sample / facts["n"])
    drawn = ready.where(F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(1 << 20)) <= int(share * (1 << 20))).limit(2 * sample).collect()
    drawn_keys, drawn_vectors = np.array([r["vec_id"] for r in drawn], np.int64), _matrix([r["v"] for r in drawn], width)
    centres = _lift(drawn_vectors[np.random.default_rng(7).permutation(len(drawn))[:pivots]], top) if drawn else np.zeros((1, width + 1))
    fixed = spark.sparkContext.broadcast(centres)  # at most ``pivots`` vectors

    def key(batches):
        for batch in batches:
            away = _distance(_lift(_matrix(batch.column("v").to_pylist(), width), top), fixed.value)
            near = away.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near])], names=["vec_id", "v", "pivot", "away"])

    index = ready.select("vec_id", "v").mapInArrow(key, "vec_id long, v binary, pivot int, away double")
    # The hashed row spreads many copies of one vector over partitions, also those of one key.
    index = materialise(index.withColumn("spread", F.xxhash64("vec_id", F.monotonically_increasing_id())).repartitionByRange("pivot", "away", "spread").sortWithinPartitions("pivot", "away").drop("spread"), "index")

    found = []
    blocks = -(-n_queries // block)
    for number in range(blocks):
        asked = queries.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == number).collect()
        own = Block(np.array([r["vec_id"] for r in asked], np.int64), _matrix([r["v"] for r in asked], width), np.array([r["copies"] for r in asked], np.int64), top, centres, k, exact)
        own.start(drawn_keys, drawn_vectors)
        handle = spark.sparkContext.broadcast(own)

        def search(batches, handle=handle):
            def flush(parts):
                pivot, away = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                keys, rows = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
                annuli = []
                for p in np.unique(pivot):
                    ring = np.flatnonzero(pivot == p)
                    for a in range(0, len(ring), ANNULUS):
                        at = ring[a : a + ANNULUS]
                        annuli.append((p, away[at].min(), away[at].max(), *_fewest(keys[at], rows[at], k)))
                query, key_, score = handle.value.search(annuli, fixed.value)
                each = handle.value.copies[query]
                query, key_, score = np.repeat(query, each), np.repeat(key_, each), np.repeat(score, each)
                return pa.RecordBatch.from_arrays([pa.array(handle.value.keys[query], pa.int64()), pa.array(key_), pa.array(score)], names=["query_id", "vec_id", "score"])

            parts, size = [], 0
            for batch in batches:
                parts.append((batch.column("pivot").to_numpy(), batch.column("away").to_numpy(), batch.column("vec_id").to_numpy(), _matrix(batch.column("v").to_pylist(), width)))
                size += batch.num_rows
                if size >= 64 * ANNULUS:
                    yield flush(parts)
                    parts, size = [], 0
            if size:
                yield flush(parts)

        found.append(index.mapInArrow(search, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")


def op10_topk(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all vectors."""
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.e, c.e)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
