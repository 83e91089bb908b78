"""Quality classifier with hierarchical empirical Bayes over sites.

A document's own evidence is the log odds of a logistic model over the presence of
words (runs of letters) and coarse shape features, fitted on a bounded sample of labelled rows. A row is
bad if its label says low quality or toxic. The evidence of all documents is then
summed by host and by path within the host. A host's rate of bad documents is
shrunk towards the global rate and a path's rate towards its host's; the strength
of both shrinkages is estimated from the spread of the rates (method of moments),
so a sparse site keeps close to the rate above it. A document's posterior log odds
are its own plus what its path (without the document itself) adds to the global
rate.

Null text counts as empty. A null host or path is a site of its own. Without any
usable label (none, or all alike) nothing is known and every document has the
posterior one half and is kept. Rows repeated with one key are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import IS_SPACE, LOWER, carried, materialise, prefix_hash, span_hash, unpacked, utf8_parts, word_spans

#: The model is fitted on about this many labelled rows, drawn by hash of the key.
SAMPLE_ROWS = 6000
WORD_BITS = 18
#: Shape features: number, bins of each, all after the hashed words.
SHAPES, BINS = 7, 24
FEATURES = (1 << WORD_BITS) + SHAPES * BINS
#: A word is a feature if its rate among bad rows differs by this many standard errors.
LEAST_Z, MOST_WORDS = 6.0, 400
REJECT_AT = 0.5
#: Site evidence shifts log odds by this much at most, so that a site can't overrule a clear text.
MOST_SHIFT = 2.0

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-"]] = True
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def features(column: pa.Array):
    """Yield (first row, row count, row of feature, feature) for runs of rows."""
    for first, raw, offsets in utf8_parts(column):
        n = len(offsets) - 1
        start, end, row = word_spans(raw, offsets, _NO_LETTER)
        word = (span_hash(prefix_hash(LOWER[raw]), start, end) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        keys, times = np.unique((row.astype(np.int64) << WORD_BITS) | word, return_counts=True)
        rows, words = keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)
        size = np.diff(offsets)
        chars = np.maximum(size, 1)
        n_words = np.bincount(row, minlength=n)
        distinct = np.bincount(rows, minlength=n)
        top = np.zeros(n)
        np.maximum.at(top, rows, times)

        def share(table, raw=raw, offsets=offsets, chars=chars):
            total = np.concatenate([[0], np.cumsum(table[raw])])
            return (total[offsets[1:]] - total[offsets[:-1]]) / chars

        long = np.minimum(np.log2(n_words + 1), 15) // 2.5  # 0 to 6: ratios mean less in short texts
        shapes = [
            np.log2(n_words + 1), _log_bin(share(_SYMBOL)), _log_bin(share(_UPPER)), _log_bin(share(_DIGIT)),
            np.minimum(3, 4 * distinct / np.maximum(n_words, 1)) // 1 + 4 * np.minimum(long, 5),
            np.minimum(3, 4 * top / np.maximum(n_words, 1)) // 1 + 4 * np.minimum(long, 5),
            24 * share(IS_SPACE),
        ]
        base = 1 << WORD_BITS
        shape = [base + k * BINS + np.clip(s, 0, BINS - 1).astype(np.int64) for k, s in enumerate(shapes)]
        yield first, n, np.concatenate([rows, *[np.arange(n)] * SHAPES]), np.concatenate([words, *shape])


def _log_bin(share: np.ndarray) -> np.ndarray:
    return np.where(share > 0, 12 + np.log2(np.maximum(share, 2.0**-11)), 0)


def _feature_rows(batches):
    for batch in batches:
        lists = [None] * batch.num_rows
        for first, n, rows, ids in features(batch.column("text")):
            order = np.argsort(rows, kind="stable")
            cut = np.searchsorted(rows[order], np.arange(n + 1))
            for k in range(n):
                lists[first + k] = ids[order[cut[k] : cut[k + 1]]].astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("bad"), pa.array(lists, pa.list_(pa.int32()))], names=["bad", "ids"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Weights of all features, the bias last; None where the labels say nothing."""
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    number = marked.count()
    if not number:
        return None
    drawn = marked.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample_rows / number)))
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("text", "bad").mapInArrow(_feature_rows, "bad boolean, ids array<int>").collect()
    y = np.array([r.bad for r in rows], float)
    if not 0 < y.sum() < len(y):
        return None
    row = np.repeat(np.arange(len(rows)), [len(r.ids) for r in rows])
    ids = np.concatenate([np.asarray(r.ids, np.int64) for r in rows])
    n, bad = np.bincount(ids, minlength=FEATURES), np.bincount(ids, y[row], FEATURES)
    rate = y.mean()
    z = (bad - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9))
    z[n < 5] = 0
    z[1 << WORD_BITS :] = 0
    picked = np.argsort(-np.abs(z))[:MOST_WORDS]
    picked = np.concatenate([picked[np.abs(z[picked]) >= LEAST_Z], np.arange(1 << WORD_BITS, FEATURES)])
    place = np.full(FEATURES, -1)
    place[picked] = np.arange(len(picked))
    x = np.zeros((len(rows), len(picked) + 1))
    x[:, -1] = 1
    keep = place[ids] >= 0
    x[row[keep], place[ids[keep]]] = 1
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.5)
    ridge[-1] = 1e-6
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    out = np.zeros(FEATURES + 1, np.float32)
    out[picked], out[-1] = w[:-1], w[-1]
    return out


def evidence(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """``docs`` with ``_odds``, the log odds that the text is bad."""
    if weights is None:
        return docs.withColumn("_odds", F.lit(0.0))
    handle = docs.sparkSession.sparkContext.broadcast(weights)  # fixed size: one float per feature

    def run(batches):
        weight = handle.value.astype(float)
        for batch in batches:
            odds = np.full(batch.num_rows, weight[-1])
            for first, n, rows, ids in features(batch.column("text")):
                odds[first : first + n] += np.bincount(rows, weight[ids], n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds)], names=[*batch.schema.names, "_odds"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_odds", T.DoubleType())]))


def site_rates(scored: DataFrame) -> tuple[DataFrame, float]:
    """Sums and shrunk rates by ``_host`` and ``_path``, and the global rate.

    Paths are summed first and hosts from the paths, so a hot host is a sum of
    partial sums. The two shrinkage strengths come from one-row aggregates.
    """
    p = 1 / (1 + F.exp(-F.col("_odds")))
    paths = materialise(scored.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum(p).alias("s")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    n = total["n"] or 0
    rate = min(max((total["s"] or 0.0) / n if n else 0.5, 1e-4), 1 - 1e-4)
    k_host = _strength(hosts.select(F.col("hn").alias("n"), F.col("hs").alias("s"), F.lit(rate).alias("m")))
    hosts = hosts.withColumn("host_rate", (F.col("hs") + k_host * rate) / (F.col("hn") + k_host))
    both = paths.alias("p").join(hosts.alias("h"), F.col("p._host").eqNullSafe(F.col("h._host"))).select("p._host", "_path", "n", "s", "hn", "host_rate")
    k_path = _strength(both.select("n", "s", F.col("host_rate").alias("m")))
    return materialise(both.select("_host", "_path", F.col("n").alias("_n"), F.col("s").alias("_s"), F.lit(k_path).alias("_k"), F.col("host_rate").alias("_host_rate")), "rates"), rate


def _strength(groups: DataFrame) -> float:
    """Rows that the rate above counts for: large where groups differ no more than by chance."""
    r = groups.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("g"),
        F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("m")) ** 2).alias("between"), F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("chance")).first()
    if not r["g"] or r["g"] < 2:
        return 1e6
    v = r["chance"] / r["n"]
    spread = (r["between"] - (r["g"] - 1) * v) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    return float(min(1e6, max(1.0, v / spread - 1))) if spread > 0 else 1e6


def posterior(scored: DataFrame, rates: DataFrame, rate: float) -> DataFrame:
    """``scored`` with ``_host_rate``, ``_path_rate`` (the document itself left out) and ``_bad``."""
    p = 1 / (1 + F.exp(-F.col("_odds")))
    joined = scored.alias("d").join(rates.alias("r"), F.col("d._host").eqNullSafe(F.col("r._host")) & F.col("d._path").eqNullSafe(F.col("r._path"))).select("d.*", "_n", "_s", "_k", "_host_rate")
    path = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), (F.col("_s") - p + F.col("_k") * F.col("_host_rate")) / (F.col("_n") - 1 + F.col("_k"))))
    joined = joined.withColumn("_path_rate", path)
    shift = F.log(F.col("_path_rate") / (1 - F.col("_path_rate"))) - float(np.log(rate / (1 - rate)))
    return joined.withColumn("_bad", 1 / (1 + F.exp(-(F.col("_odds") + F.greatest(F.lit(-MOST_SHIFT), F.least(F.lit(MOST_SHIFT), shift))))))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample_rows: int = SAMPLE_ROWS, whole: bool = False) -> DataFrame:
    """``doc_id``, ``evidence``, ``host_rate``, ``path_rate``, ``bad`` and ``keep`` of every document.

    With ``whole`` the kept documents with all their columns instead.
    """
    weights = fit(docs, labels, sample_rows)
    sites = docs.select("doc_id", "text", F.col(host).cast("string").alias("_host"), F.col(path).cast("string").alias("_path"))
    scored = materialise(evidence(sites, weights).drop("text"), "evidence")
    rates, rate = site_rates(scored)
    if whole:
        rows = carried(docs, _host=F.col(host).cast("string"), _path=F.col(path).cast("string"))
        return posterior(evidence(rows, weights), rates, rate).where(F.col("_bad") <= REJECT_AT).select(*unpacked(docs.columns, "text"))
    return posterior(scored, rates, rate).select(
        "doc_id", F.col("_odds").alias("evidence"), F.col("_host_rate").alias("host_rate"), F.col("_path_rate").alias("path_rate"), F.col("_bad").alias("bad"), (F.col("_bad") <= REJECT_AT).alias("keep"))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """The posterior of every document; host is the source, path its section by language."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
