"""Periodic runs of words, found by minimizers on many scales.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and a length of at least ``max(min_words, exponent * q)`` that no
neighbouring word extends keeping period q.

1. Periods up to ``SHORT`` are found by direct scans: words compared with those
   ``q`` further on.
2. Longer periods are dealt to scales ``[lo, w]`` with ``w`` half as long again as
   ``lo``. On each scale the grams of ``w`` words are hashed, and the least hash of
   every window is kept. A gram at least as long as the period occurs inside a run
   at multiples of the period only, and a run of three periods holds a whole window
   and its copy one period on. So the window's minimum comes twice, one period apart
   with no equal gram between: equal neighbours among the minima, ``lo`` to ``w``
   apart, are the seeds, and no run lacks one.
3. Every seed is extended word by word to its maximal stretch. Stretches that are too
   short, or whose period is a multiple of a smaller one, go.

Ties need no rule, as all equal minima of a window are kept; grams that many periods
share only lie closer than ``lo``, so the seeds stay linear in the text. Words are
compared exactly; hashes only propose.

Null text has no words. Rows with a null key or repeated rows are rows of their own.
Other columns are ignored. Texts of any length are treated whole; several short ones
are scanned together, kept apart by words that occur once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import mix, prefix_hash_of, span_hash

MIN_WORDS, EXPONENT = 24, 3
#: Periods up to this are scanned for directly.
SHORT = 8
#: Bytes of text that are scanned together.
TOGETHER = 4 << 20

RUN = "struct<start: long, length: long, period: long>"
_RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def scales(longest: int, exponent: int = EXPONENT) -> Iterator[tuple[int, int]]:
    """Least and greatest period of each scale that a text of ``longest`` words needs."""
    lo = SHORT + 1
    while exponent * lo <= longest:
        w = lo * 3 // 2
        yield lo, w
        lo = w + 1


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def seeds(words: np.ndarray, lo: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of equal minimizers that are neighbours, ``lo`` to ``w`` apart."""
    n, window = len(words) - w + 1, 2 * lo - w + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    grams = span_hash(prefix_hash_of(mix(words.astype(np.uint64))), at, at + w)
    least = _sliding(grams, window, np.minimum)
    # A gram is a minimum if the largest of the minima of its windows is its own.
    edge = np.zeros(window - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == grams)
    order = chosen[np.argsort(grams[chosen], kind="stable")]
    distance = order[1:] - order[:-1]
    keep = (grams[order[1:]] == grams[order[:-1]]) & (distance >= lo) & (distance <= w)
    return order[:-1][keep], distance[keep]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How far from ``at`` words agree with those ``lag`` on, to the right (1) or, before ``at``, to the left (-1)."""
    total, size = 0, 64
    while True:
        a, b = (at + total, min(at + total + size, len(words) - lag)) if step > 0 else (max(0, at - total - size), at - total)
        if a >= b:
            return total
        same = words[a:b] == words[a + lag : b + lag]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return total + int(np.argmin(same))
        total, size = total + b - a, size * 2


def _primitive(block: np.ndarray) -> bool:
    """Whether a block is no repetition of a shorter one."""
    q, r, left = len(block), 2, len(block)
    while left > 1:
        if r * r > left:
            r = left
        if left % r == 0:
            if np.array_equal(block[: q - q // r], block[q // r :]):
                return False
            while left % r == 0:
                left //= r
        r += 1
    return True


def _stretches(words: np.ndarray, lag: int, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of ``least`` words or more whose words ``lag`` apart are identical, by one scan."""
    same = np.flatnonzero(words[:-lag] == words[lag:])
    if not len(same):
        return []
    breaks = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.concatenate([[0], breaks + 1])], same[np.concatenate([breaks, [len(same) - 1]])]
    long = last - first + 1 + lag >= least
    return list(zip(first[long].tolist(), (last - first + 1 + lag)[long].tolist(), strict=True))


def _together(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each closed by a word of its own, and where they start."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    most = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    return np.concatenate([x for k, t in enumerate(texts) for x in (t, np.array([most + k], np.int64))]), starts


def runs_of(texts: list[np.ndarray], min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per text of word numbers its runs (start, length, period), by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def keep(words, starts, names, start, length, period):
        if _primitive(words[start : start + period]):
            k = int(np.searchsorted(starts, start, "right")) - 1
            found[names[k]].append((start - int(starts[k]), length, period))

    names = [k for k, t in enumerate(texts) if len(t) >= min_words]
    if not names:
        return found
    words, starts = _together([texts[k] for k in names])
    for lag in range(1, min(SHORT, len(words) - 1) + 1):
        for start, length in _stretches(words, lag, max(min_words, exponent * lag)):
            keep(words, starts, names, start, length, lag)
    for lo, w in scales(max(len(texts[k]) for k in names), exponent):
        long = [k for k in names if len(texts[k]) >= exponent * lo]
        if len(long) < len(names):  # texts too short for the scale leave
            names = long
            words, starts = _together([texts[k] for k in names])
        at, distance = seeds(words, lo, w)
        done, lag = -1, 0
        for k in np.lexsort((at, distance)).tolist():
            p, q = int(at[k]), int(distance[k])
            if q != lag:
                done, lag = -1, q
            if p < done:  # inside the last stretch of this period
                continue
            start = p - _reach(words, p, q, -1)
            done = p + _reach(words, p, q, 1)
            if done - start + q >= max(min_words, exponent * q):
                keep(words, starts, names, start, done - start + q, q)
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """Words that no run holds after its first period, joined by single spaces."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[k] for k in np.flatnonzero(~gone).tolist()]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and the ``collapsed`` text of every row of ``docs`` (``doc_id``, ``text``)."""
    if exponent < EXPONENT:
        raise ValueError("a run of fewer than three periods may hold no whole window and its copy")

    def group(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        coded = [np.array([numbers.setdefault(w, len(numbers)) for w in t], np.int64) for t in texts]
        runs = runs_of(coded, min_words, exponent)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], _RUNS_TYPE),
             pa.array([_collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = (text.as_py() or "").encode()
                keys.append(key)
                texts.append(data.split())  # bytes split at these six white characters and no others
                size += len(data)
                if size > TOGETHER:
                    yield group(keys, texts)
                    keys, texts, size = [], [], 0
        if keys:
            yield group(keys, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """The contract's texts: every tenth key's words repeat from some word on. A null key counts as empty text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_h", F.expr("crc32(cast(coalesce(cast(doc_id as string), '') as binary))"))
    chosen = "_h % 10 = 0"
    words = rf"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
    cut = rows.selectExpr("doc_id", "text", "_h div 10 as g", f"case when {chosen} and text is not null then {words} end as w", "size(w) as n")
    where = cut.selectExpr("doc_id", "text", "w", "n", "cast(g % nullif(n, 0) as int) as a", "cast(g % 8 as int) as e")
    where = where.selectExpr("*", "cast(1 + (n - a) div (3 + e) as int) as p")
    again = "flatten(array_repeat(slice(w, a + 1, p), cast((n - a + p - 1) div p as int)))"
    return where.selectExpr("doc_id", f"case when n > 0 then concat_ws(' ', slice(concat(slice(w, 1, a), {again}), 1, n)) else text end as text")


def digest(found: DataFrame) -> DataFrame:
    best = "aggregate(runs, cast(null as " + RUN + "), (b, r) -> case when b is null or r.length * b.period > b.length * r.period then r else b end)"
    listed = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    return found.selectExpr("doc_id", "cast(size(runs) as long) as n_runs", f"{best} as best", f"sha2({listed}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256").selectExpr(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", "1000 * best.length div best.period as exponent_milli", "runs_sha256", "collapsed_sha256")


def op11_periodic(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    return digest(periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
