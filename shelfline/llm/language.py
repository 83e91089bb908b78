"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads ``STRIDE`` bytes a step in both directions, in segments of
``STEPS`` steps, and labels every byte from the two states around it and the byte
itself. A document's probabilities are the mean over all its bytes, however long
it is. It is trained in numpy by backpropagation through time (Adam) on a bounded
sample: at most about ``DOCS_PER_LABEL`` documents of each language, drawn by hash
of the key, and ``SEGMENTS_PER_DOC`` segments of each.

Only text and label of training rows are used, and only the text of a row that is
predicted. Null text and text without a letter give ``und`` with score 0, as does
everything if no row has a label. Rows repeated with one key are predicted one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import utf8_parts
from shelfline.llm.lm_score import fold

STRIDE, STEPS, HIDDEN = 4, 32, 16
DOCS_PER_LABEL, SEGMENTS_PER_DOC = 400, 6
ROUNDS, BATCH, RATE = 240, 192, 0.01
FOLDS, HELD_OUT = 4, 2
SEGMENT = STRIDE * STEPS


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into rows of ``SEGMENT`` bytes: bytes (0 after the end), used bytes and text of each row."""
    size = np.diff(offsets)
    number = -(-size // SEGMENT)
    row = np.repeat(np.arange(len(size)), number)
    within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    used = np.minimum(SEGMENT, size[row] - within * SEGMENT)
    at = (offsets[row] + within * SEGMENT)[:, None] + np.arange(SEGMENT)
    live = np.arange(SEGMENT) < used[:, None]
    return np.where(live, data[np.minimum(at, max(0, len(data) - 1))] if len(data) else 0, 0).astype(np.uint8), used, row


class Network:
    """Weights and passes of the network; gates are update, reset, candidate."""

    def __init__(self, labels: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        n, h = len(labels), HIDDEN
        self.labels = labels
        self.w = {}
        for side in "fb":
            self.w["in" + side] = rng.normal(0, 0.2, (STRIDE * 256, 3 * h))
            self.w["re" + side] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
            self.w["bias" + side] = np.zeros(3 * h)
            self.w["out" + side] = rng.normal(0, 1 / np.sqrt(h), (h, n))
        self.w["byte"] = np.zeros((STRIDE * 256, n))
        self.w["bias"] = np.zeros(n)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    @staticmethod
    def _index(x: np.ndarray) -> np.ndarray:
        """Rows of the input tables: step, segment, place within the step."""
        return x.reshape(len(x), STEPS, STRIDE).transpose(1, 0, 2) + 256 * np.arange(STRIDE)

    def _run(self, index: np.ndarray, side: str, keep: bool = False):
        """States of one direction, by step; with ``keep`` also what the way back needs."""
        table, recur, bias = self.w["in" + side], self.w["re" + side], self.w["bias" + side]
        h = np.zeros((index.shape[1], HIDDEN), np.float32)
        states, kept = np.empty((STEPS, index.shape[1], HIDDEN), np.float32), []
        for t in range(STEPS) if side == "f" else range(STEPS - 1, -1, -1):
            x = table[index[t, :, 0]] + bias
            for k in range(1, STRIDE):
                x += table[index[t, :, k]]
            u = h @ recur
            gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            if keep:
                kept.append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
            h = c + z * (h - c)
            states[t] = h
        return states, kept

    def _logits(self, index, forward, backward):
        """By step, segment, place and label."""
        step = forward @ self.w["outf"] + backward @ self.w["outb"] + self.w["bias"]
        return step[:, :, None] + self.w["byte"][index]

    def probabilities(self, x: np.ndarray, used: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Mean label probabilities of the bytes of each of ``n`` texts."""
        total = np.zeros((n, len(self.labels)))
        for a in range(0, len(x), 1024):
            index = self._index(x[a : a + 1024])
            logits = self._logits(index, self._run(index, "f")[0], self._run(index, "b")[0])
            p = np.exp(logits - logits.max(-1, keepdims=True))
            p /= p.sum(-1, keepdims=True)
            live = (np.arange(SEGMENT) < used[a : a + 1024, None]).reshape(-1, STEPS, STRIDE).transpose(1, 0, 2)
            each = np.einsum("tsk,tskl->sl", live.astype(np.float32), p)
            for k in range(len(self.labels)):
                total[:, k] += np.bincount(row[a : a + 1024], each[:, k], n)
        return total / np.maximum(total.sum(1, keepdims=True), 1e-9)

    def gradients(self, x: np.ndarray, used: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
        """Backpropagation through time of the mean cross entropy over bytes."""
        index = self._index(x)
        states, kept = zip(*(self._run(index, side, True) for side in "fb"), strict=True)
        logits = self._logits(index, *states)
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        live = (np.arange(SEGMENT) < used[:, None]).reshape(-1, STEPS, STRIDE).transpose(1, 0, 2)
        loss = -np.log(np.maximum(p[:, np.arange(len(y)), :, y].transpose(1, 0, 2), 1e-9))[live].mean()
        p[:, np.arange(len(y)), :, y] -= 1
        d = (p * live[..., None] / live.sum()).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        np.add.at(g["byte"], index, d)
        step = d.sum(2)
        g["bias"] = step.sum((0, 1))
        for side, state, back in zip("fb", states, kept, strict=True):
            g["out" + side] = np.einsum("tsh,tsl->hl", state, step)
            above = step @ self.w["out" + side].T
            recur = self.w["re" + side]
            dh = np.zeros_like(above[0])
            for t, h, z, r, c, u in reversed(back):
                dh = dh + above[t]
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                dr = dc * u * r * (1 - r)
                dx = np.concatenate([dz, dr, dc], 1)
                du = np.concatenate([dz, dr, dc * r], 1)
                g["re" + side] += h.T @ du
                g["bias" + side] += dx.sum(0)
                for k in range(STRIDE):
                    np.add.at(g["in" + side], index[t, :, k], dx)
                dh = dh * z + du @ recur.T
        return g, float(loss)

    def train(self, x: np.ndarray, used: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> float:
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        by_label = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        loss = 0.0
        for t in range(1, rounds + 1):
            pick = np.concatenate([rng.choice(rows, max(1, BATCH // len(by_label))) for rows in by_label])
            g, loss = self.gradients(x[pick], used[pick], y[pick])
            rate = RATE * min(1, 2 * (1 - (t - 1) / rounds))
            for k in self.w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                self.w[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
        return loss


def _drawn_segments(per_doc: int):
    def run(batches):
        for batch in batches:
            for first, data, offsets in utf8_parts(batch.column("text")):
                x, used, row = segments(data, offsets)
                order = np.lexsort((np.random.default_rng(len(x)).random(len(x)), row))
                rank = np.arange(len(x)) - np.searchsorted(row[order], row[order])
                keep = np.sort(order[rank < per_doc])
                at = pa.array(first + row[keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("lang").take(at), pa.array([r.tobytes() for r in x[keep]], pa.binary()), pa.array(used[keep])], names=["doc_id", "lang", "bytes", "used"])

    return run


def fit(docs: DataFrame, docs_per_label: int = DOCS_PER_LABEL, rounds: int = ROUNDS) -> Network | None:
    """A network trained on a bounded sample of the labelled rows of ``docs`` (``doc_id``, ``text``, ``lang``); None without any."""
    rows = docs.where("lang is not null and text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, docs_per_label / n))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) <= share[F.col("lang")] * float(1 << 20))
    found = drawn.mapInArrow(_drawn_segments(SEGMENTS_PER_DOC), "doc_id long, lang string, bytes binary, used long").collect()
    found.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["bytes"]))
    labels = sorted({r["lang"] for r in found})
    if not labels:
        return None
    place = {k: i for i, k in enumerate(labels)}
    network = Network(labels)
    network.train(np.frombuffer(b"".join(r["bytes"] for r in found), np.uint8).reshape(-1, SEGMENT), np.array([r["used"] for r in found]), np.array([place[r["lang"]] for r in found]), rounds)
    return network


PREDICTED = "doc_id long, lang_pred string, score double"


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row, by whole texts."""
    handle = docs.sparkSession.sparkContext.broadcast(network)  # fixed size for a number of labels

    def run(batches):
        import regex

        letter, model = regex.compile(r"\p{L}"), handle.value
        for batch in batches:
            known = [t is not None and model is not None and bool(letter.search(t)) for t in batch.column("text").to_pylist()]
            label, score = ["und"] * len(known), [0.0] * len(known)
            for first, data, offsets in utf8_parts(batch.column("text")) if model else ():
                n = len(offsets) - 1
                p = model.probabilities(*segments(data, offsets), n)
                for k, (best, value) in enumerate(zip(p.argmax(1).tolist(), p.max(1).tolist(), strict=True)):
                    if known[first + k]:
                        label[first + k], score[first + k] = model.labels[best], min(1.0, value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(label, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PREDICTED)


def op6_language(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    network = fit(docs.where(~held_out))
    return predict(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
