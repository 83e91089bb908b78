"""Shared pieces: vectorised text hashing, blocks of documents, and connected components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import session

#: Words of a shingle, and the least similarity of near duplicates in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 75

_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_WORD_FACTORS = _RNG.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


CLEAN_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that a task hands to Python at once.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def materialise(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """A written table in the shared folder; the shuffle files it took are removed with the write."""
    conf = df.sparkSession.conf
    wanted = {CLEAN_SHUFFLE: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {key: conf.get(key) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        return session.materialise(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def carried(docs: DataFrame, **named) -> DataFrame:
    """``text``, the ``named`` columns, and all other columns of ``docs`` as one struct, whose names clash with none here."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.lit(True))
    return docs.select("text", others.alias("_others"), *[column.alias(name) for name, column in named.items()])


def unpacked(columns: list[str], text, others: str = "_others") -> list:
    """The columns of a carried table in their order, with ``text`` as given."""
    return [(F.col(text) if isinstance(text, str) else text).alias(c) if c == "text" else F.col(others)[c].alias(c) for c in columns]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def prefix_hash_of(codes: np.ndarray) -> np.ndarray:
    """Running polynomial hash of 64-bit codes; ``span_hash`` reads any span from it."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _powers(len(codes) + 1)[0][: len(codes)], out=out[1:])
    return out


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes."""
    return prefix_hash_of(_BYTE_CODES[data])


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from ``start`` to ``end``, the same wherever they stand."""
    return mix((running[end] - running[start]) * _powers(len(running))[1][start])


def utf8_parts(column: pa.Array, limit: int = 1 << 18):
    """Yield (first row, bytes, offsets) for runs of rows of about ``limit`` bytes; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset :][: len(column) + 1].astype(np.int64)
    if not len(column):
        return
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word ``[^\\x20\\x09-\\x0D]+`` (or as ``breaks`` says); words do not cross rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~breaks[data]
    edge = inside[1:] != inside[:-1]
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    # A row that begins inside a word splits it.
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingle_runs(column: pa.Array, words: int = SHINGLE_WORDS):
    """Yield (first row, hashes, row of each hash) of the word shingles of runs of rows, in text order.

    A-Z count as a-z. A row with fewer words gives its whole sequence as one
    shingle, a row without words none.
    """
    for first, data, offsets in utf8_parts(column):
        data = LOWER[data]
        start, end, row = word_spans(data, offsets)
        word = span_hash(prefix_hash(data), start, end)
        bounds = np.searchsorted(row, np.arange(len(offsets)))
        number = np.diff(bounds)
        total = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for k in range(words):
            total += word[k : k + len(total)] * _WORD_FACTORS[k]
        whole = row[: len(total)] == row[words - 1 :] if len(total) else np.zeros(0, bool)
        hashes, rows = mix(total[whole] + np.uint64(words)), row[: len(total)][whole]
        if len(short := np.flatnonzero((number > 0) & (number < words))):
            extra = [np.sum(word[bounds[r] : bounds[r + 1]] * _WORD_FACTORS[: number[r]]) + np.uint64(number[r]) for r in short]
            hashes, rows = np.concatenate([hashes, mix(np.array(extra, np.uint64))]), np.concatenate([rows, short])
            order = np.argsort(rows, kind="stable")
            hashes, rows = hashes[order], rows[order]
        yield first, hashes, rows, len(number)


def shingle_hashes(column: pa.Array, words: int = SHINGLE_WORDS):
    """Yield per row the sorted distinct hashes of its word shingles."""
    for _, hashes, rows, number in shingle_runs(column, words):
        bounds = np.searchsorted(rows, np.arange(number + 1)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(hashes[a:b])


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column: one cheap job that sizes blocks."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def in_blocks(docs: DataFrame, total: int, target: int = 8 << 20, column: str = "text") -> tuple[DataFrame, int]:
    """Deal rows to blocks of about ``target`` text bytes, one shuffle, by hash of key and text.

    There are two at least: behind a single partition Spark needs no further shuffle, and one task
    would hold the Python workers of all steps that follow.
    """
    n = max(2, math.ceil(total / target))
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", column), F.lit(n)).cast("int")).repartition(n, "block"), n


def binary_column(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


#: Bits of the hashes by which values are counted; a clash only makes a value look shared.
COUNT_BITS = 40
_COUNT_SHIFT = np.uint64(64 - COUNT_BITS)


def _low_bytes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _pack(values: np.ndarray) -> bytes:
    """Sorted values as three-byte steps, or in full where a step is too wide for that."""
    steps = np.diff(values)
    if len(steps) and steps.max() < 1 << 24:
        return b"s" + _low_bytes(values[:1], 5) + _low_bytes(steps, 3)
    return b"w" + _low_bytes(values, 5)


def _unpack(blob: bytes) -> np.ndarray:
    def read(data, width):
        out = np.zeros((len(data) // width, 8), np.uint8)
        out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
        return out.view("<u8").ravel()

    blob = memoryview(blob)
    if blob[:1] == b"w":
        return read(blob[1:], 5)
    return np.cumsum(np.concatenate([read(blob[1:6], 5), read(blob[6:], 3)]), dtype=np.uint64)


def _send_values(buckets: int, values_of):
    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def flush():
            for block in list(held):
                values = np.concatenate(held.pop(block))
                values.sort()
                first = np.flatnonzero(np.append(np.ones(len(values[:1]), bool), values[1:] != values[:-1]))
                counts = np.minimum(np.diff(np.append(first, len(values))), 255).astype(np.uint8)
                values = values[first]
                cut = np.searchsorted(values, (np.arange(buckets + 1) * (2.0**COUNT_BITS / buckets)).astype(np.uint64))
                cut[-1] = len(values)
                spans = [(k, a, b) for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in spans], pa.int32()), pa.array([block] * len(spans), pa.int32()),
                     pa.array([_pack(values[a:b]) for _, a, b in spans], pa.binary()), binary_column([counts[a:b] for _, a, b in spans])],
                    names=["bucket", "block", "packed", "counts"])

        for batch in batches:
            for block, values in zip(batch.column("block").to_pylist(), values_of(batch.column("text")), strict=True):
                held.setdefault(block, []).append(values >> _COUNT_SHIFT)
                size += len(values)
            if size > 4_000_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    return run


def _count_bucket(table: pa.Table) -> pa.Table:
    """Send back the values of the bucket that occur twice or more, with their number."""
    values = np.concatenate([_unpack(x.as_buffer()) for x in table.column("packed")])
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("counts")])
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    del ordered
    number = np.diff(np.append(first, len(values)))
    sums = np.minimum(np.add.reduceat(counts[order], first, dtype=np.int64), 255).astype(np.uint8)
    total = np.empty(len(values), np.uint8)
    total[order] = np.repeat(sums, number)
    del order, first, number
    rows, at = [], 0
    for block, sent in zip(table.column("block").to_pylist(), table.column("counts"), strict=True):
        here, part = total[at : at + len(sent.as_buffer())], values[at : at + len(sent.as_buffer())]
        at += len(part)
        if (keep := here > 1).any():
            rows.append((block, _pack(part[keep]), here[keep].tobytes()))
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "packed": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})


def shared_values(blocks: DataFrame, buckets: int, values_of) -> DataFrame:
    """Per block the hashes of its texts that occur twice or more in all blocks, with their number.

    Every block sends each of its values once to a bucket by value, so a value that
    all documents have costs a bucket one entry for each block.
    """
    sent = blocks.mapInArrow(  # all columns, so that both uses of the blocks share one exchange
        _send_values(buckets, values_of), "bucket int, block int, packed binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(_count_bucket, "block int, packed binary, counts binary")


def unpack_shared(shared: pa.Table):
    """A function from hashes to their numbers (255 at most) in all blocks; 1 for what only one has."""
    parts = [(_unpack(x.as_buffer()), np.frombuffer(y.as_buffer(), np.uint8)) for x, y in zip(shared.column("packed"), shared.column("counts"), strict=True)]
    parts.sort(key=lambda part: part[0][0])  # buckets hold ranges of hashes, so their values follow each other
    known = np.concatenate([*(values for values, _ in parts), np.array([2**64 - 1], np.uint64)])
    count = np.concatenate([*(counts for _, counts in parts), np.ones(1, np.uint8)])
    del parts
    if not (known[1:] > known[:-1]).all():  # a block that was sent in parts has some values twice
        known, at = np.unique(known, return_index=True)
        count = count[at]

    def number(values: np.ndarray) -> np.ndarray:
        short = values >> _COUNT_SHIFT
        place = np.searchsorted(known, short)
        return np.where(known[place] == short, count[place], np.uint8(1))

    return number


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of each node of ``edges`` (``a``, ``b`` longs): ``node``, ``label``.

    Labels spread over edges and then jump to the label of their label, so the
    rounds grow with the logarithm of a component's diameter. Each round is a
    written table. No edge stays on one task: the join splits hot nodes.
    """
    edges = materialise(edges.where("a <> b").distinct(), "edges")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("up"))
        moved = materialise(
            spread.join(jump, F.col("label") == F.col("at"), "left").select("node", F.least("label", "up").alias("label"), (F.least("label", "up") != F.col("old")).alias("moved")),
            "labels")
        labels = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return labels
