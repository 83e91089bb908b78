"""Exact removal of repeated byte strings by bucket-pointer refinement of sparse suffixes.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus. Suffixes are sorted into buckets only as deep as that:

1. Only suffixes at anchors are kept: the smallest q-gram hash among those in a
   string of ``LENGTH`` bytes. Equal strings have the same anchor, so nothing is
   lost, and about two anchors stand in ``LENGTH - q`` bytes. The q-gram at the
   anchor is its first bucket. Buckets of one suffix are done.
2. A bucket is refined by the bucket identifiers of the offsets that its strings
   reach: all strings with one anchor span a block of bytes, whose identifier is
   composed from those of its q-grams. Suffixes with the same block are repeated
   as a whole; one of them stays to represent the block.
3. Buckets with different blocks are refined again, in cells of ``CELL`` strings: a
   cell's new bucket is what all its strings share. Cells alone in their bucket are
   done, equal cells are repeated as a whole, and what is still open goes on.
4. That is refined once more, for every single string: the pair of the bucket at its
   start and the bucket q bytes on.

All steps are aggregates by identifier, so no bucket meets in one task. A bucket and
its refinement have 128 bits together. Null counts as empty; texts shorter than ``LENGTH``
keep all bytes. Rows repeated with one key are documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import in_blocks, materialise, mix, prefix_hash, shared_values, span_hash, text_bytes, unpack_shared, utf8_parts

#: Bytes of a repeated string, and strings of a cell between whole blocks and single strings.
LENGTH, CELL = 200, 16

#: Bytes of text that are hashed at once, and the bits of a hash that give way to a place in a window. They are the same
#: for all texts, so that equal strings have equal anchors wherever they stand.
WINDOW, PLACE_BITS = 1 << 18, np.uint64(20)

#: Text bytes of a block, and of the suffixes that a task counts.
BLOCK_BYTES, COUNTED_BYTES = 4 << 20, 16 << 20


def _in_window(data: np.ndarray, ends: np.ndarray, length: int):
    """Anchors of the strings of a window; ``ends`` holds the end of each byte's row."""
    q = length // 2
    w = length - q + 1
    n = len(data) - length + 1
    starts = np.arange(len(data) - q + 1)
    grams = span_hash(prefix_hash(data), starts, starts + q)
    value = ((grams >> PLACE_BITS) << PLACE_BITS) | starts.astype(np.uint64)
    fill = -len(value) % w
    tiles = np.concatenate([value, np.full(fill, 2**64 - 1, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
    string = np.flatnonzero(ends[:n] - starts[:n] >= length)
    own = (least[string] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(own != np.append(-1, own[:-1]))
    last = np.append(new[1:], len(own))[: len(new)] - 1
    return own[new], grams[own[new]], string[new], string[last]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Anchors of all strings of ``length`` bytes that lie in one row.

    Returns their places, bucket identifiers, and first and last string starts. A long
    text is taken in windows; an anchor whose strings start in two of them counts once.
    """
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for low in range(0, len(data) - length + 1, WINDOW):
        high = min(len(data), low + WINDOW + length - 1)
        ends = np.repeat(offsets[1:], np.diff(np.clip(offsets, low, high))) - low
        place, bucket, first, last = _in_window(data[low:high], ends, length)
        parts.append((place + low, bucket, first + low, last + low))
    place, bucket, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    new = np.flatnonzero(place != np.append(-1, place[:-1]))
    return place[new], bucket[new], first[new], last[np.append(new[1:], len(place))[: len(new)] - 1]


def _windows(data: np.ndarray, first: np.ndarray):
    """For the pieces in order of ``first`` that start in a window: which, the window's start, and its running hash."""
    for low in range(0, len(data), WINDOW):
        a, b = np.searchsorted(first, (low, low + WINDOW)).tolist()
        if b > a:
            yield slice(a, b), low, prefix_hash(data[low : low + WINDOW + 2 * LENGTH])


def _buckets_of(column: pa.Array):
    """The q-gram buckets of the anchors of each row."""
    for _, data, offsets in utf8_parts(column):
        place, bucket, _, _ = anchors(data, offsets)
        cut = np.searchsorted(place, offsets)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield bucket[a:b]


JUDGED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()), ("text", pa.binary()), *[(c, pa.list_(pa.int64())) for c in ("bucket", "block", "place", "first", "last")]])


def _judged(keys: pa.Array, data: np.ndarray, offsets: np.ndarray, known) -> pa.RecordBatch:
    """A run of rows with those anchors whose bucket holds several suffixes; the text only beside such anchors."""
    place, bucket, first, last = anchors(data, offsets)
    keep = known(bucket) > 1
    place, bucket, first, last = place[keep], bucket[keep], first[keep], last[keep]
    block = np.zeros(len(place), np.uint64)
    for some, low, running in _windows(data, first):
        block[some] = mix(span_hash(running, first[some] - low, last[some] - low + LENGTH) + (place[some] - first[some]).astype(np.uint64))
    cut = np.searchsorted(place, offsets)
    number = np.diff(cut)
    bodies = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    sha = [None if n else hashlib.sha256(body).hexdigest() for body, n in zip(bodies, number.tolist(), strict=True)]
    texts = [body if n else None for body, n in zip(bodies, number.tolist(), strict=True)]
    at = np.repeat(offsets[:-1], number)
    lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x)) for x in (bucket.view(np.int64), block.view(np.int64), place - at, first - at, last - at)]
    return pa.RecordBatch.from_arrays([keys, pa.array(np.diff(offsets)), pa.array(sha, pa.string()), pa.array(texts, pa.binary()), *lists], schema=JUDGED)


def _judge(docs: pa.Table, shared: pa.Table) -> pa.Table:
    known = unpack_shared(shared)
    runs = ((batch.column("doc_id").slice(k, len(offsets) - 1), data, offsets) for batch in docs.to_batches() for k, data, offsets in utf8_parts(batch.column("text")))
    return pa.Table.from_batches([_judged(*run, known) for run in runs], JUDGED)


#: Pieces or strings that a task hands on at once.
TOGETHER = 200_000


def _listed(column: pa.Array, names: tuple[str, ...]):
    """Per row the fields of a list of structs as arrays, without an object for each entry."""
    offsets, values = column.offsets.to_numpy().tolist(), column.values
    fields = [values.field(n).to_numpy(zero_copy_only=False) for n in names]
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield tuple(f[a:b] for f in fields)


def _pieces_of(batch: pa.RecordBatch):
    """The open pieces of each row by windows of its text: row, start and running hash of the window, fields as arrays."""
    fields = _listed(batch.column("open"), ("place", "first", "last", "alone"))
    for row, text, (place, first, last, alone) in zip(batch.column("row").to_pylist(), batch.column("text"), fields, strict=True):
        order = np.argsort(first, kind="stable")
        place, first, last, alone = place[order], first[order], last[order], alone[order]
        for some, low, running in _windows(np.frombuffer(text.as_buffer(), np.uint8), first):
            yield row, low, running, place[some] - low, first[some] - low, last[some] - low, alone[some]


def _in_parts(parts, names: list[str]):
    """Rows of equally long arrays as batches of about ``TOGETHER`` entries."""
    held, size = [], 0
    for arrays in parts:
        held.append(arrays)
        size += len(arrays[0])
        if size >= TOGETHER:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)


def _runs(size: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n of ``size``."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _cells(batches):
    """The cells of each open block: what all strings of a cell share, and what they span."""

    def of(row, low, running, place, first, last, alone):
        least, most = (place - last) // CELL, (place - first) // CELL
        size = most - least + 1
        cell = np.repeat(least, size) + _runs(size)
        place, first, last, alone = (np.repeat(x, size) for x in (place, first, last, alone))
        start = place - cell * CELL - CELL + 1  # of the first string of a whole cell
        shared = span_hash(running, start + CELL - 1, start + LENGTH) + mix(cell.astype(np.uint64))
        a, b = np.maximum(first, start), np.minimum(last, start + CELL - 1)
        span = mix(span_hash(running, a, b + LENGTH) + ((a - start) * CELL + (b - start)).astype(np.uint64))
        return np.full(len(a), row), place + low, a + low, b + low, alone, mix(shared).astype(np.int64), span.astype(np.int64)

    yield from _in_parts((of(*piece) for batch in batches for piece in _pieces_of(batch)), ["row", "place", "first", "last", "alone", "bucket", "block"])


def _strings(batches):
    """Each string of an open cell with its pair of identifiers."""
    q = LENGTH // 2

    def of(row, low, running, _, first, last, alone):
        size = last - first + 1
        start = np.repeat(first, size) + _runs(size)
        return (np.full(len(start), row), start + low, np.repeat(alone, size),
                span_hash(running, start, start + q).astype(np.int64), span_hash(running, start + q, start + LENGTH).astype(np.int64))

    yield from _in_parts((of(*piece) for batch in batches for piece in _pieces_of(batch)), ["row", "start", "alone", "b1", "b2"])


def _refined(pieces: DataFrame, suspects: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """One refinement of ``pieces`` (row, place, first, last, alone, bucket, block).

    Returns the spans of repeated pieces, and per row the text and the pieces that
    stay open: one of each block in the buckets that hold several. ``alone`` is 1
    where the piece is not known to be repeated.
    """
    blocks = pieces.groupBy("bucket", "block").agg(
        F.count("*").alias("many"), F.max("alone").alias("some"), F.min(F.struct("row", "place", "first", "last")).alias("one"))
    blocks = materialise(blocks, name)
    several = blocks.where("many > 1 and some = 1").select("bucket", "block")
    spans = pieces.where("alone = 1").join(several, ["bucket", "block"]).select("row", "first", (F.col("last") + LENGTH).alias("last"))
    alone = (F.col("many") == 1).cast("long") * F.col("some")
    open_ = blocks.groupBy("bucket").agg(F.count("*").alias("kinds"), F.max(alone).alias("some")).where("kinds > 1 and some = 1").select("bucket")
    left = blocks.withColumn("alone", alone).join(open_, "bucket").select("one.*", "alone")
    left = left.groupBy("row").agg(F.collect_list(F.struct("place", "first", "last", "alone")).alias("open"))
    return spans, left.join(suspects.select("row", "text"), "row").select("row", "text", "open")


#: Kept bytes that a task hands on at once.
KEPT_BYTES = 8 << 20


def _cut(batches):
    """Remove the union of the spans of each row."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        marked = _listed(batch.column("marked"), ("first", "last"))
        for key, n_bytes, text, (first, last) in zip(batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("text"), marked, strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            order = np.argsort(first, kind="stable")
            first, reach = first[order], np.maximum.accumulate(last[order])
            new = np.flatnonzero(first > np.append(-1, reach[:-1]))
            start, end = first[new], reach[np.append(new[1:], len(first))[: len(new)] - 1]
            step = np.zeros(len(data) + 1, np.int8)
            step[start], step[end] = 1, -1
            gone = np.cumsum(step[:-1], dtype=np.int8).view(bool)
            left = data[~gone].tobytes()
            spans = np.stack([start, end], 1).ravel()
            held.append((key, n_bytes, int(gone.sum()), len(spans) // 2, hashlib.sha256(left).hexdigest(), spans, left))
            size += len(left) + spans.nbytes
            if size > KEPT_BYTES:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"


def repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changed, whole): documents that may lose bytes, with ``spans`` (start, end, start, ...) and the ``kept`` bytes; and those that lose none."""
    total = text_bytes(docs)
    rows, _ = in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), total, BLOCK_BYTES)
    shared = shared_values(rows, -(-total // COUNTED_BYTES) or 1, _buckets_of)
    judged = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _judge, "doc_id long, n_bytes long, sha string, text binary, bucket array<long>, block array<long>, place array<long>, first array<long>, last array<long>")
    judged = materialise(judged.withColumn("row", F.monotonically_increasing_id()), "anchors")
    suspects = judged.where("text is not null")
    suffixes = suspects.select("row", F.explode(F.arrays_zip("bucket", "block", "place", "first", "last")).alias("s")).select("row", "s.*", F.lit(1).cast("long").alias("alone"))
    as_blocks, left = _refined(suffixes, suspects, "blocks")
    cells = materialise(left.mapInArrow(_cells, "row long, place long, first long, last long, alone long, bucket long, block long"), "cells")
    as_cells, left = _refined(cells, suspects, "cell-blocks")
    strings = materialise(left.mapInArrow(_strings, "row long, start long, alone long, b1 long, b2 long"), "strings")
    twice = strings.groupBy("b1", "b2").agg(F.count("*").alias("many"), F.max("alone").alias("any")).where("many > 1 and any = 1").select("b1", "b2")
    as_strings = strings.where("alone = 1").join(twice, ["b1", "b2"]).select("row", F.col("start").alias("first"), (F.col("start") + LENGTH).alias("last"))

    marked = as_blocks.union(as_cells).union(as_strings).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("marked"))
    changed = suspects.select("row", "doc_id", "n_bytes", "text").join(marked, "row", "left").select("doc_id", "n_bytes", "text", "marked").mapInArrow(_cut, CUT)
    whole = judged.where("text is null").select("doc_id", "n_bytes", F.col("sha").alias("kept_sha256"))
    return changed, whole


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    changed, whole = repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    zero = F.lit(0).cast("long")
    return changed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(
        whole.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256"))
