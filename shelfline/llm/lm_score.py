"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is the trie of all byte contexts up to ``ORDER`` in the training texts,
with escapes by method C and symbol exclusion, pretrained on the whole corpus; a
document's score is its accumulated log10 code length, the end included.

1. Documents are compressed into chunks of about ``CHUNK_BYTES``, one row each.
2. A chunk sends its distinct n-grams (a context and its next byte) with their
   training counts, and its distinct words likewise, to buckets by hash; these add
   up the counts of all chunks. So what is gathered follows the corpus.
3. Summed n-grams meet by the last two bytes of their context. All longer contexts
   with that end lie in one bucket, and the shorter ones fit one table of 256 x 256
   counts. The code length of an n-gram depends on nothing else, so it is worked
   out once for every distinct n-gram of the corpus.
4. Chunks get back the code lengths of their own n-grams and the counts of their
   own words, and score their documents. No task holds a whole model.

Null text counts as empty, which has one token, the end. Without training texts
all counts are 0 and the model is uniform. Rows repeated with one key are scored
and counted one by one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import LOWER, materialise, mix, prefix_hash, span_hash, utf8_parts, word_spans

ORDER = 5
CHUNK_BYTES = 24 << 20
#: Bytes that no UTF-8 text holds stand for what is before a text and for its end.
BEFORE, END = 0xFE, 0xFF
FOLDS, HELD_OUT = 7, 2
#: N-grams or words that a bucket should hold.
BUCKET_ROWS = 4_000_000
_END_WORD = np.uint64(1)


def _press(values: np.ndarray) -> bytes:
    """Whole numbers compressed byte plane by byte plane: the upper ones are nearly constant."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpress(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _codes(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpress(blob), dtype=np.uint64)


def _blob(codes: np.ndarray) -> bytes:
    """Ascending codes, as their steps."""
    return _press(np.diff(codes, prepend=np.uint64(0)))


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, and at the end, of each text; and the bounds of the texts among them."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.full(len(data) + (ORDER + 1) * n, BEFORE, np.uint8)
    row = np.repeat(np.arange(n), size)
    padded[np.arange(len(data)) + (ORDER + 1) * row + ORDER] = data
    ends = offsets[1:] + (ORDER + 1) * np.arange(n) + ORDER
    padded[ends] = END
    code = np.zeros(len(padded), np.uint64)
    wide = padded.astype(np.uint64)
    for k in range(ORDER + 1):
        code[k:] |= wide[: len(wide) - k] << np.uint64(8 * k)
    keep = np.ones(len(padded), bool)
    keep[(ends[:, None] - size[:, None] - 1 - np.arange(ORDER)).ravel()] = False
    return code[keep], np.concatenate([[0], np.cumsum(size + 1)])


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, the end not among them, and the row of each."""
    lower = LOWER[data]
    start, end, row = word_spans(lower, offsets)
    return span_hash(prefix_hash(lower), start, end), row


class CodeMap:
    """Values by 64-bit code, open addressing, whole arrays at a time."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, default):
        bits = max(4, int(2 * len(codes)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.codes, self.used = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, bool)
        self.values, self.default = np.full(1 << bits, default, values.dtype), default
        left, slot = np.arange(len(codes)), (mix(codes) >> self.shift).astype(np.int64)
        while len(left):
            free = ~self.used[slot]
            self.codes[slot[free]] = codes[left[free]]
            self.used[slot[free]] = True
            placed = self.codes[slot] == codes[left]
            self.values[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        slot = (mix(codes) >> self.shift).astype(np.int64)
        out = self.values[slot]
        open_ = np.flatnonzero((self.codes[slot] != codes) | ~self.used[slot])
        slot = slot[open_]
        while len(open_):
            used, same = self.used[slot], self.codes[slot] == codes[open_]
            out[open_[~used]] = self.default
            hit = used & same
            out[open_[hit]] = self.values[slot[hit]]
            go = used & ~same
            open_, slot = open_[go], (slot[go] + 1) & self.mask
        return out


def _chunks(chunk_bytes: int):
    """Rows packed into one compressed row for about ``chunk_bytes`` of text."""

    def run(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for b in held:
                    out.write_batch(b)
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + number], pa.int64()), pa.array([press.compress(sink.getvalue())], pa.binary())], names=["chunk", "rows"])

        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                some = batch.slice(a, 200)
                held.append(some)
                # Bytes of this slice, whatever buffers it shares.
                size += sum(len(t or "") for t in some.column("text").to_pylist())
                if size >= chunk_bytes:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    return run


def _opened(blob: bytes) -> pa.Table:
    import zstandard

    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)).read_all()


def _add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(codes) == 1:
        return codes[0], counts[0]
    every, number = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every)
    every, number = every[order], number[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(number, first) if len(first) else number


def _counted(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with the number of them that are for training."""
    distinct, counts = np.unique(codes[train], return_counts=True)
    rest = np.unique(codes[~train])
    return _add_up([distinct, rest], [counts, np.zeros(len(rest), np.int64)])


def _send(buckets: int):
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                table = _opened(blob)
                train = ~table.column("held_out").to_numpy()
                found = [[], []], [[], []]
                for first, data, offsets in utf8_parts(table.column("text")):
                    some = train[first : first + len(offsets) - 1]
                    grams, bounds = gram_codes(data, offsets)
                    words, row = word_codes(data, offsets)
                    for kind, codes, mine in ((0, grams, np.repeat(some, np.diff(bounds))), (1, words, some[row])):
                        c, n = _counted(codes, mine)
                        found[kind][0].append(c)
                        found[kind][1].append(n)
                        if len(found[kind][0]) > 8:
                            found[kind][0][:], found[kind][1][:] = zip(_add_up(*found[kind]), strict=True)
                found[1][0].append(np.array([_END_WORD]))
                found[1][1].append(np.array([train.sum()]))
                for kind in (0, 1):
                    if not found[kind][0]:
                        continue
                    codes, counts = _add_up(*found[kind])
                    bucket = (mix(codes) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    cut = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
                    rows = [(2 * k + kind, chunk, kind, _blob(codes[order[a:b]]), _press(counts[order[a:b]])) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SENT_TYPES, strict=True)], names=SENT_NAMES)

    return run


SENT_NAMES = ["bucket", "chunk", "kind", "codes", "counts"]
SENT_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
SENT = "bucket int, chunk long, kind int, codes binary, counts binary"


def _sum_bucket(table: pa.Table) -> pa.Table:
    """The bucket's totals; n-grams split by the last two bytes of their context."""
    kind = table.column("kind")[0].as_py()
    parts = [_codes(x) for x in table.column("codes").to_pylist()]
    codes, counts = _add_up(parts, [_unpress(x).astype(np.int64) for x in table.column("counts").to_pylist()])
    bucket = table.column("bucket")[0].as_py()
    pair = ((codes >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64) if not kind else np.zeros(len(codes), np.int64)
    order = np.argsort(pair, kind="stable")
    codes, counts, pair = codes[order], counts[order], pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    rows = [(bucket, int(pair[a]), kind, _blob(codes[a:b]), _press(counts[a:b]), int((counts[a:b] > 0).sum()), int(counts[a:b].sum())) for a, b in zip(first, np.append(first[1:], len(pair)), strict=True)]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(
        ("bucket", "pair", "kind", "codes", "counts", "known", "total"), zip(*rows, strict=True),
        (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)})


SUMS = "bucket int, pair long, kind int, codes binary, counts binary, known long, total long"


def _pairs(batches):
    """Training counts by the last context byte and the next."""
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for codes, number in zip(batch.column("codes").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            counts += np.bincount((_codes(codes) & np.uint64(0xFFFF)).astype(np.int64), _unpress(number), 1 << 16).astype(np.int64)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["pair", "n"])


def code_lengths(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each n-gram after its context.

    ``codes`` are all n-grams whose contexts share their last two bytes, ``counts``
    their training counts, ``pairs`` the 256 x 256 training counts of byte pairs.
    """
    here, steps = codes, []  # from the longest context down: counts, context of each, totals, kinds, place of each original
    at = np.arange(len(codes))
    for order in range(ORDER, 1, -1):
        if order < ORDER:
            here, inverse = np.unique(here & np.uint64((1 << (8 * (order + 1))) - 1), return_inverse=True)
            counts = np.bincount(inverse, counts, len(here))
            up, at = inverse, inverse[at]
        else:
            up = None
        _, context = np.unique(here >> np.uint64(8), return_inverse=True)
        steps.append((counts, context, at, up))
    # Counts by order, with those of the two shortest contexts read from the table.
    result, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    skipped, skipped_kinds = np.zeros(len(codes)), np.zeros(len(codes))
    last = (codes & np.uint64(0xFF)).astype(np.int64)
    before = ((codes >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
    single = pairs.sum(0)
    for k in range(ORDER + 1):
        if k < len(steps):
            number, context, place, _ = steps[k]
            total, kinds = np.bincount(context, number), np.bincount(context, number > 0)
            mine, group = number[place], context[place]
            total, kinds = total[group], kinds[group]
            if k + 1 < len(steps):
                lower = steps[k + 1][0][steps[k + 1][3]]  # the same bytes after a context shorter by one
            else:
                kept = codes_at(codes, place, len(number))
                lower = pairs[(kept >> np.uint64(8) & np.uint64(0xFF)).astype(np.int64), (kept & np.uint64(0xFF)).astype(np.int64)]
            below = np.bincount(context, np.where(number > 0, lower, 0))[group]
        elif k == len(steps):
            mine, total, kinds = pairs[before, last], pairs.sum(1)[before], (pairs > 0).sum(1)[before]
            below = np.where(pairs > 0, single[None], 0).sum(1)[before]
        else:
            mine, total, kinds, below = single[last], np.full(len(codes), single.sum()), np.full(len(codes), (single > 0).sum()), 0
        rest, symbols = total - skipped, kinds - skipped_kinds
        live = open_ & (rest > 0)
        found = live & (mine > 0)
        result[found] += np.log10(mine[found] / (rest + symbols)[found])
        escape = live & ~found
        result[escape] += np.log10(symbols[escape] / (rest + symbols)[escape])
        open_ &= ~found
        skipped, skipped_kinds = below, kinds
    result[open_] -= np.log10(max(1, 256 - int((single > 0).sum())))
    return result


def codes_at(codes: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """One original code for each shortened one."""
    out = np.zeros(n, np.uint64)
    out[place] = codes
    return out


def _score(table: pa.Table, stats: pa.Table, train_tokens: int, vocabulary: int):
    known: dict[int, tuple[list, list]] = {0: ([], []), 1: ([], [])}
    for kind, codes, values in zip(stats.column("kind").to_pylist(), stats.column("codes").to_pylist(), stats.column("numbers").to_pylist(), strict=True):
        known[kind][0].append(_codes(codes))
        known[kind][1].append(np.frombuffer(values, "<f4") if not kind else _unpress(values).astype(np.int64))
    none = np.zeros(0, np.uint64)
    grams = CodeMap(np.concatenate([none, *known[0][0]]), np.concatenate([np.zeros(0, np.float32), *known[0][1]]), np.float32(0))
    words = CodeMap(np.concatenate([none, *known[1][0]]), np.concatenate([np.zeros(0, np.int64), *known[1][1]]), 0)
    ends = int(words[np.array([_END_WORD])][0])
    bottom = np.log10(train_tokens + vocabulary + 1)
    n_tokens, n_known, base, score = [], [], [], []
    for _, data, offsets in utf8_parts(table.column("text")):
        n = len(offsets) - 1
        codes, bounds = gram_codes(data, offsets)
        score.append(np.add.reduceat(grams[codes].astype(float), bounds[:-1]))
        codes, row = word_codes(data, offsets)
        count = words[codes]
        n_tokens.append(np.bincount(row, minlength=n) + 1)
        n_known.append(np.bincount(row, count > 0, n).astype(np.int64) + (ends > 0))
        base.append(np.bincount(row, np.log10(count + 1) - bottom, n) + np.log10(ends + 1) - bottom)
    kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    parts = {k: pa.array(np.concatenate(v), kinds[k]) for k, v in zip(kinds, (n_tokens, n_known, base, score), strict=True)}
    tokens = pa.array(np.full(table.num_rows, train_tokens), pa.int64())
    return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": parts["n_tokens"], "n_known": parts["n_known"], "train_tokens": tokens, "base_score": parts["base_score"], "score": parts["score"]})


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, held_out=None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every document.

    ``held_out`` is a boolean column of ``docs``: rows that the model may not learn from.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    chunks = materialise(texts.mapInArrow(_chunks(chunk_bytes), "chunk long, rows binary"), "chunks")
    bytes_ = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(8, -(-bytes_ // (16 * BUCKET_ROWS)))
    sent = materialise(chunks.mapInArrow(_send(buckets), SENT), "sent")
    sums = materialise(sent.groupBy("bucket").applyInArrow(_sum_bucket, SUMS), "sums")
    facts = sums.where("kind = 1").agg(F.sum("total").alias("tokens"), F.sum("known").alias("words")).first()
    train_tokens, vocabulary = facts["tokens"] or 0, facts["words"] or 0
    pairs = np.zeros(1 << 16)
    for r in sums.where("kind = 0").select("codes", "counts").mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] = r["n"]  # at most 256 x 256 rows
    table = spark.sparkContext.broadcast(pairs.reshape(256, 256))

    def lengths(group: pa.Table) -> pa.Table:
        codes = [_codes(x) for x in group.column("codes").to_pylist()]
        every = np.concatenate(codes)
        order = np.argsort(every)
        counts = np.concatenate([_unpress(x) for x in group.column("counts").to_pylist()]).astype(float)
        values = np.empty(len(every), "<f4")
        values[order] = code_lengths(every[order], counts[order], table.value)
        cut = np.cumsum([0] + [len(c) for c in codes])
        return pa.table({"bucket": group.column("bucket"), "codes": group.column("codes"), "numbers": pa.array([values[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    answers = sums.where("kind = 0").groupBy("pair").applyInArrow(lengths, "bucket int, codes binary, numbers binary")
    answers = answers.unionByName(sums.where("kind = 1").select("bucket", "codes", F.col("counts").alias("numbers")))

    def answer(asked: pa.Table, told: pa.Table) -> pa.Table:
        kind = asked.column("kind")[0].as_py() if asked.num_rows else 0
        codes = np.concatenate([np.zeros(0, np.uint64), *(_codes(x) for x in told.column("codes").to_pylist())])
        numbers = told.column("numbers").to_pylist()
        values = np.concatenate([np.zeros(0, "<u8"), *map(_unpress, numbers)] if kind else [np.zeros(0, "<f4"), *(np.frombuffer(x, "<f4") for x in numbers)])
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        own = [values[np.searchsorted(codes, _codes(x))] for x in asked.column("codes").to_pylist()]
        numbers = [_press(x) if kind else x.tobytes() for x in own]
        return pa.table({"chunk": asked.column("chunk"), "kind": asked.column("kind"), "codes": asked.column("codes"), "numbers": pa.array(numbers, pa.binary())})

    returned = sent.select("bucket", "chunk", "kind", "codes").groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(answer, "chunk long, kind int, codes binary, numbers binary")

    def score(rows: pa.Table, stats: pa.Table) -> pa.Table:
        found = [_score(_opened(blob), stats, train_tokens, vocabulary) for blob in rows.column("rows").to_pylist()]
        return pa.concat_tables(found)

    return chunks.groupBy("chunk").cogroup(returned.groupBy("chunk")).applyInArrow(score, SCORES)


def fold(key: str, folds: int):
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def op8_lm_score(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, fold("doc_id", FOLDS) == HELD_OUT)


def held_out_rows(keys: list) -> list[bool]:
    """The fold of plain Python keys, for tests."""
    return [k is not None and zlib.crc32(str(k).encode()) % FOLDS == HELD_OUT for k in keys]
