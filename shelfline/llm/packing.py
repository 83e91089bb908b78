"""Packing of token sequences: shortest pack first over the length histogram.

1. Every document is tokenised once. Documents longer than a sequence are cut at
   multiples of its length. The pieces with their ids are written as a table, each
   with its number among the pieces of the same length in its partition.
2. The histogram of piece lengths has at most one entry for each token of a
   sequence, whatever the corpus. On it the driver places lengths longest first,
   each into the emptiest open pattern that has room, and updates the counts of
   the patterns.
3. Counts by length and partition give every piece its rank among all pieces of
   its length, without sorting pieces; patterns own ranges of ranks, so the rank
   names the sequence and the offset.

Null text counts as empty: one piece with the end id alone. Rows repeated with one
key are packed one by one. A pattern never splits a piece.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import materialise


SEQUENCE, END_ID = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: Words and parts of words that a Python worker remembers.
CACHED_WORDS = 600_000
#: Characters that str.split takes for white space and the tokenizer does not, and the start of a special token.
_ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")

PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of words, as bytes, remembered for the words and for their parts.

    The tokenizer lower-cases, drops white space and splits words into runs of
    letters, single digits and runs of the rest; nothing joins across these. So
    unknown words are split here and only unknown parts go through its merges.
    Words with characters beyond ``LAST`` go through the whole tokenizer. A part has
    the ids it would have as a word, so both share one memory, which drops its older
    half when full.
    """

    # The tokenizer's own split, for lower-cased text up to LAST.
    LAST = "\u017f"
    LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
    DIGITS = "0-9²³¹¼-¾"
    PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.old_words = {}, {}
        # Byte-level vocabularies write each byte as a visible character.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.shown = {i: chr(i) if i in shown else chr(next(hidden)) for i in range(256)}

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(self.words) > CACHED_WORDS // 2:
            self.old_words, self.words = self.words, {}
        self.words[text] = ids
        return ids

    def _part(self, part: str) -> bytes:
        ids = self.words.get(part)
        if ids is None:
            ids = self.old_words.get(part)
            if ids is None:
                text = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.shown)
                ids = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
            self._keep(part, ids)
        return ids

    def __call__(self, word: str) -> bytes:
        ids = self.old_words.get(word)
        if ids is None:
            if not word.isascii() and max(word) > self.LAST:
                ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                low = word.lower()
                ids = self._part(low) if low.isalpha() else b"".join([self._part(x) for x in self.PARTS.findall(low)])
                if word == low and low.isalpha():
                    return ids
        return self._keep(word, ids)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if any(o in text for o in _ODD):
            return self.whole(text)
        known = self.words
        return b"".join([known.get(w) or self(w) for w in text.split()])


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of whole texts, without special tokens."""
    ids = word_ids(path)
    return [np.frombuffer(ids.of(t), "<u4") for t in texts]


def _pieces(path: str, sequence: int, end_id: int):
    def run(batches):
        part, seen = TaskContext.get().partitionId(), {}
        kind = "<u2" if max(word_ids(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                some = batch.slice(a, 500)
                texts = [t or "" for t in some.column("text").to_pylist()]
                rows = []
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), token_ids(texts, path), strict=True):
                    ids = np.append(ids, end_id).astype(kind)
                    for start in range(0, len(ids), sequence):
                        piece = ids[start : start + sequence]
                        rank = seen.get(len(piece), 0)
                        seen[len(piece)] = rank + 1
                        rows.append((doc_id, start, len(piece), len(ids), part, rank, piece.tobytes()))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "doc_tokens", "part", "rank", "ids"])
        word_ids.cache_clear()  # the worker may go on to other steps, which need the memory

    return run


def pack_histogram(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (number of sequences, [(length, copies), ...]) that hold every length of the histogram."""
    heap: list = []  # (used, age, count, contents): the emptiest open pattern is on top
    done, age = [], 0

    def keep(used, count, contents):
        nonlocal age
        age += 1
        if used == sequence:
            done.append((count, contents))
        else:
            heapq.heappush(heap, (used, age, count, contents))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= sequence:
                used, _, count, contents = heapq.heappop(heap)
                taken = min(count, left)
                if count > taken:
                    keep(used, count - taken, contents)
                last = contents[-1]
                more = [*contents[:-1], (length, last[1] + 1)] if last[0] == length else [*contents, (length, 1)]
                keep(used + length, taken, more)
                left -= taken
            else:
                copies = min(left, sequence // length)
                keep(copies * length, left // copies, [(length, copies)])
                left %= copies
    return done + [(count, contents) for _, _, count, contents in heap]


class Plan:
    """Ranges of ranks by length: where the pieces of a length go."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]]):
        following: dict[int, int] = {}
        rows, sequence_id = [], 0
        for count, contents in patterns:
            offset = 0
            for length, copies in contents:
                rank = following.get(length, 0)
                following[length] = rank + count * copies
                rows.append((length, rank, copies, sequence_id, offset))
                offset += length * copies
            sequence_id += count
        rows.sort()
        self.length, self.rank, self.copies, self.sequence, self.offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.key = (self.length << 48) | self.rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) | rank, "right") - 1
        number = rank - self.rank[at]
        return self.sequence[at] + number // self.copies[at], self.offset[at] + number % self.copies[at] * length


def pack(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (little-endian unsigned 32-bit)."""
    path = path or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(path, sequence, end_id), "doc_id long, start long, length long, doc_tokens long, part int, rank long, ids binary")
    pieces = materialise(rows, "pieces")
    counts = materialise(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row for each length at most
    if not histogram:
        return docs.sparkSession.createDataFrame([], PIECE)
    plan = docs.sparkSession.sparkContext.broadcast(Plan(pack_histogram(histogram, sequence)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select("doc_id", "start", "length", "doc_tokens", (F.col("base") + F.col("rank")).alias("rank"), "ids")

    def assign(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                length = batch.column("length").to_numpy()
                sequence_id, offset = plan.value.place(length, batch.column("rank").to_numpy())
                ids = [np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("<u4").tobytes() for x, n in zip(batch.column("ids").to_pylist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("start"), batch.column("length"), batch.column("doc_tokens"), pa.array(sequence_id), pa.array(offset), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return ranked.mapInArrow(assign, PIECE)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))
