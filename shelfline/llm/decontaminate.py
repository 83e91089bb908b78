"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item counts as contained in a document if the document has three quarters
of the item's word shingles. Items are partitioned by size. In each partition an
item is known by its bottom MinHash values: of n shingles the n - ceil(t n) + 1
with the smallest hashes, of which a document that contains the item must have at
least one. So the sketch loses nothing, however long the document is, and a
document meets only partitions of items that are small enough for its own size.
Documents with a sketch value of an item are verified by exact shingle containment.

An item of fewer words than a shingle is contained where its words follow each
other in the document. Documents give shingles of its length for that, and only if
there are such items; hits are verified by the words. A single common word is
contained in most documents: who does not want that leaves it out of the items.

The items are a stated query set: their sketches go to all tasks in blocks of a
checked size, and each block is one pass over the documents. The documents are
never shuffled.

Null, empty and wordless texts contain nothing and are contained in nothing. Items
repeated with one key, and documents repeated with one key, give a row each.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import SHINGLE_WORDS, SIMILARITY, binary_column, materialise, shingle_hashes, shingle_runs, utf8_parts, word_spans

#: Shingles of one block of items; 16 bytes each travel to every task.
BLOCK_SHINGLES = 1 << 20
_FILTER_BITS = 22

FOUND = "doc_id long, item_id long, n_shared long, n_item long, n_doc long"


def _words(text: str) -> bytes:
    """The words of a text, A-Z as a-z, with one space before and after each."""
    return b" %b " % b" ".join(text.encode().lower().split())


def _item_sets(batches):
    for batch in batches:
        sets = list(shingle_hashes(batch.column("text")))
        counts = [np.bincount(word_spans(data, offsets)[2], minlength=len(offsets) - 1) for _, data, offsets in utf8_parts(batch.column("text"))]
        few = np.concatenate([np.zeros(0, np.int64), *counts]) < SHINGLE_WORDS
        words = [_words(t or "") if f else None for t, f in zip(batch.column("text").to_pylist(), few.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([len(s) for s in sets], pa.int64()), binary_column(sets), pa.array(words, pa.binary())], names=["item_id", "n", "shingles", "words"])


def item_blocks(items: DataFrame, block_shingles: int = BLOCK_SHINGLES):
    """Yield lists of (item_id, shingle set, words if they are fewer than a shingle's) of bounded total size."""
    sets = materialise(items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_item_sets, "item_id long, n long, shingles binary, words binary").where("n > 0"), "items")
    total = sets.agg(F.sum("n").alias("n")).first()["n"] or 0
    blocks = -(-total // block_shingles)
    for k in range(blocks):
        part = sets if blocks == 1 else sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == k)
        yield [(r["item_id"], np.frombuffer(r["shingles"], np.uint64), r["words"] and bytes(r["words"])) for r in part.collect()]


class Sketches:
    """Bottom MinHash values of a block of items, by size partition."""

    def __init__(self, items: list, similarity: int = SIMILARITY):
        self.ids = [i for i, _, _ in items]
        self.sets = [s for _, s, _ in items]
        self.words = [w for _, _, w in items]
        self.similarity = similarity
        sizes = np.array([len(s) for s in self.sets])
        few = np.array([0 if w is None else len(w.split()) for w in self.words], int)
        #: By number of words, the sorted hashes of the items of fewer words than a shingle's, and the items.
        self.few = {}
        for n in np.unique(few[few > 0]).tolist():
            member = np.flatnonzero(few == n)
            values = np.array([self.sets[m][0] for m in member], np.uint64)
            order = np.argsort(values, kind="stable")
            self.few[n] = values[order], member[order]
        self.partitions = []
        level_of = np.where(few > 0, -1, np.log2(sizes).astype(int))
        for level in np.unique(level_of[level_of >= 0]):
            member = np.flatnonzero(level_of == level)
            # The sets are sorted, so their first values are the smallest hashes.
            sketch = [self.sets[m][: sizes[m] - -(-similarity * sizes[m] // 100) + 1] for m in member]
            values, owner = np.concatenate(sketch), np.repeat(member, [len(s) for s in sketch])
            order = np.argsort(values, kind="stable")
            least = int(-(-similarity * sizes[member].min() // 100))
            self.partitions.append((least, values[order], owner[order]))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        for _, values, _ in self.partitions:
            self.filter[values >> np.uint64(64 - _FILTER_BITS)] = True

    @staticmethod
    def _same(hashes, rows, values, owner):
        """Yield (row, item index) of equal hashes."""
        left, right = np.searchsorted(values, hashes, "left"), np.searchsorted(values, hashes, "right")
        hit = np.flatnonzero(right > left)
        for row, a, b in np.unique(np.stack([rows[hit], left[hit], right[hit]], 1), axis=0).tolist():
            for item in owner[a:b].tolist():
                yield row, item

    def search(self, column: pa.Array):
        """Yield (row, item index, shared shingles, document's shingles) of contained items."""
        for (first, hashes, rows, _), *runs in zip(shingle_runs(column), *(shingle_runs(column, n) for n in self.few), strict=True):
            near = {(row, item) for (_, short, at, _), (values, owner) in zip(runs, self.few.values(), strict=True) for row, item in self._same(short, at, values, owner)}
            for row, some in groupby(sorted(near), lambda x: x[0]):
                a, b = np.searchsorted(rows, [row, row + 1])
                size, words = len(np.unique(hashes[a:b])), _words(column[first + row].as_py())
                for _, item in some:
                    if self.words[item] in words:
                        yield first + row, item, 1, size
            maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
            if not len(maybe):
                continue
            met = set()
            for least, values, owner in self.partitions:
                left, right = np.searchsorted(values, hashes[maybe], "left"), np.searchsorted(values, hashes[maybe], "right")
                for at in np.flatnonzero(right > left).tolist():
                    met.update((int(rows[maybe[at]]), least, int(m)) for m in owner[left[at] : right[at]])
            whole: dict[int, np.ndarray] = {}
            for row, least, item in sorted(met):
                if row not in whole:
                    a, b = np.searchsorted(rows, [row, row + 1])
                    whole[row] = np.unique(hashes[a:b])
                doc, want = whole[row], self.sets[item]
                if len(doc) < least:
                    continue
                place = np.minimum(np.searchsorted(doc, want), len(doc) - 1)
                shared = int((doc[place] == want).sum())
                if 100 * shared >= self.similarity * len(want):
                    yield first + row, item, shared, len(doc)


def contained(docs: DataFrame, items: DataFrame, similarity: int = SIMILARITY, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document and contained item: ``doc_id``, ``item_id``, ``n_shared``, ``n_item``, ``n_doc``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    found = []
    for block in item_blocks(items, block_shingles):
        handle = spark.sparkContext.broadcast(block)

        def run(batches, handle=handle):
            sketches = Sketches(handle.value, similarity)
            for batch in batches:
                hits = list(sketches.search(batch.column("text")))
                columns = [
                    batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())), pa.array([sketches.ids[h[1]] for h in hits], pa.int64()),
                    pa.array([h[2] for h in hits], pa.int64()), pa.array([len(sketches.sets[h[1]]) for h in hits], pa.int64()), pa.array([h[3] for h in hits], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "n_shared", "n_item", "n_doc"])

        found.append(docs.mapInArrow(run, FOUND))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], FOUND)


def clean_rows(docs: DataFrame, items: DataFrame, similarity: int = SIMILARITY, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; one pass for each block of items."""
    for block in item_blocks(items, block_shingles):
        handle = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, handle=handle):
            sketches = Sketches(handle.value, similarity)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in sketches.search(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """All contained benchmark items of all documents."""
    return contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _shingle_sql(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM (SELECT {key}, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table})"""


ORACLE = f"""
WITH d AS ({_shingle_sql("documents", "doc_id")}), b AS ({_shingle_sql("benchmark", "item_id")}),
nd AS (SELECT doc_id, count(*) AS n_doc FROM d GROUP BY doc_id), nb AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_doc FROM m JOIN nd USING (doc_id) JOIN nb USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""
