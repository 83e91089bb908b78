"""Near-duplicate classes by MinHash, bands, exact confirmation, and alternating stars.

A document is its set of distinct word shingles; two link when their sets overlap by
the stated share of their union.

1. Every document gets its set size, a 128-bit fingerprint of its set and the minima
   of ``MINIMA`` universal (multiply-shift) hashes over it. Documents with one set
   become one class, so copies of any number go on as one row.
2. The minima are cut into bands. Classes that agree on a band share a bucket. Every
   member of a bucket first meets the bucket's hub, the member with the most company
   in all its buckets. Pairs whose minima agree too rarely go; the rest are confirmed
   on whole shingle sets, which are built from the texts of those classes only.
3. The members beside the hub that are not all in one component yet meet in chunks:
   a cell compares two chunks of a bucket, all whole sets of one with all of the
   other, as a product of incidence matrices. Out of a cell come only as many links
   as join its components, fewer than it has members, so no bucket emits its pairs.
   The comparisons themselves are all made: their number, not that of rows, grows
   with the square of a bucket whose members are alike but not linked.
4. Links become components by large-star and small-star in turn, each round a written
   table, until nothing moves.

With 32 bands of 5 minima a pair at 0.85 shares no bucket with a chance of 7e-9, and
the test of the minima (``least_agreement``) drops it with a chance of 1e-9 at most.
Every link that is reported is exact.

Null and empty texts have an empty set and link with nothing. A null key takes part
in links; the smallest non-null key names the component (null if there is none), and
a row with a null key is kept where that name is null. Rows repeated with one key are
rows of their own, kept or not together. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import materialise, mix, shingle_runs

SHINGLE_WORDS, SIMILARITY = 3, 85
BANDS, BAND_ROWS = 32, 5
MINIMA = BANDS * BAND_ROWS
#: Members of a bucket, and shingles of them, that form one chunk.
CHUNK, CHUNK_SHINGLES = 512, 150_000

_RNG = np.random.default_rng(85)
_FACTORS = _RNG.integers(1, 2**64, MINIMA, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**64, MINIMA, dtype=np.uint64)
_BAND_FACTORS = _RNG.integers(1, 2**64, MINIMA, dtype=np.uint64) | np.uint64(1)


def least_agreement(similarity: int = SIMILARITY, risk: float = 1e-9) -> int:
    """Least number of equal minima of a pair that may link: fewer come with a chance below ``risk`` (Chernoff)."""
    s = similarity / 100

    def bound(m: int) -> float:
        x = m / MINIMA
        parts = (x * math.log(x / s) if x else 0.0) + ((1 - x) * math.log((1 - x) / (1 - s)) if x < 1 else 0.0)
        return math.exp(-MINIMA * parts)

    m = 0
    while m < s * MINIMA and bound(m) <= risk:
        m += 1
    return m


def distinct_runs(column: pa.Array, words: int):
    """Yield (first row, distinct hashes, their rows, number of rows) of runs of rows, sorted by row, then hash."""
    for first, hashes, rows, number in shingle_runs(column, words):
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        if len(hashes):
            new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])
            hashes, rows = hashes[new], rows[new]
        yield first, hashes, rows, number


def _fingerprints(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes for each set, whatever the order of its hashes."""
    one = np.add.reduceat(hashes, starts)
    two = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts) + sizes.astype(np.uint64)
    both = np.ascontiguousarray(np.stack([one, two], axis=1))
    return [row.tobytes() for row in both]


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set the least value of every hash, as a matrix of unsigned 32-bit numbers."""
    out = np.empty((len(starts), MINIMA), np.uint32)
    value = np.empty(len(hashes), np.uint64)
    for k in range(MINIMA):
        np.multiply(hashes, _FACTORS[k], out=value)
        value += _SHIFTS[k]
        value >>= np.uint64(32)
        out[:, k] = np.minimum.reduceat(value, starts)
    return out


SIGNED = "doc_id long, text_key long, n long, class binary, minima binary"


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row its key, a hash of its text, set size, class and minima (null where the set is empty)."""

    def run(batches):
        for batch in batches:
            for first, hashes, rows, number in distinct_runs(batch.column("text"), words):
                sizes = np.bincount(rows, minlength=number)
                filled = np.flatnonzero(sizes)
                classes, signs = [None] * number, [None] * number
                if len(filled):
                    starts = np.searchsorted(rows, filled)
                    least = minima(hashes, starts)
                    for k, name, sign in zip(filled.tolist(), _fingerprints(hashes, starts, sizes[filled]), least, strict=True):
                        classes[k], signs[k] = name, sign.tobytes()
                some = batch.slice(first, number)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("text_key"), pa.array(sizes.astype(np.int64)), pa.array(classes, pa.binary()), pa.array(signs, pa.binary())],
                    names=["doc_id", "text_key", "n", "class", "minima"])

    return _keyed(docs).mapInArrow(run, SIGNED)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", F.xxhash64("text"))


def _buckets(batches):
    """One number for each band of a class."""
    for batch in batches:
        least = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint32).reshape(-1, MINIMA)
        spread = mix(least.astype(np.uint64) + np.uint64(1)) * _BAND_FACTORS
        keys = mix(spread.reshape(-1, BANDS, BAND_ROWS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("n"), lists], names=["class", "n", "keys"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of one side with all of the other, as products of incidence matrices."""
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    common = np.intersect1d(sides[0][0], sides[1][0])
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(common), width):
        some, blocks = common[at : at + width], []
        for (values, rows), number in zip(sides, (len(left), len(right)), strict=True):
            place = np.minimum(np.searchsorted(some, values), len(some) - 1)
            held = some[place] == values
            block = np.zeros((number, len(some)), np.float32)
            block[rows[held], place[held]] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def _meet(similarity: int):
    """Links between two chunks of a bucket (or inside one), no more than join their components."""

    def links(left: list[dict], right: list[dict] | None):
        other = left if right is None else right
        x, y = ([np.frombuffer(m["shingles"], np.uint64) for m in side] for side in (left, other))
        both = overlaps(x, y)
        nx, ny = (np.array([len(s) for s in side]) for side in (x, y))
        linked = 100 * both >= similarity * (nx[:, None] + ny - both)
        if right is None:
            linked &= np.triu(np.ones(linked.shape, bool), 1)
        up: dict[bytes, bytes] = {}

        def find(part: bytes) -> bytes:
            while up.get(part, part) != part:
                part = up[part] = up.get(up[part], up[part])
            return part

        for i, j in zip(*(k.tolist() for k in np.nonzero(linked)), strict=True):
            p, q = find(left[i]["part"]), find(other[j]["part"])
            if p != q:
                up[p] = q
                yield left[i]["class"], other[j]["class"]

    def run(batches):
        for batch in batches:
            out = [link for left, right in zip(batch.column("left"), batch.column("right"), strict=True) for link in links(left.as_py(), right.as_py())]
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _sets_of(words: int):
    def run(batches):
        for batch in batches:
            for first, hashes, rows, number in distinct_runs(batch.column("text"), words):
                sizes = np.bincount(rows, minlength=number)
                filled = np.flatnonzero(sizes)
                if not len(filled):
                    continue
                starts = np.searchsorted(rows, filled)
                ends = np.append(starts[1:], len(rows))
                blobs = [hashes[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                some = batch.slice(first, number).take(pa.array(filled))
                mine = [x == y for x, y in zip(some.column("class").to_pylist(), _fingerprints(hashes, starts, sizes[filled]), strict=True)]
                yield pa.RecordBatch.from_arrays([some.column("class"), some.column("minima"), pa.array(blobs, pa.binary())], names=["class", "minima", "shingles"]).filter(pa.array(mine))

    return run


def shingle_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """``class``, ``minima`` and ``shingles`` of the ``needed`` classes, from the text of one member each."""
    needed = classes.join(needed, "class", "left_semi").select("class", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_text"), "minima")
    texts = _keyed(docs).join(needed, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_text")))
    sets = texts.select("class", "minima", "text").mapInArrow(_sets_of(words), "class binary, minima binary, shingles binary")
    return sets.groupBy("class").agg(F.first("minima").alias("minima"), F.first("shingles").alias("shingles"))


def _confirm(least: int, similarity: int):
    """Pairs whose minima agree often enough and whose whole sets overlap enough."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, MINIMA) for c in ("minima_a", "minima_b"))
            keep = (x == y).sum(axis=1) >= least
            for k in np.flatnonzero(keep).tolist():
                p, q = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in ("shingles_a", "shingles_b"))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep[k] = 100 * both >= similarity * (len(p) + len(q) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The links among pairs of classes, from their minima, then their whole sets; a written table."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("minima").alias(f"minima_{side}"), F.col("shingles").alias(f"shingles_{side}")), side)
    return materialise(pairs.mapInArrow(_confirm(least_agreement(similarity), similarity), "a binary, b binary"), "links")


def star_components(edges: DataFrame) -> DataFrame:
    """Least reachable node of each node of ``edges`` (``a``, ``b``): ``node``, ``label``.

    Large star: every node hangs its greater neighbours on the least node it knows.
    Small star: every node hangs its smaller neighbours, and itself, on the least of
    them. In turn they flatten every component to one star in a number of rounds that
    grows with the logarithm of its size. A node's least neighbour is an aggregate,
    and its neighbours never meet in one place.
    """

    def large(edges: DataFrame) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b")

    def flat(edges: DataFrame) -> bool:
        """Every node hangs on one other, or others hang on it."""  # edges may be there twice
        roles = edges.selectExpr("stack(2, a, b, b, null) as (node, up)").groupBy("node")
        return roles.agg(F.min("up").alias("p"), F.max("up").alias("q"), F.count("up").alias("ups"), F.count("*").alias("uses")).where("p <> q or (ups > 0 and ups < uses)").isEmpty()

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, number = materialise(edges.distinct(), "edges"), 0
    while not flat(edges):
        edges, number = materialise(small(edges).distinct() if number % 2 else large(edges), "stars"), number + 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b")).distinct()


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs`` (``doc_id``, ``text``)."""
    judged = materialise(signatures(docs, words), "signatures")
    classes = judged.where("class is not null").groupBy("class").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("minima").alias("minima"))
    classes = materialise(classes, "classes")

    banded = classes.select("class", "n", "minima").mapInArrow(_buckets, "class binary, n long, keys array<long>")
    banded = banded.select("class", "n", F.explode("keys").alias("key"))
    shared = banded.join(banded.groupBy("key").agg(F.count("*").alias("many")).where("many > 1"), "key")
    shared = materialise(shared.select("key", "class", "n", "many"), "buckets")
    # A class has at most one bucket for each band.
    company = shared.groupBy("class").agg(F.first("n").alias("n"), F.sum("many").alias("company"), F.collect_list(F.struct("key", "many")).alias("buckets"))
    met = company.select("class", "n", "company", F.inline("buckets"))
    hubs = met.groupBy("key").agg(F.max_by(F.struct("class", "n"), F.struct("company", "class")).alias("hub"))
    met = met.join(hubs.select("key", F.col("hub.class").alias("hub"), F.col("hub.n").alias("hub_n")), "key")
    met = materialise(met.select("key", "class", "n", "many", "hub", "hub_n"), "met")
    sets = materialise(shingle_sets(docs, classes, met.select("class").distinct(), words), "class-sets")
    fit = F.lit(100) * F.least("n", "hub_n") >= F.lit(similarity) * F.greatest("n", "hub_n")
    starred = met.where((F.col("class") != F.col("hub")) & fit).select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    first = confirmed(starred, sets, similarity)
    labels = materialise(star_components(first), "labels")

    # Pairs with a hub are judged. The rest of a bucket meets where it lies in several components;
    # buckets with the same rest are one.
    rest = met.where("class <> hub and many > 2").join(labels, F.col("class") == F.col("node"), "left")
    rest = materialise(rest.select("key", "class", "n", F.coalesce("label", "class").alias("part")), "rest")
    kinds = rest.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("n").alias("total"), F.min("part").alias("p"), F.max("part").alias("q"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64("class", F.lit(1)).cast("decimal(38,0)")).alias("s2"))
    kinds = kinds.where("p <> q").groupBy("size", "total", "s1", "s2").agg(F.min("key").alias("key"))
    members = materialise(rest.join(kinds.select("key", "size", "total"), "key"), "members")
    parts = F.greatest(F.ceil(F.col("size") / F.lit(CHUNK)), F.ceil(F.col("total") / F.lit(CHUNK_SHINGLES))).cast("long")
    chunks = members.withColumn("parts", parts).withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(7)), F.col("parts")))
    chunks = chunks.join(sets.select("class", "shingles"), "class").groupBy("key", "parts", "chunk").agg(F.collect_list(F.struct("class", "part", "shingles")).alias("members"))
    chunks = materialise(chunks, "chunks")
    whole = chunks.where("parts = 1").select(F.col("members").alias("left"), F.lit(None).cast(chunks.schema["members"].dataType).alias("right"))
    cut = chunks.where("parts > 1")
    across = (cut.select("key", F.col("chunk").alias("c"), F.explode(F.sequence("chunk", F.col("parts") - 1)).alias("d"), F.col("members").alias("left"))
              .join(cut.select("key", F.explode(F.sequence(F.lit(0).cast("long"), "chunk")).alias("c"), F.col("chunk").alias("d"), F.col("members").alias("right")), ["key", "c", "d"]))
    across = across.select("left", F.when(F.col("c") != F.col("d"), F.col("right")).alias("right"))
    second = materialise(whole.unionByName(across).mapInArrow(_meet(similarity), "a binary, b binary").distinct(), "links")
    if not second.isEmpty():
        labels = materialise(star_components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(second)), "labels")

    named = classes.select("class", "least").join(labels, F.col("class") == F.col("node"), "left").withColumn("part", F.coalesce("label", "class"))
    of_class = named.join(named.groupBy("part").agg(F.min("least").alias("component_id")), "part").select("class", "component_id")
    of_class = materialise(of_class, "class-components")
    alone = judged.where("class is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    rows = judged.where("class is not null").select("doc_id", "n", "class").join(of_class, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return alone.unionByName(rows).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_minhash(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
