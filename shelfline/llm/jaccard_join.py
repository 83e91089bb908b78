"""N-gram Jaccard self-join by grouped prefixes.

A document is its set of distinct word shingles. Two documents link when their
sets overlap by three quarters of their union. The join runs in these steps:

1. Documents are dealt to blocks. Every block sends its distinct shingles, once
   each, to buckets of shingles, which count documents and send back those that
   more than one document has. A document of which too few shingles are shared
   can't link to any other and leaves here; that is a bound, not a guess.
2. Documents with the same set become one class.
3. The rest order their shingles rarest first. A linked pair shares a shingle of
   its prefixes. Classes with the same prefix and size become one group, and
   groups meet by prefix shingle under the size and position bounds.
4. In a bucket every group first meets only its most shared group (the hub). The
   members are expanded and verified exactly, and linked classes become
   components. Only pairs that lie in different components then meet each other
   in full. A pair inside one component cannot change the answer, so all
   components are exact, and no group emits all of its pairs.

Null and empty texts have an empty set and link with nothing. A null key stays;
it takes part in links, and the smallest non-null key names the component (null
if there is none). Rows repeated with one key are rows of their own in the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import SIMILARITY, components, in_blocks, materialise, mix, shared_values, shingle_hashes, text_bytes, unpack_shared

#: Distinct shingles of all blocks that one bucket should get.
BUCKET_SHINGLES = 3_000_000
#: Bytes of texts and sets that a task hands to Python at once.
HANDED = 4 << 20


def _judge_block(similarity: int):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        known = unpack_shared(shared)
        out: dict[str, list] = {k: [] for k in ("n", "f1", "f2", "n_shared", "shingles", "counts")}
        for values in shingle_hashes(docs.column("text")):
            n = len(values)
            df = known(values)
            n_shared = int((df > 1).sum())
            keep = n > 0 and 100 * n_shared >= similarity * n
            out["n"].append(n)
            out["f1"].append(int(values.sum().astype(np.int64)) if n else 0)
            out["f2"].append(int(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)) if n else 0)
            out["n_shared"].append(n_shared)
            out["shingles"].append(values.tobytes() if keep else None)
            out["counts"].append(df.tobytes() if keep else None)
        kinds = {"n": pa.int64(), "f1": pa.int64(), "f2": pa.int64(), "n_shared": pa.int64(), "shingles": pa.binary(), "counts": pa.binary()}
        return pa.table({"doc_id": docs.column("doc_id"), **{k: pa.array(v, kinds[k]) for k, v in out.items()}})

    return run


def shingle_sets(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Per document its set size and fingerprint; the set itself only where it may link."""
    total = text_bytes(docs)
    rows, n_blocks = in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), total)
    shared = shared_values(rows, max(n_blocks, math.ceil(total / 6 / BUCKET_SHINGLES)), shingle_hashes)
    return rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _judge_block(similarity), "doc_id long, n long, f1 long, f2 long, n_shared long, shingles binary, counts binary")


def _prefixes(similarity: int):
    """Order each set rarest first and keep what a link has to share."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            keys, prefixes = [], []
            for n, blob, counts in zip(sizes.tolist(), batch.column("shingles"), batch.column("counts"), strict=True):
                values = np.frombuffer(blob.as_buffer(), np.uint64)
                length = n - -(-similarity * n // 100) + 1
                prefix = values[np.lexsort((values, np.frombuffer(counts.as_buffer(), np.uint8)))[:length]]
                factors = mix(np.arange(1, length + 1, dtype=np.uint64))
                keys.append(int(mix(np.array([np.sum(mix(prefix) * factors)], np.uint64)).astype(np.int64)[0]))
                prefixes.append(prefix.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("n"), batch.column("n_shared"), pa.array(keys, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["class", "n", "n_shared", "prefix_key", "prefix"])

    return run


def _verify(similarity: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= similarity * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes that overlap enough, verified on whole sets."""
    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(similarity), "a long, b long")


def _may_link(a: str, b: str, similarity: int):
    """Size and position bounds for two groups that meet in a shingle at ``pos``, counted from 0."""
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    most = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= similarity * F.greatest(na, nb)) & ((100 + similarity) * most >= similarity * (na + nb))


def jaccard_components(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs`` (``doc_id``, ``text``; others are ignored)."""
    judged = materialise(shingle_sets(docs, similarity), "sets", HANDED)
    maybe = judged.where("shingles is not null")
    classes = maybe.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("least"), F.max("n_shared").alias("n_shared"))
    classes = materialise(classes.withColumn("class", F.xxhash64("f1", "f2", "n")), "classes")
    sets = maybe.groupBy("f1", "f2", "n").agg(F.first("shingles").alias("shingles"), F.first("counts").alias("counts"), F.max("n_shared").alias("n_shared"))
    sets = materialise(sets.select(F.xxhash64("f1", "f2", "n").alias("class"), "n", "n_shared", "shingles", "counts"), "class-sets")

    prefixes = sets.mapInArrow(_prefixes(similarity), "class long, n long, n_shared long, prefix_key long, prefix array<long>")
    prefixes = materialise(prefixes.withColumn("grp", F.xxhash64("prefix_key", "n")), "prefixes", HANDED)
    members = prefixes.select("grp", "class", F.col("n_shared").alias("m_shared"))
    groups = prefixes.groupBy("grp").agg(F.first("n").alias("n"), F.max(F.struct("n_shared", "class"))["class"].alias("head"), F.max("n_shared").alias("n_shared"), F.first("prefix").alias("prefix"))
    met = materialise(groups.select("grp", "head", "n", "n_shared", F.posexplode("prefix").alias("pos", "shingle")), "met")

    # First every group meets the hub of its buckets, and every class the head of its group.
    rank = F.struct((F.col("n_shared") / F.col("n")).alias("share"), F.col("n_shared"), F.col("grp"))
    hubs = met.groupBy("shingle").agg(F.max_by(F.struct("grp", "head", "n", "pos"), rank).alias("h"), F.count("*").alias("many")).where("many > 1").select("shingle", "h.*")
    starred = met.alias("g").join(hubs.alias("h"), "shingle").where((F.col("g.grp") != F.col("h.grp")) & _may_link("g", "h", similarity))
    best = starred.groupBy(F.col("g.grp").alias("grp"), F.col("h.head").alias("hub")).agg(F.count("*").alias("times"))
    best = best.groupBy("grp").agg(F.max_by("hub", F.struct("times", "hub")).alias("hub"))
    to_hub = best.join(members, "grp").select(F.col("hub").alias("a"), F.col("class").alias("b"))
    to_head = members.join(groups.select("grp", "head"), "grp").where("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b"))
    starts = materialise(to_hub.union(to_head), "stars")
    first = materialise(_links(starts, sets, similarity), "links", HANDED)
    labels = components(first)

    # Then only what still lies in different components meets in full.
    tagged = met.select("shingle", "grp", "n", "pos").join(members.select("grp", "class"), "grp")
    tagged = tagged.join(labels, F.col("class") == F.col("node"), "left").select("shingle", "class", "n", "pos", F.coalesce("label", "class").alias("part"))
    tagged = materialise(tagged, "tagged")
    open_ = tagged.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("shingle")
    rest = tagged.join(open_, "shingle")
    pairs = rest.alias("l").join(rest.alias("r"), (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.part") < F.col("r.part")) & _may_link("l", "r", similarity))
    pairs = pairs.select(F.col("l.class").alias("a"), F.col("r.class").alias("b")).distinct().join(starts, ["a", "b"], "left_anti")
    second = materialise(_links(pairs, sets, similarity), "links", HANDED)
    final = components(first.union(second))

    named = classes.join(final, F.col("class") == F.col("node"), "left").withColumn("part", F.coalesce("label", "class"))
    names = named.groupBy("part").agg(F.min("least").alias("component_id"))
    of_class = materialise(named.join(names, "part").select("f1", "f2", "n", "component_id"), "class-components")
    alone = judged.where("shingles is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return alone.unionByName(maybe.select("doc_id", "f1", "f2", "n").join(of_class, ["f1", "f2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id"))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
