"""Secret scan with corpus-wide ownership frequency, in DataFrame expressions only.

Documents are searched for assignments, access keys, hex runs, private keys from
their header to their END line, vendor tokens and long mixed strings. Every
candidate value is hashed and counted over the whole corpus by distinct
repositories and owners. A value that several owners hold is a widely copied example. One that a single owner
holds, and that does not read like a placeholder, looks live. The long mixed
strings alone are too common to report, so they become spans only where the
counts say that they look live; all other kinds are always reported.

A private key without an END line within 20,000 characters ends with its base64
run: chunks of 16 characters or more, and one shorter line after them. Quotes and
escaped line ends may stand between. Copies of a key that differ only in white
space or escaped line ends count as one value.

Null text counts as empty, a null owner or repository as an owner of that name
(empty text). Rows repeated with one key are scanned one by one. Spans are code
points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import carried, materialise, unpacked


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_PEM_HEAD = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
# A character at a time or possessive, so that long keys need no stack.
_PEM_END = r"(?:(?!-----BEGIN )[\s\S]){0,20000}?-----END [A-Z ]*PRIVATE KEY-----"
_PEM_FIELDS = r"(?:(?:\s|\\[nr])*+[A-Z][A-Za-z-]*+:[^\n\\]*+)*+"
_PEM_CHUNKS = r"""(?:[\s"'\\,>#*]*+[A-Za-z0-9+/=]{16,}+)++"""
_PEM_LAST = r"""(?:["',]*+(?:\r?\n|\\[nr])[\s"'\\>#*]*+[A-Za-z0-9+/=]++(?=["',]*+(?:[\r\n\\]|\z)))?+"""
PEM = f"{_PEM_HEAD}(?:{_PEM_END}|{_PEM_FIELDS}{_PEM_CHUNKS}{_PEM_LAST})?+"
#: kind, pattern, group of the value, least characters of the value. The order is that of ties.
KINDS = [
    ("assign", ASSIGN, 2, 12),
    # A run of the class is one match, so the least length may stand in the pattern.
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),
    ("pem", PEM, 0, 1),
    ("vendor", r"(?<![A-Za-z0-9_])(?:gh[opsur]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[rs]k_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})", 0, 1),
    ("owned", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20),
]
BASE = ("assign", "access", "hex")
#: Values held by this many owners or more are widely copied.
COPIED_OWNERS = 2
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|(.)\1{7}|0123456789|abcdefgh"
#: Base64 of a live key may hold runs of one letter and short words.
PEM_PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]"

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _spans(text: Column, rank: int) -> Column:
    """The matches of one kind with their places, from the pieces between them."""
    kind, pattern, group, least = KINDS[rank]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), whole.alias("whole"), value.alias("value"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        keep = x["whole"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(end.alias("at"), F.when(keep, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(found, start, add)["spans"]).otherwise(F.array().cast(SPAN))


def _suspect(text: Column) -> Column:
    out = F.lit(False)
    for _, pattern, _, _ in KINDS:
        out = out | text.rlike(pattern)
    return out


def scan(docs: DataFrame, owner: str = "source", repository: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(suspects, rest): rows with candidates, with ``_spans`` judged corpus-wide, and the untouched other rows.

    ``_spans`` holds start, rank, kind, end and ``live`` (true, or false for
    widely copied examples and placeholders), by start and kind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = docs.where(~_suspect(text))
    found = F.flatten(F.array(*(_spans(text, k) for k in range(len(KINDS)))))
    suspects = materialise(docs.where(_suspect(text)).withColumn("_row", F.monotonically_increasing_id()).withColumn("_found", found), "suspects")

    own = F.coalesce(F.col(owner).cast("string"), F.lit(""))
    repo = F.coalesce(F.col(repository).cast("string"), F.lit(""))
    each = suspects.select("_row", own.alias("_owner"), repo.alias("_repo"), F.explode("_found").alias("s"))
    pem = F.col("s.kind") == "pem"
    each = each.select("_row", "_owner", "_repo", "s", F.sha2(F.when(pem, F.regexp_replace("s.value", r"\s|\\[nr]", "")).otherwise(F.col("s.value")), 256).alias("_hash"))
    counts = each.groupBy("_hash", "_owner", "_repo").agg(F.count("*").alias("uses"))
    counts = counts.groupBy("_hash", "_owner").agg(F.count("*").alias("repos"), F.sum("uses").alias("uses"))
    counts = counts.groupBy("_hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("uses").alias("uses"))
    judged = each.join(counts, "_hash").select(
        "_row", F.col("s.start").alias("start"), F.col("s.rank").alias("rank"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"),
        ((F.col("owners") < COPIED_OWNERS) & ~F.when(pem, F.col("s.value").rlike(PEM_PLACEHOLDER)).otherwise(F.col("s.value").rlike(PLACEHOLDER))).alias("live"), "owners", "repos", "uses")
    judged = judged.where("kind <> 'owned' or live")
    spans = judged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end", "live", "owners", "repos", "uses"))).alias("_spans"))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,live:boolean,owners:bigint,repos:bigint,uses:bigint>>")
    suspects = suspects.join(spans, "_row", "left").withColumn("_spans", F.coalesce("_spans", none)).drop("_row", "_found")
    return suspects, rest


def mask(text: Column, spans: Column, label: str = "<secret>") -> Column:
    """``text`` with every run of overlapping spans replaced by ``label``."""

    def add(state: Column, x: Column) -> Column:
        at = state["at"]
        gap = F.substring(text, at + 1, F.greatest(x["start"] - at, F.lit(0)))
        out = F.when(x["start"] >= at, F.concat(state["out"], gap, F.lit(label))).otherwise(state["out"])
        return F.struct(F.greatest(at, x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def mask_secrets(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """``docs`` with every span masked in ``text``; other columns and the other rows stay as they are."""
    rows = carried(docs, _by=F.col(owner), _from=F.col(repository))
    suspects, rest = scan(rows, "_by", "_from")
    masked = F.when(F.size("_spans") > 0, mask(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    return rest.select(*unpacked(docs.columns, "text")).unionByName(suspects.select(*unpacked(docs.columns, masked)))


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents, with the counts of live-looking and copied spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    suspects, rest = scan(docs)

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))

    spans = F.col("_spans")
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE))
    number = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    some = suspects.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda x: x["live"])).cast("long").alias("n_live"), F.size(F.filter(spans, lambda x: ~x["live"])).cast("long").alias("n_copied"))
    zero = F.lit(0).cast("long")
    none = rest.select("doc_id", *(zero.alias(f"n_{k}") for k in BASE), F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"), zero.alias("n_live"), zero.alias("n_copied"))
    return some.unionByName(none)
