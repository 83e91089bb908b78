"""Fill-in-middle over seekable compressed frames.

1. ``store`` writes every text as independent zstandard frames of a fixed number
   of bytes. Each frame carries the units (tokens) and characters that start before
   it and whether it begins inside a word, so that any unit can be found from the
   one frame that holds it.
2. ``fill_middle`` draws two cuts by a keyed hash of the document's key, finds them
   by a search over the cumulative unit counts, and decompresses only the frames
   that a cut falls into. All other frames go to the output as they lie, in the
   order of the form. Marks and the pieces of cut frames are compressed anew.
3. ``digests`` and ``restore`` read the output's frames one after another and never
   hold more than one of them; ``restore`` finds the marks in the output itself.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, so a unit starts
at 0 and wherever white space follows a word. Frames are cut at bytes, not at
units; a text of any length, or one unit longer than a frame, needs no more memory
at steps 2 and 3.

Null text counts as empty: no frame, no unit, form ``plain``. A null key is drawn
for as the empty text. Repeated rows are rows of their own, with equal results where
key and text are equal. Other columns are ignored. No step shuffles.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import IS_SPACE, materialise

FRAME_BYTES = 1 << 16
#: Compressed bytes that a task hands on at once.
BATCH_BYTES = 8 << 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The marks of a form, in the order of its output.
MARKS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}

FRAMES = "array<struct<unit: long, char: long, inside: boolean, bytes: long, data: binary>>"
STORED = f"doc_id long, n long, n_bytes long, marked boolean, frames {FRAMES}"
FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>"

_FRAMES_TYPE = pa.list_(pa.struct([("unit", pa.int64()), ("char", pa.int64()), ("inside", pa.bool_()), ("bytes", pa.int64()), ("data", pa.binary())]))


def _batches(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most 256 rows or, by their last column, about ``BATCH_BYTES``."""
    held: list[tuple] = []
    size = 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for row in rows:
        held.append(row)
        size += sum(len(f["data"] if isinstance(f, dict) else f) for f in row[-1])
        if len(held) == 256 or size > BATCH_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _unit_starts(data: np.ndarray, inside: bool, first: bool) -> np.ndarray:
    """Where units start in a run of bytes; ``inside``: the byte before it belongs to a word."""
    space = IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[:1], before[1:] = inside, ~space[:-1]
    starts = space & before
    if first and len(data):
        starts[0] = True
    return np.flatnonzero(starts)


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def frames_of(text: bytes, frame_bytes: int, compress) -> tuple[list[dict], int]:
    """The frames of a text, and its number of units."""
    frames, unit, char, inside = [], 0, 0, False
    for at in range(0, len(text), frame_bytes):
        part = text[at : at + frame_bytes]
        data = np.frombuffer(part, np.uint8)
        frames.append({"unit": unit, "char": char, "inside": inside, "bytes": len(part), "data": compress(part)})
        unit += len(_unit_starts(data, inside, at == 0))
        char += _characters(data)
        inside = not IS_SPACE[data[-1]]
    return frames, unit


def store(docs: DataFrame, frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """Texts of ``docs`` (``doc_id``, ``text``) as frames: ``doc_id``, ``n`` (units), ``n_bytes``, ``marked``, ``frames``."""

    def run(batches):
        compress = zstandard.ZstdCompressor(level=level).compress

        def rows():
            for batch in batches:
                for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    data = (text.as_py() or "").encode()
                    frames, n = frames_of(data, frame_bytes, compress)
                    yield key, n, len(data), any(m in data for m in (PREFIX, SUFFIX, MIDDLE)), frames

        yield from _batches(rows(), ["doc_id", "n", "n_bytes", "marked", "frames"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), _FRAMES_TYPE])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, STORED)


class Texts:
    """Reads and writes frames; one for each task."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes = frame_bytes
        self.open = zstandard.ZstdDecompressor().decompress
        self.close = zstandard.ZstdCompressor(level=level).compress

    def cut(self, frames: list[dict], n: int, n_bytes: int, unit: int) -> tuple[int, int, int]:
        """Frame, byte in it and characters before the cut in front of ``unit``; decompresses that frame alone."""
        if unit == 0:
            return 0, 0, 0
        if unit >= n:
            last = frames[-1]
            return len(frames), 0, last["char"] + _characters(np.frombuffer(self.open(last["data"]), np.uint8))
        at = bisect_right(frames, unit, key=lambda f: f["unit"]) - 1
        frame = frames[at]
        data = np.frombuffer(self.open(frame["data"]), np.uint8)
        byte = int(_unit_starts(data, frame["inside"], at == 0)[unit - frame["unit"]])
        return at, byte, frame["char"] + _characters(data[:byte])

    def between(self, frames: list[dict], start: tuple, end: tuple) -> Iterator[bytes | dict]:
        """The pieces from one cut to another: whole frames as they lie, bytes of cut ones."""
        for at in range(start[0], min(end[0] + 1, len(frames))):
            frame = frames[at]
            a = start[1] if at == start[0] else 0
            b = end[1] if at == end[0] else frame["bytes"]
            if a == 0 and b == frame["bytes"]:
                yield frame
            elif a < b:
                yield self.open(frame["data"])[a:b]

    def joined(self, pieces: Iterable[bytes | dict]) -> list[bytes]:
        """Pieces as output frames; small ones share a frame, full ones stay compressed."""
        out, held, size = [], [], 0
        for piece in pieces:
            if isinstance(piece, dict):
                if piece["bytes"] >= self.frame_bytes:
                    if held:
                        out.append(self.close(b"".join(held)))
                        held, size = [], 0
                    out.append(piece["data"])
                    continue
                piece = self.open(piece["data"])
            held.append(piece)
            size += len(piece)
            if size >= self.frame_bytes:
                out.append(self.close(b"".join(held)))
                held, size = [], 0
        if held:
            out.append(self.close(b"".join(held)))
        return out


def draws(key: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and the decimal key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def fill_middle(stored: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
                frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """The transformed texts as frames: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain), ``frames``."""

    def one(texts: Texts, row: dict) -> tuple:
        frames, n = row["frames"], row["n"]
        h1, h2, h3, h4 = draws(row["doc_id"], seed)
        if n == 0 or row["marked"] or h3 % 100 >= fim_percent:
            return row["doc_id"], n, PLAIN, None, None, [f["data"] for f in frames]
        form = SPM if h4 % 100 < spm_percent else PSM
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        first, second = (texts.cut(frames, n, row["n_bytes"], u) for u in (low, high))
        end = (len(frames), 0, 0)
        parts = {PREFIX: ((0, 0, 0), first), MIDDLE: (first, second), SUFFIX: (second, end)}
        pieces = (p for mark in MARKS[form] for p in (mark, *texts.between(frames, *parts[mark])))
        return row["doc_id"], n, form, first[2], second[2] - first[2], texts.joined(pieces)

    def run(batches):
        texts = Texts(frame_bytes, level)
        rows = (one(texts, {c: batch.column(c)[k].as_py() for c in batch.schema.names}) for batch in batches for k in range(batch.num_rows))
        yield from _batches(rows, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames"],
                            [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())])

    return stored.select("doc_id", "n", "n_bytes", "marked", "frames").mapInArrow(run, FILLED)


def mark_places(chunks: Iterable[bytes], marks: tuple[bytes, ...]) -> tuple[list[int], int]:
    """Where the marks of an output start, in their order, and its bytes; marks may lie across chunks."""
    found, at, tail = [], 0, b""
    for chunk in chunks:
        seen = tail + chunk
        start = 0
        while len(found) < len(marks) and (k := seen.find(marks[len(found)], start)) >= 0:
            found.append(at - len(tail) + k)
            start = k + len(marks[len(found) - 1])
        at += len(chunk)
        tail = seen[max(start, len(seen) - 2) :]
    return found, at


def restored(frames: list[bytes], form: str, open_frame) -> Iterator[bytes]:
    """The text of an output in runs of bytes, from its frames and its form alone."""
    if form == PLAIN:
        yield from map(open_frame, frames)
        return
    marks = MARKS[form]
    sizes: list[int] = []

    def chunks():
        for f in frames:
            chunk = open_frame(f)
            sizes.append(len(chunk))
            yield chunk

    places, total = mark_places(chunks(), marks)
    ends = [*places[1:], total]
    parts = {m: (p + len(m), e) for m, p, e in zip(marks, places, ends, strict=True)}
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    for mark in (PREFIX, MIDDLE, SUFFIX):
        a, b = parts[mark]
        k = bisect_right(starts, a) - 1
        while a < b:
            upto = min(b, starts[k + 1])
            if a < upto:
                yield open_frame(frames[k])[a - starts[k] : upto - starts[k]]
            a, k = max(a, upto), k + 1


def _sha256(chunks: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk)
    return digest.hexdigest()


def digests(filled: DataFrame) -> DataFrame:
    """``filled`` with ``output_sha256`` and ``restored_sha256`` in place of its frames."""

    def run(batches):
        open_frame = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
        for batch in batches:
            output, back = [], []
            for frames, form in zip(batch.column("frames"), batch.column("form").to_pylist(), strict=True):
                frames = frames.as_py()
                output.append(_sha256(map(open_frame, frames)))
                back.append(_sha256(restored(frames, form, open_frame)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(output, pa.string()), pa.array(back, pa.string())], names=[*names, "output_sha256", "restored_sha256"])

    return filled.mapInArrow(run, FILLED.replace("frames array<binary>", "output_sha256 string, restored_sha256 string"))


def _texts(filled: DataFrame, chunks_of) -> DataFrame:
    def run(batches):
        open_frame = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [b"".join(chunks_of(f.as_py(), form, open_frame)).decode() for f, form in zip(batch.column("frames"), batch.column("form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("form"), pa.array(texts, pa.string())], names=["doc_id", "form", "text"])

    return filled.mapInArrow(run, "doc_id long, form string, text string")


def outputs(filled: DataFrame) -> DataFrame:
    """The transformed texts: ``doc_id``, ``form``, ``text``."""
    return _texts(filled, lambda frames, form, open_frame: map(open_frame, frames))


def restore(filled: DataFrame) -> DataFrame:
    """The texts before the transformation: ``doc_id``, ``form``, ``text``."""
    return _texts(filled, restored)


def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    """The digest of the contract over all documents; their frames are a written table."""
    stored = materialise(store(spark.read.parquet(f"{sf_dir}/documents.parquet")), "frames")
    return digests(fill_middle(stored))


_UNITS = r"'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'"
ORACLE = rf"""
with units as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_UNITS}) as u,
  sha256('42:' || cast(doc_id as varchar)) as h from documents),
drawn as (select doc_id, text, u, len(u) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
  cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from units),
cuts as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
   when h4 % 100 < 80 then 'spm' else 'psm' end as form from drawn),
parts as (select doc_id, text, cast(n as bigint) as n, form, array_to_string(u[1:a], '') as p,
  array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from cuts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
 case when form <> 'plain' then length(m) end as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
  else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
 sha256(text) as restored_sha256 from parts"""
