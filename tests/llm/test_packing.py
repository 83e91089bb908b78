import random
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from shelfline.llm import packing
from tests.llm import cases


def test_pieces_cover_every_document_and_fill_sequences(spark):
    rows = [(500, "odd <|endoftext|> and\x1csep é  Σας ΣΑΣ it's 12345", *([None] * 10)), *cases.rows(1, 200)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = packing.pack(docs).collect()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = sorted((str(i), str([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t, *_ in rows)
    whole, filled = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and 0 < r.length <= 4096
        whole[r.doc_id, r.doc_tokens].append((r.start, ids))
        filled[r.sequence_id].append((r.offset, r.length))
    rebuilt = []
    for (i, n), parts in whole.items():
        copies = defaultdict(list)
        for start, ids in sorted(parts):
            copies[start].append(ids)
        for several in zip(*(copies[s] for s in sorted(copies)), strict=True):
            rebuilt.append((str(i), str(sum(several, []))))
            assert sum(map(len, several)) == n
    assert sorted(rebuilt) == want
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.digest(packing.pack(docs.where("doc_id = 1"))).collect()}
    ids = np.array([*tokenizer.encode(cases.rows(1, 200)[0][1], add_special_tokens=False).ids, 2], "<u4")
    assert crc == {(1, 0): zlib.crc32(ids.tobytes())}


def test_ids_equal_the_tokenizer():
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    signs = [chr(c) for c in range(33, 0x250) if not chr(c).isspace()]
    texts = ["".join(f"a{c}B{c}{c}1 " for c in signs), " ".join(signs), "it's we'll I'D 'tis don't''s ab'dc _x_ a_b x² ½ ＡＢ e\u0301 Ω ﬁ İ ſ \u212b",
             "".join(signs), "日本語テキスト ΣΑΣ приВЕТ", *(r[1] or "" for r in cases.rows(7, 40))]
    for text, ids in zip(texts, packing.token_ids(texts, packing.tokenizer_path()), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_histogram_keeps_every_length_with_little_padding():
    rnd = random.Random(1)
    for lengths in ([min(4096, max(1, int(rnd.lognormvariate(6.5, 1)))) for _ in range(5000)], [10] * 1001, [4096] * 5, [4000, 97, 96, 1], [1]):
        histogram = {}
        for n in lengths:
            histogram[n] = histogram.get(n, 0) + 1
        patterns = packing.pack_histogram(histogram)
        back, sequences = {}, 0
        for count, contents in patterns:
            assert sum(n * c for n, c in contents) <= 4096
            sequences += count
            for n, c in contents:
                back[n] = back.get(n, 0) + count * c
        assert back == histogram
        assert sequences <= sum(lengths) / 4096 * 1.03 + 1


def test_no_rows(spark):
    assert packing.pack(cases.empty(spark)).count() == 0


def test_words_go_with_their_task(monkeypatch):
    """A worker outlives its task and serves other steps."""
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": pa.array(["some words"])})
    assert sum(out.num_rows for out in packing._pieces(packing.tokenizer_path(), 4096, 2)([batch])) == 1
    assert packing.word_ids.cache_info().currsize == 0
