import hashlib
import re

from shelfline.llm import fill_middle as fim
from tests.llm import cases

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return key, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, frame_bytes):
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    filled = fim.fill_middle(fim.store(docs, frame_bytes), frame_bytes=frame_bytes)
    want = [brute(k, t) for k, t, *_ in rows]
    got = [tuple(r) for r in fim.digests(filled).collect()]
    assert sorted(got, key=str) == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t, *_) in zip(want, rows, strict=True)), key=str)
    assert sorted([(r.doc_id, r.text) for r in fim.outputs(filled).collect()], key=str) == sorted([(w[0], w[5]) for w in want], key=str)
    assert sorted([(r.doc_id, r.text) for r in fim.restore(filled).collect()], key=str) == sorted([(k, t or "") for k, t, *_ in rows], key=str)


ODD = [" lead", "trail ", " \t both \n", "  no break 　 spaces", "a\x1cb c", "x <P> y z", "<S", "P> <", "é" * 9 + " ü", "🙂 🙂🙂  🙂", "w" * 700, ("long " * 300) + "\n", "<\x20P>"]


def test_equals_brute_force_whatever_the_frames(spark):
    rows = cases.rows(0, 60) + [(1000 + 100 * k + i, t) for i, t in enumerate(ODD) for k in range(8)]
    for frame_bytes in (7, 64, 1 << 16):
        check(spark, rows if frame_bytes > 7 else [r for r in rows if len(r[1] or "") < 2000], frame_bytes)


def test_only_cut_frames_are_opened():
    """A cut reads one frame; frames between cuts go to the output as they lie."""
    texts = fim.Texts(100, 3)
    text = b" word" * 1000
    frames, n = fim.frames_of(text, 100, texts.close)
    opened, plain = [], texts.open
    texts.open = lambda data: opened.append(data) or plain(data)
    cut = texts.cut(frames, n, len(text), 501)
    assert len(opened) == 1 and cut == (25, 5, 2505)
    out = texts.joined(texts.between(frames, (0, 0, 0), cut))
    assert out[:25] == [f["data"] for f in frames[:25]] and len(opened) == 2


def test_marks_across_frames():
    for size in (1, 2, 3, 5):
        whole = b"<S>su<ff<P>pre<M>mid"
        frames = [whole[k:k + size] for k in range(0, len(whole), size)]
        assert b"".join(fim.restored(frames, "spm", lambda f: f)) == b"premidsu<ff"


def test_no_rows_and_clashing_columns(spark):
    assert fim.digests(fim.fill_middle(fim.store(cases.empty(spark)))).count() == 0
    clash = spark.createDataFrame([(5, "a b c", 1, "f", b"x")], "doc_id long, text string, n long, form string, frames binary")
    assert fim.digests(fim.fill_middle(fim.store(clash))).first()["n"] == 3
