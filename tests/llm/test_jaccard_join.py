import re
import tracemalloc

import numpy as np
import pyarrow as pa

from shelfline.llm import common
from shelfline.llm.jaccard_join import jaccard_components, shingle_sets
from tests.llm import cases


def brute(rows):
    sets = []
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((i, {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    up = list(range(len(sets)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def test_components_equal_brute_force(spark):
    for seed, n in ((0, 240),):
        got = [tuple(r) for r in jaccard_components(cases.documents(spark, seed, n)).select("doc_id", "n_shingles", "component_id").collect()]
        assert sorted(got, key=str) == brute(cases.rows(seed, n))


def test_copies_of_one_original(spark):
    """Copies whose changes do not overlap link to the original but hardly to each other."""
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for c in range(1, 60):
        w = list(base)
        for k in range(3):
            w[(c * 7 + k * 61) % 200] = f"z{c}-{k}"
        rows.append((c, " ".join(w)))
    got = [tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_no_rows(spark):
    assert jaccard_components(cases.empty(spark)).count() == 0


def taken(step):
    """What ``step`` returns, and the most bytes it held meanwhile."""
    tracemalloc.start()
    try:
        return step(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_counting_holds_few_bytes_a_value():
    """Half of the values of three blocks are shared by all of them."""
    rng = np.random.default_rng(3)
    both = np.unique(rng.integers(0, 1 << 36, 100_000, dtype=np.uint64))
    blocks = [np.unique(np.concatenate([both, rng.integers(0, 1 << 36, 100_000, dtype=np.uint64)])) for _ in range(3)]
    sent = pa.table({"block": pa.array(range(3), pa.int32()), "packed": [common._pack(b) for b in blocks], "counts": [bytes([200]) * len(b) for b in blocks]})
    found, most = taken(lambda: common._count_bucket(sent))
    assert most < 55 * sum(map(len, blocks))
    assert found.column("block").to_pylist() == [0, 1, 2]
    times = dict(zip(*(x.tolist() for x in np.unique(np.concatenate(blocks), return_counts=True)), strict=True))
    one = found.slice(1, 1)
    known, most = taken(lambda: common.unpack_shared(one))
    assert most < 40 * len(blocks[1])
    assert known(blocks[1] << np.uint64(24)).tolist() == [min(255, 200 * times[v]) for v in blocks[1].tolist()]
    assert known(np.array([1 << 62], np.uint64)).tolist() == [1]


def test_few_texts_meet_one_python_step_a_task(spark):
    """Behind a single partition all three steps would run in one task, each in a worker of its own."""
    plan = shingle_sets(cases.documents(spark, 0, 20))._jdf.queryExecution().executedPlan().toString()
    python = [line for line in plan.splitlines() if "InArrow" in line or "Exchange" in line]
    steps = [k for k, line in enumerate(python) if "InArrow" in line]
    assert len(steps) == 3 and all("Exchange" in "".join(python[a + 1:b]) for a, b in zip(steps[:-1], steps[1:]))
