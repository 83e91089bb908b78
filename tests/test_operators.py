import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import joins, org, reshape, rows
from shelfline.plans import hr


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_full_outer_hot_and_null_keys(spark):
    left = [("hot", i) for i in range(50)] + [(None, 1), (None, 2), ("solo", 9)]
    right = [("hot", "a"), ("hot", "b"), (None, "n"), ("other", "c")]
    a = spark.createDataFrame(left, "k string, x int")
    b = spark.createDataFrame(right, "k string, y string")
    want = Counter({("hot", i, y): 1 for i in range(50) for y in "ab"})
    want += Counter([(None, 1, None), (None, 2, None), ("solo", 9, None), (None, None, "n"), ("other", None, "c")])
    assert bag(joins.full_outer(a, b, "k")) == want


def test_measured_broadcasts_only_what_fits(spark):
    fact = spark.range(1000).withColumn("k", F.col("id") % 10)
    side = spark.range(10).select(F.col("id").alias("k"), F.lit("x" * 100).alias("text"))
    assert joins.fit(side, limit=10_000) == [True]
    assert joins.fit(side, fact, limit=500) == [False, False]
    small, = joins.measured(side)
    plan = fact.join(small, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    large, = joins.measured(side, limit=500)
    assert "strategy=broadcast" not in fact.join(large, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_keep_first_matches_pandas(spark):
    data = [("a", 2, "x"), ("a", 1, None), ("a", 1, "y"), ("b", None, "z"), ("b", 5, "w"), (None, 1, "q")]
    got = {tuple(r) for r in rows.keep_first(spark.createDataFrame(data, "k string, n int, t string"), "k", ["n"]).collect()}
    assert got == {("a", 1, "y"), ("b", 5, "w"), (None, 1, "q")}


@pytest.mark.parametrize("copies", [0, 400])
def test_row_numbers_are_dense(spark, copies):
    # A third of the rows and more are copies of one row.
    data = [(i % 7, f"t{i}") for i in range(600)] + [(3, "copy")] * copies
    df = spark.createDataFrame(data, "a int, b string").repartition(5)
    numbered = rows.with_row_number(df, ["a", "b"]).orderBy("row_number").collect()
    assert [r.row_number for r in numbered] == list(range(len(data)))
    assert [(r.a, r.b) for r in numbered] == sorted(data)


def test_row_slices(spark):
    df = spark.range(100).repartition(3)
    got = sorted(r.id for r in rows.row_slices(df, ["id"], [(0, 10), (95, None)]).collect())
    assert got == [*range(10), *range(95, 100)]


@pytest.mark.parametrize("n", [1, 40, 700, 2999, 3000, 5000])
def test_first_rows_with_ties_nulls_and_a_hot_key(spark, folder, monkeypatch, n):
    """The bound falls into a key that a third of the rows share, among nulls, and beyond the table."""
    monkeypatch.setattr(rows, "ONE_TASK", 10)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * 7919) % 211).cast("int").alias("a"),
        F.when(F.col("id") % 3 != 0, (F.col("id") * 31) % 17).cast("string").alias("b"))
    df.repartition(6).write.mode("overwrite").parquet(folder(f"t{n}"))
    table = spark.read.parquet(folder(f"t{n}"))
    every = sorted((tuple(r) for r in table.collect()), key=lambda r: tuple((x is not None, x) for x in r))
    got = rows.first_rows(table, n, ["a", "b"])
    assert bag(got) == Counter(every[:n])
    if n < 1000:
        text = got._jdf.queryExecution().toString()
        assert "rangepartitioning" not in text and ("PushedFilters: [Or(IsNull(a),LessThanOrEqual(a" in text or "PushedFilters: [IsNull(a)]" in text)


def test_rows_from_a_scan_are_numbered_in_one_write(spark, folder, monkeypatch):
    spark.range(1000).selectExpr("id % 7 as k", "1 as same").write.parquet(folder("scan"))
    scan = spark.read.parquet(folder("scan"))
    made, keep = [], rows.materialise
    monkeypatch.setattr(rows, "materialise", lambda df, name: made.append(name) or keep(df, name))
    for df, writes in ((scan, ["numbered"]), (scan.where("k > 0"), ["numbered"]), (scan.distinct(), ["arrival", "numbered"]),
                       (scan.repartition(3), ["arrival", "numbered"]), (scan.withColumn("r", F.rand()), ["arrival", "numbered"])):
        made.clear()
        out = rows.with_row_number(df, ["k"])
        assert sorted(r.row_number for r in out.collect()) == list(range(df.count())) and made == writes


def test_append_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    assert bag(rows.append_frames(a, b)) == Counter([(1, None), (None, "t")])


def test_record_batches(spark):
    df = spark.range(25).withColumn("v", F.col("id") * 2)
    docs = reshape.record_batches(df, "sales", ["id"], batch=10, per_dir=2).orderBy("file_number").collect()
    assert [(d.part, d.file_number, len(d.sales)) for d in docs] == [(0, 0, 10), (0, 1, 10), (1, 2, 5)]
    assert [r.id for d in docs for r in d.sales] == list(range(25))


def test_usage(spark):
    wide = spark.createDataFrame([("a", 1, None, 5), ("a", 2, 3, 7)],
                                 "Time string, `2021-01-01` int, `2021-01-02` int, Amount int")
    pdf = pd.DataFrame({"Time": ["a", "a"], "d1": [1, 2], "d2": [None, 3], "Amount": [5, 7]})
    totals = sorted(r.usage_ar for r in reshape.usage_totals(wide).collect())
    assert totals == sorted(pdf.drop(["Time", "Amount"], axis=1).sum(axis=1).astype(int))
    long = bag(reshape.usage_long(wide))
    assert sum(long.values()) == 6
    assert ("a", pd.Timestamp("2099-01-01").date(), 5.0) in long
    assert ("a", pd.Timestamp("2021-01-02").date(), None) in long


TREE = "SectionCD string, ParentSectionCD string, LCD string, SectionNameEN string, name_localized string"


def test_climb_doubles_its_reach(spark, monkeypatch):
    """A chain of 200 sections, a cycle of three with a tail, a repeated section and a parent that is missing."""
    rows = [(f"n{k:03d}", f"n{k - 1:03d}" if k else None, "L") for k in range(200)]
    rows += [("c0", "c1", "L"), ("c1", "c2", "L"), ("c2", "c0", "L"), ("t0", "c1", "L"), ("t1", "t0", "L"), ("self", "self", "L")]
    rows += [("d", "n003", "L"), ("d", "gone", "M"), ("e", "d", "L"), (None, "n001", "L")]
    made = []
    keep = org.work_path
    monkeypatch.setattr(org, "work_path", lambda s, n: made.append(keep(s, n)) or made[-1])
    climbed = org.climb(spark.createDataFrame(rows, "code string, parent string, kind string"), "code", "parent", ["kind"])
    want = Counter()
    for code, parent, kind in rows:
        walks = [(0, code, parent, kind)]
        while walks and code not in ("c0", "c1", "c2", "t0", "t1", "self"):
            want.update((code, *w) for w in walks)
            walks = [(d + 1, c, p, k) for d, _, up, _ in walks for c, p, k in rows if up is not None and c == up]
    assert bag(climbed.chain.select("leaf", "depth", "code", "parent", "kind")) == want
    assert {r.leaf for r in climbed.cyclic.collect()} == {"c0", "c1", "c2", "t0", "t1", "self"}
    assert len(os.listdir(made[0])) <= 9  # joins for a depth of 200


def test_climb_reports_cycles(spark):
    tree = spark.createDataFrame(
        [("r", None, "L0", "R", "r"), ("a", "r", "L1", "A", "a"), ("b", "a", "L2.5", "B", "b"),
         ("x", "y", "L1", "X", "x"), ("y", "x", "L2", "Y", "y"), ("o", "gone", "L2", "O", "o")], TREE)
    climbed = org.climb(tree, "SectionCD", "ParentSectionCD", ["LCD"])
    chain = {(r.leaf, r.depth): r.SectionCD for r in climbed.chain.collect()}
    assert chain[("b", 1)] == "a" and chain[("b", 2)] == "r" and ("b", 3) not in chain
    assert ("o", 1) not in chain
    assert {r.leaf for r in climbed.cyclic.collect()} == {"x", "y"}
    placed, _ = hr.levels(tree)
    by_leaf = {r.identifier: r for r in placed.collect()}
    assert set(by_leaf) == {"r", "a", "b", "o"}
    assert (by_leaf["b"].L0Code, by_leaf["b"].L1NameEN, by_leaf["b"].L2_5NameJP) == ("r", "A", "b")
    assert by_leaf["b"].L2Code is None
    assert len(placed.columns) == 37


def test_climb_has_no_depth_limit(spark):
    rows = [(f"s{k:02d}", f"s{k - 1:02d}" if k else None, "L0" if k == 0 else "L7", "N", "n") for k in range(21)]
    loop = [("p", "q", "L1", "P", "p"), ("q", "r", "L1", "Q", "q"), ("r", "q", "L1", "R", "r"), ("t", "p", "L2", "T", "t"), ("only", None, "L7", "O", "o")]
    placed, climbed = hr.levels(spark.createDataFrame(rows + loop, TREE))
    by_leaf = {r.identifier: r.L0Code for r in placed.collect()}
    assert {k: v for k, v in by_leaf.items() if k != "only"} == {f"s{k:02d}": "s00" for k in range(21)}
    assert by_leaf["only"] is None
    assert {r.leaf for r in climbed.cyclic.collect()} == {"p", "q", "r", "t"}


def test_nearer_section_wins_a_level(spark):
    tree = spark.createDataFrame([("r", None, "L0", "R", "r"), ("a", "r", "L1", "A", "a"), ("b", "a", "L1", "B", "b")], TREE)
    placed, climbed = hr.levels(tree)
    assert {r.identifier: r.L1Code for r in placed.collect()} == {"r": None, "a": "a", "b": "b"}
    assert climbed.cyclic.isEmpty()


def test_null_key_master_is_no_partner(spark):
    a = spark.createDataFrame([("1", "n1")], "personIdExternal string, nationality string")
    b = spark.createDataFrame([], "personIdExternal string, emailAddress string")
    assert bag(joins.full_outer(a, b, "personIdExternal")) == Counter([("1", "n1", None)])


def test_distinct_rows_are_dealt_before_they_are_kept(spark):
    df = spark.range(2000).selectExpr("cast(if(id % 2 = 0, 7, id) as string) as a", "if(id % 3 = 0, null, 'x') as b")
    got = rows.distinct_rows(df)
    assert bag(got) == bag(df.distinct())
    text = rows.distinct_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text and text.rindex("HashAggregate") < text.index("REBALANCE")  # nothing is kept before


def test_spread_follows_the_stored_size(spark, folder):
    spark.range(50_000).selectExpr("id as k", "sha2(cast(id as string), 256) as v").write.parquet(folder("s"))
    stored = spark.read.parquet(folder("s"))
    assert rows.spread(stored, "k", piece=200_000).rdd.getNumPartitions() > 10
    assert rows.spread(stored, "k").count() == 50_000
