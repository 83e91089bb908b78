"""Organisation tree: climbing parents and placing sections in level columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfline.session import materialise, work_path

# The named levels, top first, as the source spells them.
LEVELS = ("L0", "L1", "L2", "L2.5", "L3", "L4-1", "L4-2", "L4-3", "L4-4", "L5-1", "L5-2", "L6")


def level_column(level: str) -> str:
    """``L2.5`` as ``L2_5``, ``L4-1`` as ``L4_1``."""
    return level.replace("-", "_").replace(".", "_")


@dataclass(frozen=True)
class Climb:
    """``chain``: one row per section and ancestor, depth 0 being the section.

    ``cyclic``: ``leaf`` of the sections that are part of a cycle or lead into
    one. They have no place in the tree and no rows in the chain.
    """

    chain: DataFrame
    cyclic: DataFrame


def _open(chain: DataFrame, parent: str, span: int) -> DataFrame:
    """Walks that go on after ``span`` sections, and where."""
    return chain.where((F.col("depth") == span - 1) & F.col(parent).isNotNull()).select("leaf", F.col(parent).alias("_up"))


def climb(tree: DataFrame, node: str, parent: str, carry: Sequence[str] = ()) -> Climb:
    """Follow parent pointers from every node until no parent is found, however deep.

    The chain doubles: after a round it holds the next ``span`` sections of every
    walk, and a walk that is open there goes on by joining the chain of the section
    it points at. So a tree needs as many joins as its depth has binary digits, each
    written as a table. A walk that never ends points at such a walk again; once all
    open walks point at open walks, what is open is a cycle or leads into one.
    Rows without a parent leave before the join, so nulls never form a hot key, and a
    parent shared by many nodes is a probe-side skew that AQE splits (or a broadcast).
    Repeated rows of a section are walks of their own.
    """
    columns = [node, parent, *carry]
    first = materialise(tree.select(F.col(node).alias("leaf"), F.lit(0).alias("depth"), *columns), "tree")
    stored = tree.sparkSession.read.schema(first.schema)
    base, paths, span = work_path(tree.sparkSession, "climb"), [], 1
    chain, last, before = first, first, None
    while True:
        above = chain.select(F.col("leaf").alias("_leaf"), F.col("depth").alias("_depth"), *[F.col(c).alias(f"_t_{c}") for c in columns])
        longer = (_open(last, parent, span).join(above, F.col("_up") == F.col("_leaf"))
                  .select("leaf", (F.col("_depth") + span).alias("depth"), *[F.col(f"_t_{c}").alias(c) for c in columns]))
        paths.append(f"{base}/span-{span}")
        seen, span = Observation(), span * 2
        still = (F.col("depth") == span - 1) & F.col(parent).isNotNull()
        longer.observe(seen, F.count_if(still).alias("open")).write.parquet(paths[-1])
        chain, last = first.unionByName(stored.parquet(*paths)), stored.parquet(paths[-1])
        number = seen.get["open"]
        if not number:
            return Climb(chain, first.select("leaf").limit(0))
        # Walks that end lower the number; only where none did can all of them be endless.
        if before is not None and number >= before:
            open_ = _open(last, parent, span)
            cyclic = open_.select("leaf").distinct()
            if open_.join(cyclic.withColumnRenamed("leaf", "_leaf"), F.col("_up") == F.col("_leaf"), "left_anti").isEmpty():
                break
        before = number
    cyclic = materialise(cyclic, "cyclic")
    return Climb(chain.join(cyclic, "leaf", "left_anti"), cyclic)


def level_columns(chain: DataFrame, names: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """One row per leaf: code, English and Japanese name of its section at each level.

    ``chain`` needs ``leaf, depth, code, level``; ``names`` needs ``code,
    name_en, name_jp``. Where a level occurs twice in a chain the nearer one
    counts. A leaf without any listed level has a row of nulls. The level list is
    fixed, so the pivot needs no pass to find it.
    """
    spellings = {lv: level_column(lv) for lv in levels}
    placed = chain.join(names, "code", "left")
    entry = F.struct("depth", "code", "name_en", "name_jp")
    wide = placed.groupBy("leaf").pivot("level", list(levels)).agg(F.min(entry))
    columns = []
    for lv, name in spellings.items():
        columns += [
            F.col(f"`{lv}`.code").alias(f"{name}Code"),
            F.col(f"`{lv}`.name_en").alias(f"{name}NameEN"),
            F.col(f"`{lv}`.name_jp").alias(f"{name}NameJP"),
        ]
    return wide.select(F.col("leaf").alias("identifier"), *columns)
