"""Join helpers for hot keys and for sides of unknown size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest side, in bytes of column data, that is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024


def _data_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text by its length, other columns by a fixed width."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) + 16 if kind == "string" else F.lit(24)
        for n, kind in df.dtypes
    ]
    return reduce(lambda a, b: a + b, sizes)


def fit(*sides: DataFrame, limit: int = BROADCAST_LIMIT) -> list[bool]:
    """Whether the measured data of each side is within ``limit``.

    One job measures all sides: a master joined from others has no usable size
    estimate, and guessing wrong costs a shuffle of the fact table.
    """
    totals = [
        s.select(_data_bytes(s).cast("bigint").alias("b")).agg(
            F.lit(i).alias("i"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
        for i, s in enumerate(sides)
    ]
    size = {r["i"]: r["b"] for r in reduce(DataFrame.union, totals).collect()}  # one row per side
    return [size[i] <= limit for i in range(len(sides))]


def measured(*sides: DataFrame, limit: int = BROADCAST_LIMIT) -> list[DataFrame]:
    """Mark each side for broadcast if its measured data fits ``limit``.

    A larger side is joined by shuffle and hashed there, one partition at a time, so that
    the fact is not sorted (and spilled) for it; AQE splits hot keys.
    """
    return [F.broadcast(s) if ok else s.hint("shuffle_hash") for s, ok in zip(sides, fit(*sides, limit=limit))]


def full_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """FULL OUTER JOIN on one key, safe for hot and null keys.

    Spark cannot split a skewed full outer join, and it hashes all null keys to
    one task. The three parts below can be split: matches, left rows without a
    partner, right rows without a partner. The partner tests use distinct keys,
    which are reduced before they move. Null keys match nothing.
    """
    only_left = [c for c in left.columns if c != key]
    only_right = [c for c in right.columns if c != key]
    kinds = {f.name: f.dataType for d in (left, right) for f in d.schema.fields}

    def fill(names: Sequence[str]) -> list[Column]:
        return [F.lit(None).cast(kinds[n]).alias(n) for n in names]

    def lonely(df: DataFrame, other: DataFrame) -> DataFrame:
        keyed = df.where(F.col(key).isNotNull())
        keys = other.select(key).where(F.col(key).isNotNull()).distinct()
        return keyed.join(keys, key, "left_anti").unionByName(df.where(F.col(key).isNull()))

    columns = [key, *only_left, *only_right]
    both = left.join(right, key, "inner").select(*columns)
    left_alone = lonely(left, right).select(key, *only_left, *fill(only_right))
    right_alone = lonely(right, left).select(key, *fill(only_left), *only_right)
    return both.unionByName(left_alone).unionByName(right_alone.select(*columns))
