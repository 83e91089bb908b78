"""Checks made before a target is touched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class GuardError(ValueError):
    """A load was refused; its target is unchanged."""


def require_rows(count: int) -> None:
    if count == 0:
        raise GuardError("the extract holds no rows")


def require_at_most(count: int, cap: int | None) -> None:
    if cap is not None and count > cap:
        raise GuardError(f"the extract holds {count} rows, more than the cap of {cap}")


def require_columns(df: DataFrame, target: T.StructType) -> None:
    """The same columns by name; order does not matter, inserts go by name."""
    have, want = set(df.columns), set(target.names)
    if have != want:
        raise GuardError(f"missing columns {sorted(want - have)}, unknown columns {sorted(have - want)}")


def apply_transform(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The caller's own step; its result is what gets loaded."""
    if transform is None:
        return df
    if not callable(transform):
        raise TypeError("transform must be callable")
    return df.transform(transform)
