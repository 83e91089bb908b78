"""Compare a Spark result with the SQL it must equal, value by value."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    return value.normalize() if isinstance(value, Decimal) else value


def _kind(spark_kind: str) -> str:
    return _KINDS.get(spark_kind, spark_kind.upper())


def differences(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    want = con.sql(sql)
    found = []
    ours = dict(df.dtypes)
    theirs = dict(zip(want.columns, (str(t) for t in want.types)))
    if set(ours) != set(theirs):
        return [f"columns only here {set(ours) - set(theirs)}, only there {set(theirs) - set(ours)}"]
    names = sorted(ours)
    for n in names:
        if _kind(ours[n]).replace(" ", "") != theirs[n].replace(" ", ""):
            found.append(f"type of {n}: {ours[n]} / {theirs[n]}")
    here = Counter(tuple(_cell(r[n]) for n in names) for r in df.collect())
    order = [want.columns.index(n) for n in names]
    there = Counter(tuple(_cell(r[i]) for i in order) for r in want.fetchall())
    if here != there:
        a, b = list((here - there).items())[:2], list((there - here).items())[:2]
        found.append(f"rows {sum(here.values())} / {sum(there.values())}; only here {a}; only there {b}")
    return found
