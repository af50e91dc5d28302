"""Compare queries with their SQL in DuckDB: names, kinds of types, rows."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem".split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet'")
    return con


def _plain(a: pd.DataFrame, b: pd.DataFrame) -> list[pd.DataFrame]:
    """Both frames with columns and rows in the same order and comparable values."""
    out = [df[sorted(df.columns)].copy() for df in (a, b)]
    for c in out[0].columns:
        text = any(df[c].dtype == object or str(df[c].dtype).startswith("datetime") for df in out)
        for df in out:
            if str(df[c].dtype).startswith("datetime"):
                df[c] = df[c].dt.strftime("%Y-%m-%d")
            if text:
                df[c] = df[c].map(lambda v: None if pd.isna(v) else str(v)).astype(object)
    return [df.sort_values(list(df.columns), ignore_index=True) for df in out]


def kinds(names, types) -> dict[str, str]:
    def kind(t: str) -> str:
        t = t.lower()
        for k, words in (("int", ("bigint", "integer", "hugeint", "int", "long")), ("double", ("double", "decimal")),
                         ("date", ("date",)), ("bool", ("bool",)), ("text", ("varchar", "string"))):
            if any(t.startswith(w) for w in words):
                return k if t not in ("hugeint", "integer", "int") and not t.startswith("decimal") else t
        return t

    return {n: kind(t) for n, t in zip(names, types)}


def differences(spark, con, root: str, query, sql: str) -> list[str]:
    start = time.time()
    df = query(spark, root)
    got = df.toPandas()
    spent = time.time() - start
    rel = con.sql(sql)
    want, want_kinds = rel.df(), kinds(rel.columns, [str(t) for t in rel.types])
    got_kinds = kinds(df.columns, [f.dataType.simpleString() for f in df.schema.fields])
    out = []
    if got_kinds != want_kinds:
        out.append("schema: " + str({c: (got_kinds.get(c), want_kinds.get(c)) for c in {*got_kinds, *want_kinds}
                                     if got_kinds.get(c) != want_kinds.get(c)}))
    if len(got) != len(want):
        out.append(f"rows: {len(got)} != {len(want)}")
    if not out:
        a, b = _plain(got, want)
        for c in a.columns:
            same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
            if not same.all():
                at = (~same).idxmax()
                out.append(f"{c}: {(~same).sum()} differ, e.g. {a[c][at]!r} != {b[c][at]!r}")
    differences.last = (spent, len(got))
    return out
