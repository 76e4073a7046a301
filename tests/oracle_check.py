"""Run registered queries next to their SQL and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(round(value, 9))
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        [tuple(plain(r[i]) for i in order) for r in rows], key=repr
    )


def differences(con, df, sql: str) -> str | None:
    relation = con.execute(sql)
    want = table([d[0] for d in relation.description], relation.fetchall())
    got = table(df.columns, df.collect())
    if want == got:
        return None
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    extra = [r for r in got[1] if r not in set(want[1])][:3]
    missing = [r for r in want[1] if r not in set(got[1])][:3]
    return f"{len(got[1])} rows instead of {len(want[1])}; extra {extra}; missing {missing}"
