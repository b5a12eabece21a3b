"""Run a query in Spark and its SQL in DuckDB and compare rows, types included."""

from __future__ import annotations

import glob
import os
import time

import duckdb

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """What differs; empty if nothing does. Rows compare as sorted text, so -0.0 is not 0.0."""
    start = time.time()
    df = query(spark, sf_dir)
    got_rows = df.collect()
    spent = time.time() - start
    want = con.sql(sql)
    order = sorted(df.columns)
    problems = []
    if order != sorted(want.columns):
        return [f"columns {sorted(set(df.columns) ^ set(want.columns))}"]
    have = {f.name: _TYPES.get(f.dataType.simpleString()) for f in df.schema}
    types = dict(zip(want.columns, map(str, want.types)))
    problems += [f"type of {c}: {have[c]} != {types[c]}" for c in order if have[c] != types[c]]
    at = [want.columns.index(c) for c in order]
    got = sorted(repr(tuple(r[c] for c in order)) for r in got_rows)
    expected = sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    missing, extra = sorted(set(expected) - set(got)), sorted(set(got) - set(expected))
    if missing or extra:
        problems.append(f"{len(missing)} rows missing, {len(extra)} extra: {missing[:2]} / {extra[:2]}")
    if not got:
        problems.append("no rows")
    print(f"{spent:6.2f}s {len(got):7d} rows", end=" ")
    return problems
