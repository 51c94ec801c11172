"""Run registered queries next to their SQL and compare names, types and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa

# Widths that mean the same on both sides.
_SAME_TYPE = {"string_view": "string", "large_string": "string"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(file))[0]
        db.execute(f"create view {name} as select * from '{file}'")
    return db


def _comparable(table: pa.Table):
    names = sorted(table.column_names)
    types = {n: _SAME_TYPE.get(str(table.schema.field(n).type), str(table.schema.field(n).type))
             for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    rows = sorted(zip(*columns), key=lambda row: tuple((v is None, str(v)) for v in row))
    return types, rows


def differences(rows, db, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    got_types, got = _comparable(rows.toArrow())
    want_types, want = _comparable(db.sql(sql).to_arrow_table())
    if got_types != want_types:
        return f"schema: {got_types} != {want_types}"
    if len(got) != len(want):
        return f"rows: {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows, e.g. {bad[0]}" if bad else None
