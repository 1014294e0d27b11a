"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def difference(spark, con, name: str, sf: str) -> tuple[str | None, int]:
    """What differs between a query and its SQL (None if nothing) and the number of rows."""
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    got = sorted([tuple(_plain(r[c]) for c in columns) for r in df.collect()], key=_key)
    if name not in SQL:
        return None, len(got)
    rel = con.sql(SQL[name])
    if sorted(rel.columns) != columns:
        return f"columns {columns} against {sorted(rel.columns)}", len(got)
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for c in columns:
        if KINDS.get(types[c]) != want_types[c]:
            return f"type of {c}: {types[c]} against {want_types[c]}", len(got)
    order = [rel.columns.index(c) for c in columns]
    want = sorted([tuple(_plain(r[i]) for i in order) for r in rel.fetchall()], key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"row {dict(zip(columns, a))} against {dict(zip(columns, b))}", len(got)
        if any(isinstance(x, float) and math.copysign(1, x) != math.copysign(1, y) for x, y in zip(a, b)):
            return f"sign of zero in {a}", len(got)
    return None, len(got)


def main() -> None:
    """``python -m checks.compare <sf_dir> [name part ...]``"""
    from hanok.session import build_session

    sf, parts = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            diff, rows = difference(spark, con, name, sf)
        except Exception as e:  # noqa: BLE001
            diff, rows = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name:32} rows={rows:6} {time.time() - start:5.2f}s {diff or ''}", flush=True)
    print(f"{bad} differ")
    spark.stop()


if __name__ == "__main__":
    main()
