"""Run registered queries and their SQL on the same tables and compare schema and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)) if v is not None else "", v if v is not None else 0) for v in row)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return list(zip(*[table.column(n).to_pylist() for n in names])) if table.num_rows else []


def _type(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def difference(got: pa.Table, want: pa.Table) -> str | None:
    """First difference in schema or values, rows in any order; None if there is none."""
    a = {n: _type(got.schema.field(n).type) for n in sorted(got.column_names)}
    b = {n: _type(want.schema.field(n).type) for n in sorted(want.column_names)}
    if a != b:
        return f"schema {set(a.items()) ^ set(b.items())}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} <> {want.num_rows}"
    left, right = sorted(_rows(got), key=_key), sorted(_rows(want), key=_key)
    bad = [(x, y) for x, y in zip(left, right) if x != y]
    if not bad:
        return None
    x, y = bad[0]
    close = all(a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9)) for a, b in zip(x, y))
    return f"{len(bad)} rows differ{' (within 1e-9)' if close else ''}: {sorted(got.column_names)} {x} <> {y}"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark, con = local_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in [n for n in queries if not names or any(n.startswith(p) for p in names)]:
        start = time.time()
        try:
            got = queries[name](spark, folder).toArrow()
            spent = time.time() - start
            if name not in oracle:
                print(f"rows  {name} {got.num_rows} {spent:.1f}s", flush=True)
                continue
            problem = difference(got, con.sql(oracle[name]).to_arrow_table())
        except Exception as error:  # noqa: BLE001
            problem, spent = f"{type(error).__name__} {str(error)[:600]}", time.time() - start
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'}  {name} {spent:.1f}s {problem or got.num_rows}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
