"""Run registered queries beside their SQL and compare the results; `python tests/oracle_check.py
<data folder> [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str, build, sql: str) -> tuple[int, str | None]:
    """Row count and the first difference, if any."""
    df = build(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return len(ours), f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return len(ours), f"{a} != {b}"
    return len(ours), None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from shopgrain.session import local_session

    spark, con = local_session(), connect(folder)
    built, sql, bad = queries(), oracle_sql(), 0
    for name in names or built:
        start = time.time()
        try:
            rows, fault = compare(spark, con, folder, name, built[name], sql[name])
        except Exception as error:  # noqa: BLE001 - report every query, then go on
            rows, fault = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += fault is not None
        print(f"{'FAIL' if fault else 'ok':4} {name:32} {rows:7} rows {time.time() - start:6.2f}s "
              f"{fault or ''}", flush=True)
    print(f"{bad} failed; without SQL: {sorted(set(built) - set(sql))}; "
          f"without query: {sorted(set(sql) - set(built))}")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
