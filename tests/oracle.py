"""Run plans beside their SQL and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = build(spark, sf_dir)
    left = _sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    right = _sorted_rows(names, result.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sum(x != y for x, y in zip(left, right))} rows differ: {sorted(names)} {a} != {b}"
    return None if left else "both empty"


def main(sf_dir: str, only: list[str]) -> None:
    from tests.conftest import test_session
    from __spark_entry__ import oracle_sql, queries

    spark, con = test_session(), connect(sf_dir)
    sql, bad = oracle_sql(), 0
    for name, build in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sql:
                verdict = compare(spark, con, build, sql[name], sf_dir)
            else:
                verdict = None if build(spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name:32s} {time.time() - start:6.2f}s "
              f"{'sql ' if name in sql else 'rows'} {verdict or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
