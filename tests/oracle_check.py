"""Run every registered query against its SQL in DuckDB: python tests/oracle_check.py [folder] [names]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, float):
            return round(x, 6) if not x.is_integer() else int(x)
        return x.item() if hasattr(x, "item") else x

    cols = sorted(frame.columns)
    return sorted(
        (tuple(plain(x) for x in row) for row in frame[cols].astype(object).itertuples(index=False)),
        key=repr,
    )


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows_of(got), rows_of(want)
    if a == b:
        return ""
    only = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} != {len(b)}; only spark {only[0]}; only sql {only[1]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from feedkit.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            got = queries()[name](spark, sf_dir).toPandas()
            sql = oracle_sql().get(name)
            why = compare(got, con.execute(sql).df()) if sql else ""
            tag = "ok" if not why else "FAIL"
            tag = "rows only" if not sql else tag
        except Exception as e:  # noqa: BLE001
            got, why, tag = [], str(e)[:700], "ERROR"
        failed += tag in ("FAIL", "ERROR")
        print(f"{tag:9} {name:26} {len(got):7} rows {time.time() - begin:6.2f}s {why}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
