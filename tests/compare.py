"""Runs registered queries next to their check SQL and compares rows, types and values.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    # whole numbers with NULLs: one engine hands out doubles, the other nullable integers
    nullable = {c: "float64" for c in frame.columns if str(frame[c].dtype) == "Int64"}
    frame = frame.astype(nullable)[sorted(frame.columns)]
    text = pd.DataFrame({c: frame[c].map(lambda v: "null" if pd.isna(v) else repr(v)) for c in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    """What differs, in words; empty when equal."""
    found = []
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"]
    if len(spark_frame) != len(sql_frame):
        return [f"rows {len(spark_frame)} / {len(sql_frame)}"]
    for c in spark_frame.columns:
        a, b = spark_frame[c].dtype, sql_frame[c].dtype
        kinds = {str(a), str(b)}
        if a != b and not kinds <= {"object", "str"} and not kinds == {"float64", "Int64"}:
            found.append(f"type of {c}: {a} / {b}")
    left, right = _plain(spark_frame), _plain(sql_frame)
    for c in left.columns:
        unequal = (left[c] != right[c]).sum()
        if unequal:
            at = (left[c] != right[c]).idxmax()
            found.append(f"{c}: {unequal} values, e.g. {left[c][at]} / {right[c][at]}")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        started = time.time()
        try:
            rows = queries[name](spark, sf_dir).toPandas()
            took = time.time() - started
            if name in oracles:
                found = differences(rows, con.execute(oracles[name]).fetchdf())
                verdict = "equal" if not found else "DIFFERS " + "; ".join(found)[:600]
                bad += bool(found)
            else:
                verdict = "no check SQL"
            print(f"{name:28s} {took:6.1f}s {len(rows):8d} rows  {verdict}", flush=True)
        except Exception as error:
            bad += 1
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
