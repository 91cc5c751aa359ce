"""Run registered queries against their SQL twins in DuckDB, the way the driver does."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(v) else (float(v) if isinstance(v, float) else v) for v in row) for row in df.itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark_df, con, statement: str) -> list[str]:
    got, want = spark_df.toPandas(), con.execute(statement).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} and {sorted(want.columns)}"]
    out = []
    kinds = [(c, got[c].dtype.kind, want[c].dtype.kind) for c in sorted(got.columns)]
    out += [f"type of {c}: {a} and {b}" for c, a, b in kinds if a != b and len(got) and not (a in "iu" and b in "iu")]
    if len(got) != len(want):
        out.append(f"rows {len(got)} and {len(want)}")
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        out.append(f"values: {len(only_a)} only here, {len(only_b)} only there; {sorted(only_a, key=repr)[:3]} {sorted(only_b, key=repr)[:3]}")
    return out


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from kinmatch.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            statement = oracle_sql().get(name)
            if statement is None:
                print(f"rows {name} {len(df.toPandas())} {time.time() - start:.1f}s", flush=True)
                continue
            issues = differences(df, con, statement)
        except Exception as exc:  # noqa: BLE001
            issues = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        bad += bool(issues)
        print(f"{'BAD ' if issues else 'ok  '} {name} {time.time() - start:.1f}s", *issues, flush=True)
    print("bad:", bad)
