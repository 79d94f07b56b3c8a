"""Run the registered queries beside their SQL twins: ``check_oracles.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwise.plans.bindings import TABLES  # noqa: E402
from panelwise.plans.catalog import ORACLES, QUERIES  # noqa: E402
from panelwise.session import local_session  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(value):
    if pd.isna(value):
        return None
    return value.item() if hasattr(value, "item") else value


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, missing values as None, rows in a fixed order."""
    columns = {c: [_plain(v) for v in df[c]] for c in sorted(df.columns)}
    out = pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in columns.items()})
    order = sorted(range(len(out)), key=lambda i: [repr(v) for v in out.iloc[i]])
    return out.iloc[order].reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what is wrong."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    if a.equals(b):
        return None
    for c in a.columns:
        for x, y in zip(a[c], b[c], strict=True):
            if x != y or isinstance(x, float) and isinstance(y, float) and repr(x) != repr(y):
                return f"{c}: {x!r} ({type(x).__name__}) != {y!r} ({type(y).__name__})"
    return None


def main() -> int:
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(os.environ.get("CORES", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf).toPandas()
            spent = time.time() - start
            if name not in ORACLES:
                note = f"{len(got)} rows, no SQL twin"
            else:
                wrong = difference(got, con.execute(ORACLES[name]).df())
                bad += wrong is not None
                note = f"{len(got)} rows ok" if wrong is None else f"MISMATCH {wrong}"
        except Exception as e:  # Report and go on with the next query.
            spent, bad = time.time() - start, bad + 1
            note = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:26s} {spent:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
