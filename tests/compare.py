"""Run registered queries against their SQL oracles: python tests/compare.py SF_DIR [NAME ...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object or str(df[c].dtype).startswith(("string", "str")):
            df[c] = df[c].astype(object).where(df[c].notna(), None)
        elif pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c] + 0.0  # -0.0 and 0.0 are one value
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{c}: {int((~same).sum())} values differ, first {a[c][i]!r} != {b[c][i]!r}"
    kinds = [f"{c} {a[c].dtype}/{b[c].dtype}" for c in a.columns if str(a[c].dtype) != str(b[c].dtype)]
    return "types " + ", ".join(kinds) if kinds else ""


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def main() -> int:
    import __spark_entry__ as entry
    from wayfare.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - start
            problem = differences(got, con.execute(sql[name]).df()) if name in sql else ""
        except Exception as error:  # report and go on
            took, problem, got = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        failed += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {len(got):7d} rows {took:6.2f}s {problem}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
