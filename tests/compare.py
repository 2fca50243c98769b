"""Order-free comparison of a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None."""
    got, want = _sorted(spark_df.toPandas()), _sorted(con.execute(sql).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} instead of {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for c in got.columns:
        if pd.api.types.is_numeric_dtype(want[c]) != pd.api.types.is_numeric_dtype(got[c]):
            return f"{c}: type {got[c].dtype} instead of {want[c].dtype}"
        a, b = got[c].where(got[c].notna(), None), want[c].where(want[c].notna(), None)
        if not a.eq(b).where(a.notna() | b.notna(), True).all():
            at = (~a.eq(b).where(a.notna() | b.notna(), True)).idxmax()
            return f"{c}: {got.loc[at].to_dict()} instead of {want.loc[at].to_dict()}"
    return None
