"""Spark results against DuckDB's, order aside."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6g}"
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted([tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False)], key=repr)
