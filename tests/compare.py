"""Rows of two engines as comparable values."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v.item() if hasattr(v, "item") else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(_value, r)) for r in df.itertuples(index=False)), key=repr)
