"""Comparison of a Spark result with what DuckDB makes of SQL on the same tables."""

from __future__ import annotations

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or repr(value) == "<NA>" or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6) + 0.0
    return str(value)


def rows(pdf, columns):
    return sorted((tuple(plain(v) for v in r) for r in pdf[columns].itertuples(index=False, name=None)), key=repr)


def connect(sf_dir):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return db


def same(df, sql, sf_dir):
    got, want = df.toPandas(), connect(sf_dir).execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
