"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(
        (x is None, str(x)) for x in r))


def compare(spark_df, sf_dir: str, sql: str):
    """Return (ok, message)."""
    s_cols, s_rows = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    d_cols, d_rows = canon(*duck(sf_dir, sql))
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(s_rows)} rows equal"
