"""Parity check of each registered query against its DuckDB oracle SQL:
row count, column names and order-insensitive values (floats to 6 places)."""

from __future__ import annotations

import math

import pandas as pd

from ..sources.readers import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        seq = v.tolist() if hasattr(v, "tolist") else v
        return tuple(_norm(x) for x in seq)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def normalised_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, queries: dict, sql: dict, names=None):
    """Yield (name, status, detail) for each query; status in ok / rows-only / FAIL."""
    con = duck(sf_dir)
    for name, fn in queries.items():
        if names and name not in names:
            continue
        sdf = fn(spark, sf_dir).toPandas()
        if name not in sql:
            yield name, "rows-only", f"{len(sdf)} rows"
            continue
        odf = con.execute(sql[name]).fetchdf()
        if sorted(sdf.columns) != sorted(odf.columns):
            yield name, "FAIL", f"columns {sorted(sdf.columns)} vs {sorted(odf.columns)}"
            continue
        a, b = normalised_rows(sdf), normalised_rows(odf[list(sdf.columns)])
        if a != b:
            sb, sa = set(b), set(a)
            yield name, "FAIL", (f"rows {len(a)} vs {len(b)}; spark-only {[r for r in a if r not in sb][:2]}; "
                                 f"oracle-only {[r for r in b if r not in sa][:2]}")
        else:
            yield name, "ok", f"{len(a)} rows"
