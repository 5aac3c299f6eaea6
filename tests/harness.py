"""Local mirror of the driver's correctness gate: Spark result vs DuckDB oracle SQL.

Compares row count, column names (sorted) and the multiset of rows, exactly.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _canon(v.item())
    if isinstance(v, (int, bool)):
        return int(v)
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_canon(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def type_mismatches(spark_df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for name, dtype in spark_df.dtypes:
        want = SPARK_TO_DUCK.get(dtype, dtype)
        if duck_types.get(name) != want:
            out.append(f"{name}: spark {dtype} vs duckdb {duck_types.get(name)}")
    return out


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    bad_types = type_mismatches(spark_df, con, sql)
    if bad_types:
        return False, "types differ: " + "; ".join(bad_types)
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    # pandas dtypes too: a value hash can depend on them (e.g. float64 NaN vs Int64 <NA>)
    # Nullable BIGINT on both sides (a result whose contract says so) has no common pandas dtype.
    longs = {c for c, t in spark_df.dtypes if t == "bigint" and s[c].isna().any()}
    dtypes = [f"{c}: {s[c].dtype} vs {o[c].dtype}" for c in s.columns if str(s[c].dtype) != str(o[c].dtype) and c not in longs]
    if dtypes:
        return False, "pandas dtypes differ: " + "; ".join(dtypes)
    if len(s) != len(o):
        return False, f"row count differs: spark={len(s)} oracle={len(o)}"
    rs, ro = rows(s), rows(o)
    bad = [(a, b) for a, b in zip(rs, ro) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]} cols={sorted(s.columns)}"
    return True, f"{len(s)} rows match"
