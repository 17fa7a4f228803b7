"""Compare a registered query with its check SQL in DuckDB on the same Parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return float(value)
    if value.__class__.__name__ == "Decimal":
        return int(value) if value == int(value) else float(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(v) for v in r) for r in df.select(*names).collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), sorted(rows, key=repr)


def difference(spark_result, duck_result) -> str | None:
    (s_names, s_rows), (d_names, d_rows) = spark_result, duck_result
    if s_names != d_names:
        return f"columns {s_names} vs {d_names}"
    if s_rows == d_rows:
        return None
    s_set, d_set = set(s_rows), set(d_rows)
    return (
        f"{len(s_rows)} vs {len(d_rows)} rows; columns {s_names}; "
        f"only Spark {sorted(s_set - d_set, key=repr)[:4]}; only SQL {sorted(d_set - s_set, key=repr)[:4]}"
    )
