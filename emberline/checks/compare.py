"""Run a check in Spark and DuckDB and compare names, row count and values."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_plain(x) for x in v) + "]"
    return str(v)


def canonical(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    kinds = {d[0].lower(): str(d[1]) for d in cursor.description}
    want = canonical(want_cols, cursor.fetchall())
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(c.lower() for c in spark_df.columns) != sorted(c.lower() for c in want_cols):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_cols)}"
    wanted_types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
    }
    for name, kind in spark_df.dtypes:
        if kind in wanted_types and kinds[name.lower()] != wanted_types[kind]:
            return f"type of {name}: {kind} against {kinds[name.lower()]}"
    n_got, n_want = sum(got.values()), sum(want.values())
    if n_got != n_want:
        return f"rows {n_got} != {n_want}"
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"values: {sum((got - want).values())} differ; spark {extra}; sql {lost}"
    return None
