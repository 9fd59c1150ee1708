"""Compare a Spark result with a DuckDB result: same columns, same rows, any order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if value != value else value + 0.0
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"
    want = bag(columns, relation.fetchall())
    got = bag(spark_df.columns, spark_df.collect())
    if got == want:
        return None
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows on {sorted(columns)}; "
        f"only Spark: {list((got - want).items())[:2]}; only DuckDB: {list((want - got).items())[:2]}"
    )
