"""Compare each query with its SQL twin in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark frame and a SQL result, or None."""
    result = con.execute(sql)
    want_names = [c[0] for c in result.description]
    if sorted(want_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    names = sorted(want_names)
    order = [want_names.index(n) for n in names]
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    got = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(sorted(got, key=repr), sorted(want, key=repr)):
        if mine != theirs:
            return f"{mine} != {theirs}"
    kinds = {n: f.dataType.simpleString() for n, f in zip(names, (df.schema[n] for n in names))}
    types = {n: str(t) for n, t in zip(want_names, (d[1] for d in result.description))}
    clashes = {
        n: (kinds[n], types[n])
        for n in names
        if (kinds[n], types[n]) not in SAME_TYPE
    }
    return f"types {clashes}" if clashes else None


SAME_TYPE = {
    ("bigint", "BIGINT"),
    ("int", "INTEGER"),
    ("string", "VARCHAR"),
    ("double", "DOUBLE"),
    ("boolean", "BOOLEAN"),
    ("timestamp_ntz", "TIMESTAMP"),
}
