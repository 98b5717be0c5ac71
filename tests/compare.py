"""Run a Spark query and its SQL twin and compare names, types and values."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# fixed values: Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else v) for v in row)


def differences(con, df, sql):
    """Empty when the two results are equal; otherwise a short description."""
    columns = sorted(df.columns)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    if spark_types != duck_types:
        odd = {c: (spark_types.get(c), duck_types.get(c)) for c in {*spark_types, *duck_types} if spark_types.get(c) != duck_types.get(c)}
        return f"types differ: {odd}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if not _same(a, b)]
    return f"{len(bad)} of {len(ours)} rows differ, first: {columns} {bad[0]}" if bad else ""


def _same(a, b):
    return all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b)
    )
