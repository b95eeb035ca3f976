"""Compare a registered query with its SQL counterpart on DuckDB."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)


def rows_of_duckdb(con, sql):
    result = con.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    names = [result.columns[i] for i in order]
    return names, sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)


def types_of_duckdb(con, sql):
    result = con.sql(sql)
    return {name: str(kind) for name, kind in zip(result.columns, result.types)}


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(con, df, sql):
    """What differs between a result and its SQL counterpart, or None; types, row count and exact values."""
    kinds = {n: SPARK_TYPES.get(k, k) for n, k in df.dtypes}
    wanted = types_of_duckdb(con, sql)
    if kinds != wanted:
        return f"types {sorted(set(kinds.items()) ^ set(wanted.items()))}"
    names, ours = rows_of_spark(df)
    _, theirs = rows_of_duckdb(con, sql)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows instead of {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{names}: {str(a)[:300]} instead of {str(b)[:300]}"
    return None
