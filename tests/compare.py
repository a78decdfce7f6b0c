"""Spark results against DuckDB results, as multisets of rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def compare(spark_df, connection, sql):
    """Differences between a Spark result and an SQL result: [] if none."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = rows_by_name(columns, result.fetchall())
    got = rows_by_name(spark_df.columns, spark_df.collect())
    problems = []
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(columns)}"]
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    if got != expected:
        extra, missing = set(got) - set(expected), set(expected) - set(got)
        problems.append(f"only spark {sorted(extra)[:3]}; only sql {sorted(missing)[:3]}")
    return problems
