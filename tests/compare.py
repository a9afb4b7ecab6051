"""Compares a registered query with its SQL oracle: names, types and all values."""

import glob
import math
import os

import duckdb
from pyspark.sql import types as T

# Spark type -> DuckDB type of the same values.
TYPES = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
}


def open_tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _sorted_rows(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=lambda row: tuple(map(str, row)))


def mismatch(spark_df, connection, sql):
    """None when equal, else a description of the difference."""
    columns = sorted(spark_df.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != columns:
        return f"columns {columns} != {sorted(relation.columns)}"
    found = dict(zip(relation.columns, map(str, relation.types)))
    fields = {field.name: TYPES.get(type(field.dataType), str(field.dataType)) for field in spark_df.schema}
    wrong = {name: (fields[name], found[name]) for name in columns if fields[name] != found[name]}
    if wrong:
        return f"types {wrong}"
    ours = _sorted_rows(tuple(row) for row in spark_df.select(*columns).collect())
    chosen = ", ".join(f'"{name}"' for name in columns)
    theirs = _sorted_rows(connection.sql(f"SELECT {chosen} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(different)} rows differ, first {different[0]} in {columns}" if different else None
