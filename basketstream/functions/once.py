"""Columns that are computed exactly once per row.

The optimizer merges projections and moves filters below them by copying the
expressions involved. For cheap expressions that is good; for JSON parsing it
means parsing the same text again in the filter and for every field. A generator
over a one-element array is not copied and not crossed by filters, keeps one row
per row, and stays inside whole-stage code generation.
"""

from pyspark.sql import Column, DataFrame, functions as F


def add_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def isolate(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed once before anything built on top."""
    return df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
