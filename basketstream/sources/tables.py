"""Paths of table files, and reads of tables that may not exist yet."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F


def read_or_empty(spark, path: str, schema: str) -> DataFrame:
    """Table at ``path``, or an empty one while nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def lines_or_empty(spark, folder: str) -> DataFrame:
    """Lines of the text files in ``folder``, or none while nothing has been written there."""
    try:
        return spark.read.text(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def relative_path(path: Column, folder: str) -> Column:
    """File path below ``folder``; both as the reader reports them, without a scheme."""
    plain = F.regexp_replace(F.url_decode(path), "^[a-z0-9]+:/+", "/")
    return F.substring(plain, F.lit(len(folder) + 2), F.length(plain))


def table_of(source_file: Column) -> Column:
    """Logical table of a source file: ``a.parquet`` for itself and for ``a.parquet/any/part.parquet``."""
    # Not split_part, which compiles a pattern for every row.
    return F.substring_index(source_file, "/", 1)
