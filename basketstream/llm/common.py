"""Small helpers that several text operators share."""

import os
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketstream.session import prepare, scratch_dir

# Texts can be long: a task holds one Arrow batch of whole rows at a time.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings that the text operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_once(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the folder that all executors share and continue from its rows.

    Rows that are read twice, or that depend on the order in which a task met
    them, are settled this way: a lost executor then costs a re-read, and both
    readers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """URI of a new folder that the driver and all executors can reach."""
    path = scratch_dir(spark, purpose)
    return path if ":" in path.split("/")[0] else f"file://{os.path.abspath(path)}"


def filesystem(uri: str):
    """File system and path of a URI, for tasks that write or seek in real files."""
    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, write) -> None:
    """Call ``write(stream)`` on a private name, then give the file its own name.

    A task that is repeated, or that runs twice at a time, replaces a whole file
    by a whole file with the same content.
    """
    files, path = filesystem(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    private = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(private) as stream:
        write(stream)
    files.move(private, path)


def bytes_of(name: str = "text"):
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def batch_of(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, schema.types)], schema=schema)


def squeeze(text: bytes) -> bytes:
    """Every run of ASCII white space becomes one space; other bytes stay."""
    words = text.split()
    if not words:
        return b" " if text else b""
    core = b" ".join(words)
    if text[:1].isspace():
        core = b" " + core
    return core + b" " if text[-1:].isspace() else core
