"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Source clock values are zone-free; UTC keeps instants and local values apart.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes. Long rule lists would end up
    # in one such method; below this limit Spark splits them into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name="basketstream", master=None, extra=None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark):
    """Apply the settings the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_SCRATCH = []


def scratch_dir(spark, purpose):
    """A new folder below the shared folder that the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode session
    that does not name one gets a temporary folder: on a cluster such a folder
    would be invisible to the other machines, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        if not _LOCAL_SCRATCH:
            _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="basketstream-"))
        shared = _LOCAL_SCRATCH[0]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(spark, df, purpose):
    """Write ``df`` once to the shared folder and continue from the written rows."""
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
