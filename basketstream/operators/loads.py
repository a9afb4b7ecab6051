"""Loads that become visible as a whole: rows and ledger appear with one file, or not at all.

A load writes its rows and its ledger entries into folders named after it. It first
*claims*: a small file says that these folders may be unfinished. It ends with a
*generation*: a file under the next number that names the load. Readers leave out what
belongs to a claim that no generation names, so the rows of a load that died are never
seen. A number is taken once: of two loads that started from the same generation the
second to finish fails, and its rows stay unseen too.

The generation is written aside and renamed to its name without replacing. That is one
step on file systems with such a rename, as HDFS; on a local folder it is a look and a
rename, and an object store needs a committer of its own.
"""

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from basketstream.operators.quality import QualityError
from basketstream.sources.tables import lines_or_empty

# Partition column of what loads write, and its value for rows that are appended without a claim.
LOAD = "load"
UNCLAIMED = "unclaimed"


def load_of(path):
    """Name of the load that a file below a folder of loads belongs to."""
    return F.regexp_extract(path, f"/{LOAD}=([^/]+)/", 1)


class Loads:
    """Claims and generations of one source below ``root``."""

    def __init__(self, root: str):
        self.claims, self.generations = os.path.join(root, "claims"), os.path.join(root, "generations")

    def latest(self, spark) -> int:
        """Number of the last generation, 0 before the first."""
        return max(map(int, _names(spark, self.generations)), default=0)

    def claim(self, spark) -> str:
        """Name of a new load, whose rows and ledger entries are unseen until it is published."""
        # A leading letter: the reader of partition folders would take some names for numbers.
        load = f"l{uuid.uuid4().hex}"
        _put(spark, self.claims, load, load)
        return load

    def publish(self, spark, number: int, load: str) -> None:
        """Make ``load`` visible as generation ``number``, one more than the generation that it was computed from."""
        try:
            _put(spark, self.generations, f"{number:012d}", load)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            raise QualityError(f"Another load has published generation {number}; nothing of this one is visible") from error

    def unpublished(self, spark) -> list[str]:
        """Loads that are under way or have died; published ones occur twice, as claim and as generation."""
        # Claims are listed last: if there are no more of them than generations, each of them is published.
        published = len(_names(spark, self.generations))
        if len(_names(spark, self.claims)) == published:
            return []
        names = lines_or_empty(spark, self.claims).unionByName(lines_or_empty(spark, self.generations))
        return [row["value"] for row in names.groupBy("value").count().where("count = 1").collect()]


def _names(spark, folder) -> list[str]:
    """Names of the finished files in a folder: one short name per load."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found = (status.getPath().getName() for status in system.listStatus(path))
    return [name for name in found if not name.startswith(("_", "."))]


def _put(spark, folder, name, text):
    """Write a small file that appears whole; an error if there is one of that name."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    system = hadoop.Path(folder).getFileSystem(conf)
    aside = system.makeQualified(hadoop.Path(folder, f"_{uuid.uuid4().hex}"))
    out = system.create(aside)
    out.write(bytearray(text, "utf-8"))
    out.close()
    replace_nothing = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(aside.toUri(), conf).rename(aside, hadoop.Path(aside.getParent(), name), replace_nothing)
    finally:
        system.delete(aside, False)
