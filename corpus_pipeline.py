"""The corpus pipeline: filters the given documents, removes duplicates, and packs what is left.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; ``run`` writes each one to the shared folder and reads
it again as the next one's input. All but the last return the columns of
``documents``, so a row carries its text to the end.

Learned decisions use ``labels`` of ids that the stage still sees. The quality
classifier rejects below its threshold, the quality rules reject what their base
rules or their learned list reject, exact dedup keeps the smallest id of equal
texts, near-dedup keeps the smallest id of each component of similar texts, and packing
turns the rest into sequences. Defined cases are those of the operators: an empty
table passes through every stage and gives an empty result.

SQL cannot express the classifier, the learned rules, near-dedup or packing, so there
is no oracle; the tests hold ``run`` against a brute-force version.
"""

from pyspark.sql import functions as F

from basketstream.llm import exact_dedup, packing, quality_model, quality_rules, similar
from basketstream.llm.common import ready, table, write_once
from basketstream.llm.labelled import remainder
from basketstream.llm.queries import QUALITY_THRESHOLD

ORACLE_SQL = None


def _labels(spark, sf_dir):
    """Labels of the rows that may be learned from, as in the quality query."""
    return table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)


def quality_classifier(spark, docs, sf_dir):
    """Keeps documents whose quality score reaches the threshold."""
    model = quality_model.train(docs, _labels(ready(spark), sf_dir), F.lit(True))
    return model.filter(docs, QUALITY_THRESHOLD)


def quality_rules_stage(spark, docs, sf_dir):
    """Keeps documents that neither the base rules nor the learned decision list reject."""
    return quality_rules.keep_good(docs, _labels(ready(spark), sf_dir))


def exact_duplicates(spark, docs, sf_dir):
    """Keeps one row of equal texts, that of the smallest id."""
    ready(spark)
    return exact_dedup.keep_first(docs)


def near_duplicates(spark, docs, sf_dir):
    """Keeps one row of each component of similar texts (five-word shingles, 0.8 or more), that of the smallest id."""
    ready(spark)
    return similar.keep_one(docs, from_files=True)


def pack(spark, docs, sf_dir):
    """Pieces of sequences of 2048 ids."""
    ready(spark)
    pieces = packing.pack(docs, extra={"ids_crc32": F.crc32("ids")}, keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules_stage),
    ("exact dedup", exact_duplicates),
    ("near-dedup", near_duplicates),
    ("packing", pack),
]


def run(spark, sf_dir):
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
