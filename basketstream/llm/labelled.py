"""Labelled rows for the classifiers: a bounded training sample and its class rates."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from basketstream.llm.common import write_once


def remainder(id_column, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def training_sample(docs: DataFrame, labels: DataFrame, label_column: str, usable: Column, per_class: int,
                    id_column="doc_id", text_column="text"):
    """(written rows doc_id, label, text; {label: (rows usable, rows sampled)}).

    Up to ``per_class`` rows of each class, in the order of a hash of the id. The
    counts are over all usable labelled rows, so that weights can restore the true
    class rates. Ids labelled more than once count as 1 if any label is; ids are at
    most ``2 * per_class``, so they are broadcast to the documents.
    """
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull() & usable)
    known = known.groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(F.max(label_column).cast("int").alias("label"))
    known = write_once(known, "labels")
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = known.where("label = 0").orderBy(order, "doc_id").limit(per_class).unionByName(
        known.where("label = 1").orderBy(order, "doc_id").limit(per_class))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    sample = write_once(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
    found = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    return sample, {label: (counts[label], found[label]) for label in counts if found.get(label)}


def class_weights(counts: dict) -> dict:
    """Weight of a sampled row of each class, so that weighted class rates are the true ones; mean 1."""
    whole, sampled = (sum(c[i] for c in counts.values()) for i in (0, 1))
    return {label: (all_rows / whole) / (rows / sampled) for label, (all_rows, rows) in counts.items()}


def logistic(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
