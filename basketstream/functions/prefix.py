"""Running totals in global order without a single-task window.

A window without PARTITION BY pulls every row into one task. Here rows are cut
into ordered buckets at approximate quantiles of the ordering value; only the
per-bucket totals (at most ``MAX_BUCKETS`` rows) go through a global window, and
each bucket runs its own window in its own task. Equal values always share a
bucket, so the result does not depend on where the cuts fall.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window as W, functions as F


MAX_BUCKETS = 1000


def running_totals_desc(df: DataFrame, order: str, totals: list[str], buckets: int = 0) -> DataFrame:
    """Add ``<name>_through`` = total of ``name`` over rows with order >= this row's.

    ``df`` must hold one row per value of ``order`` (aggregate first).
    """
    spark = df.sparkSession
    # More buckets than this would not change the result, only the size of what is gathered and broadcast.
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    inner = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(order, inner, 0.25 / buckets) if inner else []
    # Bucketizer wants at least one cut; where it falls does not matter.
    splits = [float("-inf"), *sorted(set(cuts or [0.0])), float("inf")]
    cut = Bucketizer(splits=splits, inputCol=order, outputCol="_bucket", handleInvalid="error")
    bucketed = cut.transform(df)

    above = W.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(*[F.sum(name).alias(f"_{name}_bucket") for name in totals])
        .select(
            "_bucket",
            *[
                F.coalesce(F.sum(f"_{name}_bucket").over(above), F.lit(0)).alias(f"_{name}_above")
                for name in totals
            ],
        )
    )
    inside = W.partitionBy("_bucket").orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    # At most MAX_BUCKETS rows: small enough to broadcast whatever the data size.
    joined = bucketed.join(F.broadcast(offsets), "_bucket")
    return joined.select(
        *df.columns,
        *[
            (F.sum(name).over(inside) + F.col(f"_{name}_above")).alias(f"{name}_through")
            for name in totals
        ],
    )
