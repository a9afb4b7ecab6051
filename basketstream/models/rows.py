"""Training rows: feature-label assembly with guards, temporal split, timing buckets."""

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.functions.times import as_date
from basketstream.operators.quality import QualityError

KEYS = fixed.SNAPSHOT_KEYS
LABEL = "purchase_observed_within_7d"
HOURS = "hours_to_first_purchase"


def feature_columns(recency: bool) -> list[str]:
    return fixed.COUNT_FEATURES + (fixed.RECENCY_FEATURES if recency else [])


def not_finite(name: str) -> Column:
    value = F.col(name).cast("double")
    return value.isNull() | F.isnan(value) | value.isin(float("inf"), float("-inf"))


def any_of(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def _finite_hours() -> Column:
    return ~not_finite(HOURS)


def key_comparison(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Full join of both key sets, each reduced to one row per key beforehand."""
    left = features.groupBy(*KEYS).agg(F.count("*").alias("feature_rows"))
    right = labels.groupBy(*KEYS).agg(F.count("*").alias("label_rows"))
    return left.join(right, KEYS, "full")


def key_diff(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys that only one side has, and which side that is."""
    sides = key_comparison(features, labels)
    only = F.when(F.col("label_rows").isNull(), "features").when(F.col("feature_rows").isNull(), "labels")
    return sides.withColumn("only_in", only).where(F.col("only_in").isNotNull()).select(*KEYS, "only_in")


def guard_counts(features: DataFrame, labels: DataFrame, as_of_dates, recency: bool = False) -> DataFrame:
    """Violations per guard in the order the guards apply, as (position, guard, violations)."""
    dates = [F.lit(str(day)).cast("date") for day in as_of_dates]
    positive, negative = F.col(LABEL) == F.lit(True), F.col(LABEL) == F.lit(False)
    hours = F.col(HOURS)
    from_keys = key_comparison(features, labels).agg(
        (F.count("feature_rows") == 0).cast("bigint").alias("no_feature_rows"),
        F.count_if(F.col("feature_rows") > 1).alias("duplicate_feature_keys"),
        F.count_if(F.col("label_rows") > 1).alias("duplicate_label_keys"),
        F.count_if(F.col("feature_rows").isNull() | F.col("label_rows").isNull()).alias("keys_differ"),
    )
    from_features = features.agg(
        F.count_if(~F.coalesce(F.col(KEYS[0]).isin(dates), F.lit(False))).alias("unexpected_as_of_date"),
        F.count_if(any_of(not_finite(name) for name in feature_columns(recency))).alias("non_finite_feature"),
    )
    from_labels = labels.agg(
        F.count_if(F.col(LABEL).isNull()).alias("missing_label"),
        F.count_if(positive & ~_finite_hours()).alias("positive_without_hours"),
        F.count_if(negative & hours.isNotNull() & ~F.isnan(hours)).alias("negative_with_hours"),
        F.count_if(positive & _finite_hours() & ((hours < 0) | (hours >= 24 * fixed.LABEL_DAYS))).alias("hours_outside_window"),
    )
    order = {name: position for position, name in enumerate([
        "no_feature_rows", "duplicate_feature_keys", "duplicate_label_keys", "keys_differ",
        "unexpected_as_of_date", "missing_label", "non_finite_feature",
        "positive_without_hours", "negative_with_hours", "hours_outside_window",
    ])}
    result = None
    for part in (from_keys, from_features, from_labels):
        rows = part.unpivot([], part.columns, "guard", "violations")
        result = rows if result is None else result.unionAll(rows)
    position = F.create_map(*[F.lit(item) for pair in order.items() for item in pair])[F.col("guard")]
    return result.select(position.alias("position"), "guard", "violations")


def check_guards(counts: DataFrame) -> None:
    """Raise on the first guard with violations (ten rows reach the driver)."""
    for row in sorted(counts.collect()):
        if row["violations"]:
            raise QualityError(f"{row['guard']}: {row['violations']}")


def training_rows(features: DataFrame, labels: DataFrame, recency: bool = False) -> DataFrame:
    """Features with label (0/1) and hours; the guards must have passed."""
    outcome = labels.select(*KEYS, F.col(LABEL).cast("int").alias("label"), F.col(HOURS))
    rows = features.select(*KEYS, *feature_columns(recency))
    return rows.join(outcome, KEYS)


def assemble(features: DataFrame, labels: DataFrame, as_of_dates, recency: bool = False) -> DataFrame:
    """Guarded training rows of some as-of dates (date filters prune partitions)."""
    dates = [F.lit(str(day)).cast("date") for day in as_of_dates]
    chosen = F.col(KEYS[0]).isin(dates)
    features, labels = features.where(chosen), labels.where(chosen)
    check_guards(guard_counts(features, labels, as_of_dates, recency))
    return training_rows(features, labels, recency)


def check_split(train_dates, evaluation_date) -> None:
    """Training dates are unique and their outcome windows end before evaluation starts."""
    days = [as_date(day) for day in train_dates]
    if len(set(days)) != len(days):
        raise ValueError("Training dates must be unique")
    if max(days) + timedelta(days=fixed.LABEL_DAYS) > as_date(evaluation_date):
        raise ValueError("Training and evaluation outcome windows overlap")


def timing_bucket(hours: Column) -> Column:
    """0 below the first edge, 1 from it up to the second, 2 from there on."""
    first, second = fixed.TIMING_EDGES_HOURS
    return F.when(hours < first, 0).when(hours < second, 1).when(hours >= second, 2)


def timing_rows(rows: DataFrame) -> DataFrame:
    """Purchased pairs only, with their timing bucket."""
    return rows.where("label = 1").withColumn("bucket", timing_bucket(F.col(HOURS)))


def timing_prior(train: DataFrame) -> DataFrame:
    """Share of every bucket in training rows; absent buckets have share zero."""
    counts = train.agg(
        *[F.count_if(F.col("bucket") == index).alias(str(index)) for index in range(3)]
    )
    shaped = counts.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(index).alias("bucket"),
                F.lit(name).alias("bucket_name"),
                F.col(str(index)).alias("bucket_rows"),
                (F.col("0") + F.col("1") + F.col("2")).alias("_all"),
                # Lowest index among the largest buckets.
                F.when(F.col("0") == F.greatest("0", "1", "2"), 0)
                .when(F.col("1") == F.greatest("1", "2"), 1).otherwise(2).alias("_majority"),
            )
            for index, name in enumerate(fixed.TIMING_BUCKET_NAMES)
        ]))
    )
    return shaped.select(
        "bucket",
        "bucket_name",
        "bucket_rows",
        F.try_divide("bucket_rows", "_all").alias("prior"),
        (F.col("bucket") == F.col("_majority")).alias("is_majority"),
    )
