"""Batch scoring and the record of trained models."""

import os

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.operators.contract import feature_row_errors, unexpected_columns
from basketstream.operators.quality import QualityError

ROLES = ("validation", "holdout")
RUN_COLUMNS = (
    "run_id string, model string, evaluation_role string, params map<string,string>, "
    "metrics map<string,double>, model_path string, recorded_at_utc timestamp"
)


def check_classes(purchase_model, timing_model) -> None:
    if purchase_model.stages[-1].numClasses != 2 or timing_model.stages[-1].numClasses != 3:
        raise QualityError("Unexpected model classes")


def check_features(model, expected: list[str], kind: str) -> None:
    if model.stages[0].getInputCols() != expected:
        raise QualityError(f"The {kind.lower()} model was fitted on other features")


def score(rows: DataFrame, purchase_model, timing_model, keys=tuple(fixed.SNAPSHOT_KEYS)) -> DataFrame:
    """Purchase probability and three timing shares per row.

    ``rows`` holds the features and, if wanted, some of the named ``keys``; any
    other column is an error.

    The shares are conditional on a purchase happening; they are not multiplied
    with its probability. Rows that break an input rule fail the job.
    """
    check_classes(purchase_model, timing_model)
    extra = unexpected_columns(rows, fixed.COUNT_FEATURES, fixed.RECENCY_FEATURES, keys)
    if extra:
        raise ValueError(f"The scoring input has columns that are neither features nor keys: {', '.join(extra)}")
    broken = feature_row_errors(rows, fixed.COUNT_FEATURES, fixed.RECENCY_FEATURES)
    names = [*fixed.COUNT_FEATURES, *fixed.RECENCY_FEATURES]
    problem = F.concat(F.lit("Invalid feature row: "), F.array_join(broken, ","))
    first = F.when(F.size(broken) > 0, F.raise_error(problem)).otherwise(F.col(names[0]))
    checked = rows.withColumn(names[0], first)
    keys = [name for name in rows.columns if name not in names]
    working = ["_raw", "_scaled", "_margin", "prediction"]
    bought = purchase_model.transform(checked).withColumn("_purchase", vector_to_array("_probability")[1])
    timed = timing_model.transform(bought.drop(*working, "_probability"))
    shares = vector_to_array("_probability")
    return timed.select(
        *keys,
        F.col("_purchase").alias("purchase_within_7d_probability"),
        shares[0].alias("under_24h"),
        shares[1].alias("hours_24_to_72"),
        shares[2].alias("hours_72_to_168"),
    )


def save_run(spark, root, run_id, kind, model, params: dict, metrics: dict, role="validation") -> str:
    """Store a model and append its record to the run table. Returns the model path."""
    if role not in ROLES:
        raise ValueError(f"Unknown evaluation role: {role}")
    path = os.path.join(root, "models", kind, run_id)
    model.write().save(path)
    row = (run_id, kind, role, {k: str(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items()}, path, None)
    record = spark.createDataFrame([row], RUN_COLUMNS).withColumn("recorded_at_utc", F.current_timestamp())
    record.write.mode("append").parquet(os.path.join(root, "model_runs"))
    return path


def model_runs(spark, root) -> DataFrame:
    return spark.read.schema(RUN_COLUMNS).parquet(os.path.join(root, "model_runs"))


def load_models(purchase_path: str, timing_path: str):
    """Both models, checked for the features and classes scoring relies on."""
    purchase, timing = PipelineModel.load(purchase_path), PipelineModel.load(timing_path)
    check_features(purchase, fixed.COUNT_FEATURES, "Purchase")
    check_features(timing, [*fixed.COUNT_FEATURES, *fixed.RECENCY_FEATURES], "Timing")
    check_classes(purchase, timing)
    return purchase, timing
