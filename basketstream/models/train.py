"""Purchase and timing models on Spark ML.

The penalty is stated as C of the objective  C * sum(loss) + |w|^2 / 2  on inputs
scaled by the population deviation. Spark minimises  mean(loss) + reg * |w|^2 / 2
on inputs scaled by the sample deviation; equal optima need
reg = (n - 1) / (C * n^2).
"""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.models.rows import feature_columns, timing_rows
from basketstream.operators.quality import QualityError


def _pipeline(columns, label, family, c, rows) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="_scaled", labelCol=label, predictionCol="prediction",
            probabilityCol="_probability", rawPredictionCol="_margin", family=family,
            standardization=False, elasticNetParam=0.0, maxIter=fixed.MAX_ITERATIONS,
            regParam=(rows - 1) / (c * rows * rows), tol=1e-10,
        ),
    ])


def _class_counts(rows: DataFrame, label: str) -> dict:
    """Rows per class; the classes are two or three, so this is a handful of rows."""
    return {row[label]: row["count"] for row in rows.groupBy(label).count().collect()}


def fit_purchase(train: DataFrame, evaluation: DataFrame, recency: bool = False):
    """Binary model. Both classes must occur in training and in evaluation."""
    counts = _class_counts(train, "label")
    if set(counts) != {0, 1} or set(_class_counts(evaluation, "label")) != {0, 1}:
        raise QualityError("One of the classes is absent from training or evaluation")
    total = sum(counts.values())
    return _pipeline(feature_columns(recency), "label", "binomial", fixed.PURCHASE_C, total).fit(train)


def fit_timing(train: DataFrame, evaluation: DataFrame, recency: bool = True):
    """Three-bucket model over purchased pairs."""
    rows = timing_rows(train)
    counts = _class_counts(rows, "bucket")
    if set(counts) != {0, 1, 2}:
        raise QualityError("A timing bucket has no training row")
    if timing_rows(evaluation).isEmpty():
        raise QualityError("No purchase falls into the evaluation rows")
    total = sum(counts.values())
    return _pipeline(feature_columns(recency), "bucket", "multinomial", fixed.TIMING_C, total).fit(rows)


def purchase_scores(model, rows: DataFrame) -> DataFrame:
    """Rows with ``score`` = probability of a purchase within the window."""
    scored = model.transform(rows).withColumn("score", vector_to_array("_probability")[1])
    return scored.drop("_raw", "_scaled", "_margin", "_probability", "prediction")


def timing_scores(model, rows: DataFrame) -> DataFrame:
    """Rows with the three ``probabilities`` and the predicted bucket."""
    scored = model.transform(rows).withColumn("probabilities", vector_to_array("_probability"))
    whole = scored.withColumn("prediction", F.col("prediction").cast("int"))
    return whole.drop("_raw", "_scaled", "_margin", "_probability")
