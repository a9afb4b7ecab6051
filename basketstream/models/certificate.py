"""Certificate that a fitted model is the optimum of its stated objective.

The objective is convex, so the fit is right if and only if its gradient vanishes.
The gradient is one aggregation over the training rows: for a class k and a scaled
feature j it is mean((p_k - y_k) z_j) + reg * w_kj, and mean(p_k - y_k) for the free
intercept. The latter says that the probabilities of a class add up to its rows, which
can be held against the data without knowing the coefficients.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def optimality(model, rows: DataFrame, label: str) -> DataFrame:
    """Per class: class_rows, expected_rows (sum of its probability), gradient (largest absolute entry)."""
    fitted = model.stages[-1]
    classes, weights = fitted.numClasses, fitted.coefficientMatrix.toArray()
    if classes == 2:  # one row of coefficients, which are those of class 1
        weights = [-weights[0], weights[0]]
    penalty = fitted.getOrDefault("regParam")
    scored = model.transform(rows).select(
        F.col(label).cast("int").alias("y"), vector_to_array("_scaled").alias("z"), vector_to_array("_probability").alias("p"))
    features, sums = fitted.numFeatures, {}
    for k in range(classes):
        apart = F.col("p")[k] - F.when(F.col("y") == k, 1.0).otherwise(0.0)
        sums |= {f"rows_{k}": F.count_if(F.col("y") == k), f"expected_{k}": F.sum(F.col("p")[k]), f"free_{k}": F.avg(apart)}
        sums |= {f"slope_{k}_{j}": F.avg(apart * F.col("z")[j]) for j in range(features)}
    total = scored.agg(*[column.alias(name) for name, column in sums.items()])
    found = []
    for k in range(classes):
        # A binomial fit penalises its one row of coefficients, seen from either class.
        slopes = [F.abs(F.col(f"slope_{k}_{j}") + F.lit(penalty * float(weights[k][j]))) for j in range(features)]
        found.append(F.struct(F.lit(k).alias("class"), F.col(f"rows_{k}").alias("class_rows"), F.col(f"expected_{k}").alias("expected_rows"),
                              F.greatest(F.abs(f"free_{k}"), *slopes).alias("gradient")))
    return total.select(F.inline(F.array(*found)))
