"""Exact ranking, timing and classification metrics as Spark aggregates."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketstream import fixed_values as fixed
from basketstream.functions.prefix import running_totals_desc

# Smallest positive double step at 1.0; probabilities are clipped by it.
EPSILON = 2.220446049250313e-16


def top_k(scored: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
    """The ``k`` highest scores; ties go to the smaller keys."""
    return scored.orderBy(F.desc("score"), *fixed.SNAPSHOT_KEYS).limit(k)


def score_groups(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score with totals from the top down."""
    groups = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )
    return running_totals_desc(groups, "score", ["pos", "neg"])


def ranking_metrics(scored: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
    """Rows (metric, value) for ``label`` (0/1) against ``score``.

    Average precision adds up recall steps times precision over distinct scores;
    the area under the ROC curve counts tied pairs half. All but the top-k
    figures need only totals per distinct score.
    """
    pos, neg, score = F.col("pos"), F.col("neg"), F.col("score")
    step = pos * F.col("pos_through") / (F.col("pos_through") + F.col("neg_through"))
    # Negatives of a group lose to all positives above it and tie with those in it.
    wins = neg * (F.col("pos_through") - pos + pos * F.lit(0.5))
    squares = pos * (1 - score) * (1 - score) + neg * score * score
    totals = score_groups(scored).agg(
        F.sum(step).alias("steps"),
        F.sum(wins.cast("double")).alias("wins"),
        F.sum(squares).alias("squares"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    hits = top_k(scored, k).agg(F.sum("label").alias("hits"), F.count("*").alias("kept"))
    # Two one-row relations become one row without a join.
    both = totals.unionByName(hits, allowMissingColumns=True)
    row = both.agg(*[F.max(name).alias(name) for name in both.columns])
    everyone = F.col("positives") + F.col("negatives")
    pairs = F.col("positives").cast("double") * F.col("negatives")
    figures = row.select(
        F.try_divide(F.col("positives"), everyone).alias("random_ranking_ap"),
        F.try_divide("steps", "positives").alias("average_precision"),
        F.try_divide(F.col("wins"), pairs).alias("roc_auc"),
        F.try_divide(F.col("squares"), everyone).alias("brier_score"),
        F.try_divide("hits", "kept").alias("precision_at_k"),
        F.try_divide("hits", "positives").alias("recall_at_k"),
    )
    return figures.unpivot([], figures.columns, "metric", "value")


def _clipped(value):
    return F.least(F.greatest(value, F.lit(EPSILON)), F.lit(1.0 - EPSILON))


def log_loss(probabilities, truth):
    """Mean negative log of the true class's share; shares are brought to sum one."""
    chosen = F.element_at(probabilities, (truth + 1).cast("int"))
    total = F.aggregate(probabilities, F.lit(0.0), lambda acc, p: acc + p)
    return F.avg(-F.log(_clipped(chosen / total)))


def with_prior(scored: DataFrame, prior: DataFrame) -> DataFrame:
    """Attach the three prior shares and the majority bucket to every row.

    The prior is three rows by construction, so it travels as literals.
    """
    rows = sorted(prior.select("bucket", "prior", "is_majority").collect())
    majority = next(row["bucket"] for row in rows if row["is_majority"])
    return scored.withColumns({
        "prior_shares": F.array(*[F.lit(float(row["prior"] or 0.0)) for row in rows]),
        "majority": F.lit(majority),
    })


def confusion(scored: DataFrame) -> DataFrame:
    """Rows per (bucket, prediction): at most nine."""
    return scored.groupBy("bucket", "prediction").agg(F.count("*").alias("n"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per bucket; a zero denominator gives zero."""
    cells = confusion(scored)

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    def ratio(top, bottom):
        return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))

    truth, guess = F.col("bucket"), F.col("prediction")
    figures = cells.agg(*[
        F.struct(
            F.lit(index).alias("bucket"),
            F.lit(name).alias("bucket_name"),
            total((truth == index) & (guess == index)).alias("hits"),
            total(guess == index).alias("guessed"),
            total(truth == index).alias("support"),
        ).alias(f"c{index}")
        for index, name in enumerate(fixed.TIMING_BUCKET_NAMES)
    ]).select(F.inline(F.array("c0", "c1", "c2")))
    precision = ratio(F.col("hits"), F.col("guessed"))
    recall = ratio(F.col("hits"), F.col("support"))
    f1 = ratio(2 * F.col("hits"), F.col("guessed") + F.col("support"))
    return figures.select(
        "bucket", "bucket_name",
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        "support", "guessed",
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Per-class rows plus macro and support-weighted averages."""
    classes = class_report(scored)
    per_class = classes.select(F.col("bucket_name").alias("class_name"), "precision", "recall", "f1", "support")
    measures = ("precision", "recall", "f1")
    macro = classes.agg(
        F.lit("macro avg").alias("class_name"),
        *[F.avg(name).alias(name) for name in measures],
        F.sum("support").alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class_name"),
        *[F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(name) for name in measures],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def timing_metrics(scored: DataFrame, train_scored: DataFrame, prior: DataFrame) -> DataFrame:
    """Rows (metric, value) for ``bucket`` against ``probabilities`` and ``prediction``."""
    evaluation = with_prior(scored, prior)
    training = with_prior(train_scored, prior)
    truth = F.col("bucket")
    fit = training.agg(
        log_loss(F.col("prior_shares"), truth).alias("training_prior_log_loss"),
        log_loss(F.col("probabilities"), truth).alias("training_model_log_loss"),
    )
    held = evaluation.agg(
        F.avg((F.col("majority") == truth).cast("double")).alias("majority_bucket_accuracy"),
        F.avg((F.col("prediction") == truth).cast("double")).alias("model_accuracy"),
        log_loss(F.col("prior_shares"), truth).alias("prior_log_loss"),
        log_loss(F.col("probabilities"), truth).alias("model_log_loss"),
    )
    # Averages over buckets that occur as truth or as prediction.
    seen = class_report(scored).where((F.col("support") > 0) | (F.col("guessed") > 0))
    macro = seen.agg(F.avg("f1").alias("model_macro_f1"))
    parts = [df.unpivot([], df.columns, "metric", "value") for df in (fit, held, macro)]
    return reduce(DataFrame.unionAll, parts)
