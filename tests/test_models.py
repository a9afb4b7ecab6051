import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketstream import fixed_values as fixed
from basketstream.models import metrics, rows as model_rows, score as scoring, train
from basketstream.operators.quality import QualityError

DAY = date(2022, 9, 2)
KEYS = "feature_as_of_date_source date, client_id bigint, sku bigint"
NAMES = [*fixed.COUNT_FEATURES, *fixed.RECENCY_FEATURES]
FEATURES = KEYS + "".join(f", {name} bigint" for name in fixed.COUNT_FEATURES) + "".join(
    f", {name} double" for name in fixed.RECENCY_FEATURES)
LABELS = KEYS + ", purchase_observed_within_7d boolean, hours_to_first_purchase double"


def features(spark, recencies=((1.5, 2.5), (3.5, 4.5)), keys=((1, 100), (2, 200))):
    data = [(DAY, *key, *[1] * 11, *recency) for key, recency in zip(keys, recencies)]
    return spark.createDataFrame(data, FEATURES)


def labels(spark, *data):
    data = data or ((2, 200, False, None), (1, 100, True, 12.0))
    return spark.createDataFrame([(DAY, *row) for row in data], LABELS)


def test_training_rows_golden(spark):
    made = model_rows.assemble(features(spark), labels(spark), [DAY], recency=True).orderBy("client_id").collect()
    assert [(r["label"], r["hours_to_first_purchase"]) for r in made] == [(1, 12.0), (0, None)]


@pytest.mark.parametrize("guard,change", [
    ("no_feature_rows", lambda f, l: (f.where("false"), l)),
    ("duplicate_feature_keys", lambda f, l: (f.unionAll(f), l)),
    ("duplicate_label_keys", lambda f, l: (f, l.unionAll(l))),
    ("keys_differ", lambda f, l: (f, l.withColumn("sku", F.when(F.col("sku") == 100, 999).otherwise(F.col("sku"))))),
    ("missing_label", lambda f, l: (f, l.withColumn("purchase_observed_within_7d", F.lit(None).cast("boolean")))),
    ("non_finite_feature", lambda f, l: (f.withColumn("hours_since_last_sku_event", F.lit(float("inf"))), l)),
    ("positive_without_hours", lambda f, l: (f, l.withColumn("hours_to_first_purchase", F.lit(None).cast("double")))),
    ("negative_with_hours", lambda f, l: (f, l.withColumn("hours_to_first_purchase", F.lit(3.0)))),
    ("hours_outside_window", lambda f, l: (f, l.withColumn("hours_to_first_purchase", F.col("hours_to_first_purchase") + 156))),
])
def test_guards(spark, guard, change):
    with pytest.raises(QualityError, match=f"^{guard}: "):
        f, l = change(features(spark), labels(spark))
        model_rows.check_guards(model_rows.guard_counts(f, l, [DAY], recency=True))


def test_unexpected_date_guard(spark):
    with pytest.raises(QualityError, match="unexpected_as_of_date: 2"):
        model_rows.check_guards(model_rows.guard_counts(features(spark), labels(spark), [date(2022, 9, 3)]))


def test_split_guard():
    model_rows.check_split(["2022-09-02", "2022-09-05"], "2022-09-12")
    with pytest.raises(ValueError, match="overlap"):
        model_rows.check_split(["2022-09-02", "2022-09-06"], "2022-09-12")
    with pytest.raises(ValueError, match="unique"):
        model_rows.check_split(["2022-09-02", "2022-09-02"], "2022-09-12")


def scored(spark, pairs):
    data = [(DAY, i, i, float(s), y) for i, (s, y) in enumerate(pairs)]
    return spark.createDataFrame(data, KEYS + ", score double, label int")


def as_dict(df):
    return {row["metric"]: row["value"] for row in df.collect()}


def test_metrics_with_ties_golden(spark):
    pairs = [(.9, 1), (.8, 0), (.8, 1), (.3, 0), (.3, 0), (.1, 1)]
    got = as_dict(metrics.ranking_metrics(scored(spark, pairs), k=2))
    assert got["average_precision"] == pytest.approx(0.7222222, abs=1e-6)
    assert got["roc_auc"] == pytest.approx(0.6111111, abs=1e-6)
    assert got["random_ranking_ap"] == pytest.approx(0.5)
    assert got["brier_score"] == pytest.approx(np.mean([(y - s) ** 2 for s, y in pairs]))
    # The tie at 0.8 goes to the smaller key, which is a negative.
    assert got["precision_at_k"] == pytest.approx(0.5) and got["recall_at_k"] == pytest.approx(1 / 3)


def test_metrics_against_brute_force(spark):
    """Many distinct scores, and one score shared by a third of the rows."""
    rng = random.Random(7)
    pairs = [(0.25 if i % 3 == 0 else round(rng.random(), 3), int(rng.random() < 0.2)) for i in range(900)]
    got = as_dict(metrics.ranking_metrics(scored(spark, pairs)))
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for threshold in sorted(set(pos)):
        taken = [y for s, y in pairs if s >= threshold]
        ap += pos.count(threshold) / len(pos) * sum(taken) / len(taken)
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["average_precision"] == pytest.approx(ap, abs=1e-12)
    assert got["recall_at_k"] == 1.0


@pytest.mark.parametrize("hours,bucket", [(0.0, 0), (23.99, 0), (24.0, 1), (71.99, 1), (72.0, 2), (167.0, 2), (None, None)])
def test_timing_bucket(spark, hours, bucket):
    value = F.lit(hours).cast("double")
    assert spark.range(1).select(model_rows.timing_bucket(value).alias("x")).collect()[0]["x"] == bucket


def timed(spark, data):
    return spark.createDataFrame(data, "bucket int, probabilities array<double>, prediction int")


def test_timing_metrics_and_report(spark):
    rows = [(0, [.5, .3, .2], 0), (0, [.2, .5, .3], 1), (1, [.1, .8, .1], 1), (2, [.0, .6, .4], 1)]
    df = timed(spark, rows)
    prior = model_rows.timing_prior(df)
    assert [tuple(r)[2:] for r in prior.orderBy("bucket").collect()] == [(2, .5, True), (1, .25, False), (1, .25, False)]
    got = as_dict(metrics.timing_metrics(df, df, prior))
    assert got["model_log_loss"] == pytest.approx(-np.mean(np.log([.5, .2, .8, .4])))
    assert got["prior_log_loss"] == pytest.approx(-np.mean(np.log([.5, .5, .25, .25])))
    assert got["model_accuracy"] == .5 and got["majority_bucket_accuracy"] == .5
    assert got["model_macro_f1"] == pytest.approx((2 / 3 + .5 + 0) / 3)
    report = {r["class_name"]: tuple(r)[1:] for r in metrics.classification_report(df).collect()}
    assert report["under 24h"] == pytest.approx((1.0, .5, 2 / 3, 2))
    assert report["72-168h"] == (0.0, 0.0, 0.0, 1)
    assert report["macro avg"][0] == pytest.approx((1 + 1 / 3 + 0) / 3)
    assert report["weighted avg"][1] == pytest.approx((.5 * 2 + 1 + 0) / 4)
    # A class that neither occurs nor is predicted does not enter the macro average.
    two = timed(spark, [(0, [1., 0., 0.], 0), (1, [0., 1., 0.], 1)])
    assert as_dict(metrics.timing_metrics(two, df, prior))["model_macro_f1"] == 1.0


def synthetic(n=400):
    rng = np.random.default_rng(3)
    x = rng.poisson(2.0, (n, 11)).astype(float)
    recency = rng.uniform(0, 24, (n, 2))
    logit = 0.6 * x[:, 7] - 0.4 * x[:, 0] + 0.05 * recency[:, 1] - 0.5
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    hours = np.where(y == 1, rng.uniform(0, 167, n), np.nan)
    return np.hstack([x, recency]), y, hours


def model_frame(spark, x, y, hours):
    data = [
        (DAY, i, i, *[int(v) for v in x[i, :11]], *map(float, x[i, 11:]), int(y[i]), None if np.isnan(hours[i]) else float(hours[i]))
        for i in range(len(y))
    ]
    return spark.createDataFrame(data, FEATURES + ", label int, hours_to_first_purchase double")


def newton(x, y, c, classes):
    """Minimise C * sum(loss) + |w|^2 / 2 on inputs scaled by the population deviation."""
    z = (x - x.mean(0)) / x.std(0)
    z = np.hstack([z, np.ones((len(z), 1))])
    d, k = z.shape[1], classes
    w, ridge = np.zeros((k, d)), np.append(np.ones(d - 1), 1e-9)
    target = np.eye(k)[y]
    for _ in range(60):
        e = np.exp(z @ w.T - (z @ w.T).max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        gradient = c * (p - target).T @ z + w * ridge
        hessian = np.zeros((k * d, k * d))
        for a in range(k):
            for b in range(k):
                weight = p[:, a] * ((a == b) - p[:, b])
                hessian[a * d:(a + 1) * d, b * d:(b + 1) * d] = c * (z * weight[:, None]).T @ z
        hessian += np.diag(np.tile(ridge, k))
        w = w - np.linalg.solve(hessian, gradient.ravel()).reshape(k, d)
    return p


def test_models_reach_the_stated_optimum(spark):
    x, y, hours = synthetic()
    frame = model_frame(spark, x, y, hours).cache()
    model = train.fit_purchase(frame, frame)
    got = np.array([r["score"] for r in train.purchase_scores(model, frame).orderBy("client_id").collect()])
    # A two-class softmax splits the weights between its classes and so pays half the penalty.
    want = newton(x[:, :11], y, fixed.PURCHASE_C / 2, 2)[:, 1]
    assert np.abs(got - want).max() < 1e-5

    timing = train.fit_timing(frame, frame)
    positives = model_rows.timing_rows(frame).orderBy("client_id")
    shares = np.array([r["probabilities"] for r in train.timing_scores(timing, positives).orderBy("client_id").collect()])
    buckets = np.digitize(hours[y == 1], fixed.TIMING_EDGES_HOURS)
    assert np.abs(shares - newton(x[y == 1], buckets, fixed.TIMING_C, 3)).max() < 1e-5


def test_fit_guards(spark):
    x, y, hours = synthetic(60)
    frame = model_frame(spark, x, y, hours)
    with pytest.raises(QualityError, match="One of the classes is absent"):
        train.fit_purchase(frame.where("label = 1"), frame)
    with pytest.raises(QualityError, match="timing bucket has no training row"):
        train.fit_timing(frame.where("label = 0 or hours_to_first_purchase < 24"), frame)
    with pytest.raises(QualityError, match="No purchase falls into"):
        train.fit_timing(frame, frame.where("label = 0"))


def test_store_load_and_score(spark, tmp_path):
    x, y, hours = synthetic(120)
    frame = model_frame(spark, x, y, hours)
    purchase, timing = train.fit_purchase(frame, frame), train.fit_timing(frame, frame)
    root = str(tmp_path)
    paths = [
        scoring.save_run(spark, root, "r1", "purchase", purchase, {"C": 1.0}, {"ap": 0.5}),
        scoring.save_run(spark, root, "r2", "timing", timing, {"C": 0.01}, {"ll": 1.0}, role="holdout"),
    ]
    with pytest.raises(ValueError):
        scoring.save_run(spark, root, "r3", "purchase", purchase, {}, {}, role="production")
    runs = {r["run_id"]: (r["evaluation_role"], r["params"]["C"]) for r in scoring.model_runs(spark, root).collect()}
    assert runs == {"r1": ("validation", "1.0"), "r2": ("holdout", "0.01")}
    with pytest.raises(QualityError, match="fitted on other features"):
        scoring.load_models(paths[1], paths[1])
    models = scoring.load_models(*paths)
    inputs = frame.select("client_id", *NAMES)
    out = scoring.score(inputs, *models).orderBy("client_id")
    assert out.columns == ["client_id", "purchase_within_7d_probability", "under_24h", "hours_24_to_72", "hours_72_to_168"]
    rows = out.collect()
    assert all(abs(r[2] + r[3] + r[4] - 1) < 1e-9 for r in rows)
    same = train.purchase_scores(purchase, frame).orderBy("client_id").collect()
    assert [r[1] for r in rows] == pytest.approx([r["score"] for r in same])
    with pytest.raises(Exception, match="search_previous_day_negative"):
        scoring.score(inputs.withColumn("search_previous_day", F.lit(-1)), *models).collect()
    with pytest.raises(ValueError, match="neither features nor keys: client_age"):
        scoring.score(inputs.withColumn("client_age", F.lit(30)), *models)
    with pytest.raises(QualityError, match="Unexpected model classes"):
        scoring.score(inputs, purchase, purchase)


def test_certificate_tells_the_optimum_from_a_point_beside_it(spark):
    """Gradient of the stated objective by NumPy, at the optimum and after too few steps."""
    from basketstream.models.certificate import optimality

    draw = np.random.default_rng(3)
    x = draw.poisson(2.0, (400, len(fixed.COUNT_FEATURES)))
    y = (x[:, 0] + draw.normal(0, 1, 400) > 2.5).astype(int)
    names = fixed.COUNT_FEATURES
    rows = spark.createDataFrame([(*map(int, a), int(b)) for a, b in zip(x, y)], ", ".join(f"{n} bigint" for n in names) + ", label int")
    best = train.fit_purchase(rows, rows)
    found = {r["class"]: r for r in optimality(best, rows, "label").collect()}
    assert all(r["gradient"] < 1e-7 for r in found.values())
    assert found[1]["class_rows"] == y.sum() and abs(found[1]["expected_rows"] - y.sum()) < 1e-4
    pipeline = train._pipeline(names, "label", "binomial", fixed.PURCHASE_C, 400)
    pipeline.getStages()[-1].setMaxIter(2)
    early = pipeline.fit(rows)
    (one,) = optimality(early, rows, "label").where("class = 1").collect()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    w, free = early.stages[-1].coefficients.toArray(), early.stages[-1].intercept
    apart = 1 / (1 + np.exp(-(z @ w + free))) - y
    slope = z.T @ apart / 400 + early.stages[-1].getRegParam() * w
    assert abs(one["gradient"] - max(np.abs(slope).max(), abs(apart.mean()))) < 1e-9 and one["gradient"] > 1e-4
