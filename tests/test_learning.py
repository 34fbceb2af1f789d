"""Models on small frames: penalty scale, ranks against Spark's evaluator, calibration, splits."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tickloom.operators import layout, learning, newton
from tickloom.plans import catalog


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = []
    for i in range(400):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        data.append((i, "S", i * 1_000, a, b, int(rnd.random() < 1 / (1 + math.exp(-2 * a)))))
    return spark.createDataFrame(data, "id long, symbol string, event_time_ms long, a double, b double, label int").cache()


def test_auc_equals_the_evaluator(rows):
    model = learning.fit_logistic(rows, ["a", "b"], balanced=False)
    scored = learning.predict(model, rows, ["a", "b"])
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(scored)
    assert abs(learning.auc_brier(scored).first()["auc"] - want) < 1e-4


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "score double, label int")
    assert learning.auc_brier(df).first()["auc"] == 0.875


def test_auc_of_close_scores(spark):
    df = spark.createDataFrame([(0.5000002, 1), (0.5000001, 0)], "score double, label int")
    assert learning.auc_brier(df).first()["auc"] == 1.0


def test_walk_forward_counts_ties(spark):
    df = spark.createDataFrame([(i, "S", 5 if 2 <= i < 9 else i) for i in range(12)], "id long, symbol string, event_time_ms long")
    order = sorted(df.collect(), key=lambda r: (r["event_time_ms"], r["id"], r["symbol"]))
    for fraction in (0.1, 0.5, 0.7, 0.99):
        got = {r["id"]: r["part"] for r in learning.walk_forward_split(df, fraction).collect()}
        assert [got[r["id"]] for r in order] == ["train" if k < int(12 * fraction) else "test" for k in range(12)]


def test_penalty_is_on_summed_losses(rows):
    """The gradient of c * sum(loss) + |w|^2 / 2 vanishes at the fitted weights."""
    c = 0.5
    model = learning.fit_logistic(rows, ["a", "b"], c=c, balanced=False)
    w, k = model.coefficients.toArray(), model.intercept
    grad = [w[0], w[1]]
    for r in rows.collect():
        miss = 1 / (1 + math.exp(-(w[0] * r["a"] + w[1] * r["b"] + k))) - r["label"]
        grad[0] += c * miss * r["a"]
        grad[1] += c * miss * r["b"]
    assert all(abs(g) < 1e-2 for g in grad)


def test_strong_l1_drops_the_useless_input(rows):
    model = learning.fit_logistic(rows, ["a", "b"], c=0.05, penalty="l1", balanced=False)
    assert model.coefficients[0] > 0 and model.coefficients[1] == 0
    assert learning.coefficients(model, ["a", "b"])[0][0] == "a"


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 8, "label int")
    assert {r["label"]: r["weight"] for r in learning.class_weights(df).collect()} == {1: 2.5, 0: 0.625}


def test_isotonic_scores_are_probabilities(rows):
    out = learning.isotonic_scores(rows, rows, ["a", "b"]).collect()
    assert len(out) == 400 and all(0 <= r["calibrated"] <= 1 for r in out)


def test_splits(rows):
    plain = {r["id"]: r["part"] for r in learning.walk_forward_split(rows).collect()}
    assert sum(p == "train" for p in plain.values()) == 280 and plain[279] == "train" and plain[280] == "test"
    purged = {r["id"]: r["part"] for r in learning.purged_split(rows).collect()}
    assert purged[220] == "train" and 221 not in purged and 339 not in purged and purged[340] == "test"


def test_constant_input_is_not_scaled_away(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = sorted(map(tuple, learning.standardize(df, ["a", "b"], df).collect()))
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


# ---- many models at once --------------------------------------------------------------


def minimum(x, y, c, penalty, penalise_intercept):
    """Weights and intercept of the least c * summed losses + penalty, by many small proximal steps in numpy."""
    x = np.column_stack([x, np.ones(len(x))])
    w, push = np.zeros(x.shape[1]), np.ones(x.shape[1])
    push[-1] = penalise_intercept
    rate = 1.0 / (c * 0.25 * np.linalg.norm(x, 2) ** 2 + 1)
    v, k = w.copy(), 1.0
    for _ in range(20_000):
        z = v - rate * (c * x.T @ (1 / (1 + np.exp(-x @ v)) - y) + (push * v if penalty == "l2" else 0))
        new = z if penalty == "l2" else np.sign(z) * np.maximum(np.abs(z) - rate * push, 0)
        k, old = (1 + math.sqrt(1 + 4 * k * k)) / 2, k
        w, v = new, new + (old - 1) / k * (new - w)
    return w


@pytest.mark.parametrize("penalty", ["l1", "l2"])
@pytest.mark.parametrize("penalise_intercept", [True, False])
def test_models_fitted_together(rows, penalty, penalise_intercept):
    wide = rows.withColumn("d", F.col("a") * 0.5 + F.sin("b") + 1)
    subsets = [["a", "b", "d"], ["b", "d"], ["a"], []]
    fits = newton.fit_subsets(wide, ["a", "b", "d"], subsets, 0.1, penalty, penalise_intercept=penalise_intercept)
    data = wide.collect()
    y = np.array([r["label"] for r in data], float)
    for fit, used in zip(fits, subsets):
        want = minimum(np.array([[r[f] for f in used] for r in data]).reshape(len(data), len(used)), y, 0.1, penalty, penalise_intercept)
        assert fit.gap < 1e-9 and [fit.named()[f] for f in used] + [fit.intercept] == pytest.approx(want.tolist(), abs=1e-6)
        assert set(fit.named()) == set(used) and all(w == 0 for f, w in zip(fit.features, fit.weights) if f not in used)


def test_models_equal_the_solver_of_spark(rows):
    model = learning.fit_logistic(rows, ["a", "b"], c=0.5, balanced=False)
    [fit] = newton.fit_subsets(rows, ["a", "b"], [["a", "b"]], 0.5, "l2")
    assert [*fit.weights, fit.intercept] == pytest.approx([*model.coefficients, model.intercept], abs=1e-4)


def test_models_of_no_rows_and_of_parted_labels(rows):
    [fit] = newton.fit_subsets(rows.limit(0), ["a", "b"], [["a", "b"]])
    assert not fit.weights.any() and fit.intercept == 0
    parted = rows.withColumn("label", (F.col("a") > 0).cast("int"))
    [fit] = newton.fit_subsets(parted, ["a", "b"], [["a", "b"]], 100.0, "l1", penalise_intercept=True)
    assert fit.gap < 1e-6 and fit.named()["a"] > 5


def test_ablation_report(rows):
    split = rows.withColumn("part", F.when(F.col("id") < 300, "train").otherwise("test")).withColumn("b2", F.col("b") * F.col("b"))
    got = {r["model"]: r for r in learning.feature_ablation(split, ["a", "b", "b2"]).collect()}
    assert set(got) == {"FULL", "a", "b", "b2"} and all(r["gap"] < 1e-9 and r["n"] == 100 for r in got.values())
    assert got["FULL"]["delta_auc"] is None and got["a"]["delta_auc"] < -0.05 and got["a"]["leakage"] and not got["b"]["leakage"]
    train, test = (split.filter(F.col("part") == p) for p in ("train", "test"))
    data = train.collect()
    w = minimum(np.array([[r[f] for f in ("b", "b2")] for r in data]), np.array([r["label"] for r in data], float), 0.1, "l1", True)
    scores = [(1 / (1 + math.exp(-(w[0] * r["b"] + w[1] * r["b2"] + w[2]))), r["label"]) for r in test.collect()]
    wins = sum((p > q) + 0.5 * (abs(p - q) < 1e-12) for p, x in scores if x for q, z in scores if not z)
    assert got["a"]["auc"] == pytest.approx(wins / sum(x for _, x in scores) / sum(1 - x for _, x in scores), abs=1e-6)
    assert got["a"]["brier"] == pytest.approx(sum((p - x) ** 2 for p, x in scores) / 100, abs=1e-6)


# ---- calibration of test rows ---------------------------------------------------------


def pooled(points):
    """Pool adjacent violators over (score, label), and the curve through the blocks' ends."""
    blocks = []
    for s in sorted({p[0] for p in points}):
        own = [y for x, y in points if x == s]
        blocks.append([s, s, sum(own), len(own)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            lo, hi = blocks[-2:]
            blocks[-2:] = [[lo[0], hi[1], lo[2] + hi[2], lo[3] + hi[3]]]
    x = [e for b in blocks for e in ({b[0], b[1]} if b[0] == b[1] else (b[0], b[1]))]
    y = [b[2] / b[3] for b in blocks for _ in ({b[0], b[1]} if b[0] == b[1] else (b[0], b[1]))]
    return lambda s: float(np.interp(s, x, y))


def test_calibrated_test_rows(rows):
    train, test = rows.filter("id < 300"), rows.filter("id >= 300")
    got = {r["id"]: r["calibrated"] for r in learning.isotonic_scores(train, test, ["a", "b"]).collect()}
    fold = {r["id"]: r["fold"] for r in learning.stratified_folds(train).collect()}
    data, curves = {r["id"]: r for r in rows.collect()}, []
    for k in range(5):
        model = learning.fit_logistic(train.join(learning.stratified_folds(train).filter(F.col("fold") != k).select("id"), "id"), ["a", "b"])
        p = lambda r, m=model: 1 / (1 + math.exp(-(m.coefficients[0] * r["a"] + m.coefficients[1] * r["b"] + m.intercept)))
        curves.append((p, pooled([(p(data[i]), data[i]["label"]) for i in fold if fold[i] == k])))
    want = {i: sum(curve(p(data[i])) for p, curve in curves) / 5 for i in got}
    assert got == pytest.approx(want, abs=1e-6)


# ---- ranges that follow the data ------------------------------------------------------


def test_close_scores_are_many_tasks(spark):
    n = 200_000
    scored = spark.range(n).select((F.lit(0.5) + F.col("id") * 1e-13).alias("score"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("label"))
    sizes = [r["count"] for r in layout.in_ranges(scored, ["score"], "close", 16).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * n / 16
    y = np.array([r["label"] for r in scored.orderBy("score").collect()])
    wins = (y * (np.cumsum(1 - y) - (1 - y))).sum()
    got = learning.auc_brier(scored).first()
    assert (got["n"], got["positives"]) == (n, int(y.sum())) and got["auc"] == pytest.approx(wins / y.sum() / (1 - y).sum(), abs=1e-6)


def test_one_time_is_split_over_many_tasks(spark):
    rows = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(10_007)).alias("id"), F.lit("S").alias("symbol"), F.lit(5).cast("long").alias("event_time_ms")).distinct()
    got = learning.walk_forward_split(rows)
    ids = sorted(r["id"] for r in rows.collect())
    assert {r["id"] for r in got.filter("part = 'train'").collect()} == set(ids[: int(len(ids) * 0.7)])


def test_model_queries_return_whole_results(spark, sf_dir):
    store = catalog.stored_features(spark, sf_dir)
    tests = {(r["symbol"], r["id"]) for r in learning.purged_split(learning.dataset(store, catalog.FLOW)).filter("part = 'test'").collect()}
    q = {n: catalog.QUERIES[n](spark, sf_dir) for n in ("logreg_fit", "isotonic_calibrated", "logreg_report", "coefficient_ranking", "isotonic_report", "feature_ablation")}
    scored = q["logreg_fit"].collect()
    if not scored:
        pytest.skip("no rows of both labels at this scale")
    assert {(r["symbol"], r["id"]) for r in scored} == tests == {(r["symbol"], r["id"]) for r in q["isotonic_calibrated"].collect()}
    assert all(0 <= r["calibrated"] <= 1 for r in q["isotonic_calibrated"].collect())
    report, ranking = q["logreg_report"].first(), q["coefficient_ranking"].orderBy("rank").collect()
    assert (report["n"], report["positives"]) == (len(scored), sum(r["label"] for r in scored)) and report["gap"] < 1e-3
    assert len(ranking) == len(catalog.FLOW) and [r["size"] for r in ranking] == sorted((r["size"] for r in ranking), reverse=True)
    assert {r["stage"] for r in q["isotonic_report"].collect()} == {"raw", "calibrated"}
    assert q["feature_ablation"].count() == 1 + len(catalog.config.BASE_FEATURES)
