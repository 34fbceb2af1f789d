"""Leakage-safe datasets, splits, scaling, logistic models, calibration and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import config
from tickloom.functions.ranks import exact_ranks
from tickloom.functions.scalars import rnd
from tickloom.operators import newton
from tickloom.operators.features import TICK_COLUMNS, orderflow_features, tick_columns
from tickloom.operators.labels import MIN_PATH, path_label_of, path_returns
from tickloom.operators.layout import in_ranges, newest_per_symbol, slot_start, with_rank
from tickloom.operators.sampled import sampled_rows

CONTINUATIONS = ("CONTINUATION_UP", "CONTINUATION_DOWN")
EMBARGO_MS = 60_000
FOLDS = 5


def feature_store(ticks: DataFrame, cost: float = 0.01) -> DataFrame:
    """One row per sampled tick: tick features, order flow, and the path label.

    Tick features and labels come from one pass over the chunks. Order flow holds one row per sampled tick (a tenth of the
    ticks) too and joins on (symbol, id), which spreads a hot symbol over all tasks.
    """
    flow = orderflow_features(ticks).drop("event_time_ms")
    label = F.when(F.col("path_ticks") >= MIN_PATH, path_label_of(*path_returns(), cost)).alias("micro_label")
    rows = tick_columns(sampled_rows(ticks, keep=TICK_COLUMNS), [label])
    return rows.join(flow, ["symbol", "id"], "left").select(*[c for c in rows.columns if c != "micro_label"],
                                                            *[c for c in flow.columns if c not in ("symbol", "id")], "micro_label")


def dataset(
    store: DataFrame,
    features: Sequence[str] = tuple(config.FLOW_FEATURES),
    positive: Sequence[str] = CONTINUATIONS,
    labels: Sequence[str] | None = (*CONTINUATIONS, "ABSORPTION"),
    min_abs_z: float | None = 0.5,
    symbol: str | None = None,
) -> DataFrame:
    """Model rows: id, symbol, time, inputs, and label 1 for the `positive` path labels.

    Rows with a null input are left out. Columns that look into the future are refused.
    """
    leaky = set(features) & config.LEAKY_COLUMNS
    if leaky:
        raise ValueError(f"inputs computed from the future: {sorted(leaky)}")
    rows = store.filter(F.col("micro_label").isin(*labels) if labels else F.col("micro_label").isNotNull())
    if min_abs_z is not None:
        rows = rows.filter(F.abs("zscore") >= min_abs_z)
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    return rows.select(
        "id", "symbol", "event_time_ms",
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col("micro_label").isin(*positive).cast("int").alias("label"),
    ).dropna()


def outcome_dataset(store: DataFrame, horizon_labels: DataFrame, features: Sequence[str] = tuple(config.BASE_FEATURES)) -> DataFrame:
    """Model rows whose label is the 10-second reversal outcome."""
    return store.join(horizon_labels, ["symbol", "id"]).select(
        "id", "symbol", "event_time_ms",
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col("outcome_10s").cast("int").alias("label"),
    ).dropna()


def _split_index(fraction: float):
    return lambda n: F.least(F.floor(n * F.lit(fraction)).cast("bigint"), n - 1)


def split_time(rows: DataFrame, fraction: float = 0.7) -> Column:
    """Time of the row at position floor(fraction * n) in time order, as a scalar subquery."""
    at = exact_ranks(
        rows, [], "event_time_ms", {"t": _split_index(fraction)}, bucket=lambda t: slot_start(t, 60_000)
    )
    return at.select("t").scalar()


def purged_split(rows: DataFrame, fraction: float = 0.7, embargo_ms: int = EMBARGO_MS) -> DataFrame:
    """Adds `part`: train up to the split time minus the embargo, test from it plus the embargo."""
    at = split_time(rows, fraction)
    part = F.when(F.col("event_time_ms") <= at - embargo_ms, F.lit("train")).when(
        F.col("event_time_ms") >= at + embargo_ms, F.lit("test")
    )
    return rows.withColumn("part", part).filter(F.col("part").isNotNull())


def walk_forward_split(rows: DataFrame, fraction: float = 0.7) -> DataFrame:
    """Adds `part`: the first floor(fraction * n) rows in (time, id, symbol) order are train, the rest test.

    Rows are dealt to ranges of that order. Only the range that the split falls into is numbered row by row, and ranges are even
    whatever the times are, also if all rows have one time.
    """
    order = ["event_time_ms", "id", "symbol"]
    ranged = in_ranges(rows, order, "walk-forward")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range
    cut = F.floor(F.sum("_size").over(Window.partitionBy(F.lit(0))) * F.lit(fraction)).cast("bigint")
    left = sizes.select("_part", (cut - F.coalesce(before, F.lit(0))).alias("_left"), "_size")
    split = left.filter((F.col("_left") > 0) & (F.col("_left") < F.col("_size")))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    whole = ranged.join(left.filter((F.col("_left") <= 0) | (F.col("_left") >= F.col("_size"))), "_part").withColumn(
        "part", F.when(F.col("_left") > 0, F.lit("train")).otherwise(F.lit("test")))
    inside = ranged.join(split, "_part").withColumn("part", F.when(place <= F.col("_left"), F.lit("train")).otherwise(F.lit("test")))
    return whole.unionByName(inside).select(*rows.columns, "part")


def standardize(rows: DataFrame, features: Sequence[str], fit_on: DataFrame) -> DataFrame:
    """Scale inputs by the mean and population deviation of `fit_on` (deviation 0 counts as 1)."""
    stats = fit_on.agg(
        F.struct(*[
            F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")).alias(f) for f in features
        ]).alias("stats")
    ).scalar()

    def scaled(f: str) -> Column:
        s = stats[f]
        return (F.col(f) - s["mean"]) / F.when(s["std"] > 0, s["std"]).otherwise(F.lit(1.0))

    return rows.withColumns({f: scaled(f) for f in features})


def class_weights(train: DataFrame) -> DataFrame:
    """Balanced weights n / (classes * rows of the class)."""
    counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    return counts.withColumn(
        "weight", F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))
    )


def with_weight(train: DataFrame) -> DataFrame:
    """Adds the balanced `weight` of each row (two classes, read as a scalar)."""
    table = class_weights(train).agg(F.map_from_entries(F.collect_list(F.struct("label", "weight"))).alias("m"))
    return train.withColumn("weight", F.element_at(table.scalar(), F.col("label")))


def as_vectors(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="inputs").transform(rows)


def fit_logistic(
    train: DataFrame, features: Sequence[str], c: float = 0.1, penalty: str = "l2", balanced: bool = True
) -> LogisticRegressionModel:
    """Logistic regression on scaled inputs.

    `c` is the inverse penalty strength on summed losses; Spark averages losses by
    their weights, hence regParam = 1 / (c * total weight).
    """
    rows = as_vectors(with_weight(train) if balanced else train.withColumn("weight", F.lit(1.0)), features)
    total = rows.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        featuresCol="inputs", labelCol="label", weightCol="weight", standardization=False, maxIter=200,
        regParam=1.0 / (c * total), elasticNetParam=1.0 if penalty == "l1" else 0.0,
    ).fit(rows)


def optimality_gap(
    model: LogisticRegressionModel, train: DataFrame, features: Sequence[str], c: float = 0.1, penalty: str = "l2", balanced: bool = True
) -> float:
    """How far the weights are from the optimum of c * summed losses + penalty: the largest violated slope.

    0 at the optimum; each slope is measured against c * the weighted size of its input.
    """
    rows = predict(model, with_weight(train) if balanced else train.withColumn("weight", F.lit(1.0)), features, "_p")
    off = F.col("weight") * (F.col("_p") - F.col("label"))
    inputs = [F.lit(1.0), *[F.col(f) for f in features]]
    found = rows.agg(
        F.array(*[F.sum(off * x) for x in inputs]).alias("slopes"),
        F.array(*[F.sum(F.col("weight") * F.abs(x)) for x in inputs]).alias("sizes"),
    ).first()
    gaps = [abs(c * found["slopes"][0]) / max(1.0, c * found["sizes"][0])]
    for w, slope, size in zip(model.coefficients.toArray().tolist(), found["slopes"][1:], found["sizes"][1:]):
        if penalty == "l2":
            gap = abs(c * slope + w)
        else:
            gap = abs(c * slope + (1.0 if w > 0 else -1.0)) if w else max(0.0, abs(c * slope) - 1.0)
        gaps.append(gap / max(1.0, c * size))
    return max(gaps)


def save_model(model: LogisticRegressionModel, features: Sequence[str], path: str) -> None:
    """The model with its input columns, as a Spark pipeline."""
    PipelineModel([VectorAssembler(inputCols=list(features), outputCol="inputs"), model]).write().overwrite().save(path)


def load_model(path: str) -> tuple[LogisticRegressionModel, list[str]]:
    """A saved model and its inputs."""
    assembler, model = PipelineModel.load(path).stages
    return model, assembler.getInputCols()


def predict(model: LogisticRegressionModel, rows: DataFrame, features: Sequence[str], name: str = "score") -> DataFrame:
    scored = model.transform(as_vectors(rows, features))
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "inputs", "rawPrediction", "probability", "prediction"
    )


def coefficients(model: LogisticRegressionModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Inputs by size of their coefficient."""
    pairs = zip(features, model.coefficients.toArray().tolist())
    return sorted(pairs, key=lambda p: -abs(p[1]))


def stratified_folds(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Adds `fold`: the rows of each label, in (time, id, symbol) order, in `folds` stretches of equal length.

    Rows are numbered in two phases, so no label is one task.
    """
    ranked = with_rank(train.withColumnsRenamed({"symbol": "_symbol"}).withColumn("symbol", F.col("label").cast("string")),
                       ("event_time_ms", "id", "_symbol"))
    fold = F.floor((F.col("_rn") - 1) * folds / F.col("_n")).cast("int")
    return ranked.withColumn("fold", fold).drop("symbol", "_rn", "_n").withColumnRenamed("_symbol", "symbol")


def isotonic_curves(train: DataFrame, features: Sequence[str], c: float = 0.1, folds: int = FOLDS) -> list[tuple]:
    """(model, curve, held) for each stratified fold: fitted on the other folds, calibrated on `held`, the fold itself.

    `held` has the model's score as `_raw`. Equal scores are pooled before the fit.
    """
    drawn = stratified_folds(train, folds)
    out = []
    for k in range(folds):
        model = fit_logistic(drawn.filter(F.col("fold") != k).drop("fold"), features, c)
        held = predict(model, drawn.filter(F.col("fold") == k), features, "_raw")
        pooled = held.groupBy("_raw").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
        curve = IsotonicRegression(featuresCol="_raw", labelCol="label", weightCol="weight", predictionCol=f"_cal{k}").fit(pooled)
        out.append((model, curve, held))
    return out


def isotonic_scores(train: DataFrame, test: DataFrame, features: Sequence[str], c: float = 0.1, folds: int = FOLDS) -> DataFrame:
    """Test rows with `score` (one model) and `calibrated` (mean of `folds` isotonic calibrations)."""
    out = predict(fit_logistic(train, features, c), test, features)
    names = []
    for k, (model, curve, _) in enumerate(isotonic_curves(train, features, c, folds)):
        out = curve.transform(predict(model, out, features, "_raw")).drop("_raw")
        names.append(f"_cal{k}")
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
    return out.withColumn("calibrated", mean).drop(*names)


def auc_brier(scored: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by ranks (ties count half) and the Brier score, both on the scores as they are, for each
    value of the columns `by`.

    Equal scores collapse to one row. Distinct scores are dealt to ranges that follow the data (`layout.in_ranges`), so
    scores that lie close together are cut as well as any others; the rows without label 1 below a range and those below inside it
    give each score its rank.
    """
    keys = list(by)
    by_score = scored.withColumn("_s", F.col(score).cast("double") + F.lit(0.0)).groupBy(*keys, "_s").agg(
        F.sum("label").alias("_pos"), F.sum(F.lit(1) - F.col("label")).alias("_neg"),
        F.sum((F.col("_s") - F.col("label")) * (F.col("_s") - F.col("label"))).alias("_sq"),
    )
    ranged = in_ranges(by_score, [*keys, "_s"], "scores")
    earlier = (Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_neg").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(*earlier)), F.lit(0))
    parts = parts.select(*keys, "_part", before.alias("_base"))
    inside = F.coalesce(F.sum("_neg").over(Window.partitionBy(*keys, "_part").orderBy("_s").rowsBetween(*earlier)), F.lit(0))
    below = F.col("_base") + F.col("_inside")
    pairs = ranged.withColumn("_inside", inside).join(parts, [*keys, "_part"]).withColumn(
        "_wins", F.col("_pos") * (below + F.col("_neg") * 0.5))
    n, pos, neg = F.sum(F.col("_pos") + F.col("_neg")), F.sum("_pos"), F.sum("_neg")
    return pairs.groupBy(*keys).agg(
        n.alias("n"), pos.alias("positives"),
        rnd(F.try_divide(F.sum("_wins"), pos * neg), 6).alias("auc"),
        rnd(F.try_divide(F.sum("_sq"), n), 6).alias("brier"),
    )


def calibration_curve(scored: DataFrame, score: str = "score", bins: int = 10) -> DataFrame:
    """Quantile bins: mean score against the share of positives, with a flag on gaps over 0.1."""
    wanted = {}
    for i in range(1, bins):
        wanted[f"lo{i}"] = lambda n, q=i / bins: F.floor((n - 1) * F.lit(q)).cast("bigint")
        wanted[f"hi{i}"] = lambda n, q=i / bins: F.ceil((n - 1) * F.lit(q)).cast("bigint")
    at = exact_ranks(scored, [], score, wanted)
    edges = []
    for i in range(1, bins):
        pos = (F.col("n") - 1) * F.lit(i / bins)
        edges.append(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (pos - F.floor(pos)))
    inner = at.select(F.array(*edges).alias("edges")).scalar()
    below = sum(((F.get(inner, F.lit(i)) < F.col(score)).cast("bigint") for i in range(bins - 1)), F.lit(0).cast("bigint"))
    binned = scored.withColumn("bin", below)
    out = binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("_pred"), F.avg("label").alias("_frac")
    )
    gap = F.col("_frac") - F.col("_pred")
    return out.select(
        "bin", "n", rnd(F.col("_pred"), 6).alias("mean_predicted"), rnd(F.col("_frac"), 6).alias("fraction_positive"),
        rnd(gap, 6).alias("gap"),
        F.when(gap < -0.1, F.lit("OVERCONFIDENT")).when(gap > 0.1, F.lit("UNDERCONFIDENT")).otherwise(F.lit("")).alias("flag"),
    )


CONFIDENCE_RANGES = ((0.3, 0.5), (0.5, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 1.0))


def confidence_buckets(
    scored: DataFrame, score: str = "score", ranges: Sequence[tuple[float, float]] = CONFIDENCE_RANGES, more_than: int = 10
) -> DataFrame:
    """Hit rate per score range [lo, hi); ranges with `more_than` or fewer rows are left out."""
    table = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in ranges])
    hits = scored.withColumn(
        "_r", F.explode(F.filter(table, lambda r: (F.col(score) >= r["lo"]) & (F.col(score) < r["hi"])))
    )
    return (
        hits.groupBy(F.col("_r.lo").alias("lo"), F.col("_r.hi").alias("hi"))
        .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("label") * 100, 1).alias("hit_rate"))
        .filter(F.col("n") > more_than)
    )


def threshold_hit_rate(scored: DataFrame, score: str = "score", thresholds: Sequence[float] = (0.55, 0.60, 0.65)) -> DataFrame:
    """Rows above each threshold and their hit rate."""
    over = F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col(score) > t)
    return (
        scored.withColumn("threshold", F.explode(over))
        .groupBy("threshold")
        .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("label") * 100, 1).alias("hit_rate"))
    )


def linear_scores(rows: DataFrame, fits: Sequence[newton.Fit], names: Sequence[str]) -> DataFrame:
    """`rows` with a probability for each fit."""
    def score(fit: newton.Fit) -> Column:
        logit = sum((F.col(f) * F.lit(w) for f, w in fit.named().items()), F.lit(fit.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

    return rows.withColumns({n: score(fit) for n, fit in zip(names, fits)})


def feature_ablation(
    split: DataFrame, features: Sequence[str] = tuple(config.BASE_FEATURES), c: float = 0.1, leak_drop: float = -0.05
) -> DataFrame:
    """AUC and Brier of the full model and of each model without one input, and how close each fit is to its optimum.

    `split` has scaled inputs, label and part. All models are fitted together, each Newton step by one pass over the training
    rows, and the test rows are scored by all models at once. The penalty is L1 and includes the intercept.
    """
    train, test = split.filter(F.col("part") == "train"), split.filter(F.col("part") == "test")
    dropped = [None, *features]
    fits = newton.fit_subsets(train, features, [[f for f in features if f != x] for x in dropped], c, "l1", penalise_intercept=True)
    names = ["FULL" if x is None else x for x in dropped]
    scored = linear_scores(test, fits, [f"_s{m}" for m in range(len(fits))])
    models = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"_s{m}").alias("score")) for m, n in enumerate(names)]))
    report = auc_brier(scored.select("label", models.alias("_m")).select("label", "_m.model", "_m.score"), by=["model"])
    gaps = F.create_map(*[x for n, fit in zip(names, fits) for x in (F.lit(n), F.lit(fit.gap))])
    empty = test.sparkSession.createDataFrame([(n,) for n in names], "model string")  # a test part without rows has a report too
    report = empty.join(report, "model", "left").withColumns({x: F.coalesce(x, F.lit(0).cast("bigint")) for x in ("n", "positives")})
    full = report.filter("model = 'FULL'").select(F.col("auc").alias("_full"))
    delta = F.when(F.col("model") != "FULL", rnd(F.col("auc") - F.col("_full"), 6))
    return report.join(F.broadcast(full)).select(  # one row
        "model", "n", "positives", "auc", "brier", delta.alias("delta_auc"),
        F.coalesce(delta < leak_drop, F.lit(False)).alias("leakage"), F.element_at(gaps, F.col("model")).alias("gap"))


def score_signals(
    scaled: DataFrame,
    features: Sequence[str],
    weights: Sequence[float],
    intercept: float,
    min_score: float = 0.5,
    limit: int = 20,
) -> DataFrame:
    """Scored signals: the newest `limit` per symbol at or above `min_score`.

    `scaled` holds scaled inputs next to symbol, id, time, price and bucket. The
    drivers are the three inputs with the largest |weight * input| of the row.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be within 1..100")
    logit = sum((F.col(f) * F.lit(float(w)) for f, w in zip(features, weights)), F.lit(float(intercept)))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    parts = F.array(*[
        F.struct((-F.abs(F.col(f) * F.lit(float(w)))).alias("c"), F.lit(i).alias("i"), F.lit(f).alias("name"))
        for i, (f, w) in enumerate(zip(features, weights))
    ])
    rows = scaled.withColumn("_score", score).withColumn("_parts", F.array_sort(parts)).filter(F.col("_score") >= min_score)
    newest = newest_per_symbol(rows, limit)  # `_pos` numbers them from the newest
    s = F.col("_score")
    bucket = F.coalesce("bucket", F.lit("UNKNOWN"))
    continues = s >= 0.5
    return newest.select(
        "symbol", "id", "price", "event_time_ms",
        F.when(continues, F.lit("CONTINUATION")).otherwise(F.lit("ABSORPTION")).alias("signal"),
        bucket.alias("spike_type"),
        rnd(s, 3).alias("score"),
        F.when(s >= 0.8, F.lit("HIGH")).when(s >= 0.6, F.lit("MEDIUM")).otherwise(F.lit("LOW")).alias("confidence"),
        F.when(continues, F.format_string(config.CONTINUATION_TEXT, bucket, s * 100))
        .otherwise(F.format_string(config.ABSORPTION_TEXT, bucket, (F.lit(1.0) - s) * 100)).alias("interpretation"),
        F.lit("FILTER_IN").alias("action"),
        F.concat_ws(",", F.transform(F.slice("_parts", 1, 3), lambda p: p["name"])).alias("drivers"),
        F.col("_pos").cast("bigint").alias("rank"),
    )


def newest_feature_rows(store: DataFrame, features: Sequence[str] = tuple(config.FLOW_FEATURES), last: int = 200) -> DataFrame:
    """The newest `last` rows per symbol that have order flow, nulls read as 0."""
    rows = newest_per_symbol(store.filter(F.col("imbalance_20").isNotNull()), last).drop("_pos")
    return rows.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
