"""Signal outcomes: resolution against later prices, and accuracy reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import config
from tickloom.functions.scalars import pct_change, pct_move, rnd, share
from tickloom.operators.asof import asof_horizons
from tickloom.operators.layout import newest_per_symbol

SETTLE_MS = 10_000
HORIZONS = {"price_10s": 8_000, "price_30s": 28_000}


def verdict(signal: Column, move: Column, threshold: Column) -> Column:
    """WIN / NEUTRAL / LOSS of a signal for a later move in percent; all bounds are strict."""
    won = F.when(signal == "REV_EDGE", move < -threshold).when(signal == "CONT_EDGE", move > threshold)
    return (
        F.when(~signal.isin("REV_EDGE", "CONT_EDGE"), F.lit("NEUTRAL"))
        .when(won, F.lit("WIN"))
        .when(F.abs(move) < threshold * 0.5, F.lit("NEUTRAL"))
        .otherwise(F.lit("LOSS"))
    )


def resolve_priced(rows: DataFrame) -> DataFrame:
    """Set result_10s/result_30s from price_10s/price_30s; a missing price stays PENDING."""
    threshold = config.keyed_case(F.col("bucket"), config.OUTCOME_THRESHOLD, config.DEFAULT_THRESHOLD)

    def result(price: str) -> Column:
        move = F.coalesce(pct_change(F.col(price), F.col("price_entry")), F.lit(0.0))
        return F.when(F.col(price).isNotNull(), verdict(F.col("signal"), move, threshold)).otherwise(F.lit("PENDING"))

    return rows.withColumns({"result_10s": result("price_10s"), "result_30s": result("price_30s")})


def resolve_outcomes(recorded: DataFrame, ticks: DataFrame, now_ms) -> DataFrame:
    """Resolve recorded signals older than 10 s with the first prices 8 s and 28 s later.

    Each horizon settles on its own; younger signals and missing prices stay PENDING.
    """
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    bare = recorded.drop("price_10s", "price_30s", "result_10s", "result_30s")
    priced = asof_horizons(bare, ticks, HORIZONS)
    due = F.col("event_time_ms") < now - SETTLE_MS
    priced = priced.withColumns({p: F.when(due, F.col(p)) for p in HORIZONS})
    return resolve_priced(priced).select(
        "id", "symbol", "signal", "bucket", "confidence", "price_entry", "event_time_ms",
        "price_10s", "price_30s", "result_10s", "result_30s",
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    r = F.col("result_10s")
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(r == "PENDING").alias("pending"),
        F.count_if(r == "WIN").alias("win"),
        F.count_if(r == "LOSS").alias("loss"),
    )


def outcomes_by_bucket(outcomes: DataFrame) -> DataFrame:
    settled = outcomes.filter(F.col("result_10s") != "PENDING")
    return settled.groupBy("bucket", "signal").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("result_10s") == "WIN").alias("wins"),
        rnd(F.avg("confidence"), 3).alias("avg_conf"),
    ).withColumn("win_pct", share(F.col("wins"), F.col("n")))


def accuracy(outcomes: DataFrame, last: int = 500) -> DataFrame:
    """Win rates over the newest `last` outcomes per symbol.

    win_rate_30s keeps the customary ratio to the outcomes settled at 10 s;
    win_rate_30s_own divides by those settled at 30 s.
    """
    newest = newest_per_symbol(outcomes, last, prune=True)
    counts = newest.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("result_10s") != "PENDING").alias("validated"),
        F.count_if(F.col("result_30s") != "PENDING").alias("_validated_30"),
        F.count_if(F.col("result_10s") == "WIN").alias("_wins_10"),
        F.count_if(F.col("result_30s") == "WIN").alias("_wins_30"),
        rnd(F.avg("confidence"), 3).alias("avg_confidence"),
    )
    return counts.select(
        "symbol", "total", "validated",
        share(F.col("_wins_10"), F.col("validated")).alias("win_rate_10s"),
        share(F.col("_wins_30"), F.col("validated")).alias("win_rate_30s"),
        share(F.col("_wins_30"), F.col("_validated_30")).alias("win_rate_30s_own"),
        "avg_confidence",
    )


def micro_move_diag(outcomes: DataFrame, tiny: float = 0.001) -> DataFrame:
    """How small the moves after signals were."""
    move = pct_move(F.col("price_10s"), F.col("price_entry"))
    return outcomes.filter(F.col("price_10s").isNotNull()).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(move < tiny).alias("micro_moves"),
        rnd(F.avg(move), 8).alias("avg_move_pct"),
        rnd(F.avg(F.col("price_10s") - F.col("price_entry")), 6).alias("avg_raw_move"),
    )


def outcome_sample(outcomes: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows (by time) with their signed move."""
    move = F.coalesce(pct_change(F.col("price_10s"), F.col("price_entry")), F.lit(0.0))
    return outcomes.orderBy("event_time_ms", "id").limit(rows).select(
        "id", "symbol", "signal", "bucket", "confidence", "price_entry", "price_10s", rnd(move, 6).alias("move_pct"), "result_10s"
    )


def outcome_price_match(outcomes: DataFrame, ticks: DataFrame) -> DataFrame:
    """Pairs of outcomes and ticks with the same price, per symbol of the outcome.

    Both sides are counted per price before they meet, so a price that many rows
    share costs one row in the join and no pair is ever built.
    """
    entries = outcomes.groupBy("symbol", F.col("price_entry").alias("price")).agg(F.count(F.lit(1)).alias("_a"))
    prices = ticks.groupBy("price").agg(F.count(F.lit(1)).alias("_b"))
    return entries.join(prices, "price").groupBy("symbol").agg(F.sum(F.col("_a") * F.col("_b")).alias("pairs"))
