"""OHLCV candles, minute metrics, and move distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ranks import exact_ranks, median_indexes, nearest_rank_index, nearest_ranks
from tickloom.functions.scalars import pct_move, rnd
from tickloom.operators.layout import TICK, order_key, slot_start, with_previous

MINUTE_MS = 60_000


def candles(ticks: DataFrame, interval_ms: int = 1_000) -> DataFrame:
    """Open/high/low/close/volume per symbol and non-empty interval.

    Map-side partial hash aggregation: one row per candle and task is exchanged,
    and no sort is needed for the first and the last price.
    """
    key = order_key(F.col("event_time_ms"), F.col("id"), interval_ms)
    return (
        ticks.filter(F.col("event_type") == "trade")
        .groupBy("symbol", slot_start(F.col("event_time_ms"), interval_ms).alias("time_ms"))
        .agg(
            F.min_by("price", key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", key).alias("close"),
            F.sum("quantity").alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
    )


SPAN = (
    "symbol string, time_ms bigint, first struct<event_time_ms: bigint, id: bigint, price: double>, "
    "last struct<event_time_ms: bigint, id: bigint, price: double>, trades bigint"
)


def spans(ticks: DataFrame, interval_ms: int = 1_000) -> DataFrame:
    """Candles that can be merged: the first and the last trade of each interval, and how many there are."""
    end = F.struct("event_time_ms", "id", "price")
    return ticks.filter(F.col("event_type") == "trade").groupBy(
        "symbol", slot_start(F.col("event_time_ms"), interval_ms).alias("time_ms")
    ).agg(F.min(end).alias("first"), F.max(end).alias("last"), F.count(F.lit(1)).alias("trades"))


def merge_spans(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol", "time_ms").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("trades").alias("trades"))


def span_candles(rows: DataFrame) -> DataFrame:
    """Open, close and trades of merged candles."""
    return rows.select("symbol", "time_ms", F.col("first.price").alias("open"), F.col("last.price").alias("close"), "trades")


def body_pct() -> Column:
    return F.try_divide(F.col("close") - F.col("open"), F.col("open")) * F.lit(100.0)


def candle_moves(candle_rows: DataFrame) -> DataFrame:
    """Absolute open-to-close move in percent, for candles with a positive open."""
    return candle_rows.filter(F.col("open") > 0).withColumn("move", F.abs(body_pct()))


def candle_move_stats(ticks: DataFrame) -> DataFrame:
    """Mean, sample deviation, P95 and P99 of 1-second candle moves."""
    moves = candle_moves(candles(ticks)).select("symbol", "move")
    spread = moves.groupBy("symbol").agg(F.avg("move").alias("mean"), F.stddev_samp("move").alias("std"))
    ranks = nearest_ranks(moves, ["symbol"], "move", {"p95": 0.95, "p99": 0.99})
    return ranks.join(spread, "symbol").select(
        "symbol", F.col("n").alias("candles"),
        rnd(F.col("mean"), 6).alias("mean_move"), rnd(F.col("std"), 6).alias("std_move"),
        rnd(F.col("p95"), 6).alias("p95"), rnd(F.col("p99"), 6).alias("p99"),
    )


def tick_moves(ticks: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Ticks with the previous price and the absolute move in percent."""
    return with_previous(ticks, keep=keep).withColumn("move_pct", pct_move(F.col("price"), F.col("prev_price")))


def tick_move_stats(ticks: DataFrame) -> DataFrame:
    """Mean, sample deviation, median, P99 and P99.9 of tick-to-tick moves."""
    moves = (
        tick_moves(ticks, keep=TICK)
        .filter(F.col("move_pct").isNotNull())
        .select("symbol", "move_pct")
    )
    spread = moves.groupBy("symbol").agg(
        F.avg("move_pct").alias("mean"), F.stddev_samp("move_pct").alias("std")
    )
    wanted = median_indexes() | {
        "p99": lambda n: nearest_rank_index(n, 0.99),
        "p999": lambda n: nearest_rank_index(n, 0.999),
    }
    ranks = exact_ranks(moves, ["symbol"], "move_pct", wanted)
    return ranks.join(spread, "symbol").select(
        "symbol", F.col("n").alias("moves"),
        rnd(F.col("mean"), 6).alias("mean_move"), rnd(F.col("std"), 6).alias("std_move"),
        rnd((F.col("_med_lo") + F.col("_med_hi")) / 2, 6).alias("median_move"),
        rnd(F.col("p99"), 6).alias("p99"), rnd(F.col("p999"), 6).alias("p999"),
    )


def move_percentiles(ticks: DataFrame, interval_ms: int = 1_000) -> DataFrame:
    """Nearest-rank percentiles of candle moves per symbol."""
    probs = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
    return nearest_ranks(candle_moves(candles(ticks, interval_ms)), ["symbol"], "move", probs)


def _minute_aggs() -> list[Column]:
    latency = F.col("ingest_time_ms") - F.col("event_time_ms")
    return [
        F.count(F.lit(1)).alias("trade_count"),
        rnd(F.avg(latency), 6).alias("avg_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
        F.min("price").alias("price_low"),
        F.max("price").alias("price_high"),
        rnd(F.sum("quantity"), 6).alias("volume"),
    ]


def metrics_1min(ticks: DataFrame, now_ms, minutes: int = 60) -> DataFrame:
    """Per symbol and minute: trades, latency, price range, volume; the last `minutes`."""
    if not 1 <= minutes <= 1440:
        raise ValueError("minutes must be within 1..1440")
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    recent = ticks.filter((F.col("event_type") == "trade") & (F.col("event_time_ms") >= now - minutes * MINUTE_MS))
    return recent.groupBy(slot_start(F.col("event_time_ms"), MINUTE_MS).alias("bucket_ms"), "symbol").agg(
        *_minute_aggs()
    )


def metrics_1min_slippage(ticks: DataFrame) -> DataFrame:
    """Minute metrics of the whole table with the mean absolute tick-to-tick price change."""
    rows = with_previous(ticks.filter(F.col("event_type") == "trade"))
    return rows.groupBy("symbol", slot_start(F.col("event_time_ms"), MINUTE_MS).alias("bucket_ms")).agg(
        *_minute_aggs(), rnd(F.avg(F.abs(F.col("price") - F.col("prev_price"))), 6).alias("avg_slippage")
    )
