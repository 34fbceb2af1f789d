"""Scans over ticks: latest, replay, moves, polling, down-sampling, feed strips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import aggressor_side, clock, pct_change, pct_move, rnd
from tickloom.operators.candles import candle_moves, candles, tick_moves
from tickloom.operators.layout import (
    TICK,
    newest_per_symbol,
    oldest_per_symbol,
    order_key,
    with_rank,
)
from tickloom.sources.ticks import with_latency

EVENT_COLUMNS = [
    "id", "symbol", "price", "quantity", "event_time_ms", "ingest_time_ms",
    "latency_ms", "is_buyer_maker", "trade_id",
]
SLOW_MS = 300


def _check(name: str, value: int, low: int, high: int) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must be within {low}..{high}")


def events_latest(ticks: DataFrame, limit: int = 100, symbol: str | None = None) -> DataFrame:
    """Newest `limit` ticks per symbol with their latency."""
    _check("limit", limit, 1, 1000)
    rows = ticks if symbol is None else ticks.filter(F.col("symbol") == symbol.upper())
    return with_latency(newest_per_symbol(rows, limit, prune=True)).select(*EVENT_COLUMNS)


def replay(ticks: DataFrame, from_ms: int, to_ms: int, limit: int = 500, symbol: str | None = None) -> DataFrame:
    """Ticks with from_ms <= time <= to_ms, the oldest `limit` per symbol."""
    if from_ms >= to_ms:
        raise ValueError("from must be smaller than to")
    _check("limit", limit, 1, 5000)
    rows = ticks.filter(F.col("event_time_ms").between(from_ms, to_ms))
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol.upper())
    return with_latency(oldest_per_symbol(rows, limit, prune=True)).select(*EVENT_COLUMNS)


def recent_real_moves(ticks: DataFrame, last: int = 500, min_pct: float = 0.001) -> DataFrame:
    """Moves above `min_pct` among the newest `last` ticks; the first of them still has its predecessor."""
    rows = newest_per_symbol(ticks.select("id", "symbol", "event_time_ms", "price"), last + 1, prune=True)
    w = Window.partitionBy("symbol").orderBy(F.col("_pos").desc())
    moved = rows.withColumn("prev_price", F.lag("price").over(w)).withColumn(
        "move_pct", pct_move(F.col("price"), F.col("prev_price"))
    )
    return (
        moved.filter((F.col("_pos") <= last) & (F.col("move_pct") > min_pct))
        .select("symbol", "id", "event_time_ms", clock(F.col("event_time_ms")).alias("clock"),
                "price", "prev_price", rnd(F.col("move_pct"), 8).alias("move_pct"))
    )


def last_moves(ticks: DataFrame, last: int = 20) -> DataFrame:
    """Moves within the newest `last` ticks only: last-1 rows per symbol."""
    rows = newest_per_symbol(ticks.select("id", "symbol", "event_time_ms", "price"), last, prune=True)
    w = Window.partitionBy("symbol").orderBy(F.col("_pos").desc())
    return (
        rows.withColumn("prev_price", F.lag("price").over(w))
        .filter(F.col("prev_price").isNotNull())
        .select("symbol", "id", clock(F.col("event_time_ms")).alias("clock"), "price",
                rnd(pct_move(F.col("price"), F.col("prev_price")), 6).alias("move_pct"))
    )


def incremental_poll(ticks: DataFrame, last_id: int) -> DataFrame:
    """Rows that arrived after `last_id` (the filter reaches the scan)."""
    return ticks.filter(F.col("id") > last_id)


def poll_position(ticks: DataFrame, last_id: int) -> DataFrame:
    """Per symbol: new rows and the position to poll from next."""
    return incremental_poll(ticks, last_id).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("new_events"), F.max("id").alias("last_id")
    )


def downsample_stride(ticks: DataFrame, now_ms, minutes: int = 5, target: int = 200) -> DataFrame:
    """Every k-th tick of the last `minutes`, k = max(1, floor(n / target)), per symbol."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    ranked = with_rank(ticks.filter(F.col("event_time_ms") >= now - minutes * 60_000))
    step = F.greatest(F.floor(F.col("_n") / F.lit(target)).cast("bigint"), F.lit(1).cast("bigint"))
    return (
        ranked.withColumn("step", step)
        .filter(F.pmod(F.col("_rn") - 1, F.col("step")) == 0)
        .withColumn("idx", ((F.col("_rn") - 1) / F.col("step")).cast("bigint"))
        .drop("_rn", "_n")
    )


def latency_strip(ticks: DataFrame, last: int = 60, slow_ms: int = SLOW_MS) -> DataFrame:
    """The newest `last` latencies per symbol with their mean and maximum and a slow flag."""
    rows = with_latency(newest_per_symbol(ticks, last, prune=True)).withColumn("latency", F.abs("latency_ms"))
    w = Window.partitionBy("symbol")
    return rows.select(
        "symbol", "id", F.col("_pos").cast("bigint").alias("pos"), "latency",
        F.round(F.avg("latency").over(w)).cast("bigint").alias("avg_latency"),
        F.max("latency").over(w).alias("max_latency"),
        (F.col("latency") > slow_ms).alias("slow"),
    )


def price_change_since_open(ticks: DataFrame) -> DataFrame:
    """Last price and its change in percent since the first price, per symbol."""
    day = 86_400_000
    key = order_key(F.col("event_time_ms"), F.col("id"), day)
    per_day = ticks.groupBy("symbol", (F.col("event_time_ms") - F.pmod("event_time_ms", F.lit(day))).alias("day")).agg(
        F.min_by("price", key).alias("first"), F.max_by("price", key).alias("last")
    )
    ends = per_day.groupBy("symbol").agg(
        F.min_by("first", "day").alias("first_price"), F.max_by("last", "day").alias("last_price")
    )
    return ends.select(
        "symbol", "first_price", "last_price",
        rnd(pct_change(F.col("last_price"), F.col("first_price")), 3).alias("change_pct"),
    )


def feed_spike_tags(ticks: DataFrame, fetch: int = 300, show: int = 80, floor: float = 0.01) -> DataFrame:
    """The newest `show` rows, each compared with the newer row above it.

    The threshold is max(mean + 2 sd, floor) over the newest `fetch` rows.
    """
    rows = newest_per_symbol(ticks, fetch, prune=True)
    w = Window.partitionBy("symbol").orderBy("_pos")
    whole = Window.partitionBy("symbol")
    diff = F.abs(F.col("price") - F.col("above"))
    compared = (
        rows.withColumn("above", F.lag("price").over(w))
        .withColumn("diff", diff)
        .withColumn("threshold", F.greatest(
            F.coalesce(F.avg("diff").over(whole), F.lit(0.0)) + 2 * F.coalesce(F.stddev_pop("diff").over(whole), F.lit(0.0)),
            F.lit(floor)))
    )
    return compared.filter(F.col("_pos") <= show).select(
        "symbol", "id", F.col("_pos").cast("bigint").alias("pos"), "price",
        aggressor_side(F.col("is_buyer_maker")).alias("side"),
        F.coalesce(F.col("diff") > F.col("threshold"), F.lit(False)).alias("is_spike"),
        rnd(pct_change(F.col("price"), F.col("above")), 3).alias("pct"),
    )


def trade_side(ticks: DataFrame) -> DataFrame:
    return ticks.select("id", "symbol", aggressor_side(F.col("is_buyer_maker")).alias("side"))


def top_moves(ticks: DataFrame, candle_top: int = 10, tick_top: int = 20, notional: float = 77_000.0) -> DataFrame:
    """Largest candle moves and largest tick moves per symbol, with their value at a fixed notional."""
    by_candle = candle_moves(candles(ticks)).select(
        F.lit("candle").alias("kind"), "symbol", F.col("time_ms"), F.lit(0).cast("bigint").alias("id"), "move"
    )
    by_tick = tick_moves(ticks, keep=TICK).filter(
        F.col("move_pct").isNotNull()
    ).select(
        F.lit("tick").alias("kind"), "symbol", F.col("event_time_ms").alias("time_ms"), "id",
        F.col("move_pct").alias("move"),
    )
    w = Window.partitionBy("symbol").orderBy(F.col("move").desc(), "time_ms", "id")

    def largest(df: DataFrame, k: int) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    return largest(by_candle, candle_top).unionByName(largest(by_tick, tick_top)).select(
        "kind", "symbol", F.col("rank").cast("bigint").alias("rank"), "time_ms", "id",
        rnd(F.col("move"), 6).alias("move_pct"),
        rnd(F.col("move") / 100 * notional, 2).alias("move_value"),
    )
