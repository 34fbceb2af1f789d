"""Tick sources: stored ticks, raw trade messages, and the event table read as ticks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.layout import with_rank

# Fixed values of the event-to-tick reading: time runs 4000 times faster from
# this start, and prices sit on a base so that percent moves are small.
TICK_EPOCH_MS = 1_704_067_200_000
TIME_COMPRESSION = 4_000
PRICE_BASE = 78_000.0
LATENCY_STEP, LATENCY_SPAN = 37, 400


def events_as_ticks(events: DataFrame) -> DataFrame:
    """Read the event table (event_id, ts, user_id, event_type, value, props) as trade ticks."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(TICK_EPOCH_MS * 1000)
    width = F.lit(TIME_COMPRESSION * 1000)
    event_time = F.lit(TICK_EPOCH_MS) + ((micros - F.pmod(micros, width)) / width).cast("bigint")
    latency = F.pmod(F.col("event_id") * LATENCY_STEP, F.lit(LATENCY_SPAN))
    symbol = (
        F.when(F.col("event_type") == "click", F.lit("BTCUSDT"))
        .when(F.col("event_type") == "view", F.lit("ETHUSDT"))
        .otherwise(F.upper("event_type"))
    )
    return events.select(
        F.col("event_id").alias("id"),
        symbol.alias("symbol"),
        F.lit("trade").alias("event_type"),
        (F.lit(PRICE_BASE) + F.col("value")).alias("price"),
        (F.get_json_object("props", "$.k").cast("double") / F.lit(10.0)).alias("quantity"),
        event_time.alias("event_time_ms"),
        (event_time + latency).alias("ingest_time_ms"),
        F.col("event_id").alias("trade_id"),
        (F.pmod(F.col("user_id"), F.lit(2)) == 0).alias("is_buyer_maker"),
    )


def read_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_ticks(spark.read.parquet(f"{sf_dir}/events.parquet"))


def with_latency(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("latency_ms", F.col("ingest_time_ms") - F.col("event_time_ms"))


def as_messages(ticks: DataFrame, kind: Column | None = None) -> DataFrame:
    """Write ticks as raw trade messages (column `raw`), the form the feed delivers."""
    body = F.struct(
        (F.lit("trade") if kind is None else kind).alias("e"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("event_time_ms").alias("T"),
        F.col("trade_id").alias("t"),
        F.col("is_buyer_maker").alias("m"),
    )
    return ticks.select(F.to_json(body).alias("raw"), "ingest_time_ms")


def parse_messages(messages: DataFrame) -> DataFrame:
    """Parse `raw`; adds the message fields and `status`: ok, other_type or rejected.

    A message is rejected when it is not JSON or misses a required field; other
    event types are dropped on purpose. Price and quantity must read as numbers.
    """
    # json_tuple reads each message once and tells `T` (time) from `t` (trade id)
    fields = F.json_tuple("raw", "e", "s", "p", "q", "T", "t", "m").alias(
        "_kind", "symbol", "_price", "_quantity", "_time", "_trade", "_maker"
    )
    read = messages.select("raw", "ingest_time_ms", fields).select(
        "symbol",
        F.lit("trade").alias("event_type"),
        F.col("_price").try_cast("double").alias("price"),
        F.col("_quantity").try_cast("double").alias("quantity"),
        F.col("_time").try_cast("bigint").alias("event_time_ms"),
        "ingest_time_ms",
        F.col("_trade").try_cast("bigint").alias("trade_id"),
        F.col("_maker").try_cast("boolean").alias("is_buyer_maker"),
        "raw",
        "_kind",
    )
    required = ("symbol", "price", "quantity", "event_time_ms", "trade_id", "is_buyer_maker")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    status = (
        F.when(F.col("_kind") != "trade", F.lit("other_type"))
        .when((F.col("_kind") == "trade") & complete, F.lit("ok"))
        .otherwise(F.lit("rejected"))
    )
    return read.withColumn("status", status).drop("_kind")


def parse_trades(messages: DataFrame) -> DataFrame:
    """The ticks among raw messages."""
    return parse_messages(messages).filter(F.col("status") == "ok").drop("status")


def dead_letters(messages: DataFrame) -> DataFrame:
    """Messages that could not be read, kept for inspection."""
    return parse_messages(messages).filter(F.col("status") == "rejected").select("raw", "ingest_time_ms")


def load_events(ticks: DataFrame, limit: int | None = 10_000, symbol: str | None = None) -> DataFrame:
    """Oldest `limit` trades per symbol by event time, with latency.

    The limit may be far above what fits one task, so rows are numbered by the
    two-phase rank instead of a per-symbol window.
    """
    rows = ticks.filter(F.col("event_type") == "trade")
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol.upper())
    if limit is not None:
        rows = with_rank(rows).filter(F.col("_rn") <= limit).drop("_rn", "_n")
    return with_latency(rows).select(
        "id", "symbol", "price", "quantity", "event_time_ms", "latency_ms", "is_buyer_maker"
    )
