"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# A raw trade message as the feed sends it: price and quantity are text.
TRADE_MESSAGE = T.StructType([
    T.StructField("e", T.StringType()),
    T.StructField("s", T.StringType()),
    T.StructField("p", T.StringType()),
    T.StructField("q", T.StringType()),
    T.StructField("T", T.LongType()),
    T.StructField("t", T.LongType()),
    T.StructField("m", T.BooleanType()),
])

MARKET_EVENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("event_time_ms", T.LongType()),
    T.StructField("ingest_time_ms", T.LongType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("raw", T.StringType()),
])

SIGNAL_OUTCOMES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("price_entry", T.DoubleType()),
    T.StructField("event_time_ms", T.LongType()),
    T.StructField("price_10s", T.DoubleType()),
    T.StructField("price_30s", T.DoubleType()),
    T.StructField("result_10s", T.StringType()),
    T.StructField("result_30s", T.StringType()),
])

# The test event table that is read as ticks.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
