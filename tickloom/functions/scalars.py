"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(x: Column, digits: int) -> Column:
    """Round, with negative zero folded into zero."""
    return F.round(x, digits) + F.lit(0.0)


def pct_change(new: Column, old: Column) -> Column:
    """(new - old) / old * 100; null when `old` is 0 or null."""
    return F.try_divide(new - old, old) * F.lit(100.0)


def pct_move(new: Column, old: Column) -> Column:
    """|new - old| / old * 100; null when `old` is 0 or null."""
    return F.try_divide(F.abs(new - old), old) * F.lit(100.0)


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded; null for an empty whole."""
    return rnd(F.try_divide(part, whole) * F.lit(100.0), digits)


def clock(ms: Column) -> Column:
    """HH:MM:SS of an epoch-ms time in the session time zone."""
    return F.date_format(F.timestamp_millis(ms), "HH:mm:ss")


def aggressor_side(is_buyer_maker: Column) -> Column:
    """A resting buyer means the aggressor sold; unknown counts as a buy."""
    return F.when(is_buyer_maker, F.lit("sell")).otherwise(F.lit("buy"))


def size_bucket(move: Column, p75: Column, p90: Column, p99: Column) -> Column:
    """Bucket of an absolute move; each bound belongs to the larger bucket. No move, no bucket."""
    return (
        F.when(move < p75, F.lit("SMALL"))
        .when(move < p90, F.lit("MEDIUM"))
        .when(move < p99, F.lit("LARGE"))
        .when(move.isNotNull(), F.lit("EXTREME"))
    )
