"""Statistics over short, bounded arrays of consecutive prices (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail(a: Column) -> Column:
    """All but the first element."""
    return F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))


def init(a: Column) -> Column:
    """All but the last element."""
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))


def deltas(prices: Column) -> Column:
    return F.zip_with(tail(prices), init(prices), lambda cur, prev: cur - prev)


def pct_moves(prices: Column) -> Column:
    """|change| in percent between neighbours; a zero base gives no entry."""
    moves = F.zip_with(
        tail(prices),
        init(prices),
        lambda cur, prev: F.when(prev > 0, F.try_divide(F.abs(cur - prev), prev) * F.lit(100.0)),
    )
    return F.filter(moves, lambda m: m.isNotNull())


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def let(value: Column, fn) -> Column:
    """Bind `value` once inside an expression."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def std_pop(a: Column) -> Column:
    """Population standard deviation, two passes; null for an empty array."""
    return let(
        F.struct(a.alias("xs"), mean(a).alias("m")),
        lambda s: F.sqrt(
            F.try_divide(
                F.aggregate(s["xs"], F.lit(0.0), lambda acc, x: acc + (x - s["m"]) * (x - s["m"])),
                F.size(s["xs"]),
            )
        ),
    )


def covar_pop(a: Column, b: Column) -> Column:
    """Population covariance of two arrays of equal length."""
    return let(
        F.struct(a.alias("xs"), b.alias("ys"), mean(a).alias("mx"), mean(b).alias("my")),
        lambda s: F.try_divide(
            total(F.zip_with(s["xs"], s["ys"], lambda x, y: (x - s["mx"]) * (y - s["my"]))),
            F.size(s["xs"]),
        ),
    )


def roll_spread(prices: Column, min_prices: int = 10) -> Column:
    """Roll's spread 2*sqrt(-cov(d_i, d_{i-1})); 0 when the covariance is not negative."""
    return let(
        deltas(prices),
        lambda d: let(
            covar_pop(tail(d), init(d)),
            lambda cov: F.when(
                (F.size(d) >= min_prices - 1) & (cov < 0), F.lit(2.0) * F.sqrt(F.abs(cov))
            ).otherwise(F.lit(0.0)),
        ),
    )


def flip_rate(prices: Column, min_prices: int = 10) -> Column:
    """Share of neighbouring price changes with opposite signs."""
    return let(
        deltas(prices),
        lambda d: F.when(
            F.size(d) >= min_prices - 1,
            F.size(F.filter(F.zip_with(tail(d), init(d), lambda x, y: F.signum(x) * F.signum(y)), lambda p: p < 0))
            / F.greatest(F.size(d) - 1, F.lit(1)),
        ).otherwise(F.lit(0.0)),
    )


def micro_range(prices: Column, min_prices: int = 10) -> Column:
    return F.when(
        F.size(prices) >= min_prices, F.array_max(prices) - F.array_min(prices)
    ).otherwise(F.lit(0.0))
