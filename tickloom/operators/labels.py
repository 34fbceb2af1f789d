"""Labels from future prices: path, fixed horizon, volatility-scaled; and their distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import pct_change, rnd, share
from tickloom.operators.asof import asof_forward, asof_horizons
from tickloom.operators.extremes import range_extremes
from tickloom.operators.features import is_sampled
from tickloom.operators.layout import with_rank
from tickloom.operators.sampled import PATH_ROWS, STRIDE, WINDOW, sampled_rows

PATH_MS = 60_000
MIN_PATH = 5


def path_label_of(up: Column, down: Column, cost: float) -> Column:
    """Class of a future path from its highest and lowest return (percent)."""
    return (
        F.when((up > cost) & (down > -cost / 2), F.lit("CONTINUATION_UP"))
        .when((down < -cost) & (up < cost / 2), F.lit("CONTINUATION_DOWN"))
        .when((F.abs(up) < cost) & (F.abs(down) < cost), F.lit("NOISE"))
        .otherwise(F.lit("ABSORPTION"))
    )


def _path_by_rows(ticks: DataFrame, window: int, stride: int, path_rows: int | None) -> DataFrame:
    """Extremes of the ticks in [t, t + 60 s], at most the first `path_rows`, as ranges of row numbers.

    The end of a path is found by one as-of pass; n log n for any density and any length of path.
    """
    ranked = with_rank(ticks.select("id", "symbol", "event_time_ms", "price"), peers=True)
    asked = ranked.filter(is_sampled(window, stride)).withColumn("target_ms", F.col("event_time_ms") + PATH_MS + 1)
    found = asof_forward(asked, ranked, offsets=(PATH_MS + 1,), fetch=("_rn",), crowd=ticks)
    last = F.coalesce(F.col("found__rn") - 1, F.col("_n"))
    if path_rows is not None:
        last = F.least(last, F.col("_rn_first") + path_rows - 1)
    paths = found.select("symbol", "id", "event_time_ms", "price", F.col("_rn").alias("_q"), F.col("_rn_first").alias("_a"), last.alias("_b"))
    paths = paths.filter(F.col("_b") - F.col("_a") + 1 >= MIN_PATH)
    best = range_extremes(ranked, paths.select("symbol", "_q", "_a", "_b"), "price")
    return paths.join(best, ["symbol", "_q"]).select(
        "symbol", "id", "event_time_ms", "price", (F.col("_b") - F.col("_a") + 1).alias("path_ticks"), "highest", "lowest")


def future_extremes(ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE, path_rows: int | None = PATH_ROWS) -> DataFrame:
    """Highest and lowest price of the path after each sampled tick.

    The published path is the first 200 ticks with time in [t, t + 60 s], from the first tick
    of the same millisecond on. It is read from the chunk of the tick, a
    bounded array whatever the density. `path_rows=None` takes all ticks of the minute, any other
    number the first so many (`extremes.range_extremes`). Rows with fewer than 5 path ticks have none.
    """
    if path_rows != PATH_ROWS:
        return _path_by_rows(ticks, window, stride, path_rows)
    rows = sampled_rows(ticks, window, stride, past=False)
    return rows.select(
        "symbol", "id", "event_time_ms", "price", F.col("path_ticks").cast("bigint").alias("path_ticks"), "highest", "lowest",
    ).filter(F.col("path_ticks") >= MIN_PATH)


def path_label(
    ticks: DataFrame, cost: float = 0.01, window: int = WINDOW, stride: int = STRIDE, path_rows: int | None = PATH_ROWS
) -> DataFrame:
    """CONTINUATION_UP / CONTINUATION_DOWN / NOISE / ABSORPTION per sampled tick."""
    up, down = path_returns()
    return future_extremes(ticks, window, stride, path_rows).select(
        "symbol", "id", "event_time_ms", "path_ticks", rnd(up, 6).alias("max_return"), rnd(down, 6).alias("min_return"),
        path_label_of(up, down, cost).alias("micro_label"),
    )


def path_returns() -> tuple[Column, Column]:
    """Highest and lowest return (percent) of a path."""
    return pct_change(F.col("highest"), F.col("price")), pct_change(F.col("lowest"), F.col("price"))


def horizon_label(rows: DataFrame, ticks: DataFrame, bar: float = -0.001) -> DataFrame:
    """1 if the price fell by more than 0.001 % after 10 s / 30 s; rows without both prices are left out."""
    priced = asof_horizons(rows.select("symbol", "id", "event_time_ms", "price"), ticks, {"p10": 10_000, "p30": 30_000})
    return priced.filter(F.col("p10").isNotNull() & F.col("p30").isNotNull()).select(
        "symbol", "id",
        (pct_change(F.col("p10"), F.col("price")) < bar).cast("int").cast("string").alias("outcome_10s"),
        (pct_change(F.col("p30"), F.col("price")) < bar).cast("int").cast("string").alias("outcome_30s"),
    )


def vol_scaled_label(features: DataFrame, ticks: DataFrame, scale: float = 0.5, floor: float = 0.001) -> DataFrame:
    """1 if the return after 30 s / 60 s is below -scale * volatility."""
    priced = asof_horizons(
        features.select("symbol", "id", "event_time_ms", "price", "volatility_1m"), ticks,
        {"p30": 30_000, "p60": 60_000},
    )
    bar = -F.when(F.col("volatility_1m") > 0, F.col("volatility_1m")).otherwise(F.lit(floor)) * scale
    return priced.filter(F.col("p30").isNotNull() & F.col("p60").isNotNull()).select(
        "symbol", "id",
        (pct_change(F.col("p30"), F.col("price")) < bar).cast("int").cast("string").alias("label_30s"),
        (pct_change(F.col("p60"), F.col("price")) < bar).cast("int").cast("string").alias("label_60s"),
    )


def label_distribution(rows: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value."""
    counts = rows.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select("label", "n", share(F.col("n"), whole).alias("pct"))
