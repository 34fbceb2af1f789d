"""Microstructure features of sampled ticks.

A feature row is every `stride`-th tick after the first `WINDOW` ticks of its
symbol. The windows of the sampled ticks are read chunk by chunk (`operators/sampled.py`),
so the work per tick is a tenth of sliding a 100-row frame over every tick.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import series
from tickloom.functions.scalars import rnd
from tickloom.operators.asof import asof_forward
from tickloom.operators.layout import (
    RANK_CHUNK,
    UNTIL_NOW,
    chunk_window,
    oldest_per_symbol,
    with_rank,
)
from tickloom.operators.sampled import MINUTE, RATE_ROWS, STRIDE, WINDOW, sampled_rows
from tickloom.operators.tape import SUMS, TOTALS, number, totals_at

EXACT = "decimal(38,18)"  # running totals of quantities and moves


def trade_rate(ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE, rate_rows: int | None = None) -> DataFrame:
    """(symbol, id, trade_rate_1m) of the sampled ticks: ticks of the last minute before each, by row numbers; at most `rate_rows`."""
    ranked = with_rank(ticks.select("id", "symbol", "event_time_ms"))
    asked = ranked.filter(is_sampled(window, stride)).withColumn("target_ms", F.col("event_time_ms") - MINUTE)
    found = asof_forward(asked, ranked, offsets=(-MINUTE,), fetch=("_rn",), crowd=ticks)
    rate = F.col("_rn") - F.col("found__rn")
    return found.select("symbol", "id", (rate if rate_rows is None else F.least(rate, F.lit(rate_rows))).alias("trade_rate_1m"))


def tick_features(ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE, rate_rows: int | None = RATE_ROWS) -> DataFrame:
    """Feature rows with move, rank, z-score, bucket, spread, flips, range, volatility, rate, hour, latency.

    The published trade rate counts at most the 200 ticks before; `rate_rows=None` counts the whole minute, any other number
    at most so many.
    """
    if rate_rows != RATE_ROWS:
        cut = tick_features(ticks, window, stride)
        return cut.drop("trade_rate_1m").join(trade_rate(ticks, window, stride, rate_rows), ["symbol", "id"]).select(cut.columns)
    return tick_columns(sampled_rows(ticks, window, stride, TICK_COLUMNS, path=False))


TICK_COLUMNS = ("quantity", "ingest_time_ms")


def tick_columns(rows: DataFrame, more: Sequence[Column | str] = ()) -> DataFrame:
    """The feature columns of `sampled_rows`, and `more`."""
    spike = F.col("spike")
    bucket = (
        F.when(spike.isNull(), F.lit(None))
        .when((F.col("moves") == 0) | (spike < F.col("level_75")), F.lit("SMALL"))
        .when(spike < F.col("level_90"), F.lit("MEDIUM"))
        .when(spike < F.col("level_99"), F.lit("LARGE"))
        .otherwise(F.lit("EXTREME"))
    )
    rank = F.when(F.col("moves") > 0, F.col("below") / F.col("moves")).otherwise(F.lit(0.0))
    z = F.when(F.col("std") > 0, rnd((spike - F.col("mean")) / F.col("std"), 3)).otherwise(F.lit(0.0))
    hour = F.pmod(
        ((F.col("event_time_ms") - F.pmod("event_time_ms", F.lit(3_600_000))) / 3_600_000).cast("bigint"), F.lit(24)
    )
    return rows.select(
        "id", "symbol", "event_time_ms", "price",
        rnd(spike, 8).alias("spike_pct"),
        rnd(rank, 6).alias("spike_rank"),
        z.alias("zscore"),
        bucket.alias("bucket"),
        F.lit("PENDING").alias("signal"),
        F.lit(0.0).alias("confidence"),
        F.col("quantity").alias("volume"),
        rnd(F.col("spread"), 8).alias("spread_est"),
        rnd(F.col("flips"), 4).alias("flip_rate"),
        rnd(F.col("range"), 6).alias("micro_range"),
        rnd(F.coalesce(F.col("std"), F.lit(0.0)), 8).alias("volatility_1m"),
        F.col("rate").cast("bigint").alias("trade_rate_1m"),
        rnd(hour / 24, 4).alias("hour_of_day"),
        (F.col("ingest_time_ms") - F.col("event_time_ms")).alias("latency_ms"),
        *more,
    )


def spread_snapshot(ticks: DataFrame, current_ms, back_ms: int = 5_000, rows: int = 200) -> DataFrame:
    """Roll spread, flip rate and range per symbol over the last `back_ms` (the oldest `rows` of it)."""
    now = F.lit(current_ms) if isinstance(current_ms, int) else current_ms
    recent = oldest_per_symbol(
        ticks.select("id", "symbol", "event_time_ms", "price").filter(F.col("event_time_ms") >= now - back_ms), rows
    )
    prices = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "price"))), lambda x: x["price"])
    return recent.groupBy("symbol").agg(prices.alias("prices")).select(
        "symbol",
        F.size("prices").cast("bigint").alias("ticks"),
        rnd(series.roll_spread(F.col("prices")), 6).alias("roll_spread"),
        rnd(series.flip_rate(F.col("prices")), 4).alias("flip_rate"),
        rnd(series.micro_range(F.col("prices")), 6).alias("micro_range"),
    )


def snapshots(rows: DataFrame, snap: Sequence[str], probes: dict[str, tuple[int, bool]], keep: Sequence[str]) -> DataFrame:
    """State of the tape at shifted times, for rows already cut into time chunks.

    For every row with `_ask`, and every probe (offset_ms, inclusive), the `snap`
    columns of the last tick with time < t + offset (<= when inclusive). Running
    totals among the `snap` columns turn two snapshots into the total of the time
    window between them, so a window costs the same however many ticks it holds.
    Reuses the (symbol, _chunk) partitioning: no further exchange.
    """
    own = F.array(
        F.struct(
            F.col("event_time_ms").alias("at"), F.lit(1).alias("ord"),
            F.lit(None).cast("string").alias("name"), F.struct(*snap).alias("state"),
        )
    )
    state_type = rows.select(F.struct(*snap).alias("state")).schema["state"].dataType
    asked = F.array(*[
        F.struct(
            (F.col("event_time_ms") + offset).alias("at"), F.lit(2 if inclusive else 0).alias("ord"),
            F.lit(name).alias("name"), F.lit(None).cast(state_type).alias("state"),
        )
        for name, (offset, inclusive) in probes.items()
    ])
    points = rows.select(
        "symbol", "_chunk", "_home", "id", "event_time_ms", *keep,
        F.explode(F.when(F.col("_ask"), F.concat(own, asked)).otherwise(own)).alias("_pt"),
    )
    w = (
        Window.partitionBy("symbol", "_chunk")
        .orderBy("_pt.at", "_pt.ord", "id")
        .rowsBetween(*UNTIL_NOW)
    )
    seen = points.withColumn("_seen", F.last("_pt.state", ignorenulls=True).over(w)).filter(
        F.col("_pt.name").isNotNull()
    )
    return seen.groupBy("symbol", "_chunk", "_home", "id", "event_time_ms").agg(
        *[F.first(c).alias(c) for c in keep],
        *[F.first(F.when(F.col("_pt.name") == name, F.col("_seen")), ignorenulls=True).alias(name) for name in probes],
    )


def _state(name: str, field: str) -> Column:
    """A running total at a probe; 0 before the first tick at hand."""
    return F.coalesce(F.col(f"{name}.{field}"), F.lit(0))


def lookback_counts(ticks: DataFrame, windows: Sequence[int] = (1_000, 2_000, 60_000)) -> DataFrame:
    """Ticks of the symbol in [t - w, t) for each window w, for every tick: differences of row numbers found by as-of."""
    ranked = with_rank(ticks.select("id", "symbol", "event_time_ms"), peers=True)
    steps = F.array(*[F.struct(F.lit(f"n_{w}ms").alias("name"), F.lit(w).cast("bigint").alias("ms")) for w in windows])
    probes = ranked.withColumn("_w", F.explode(steps)).select(
        "symbol", "id", "event_time_ms", "_rn_first", F.col("_w.name").alias("_name"),
        (F.col("event_time_ms") - F.col("_w.ms")).alias("target_ms"),
    )
    found = asof_forward(probes, ranked, offsets=[-w for w in windows], fetch=("_rn",), crowd=ticks)
    # a tick is never before its own window, so "nothing found" means the tape starts later
    n = F.col("_rn_first") - F.coalesce("found__rn", F.lit(1))
    return found.groupBy("symbol", "id", "event_time_ms").agg(
        *[F.max(F.when(F.col("_name") == f"n_{w}ms", n)).alias(f"n_{w}ms") for w in windows]
    )


def is_sampled(window: int = WINDOW, stride: int = STRIDE) -> Column:
    """Every `stride`-th row after the first `window` rows of its symbol."""
    return (F.col("_rn") > window) & (F.pmod(F.col("_rn") - 1 - window, F.lit(stride)) == 0)


def tape_totals(rows: DataFrame) -> DataFrame:
    """Running totals of the tape inside a chunk: count, signed volume, volume, moves and their squares."""
    w = chunk_window()
    run = w.rowsBetween(*UNTIL_NOW)
    prev = F.lag("price").over(w)
    return (
        rows.withColumn("_prev", prev)
        .withColumn("c", F.coalesce(F.signum(F.col("price") - F.col("_prev")) * F.col("quantity"), F.lit(0.0)))
        .withColumn("x", F.when(F.col("_prev") > 0, F.try_divide(F.abs(F.col("price") - F.col("_prev")), F.col("_prev")) * 100.0))
        .withColumn("seen", F.row_number().over(w))
        .withColumn("sum_c", F.sum(F.col("c").cast(EXACT)).over(run))
        .withColumn("sum_q", F.sum(F.col("quantity").cast(EXACT)).over(run))
        .withColumn("n_q", F.sum((F.col("quantity") > 0).cast("int")).over(run))
        .withColumn("n_x", F.count("x").over(run))
        .withColumn("sum_x", F.sum(F.coalesce("x", F.lit(0.0))).over(run))
        .withColumn("sum_xx", F.sum(F.coalesce(F.col("x") * F.col("x"), F.lit(0.0))).over(run))
        .withColumn("_diff", F.coalesce((F.col("x") != F.lag("x").over(w)).cast("int"), F.lit(1)))
        .withColumn("n_diff", F.sum("_diff").over(run))
        .withColumn("std_5", F.stddev_pop("x").over(w.rowsBetween(-4, 0)))
        # the tick that follows: the first tick of a window that starts here
        .withColumns({
            "next_c": F.lead("c").over(w), "next_q": F.lead("quantity").over(w),
            "next_x": F.lead("x").over(w), "next_d1": F.lead("_diff", 1).over(w), "next_d2": F.lead("_diff", 2).over(w),
            "first_q": F.first("quantity").over(run),
        })
    )


TAPE = [
    "price", "seen", "sum_c", "sum_q", "n_q", "n_x", "sum_x", "sum_xx", "n_diff", "std_5",
    "next_c", "next_q", "next_x", "next_d1", "next_d2", "first_q",
]


def _flow(start: str, end: str = "now") -> dict[str, Column]:
    """Totals of the window between two snapshots, without its first tick's change.

    The first tick of a window has no change inside the window, so its signed
    volume, volume and move are taken out again.
    """
    gap = lambda f: _state(end, f) - _state(start, f)
    first_q = F.coalesce(F.col(f"{start}.next_q"), F.col(f"{end}.first_q"), F.lit(0.0))
    first_c = F.coalesce(F.col(f"{start}.next_c"), F.lit(0.0))
    first_x = F.col(f"{start}.next_x")
    n_x = gap("n_x") - first_x.isNotNull().cast("int")
    sum_x = gap("sum_x") - F.coalesce(first_x, F.lit(0.0))
    sum_xx = gap("sum_xx") - F.coalesce(first_x * first_x, F.lit(0.0))
    changes = gap("n_diff") - F.coalesce(F.col(f"{start}.next_d1"), F.lit(1)) - F.coalesce(F.col(f"{start}.next_d2"), F.lit(1))
    mean_x = F.try_divide(sum_x, n_x)
    # equal moves have no spread: counted exactly, not left to rounding of totals
    var = F.when(n_x <= 0, F.lit(None)).when(changes <= 0, F.lit(0.0)).otherwise(F.greatest(F.try_divide(sum_xx, n_x) - mean_x * mean_x, F.lit(0.0)))
    has_volume = gap("n_q") - (first_q > 0).cast("int") > 0
    exact = lambda f, first: (gap(f) - first.cast(EXACT)).cast("double")  # decimals: differences of totals lose nothing
    signed = F.when(has_volume, exact("sum_c", first_c)).otherwise(F.lit(0.0))
    volume = F.when(has_volume, exact("sum_q", first_q)).otherwise(F.lit(0.0))
    return {"n": gap("seen"), "signed": signed, "volume": volume, "n_x": n_x, "std_x": F.sqrt(var)}


def _flow_output(rows: DataFrame, p: dict[str, Column]) -> DataFrame:
    """Order-flow columns from the parts of a row's windows."""
    burst = p["n_1s"] / F.when(p["n_60s"] > 0, p["n_60s"] / F.lit(60.0)).otherwise(F.lit(1.0))
    rows = rows.withColumns({
        "_n": p["n"],
        "_imb": p["signed"] / F.greatest(p["volume"], F.lit(1e-10)),
        "_burst": burst,
        "_ratio": F.when((p["n_x"] >= 5) & (p["std_x"] > 0), p["std_5"] / p["std_x"]).otherwise(F.lit(1.0)),
        "_decay": F.when(
            (p["n_post"] >= 2) & (F.col("p0") > 0), (p["post_price"] - F.col("p0")) / F.col("p0") * 100.0
        ).otherwise(F.lit(0.0)),
    })
    enough = F.col("_n") >= 3
    return rows.select(
        "symbol", "id", "event_time_ms",
        F.when(enough, rnd(F.col("_imb"), 6)).alias("imbalance_20"),
        F.when(enough, rnd(F.col("_burst"), 4)).alias("burst_1s"),
        F.when(enough, rnd(F.col("_ratio"), 4)).alias("vol_ratio"),
        F.when(enough, rnd(F.col("_decay"), 8)).alias("decay_500ms"),
        F.when(enough, rnd(F.col("_imb") * F.col("_burst"), 6)).alias("dir_burst"),
    )


def orderflow_features(ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """Order-flow features of the sampled ticks.

    imbalance_20 covers the 2 s before the tick, vol_ratio compares the last five
    moves of those 2 s with all of them, burst_1s the last second with the last
    minute. Null when fewer than 3 ticks lie in the 2 s. decay_500ms looks ahead
    and is never a model input.

    Windows are ranges of row numbers: their ends are found by one as-of pass, counts are
    differences of row numbers, and sums are differences of two totals fetched by row
    number (`operators/tape.py`). Nothing holds more than one chunk of ticks, however many ticks a second has.
    """
    cols = ticks.select("id", "symbol", "event_time_ms", "price", "quantity")
    ranked = with_rank(cols, peers=True)
    ends = {"w1": -1_000, "w2": -2_000, "w60": -MINUTE, "post": 501}
    steps = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ms).cast("bigint").alias("ms")) for n, ms in ends.items()])
    keys = ["symbol", "id", "event_time_ms", "price", "_rn_first", "_n"]
    probes = ranked.filter(is_sampled(window, stride)).withColumn("_e", F.explode(steps)).select(
        *keys, F.col("_e.name").alias("_name"), (F.col("event_time_ms") + F.col("_e.ms")).alias("target_ms")
    )
    found = asof_forward(probes, ranked, offsets=list(ends.values()), fetch=("_rn",), crowd=ticks)
    name, end = F.col("_name"), F.coalesce("found__rn", F.when(F.col("_name") == "post", F.col("_n") + 1).otherwise(F.lit(1)))
    # each end asks for the state of one tick: the first of the 2 s, the last before the tick, the last of the half second after it
    asked = found.select(
        "symbol", "id", "event_time_ms", F.col("price").alias("p0"), "_rn_first", "_name", end.alias("_end"),
        F.when(name == "w2", end).when(name == "post", end - 1).otherwise(F.col("_rn_first") - 1).alias("_rn"),
    )
    met = totals_at(ranked, asked, RANK_CHUNK)
    sign = F.when(name == "w2", F.lit(-1)).when(name == "w1", F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    of = lambda n, c: F.max(F.when(name == n, F.col(c)))
    rows = met.groupBy("symbol", "id", "event_time_ms", "p0", "_rn_first").agg(
        *[of(n, "_end").alias(n) for n in ends], *[F.sum(sign * F.col(c)).alias(c) for c in TOTALS],
        of("w2", "at_next_d").alias("_next_d"), of("w1", "at_std_5").alias("_std_5"), of("post", "at_price").alias("_after"),
    )
    total = {c: number(*[F.col(f"{c}{k}") for k in range(3)]) for c in SUMS}
    mean = F.try_divide(total["x"], F.col("n_x"))
    spread = F.greatest(F.try_divide(total["xx"], F.col("n_x")) - mean * mean, F.lit(0.0))
    var = F.when(F.col("n_diff") - F.col("_next_d") <= 0, F.lit(0.0)).otherwise(spread)
    has_volume = F.col("n_q") > 0
    now = F.col("_rn_first")
    return _flow_output(rows, {
        "n": now - F.col("w2"), "n_1s": now - F.col("w1"), "n_60s": now - F.col("w60"),
        "signed": F.when(has_volume, total["c"]).otherwise(F.lit(0.0)),
        "volume": F.when(has_volume, total["q"]).otherwise(F.lit(0.0)),
        "n_x": F.col("n_x"), "std_x": F.sqrt(var), "std_5": F.col("_std_5"),
        "n_post": F.col("post") - now, "post_price": F.col("_after"),
    })


def sampled_ticks(ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """The ticks that become feature rows."""
    return with_rank(ticks).filter(is_sampled(window, stride)).drop("_rn", "_n")
