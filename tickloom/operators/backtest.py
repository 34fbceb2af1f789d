"""Event strategies evaluated as sets: entries, as-of exits, statistics, sweeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import rnd, share
from tickloom.operators.asof import asof_forward
from tickloom.operators.layout import BEFORE_NOW, SLOT_MS, UNTIL_NOW, slot_start, with_rank
from tickloom.operators.spikes import classified_spikes, first_fixed_moves, spike_frame
from tickloom.sources.tables import append_rows

FEE = 0.001


def follow_trades(
    spikes: DataFrame, ticks: DataFrame, holds: Sequence[int] = (30,), fee: float = FEE, reverse: bool = False,
    keep_open: bool = False,
) -> DataFrame:
    """Trade each spike for each holding time (seconds).

    Entry at the spike's price; exit at the first later tick at or after entry +
    hold; positions without an exit are dropped, or kept without PnL. `spikes` needs symbol, id,
    event_time_ms, price, pct, direction, latency_ms; other columns pass through.
    """
    entries = (
        spikes.withColumn("hold", F.explode(F.array(*[F.lit(int(h)) for h in holds])))
        .withColumn("target_ms", F.col("event_time_ms") + F.col("hold").cast("bigint") * 1000)
    )
    if reverse:
        entries = entries.withColumn(
            "direction", F.when(F.col("direction") == "down", F.lit("up")).otherwise(F.lit("down"))
        )
    closed = asof_forward(entries, ticks, offsets=[h * 1000 for h in holds])
    if not keep_open:
        closed = closed.filter(F.col("found_price").isNotNull())
    gross = F.try_divide(F.col("found_price") - F.col("price"), F.col("price"))
    signed = F.when(F.col("direction") == "up", gross).otherwise(-gross)
    return closed.withColumns({
        "exit_price": F.col("found_price"),
        "exit_time_ms": F.col("found_ms"),
        "hold_ms": F.col("found_ms") - F.col("event_time_ms"),
        "net_pnl_pct": (signed - 2 * fee) * 100.0,
    }).withColumn("win", F.col("net_pnl_pct") > 0).drop("found_price", "found_ms", "target_ms")


def _entries(ticks: DataFrame, zs: Sequence[float], min_pct: float) -> DataFrame:
    return spike_frame(ticks, zs, min_pct).select(
        "symbol", "id", "event_time_ms", "price", "pct", "direction", "z",
        (F.col("ingest_time_ms") - F.col("event_time_ms")).alias("latency_ms"),
    )


def spike_follow_trades(
    ticks: DataFrame, hold: int = 30, z: float = 2.0, min_pct: float = 0.01, fee: float = FEE
) -> DataFrame:
    return follow_trades(_entries(ticks, (z,), min_pct), ticks, (hold,), fee)


def trade_rows(trades: DataFrame) -> DataFrame:
    """Trades as reported: rounded, with their columns named for entry and exit."""
    return trades.select(
        "symbol", "id", F.col("event_time_ms").alias("entry_time_ms"), "exit_time_ms",
        F.col("price").alias("entry_price"), "exit_price", "direction",
        rnd(F.col("pct"), 6).alias("spike_pct"), "hold_ms", rnd(F.col("net_pnl_pct"), 8).alias("net_pnl_pct"),
        "win", "latency_ms",
    )


def _slot_summaries(trades: DataFrame, keys: Sequence[str], slot_ms: int) -> DataFrame:
    """Per group and time slot: sums of the trades, and `_fall`, the deepest fall below the peak so far.

    Trades are summed in order inside their slot; then one row per slot is scanned in
    order. So no task sees all trades of a symbol. Open positions (no PnL) only count
    as entries.
    """
    keys = list(keys)
    pnl, win = F.col("net_pnl_pct"), F.col("win")
    slotted = trades.withColumn("_slot", slot_start(F.col("event_time_ms"), slot_ms))
    inside = Window.partitionBy(*keys, "_slot").orderBy("event_time_ms", "id").rowsBetween(*UNTIL_NOW)
    running = slotted.withColumn("_cum", F.sum(F.coalesce(pnl, F.lit(0.0))).over(inside)).withColumn(
        "_peak", F.max("_cum").over(inside)
    )
    per_slot = running.groupBy(*keys, "_slot").agg(
        F.count(F.lit(1)).alias("_entries"), F.count(pnl).alias("_n"), F.count_if(win).alias("_winners"),
        F.sum(F.coalesce(pnl, F.lit(0.0))).alias("_total"),
        F.sum(F.when(win, pnl).otherwise(F.lit(0.0))).alias("_won"),
        F.max(pnl).alias("_best"), F.min(pnl).alias("_worst"),
        F.sum(F.when(pnl.isNotNull(), F.col("hold_ms"))).alias("_hold"),
        F.sum(F.when(pnl.isNotNull(), F.col("latency_ms"))).alias("_latency"),
        F.max("_cum").alias("_high"), F.min("_cum").alias("_low"), F.max(F.col("_peak") - F.col("_cum")).alias("_own"),
    )
    scan = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(*BEFORE_NOW)
    placed = per_slot.withColumn("_offset", F.coalesce(F.sum("_total").over(scan), F.lit(0.0)))
    peak_before = F.greatest(F.coalesce(F.max(F.col("_offset") + F.col("_high")).over(scan), F.lit(0.0)), F.lit(0.0))
    return placed.withColumn("_before", peak_before).withColumn(
        "_fall", F.greatest(F.col("_own"), F.col("_before") - (F.col("_offset") + F.col("_low")), F.lit(0.0))
    )


def max_drawdown(trades: DataFrame, keys: Sequence[str] = ("symbol",), slot_ms: int = SLOT_MS) -> DataFrame:
    """Largest fall of the cumulated PnL below its running peak (the peak starts at 0)."""
    return _slot_summaries(trades, keys, slot_ms).groupBy(*keys).agg(F.max("_fall").alias("max_drawdown"))


def trade_stats(trades: DataFrame, keys: Sequence[str] = ("symbol",), slot_ms: int = SLOT_MS) -> DataFrame:
    """Trade statistics per group in one pass; profit_factor is null when there is no loss to divide by.

    `entries` counts open positions too, if `trades` holds them.
    """
    n, winners = F.sum("_n"), F.sum("_winners")
    losers = n - winners
    avg_win = F.coalesce(F.try_divide(F.sum("_won"), winners), F.lit(0.0))
    avg_loss = F.coalesce(F.try_divide(F.sum("_total") - F.sum("_won"), losers), F.lit(0.0))
    return _slot_summaries(trades, keys, slot_ms).groupBy(*keys).agg(
        F.sum("_entries").alias("entries"),
        n.alias("total_trades"),
        share(winners, n, 2).alias("win_rate_pct"),
        F.when(n > 0, rnd(F.sum("_total"), 4)).alias("total_pnl_pct"),
        rnd(F.try_divide(F.sum("_total"), n), 4).alias("avg_pnl_pct"),
        rnd(F.max("_best"), 4).alias("best_trade_pct"),
        rnd(F.min("_worst"), 4).alias("worst_trade_pct"),
        rnd(F.abs(F.try_divide(avg_win, avg_loss)), 3).alias("profit_factor"),
        rnd(F.try_divide(F.sum("_hold"), n) / 1000, 1).alias("avg_hold_sec"),
        rnd(F.try_divide(F.sum("_latency"), n), 1).alias("avg_entry_latency_ms"),
        winners.alias("winners"),
        losers.alias("losers"),
        F.when(n > 0, rnd(F.max("_fall"), 4)).alias("max_drawdown_pct"),
    )


def verdict_of(win_rate: Column, pnl: Column) -> Column:
    """Short verdict: edge, positive PnL, or none."""
    return (
        F.when((win_rate >= 55) & (pnl > 0), F.lit("EDGE"))
        .when(pnl > 0, F.lit("POSITIVE_PNL"))
        .otherwise(F.lit("NO_EDGE"))
    )


def report_verdict_of(win_rate: Column, pnl: Column) -> Column:
    """Verdict of the full report: also tells fees that eat a good win rate, and no trades."""
    return (
        F.when(win_rate.isNull(), F.lit("NO_TRADES"))
        .when((win_rate >= 55) & (pnl > 0), F.lit("EDGE"))
        .when(pnl > 0, F.lit("POSITIVE_PNL"))
        .when(win_rate >= 50, F.lit("FEES_EAT_PNL"))
        .otherwise(F.lit("NO_EDGE"))
    )


def backtest_verdict(stats: DataFrame) -> DataFrame:
    wr, pnl = F.col("win_rate_pct"), F.col("total_pnl_pct")
    return stats.select(
        "symbol", "win_rate_pct", "total_pnl_pct",
        verdict_of(wr, pnl).alias("verdict"), report_verdict_of(wr, pnl).alias("report_verdict"),
    )


def mean_reversion_sweep(
    ticks: DataFrame, holds: Sequence[int] = (5, 10, 20, 30, 60), z: float = 2.0, min_pct: float = 0.01, fee: float = FEE
) -> DataFrame:
    """Trade against each spike for several holding times; one as-of pass for all of them."""
    trades = follow_trades(_entries(ticks, (z,), min_pct), ticks, holds, fee, reverse=True)
    return trade_stats(trades, ("symbol", "hold"))


def backtest_by_class(ticks: DataFrame, holds: Sequence[int] = (5, 10, 30), fee: float = FEE) -> DataFrame:
    """ABSORPTION spikes traded against, NOISE spikes traded along as the control."""
    spikes = classified_spikes(ticks).filter(F.col("spike_class").isin("ABSORPTION", "NOISE"))
    flipped = F.when(F.col("direction") == "down", F.lit("up")).otherwise(F.lit("down"))
    spikes = spikes.withColumn(
        "direction", F.when(F.col("spike_class") == "ABSORPTION", flipped).otherwise(F.col("direction"))
    ).select(
        "symbol", "id", "event_time_ms", "price", "pct", "direction", "spike_class",
        (F.col("ingest_time_ms") - F.col("event_time_ms")).alias("latency_ms"),
    )
    return trade_stats(follow_trades(spikes, ticks, holds, fee), ("symbol", "spike_class", "hold"))


def grid_search(
    ticks: DataFrame,
    holds: Sequence[int] = (5, 10, 20, 60),
    zs: Sequence[float] = (1.5, 2.0, 2.5, 3.0),
    min_pct: float = 0.01,
    fee: float = FEE,
) -> DataFrame:
    """All (hold, z) pairs in one job; `best` marks the highest PnL per symbol."""
    trades = follow_trades(_entries(ticks, zs, min_pct), ticks, holds, fee)
    stats = trade_stats(trades, ("symbol", "hold", "z"))
    order = Window.partitionBy("symbol").orderBy(F.col("total_pnl_pct").desc(), "hold", "z")
    return stats.select(
        "symbol", "hold", "z", "total_trades", "win_rate_pct", "total_pnl_pct", "max_drawdown_pct",
        (F.row_number().over(order) == 1).alias("best"),
    )


def exec_cost_win_rate(
    ticks: DataFrame, min_pct: float = 0.005, first: int = 200, horizon_ms: int = 10_000, cost: float = 0.00041
) -> DataFrame:
    """Reversal wins after execution cost, over the first `first` real moves per symbol.

    The exit is looked up from the previous tick's time on.
    """
    moves = first_fixed_moves(ticks, min_pct, first).select(
        "symbol", "id", "price", "prev_price", (F.col("prev_event_time_ms") + horizon_ms).alias("target_ms")
    )
    net = F.col("price") - F.col("found_price") - F.col("prev_price") * cost
    return (
        asof_forward(moves, ticks, offsets=(horizon_ms,))
        .filter(F.col("found_price").isNotNull())
        .groupBy("symbol")
        .agg(F.count_if(net > 0).alias("wins"), F.count(F.lit(1)).alias("total"))
        .withColumn("win_rate", share(F.col("wins"), F.col("total")))
    )


def backtest_report(
    ticks: DataFrame, hold: int = 30, z: float = 2.0, min_spike: float = 0.01, fee: float = FEE, min_events: int = 20,
    symbol: str | None = None, limit: int | None = None, save: str | None = None, run_time: str | None = None,
) -> DataFrame:
    """One row per symbol: parameters, statistics and verdict. Symbols below `min_events` ticks have none.

    `symbol` runs one symbol, `limit` the oldest ticks of each; `save` appends the run, stamped with
    `run_time`, to the results table in that folder.
    """
    checked = [("hold", hold, 5, 300), ("z", z, 1.0, 5.0), ("min_spike", min_spike, 0.001, 1.0)]
    if limit is not None:
        checked.append(("limit", limit, 100, 50_000))
    for name, value, low, high in checked:
        if not low <= value <= high:
            raise ValueError(f"{name} must be within {low}..{high}")
    if save is not None and run_time is None:
        raise ValueError("a saved run needs its run_time")
    if symbol is not None:
        ticks = ticks.filter(F.col("symbol") == symbol.upper())
    if limit is not None:
        ticks = with_rank(ticks).filter(F.col("_rn") <= limit).drop("_rn", "_n")
    entries = _entries(ticks, (z,), min_spike)
    loaded = ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("events_loaded")).filter(
        F.col("events_loaded") >= min_events
    )
    stats = trade_stats(follow_trades(entries, ticks, (hold,), fee, keep_open=True))
    report = loaded.join(stats, "symbol", "left").select(
        "symbol", "events_loaded",
        F.coalesce("entries", F.lit(0)).alias("spikes_detected"),
        F.coalesce("total_trades", F.lit(0)).alias("trades_executed"),
        "win_rate_pct", "total_pnl_pct", "avg_pnl_pct", "best_trade_pct", "worst_trade_pct",
        "max_drawdown_pct", "profit_factor", "avg_hold_sec", "avg_entry_latency_ms",
        report_verdict_of(F.col("win_rate_pct"), F.col("total_pnl_pct")).alias("verdict"),
    )
    if save is not None:
        append_rows(result_rows(report, run_time, hold, z, min_spike), save)
    return report


def result_rows(report: DataFrame, run_time: str, hold: int, z: float, min_spike: float) -> DataFrame:
    """Report rows in the shape of the results table: parameters and statistics as JSON text."""
    stats = [c for c in report.columns if c not in ("symbol", "events_loaded", "spikes_detected", "verdict")]
    return report.select(
        "symbol",
        F.lit(run_time).alias("run_time"),
        F.to_json(F.struct(
            "symbol", "events_loaded", "spikes_detected", F.lit(hold).alias("hold_seconds"),
            F.lit(z).alias("z_threshold"), F.lit(min_spike).alias("min_spike_pct"),
        )).alias("params"),
        F.to_json(F.struct(*stats), {"ignoreNullFields": "false"}).alias("stats"),
    )
