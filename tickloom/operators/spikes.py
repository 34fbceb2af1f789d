"""Spike detection and what happens after a spike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.ranks import nearest_ranks
from tickloom.functions.scalars import pct_change, pct_move, rnd, share
from tickloom.operators.candles import body_pct, candle_moves, candles
from tickloom.operators.layout import (
    TICK,
    attach_per_symbol,
    chunk_window,
    oldest_per_symbol,
    per_symbol_to_rank_chunks,
    rank_chunks,
    with_previous,
    with_rank,
)

FLAT_PCT = 0.005
LOOKAHEAD = 10


def spike_frame(
    ticks: DataFrame,
    zs: Sequence[float] = (2.0,),
    min_pct: float = 0.01,
    min_events: int = 10,
    leads: Sequence[int] = (),
    volume_rows: int = 0,
) -> DataFrame:
    """Spikes: |price change| > mean + z * population deviation of the symbol, and >= min_pct.

    One row per spike and z, with direction, and on request the price n ticks later
    (`price_<n>`) and the volume of the spike's and the following ticks. Nothing
    for symbols with fewer than `min_events` ticks.
    """
    after = max([0, *leads, volume_rows - 1])
    chunked = rank_chunks(with_rank(ticks), before=1, after=after)
    w = chunk_window("_rn")
    moved = chunked.withColumn("prev_price", F.lag("price").over(w))
    for n in leads:
        moved = moved.withColumn(f"price_{n}", F.lead("price", n).over(w))
    if volume_rows:
        moved = moved.withColumn("volume_after", F.sum("quantity").over(w.rowsBetween(0, volume_rows - 1)))
    moved = moved.filter("_home").withColumn("diff", F.col("price") - F.col("prev_price"))
    step = F.abs(F.col("price") - F.col("prev_price"))
    stats = (
        with_previous(ticks, keep=TICK)
        .groupBy("symbol")
        .agg(F.avg(step).alias("_avg"), F.stddev_pop(step).alias("_std"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_events)
    )
    spread = per_symbol_to_rank_chunks(stats).drop("_n")
    over = lambda z: F.abs("diff") > F.col("_avg") + z * F.col("_std")
    found = moved.join(spread, ["symbol", "_chunk"], "inner").withColumn("pct", pct_move(F.col("price"), F.col("prev_price")))
    found = found.filter(over(F.lit(float(min(zs)))) & (F.col("pct") >= min_pct))  # few rows are left to repeat for each z
    found = found.withColumn("z", F.explode(F.array(*[F.lit(float(z)) for z in zs]))).filter(over(F.col("z")))
    return found.withColumn("direction", F.when(F.col("diff") > 0, F.lit("up")).otherwise(F.lit("down"))).drop(
        "_avg", "_std", "_home", "_chunk"
    )


def detect_spikes(ticks: DataFrame, z: float = 2.0, min_pct: float = 0.01) -> DataFrame:
    spikes = spike_frame(ticks, (z,), min_pct)
    return spikes.select(
        "symbol", "id", (F.col("_rn") - 1).alias("idx"), F.col("event_time_ms").alias("time_ms"),
        "price", "prev_price", rnd(F.col("diff"), 6).alias("diff"), rnd(F.col("pct"), 6).alias("pct"),
        "direction", (F.col("ingest_time_ms") - F.col("event_time_ms")).alias("latency_ms"),
    )


def detect_spikes_ui(sampled: DataFrame, floor: float = 0.05, min_pct: float = 0.01) -> DataFrame:
    """Spikes of a down-sampled chart series (at most about 400 points per symbol).

    Threshold: max(mean + 2 sd, 2 mean, floor); needs 3 points.
    """
    w = Window.partitionBy("symbol").orderBy("event_time_ms", "id")
    whole = Window.partitionBy("symbol")
    moved = (
        sampled.withColumn("prev_price", F.lag("price").over(w))
        .withColumn("diff", F.abs(F.col("price") - F.col("prev_price")))
        .withColumn("_avg", F.avg("diff").over(whole))
        .withColumn("_std", F.stddev_pop("diff").over(whole))
        .withColumn("_points", F.count(F.lit(1)).over(whole))
        .withColumn("pct", pct_move(F.col("price"), F.col("prev_price")))
    )
    threshold = F.greatest(F.col("_avg") + 2 * F.col("_std"), 2 * F.col("_avg"), F.lit(floor))
    return moved.filter(
        (F.col("_points") >= 3) & (F.col("diff") > threshold) & (F.col("pct") > min_pct)
    ).select(
        "symbol", "id", "idx", "price", rnd(F.col("diff"), 6).alias("diff"), rnd(F.col("pct"), 6).alias("pct"),
        F.col("event_time_ms").alias("time_ms"),
        F.abs(F.col("ingest_time_ms") - F.col("event_time_ms")).alias("latency"),
    )


def fixed_moves(ticks: DataFrame, min_pct: float = 0.005) -> DataFrame:
    """Moves of at least `min_pct` percent, with the previous tick's price and time."""
    moved = with_previous(ticks, ("price", "event_time_ms"), keep=TICK)
    return moved.filter(F.col("prev_price") > 0).withColumn(
        "move_pct", pct_move(F.col("price"), F.col("prev_price"))
    ).filter(F.col("move_pct") >= min_pct)


def first_fixed_moves(ticks: DataFrame, min_pct: float = 0.005, first: int = 200) -> DataFrame:
    return oldest_per_symbol(fixed_moves(ticks, min_pct), first)


def spike_follow_through(ticks: DataFrame, z: float = 2.0, min_pct: float = 0.01, ahead: int = 5) -> DataFrame:
    """Shares of spikes that continued, reverted or stayed flat after `ahead` ticks."""
    spikes = spike_frame(ticks, (z,), min_pct, leads=(ahead, 2 * ahead)).filter(
        F.col(f"price_{2 * ahead}").isNotNull()
    )
    move = pct_change(F.col(f"price_{ahead}"), F.col("price"))
    signed = F.when(F.col("direction") == "up", move).otherwise(-move)
    kind = (
        F.when(signed > FLAT_PCT, F.lit("follow")).when(signed < -FLAT_PCT, F.lit("revert")).otherwise(F.lit("neutral"))
    )
    counts = spikes.withColumn("kind", kind).groupBy("symbol").agg(
        F.count_if(F.col("kind") == "follow").alias("follow"),
        F.count_if(F.col("kind") == "revert").alias("revert"),
        F.count_if(F.col("kind") == "neutral").alias("neutral"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "symbol", "follow", "revert", "neutral", "total",
        share(F.col("follow"), F.col("total")).alias("follow_pct"),
        share(F.col("revert"), F.col("total")).alias("revert_pct"),
        share(F.col("neutral"), F.col("total")).alias("neutral_pct"),
    )


def classify_after(move_5: Column, move_30: Column) -> Column:
    """NOISE / MOMENTUM / ABSORPTION from the moves 5 and 30 ticks after a spike."""
    return (
        F.when(F.abs(move_30) < 0.005, F.lit("NOISE"))
        .when((F.abs(move_5) > 0.01) & (F.abs(move_30) > F.abs(move_5) * 0.5), F.lit("MOMENTUM"))
        .otherwise(F.lit("ABSORPTION"))
    )


def classified_spikes(ticks: DataFrame, z: float = 2.0, min_pct: float = 0.01) -> DataFrame:
    """Spikes with 30 later ticks, their class, and the volume of the 5 ticks from the spike on."""
    spikes = spike_frame(ticks, (z,), min_pct, leads=(5, 30), volume_rows=5).filter(F.col("price_30").isNotNull())
    return (
        spikes.withColumn("move_5", pct_change(F.col("price_5"), F.col("price")))
        .withColumn("move_30", pct_change(F.col("price_30"), F.col("price")))
        .withColumn("spike_class", classify_after(F.col("move_5"), F.col("move_30")))
    )


def spike_class(ticks: DataFrame) -> DataFrame:
    return classified_spikes(ticks).select(
        "symbol", "id", "spike_class", rnd(F.col("pct"), 6).alias("pct"),
        rnd(F.col("move_5"), 6).alias("move_5"), rnd(F.col("move_30"), 6).alias("move_30"),
        rnd(F.col("volume_after"), 6).alias("volume"),
    )


def spike_class_shares(ticks: DataFrame) -> DataFrame:
    """Count and share of each post-spike class per symbol."""
    counts = classified_spikes(ticks).groupBy("symbol", "spike_class").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("symbol"))
    return counts.select("symbol", "spike_class", "n", share(F.col("n"), whole).alias("pct"))


CANDLE_SLOT_MS = 3_600_000


def chunked_candles(candle_rows: DataFrame, after: int = LOOKAHEAD) -> DataFrame:
    """Candles in even chunks, with `after` following candles at hand; `_rn`, `_n` count candles."""
    return rank_chunks(with_rank(candle_rows, order=("time_ms",), slot_ms=CANDLE_SLOT_MS, even=True), after=after)


def candle_class_of(body: Column, after: Column) -> Column:
    return (
        F.when(F.abs(body) < 0.005, F.lit("FLAT"))
        .when((body > 0) & (after > 0.003), F.lit("MOMENTUM_UP"))
        .when((body < 0) & (after < -0.003), F.lit("MOMENTUM_DOWN"))
        .when((body > 0) & (after < -0.003), F.lit("REVERSAL_DOWN"))
        .when((body < 0) & (after > 0.003), F.lit("REVERSAL_UP"))
        .otherwise(F.lit("NOISE"))
    )


def candle_class(ticks: DataFrame, lookahead: int = LOOKAHEAD) -> DataFrame:
    """Class of each 1-second candle from its body and the close `lookahead` candles on."""
    w = chunk_window("_rn")
    rows = (
        chunked_candles(candles(ticks), lookahead)
        .withColumn("next_open", F.lead("open", 1).over(w))
        .withColumn("close_ahead", F.lead("close", lookahead).over(w))
        .filter(F.col("_home") & F.col("close_ahead").isNotNull())
        .withColumn("body", body_pct())
        .withColumn("after", pct_change(F.col("close_ahead"), F.col("close")))
    )
    return rows.withColumn("candle_class", candle_class_of(F.col("body"), F.col("after")))


def candle_class_pnl(ticks: DataFrame, lookahead: int = LOOKAHEAD, skip_last: int = 20, cost: float = 0.02) -> DataFrame:
    """Trade each class: long after UP, short after DOWN, from the next open to the close ahead."""
    rows = candle_class(ticks, lookahead).filter(F.col("_rn") <= F.col("_n") - skip_last)
    gain = pct_change(F.col("close_ahead"), F.col("next_open"))
    pnl = (
        F.when(F.col("candle_class").endswith("_UP"), gain - cost)
        .when(F.col("candle_class").endswith("_DOWN"), -gain - cost)
    )
    return rows.withColumn("pnl", pnl).groupBy("symbol", "candle_class").agg(
        F.count(F.lit(1)).alias("n"),
        share(F.sum(F.when(F.col("pnl") > 0, 1).when(F.col("pnl").isNotNull(), 0)), F.count("pnl")).alias("win_rate"),
        rnd(F.sum("pnl"), 4).alias("total_pnl"),
        rnd(F.avg("pnl"), 4).alias("avg_pnl"),
    )


def _reverts(body: Column, after: Column, bar: Column) -> Column:
    return ((body > 0) & (after < -bar)) | ((body < 0) & (after > bar))


def _continues(body: Column, after: Column, bar: Column) -> Column:
    return ((body > 0) & (after > bar)) | ((body < 0) & (after < -bar))


def edge_table(ticks: DataFrame, lookahead: int = LOOKAHEAD, min_moves: int = 50) -> DataFrame:
    """Measured reversal/continuation rates per symbol and percentile bucket of candle moves."""
    all_candles = candles(ticks)
    base = candle_moves(all_candles).filter(F.col("close") > 0)
    probs = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}
    levels = nearest_ranks(base, ["symbol"], "move", probs).filter(F.col("n") >= min_moves).drop("n")
    w = chunk_window("_rn")
    rows = (
        attach_per_symbol(chunked_candles(all_candles, lookahead), levels, all_candles, time="time_ms", slot_ms=CANDLE_SLOT_MS, even=True)
        .withColumn("close_ahead", F.lead("close", lookahead).over(w))
        .filter(F.col("_home") & F.col("close_ahead").isNotNull() & (F.col("open") > 0))
        .withColumn("body", body_pct())
        .withColumn("after", pct_change(F.col("close_ahead"), F.col("close")))
    )
    m, bar = F.abs("body"), F.col("p50") * 0.5
    bucket = (
        F.when((m >= F.col("p50")) & (m < F.col("p75")), F.lit("SMALL"))
        .when((m >= F.col("p75")) & (m < F.col("p90")), F.lit("MEDIUM"))
        .when((m >= F.col("p90")) & (m < F.col("p99")), F.lit("LARGE"))
        .when((m >= F.col("p99")) & (m < 999), F.lit("EXTREME"))
    )
    counts = (
        rows.withColumn("bucket", bucket).filter(F.col("bucket").isNotNull())
        .groupBy("symbol", "bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(_reverts(F.col("body"), F.col("after"), bar)).alias("rev"),
            F.count_if(_continues(F.col("body"), F.col("after"), bar)).alias("cont"),
            F.avg("after").alias("avg_after"),
        )
    )
    directional = F.col("rev") + F.col("cont")
    table = counts.withColumns({
        "rev_pct": F.coalesce(share(F.col("rev"), directional), F.lit(0.0)),
        "cont_pct": F.coalesce(share(F.col("cont"), directional), F.lit(0.0)),
        "avg_after": rnd(F.col("avg_after"), 5),
    })
    edge = (
        F.when(directional < 5, F.lit("INSUF"))
        .when(F.col("rev_pct") > 60, F.lit("REV_EDGE"))
        .when(F.col("cont_pct") > 60, F.lit("CONT_EDGE"))
        .otherwise(F.lit("NO_EDGE"))
    )
    return table.withColumn("edge", edge)


def edge_map_calibrated(ticks: DataFrame) -> DataFrame:
    """The measured edges as a look-up table for the enrichment."""
    return (
        edge_table(ticks)
        .filter(F.col("edge").isin("REV_EDGE", "CONT_EDGE"))
        .select(
            "symbol", "bucket", F.col("edge").alias("signal"),
            rnd(F.col("rev_pct") / 100, 2).alias("prob_reversal"),
            rnd(F.col("cont_pct") / 100, 2).alias("prob_continuation"),
        )
    )


def symbol_profile(ticks: DataFrame, lookahead: int = LOOKAHEAD, min_candles: int = 20) -> DataFrame:
    """Candle statistics per symbol: flat and spike shares, reversal rate, move and volume."""
    all_candles = candles(ticks)
    base = candle_moves(all_candles)
    levels = (
        nearest_ranks(base, ["symbol"], "move", {"thr": 0.99})
        .filter(F.col("n") >= min_candles)
        .select("symbol", "thr")
    )
    w = chunk_window("_rn")
    rows = (
        attach_per_symbol(chunked_candles(all_candles, lookahead), levels, all_candles, time="time_ms", slot_ms=CANDLE_SLOT_MS, even=True)
        .withColumn("close_ahead", F.lead("close", lookahead).over(w))
        .filter(F.col("_home") & (F.col("open") > 0))
        .withColumn("body", body_pct())
        .withColumn("after", pct_change(F.col("close_ahead"), F.col("close")))
    )
    m, thr = F.abs("body"), F.col("thr")
    bar = thr * 0.3
    spiked = (m >= thr) & F.col("close_ahead").isNotNull()
    aggs = rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("candles"),
        F.max("thr").alias("thr"),
        F.count_if(m < 0.002).alias("_flat"),
        F.count_if(m >= thr).alias("total_spikes"),
        F.count_if(spiked & _reverts(F.col("body"), F.col("after"), bar)).alias("reversals"),
        F.count_if(spiked & _continues(F.col("body"), F.col("after"), bar)).alias("continuations"),
        F.avg(m).alias("_avg"), F.stddev_samp(m).alias("_std"), F.avg("volume").alias("_vol"),
    )
    rev = F.coalesce(
        F.try_divide(F.col("reversals"), F.col("reversals") + F.col("continuations")) * 100.0, F.lit(0.0)
    )
    return aggs.select(
        "symbol", "candles",
        share(F.col("_flat"), F.col("candles")).alias("flat_pct"),
        share(F.col("total_spikes"), F.col("candles")).alias("spike_pct"),
        rnd(F.col("thr"), 4).alias("spike_thresh"),
        rnd(rev, 1).alias("rev_rate"), rnd(F.lit(100.0) - rev, 1).alias("cont_rate"),
        rnd(F.col("_avg"), 5).alias("avg_move"), rnd(F.col("_std"), 5).alias("std_move"),
        rnd(F.col("_vol"), 4).alias("avg_volume"),
        "total_spikes", "reversals", "continuations",
    )


COMPARED = [
    "candles", "flat_pct", "spike_thresh", "spike_pct", "total_spikes", "rev_rate",
    "cont_rate", "avg_move", "std_move", "avg_volume",
]


def symbol_compare(profiles: DataFrame, left: str = "BTCUSDT", right: str = "ETHUSDT") -> DataFrame:
    """One row per metric: both symbols' values, the difference, and the ratio."""
    metrics = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in COMPARED
    ])
    long = profiles.filter(F.col("symbol").isin(left, right)).select("symbol", F.explode(metrics).alias("_m"))
    sides = long.groupBy(F.col("_m.metric").alias("metric")).agg(
        F.max(F.when(F.col("symbol") == left, F.col("_m.value"))).alias("left_value"),
        F.max(F.when(F.col("symbol") == right, F.col("_m.value"))).alias("right_value"),
    )
    return sides.withColumns({
        "difference": rnd(F.col("right_value") - F.col("left_value"), 5),
        "ratio": rnd(F.try_divide(F.col("right_value"), F.col("left_value")), 2),
    })
