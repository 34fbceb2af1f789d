"""Percentile profiles, size buckets, edges, streaks, confidence: the enriched event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import config
from tickloom.functions.ranks import nearest_ranks
from tickloom.functions.scalars import rnd, size_bucket
from tickloom.operators.candles import body_pct, candles
from tickloom.operators.layout import (
    UNTIL_NOW,
    attach_per_symbol,
    chunk_window,
    newest_per_symbol,
    rank_chunks,
    with_rank,
)

PROFILE_PROBS = {"p75": 0.75, "p90": 0.90, "p99": 0.99}
LOOKBACK_MS = 7_200_000


def pct_profile(
    ticks: DataFrame, now_ms=None, lookback_ms: int = LOOKBACK_MS, min_ticks: int = 100, min_candles: int = 20
) -> DataFrame:
    """Per symbol: p75/p90/p99, mean, population deviation and count of 1-second candle moves.

    Symbols with fewer than `min_ticks` ticks or `min_candles` candles have no row.
    `now_ms` bounds the look-back; None takes the whole table.
    """
    rows = ticks
    if now_ms is not None:
        now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
        rows = ticks.filter(F.col("event_time_ms") >= now - lookback_ms)
    return profile_of_candles(candles(rows), min_ticks, min_candles)


def profile_of_candles(rows: DataFrame, min_ticks: int = 100, min_candles: int = 20) -> DataFrame:
    """The profile of 1-second candles (symbol, open, close, trades)."""
    # candles with open <= 0 have no move but their ticks count towards min_ticks
    moves = rows.select(
        "symbol", "trades", F.when(F.col("open") > 0, F.abs(body_pct())).alias("move")
    )
    ranks = nearest_ranks(moves, ["symbol"], "move", PROFILE_PROBS)
    shape = moves.groupBy("symbol").agg(
        F.sum("trades").alias("ticks"), F.avg("move").alias("mean"), F.stddev_pop("move").alias("std")
    )
    return (
        ranks.join(shape, "symbol")
        .filter((F.col("ticks") >= min_ticks) & (F.col("n") >= min_candles))
        .select("symbol", "p75", "p90", "p99", "mean", "std", "n")
    )


def edge_rows(edge_map: Sequence[tuple] = tuple(config.EDGE_MAP)) -> dict[tuple, tuple]:
    return {(s, b): (signal, rev, cont) for s, b, signal, rev, cont in edge_map}


def edge_lookup(symbol: Column, bucket: Column, edge_map: Sequence[tuple] = tuple(config.EDGE_MAP)) -> Column:
    """struct(signal, prob_reversal, prob_continuation) of a fixed edge map; NO_EDGE when absent."""

    def entry(signal, rev, cont):
        return F.struct(
            F.lit(signal).alias("signal"), F.lit(rev).alias("prob_reversal"), F.lit(cont).alias("prob_continuation")
        )

    out = None
    for (s, b), values in edge_rows(edge_map).items():
        hit = (symbol == s) & (bucket == b)
        out = F.when(hit, entry(*values)) if out is None else out.when(hit, entry(*values))
    return out.otherwise(entry("NO_EDGE", 0.5, 0.5))


def edges_per_symbol(edges: DataFrame) -> DataFrame:
    """A measured edge table (symbol, bucket, signal, prob_reversal, prob_continuation) as one map per symbol.

    At most four buckets per symbol; it travels with the symbol's profile, so the
    ticks need no join of their own for it.
    """
    entry = F.struct("bucket", F.struct("signal", "prob_reversal", "prob_continuation"))
    return edges.groupBy("symbol").agg(F.map_from_entries(F.collect_list(entry)).alias("_edges"))


def confidence(bucket: Column, streak: Column) -> Column:
    """round(min(base + min((streak-1)*step, max bonus), 1), 3)."""
    bonus = F.least((streak - 1) * F.lit(config.STREAK_STEP), F.lit(config.STREAK_BONUS_MAX))
    base = config.keyed_case(bucket, config.BASE_CONFIDENCE, config.BASE_CONFIDENCE["SMALL"])
    return rnd(F.least(base + bonus, F.lit(1.0)), 3)


RUN_STATE = "symbol string, price double, signal string, streak bigint"


def _runs(known: DataFrame, before: DataFrame | None) -> DataFrame:
    """(symbol, _chunk, _run): the run of signals that reaches the end of each chunk, however long it is.

    One row a chunk says which run its last rated row belongs to and whether all its
    rated rows are that run. Where they are and the chunk before ended on the same signal,
    the run goes on; running totals between such breaks give its length. `before`
    (RUN_STATE) counts as the chunk before the first.
    """
    rated = known.filter(F.col("_home") & F.col("_rated"))
    ends = rated.groupBy("symbol", "_chunk").agg(
        F.max_by("signal", "_pos").alias("signal"), F.max_by("_len", "_pos").alias("_len"), F.count(F.lit(1)).alias("_cnt"),
    )
    if before is not None:
        ends = ends.unionByName(before.filter(F.col("signal").isNotNull()).select(
            "symbol", F.lit(-1).cast("bigint").alias("_chunk"), "signal", F.col("streak").alias("_len"),
            F.lit(None).cast("bigint").alias("_cnt")))
    w = Window.partitionBy("symbol").orderBy("_chunk")
    goes_on = (F.col("_len") == F.col("_cnt")) & (F.col("signal") == F.lag("signal").over(w))
    island = F.sum(F.coalesce((~goes_on).cast("int"), F.lit(1))).over(w.rowsBetween(*UNTIL_NOW))
    whole = Window.partitionBy("symbol", "_island").orderBy("_chunk").rowsBetween(*UNTIL_NOW)
    return ends.withColumn("_island", island).select(
        "symbol", "_chunk", F.struct("signal", F.sum("_len").over(whole).alias("streak")).alias("_run"))


def enriched_events(
    ticks: DataFrame,
    profile: DataFrame | None = None,
    descending: bool = False,
    edge_map: Sequence[tuple] = tuple(config.EDGE_MAP),
    edges: DataFrame | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Every tick with its change and what that change means.

    Adds spike_pct, bucket, signal, prob_reversal, prob_continuation, streak,
    confidence, zscore, regime_n and classification. The first tick of a symbol, and
    symbols without a profile, have signal NO_DATA. With `descending`, rows are
    walked from the newest to the oldest, each compared with the newer one.

    Two exchanges of the ticks: one to number them, one into even chunks; the
    profile look-up reuses the latter's partitioning, so a hot symbol is never in
    one task. Runs of a signal are counted inside the chunks and carried from chunk to
    chunk. `before` (RUN_STATE, a row for each symbol) goes on from earlier ticks.
    """
    return _enriched(ticks, profile, descending, edge_map, edges, before)[0]


def continued(
    ticks: DataFrame, profile: DataFrame, before: DataFrame, edge_map: Sequence[tuple] = tuple(config.EDGE_MAP)
) -> tuple[DataFrame, DataFrame]:
    """`enriched_events` that goes on from `before`, and the RUN_STATE after these ticks."""
    rows, runs, ranked = _enriched(ticks, profile, False, edge_map, None, before)
    last = ranked.groupBy("symbol").agg(F.max_by("price", "_rn").alias("_price"))
    run = runs.groupBy("symbol").agg(F.max_by("_run", "_chunk").alias("_run"))
    old = before.withColumnRenamed("price", "_old").select("symbol", "_old")
    after = last.join(run, "symbol", "full").join(old, "symbol", "full").select(
        "symbol", F.coalesce("_price", "_old").alias("price"), "_run.signal", "_run.streak")
    return rows, after


def _enriched(ticks, profile, descending, edge_map, edges, before) -> tuple[DataFrame, DataFrame, DataFrame]:
    if profile is None:
        profile = pct_profile(ticks)
    ranked = with_rank(ticks, descending=descending)
    chunked = rank_chunks(ranked, before=1)
    w = chunk_window("_rn")
    moved = chunked.withColumn("prev_price", F.lag("price").over(w))
    if before is not None:
        first = before.select("symbol", F.col("price").alias("_before"))
        profile = profile.join(first, "symbol", "full")
    if edges is not None:
        profile = profile.join(edges_per_symbol(edges), "symbol", "left")
    known = attach_per_symbol(moved, profile, ticks, "left")
    if before is not None:
        known = known.withColumn("prev_price", F.when(F.col("_rn") == 1, F.col("_before")).otherwise(F.col("prev_price")))
    change = F.try_divide(F.col("price") - F.col("prev_price"), F.col("prev_price")) * F.lit(100.0)
    has_prev = F.col("prev_price") > 0
    known = known.withColumn("change_pct", F.when(has_prev, change)).withColumn(
        "_rated", F.col("_home") & F.coalesce(has_prev, F.lit(False)) & F.col("price").isNotNull() & F.col("p75").isNotNull()
    )
    size = F.abs(F.col("change_pct"))
    known = known.withColumn(
        "bucket", F.when(F.col("_rated"), size_bucket(size, F.col("p75"), F.col("p90"), F.col("p99")))
    )
    if edges is None:
        found = edge_lookup(F.col("symbol"), F.col("bucket"), edge_map)
    else:
        found = F.try_element_at("_edges", F.col("bucket"))
    known = known.withColumn("_edge", found).withColumns({
        "signal": F.coalesce("_edge.signal", F.lit("NO_EDGE")),
        "prob_reversal": F.coalesce("_edge.prob_reversal", F.lit(0.5)),
        "prob_continuation": F.coalesce("_edge.prob_continuation", F.lit(0.5)),
    })
    run = Window.partitionBy("symbol", "_chunk", "_rated").orderBy("_rn")
    starts = F.when(F.col("signal").eqNullSafe(F.lag("signal").over(run)), F.lit(None)).otherwise(F.col("_pos"))
    known = (
        known.withColumn("_pos", F.row_number().over(run))
        .withColumn("_start", starts)
        .withColumn("_start", F.last("_start", ignorenulls=True).over(run))
        .withColumn("_len", (F.col("_pos") - F.col("_start") + 1).cast("bigint"))
    )
    runs = _runs(known, before)
    each = Window.partitionBy("symbol").orderBy("_chunk")
    carried = runs.select("symbol", "_chunk", F.lag("_run").over(each).alias("_carry"))
    known = known.join(carried, ["symbol", "_chunk"], "left")
    goes_on = (F.col("_start") == 1) & (F.col("signal") == F.col("_carry.signal"))
    length = F.col("_len") + F.when(goes_on, F.col("_carry.streak")).otherwise(F.lit(0))
    known = known.withColumn("streak", F.least(length, F.lit(config.STREAK_CAP)))
    rated = F.col("_rated")
    spike = F.when(F.coalesce(has_prev, F.lit(False)), F.col("change_pct")).otherwise(F.lit(0.0))
    z = F.when(
        F.col("std") > 0, rnd((size - F.col("mean")) / F.col("std"), 3)
    ).otherwise(F.lit(0.0))
    label = F.when(F.col("signal") == "NO_EDGE", F.lit("NOISE")).otherwise(F.col("signal"))
    keep = [c for c in ticks.columns]
    out = known.filter("_home").select(
        *keep,
        "_rn",
        "_n",
        rnd(spike, 6).alias("spike_pct"),
        F.when(rated, F.col("signal")).otherwise(F.lit("NO_DATA")).alias("signal"),
        F.when(rated, F.concat_ws("_", label, F.col("bucket"))).otherwise(F.lit("UNKNOWN")).alias("classification"),
        "bucket",
        F.when(rated, F.col("prob_reversal")).otherwise(F.lit(0.5)).alias("prob_reversal"),
        F.when(rated, F.col("prob_continuation")).otherwise(F.lit(0.5)).alias("prob_continuation"),
        F.when(rated, F.col("streak")).cast("bigint").alias("streak"),
        F.when(rated, confidence(F.col("bucket"), F.col("streak"))).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(rated, z).alias("zscore"),
        F.when(rated, F.col("n")).alias("regime_n"),
    )
    return out, runs, ranked


INTELLIGENCE = [
    "signal", "classification", "bucket", "prob_reversal", "prob_continuation", "confidence", "zscore", "regime_n",
]


def with_intelligence(enriched: DataFrame) -> DataFrame:
    """The enriched columns folded into one struct, the shape the event feed serves."""
    rest = [c for c in enriched.columns if c not in INTELLIGENCE]
    return enriched.select(*rest, F.struct(*INTELLIGENCE).alias("intelligence"))


def is_real(signal: Column) -> Column:
    return ~signal.isin("NO_DATA", "NO_EDGE")


def record_signals(enriched: DataFrame, min_confidence: float = config.RECORD_MIN_CONFIDENCE) -> DataFrame:
    """Outcome rows, still PENDING, for confident signals; one per (symbol, event id)."""
    gate = (
        (F.col("confidence") >= min_confidence)
        & F.col("bucket").isin(*config.RECORD_BUCKETS)
        & is_real(F.col("signal"))
    )
    pending = F.lit("PENDING")
    none = F.lit(None).cast("double")
    return enriched.filter(gate).select(
        "id", "symbol", "signal", "bucket", "confidence", F.col("price").alias("price_entry"), "event_time_ms",
        none.alias("price_10s"), none.alias("price_30s"),
        pending.alias("result_10s"), pending.alias("result_30s"),
    )


def new_signals(recorded: DataFrame, stored: DataFrame) -> DataFrame:
    """Recorded signals that the outcome table does not hold yet."""
    return recorded.join(stored.select("symbol", "id"), ["symbol", "id"], "left_anti")


def signals_filtered(
    enriched: DataFrame, min_confidence: float = 0.60, limit: int = 50, fetch: int = 500
) -> DataFrame:
    """Among the newest `fetch` ticks of a symbol: the newest `limit` confident real signals."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be within 1..200")
    if {"_rn", "_n"} <= set(enriched.columns):  # numbered already, from the oldest
        newest = enriched.filter(F.col("_n") - F.col("_rn") < fetch)
    else:
        newest = newest_per_symbol(enriched, fetch).drop("_pos")
    confident = newest.filter((F.col("confidence") >= min_confidence) & is_real(F.col("signal")))
    return newest_per_symbol(confident, limit)


def signal_counts(enriched: DataFrame, now_ms, window_ms: int = 300_000) -> DataFrame:
    """Reversal, continuation and no-edge counts per symbol over the last `window_ms`."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    recent = enriched.filter(now - F.col("event_time_ms") < window_ms)
    return recent.groupBy("symbol").agg(
        F.count_if(F.col("signal") == "REV_EDGE").alias("rev"),
        F.count_if(F.col("signal") == "CONT_EDGE").alias("cont"),
        F.count_if(F.col("signal") == "NO_EDGE").alias("no_edge"),
    )


def edge_signal_v1(
    enriched: DataFrame, edge_map: Sequence[tuple] = tuple(config.EDGE_MAP_V1), strong: float = 0.60
) -> DataFrame:
    """First edition of the look-up: the label is stored, the signal follows from the probabilities."""
    edge = edge_lookup(F.col("symbol"), F.col("bucket"), [(s, b, label, r, c) for s, b, label, r, c in edge_map])
    found = enriched.filter(F.col("bucket").isNotNull()).withColumn("_e", edge)
    rev, cont = F.col("_e.prob_reversal"), F.col("_e.prob_continuation")
    label = F.when(F.col("_e.signal") == "NO_EDGE", F.lit("NOISE")).otherwise(F.col("_e.signal"))
    return found.select(
        "id", "symbol", "bucket",
        F.concat_ws("_", F.col("bucket"), label).alias("classification"),
        rev.alias("prob_reversal"), cont.alias("prob_continuation"),
        F.when(rev > strong, F.lit("REV_EDGE")).when(cont > strong, F.lit("CONT_EDGE"))
        .otherwise(F.lit("NO_EDGE")).alias("signal"),
    )


def latest_enriched(ticks: DataFrame, profile: DataFrame, last: int = 500, **options) -> DataFrame:
    """The newest `last` ticks per symbol, enriched. A streak may reach back any distance, so all ticks are read."""
    rows = enriched_events(ticks, profile, **options)
    first = F.col("_rn") if options.get("descending") else F.col("_n") - F.col("_rn") + 1
    return rows.filter(first <= last)


def recent_profile(ticks: DataFrame, last: int = 10_000, min_candles: int = 20) -> DataFrame:
    """The percentile profile of the newest `last` ticks per symbol."""
    recent = with_rank(ticks, descending=True).filter(F.col("_rn") <= last).drop("_rn", "_n")
    return pct_profile(recent, min_ticks=0, min_candles=min_candles)
