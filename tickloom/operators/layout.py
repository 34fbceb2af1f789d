"""How ordered work is spread over tasks.

Ticks have few symbols and many rows, so `partitionBy(symbol)` would put a hot
symbol into one task. Every ordered operator here runs on pieces of a symbol:

* time chunks: the `chunk_ms`-wide slot of the tick's time, with copies of the
  rows a neighbour needs (a time halo), or one carried row where "the previous
  tick, however far" is asked for;
* rank chunks: pieces of equal row count, from an exact per-symbol row number,
  with a halo of rows. They are even whatever the density of the data.

Both are one hash exchange on (symbol, _chunk); windows, local aggregates and
lookups on those keys reuse it. The per-slot tables behind the carries and the
row numbers hold one row per symbol and time slot: they grow with calendar time,
not with the number of ticks.

Slots are a minute wide, but a minute that holds too many ticks of a symbol is cut
into narrower slots (down to a millisecond), so neither a hot symbol nor a hot
minute ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialize

SLOT_MS = 60_000          # slots for carries and row numbers
FRAME_CHUNK_MS = 300_000  # chunks for windows with a time halo
RANK_CHUNK = 8_192        # rows per rank chunk

HOT_ROWS = 1_000_000      # a slot with more rows is cut into narrower ones

TICK = ("id", "symbol", "event_time_ms", "price")

UNTIL_NOW = (Window.unboundedPreceding, Window.currentRow)
BEFORE_NOW = (Window.unboundedPreceding, -1)


def slot_start(time: Column, width_ms: int) -> Column:
    """Start of the `width_ms`-wide slot that holds `time` (integer arithmetic)."""
    return time - F.pmod(time, F.lit(width_ms).cast("bigint"))


def order_key(time: Column, ident: Column, width_ms: int) -> Column:
    """One number that orders rows of a slot by (time, id), for any 64-bit id.

    A decimal keeps `min_by`/`max_by` in hash aggregation, where a struct key would
    force a sort of all rows first.
    """
    offset = F.pmod(time, F.lit(width_ms).cast("bigint")).cast("decimal(13,0)")
    return offset * F.lit(str(10**20)).cast("decimal(21,0)") + ident.cast("decimal(20,0)")


def time_chunks(
    df: DataFrame,
    chunk_ms: int = FRAME_CHUNK_MS,
    before_ms: int = 0,
    after_ms: int = 0,
    time: str = "event_time_ms",
) -> DataFrame:
    """Add `_chunk` and `_home`; copy each row to every chunk whose frames reach it.

    Exact for frames that stay within [t - before_ms, t + after_ms]. Keep only
    `_home` rows after the window functions.
    """
    own = slot_start(F.col(time), chunk_ms)
    if not before_ms and not after_ms:
        return df.withColumn("_chunk", own).withColumn("_home", F.lit(True))
    first = slot_start(F.col(time) - after_ms, chunk_ms)
    last = slot_start(F.col(time) + before_ms, chunk_ms)
    step = F.lit(chunk_ms).cast("bigint")
    return df.withColumn("_chunk", F.explode(F.sequence(first, last, step))).withColumn(
        "_home", F.col("_chunk") == own
    )


#: Answers of `crowded_slots`, the latest KNOWN of them (a stream asks for every micro-batch).
_CROWDED: dict[tuple, DataFrame | None] = {}
KNOWN = 64


def crowded_slots(
    df: DataFrame, time: str = "event_time_ms", slot_ms: int = SLOT_MS, hot_rows: int | None = None
) -> DataFrame | None:
    """(symbol, _wide, _width): slots with too many rows and how wide their pieces shall be, or None.

    When a plan is built, one small job over two columns (rows per symbol and slot, summed
    on the map side) asks whether there is any, and the answer is remembered for the
    session. It only decides how work is spread, never a result. The table itself
    stays in the plan: it is neither collected nor cut off, and Spark chooses how to join it.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    times = df.select("symbol", F.col(time).alias("_t"))
    known = (df.sparkSession.sparkContext.applicationId, times.semanticHash(), slot_ms, hot_rows)
    if known not in _CROWDED:
        counts = times.groupBy("symbol", slot_start(F.col("_t"), slot_ms).alias("_wide")).agg(
            F.count(F.lit(1)).alias("_cnt")
        )
        width = F.greatest(F.floor(F.lit(slot_ms * hot_rows) / F.col("_cnt")).cast("bigint"), F.lit(1).cast("bigint"))
        crowded = counts.filter(F.col("_cnt") > hot_rows).select("symbol", "_wide", width.alias("_width"))
        _CROWDED[known] = None if crowded.isEmpty() else crowded
        while len(_CROWDED) > KNOWN:
            del _CROWDED[next(iter(_CROWDED))]
    return _CROWDED[known]


def crowded_after(hot: DataFrame | None, offsets: Sequence[int], slot_ms: int = SLOT_MS) -> DataFrame | None:
    """Also cut the slots where the crowd turns up again at t + offset (probes made from ticks)."""
    if hot is None or not offsets:
        return hot
    shifts = {0} | {shift for o in offsets for shift in (o - o % slot_ms, o - o % slot_ms + slot_ms)}
    at = F.array(*[F.col("_wide") + F.lit(x).cast("bigint") for x in sorted(shifts)])
    return hot.select("symbol", F.explode(at).alias("_wide"), "_width").groupBy("symbol", "_wide").agg(
        F.min("_width").alias("_width")
    )


def with_slots(df: DataFrame, hot: DataFrame | None, time: Column, slot_ms: int = SLOT_MS) -> DataFrame:
    """Add `_wide` (the slot of full width), `_width` and `_slot` (the slot to work in)."""
    wide = slot_start(time, slot_ms)
    if hot is None:
        return df.withColumns({"_wide": wide, "_width": F.lit(slot_ms).cast("bigint"), "_slot": wide})
    placed = df.withColumn("_wide", wide).join(hot, ["symbol", "_wide"], "left")
    placed = placed.withColumn("_width", F.coalesce("_width", F.lit(slot_ms).cast("bigint")))
    return placed.withColumn("_slot", time - F.pmod(time - F.col("_wide"), F.col("_width")))


def with_previous(
    df: DataFrame, fetch: Sequence[str] = ("price",), keep: Sequence[str] | None = None,
    slot_ms: int = SLOT_MS, hot_rows: int | None = None,
) -> DataFrame:
    """Add `prev_<col>`: the value at the tick before this one, per symbol.

    One exchange of the rows (only the columns `keep`, if given). The last tick of
    each slot is carried into the next non-empty slot, so the first row of a slot sees
    its true predecessor. `fetch` names numeric columns.
    """
    time = F.col("event_time_ms")
    key = order_key(time, F.col("id"), slot_ms)
    hot = crowded_slots(df, "event_time_ms", slot_ms, hot_rows)
    df = df.select(*keep) if keep else df
    placed = with_slots(df, hot, time, slot_ms).drop("_wide", "_width")
    tails = placed.groupBy("symbol", "_slot").agg(*[F.max_by(c, key).alias(f"_last_{c}") for c in fetch])
    slots = Window.partitionBy("symbol").orderBy("_slot")
    carried = tails.select(
        "symbol", "_slot", *[F.lag(f"_last_{c}").over(slots).alias(f"_carry_{c}") for c in fetch]
    )
    w = Window.partitionBy("symbol", "_slot").orderBy("event_time_ms", "id")
    lagged = placed.withColumns({"_first": F.row_number().over(w) == 1} | {f"_lag_{c}": F.lag(c).over(w) for c in fetch})
    joined = lagged.join(carried, ["symbol", "_slot"], "left")
    previous = {
        f"prev_{c}": F.when(F.col("_first"), F.col(f"_carry_{c}")).otherwise(F.col(f"_lag_{c}")) for c in fetch
    }
    return joined.withColumns(previous).select(*df.columns, *previous)


def _slot_counts(df: DataFrame, time: str, slot_ms: int, hot_rows: int | None, even: bool) -> tuple[DataFrame, DataFrame]:
    """`df` with `_slot`, and rows per symbol and slot."""
    hot = None if even else crowded_slots(df, time, slot_ms, hot_rows)
    placed = with_slots(df, hot, F.col(time), slot_ms).drop("_wide", "_width")
    return placed, placed.groupBy("symbol", "_slot").agg(F.count(F.lit(1)).alias("_cnt"))


def with_rank(
    df: DataFrame,
    order: Sequence[str] = ("event_time_ms", "id"),
    descending: bool = False,
    slot_ms: int = SLOT_MS,
    peers: bool = False,
    hot_rows: int | None = None,
    even: bool = False,
) -> DataFrame:
    """Add `_rn` (1-based row number per symbol) and `_n` (rows of the symbol).

    Two phases: rows per slot give each slot its starting number, then rows are
    numbered inside their slot. `order[0]` is the time column. With `peers`,
    `_rn_first` is the number of the first row at the same time. `even` says that no
    slot can be crowded (candles), so none is looked for.
    """
    placed, counts = _slot_counts(df, order[0], slot_ms, hot_rows, even)
    by_slot = Window.partitionBy("symbol").orderBy(F.col("_slot").desc() if descending else F.col("_slot"))
    offsets = counts.select(
        "symbol", "_slot",
        F.coalesce(F.sum("_cnt").over(by_slot.rowsBetween(*BEFORE_NOW)), F.lit(0)).alias("_base"),
        F.sum("_cnt").over(Window.partitionBy("symbol")).alias("_n"),
    )
    keys = [F.col(c).desc() if descending else F.col(c) for c in order]
    inside = Window.partitionBy("symbol", "_slot")
    numbers = {"_local": F.row_number().over(inside.orderBy(*keys))}
    if peers:
        numbers["_peer"] = F.rank().over(inside.orderBy(keys[0]))
    joined = placed.withColumns(numbers).join(offsets, ["symbol", "_slot"], "inner")
    ranks = {"_rn": F.col("_base") + F.col("_local")}
    if peers:
        ranks["_rn_first"] = F.col("_base") + F.col("_peer")
    return joined.withColumns(ranks).select(*df.columns, "_n", *ranks)


def in_ranges(df: DataFrame, order: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Add `_part`: ranges of `order`, of about equal numbers of rows, that follow the data (0 holds the smallest).

    Spark draws the cuts from a sample of the rows. They are written with the rows, so every reader sees the same ones. Rows that
    are equal in `order` share a range.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


def chunk_of_rank(rn: Column, size: int) -> Column:
    zero_based = rn - F.lit(1)
    return ((zero_based - F.pmod(zero_based, F.lit(size).cast("bigint"))) / F.lit(size)).cast("bigint")


def rank_chunks(ranked: DataFrame, before: int = 0, after: int = 0, size: int = RANK_CHUNK) -> DataFrame:
    """Cut numbered rows into even chunks; copy `before`/`after` rows over the cuts."""
    if max(before, after) > size:
        raise ValueError("halo larger than the chunk")
    own = chunk_of_rank(F.col("_rn"), size)
    first = F.greatest(chunk_of_rank(F.col("_rn") - after, size), F.lit(0))
    last = F.least(
        chunk_of_rank(F.col("_rn") + before, size), chunk_of_rank(F.col("_n"), size)
    )
    return ranked.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.col("_chunk") == own
    )


def chunk_window(*order: str) -> Window:
    return Window.partitionBy("symbol", "_chunk").orderBy(*(order or ("event_time_ms", "id")))


def per_symbol_to_rank_chunks(stats: DataFrame, n: str = "_n", size: int = RANK_CHUNK) -> DataFrame:
    """Repeat a one-row-per-symbol table for each rank chunk of the symbol.

    Joining rows to it on (symbol, _chunk) reuses the rows' partitioning, so a
    hot symbol is looked up in as many tasks as it has chunks.
    """
    last = chunk_of_rank(F.col(n), size)
    return stats.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))


def attach_per_symbol(
    chunked: DataFrame, stats: DataFrame, source: DataFrame, how: str = "inner", time: str = "event_time_ms",
    slot_ms: int = SLOT_MS, even: bool = False,
) -> DataFrame:
    """Join a one-row-per-symbol table to rows cut by `rank_chunks`.

    `source` is the table whose rows were numbered (`time`, `slot_ms` and `even` as then); its row counts say how many
    chunks each symbol has. They are added up from the counts per slot that the numbering rests on, so no row is counted again.
    """
    _, counts = _slot_counts(source, time, slot_ms, None, even)
    sizes = counts.groupBy("symbol").agg(F.sum("_cnt").alias("_size"))
    spread = per_symbol_to_rank_chunks(stats.join(sizes, "symbol"), "_size").drop("_size")
    return chunked.join(spread, ["symbol", "_chunk"], how)


def slots_with(df: DataFrame, limit: int, descending: bool, time: str = "event_time_ms", slot_ms: int = SLOT_MS) -> DataFrame:
    """The rows of the slots that hold each symbol's newest (or oldest) `limit` rows.

    Rows are counted per symbol and slot (two columns, summed on the map side); slots in
    front of which there are `limit` rows already are left out. So what is put in order
    afterwards is bounded by `limit` and one slot, however many tasks read the table.
    """
    slot = slot_start(F.col(time), slot_ms)
    counts = df.groupBy("symbol", slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy("symbol").orderBy(F.col("_slot").desc() if descending else F.col("_slot")).rowsBetween(*BEFORE_NOW)
    wanted = counts.withColumn("_front", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).filter(F.col("_front") < limit)
    edge = wanted.groupBy("symbol").agg((F.min if descending else F.max)("_slot").alias("_edge"))
    met = df.join(edge, "symbol")
    return met.filter(slot >= F.col("_edge") if descending else slot <= F.col("_edge")).select(*df.columns)


def newest_per_symbol(df: DataFrame, limit: int, order: Sequence[str] = ("event_time_ms", "id"), prune: bool = False) -> DataFrame:
    """The newest `limit` rows of each symbol, numbered 1.. from the newest (`_pos`).

    `prune` first leaves out the slots that cannot hold them (`slots_with`): for tables
    that many tasks read. Spark keeps only `limit` rows per symbol and task before the
    exchange (window group limit).
    """
    if prune:
        df = slots_with(df, limit, True, order[0])
    w = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") <= limit)


def oldest_per_symbol(df: DataFrame, limit: int, order: Sequence[str] = ("event_time_ms", "id"), prune: bool = False) -> DataFrame:
    """The oldest `limit` rows of each symbol, numbered 1.. from the oldest (`_pos`)."""
    if prune:
        df = slots_with(df, limit, False, order[0])
    w = Window.partitionBy("symbol").orderBy(*order)
    return df.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") <= limit)


def latest_ms(df: DataFrame, time: str = "event_time_ms") -> Column:
    """The newest event time of a table as a scalar subquery: one number, no join."""
    return df.agg(F.max(time).alias("now_ms")).scalar()
