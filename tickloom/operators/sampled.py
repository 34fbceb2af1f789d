"""What the ticks beside a sampled tick say, computed chunk by chunk with numpy over Arrow.

Spark numbers the ticks, cuts them into even chunks with a halo of rows and exchanges them once; inside a chunk all
sampled ticks are handled together. Sums run in the order of the values, so results do not depend on the chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators.layout import RANK_CHUNK, chunk_of_rank, with_rank
from tickloom.session import ship

WINDOW = 100
STRIDE = 10
RATE_ROWS = 200
PATH_ROWS = 200
MINUTE = 60_000
LEVELS = {"level_75": 0.75, "level_90": 0.90, "level_99": 0.99}
PAST = ("prev_price", "spike", "moves", "mean", "std", *LEVELS, "below", "spread", "flips", "range", "rate")
PATH = ("path_ticks", "highest", "lowest")
MIN_PRICES = 10  # fewer have no spread, flips or range


def peer_chunks(ranked: DataFrame, before: int, after: int, size: int | None = None) -> DataFrame:
    """Cut numbered rows (`_rn`, `_rn_first`, `_n`) into even chunks that keep the rows of one time together.

    A row's chunk is that of the first row of its time; the `before` rows in front of it and `after` rows from that first
    row on are copied into the chunk. A row has a copy or two, however many rows have one time.
    """
    size = RANK_CHUNK if size is None else size
    if max(before, after) > size:
        raise ValueError("halo larger than the chunk")
    own = chunk_of_rank(F.col("_rn_first"), size)
    first = F.greatest(chunk_of_rank(F.col("_rn") - after, size), F.lit(0))
    last = F.least(chunk_of_rank(F.col("_rn") + before, size), chunk_of_rank(F.col("_n"), size))
    return ranked.withColumn("_chunk", F.explode(F.array_union(F.array(own), F.sequence(first, last)))).withColumn(
        "_home", F.col("_chunk") == own
    )


def _running_total(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of the first `count` values of each column, added one after the other."""
    total = np.zeros(values.shape[1])
    for j, row in enumerate(values):
        total = np.where(j < count, total + row, total)
    return total


def past_statistics(price: np.ndarray, missing: np.ndarray, at: np.ndarray, window: int) -> dict:
    """Statistics of the `window` prices before each place `at`: values, or (values, which are null)."""
    past = np.arange(-window, 0)[:, None] + at
    p, gone = price[past], missing[past]
    has_base = ~gone[:-1] & ~(p[:-1] <= 0)
    move = np.abs(p[1:] - p[:-1]) / p[:-1] * 100.0
    valid = has_base & ~gone[1:]
    count = valid.sum(axis=0)
    move = np.sort(np.where(valid, move, np.nan), axis=0)  # those that do not count are last
    mean = _running_total(move, count) / count
    std = np.sqrt(_running_total((move - mean) ** 2, count) / count)
    none = count == 0
    prev, lost, now = p[-1], gone[-1], price[at]
    base = ~lost & ~(prev <= 0)
    spike = np.where(base, np.abs(now - prev) / prev * 100.0, 0.0)
    no_spike = base & missing[at]
    among = np.arange(len(move))[:, None] < count
    not_a_number = np.isnan(spike) & ~no_spike  # above everything, as in SQL
    below = (among & ((move <= spike) | not_a_number)).sum(axis=0)
    out = {"prev_price": (prev, lost), "spike": (spike, no_spike), "moves": count, "mean": (mean, none), "std": (std, none), "below": below}
    for name, level in LEVELS.items():
        k = np.floor(count * level).astype(int)
        out[name] = (np.take_along_axis(move, np.minimum(k, max(len(move) - 1, 0))[None], axis=0)[0] if len(move) else mean, none)
    spread, flips, extent = np.zeros(len(at)), np.zeros(len(at)), (np.zeros(len(at)), np.zeros(len(at), bool))
    if window >= MIN_PRICES:
        d = np.where(gone[1:] | gone[:-1], np.nan, p[1:] - p[:-1])
        x, y = d[1:], d[:-1]
        n = np.full(len(at), len(x))
        cov = _running_total((x - _running_total(x, n) / n) * (y - _running_total(y, n) / n), n) / n
        spread = np.where(cov < 0, 2.0 * np.sqrt(np.abs(cov)), 0.0)
        flips = (np.sign(x) * np.sign(y) < 0).sum(axis=0) / len(x)
        extent = (np.where(gone, -np.inf, p).max(axis=0) - np.fmin.reduce(np.where(gone, np.inf, p)), gone.all(axis=0))
    return out | {"spread": spread, "flips": flips, "range": extent}


def path_extremes(price: np.ndarray, missing: np.ndarray, time: np.ndarray, at: np.ndarray, first: np.ndarray) -> dict:
    """Length, highest and lowest price of the ticks in [t, t + MINUTE], at most PATH_ROWS, from the place `first` on."""
    end = np.minimum(first + PATH_ROWS, np.searchsorted(time, time[at] + MINUTE, side="right"))
    places = first + np.arange(PATH_ROWS)[:, None]
    inside = places < end
    places = np.minimum(places, len(price) - 1)
    inside &= ~missing[places]
    p, empty = price[places], ~inside.any(axis=0)
    highest = np.where(inside, p, -np.inf).max(axis=0)
    lowest = np.fmin.reduce(np.where(inside, p, np.inf))
    return {"path_ticks": end - first, "highest": (highest, empty), "lowest": (lowest, empty)}


def sampled_rows(
    ticks: DataFrame, window: int = WINDOW, stride: int = STRIDE, keep: Sequence[str] = (), past: bool = True, path: bool = True
) -> DataFrame:
    """The sampled ticks (symbol, id, event_time_ms, price, `keep`) with statistics of the ticks beside them.

    `past` (columns PAST): the `window` ticks before each, their moves, the tick's own move among them, and how many of the
    RATE_ROWS ticks before lie in the last minute. `path` (columns PATH): the first PATH_ROWS ticks with time in [t, t + 60 s],
    from the first tick of the same millisecond on.
    """
    if window % stride or RATE_ROWS % stride:
        raise ValueError("stride must divide the window lengths")
    ship(ticks.sparkSession)
    carried = ["symbol", "id", "event_time_ms", "price", *keep]
    ranked = with_rank(ticks.select(*carried), peers=True)
    rows = peer_chunks(ranked, max(window, RATE_ROWS) if past else 0, PATH_ROWS if path else 0)
    schema = StructType(list(ticks.select(*carried).schema.fields))
    for name in (*(PAST if past else ()), *(PATH if path else ())):
        schema.add(name, "double")

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rn")
        rn, first, time, price = (table[c].to_numpy() for c in ("_rn", "_rn_first", "event_time_ms", "price"))
        missing = table["price"].is_null().to_numpy()
        at = np.flatnonzero(table["_home"].to_numpy() & (rn > window) & ((rn - 1 - window) % stride == 0))
        found = {}
        with np.errstate(all="ignore"):
            if past:
                found |= past_statistics(price, missing, at, window)
                found["rate"] = at - np.maximum(np.searchsorted(time, time[at] - MINUTE), np.maximum(at - RATE_ROWS, 0))
            if path:
                found |= path_extremes(price, missing, time, at, at - (rn[at] - first[at]))
        out = table.select(carried).take(pa.array(at))
        for name in schema.fieldNames()[len(carried):]:
            values, none = found[name] if isinstance(found[name], tuple) else (found[name], None)
            out = out.append_column(name, pa.array(values.astype(float), mask=none))
        return out

    return rows.groupBy("symbol", "_chunk").applyInArrow(work, schema)
