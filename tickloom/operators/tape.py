"""Running totals of a tape at asked row numbers.

The tape is cut into even chunks of rows. A chunk meets the row numbers that are asked of it in one task, where numpy runs
through its ticks once; totals of earlier chunks (a row each) are added afterwards. Totals are whole numbers, in three parts of
nine places (1, 1e-9, 1e-18), so a difference of two of them loses nothing however long the tape or small a quantity is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators.layout import BEFORE_NOW, chunk_of_rank, rank_chunks
from tickloom.session import ship

PLACES = 10**9
SUMS = ("c", "q", "x", "xx")           # signed volume, volume, moves, squares of moves
COUNTS = ("n_q", "n_x", "n_diff")      # positive volumes, moves, moves unlike the one before
TOTALS = [*(f"{s}{k}" for s in SUMS for k in range(3)), *COUNTS]
VALUES = ("price", "std_5", "next_d")  # of the tick itself; whether the next move differs


def exact_parts(v: np.ndarray) -> list[np.ndarray]:
    """Whole numbers a, b, c with v = a + b / 1e9 + c / 1e18; a number that is not one counts as 0."""
    v = np.where(np.isnan(v), 0.0, v)
    if np.any(np.abs(v) >= 9e18):
        raise OverflowError("a quantity or move is too large to be added up exactly")
    near = np.rint(v * PLACES)
    short = (np.abs(near) < 2**53) & (near / PLACES == v)  # nine places say all
    k = np.where(short, near, 0).astype(np.int64)
    a = k // PLACES
    parts = [a, k - a * PLACES, np.zeros_like(k)]
    if not short.all():
        whole = np.floor(v)
        rest = (v - whole) * PLACES
        middle = np.floor(rest)
        parts = [np.where(short, p, o.astype(np.int64)) for p, o in zip(parts, (whole, middle, np.rint((rest - middle) * PLACES)))]
    return parts


def number(a: Column, b: Column, c: Column) -> Column:
    """The number with these three parts."""
    places = F.lit(PLACES).cast("bigint")
    upper = F.when(F.abs(a) < 9 * 10**8, (a * places + b).cast("double") / PLACES).otherwise(a + b / PLACES)
    return upper + c / F.lit(1e18)


def states(price: np.ndarray, no_price: np.ndarray, quantity: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """What each tick adds to the totals, its move, and whether it has one; the first row has no tick before it."""
    prev, lost = np.roll(price, 1), np.roll(no_price, 1)
    lost[:1] = True
    moved = ~lost & ~no_price
    gap = np.where(moved, price - prev, np.nan)
    has_x = moved & ~(prev <= 0)
    x = np.where(has_x, np.abs(gap) / prev * 100.0, np.nan)
    same = np.zeros(len(x), bool)
    same[1:] = has_x[1:] & has_x[:-1] & ((x[1:] == x[:-1]) | (np.isnan(x[1:]) & np.isnan(x[:-1])))
    out = {"n_q": (quantity > 0).astype(np.int64), "n_x": has_x.astype(np.int64), "n_diff": (~same).astype(np.int64)}
    sign = np.where(np.isnan(gap), 0, np.sign(gap)).astype(np.int64)
    volume = exact_parts(quantity)
    for name, parts in (("c", [sign * part for part in volume]), ("q", volume), ("x", exact_parts(x)), ("xx", exact_parts(x * x))):
        out |= {f"{name}{k}": part for k, part in enumerate(parts)}
    return out, x, has_x


def deviation_of_five(x: np.ndarray, has_x: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deviation of the moves of each place and the four rows before it, and where there is none."""
    five = places - np.arange(5)[:, None]
    held = (five >= 0) & has_x[np.maximum(five, 0)]
    five = x[np.maximum(five, 0)]
    count = held.sum(axis=0)
    base = np.take_along_axis(five, held.argmax(axis=0)[None], axis=0)
    off = np.where(held, five - base, 0.0)  # equal moves have no deviation
    mean = off.sum(axis=0) / count
    return np.sqrt(np.where(held, (off - mean) ** 2, 0.0).sum(axis=0) / count), count == 0


def _chunk_states(table: pa.Table) -> tuple:
    """The rows of a chunk in order, their `states`, and the places of the first own row and behind the last."""
    table = table.sort_by("_rn")
    own = np.flatnonzero(table["_home"].to_numpy())
    with np.errstate(all="ignore"):
        found = states(table["price"].to_numpy(), table["price"].is_null().to_numpy(), table["quantity"].to_numpy())
    return table, *found, *((own[0], own[-1] + 1) if len(own) else (0, 0))


def totals_at(ranked: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """`asked` (symbol, `_rn`, any other columns) with TOTALS up to that row number, and VALUES of that tick; null without the row.

    `ranked` has symbol, `_rn`, `_n`, price and quantity.
    """
    ship(ranked.sparkSession)
    rows = rank_chunks(ranked.select("symbol", "_rn", "_n", "price", "quantity"), 6, 1, size).drop("_n").repartition("symbol", "_chunk")
    wide = ", ".join(f"{c} bigint" for c in TOTALS)

    def add_up(table: pa.Table) -> pa.Table:
        held, found, _, _, first, end = _chunk_states(table)
        out = held.select(["symbol", "_chunk"]).slice(first, min(1, end - first))
        for c in TOTALS:
            out = out.append_column(c, pa.array([found[c][first:end].sum()][: out.num_rows], pa.int64()))
        return out

    sums = rows.groupBy("symbol", "_chunk").applyInArrow(add_up, f"symbol string, _chunk bigint, {wide}")
    earlier = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(*BEFORE_NOW)
    bases = sums.select("symbol", "_chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_b_{c}") for c in TOTALS])

    asked = asked.withColumn("_chunk", chunk_of_rank(F.col("_rn"), size))
    names = asked.columns
    schema = StructType(list(asked.schema.fields))
    for c in TOTALS:
        schema.add(c, "long")
    for c in VALUES:
        schema.add(f"at_{c}", "double")

    def answer(ticks: pa.Table, probes: pa.Table) -> pa.Table:
        out = probes.select(names)
        if not ticks.num_rows or not probes.num_rows:
            for field in schema.fields[len(names):]:
                out = out.append_column(field.name, pa.nulls(out.num_rows, pa.int64() if field.name in TOTALS else pa.float64()))
            return out
        held, found, x, has_x, first, end = _chunk_states(ticks)
        place = probes["_rn"].to_numpy() - held["_rn"][0].as_py()
        none = (place < first) | (place >= end)
        place = np.clip(place, first, end - 1)
        for c in TOTALS:
            out = out.append_column(c, pa.array(np.cumsum(found[c][first:end])[place - first], mask=none))
        with np.errstate(all="ignore"):
            std, no_std = deviation_of_five(x, has_x, place)
        next_d = found["n_diff"][np.minimum(place + 1, len(x) - 1)].astype(float)
        price, no_price = held["price"].to_numpy()[place], held["price"].is_null().to_numpy()[place]
        for c, v, lost in (("price", price, no_price), ("std_5", std, no_std), ("next_d", next_d, none)):
            out = out.append_column(f"at_{c}", pa.array(v, mask=none | lost))
        return out

    met = rows.groupBy("symbol", "_chunk").cogroup(asked.groupBy("symbol", "_chunk")).applyInArrow(answer, schema)
    plus = met.join(bases, ["symbol", "_chunk"], "left")
    return plus.select(*[c for c in names if c != "_chunk"], *[(F.col(c) + F.col(f"_b_{c}")).alias(c) for c in TOTALS], *[f"at_{c}" for c in VALUES])
