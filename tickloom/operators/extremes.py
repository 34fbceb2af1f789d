"""Highest and lowest values of ranges of row numbers, however long the ranges are.

Rows lie in blocks of FAN rows, blocks in blocks of FAN blocks, and so on. A range is the end of one block, the beginning of
another, and whole blocks between them, which are a range one level higher. So a range costs at most two slices of FAN values
on each level, whatever it spans, and a block is one row with two short arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.layout import chunk_of_rank

FAN = 512
LEVELS = 4  # ranges of up to FAN ** LEVELS rows


def _parts(ranges: DataFrame, levels: int, fan: int) -> list[DataFrame]:
    """(symbol, _q, _block, _from, _to) of each level: pieces of ranges that lie in one block, as places from 1 in it."""
    out, left = [], ranges
    size = F.lit(fan).cast("bigint")
    for level in range(levels):
        cut = left.withColumns({"_ba": chunk_of_rank(F.col("_a"), fan), "_bb": chunk_of_rank(F.col("_b"), fan)})
        place = lambda c, block: (F.col(c) - F.col(block) * size).cast("int")
        piece = lambda block, a, b: F.struct(F.col(block).alias("block"), a.alias("from"), b.alias("to"))
        first, last = place("_a", "_ba"), place("_b", "_bb")
        pieces = F.when(F.col("_ba") == F.col("_bb"), F.array(piece("_ba", first, last))).otherwise(
            F.array(piece("_ba", first, F.lit(fan)), piece("_bb", F.lit(1), last)))
        out.append(cut.select("symbol", "_q", F.explode(pieces).alias("_p")).select(
            "symbol", "_q", F.col("_p.block").alias("_block"), F.col("_p.from").alias("_from"), F.col("_p.to").alias("_to")))
        # whole blocks between the two, numbered from 1 one level higher
        left = cut.filter(F.col("_bb") - F.col("_ba") > 1).select("symbol", "_q", (F.col("_ba") + 2).alias("_a"), F.col("_bb").alias("_b"))
    return out


def range_extremes(rows: DataFrame, ranges: DataFrame, value: str, levels: int = LEVELS, fan: int = FAN) -> DataFrame:
    """(symbol, _q, highest, lowest) of `value` over the rows `_a` to `_b` (row numbers `_rn` from 1) of each range.

    `ranges` has symbol, a key `_q` within the symbol, `_a` and `_b`; ranges without rows have none. Null values do not count.
    """
    held = rows.select("symbol", "_rn", F.col(value).alias("hi"), F.col(value).alias("lo"))
    found = None
    for pieces in _parts(ranges.filter(F.col("_a") <= F.col("_b")), levels, fan):
        blocks = held.groupBy("symbol", chunk_of_rank(F.col("_rn"), fan).alias("_block")).agg(
            F.sort_array(F.collect_list(F.struct("_rn", "hi", "lo"))).alias("_items"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
        arrays = blocks.select("symbol", "_block", F.col("_items.hi").alias("_hi"), F.col("_items.lo").alias("_lo"))
        met = pieces.join(arrays, ["symbol", "_block"])
        part = lambda c: F.slice(c, F.col("_from"), F.col("_to") - F.col("_from") + 1)
        best = met.select("symbol", "_q", F.array_max(part("_hi")).alias("highest"), F.array_min(part("_lo")).alias("lowest"))
        found = best if found is None else found.unionByName(best)
        held = blocks.select("symbol", (F.col("_block") + 1).alias("_rn"), "hi", "lo")
    return found.groupBy("symbol", "_q").agg(F.max("highest").alias("highest"), F.min("lowest").alias("lowest"))
