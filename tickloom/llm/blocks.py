"""Blocks of documents, and packed messages between blocks and the owners of hash ranges.

A block is a range of document ids with some megabytes of text, and one task reads it. What blocks
have in common (words, windows) is found by owners: each owner has one range of 64-bit keys, and a
block sends it the block's distinct keys of that range, sorted and packed, in one row. So a key that a
third of all documents hold arrives once a block, never once a document, and the rows that cross the
network number blocks times owners. Owners answer in the order of the keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialize

BLOCK_BYTES = 8 << 20
#: Blocks that the driver cuts by itself.
ONE_LEVEL = 1 << 12
#: More blocks than this are not made: 8 MB each, of 32 TB of text; beyond, they grow (a task's memory follows its block).
MOST_BLOCKS = 1 << 22


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    planes = np.frombuffer(pa.decompress(blob[9:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.view(np.uint64).reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def ranges(keys: np.ndarray, bits: int, top: int = 64) -> Iterator[tuple[int, int, int]]:
    """(owner, from, to) for each of the 2^bits ranges of keys below 2^top that holds some of the sorted `keys`."""
    edges = np.searchsorted(keys >> np.uint64(top - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    for owner in np.flatnonzero(np.diff(edges)):
        yield int(owner), int(edges[owner]), int(edges[owner + 1])


def among(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of `keys` are in the sorted array `found`."""
    if not len(found):
        return np.zeros(len(keys), bool)
    return found[np.minimum(np.searchsorted(found, keys), len(found) - 1)] == keys


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def owner_bits(blocks: int) -> int:
    """As many owners as blocks, as a power of two."""
    return max(2, min(22, (blocks - 1).bit_length()))


def _cuts(docs: DataFrame, key: Column, n: int) -> list[float]:
    """The n - 1 cuts of `key` into even ranges, by rank; a key that holds several of them comes several times."""
    return docs.select(key.alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []


def in_blocks(docs: DataFrame, id_col: str, total: int, block_bytes: int = BLOCK_BYTES, text: str | None = None) -> tuple[DataFrame, int]:
    """`docs` as columns `_row` (all columns) and `_block`, and the number of blocks.

    Blocks are ranges of ids, so an earlier document is never in a later block; null ids come last. Where an id holds more than a
    block, or rows have none, rows of one id lie in the order of a hash of `text`, so that they are spread over blocks too. Up
    to ONE_LEVEL blocks are cut by quantiles that the driver asks for; more are cut out of ONE_LEVEL wide ranges, whose cuts
    Spark works out for each range and joins to its rows.
    """
    n = max(1, min(MOST_BLOCKS, -(-total // block_bytes)))
    key = F.col(f"`{id_col}`").cast("double")
    bounds = _cuts(docs, key, min(n, ONE_LEVEL))
    if text is not None and n > 1 and (len(set(bounds)) < len(bounds) or not docs.where(key.isNull()).isEmpty()):
        tie = F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(1 << 20)) / F.lit(float(1 << 20))
        key = F.when(key.isNull(), F.lit(1e300) * (tie + 1.0)).otherwise(key + tie)
        bounds = _cuts(docs, key, min(n, ONE_LEVEL))
    bounds = sorted(set(bounds))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    if not bounds:  # all in one block
        return rows.select(F.lit(0).alias("_block"), "_row"), 1
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_key", outputCol="_cut", handleInvalid="keep")
    placed = cut.transform(rows).withColumn("_cut", F.col("_cut").cast("int"))
    each = -(-n // ONE_LEVEL)
    if each == 1:
        return placed.select(F.col("_cut").alias("_block"), "_row"), len(bounds) + 1
    share = F.percentile_approx("_key", F.array(*[F.lit(i / each) for i in range(1, each)]), F.lit(20 * each))
    finer = cut.transform(docs.select(key.alias("_key"))).groupBy(F.col("_cut").cast("int").alias("_cut")).agg(share.alias("_finer"))
    finer = materialize(finer, "cuts")  # ONE_LEVEL rows of numbers, MOST_BLOCKS in all
    inside = F.size(F.filter("_finer", lambda x: x < F.col("_key")))
    return placed.join(F.broadcast(finer), "_cut").select((F.col("_cut") * each + inside).cast("int").alias("_block"), "_row"), n
