"""Exact order statistics without collecting a group.

Values are counted per (group, value), values fall into a bounded number of
logarithmic buckets, and only the buckets that hold a wanted rank are searched.
Equal values collapse to one row before the exchange, so a group dominated by one
value (flat candles have a move of 0) stays small.

A bucket of more than CROWD different values is narrowed first: its values are counted in CELLS cells of equal
width, and only the cell that holds the rank is kept, LEVELS times. A logarithmic bucket spans a 64th of its
values, so what is left after two levels are values that agree in 38 binary places: some ten thousand doubles at
most, wherever the data crowd. Where no bucket is crowded, these steps have no rows and adaptive execution leaves them out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_E = 64
SIGN_OFFSET = 1_000_000
CROWD = 1_000_000
CELLS = 1 << 16
LEVELS = 2


def value_bucket(v: Column) -> Column:
    """Monotone bucket of a double: about 64 per factor e, 0 for zero."""
    magnitude = F.floor(F.ln(F.abs(v)) * F.lit(BUCKETS_PER_E)).cast("bigint") + F.lit(SIGN_OFFSET)
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, magnitude).otherwise(-magnitude)


def nearest_rank_index(n: Column, p: float) -> Column:
    """0-based index floor(n*p), held inside 0..n-1."""
    return F.least(F.floor(n * F.lit(float(p))).cast("bigint"), n - F.lit(1))


def exact_ranks(
    df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, callable], bucket=value_bucket, crowd: int | None = None
) -> DataFrame:
    """One row per group: `n` and, per name, the value at a 0-based sorted index.

    `wanted` maps an output name to a function of the count column giving the
    index. `bucket` is any monotone function of the value with few results.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .select(*keys, F.col(value).alias("_v"), bucket(F.col(value)).alias("_vb"))
        .groupBy(*keys, "_vb", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    crowd = CROWD if crowd is None else crowd
    extent = [F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    by_bucket = counted.groupBy(*keys, "_vb").agg(F.sum("_c").alias("_bc"), *extent)
    group = Window.partitionBy(*keys)
    ranked = by_bucket.select(
        *keys,
        "_vb",
        F.sum("_bc").over(group.orderBy("_vb").rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
        "_bc", "_d", "_lo", "_hi",
        F.sum("_bc").over(group).alias("n"),
    ).withColumn("_start", F.col("_end") - F.col("_bc"))
    targets = F.array(
        *[F.struct(F.lit(name).alias("name"), fn(F.col("n")).alias("idx")) for name, fn in wanted.items()]
    )
    hits = (
        ranked.withColumn("_t", F.explode(targets))
        .filter((F.col("_t.idx") >= F.col("_start")) & (F.col("_t.idx") < F.col("_end")))
        .select(*keys, "_vb", "n", F.col("_t.name").alias("_name"), (F.col("_t.idx") - F.col("_start")).alias("_k"), "_d", "_lo", "_hi")
    )
    searched = None
    for _ in range(LEVELS):
        calm = hits.filter(F.col("_d") <= crowd)
        searched = calm if searched is None else searched.unionByName(calm)
        hits = _narrowed(counted, hits.filter(F.col("_d") > crowd), keys, extent)
    searched = searched.unionByName(hits)
    inside = Window.partitionBy(*keys, "_name").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        counted.join(searched, [*keys, "_vb"], "inner")
        .filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        .withColumn("_cum", F.sum("_c").over(inside))
        .filter(F.col("_cum") > F.col("_k"))
    )
    return found.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.min(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in wanted],
    )


def _narrowed(counted: DataFrame, hits: DataFrame, keys: list[str], extent: list[Column]) -> DataFrame:
    """The wanted ranks `_k` of `hits`, looked for in the one cell between `_lo` and `_hi` that holds them."""
    lo = F.col("_lo").cast("double")
    width = (F.col("_hi").cast("double") - lo) / F.lit(float(CELLS))
    cell = F.floor((F.col("_v").cast("double") - lo) / width).cast("bigint")  # never falls as the value grows
    cells = (
        counted.join(hits.drop("_d"), [*keys, "_vb"]).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        .groupBy(*keys, "_vb", "_name", "n", "_k", F.coalesce(cell, F.lit(0)).alias("_cell")).agg(F.sum("_c").alias("_bc"), *extent)
    )
    upto = F.sum("_bc").over(Window.partitionBy(*keys, "_name").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    held = cells.withColumn("_end", upto).filter((F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_bc")))
    return held.select(*keys, "_vb", "n", "_name", (F.col("_k") - F.col("_end") + F.col("_bc")).alias("_k"), "_d", "_lo", "_hi")


def nearest_ranks(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles s[floor(n*p)] per group, with `n`."""
    return exact_ranks(
        df, keys, value, {name: (lambda n, p=p: nearest_rank_index(n, p)) for name, p in probs.items()}
    )


def median_indexes(prefix: str = "_med") -> dict[str, callable]:
    """The two middle indexes; their mean is the interpolated median."""
    lower = lambda n: F.floor((n - F.lit(1)) / F.lit(2)).cast("bigint")
    upper = lambda n: F.floor(n / F.lit(2)).cast("bigint")
    return {f"{prefix}_lo": lower, f"{prefix}_hi": upper}
