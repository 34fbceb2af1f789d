"""Temporal joins: the first tick at or after a time, however far away it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.layout import (
    SLOT_MS,
    UNTIL_NOW,
    crowded_after,
    crowded_slots,
    order_key,
    with_slots,
)


def asof_forward(
    probes: DataFrame,
    ticks: DataFrame,
    target: str = "target_ms",
    slot_ms: int = SLOT_MS,
    offsets: Sequence[int] = (),
    hot_rows: int | None = None,
    fetch: Sequence[str] = ("price",),
    crowd: DataFrame | None = None,
) -> DataFrame:
    """For each probe (symbol, `target`): the first tick of the symbol with time >= target.

    Adds `found_ms` and `found_<col>` for the numeric columns `fetch` (null when no
    such tick exists). `offsets` are the distances from ticks to targets; they only tell which
    slots will be crowded, looked for in `crowd` (default: `ticks`).

    Ticks and probes meet in the slot of their time; inside a slot one backward pass
    with a running "last tick seen" answers all probes, n log n for any density. A
    probe whose slot has no later tick gets the first tick of the next non-empty slot,
    carried over a table of one row per symbol and slot that holds ticks or probes: empty
    time costs nothing, however far apart probes and ticks are.
    """
    key = order_key(F.col("_t"), F.col("_i"), slot_ms)
    bare = ticks.select("symbol", F.col("event_time_ms").alias("_t"), F.col("id").alias("_i"), *fetch)
    crowd = ticks if crowd is None else crowd
    hot = crowded_after(crowded_slots(crowd, "event_time_ms", slot_ms, hot_rows), offsets, slot_ms)
    points = with_slots(bare, hot, F.col("_t"), slot_ms)
    heads = points.groupBy("symbol", "_slot").agg(*[F.min_by(c, key).alias(c) for c in fetch], F.min("_t").alias("_t"))
    packed = probes.select("symbol", F.col(target).alias("_at"), F.struct(*probes.columns).alias("_probe"))
    placed = with_slots(packed, hot, F.col("_at"), slot_ms)
    # slots that hold ticks or probes, backwards in time; a slot's probes come before its head, so they see later heads only
    found_type = bare.select(F.struct("_t", *fetch).alias("s")).schema["s"].dataType
    asked = placed.select("symbol", "_slot").distinct().withColumn("_head", F.lit(None).cast(found_type))
    later = Window.partitionBy("symbol").orderBy(F.col("_slot").desc(), F.col("_head").isNotNull()).rowsBetween(*UNTIL_NOW)
    slots = asked.unionByName(heads.select("symbol", "_slot", F.struct("_t", *fetch).alias("_head")))
    answers = slots.withColumn("_next", F.last("_head", ignorenulls=True).over(later)).filter(
        F.col("_head").isNull() & F.col("_next").isNotNull())
    carried = answers.select(
        "symbol", "_slot", F.col("_next._t").alias("_at"), F.lit(0).cast("bigint").alias("_i"),
        F.col("_next").alias("_tick"), F.lit(None).cast(probes.schema).alias("_probe"),
    )
    tick_rows = points.select(
        "symbol", "_slot", F.col("_t").alias("_at"), "_i",
        F.struct("_t", *fetch).alias("_tick"), F.lit(None).cast(probes.schema).alias("_probe"),
    )
    probe_rows = placed.select(
        "symbol", "_slot", "_at", F.lit(None).cast("bigint").alias("_i"),
        F.lit(None).cast(found_type).alias("_tick"), "_probe",
    )
    backward = (
        Window.partitionBy("symbol", "_slot")
        .orderBy(F.col("_at").desc(), F.col("_probe").isNotNull(), F.col("_i").desc())
        .rowsBetween(*UNTIL_NOW)
    )
    met = tick_rows.unionByName(carried).unionByName(probe_rows)
    return (
        met.withColumn("_found", F.last("_tick", ignorenulls=True).over(backward))
        .filter(F.col("_probe").isNotNull())
        .select("_probe.*", F.col("_found._t").alias("found_ms"), *[F.col(f"_found.{c}").alias(f"found_{c}") for c in fetch])
    )


def asof_horizons(
    probes: DataFrame,
    ticks: DataFrame,
    horizons: dict[str, int],
    keys: Sequence[str] = ("symbol", "id"),
    time: str = "event_time_ms",
) -> DataFrame:
    """One price column per horizon: the first tick at or after time + horizon.

    All horizons go through one as-of pass; `keys` identify a probe.
    """
    steps = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h).cast("bigint").alias("ms")) for n, h in horizons.items()])
    asked = (
        probes.withColumn("_step", F.explode(steps))
        .withColumn("target_ms", F.col(time) + F.col("_step.ms"))
        .withColumn("_name", F.col("_step.name"))
        .drop("_step")
    )
    found = asof_forward(asked, ticks, offsets=tuple(horizons.values()))
    rest = [c for c in probes.columns if c not in keys]
    return found.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in rest],
        *[F.max(F.when(F.col("_name") == n, F.col("found_price"))).alias(n) for n in horizons],
    )
