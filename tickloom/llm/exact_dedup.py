"""Exact dedup as a stateful stream.

Texts are equal when identical after A-Z became a-z. Arrivals (id, digest of the text, locator of its
content) pass through a keyed streaming aggregation whose state lies in RocksDB on the executors' disks
and in the checkpoint. The state never expires: for each digest it keeps the identifier of the row that
stays (the largest id), the file in which its content lies, and the number of rows. A restarted stream
goes on from its checkpoint, and a map-side count keeps a digest that a third of all rows share small.

Hits are then checked on the full bytes: rows of a digest are joined with the content of the row that
stays, found by its locator. Rows that differ (a digest collision) form groups of their own by text.

Defined cases: null counts as empty, and empty texts are copies of one another; the row that stays is
the one with the largest id, and rows that repeat that id with the same text all stay; null ids are
smaller than any other and stay only among themselves; an empty table gives an empty result; input
columns named like a result give way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import fresh_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State in RocksDB; without pre-allocated files, which would take megabytes for each small state store, and with
#: one bound on the memory of all stores of an executor (beyond it, stores write to their disk).
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}


def normalized(text: str) -> Column:
    return F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), UPPER, UPPER.lower())


def sha256(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


def remember(arrivals_path: str, schema, spark, batches: int = 4, state_path: str | None = None) -> DataFrame:
    """Runs the stream over all arrivals that are there: (digest, keep_id, locator, size) for each digest.

    With the `state_path` of an earlier run, only arrivals since then are read, and the result covers all.
    """
    state_path = state_path or fresh_path(spark, "dedup-state")
    out = f"{state_path}/told"
    files = len(spark.read.schema(schema).parquet(arrivals_path).inputFiles())
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(arrivals_path)
    state = arrivals.groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("top"), F.count("*").alias("size"))

    def tell(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").foreachBatch(tell).trigger(availableNow=True)
                 .option("checkpointLocation", f"{state_path}/checkpoint").start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    told = spark.read.schema(state.schema).parquet(f"{out}/*") if files else spark.createDataFrame([], state.schema)
    latest = told.groupBy("digest").agg(F.max("top").alias("top"), F.max("size").alias("size"))  # both only grow
    return latest.select("digest", F.col("top.id").alias("keep_id"), F.col("top.locator").alias("locator"), "size")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """A row for each row of `docs`: its id, `keep_id`, `group_size`, `kept` and `digest`."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), digest(normalized(text)).alias("digest"), F.input_file_name().alias("locator"))
    path = fresh_path(spark, "arrivals")
    rows.write.parquet(path)
    arrivals = spark.read.schema(rows.schema).parquet(path)
    groups = remember(path, rows.schema, spark)
    several = groups.where(F.col("size") > 1)

    # The full bytes of every hit against those of the row that stays. Both sides of the join ask for the
    # same columns and filter nothing before it, so they read the texts from one exchange.
    content = docs.select(F.col(f"`{id_col}`").alias("id"), F.input_file_name().alias("place"), normalized(text).alias("normal"))
    content = content.withColumn("digest", digest(F.col("normal"))).join(several, "digest")
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & F.col("place").eqNullSafe(F.col("locator"))
    kept = content.groupBy("digest").agg(F.max_by("normal", F.struct(stays, "id")).alias("kept_normal"))
    other = content.join(kept, "digest").where(~F.col("normal").eqNullSafe(F.col("kept_normal")))
    path = fresh_path(spark, "collisions")
    other = other.select("id", "place", "digest", "normal")
    other.write.parquet(path)
    other = spark.read.schema(other.schema).parquet(path)
    apart = other.groupBy("digest", "normal").agg(F.max("id").alias("apart_id"), F.count("*").alias("apart_size"))
    moved = other.join(apart, ["digest", "normal"]).groupBy("id", "digest").agg(
        F.max("apart_id").alias("apart_id"), F.max("apart_size").alias("apart_size"))
    fewer = other.groupBy("digest").agg(F.count("*").alias("gone"))

    result = arrivals.join(groups, "digest").join(fewer, "digest", "left").join(moved, ["id", "digest"], "left")
    keep = F.coalesce("apart_id", "keep_id")
    size = F.coalesce("apart_size", F.col("size") - F.coalesce("gone", F.lit(0)))
    return result.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), "digest")
