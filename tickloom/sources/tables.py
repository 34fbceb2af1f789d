"""Stored tables: append, overwrite, retention, existence and counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def event_date(time: str = "event_time_ms") -> Column:
    return F.to_date(F.timestamp_millis(F.col(time)))


def write_ticks(ticks: DataFrame, path: str, mode: str = "append") -> None:
    """Append ticks, laid out by symbol and day, sorted by time inside files.

    Symbol and day prune folders; the sort gives each row group a narrow
    time range, so replay filters skip row groups. The hour spreads the write of a
    hot symbol over tasks.
    """
    hour = F.col("event_time_ms") - F.pmod(F.col("event_time_ms"), F.lit(3_600_000))
    (
        ticks.withColumn("date", event_date())
        .repartition("symbol", "date", hour)
        .sortWithinPartitions("symbol", "date", "event_time_ms", "id")
        .write.mode(mode)
        .partitionBy("symbol", "date")
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a table in place (truncate and fill)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def truncate_table(spark: SparkSession, path: str) -> None:
    """Empty a table but keep its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def read_features(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """The feature table with only the wanted columns and rows (both reach the scan)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def retain_recent(ticks: DataFrame, now_ms, keep_ms: int = 7_200_000) -> DataFrame:
    """Ticks not older than `keep_ms` before `now_ms` (a number or a column)."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return ticks.filter(F.col("event_time_ms") >= now - F.lit(keep_ms))


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that a pattern finds."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []]


def drop_old_days(spark: SparkSession, path: str, now_ms: int, keep_ms: int = 7_200_000) -> list[str]:
    """Delete the `date=` folders of a tick table whose whole day is older than `keep_ms` before `now_ms`.

    Lists folders only; ticks of the day that is cut stay until it is over (`retain_recent` filters them).
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/symbol=*/date=*")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    first = datetime.fromtimestamp((now_ms - keep_ms) / 1000, timezone.utc).date().isoformat()
    old = sorted(str(f.getPath()) for f in found if f.getPath().getName().removeprefix("date=") < first)
    for folder in old:
        drop_folder(spark, folder)
    return old


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
