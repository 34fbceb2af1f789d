"""Session helpers: local sessions for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small shuffles are spread over the cores of one machine instead of being put together in one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")  # cheaper plan building from Python
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


_MADE: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; `drop_scratch` deletes all of this session's."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    scratch(spark).append(path)
    return path


def scratch(spark: SparkSession) -> list[str]:
    """Places of this session; another list after `drop_scratch`."""
    return _MADE.setdefault(spark.sparkContext.applicationId, [])


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote to places of `fresh_path`. Results that read them must be done."""
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once a session, as an archive in the shared folder.

    So functions that run on workers can import it wherever the driver found it.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    packed = io.BytesIO()
    home = Path(__file__).resolve().parent
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(home.rglob("*.py")):
            archive.write(file, file.relative_to(home.parent).as_posix())
    name = fresh_path(spark, "package") + ".zip"
    scratch(spark).append(name)
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(where.toString())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where one result feeds several jobs (model fits, splits): the written
    table outlives lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
