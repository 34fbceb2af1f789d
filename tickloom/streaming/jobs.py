"""Structured Streaming jobs over ticks: ingest, candles, streaks, outcomes, profiles, rolling counts.

Event time is the tick's own time. Every job keeps its progress and its tables in one folder, which may
be given: started again on that folder, it goes on where it ended, without loss or repeats. A
micro-batch writes folders of its own (`<table>/batch=<n>`) and reads the state that the batch before
it left, so a repeated batch changes nothing.

Streaks, outcomes and profiles run the batch operators on each micro-batch, with a small table as state
(a row for each symbol, open signals, candles of the look-back), so no symbol is ever one group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickloom import config
from tickloom.functions.scalars import pct_change
from tickloom.operators.asof import asof_forward
from tickloom.operators.candles import SPAN, merge_spans, span_candles, spans
from tickloom.operators.outcomes import HORIZONS, verdict
from tickloom.operators.signals import RUN_STATE, continued, profile_of_candles
from tickloom.session import fresh_path
from tickloom.sources.schemas import EVENTS
from tickloom.sources.tables import drop_folder, event_date, folders, retain_recent
from tickloom.sources.ticks import dead_letters, events_as_ticks, parse_trades

LATENESS = "10 seconds"


def file_stream(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream; `files_per_trigger` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1_000_000) -> DataFrame:
    """Raw trade messages from Kafka: `raw` and the broker's time as ingest time (needs Spark's Kafka package)."""
    source = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("maxOffsetsPerTrigger", per_trigger).load()
    )
    return source.select(F.col("value").cast("string").alias("raw"), F.unix_millis("timestamp").alias("ingest_time_ms"))


def tick_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 8) -> DataFrame:
    """The event table replayed as a stream of ticks."""
    return events_as_ticks(file_stream(spark, sf_dir, EVENTS, "events.parquet", files_per_trigger))


def with_event_time(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("event_ts", F.timestamp_millis("event_time_ms")).withWatermark("event_ts", LATENESS)


def once_per_trade(ticks: DataFrame) -> DataFrame:
    """Drop repeated deliveries of a trade within the lateness bound."""
    return ticks.dropDuplicatesWithinWatermark(["symbol", "trade_id"])


@contextmanager
def state_partitions(spark: SparkSession):
    """Start streams with no more state partitions than twice the cores: each holds a state store."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


SPANS = "batch int, last_ms bigint, middle_ms bigint"


class Store:
    """The tables of a job, one folder for each micro-batch."""

    def __init__(self, path: str, batch: int):
        self.path, self.batch = path, batch

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path}/{table}/batch={self.batch}")

    def state(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """What the batch before this one left; nothing before the first."""
        if not self.batch:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/{table}/batch={self.batch - 1}")

    def kept_batches(self, rows: DataFrame, keep_ms: int | None, table: str) -> tuple[list[tuple[int, int]], int | None]:
        """(batch, time of its last event) of the batches of `table` that are still kept, this one (`rows`) included, and the time of
        the last event of all that are gone.

        A batch goes, with its folder, when its last event is more than `keep_ms` behind the newest time. The newest time is the
        latest of the batches' median times, so a wrong stamp here and there drops nothing. One small row a batch is state.
        """
        spark, time = rows.sparkSession, F.col("event_time_ms")
        known = {r["batch"]: (r["last_ms"], r["middle_ms"]) for r in self.state(spark, "spans", SPANS).collect()}  # a row a kept batch
        gone = known.pop(-1, (None, None))[0]
        last, middle = rows.agg(F.max(time), F.percentile_approx(time, 0.5, 1000)).first()
        if last is not None:
            known[self.batch] = (last, middle)
        newest = max((m for _, m in known.values()), default=0)
        old = [] if keep_ms is None else [n for n, (x, _) in known.items() if x < newest - keep_ms]
        for n in old:
            gone = max(known[n][0], known[n][0] if gone is None else gone)
            del known[n]
        left = [(n, *x) for n, x in known.items()] + ([] if gone is None else [(-1, gone, gone)])
        self.write("spans", spark.createDataFrame(left, SPANS).coalesce(1))
        for n in old:
            drop_folder(spark, f"{self.path}/{table}/batch={n}")
        self.forget(spark, "spans")
        return [(n, x) for n, (x, _) in known.items()], gone

    def batches(self, spark: SparkSession, table: str, schema: str, numbers: Sequence[int]) -> DataFrame:
        """The rows of some batches of a table."""
        if not numbers:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.path}/{table}/batch={n}" for n in numbers])

    def forget(self, spark: SparkSession, *tables: str) -> None:
        """State that no repeated batch can ask for any more."""
        for table in tables:
            drop_folder(spark, f"{self.path}/{table}/batch={self.batch - 2}")


def run_batches(
    stream: DataFrame, name: str, work: Callable[[DataFrame, Store], None], path: str | None = None, seconds: int | None = None,
    mode: str = "append",
) -> tuple[str, StreamingQuery]:
    """Hand every micro-batch to `work`; returns the job's folder and the running query.

    Runs over all available input to the end; with `seconds`, for ever in micro-batches of that
    length, and returns at once. On the folder of an earlier run it goes on from there.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, name)

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            work(batch, Store(path, number))
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{path}/progress")
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    with state_partitions(spark):
        query = writer.trigger(**trigger).start()
    if seconds is None:
        query.awaitTermination()
    return path, query


def read_table(spark: SparkSession, path: str, table: str = "rows") -> DataFrame:
    """All batches of a job's table; `batch` tells them apart."""
    return spark.read.option("basePath", f"{path}/{table}").parquet(f"{path}/{table}/batch=*")


def recent_rows(spark: SparkSession, path: str, keep_ms: int, table: str = "rows") -> DataFrame:
    """The rows of a job's table that are at most `keep_ms` older than its newest one."""
    rows = read_table(spark, path, table)
    return retain_recent(rows, rows.agg(F.max("event_time_ms")).scalar(), keep_ms)


def newest_rows(spark: SparkSession, path: str, keys: Sequence[str], table: str = "rows") -> DataFrame:
    """The newest version of each row of a table that is written in update mode."""
    rows = read_table(spark, path, table)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return newest.select(*keys, "_row.*")


def ingest(
    messages: DataFrame, symbols: tuple[str, ...] | None = None, path: str | None = None, seconds: int | None = None,
    keep_ms: int | None = None,
) -> tuple[str, StreamingQuery]:
    """Raw messages into the tick table (`rows`, by symbol and day), optionally only some symbols; the unreadable ones into `dead`.

    With `keep_ms`, batches whose ticks are all older than that are deleted while the stream runs (`recent_rows` reads the rest).
    """

    def work(batch: DataFrame, store: Store) -> None:
        ticks = parse_trades(batch)
        if symbols:
            ticks = ticks.filter(F.col("symbol").isin(*[s.upper() for s in symbols]))
        store.write("rows", ticks.withColumn("date", event_date()), ("symbol", "date"))
        store.write("dead", dead_letters(batch))
        if keep_ms is not None:
            store.kept_batches(ticks, keep_ms, "rows")

    return run_batches(messages, "ticks", work, path, seconds)


def live_candles(ticks: DataFrame, interval: str = "1 second") -> DataFrame:
    """Candles of a tick stream: in append mode once their interval is behind the watermark, in update mode as they grow."""
    order = F.struct("event_time_ms", "id")
    rows = once_per_trade(with_event_time(ticks)).groupBy(F.window("event_ts", interval).alias("w"), "symbol")
    return rows.agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("quantity").alias("volume"), F.count(F.lit(1)).alias("trades"),
    ).select("symbol", F.unix_millis("w.start").alias("time_ms"), "open", "high", "low", "close", "volume", "trades")


def live_counts(enriched: DataFrame, length: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Reversal, continuation and no-edge counts over sliding windows of a stream of enriched events."""
    rows = with_event_time(enriched).groupBy(F.window("event_ts", length, step).alias("w"), "symbol")
    return rows.agg(
        F.count_if(F.col("signal") == "REV_EDGE").alias("rev"),
        F.count_if(F.col("signal") == "CONT_EDGE").alias("cont"),
        F.count_if(F.col("signal") == "NO_EDGE").alias("no_edge"),
    ).select("symbol", F.unix_millis("w.start").alias("start_ms"), "rev", "cont", "no_edge")


def keep_current(rows: DataFrame, name: str, path: str | None = None, seconds: int | None = None) -> tuple[str, StreamingQuery]:
    """Windowed aggregates with their open windows: each batch stores the rows that changed (read them by `newest_rows`)."""
    return run_batches(rows, name, lambda batch, store: store.write("rows", batch), path, seconds, "update")


def streaks(ticks: DataFrame, profile: DataFrame, path: str | None = None, seconds: int | None = None) -> tuple[str, StreamingQuery]:
    """Signal and streak of each tick of a stream.

    A micro-batch is enriched like a table, in even chunks, and goes on from the state before it: a row
    for each symbol with its last price, signal and streak. Ticks count in the order of their batches.
    """

    def work(batch: DataFrame, store: Store) -> None:
        before = store.state(batch.sparkSession, "state", RUN_STATE)
        rows, after = continued(batch.select("id", "symbol", "event_time_ms", "price"), profile, before)
        store.write("rows", rows.filter(F.col("streak").isNotNull()).select("id", "symbol", "event_time_ms", "signal", "streak"))
        store.write("state", after)
        store.forget(batch.sparkSession, "state")

    return run_batches(ticks, "streaks", work, path, seconds)


TICKS = "id bigint, symbol string, event_time_ms bigint, price double"
OPEN = "id bigint, symbol string, signal string, bucket string, price_entry double, horizon string, target_ms bigint"


def outcomes(
    signals: DataFrame, ticks: DataFrame, horizons: dict[str, int] | None = None, keep_ms: int | None = None,
    path: str | None = None, seconds: int | None = None,
) -> tuple[str, StreamingQuery]:
    """Settle signals (symbol, id, event_time_ms, signal, bucket, price_entry) as ticks arrive.

    A micro-batch writes its own ticks and asks, by one as-of pass, for the first tick at or after each open target. It reads
    only the batches of ticks that end at the earliest open target or later: the last ones as a rule, older ones for a late
    signal, and none is written again. State: signals whose horizon has no tick yet, and the time span of each batch.

    With `keep_ms`, batches of ticks older than that are deleted. A target that the deleted ticks might have answered cannot be
    settled rightly any more: it ends as EXPIRED, without a price. A settled outcome stays as it is, whatever ticks come later.
    """
    none = F.lit(None).cast("string")
    as_rows = lambda df, signal, bucket, price: df.select(
        "symbol", "id", "event_time_ms", price.alias("price"), signal.alias("signal"), bucket.alias("bucket"))
    both = as_rows(ticks, none, none, F.col("price")).unionByName(
        as_rows(signals, F.col("signal"), F.col("bucket"), F.col("price_entry")))
    steps = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ms).cast("bigint").alias("ms")) for n, ms in (horizons or HORIZONS).items()])
    result = ["id", "symbol", "signal", "bucket", "price_entry", "horizon"]

    def work(batch: DataFrame, store: Store) -> None:
        spark = batch.sparkSession
        new = batch.filter(F.col("signal").isNull()).select("id", "symbol", "event_time_ms", "price")
        store.write("ticks", new)
        kept, gone = store.kept_batches(new, keep_ms, "ticks")
        waiting = batch.filter(F.col("signal").isNotNull()).withColumn("_h", F.explode(steps)).select(
            "id", "symbol", "signal", "bucket", F.col("price").alias("price_entry"), F.col("_h.name").alias("horizon"),
            (F.col("event_time_ms") + F.col("_h.ms")).alias("target_ms"))
        asked = store.state(spark, "open", OPEN).unionByName(waiting)
        lost = F.lit(False) if gone is None else F.col("target_ms") <= gone
        expired = asked.filter(lost).withColumns({"price": F.lit(None).cast("double"), "result": F.lit("EXPIRED")})
        asked = asked.filter(~lost)
        earliest = asked.agg(F.min("target_ms")).first()[0]
        tape = store.batches(spark, "ticks", TICKS, [n for n, last in kept if earliest is not None and last >= earliest])
        found = asof_forward(asked, tape).persist()
        threshold = config.keyed_case(F.col("bucket"), config.OUTCOME_THRESHOLD, config.DEFAULT_THRESHOLD)
        move: Column = F.coalesce(pct_change(F.col("found_price"), F.col("price_entry")), F.lit(0.0))
        settled = found.filter(F.col("found_ms").isNotNull()).withColumns({
            "price": F.col("found_price"), "result": verdict(F.col("signal"), move, threshold)})
        store.write("rows", settled.select(*result, "price", "result").unionByName(expired.select(*result, "price", "result")))
        store.write("open", found.filter(F.col("found_ms").isNull()).select(*asked.columns))
        found.unpersist()
        store.forget(spark, "open")

    return run_batches(both, "outcomes", work, path, seconds)


def outcome_rows(spark: SparkSession, path: str) -> DataFrame:
    """Settled outcomes, and those still open as PENDING without a price."""
    settled = read_table(spark, path).drop("batch")
    newest = max(int(f.removeprefix("batch=")) for f in folders(spark, f"{path}/open/batch=*"))  # it may hold no rows
    left = spark.read.schema(OPEN).parquet(f"{path}/open/batch={newest}")
    pending = left.withColumns({"price": F.lit(None).cast("double"), "result": F.lit("PENDING")})
    return settled.unionByName(pending.select(settled.columns))


def profiles(ticks: DataFrame, lookback_ms: int = 7_200_000, path: str | None = None, seconds: int | None = None) -> tuple[str, StreamingQuery]:
    """Keep the percentile profile current, one version for each micro-batch.

    State: 1-second candles of the look-back, which merge (first and last price with their order, number of
    trades). The look-back is in whole seconds.
    """

    def work(batch: DataFrame, store: Store) -> None:
        spark = batch.sparkSession
        merged = merge_spans(store.state(spark, "candles", SPAN).unionByName(spans(batch)))
        newest = merged.agg(F.max("last.event_time_ms")).scalar()
        store.write("candles", merged.filter(F.col("time_ms") >= newest - lookback_ms))
        candles = spark.read.schema(SPAN).parquet(f"{store.path}/candles/batch={store.batch}")
        store.write("rows", profile_of_candles(span_candles(candles)))
        store.forget(spark, "candles")

    return run_batches(ticks, "profile", work, path, seconds)
