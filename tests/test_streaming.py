"""Streams replayed in several micro-batches give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import candles, outcomes, signals
from tickloom.sources import tables
from tickloom.sources import ticks as src
from tickloom.streaming import jobs


@pytest.fixture(scope="module")
def parts(ticks):
    """The ticks in four pieces, in time order."""
    start, end = ticks.agg(F.min("event_time_ms"), F.max("event_time_ms")).first()
    step = (end - start) // 4 + 1
    return [ticks.filter(F.col("event_time_ms").between(start + i * step, start + (i + 1) * step - 1)) for i in range(4)]


def put(path, *frames):
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def pieces(parts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pieces"))
    put(path, *parts)
    return path


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_streaks_go_on_after_a_stop(spark, ticks, parts, tmp_path):
    """Two files, a stop, two more files: no tick is lost or repeated, and streaks run through."""
    source, job = str(tmp_path / "in"), str(tmp_path / "job")
    profile = signals.pct_profile(ticks)
    for pair in (parts[:2], parts[2:]):
        put(source, *pair)
        jobs.streaks(jobs.file_stream(spark, source, ticks.schema, files_per_trigger=1), profile, job)
    got = jobs.read_table(spark, job)
    assert got.select("batch").distinct().count() == 4
    want = signals.enriched_events(ticks, profile).filter("streak is not null")
    assert rows_of(got, "id", "signal", "streak") == rows_of(want, "id", "signal", "streak")


def test_a_repeated_batch_changes_nothing(spark, ticks, parts, tmp_path):
    profile, path = signals.pct_profile(ticks), str(tmp_path / "job")
    works = []

    def catch(stream, name, work, *rest):
        works.append(work)
        return path, None

    whole = jobs.run_batches
    try:
        jobs.run_batches = catch
        jobs.streaks(None, profile)
    finally:
        jobs.run_batches = whole
    for number in (0, 1, 1, 2):
        works[0](parts[number], jobs.Store(path, number))
    want = signals.enriched_events(parts[0].unionByName(parts[1]).unionByName(parts[2]), profile).filter("streak is not null")
    assert rows_of(jobs.read_table(spark, path), "id", "streak") == rows_of(want, "id", "streak")


def settled(spark, ticks, waiting, now):
    whole = outcomes.resolve_outcomes(waiting, ticks, now)
    return sorted((r["id"], h, r[h], r[f"result_{h[6:]}"]) for r in whole.collect() for h in ("price_10s", "price_30s"))


def test_outcomes_of_late_signals(spark, ticks, pieces, parts, tmp_path):
    """Signals of each piece arrive one micro-batch after its ticks, most of them after their horizon."""
    enriched = signals.enriched_events(ticks)
    waiting = signals.record_signals(enriched, 0.35).cache()
    path = str(tmp_path / "signals")
    put(path, waiting.limit(0), *[waiting.join(p.select("symbol", "id"), ["symbol", "id"]) for p in parts])
    job, _ = jobs.outcomes(
        jobs.file_stream(spark, path, waiting.schema, files_per_trigger=1),
        jobs.file_stream(spark, pieces, ticks.schema, files_per_trigger=1))
    got = jobs.outcome_rows(spark, job)
    key = lambda r: (r[0], r[1])
    assert sorted(((r["id"], r["horizon"], r["price"], r["result"]) for r in got.collect()), key=key) == settled(spark, ticks, waiting, 1 << 50)
    assert got.filter("result = 'PENDING' and price is null").count() > 0
    assert jobs.read_table(spark, job, "open").select("batch").distinct().count() <= 2  # old state is gone


def test_a_late_tick_does_not_reopen_an_outcome(spark, tape, tmp_path):
    ticks, sigs = str(tmp_path / "t"), str(tmp_path / "s")
    signal = tape([(0, 100.0)]).select("id", "symbol", "event_time_ms", F.lit("CONT_EDGE").alias("signal"), F.lit("MEDIUM").alias("bucket"), F.col("price").alias("price_entry"))
    put(ticks, tape([(0, 100.0), (9_000, 101.0)]), tape([(8_500, 90.0), (20_000, 95.0)], first_id=10), tape([(40_000, 99.0)], first_id=20))
    put(sigs, signal)
    job, _ = jobs.outcomes(jobs.file_stream(spark, sigs, signal.schema), jobs.file_stream(spark, ticks, tape([(0, 1)]).schema, files_per_trigger=1))
    got = {r["horizon"]: (r["price"], r["result"]) for r in jobs.outcome_rows(spark, job).collect()}
    assert got == {"price_10s": (101.0, "WIN"), "price_30s": (99.0, "LOSS")}


@pytest.mark.parametrize("keep_ms", [None, 7_200_000, 300_000])
def test_a_signal_that_comes_20_minutes_late(spark, tape, tmp_path, keep_ms):
    """It settles on the first tick after its horizon, whatever has come since, or is EXPIRED if that tick may be deleted."""
    ticks, sigs = str(tmp_path / "t"), str(tmp_path / "s")
    minute = 60_000
    signal = tape([(0, 100.0)]).select("id", "symbol", "event_time_ms", F.lit("CONT_EDGE").alias("signal"), F.lit("MEDIUM").alias("bucket"), F.col("price").alias("price_entry"))
    batches = [[(0, 100.0), (9_000, 101.0), (29_000, 90.0)], [(10 * minute, 50.0)], [(19 * minute, 55.0)], [(20 * minute, 60.0), (20 * minute + 1, 61.0)]]
    put(ticks, *[tape(b, first_id=10 * k + 1) for k, b in enumerate(batches)])
    put(sigs, *[signal.limit(0)] * 3, signal)
    job, _ = jobs.outcomes(
        jobs.file_stream(spark, sigs, signal.schema, files_per_trigger=1),
        jobs.file_stream(spark, ticks, tape([(0, 1)]).schema, files_per_trigger=1), keep_ms=keep_ms)
    got = {r["horizon"]: (r["price"], r["result"]) for r in jobs.outcome_rows(spark, job).collect()}
    if keep_ms == 300_000:
        assert got == {"price_10s": (None, "EXPIRED"), "price_30s": (None, "EXPIRED")}
    else:
        assert got == {"price_10s": (101.0, "WIN"), "price_30s": (90.0, "LOSS")}
    kept = jobs.read_table(spark, job, "ticks").select("batch").distinct().count()
    assert kept == (2 if keep_ms == 300_000 else 4)  # each batch's ticks are written once, and old ones deleted


def test_a_running_stream_keeps_two_hours(spark, tape, tmp_path):
    """Eight batches over four hours, one of them with a time stamp in microseconds: the last two hours stay."""
    path, half = str(tmp_path / "raw"), 1_800_000
    tapes = [tape([(k * half + x * 60_000, 10.0 + k) for x in range(30)], first_id=100 * k + 1) for k in range(8)]
    wrong = tape([(0, 1.0)], start=1_704_067_200_000_000, first_id=9_999)
    put(path, *[src.as_messages(t) for t in tapes[:4]], src.as_messages(tapes[4].unionByName(wrong)), *[src.as_messages(t) for t in tapes[5:]])
    schema = src.as_messages(tapes[0]).schema
    job, _ = jobs.ingest(jobs.file_stream(spark, path, schema, files_per_trigger=1), keep_ms=7_200_000)
    stored = jobs.read_table(spark, job)
    held = {r["price"] for r in stored.select("price").distinct().collect()}
    assert held == {1.0, 13.0, 14.0, 15.0, 16.0, 17.0}  # batches 3 to 7 reach into the last two hours; the wrong stamp drops nothing
    right = stored.filter("price > 1")
    assert tables.retain_recent(right, right.agg(F.max("event_time_ms")).scalar(), 7_200_000).count() == 121


def test_repeats_and_late_rows(spark, tape, tmp_path):
    path = str(tmp_path / "late")
    repeat = tape([(0, 10)]).unionByName(tape([(40_000, 12)], first_id=3))
    late = tape([(60_000, 13)], first_id=5).unionByName(tape([(5, 99)], first_id=9))
    put(path, tape([(0, 10), (20_000, 11)]), repeat, late)
    job, _ = jobs.keep_current(jobs.live_candles(jobs.file_stream(spark, path, repeat.schema, files_per_trigger=1)), "candles")
    rows = jobs.newest_rows(spark, job, ["symbol", "time_ms"]).orderBy("time_ms").collect()
    # the row behind the watermark (price 99) and the repeated trade change no candle; the open one is there
    assert [(r["open"], r["high"], r["trades"]) for r in rows] == [(10.0, 10.0, 1), (11.0, 11.0, 1), (12.0, 12.0, 1), (13.0, 13.0, 1)]


def test_profile_per_batch(spark, ticks, pieces):
    job, _ = jobs.profiles(jobs.file_stream(spark, pieces, ticks.schema, files_per_trigger=1))
    runs = jobs.read_table(spark, job)
    last = runs.filter(F.col("batch") == 3)
    columns = ["symbol", "p75", "p90", "p99", "n"]
    assert rows_of(last, *columns) == rows_of(signals.pct_profile(ticks), *columns)


def test_candles_merge(ticks, parts):
    merged = candles.merge_spans(candles.spans(parts[0].unionByName(parts[2])).unionByName(candles.spans(parts[1].unionByName(parts[3]))))
    columns = ["symbol", "time_ms", "open", "close", "trades"]
    assert rows_of(candles.span_candles(merged), *columns) == rows_of(candles.candles(ticks), *columns)


def test_ingest_keeps_wanted_symbols_and_dead_letters(spark, ticks, tmp_path):
    path = str(tmp_path / "raw")
    messages = src.as_messages(ticks)
    broken = messages.limit(2).withColumn("raw", F.lit("{broken"))
    put(path, messages, broken)
    job, query = jobs.ingest(jobs.file_stream(spark, path, messages.schema, files_per_trigger=1), ("btcusdt",))
    assert not query.isActive and query.exception() is None
    out = jobs.read_table(spark, job)
    assert {r[0] for r in out.select("symbol").distinct().collect()} == {"BTCUSDT"}
    assert out.count() == ticks.filter("symbol = 'BTCUSDT'").count()
    assert [r["raw"] for r in jobs.read_table(spark, job, "dead").collect()] == ["{broken"] * 2


def test_old_days_are_dropped(spark, tape, tmp_path):
    day = 86_400_000
    path = str(tmp_path / "table")
    ticks = tape([(k * day, 1.0) for k in range(4)]).withColumn("date", tables.event_date())
    tables.append_rows(ticks, path, ("symbol", "date"))
    now = 1_704_067_200_000 + 3 * day
    gone = tables.drop_old_days(spark, path, now, day)
    assert [g[-10:] for g in gone] == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).count() == 2 == tables.retain_recent(ticks, now, day).count()


def test_retained_messages_are_written_by_all_tasks(spark, sf_dir, tmp_path, monkeypatch):
    from tickloom.plans import catalog

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    made = []
    monkeypatch.setattr(catalog, "fresh_path", lambda s, name: made.append(str(tmp_path / name)) or made[-1])
    got = catalog.QUERIES["stream_retention"](spark, str(tmp_path))
    files = spark.read.parquet(made[0]).inputFiles()
    assert len(files) > 8  # eight micro-batches, each of several files
    assert got.count() == spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type <> 'signup'").count()
