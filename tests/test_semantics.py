"""Small hand-made tapes: every branch and guard with its expected value."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions import series
from tickloom.operators import backtest, candles, events, features, featurespec, labels, learning, outcomes, signals, spikes
from tickloom.sources import tables
from tickloom.sources import ticks as src

START = 1_704_067_200_000


def test_candle_ends_by_id_and_gaps(tape):
    rows = candles.candles(tape([(0, 10), (0, 11), (2_500, 12)])).orderBy("time_ms").collect()
    assert [(r["open"], r["close"], r["trades"]) for r in rows] == [(10.0, 11.0, 2), (12.0, 12.0, 1)]
    assert [r["time_ms"] - START for r in rows] == [0, 2_000]


def test_candle_lookahead_counts_candles(tape):
    ticks = tape([(i * 3_000, 100 + i) for i in range(12)])
    rows = spikes.candle_class(ticks).orderBy("time_ms").collect()
    assert [r["close_ahead"] for r in rows] == [110.0, 111.0]


def test_profile_needs_ticks_and_candles(tape):
    few = tape([(i * 1_000, 100 + i % 3) for i in range(99)])
    assert signals.pct_profile(few).count() == 0
    assert signals.pct_profile(tape([(i * 100, 100 + i % 3) for i in range(190)])).count() == 0
    assert signals.pct_profile(tape([(i * 1_000, 100 + i % 3) for i in range(100)])).first()["n"] == 100
    assert signals.enriched_events(few).select("signal").distinct().collect()[0][0] == "NO_DATA"


def test_bucket_bounds_belong_to_the_larger(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 2.0, 3.0)], "m double")
    got = [r[0] for r in df.select(signals.size_bucket(F.col("m"), F.lit(1.0), F.lit(2.0), F.lit(3.0))).collect()]
    assert got == ["SMALL", "MEDIUM", "LARGE", "EXTREME"]


def profile_of(spark, p75, p90, p99, symbol="BTCUSDT"):
    return spark.createDataFrame(
        [(symbol, p75, p90, p99, 0.1, 0.0, 100)],
        "symbol string, p75 double, p90 double, p99 double, mean double, std double, n long")


def test_streaks_and_confidence(spark, tape):
    # BTCUSDT: a small move is REV_EDGE, a large one NO_EDGE
    prices, p = [100.0], 100.0
    for big in [0, 0, 0, 1, 0, 0] + [0] * 12:
        p += 1.5 if big else 0.1
        prices.append(p)
    got = signals.enriched_events(tape([(i * 10, q) for i, q in enumerate(prices)]), profile_of(spark, 0.5, 1.0, 2.0))
    rows = got.orderBy("event_time_ms").collect()
    assert rows[0]["signal"] == "NO_DATA" and rows[0]["streak"] is None and rows[0]["confidence"] == 0.0
    assert [r["streak"] for r in rows[1:]] == [1, 2, 3, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 10, 10, 10]
    assert [r["confidence"] for r in rows[1:8]] == [0.35, 0.39, 0.43, 0.8, 0.35, 0.39, 0.43]
    assert rows[-1]["confidence"] == 0.5
    assert rows[4]["classification"] == "NOISE_LARGE" and rows[1]["classification"] == "REV_EDGE_SMALL"
    assert {r["zscore"] for r in rows[1:]} == {0.0}


def test_streak_crosses_chunks(spark, tape, monkeypatch):
    from tickloom.operators import layout

    ticks = tape([(i * 10, 100 + (i % 7) * 0.2 + (i % 11 == 0)) for i in range(400)])
    profile = profile_of(spark, 0.3, 0.9, 1.1)
    want = sorted(map(tuple, signals.enriched_events(ticks, profile).select("id", "signal", "streak").collect()))
    for f in (layout.rank_chunks, layout.per_symbol_to_rank_chunks):
        monkeypatch.setattr(f, "__defaults__", tuple(100 if d == layout.RANK_CHUNK else d for d in f.__defaults__))
    assert sorted(map(tuple, signals.enriched_events(ticks, profile).select("id", "signal", "streak").collect())) == want


def test_streak_over_unpriced_ticks(spark, tape, monkeypatch):
    """A run goes on over any number of rows that carry no signal, and over chunks without any."""
    from tickloom.operators import layout

    ticks = tape([(i * 10, 100 * 1.02**i) for i in range(20)] + [(200 + i * 10, 100.0) for i in range(150)] + [(2_000 + i * 10, 100 * 1.02**i) for i in range(20)])
    gap = F.col("event_time_ms").between(1_704_067_200_200, 1_704_067_201_990)
    ticks = ticks.withColumn("price", F.when(~gap, F.col("price")))
    profile = profile_of(spark, 0.3, 0.9, 1.1)
    for f in (layout.rank_chunks, layout.per_symbol_to_rank_chunks):
        monkeypatch.setattr(f, "__defaults__", tuple(16 if d == layout.RANK_CHUNK else d for d in f.__defaults__))
    rows = signals.enriched_events(ticks, profile).orderBy("_rn").collect()
    assert {r["signal"] for r in rows[20:171]} == {"NO_DATA"} and {r["bucket"] for r in rows[20:171]} == {None}
    assert [r["streak"] for r in rows[1:20]] == [min(k, 10) for k in range(1, 20)]
    assert [r["streak"] for r in rows[171:]] == [10] * 19
    assert signals.record_signals(signals.enriched_events(ticks, profile)).filter(gap).count() == 0


def test_enrichment_goes_on(spark, ticks):
    profile = signals.pct_profile(ticks)
    cut = ticks.agg(F.expr("percentile(event_time_ms, 0.4)")).first()[0]
    cols = ["symbol", "id", "spike_pct", "signal", "streak", "confidence"]
    state = spark.createDataFrame([], signals.RUN_STATE)
    got = []
    for part in (ticks.filter(F.col("event_time_ms") < cut), ticks.filter(F.col("event_time_ms") >= cut)):
        rows, state = signals.continued(part, profile, state)
        got += rows.select(cols).collect()
        state = spark.createDataFrame(state.collect(), signals.RUN_STATE)
    whole = signals.enriched_events(ticks, profile).select(cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))


def test_newest_enrichment_equals_the_whole(ticks):
    profile = signals.pct_profile(ticks)
    cols = ["id", "spike_pct", "signal", "confidence", "streak"]
    part = {tuple(r) for r in signals.latest_enriched(ticks, profile, 20).select(cols).collect()}
    whole = signals.newest_per_symbol(signals.enriched_events(ticks, profile), 20).select(cols)
    assert part == {tuple(r) for r in whole.collect()}


def test_recording_gate_and_no_repeats(spark):
    rows = [(1, "BTCUSDT", 1.0, START, "REV_EDGE", "MEDIUM", 0.62), (2, "BTCUSDT", 1.0, START, "REV_EDGE", "MEDIUM", 0.619),
            (3, "BTCUSDT", 1.0, START, "NO_EDGE", "LARGE", 0.8), (4, "BTCUSDT", 1.0, START, "REV_EDGE", "SMALL", 0.7)]
    enriched = spark.createDataFrame(
        rows, "id long, symbol string, price double, event_time_ms long, signal string, bucket string, confidence double")
    recorded = signals.record_signals(enriched)
    assert [(r["id"], r["result_10s"]) for r in recorded.collect()] == [(1, "PENDING")]
    assert signals.new_signals(recorded, recorded).count() == 0


@pytest.mark.parametrize("signal, price, want", [
    ("REV_EDGE", 99.0, "WIN"), ("REV_EDGE", 101.0, "LOSS"), ("CONT_EDGE", 101.0, "WIN"), ("CONT_EDGE", 99.0, "LOSS"),
    ("REV_EDGE", 100.0, "NEUTRAL"), ("NO_EDGE", 120.0, "NEUTRAL"), ("REV_EDGE", None, "PENDING"),
])
def test_outcome_verdicts(spark, signal, price, want):
    df = spark.createDataFrame([(signal, "MEDIUM", 100.0, price, price)],
                               "signal string, bucket string, price_entry double, price_10s double, price_30s double")
    assert outcomes.resolve_priced(df).first()["result_10s"] == want


def test_outcome_bounds_are_strict(spark):
    df = spark.createDataFrame([(m,) for m in (-1.0, -0.5, -0.4, 1.0)], "move double")
    got = [r[0] for r in df.select(outcomes.verdict(F.lit("REV_EDGE"), F.col("move"), F.lit(1.0))).collect()]
    assert got == ["LOSS", "LOSS", "NEUTRAL", "LOSS"]


def test_exit_at_the_horizon_and_open_positions(spark, tape):
    ticks = tape([(0, 100), (30_000, 110), (31_000, 120)])
    entries = ticks.select("symbol", "id", "event_time_ms", "price", F.lit(1.0).alias("pct"), F.lit("up").alias("direction"),
                           F.lit(5).cast("long").alias("latency_ms"))
    rows = backtest.follow_trades(entries, ticks, (30,), fee=0.0).collect()
    assert [(r["id"], r["exit_price"], round(r["net_pnl_pct"], 9)) for r in rows] == [(1, 110.0, 10.0)]


def trades_of(spark, pnls, step=1_000):
    rows = [(i, "S", START + i * step, float(p), p > 0, 1_000, 5) for i, p in enumerate(pnls)]
    return spark.createDataFrame(
        rows, "id long, symbol string, event_time_ms long, net_pnl_pct double, win boolean, hold_ms long, latency_ms long")


@pytest.mark.parametrize("step", [1_000, 4_000_000])
def test_drawdown_over_slots(spark, step):
    assert backtest.max_drawdown(trades_of(spark, [1, -2, 0.5, -1.0], step)).first()["max_drawdown"] == 2.5
    assert backtest.max_drawdown(trades_of(spark, [-1.0, -1.0, 5.0], step)).first()["max_drawdown"] == 2.0
    assert backtest.max_drawdown(trades_of(spark, [1.0, 2.0], step)).first()["max_drawdown"] == 0.0


def test_payoff_is_null_without_losses(spark):
    assert backtest.trade_stats(trades_of(spark, [1.0, 2.0])).first()["profit_factor"] is None
    row = backtest.trade_stats(trades_of(spark, [1.0, -2.0])).first()
    assert (row["profit_factor"], row["winners"], row["losers"], row["win_rate_pct"]) == (0.5, 1, 1, 50.0)


def test_no_spikes_means_an_empty_report(tape):
    row = backtest.backtest_report(tape([(i * 1_000, 100) for i in range(30)])).first()
    assert (row["events_loaded"], row["spikes_detected"], row["verdict"]) == (30, 0, "NO_TRADES")
    assert backtest.backtest_report(tape([(i, 100) for i in range(19)])).count() == 0
    with pytest.raises(ValueError):
        backtest.backtest_report(tape([(0, 1)]), hold=1)


def test_results_table_row(spark, tape):
    report = backtest.backtest_report(tape([(i * 1_000, 100 + (i % 20 == 5) * 3) for i in range(90)]))
    row = backtest.result_rows(report, "2024-01-01T00:00:00+00:00", 30, 2.0, 0.01).first()
    assert json.loads(row["params"])["hold_seconds"] == 30
    assert "win_rate_pct" in json.loads(row["stats"])


@pytest.mark.parametrize("prices, roll, flips", [
    (list(range(9)), 0.0, 0.0), ([5.0] * 20, 0.0, 0.0), ([1.0, 2.0] * 10, 2.0, 1.0),
])
def test_spread_of_series(spark, prices, roll, flips):
    df = spark.createDataFrame([([float(p) for p in prices],)], "p array<double>")
    row = df.select(series.roll_spread(F.col("p")), series.flip_rate(F.col("p"))).first()
    assert row[1] == flips and (row[0] == roll or (roll and row[0] > 0))


def test_path_needs_five_ticks_and_stops_at_200(tape):
    lead = [(i, 100.0) for i in range(100)]
    short = tape([*lead, (100_000, 100), (100_001, 101), (100_002, 101), (100_003, 101)])
    assert labels.path_label(short).count() == 0
    long = tape([*lead, *[(100_000 + i, 100.0 if i < 200 else 150.0) for i in range(250)]])
    first = labels.path_label(long).orderBy("event_time_ms").first()
    assert (first["path_ticks"], first["max_return"], first["micro_label"]) == (200, 0.0, "NOISE")


def test_path_starts_at_the_first_tick_of_the_millisecond(tape):
    # the sampled tick (number 101) shares its millisecond with the two before it
    rows = [(i, 100.0) for i in range(98)] + [(500, 90.0), (500, 95.0), (500, 100.0)] + [(600 + i, 100.0) for i in range(5)]
    row = labels.path_label(tape(rows)).orderBy("event_time_ms").first()
    assert (row["path_ticks"], row["min_return"]) == (8, -10.0)


@pytest.mark.parametrize("up, down, want", [
    (0.5, -0.01, "CONTINUATION_UP"), (0.01, -0.5, "CONTINUATION_DOWN"), (0.05, -0.05, "NOISE"), (0.5, -0.5, "ABSORPTION")])
def test_path_classes(spark, up, down, want):
    assert spark.range(1).select(labels.path_label_of(F.lit(up), F.lit(down), 0.1)).first()[0] == want


def test_order_flow_needs_three_ticks(tape):
    quiet = [(i * 10, 100 + i % 2) for i in range(100)] + [(50_000, 100), (51_000, 101)]
    row = features.orderflow_features(tape(quiet)).orderBy("event_time_ms").first()
    assert row["imbalance_20"] is None and row["burst_1s"] is None
    zero = [(i * 10, 100 + i % 2, 0.0) for i in range(120)]
    row = features.orderflow_features(tape(zero)).orderBy("event_time_ms").first()
    assert (row["imbalance_20"], row["vol_ratio"]) == (0.0, row["vol_ratio"])


def test_spec_guards():
    from tickloom import config

    leaky = {**config.ETH_FLOW_SPEC, "features": [{"name": "retrace_ratio", "normalize": False}]}
    with pytest.raises(ValueError, match="future"):
        featurespec.check_spec(leaky)
    assert [featurespec.duration_ms(x) for x in ("250ms", "1s", "5m")] == [250, 1_000, 300_000]


def test_dataset_refuses_leaky_inputs(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="future"):
        learning.dataset(df, ["decay_500ms"])


MESSAGES = [
    '{"e":"trade","s":"BTCUSDT","p":"78500.10","q":"0.0150","T":1777652538994,"t":1001,"m":true}',
    '{"e":"aggTrade","s":"BTCUSDT","p":"1","q":"1","T":1,"t":1,"m":true}',
    '{"e":"trade","s":"BTCUSDT","q":"1","T":1,"t":1,"m":true}',
    '{broken',
    '{"e":"trade","s":"BTCUSDT","p":"abc","q":"1","T":1,"t":1,"m":true}',
]


def test_messages(spark):
    df = spark.createDataFrame([(m, 7) for m in MESSAGES], "raw string, ingest_time_ms long")
    row = src.parse_trades(df).collect()
    assert len(row) == 1 and row[0]["raw"] == MESSAGES[0]
    assert (row[0]["price"], row[0]["quantity"], row[0]["event_time_ms"], row[0]["trade_id"], row[0]["is_buyer_maker"]) == (
        78500.10, 0.015, 1777652538994, 1001, True)
    assert sorted(r["raw"] for r in src.dead_letters(df).collect()) == sorted(MESSAGES[2:])


def test_arguments(ticks):
    with pytest.raises(ValueError):
        events.replay(ticks, 5, 5)
    with pytest.raises(ValueError):
        events.events_latest(ticks, 0)
    with pytest.raises(ValueError):
        candles.metrics_1min(ticks, 0, 0)


def test_tables(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    tables.write_ticks(ticks, path)
    tables.write_ticks(ticks.limit(10), path)
    assert spark.read.parquet(path).count() == ticks.count() + 10
    out = str(tmp_path / "outcomes")
    row = spark.createDataFrame([("BTCUSDT", "REV_EDGE", "MEDIUM", 0.73, 78500.0, 1777652538994)],
                                "symbol string, signal string, bucket string, confidence double, price_entry double, event_time_ms long")
    tables.append_rows(row, out)
    tables.append_rows(row, out)
    assert spark.read.parquet(out).count() == 2
    tables.replace_table(row, out)
    assert tables.read_features(spark, out, ["signal"], F.col("confidence") > 0.7).first()[0] == "REV_EDGE"
    tables.truncate_table(spark, out)
    assert spark.read.parquet(out).count() == 0 and spark.read.parquet(out).columns == row.columns
    assert not tables.table_exists(spark, "nowhere")
    now = ticks.agg(F.max("event_time_ms")).first()[0]
    assert tables.retain_recent(ticks, now, 0).count() >= 1


def test_invariants(ticks):
    bad = candles.candles(ticks).filter("low > open or low > close or high < open or high < close")
    assert bad.count() == 0
    shares = labels.label_distribution(candles.candles(ticks).withColumn("l", F.col("trades") % 3), "l")
    assert abs(sum(r["pct"] for r in shares.collect()) - 100) < 0.3


def test_filters_and_columns_reach_the_scan(spark, ticks, tmp_path):
    path = str(tmp_path / "stored")
    tables.write_ticks(ticks, path)
    stored = spark.read.parquet(path)
    plan = events.replay(stored, START, START + 1, symbol="btcusdt")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "GreaterThanOrEqual(event_time_ms" in plan
    narrow = candles.candles(stored).select("symbol", "time_ms", "high")._jdf.queryExecution().executedPlan().toString()
    assert "quantity" not in narrow
