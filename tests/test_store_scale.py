"""The passes behind the feature store: what they exchange, and their exactness for any cut into chunks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import features, layout, learning


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_exchanges_no_arrays_and_no_tape_twice(ticks):
    plan = plan_of(learning.feature_store(ticks))
    assert "collect_list" not in plan and "decimal(38,18)" not in plan
    assert "_rn#" in plan and not any("hashpartitioning(symbol" in line and "_chunk" in line and "_rn" in line.split("hashpartitioning", 1)[1].split("ENSURE")[0]
                                      for line in plan.splitlines())


@pytest.mark.parametrize("size", [256, 8_192])
def test_store_of_crowded_milliseconds_is_the_brute_force(tape, monkeypatch, size):
    from tickloom.operators import sampled

    rng = np.random.default_rng(5)
    times = np.sort(rng.integers(0, 12, 1_500)) * 1_000  # some hundred ticks in each of a few milliseconds
    moves = [(int(t), None if k % 97 == 5 else float(100 + rng.integers(-20, 20) / 8), float(rng.integers(1, 100)) / 10) for k, t in enumerate(times)]
    ticks = tape([(t, p or 0.0, q) for t, p, q in moves]).withColumn("price", F.when(F.pmod("id", F.lit(97)) != 6, F.col("price")))
    monkeypatch.setattr(sampled, "RANK_CHUNK", size)
    monkeypatch.setattr(features, "RANK_CHUNK", size)
    rows = sorted(ticks.collect(), key=lambda r: (r["event_time_ms"], r["id"]))
    t, p, q = ([r[c] for r in rows] for c in ("event_time_ms", "price", "quantity"))
    got = {r["id"]: r for r in learning.feature_store(ticks).collect()}
    path = {r["id"]: r for r in sampled.sampled_rows(ticks, past=False).collect()}
    sampled_at = range(100, len(rows), 10)
    assert set(got) == {rows[k]["id"] for k in sampled_at}
    for k in sampled_at:
        row, first = got[rows[k]["id"]], t.index(t[k])
        ahead = [j for j in range(first, min(first + 200, len(rows))) if t[j] <= t[k] + 60_000]
        prices = [p[j] for j in ahead if p[j] is not None]
        found = path[rows[k]["id"]]
        assert (found["path_ticks"], found["highest"], found["lowest"]) == (len(ahead), max(prices), min(prices))
        assert row["trade_rate_1m"] == sum(t[j] >= t[k] - 60_000 for j in range(max(0, k - 200), k))
        pairs = [(p[j - 1], p[j]) for j in range(k - 99, k)]
        moved = sorted(abs(b - a) / a * 100 for a, b in pairs if a is not None and b is not None and a > 0)
        assert abs(row["volatility_1m"] - np.std(moved)) < 2e-8
        window = [j for j in range(first) if t[j] >= t[k] - 2_000]
        if len(window) >= 3:
            signed = sum(np.sign(p[j] - p[j - 1]) * q[j] for j in window[1:] if p[j] is not None and p[j - 1] is not None)
            assert abs(row["imbalance_20"] - signed / sum(q[j] for j in window[1:])) < 1e-6
    assert layout.RANK_CHUNK == 8_192


def test_spec_windows_do_not_depend_on_chunks(tape, monkeypatch):
    from tickloom.operators import featurespec

    rng = np.random.default_rng(3)
    times = np.cumsum(rng.integers(0, 900, 400))
    ticks = tape([(int(t), float(100 + rng.integers(-9, 9)), 0.5, "ETHUSDT") for t in times])
    profile = ticks.sparkSession.createDataFrame([("ETHUSDT", 0.0, 0.0, 0.0)], "symbol string, p75 double, p90 double, p99 double")
    whole = sorted(map(tuple, featurespec.spec_features(ticks, profile).collect()), key=str)
    monkeypatch.setattr(featurespec, "RANK_CHUNK", 64)
    assert len(whole) > 300 and sorted(map(tuple, featurespec.spec_features(ticks, profile).collect()), key=str) == whole
