"""Chunked, ranked and as-of operators against brute force and against themselves with other cuts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions import ranks
from tickloom.functions.ranks import exact_ranks, nearest_ranks
from tickloom.operators import asof, extremes, features, labels, layout


@pytest.fixture(scope="module")
def crowd(spark):
    """Two symbols; one holds most rows, and a third of all rows share two seconds."""
    rnd = random.Random(7)
    start, rows = 1_704_067_200_000, []
    for i in range(3_000):
        if i % 3 == 0:
            t = start + 200_000 + rnd.randrange(2_000)
        else:
            t = start + rnd.randrange(900_000)
        rows.append((i, "HOT" if i % 5 else "COLD", t, 100 + rnd.random(), float(rnd.randrange(4))))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, symbol string, event_time_ms long, price double, quantity double")


def by_symbol(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_is_the_row_number(crowd, hot_rows, descending):
    rows, df = crowd
    want = {}
    for group in by_symbol(rows).values():
        for n, r in enumerate(reversed(group) if descending else group, 1):
            want[r[0]] = (n, len(group))
    got = layout.with_rank(df, descending=descending, hot_rows=hot_rows).collect()
    assert {r["id"]: (r["_rn"], r["_n"]) for r in got} == want


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_previous_tick(crowd, hot_rows):
    rows, df = crowd
    want = {}
    for group in by_symbol(rows).values():
        for before, r in zip([None, *group], group):
            want[r[0]] = before and (before[3], before[2])
    got = layout.with_previous(df, ("price", "event_time_ms"), hot_rows=hot_rows).collect()
    assert {r["id"]: r["prev_price"] and (r["prev_price"], r["prev_event_time_ms"]) for r in got} == want


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
@pytest.mark.parametrize("horizon", [0, 10_000, 700_000])
def test_asof_is_the_first_later_tick(crowd, hot_rows, horizon):
    rows, df = crowd
    groups = by_symbol(rows)
    want = {}
    for r in rows:
        later = next((x for x in groups[r[1]] if x[2] >= r[2] + horizon), None)
        want[r[0]] = later and (later[2], later[3])
    probes = df.select("symbol", "id", (F.col("event_time_ms") + horizon).alias("target_ms"))
    got = asof.asof_forward(probes, df, offsets=(horizon,), hot_rows=hot_rows).collect()
    assert {r["id"]: r["found_ms"] and (r["found_ms"], r["found_price"]) for r in got} == want


def test_asof_crosses_empty_slots(tape):
    ticks = tape([(0, 10), (5 * 60_000 + 7, 11), (9 * 60_000, 12)])
    probes = ticks.select("symbol", "id", (F.col("event_time_ms") + 1).alias("target_ms"))
    got = {r["id"]: r["found_price"] for r in asof.asof_forward(probes, ticks).collect()}
    assert got == {1: 11.0, 2: 12.0, 3: None}


def test_asof_takes_the_smallest_id_of_equal_times(tape):
    ticks = tape([(0, 10), (1_000, 7), (1_000, 8)])
    probes = ticks.filter("id = 1").select("symbol", "id", (F.col("event_time_ms") + 1_000).alias("target_ms"))
    assert asof.asof_forward(probes, ticks).first()["found_price"] == 7.0


def test_rank_chunks_keep_halo_and_rows(crowd):
    _, df = crowd
    chunked = layout.rank_chunks(layout.with_rank(df), before=3, after=2, size=64)
    w = layout.chunk_window("_rn")
    whole = Window.partitionBy("symbol").orderBy("event_time_ms", "id")
    cut = chunked.withColumns({"b": F.lag("price", 3).over(w), "a": F.lead("price", 2).over(w)}).filter("_home")
    plain = df.withColumns({"b": F.lag("price", 3).over(whole), "a": F.lead("price", 2).over(whole)})
    cols = ["id", "a", "b"]
    assert sorted(map(tuple, cut.select(cols).collect()), key=lambda r: r[0]) == sorted(
        map(tuple, plain.select(cols).collect()), key=lambda r: r[0])


def test_lookback_counts(crowd):
    rows, df = crowd
    groups = by_symbol(rows)
    got = {r["id"]: (r["n_1000ms"], r["n_60000ms"]) for r in features.lookback_counts(df, (1_000, 60_000)).collect()}
    for r in rows[:300]:
        near = [x[2] for x in groups[r[1]] if x[2] < r[2]]
        assert got[r[0]] == (sum(t >= r[2] - 1_000 for t in near), sum(t >= r[2] - 60_000 for t in near))


def test_crowded_slots_are_found(crowd):
    _, df = crowd
    hot = layout.crowded_slots(df, hot_rows=100)
    assert hot.filter("symbol = 'HOT' and _width < 60000").count() >= 1
    assert layout.crowded_slots(df) is None


def test_order_key_of_any_id(spark):
    ids = [-(1 << 63), -5, 0, 34_359_738_368, (1 << 63) - 1]
    rows = [(t, i) for t in (0, 1, 86_399_999) for i in ids]
    df = spark.createDataFrame(rows, "t long, i long").withColumn("k", layout.order_key(F.col("t"), F.col("i"), 86_400_000))
    assert [(r["t"], r["i"]) for r in df.orderBy("k").collect()] == rows


@pytest.mark.parametrize("limit", [1, 7, 400, 10_000])
def test_newest_and_oldest_rows_by_slots(crowd, limit):
    _, df = crowd
    for pick in (layout.newest_per_symbol, layout.oldest_per_symbol):
        assert sorted(map(tuple, pick(df, limit, prune=True).collect())) == sorted(map(tuple, pick(df, limit).collect()))
    assert layout.slots_with(df, limit, True).count() <= df.count()


def test_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (4, 1, 3, 2)] + [("b", 0.0)] * 50 + [("b", 5.0)], "k string, v double")
    got = {r["k"]: r for r in nearest_ranks(df, ["k"], "v", {"p50": 0.5, "p99": 0.99, "top": 1.0}).collect()}
    assert (got["a"]["p50"], got["a"]["p99"], got["a"]["top"], got["a"]["n"]) == (3.0, 4.0, 4.0, 4)
    assert (got["b"]["p50"], got["b"]["p99"], got["b"]["n"]) == (0.0, 5.0, 51)
    hundred = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    assert nearest_ranks(hundred, [], "v", {"p": 0.99}).first()["p"] == 99.0


def test_ranks_of_signed_values(spark):
    values = [-3.5, -1e-9, 0.0, 2e-9, 7.0, 7.0, -100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {f"i{i}": (lambda n, i=i: F.lit(i).cast("bigint")) for i in range(len(values))}
    row = exact_ranks(df, [], "v", wanted).first()
    assert [row[f"i{i}"] for i in range(len(values))] == sorted(values)


@pytest.mark.parametrize("small_chunks", [False, True])
def test_layout_of_crowded_tapes_changes_no_feature(crowd, monkeypatch, small_chunks):
    _, df = crowd

    def result(fn):
        return sorted(map(tuple, fn(df).collect()))

    calm = [result(features.orderflow_features), result(features.lookback_counts)]
    assert any(r[3] is not None for r in calm[0])
    monkeypatch.setattr(layout, "HOT_ROWS", 50)
    if small_chunks:
        monkeypatch.setattr(features, "RANK_CHUNK", 64)
        monkeypatch.setattr(layout.rank_chunks, "__defaults__", (0, 0, 64))
    assert layout.crowded_slots(df) is not None
    assert [result(features.orderflow_features), result(features.lookback_counts)] == calm


def test_small_quantities_are_not_rounded_away(tape):
    ticks = tape([(i * 20, 100 + (i * 7 % 5), (1 + i % 3) * 1e-9) for i in range(300)])
    rows = [r.asDict() for r in ticks.orderBy("id").collect()]
    got = {r["id"]: r["imbalance_20"] for r in features.orderflow_features(ticks).collect()}
    checked = 0
    for k in range(100, 300, 10):
        past = [r for r in rows if rows[k]["event_time_ms"] - 2_000 <= r["event_time_ms"] < rows[k]["event_time_ms"]]
        signed = sum(((b["price"] > a["price"]) - (b["price"] < a["price"])) * b["quantity"] for a, b in zip(past, past[1:]))
        want = signed / max(sum(r["quantity"] for r in past[1:]), 1e-10)
        assert got[rows[k]["id"]] == pytest.approx(want, abs=2e-6)
        checked += abs(want) > 1e-3
    assert checked > 5


def test_targets_before_the_first_tick(spark, tape):
    ticks = tape([(600_000, 10.0), (700_000, 11.0)])
    t0 = 1_704_067_200_000
    probes = spark.createDataFrame([(1, "BTCUSDT", t0 - 10_000_000), (2, "BTCUSDT", t0 + 5), (3, "BTCUSDT", t0 + 600_001), (4, "BTCUSDT", t0 + 700_001)],
                                   "id long, symbol string, target_ms long")
    got = {r["id"]: r["found_price"] for r in asof.asof_forward(probes, ticks).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 11.0, 4: None}


def test_asof_far_apart(spark):
    """A tick stamped in microseconds, probes at time 0 and an empty year: a row for each slot that holds something, no more."""
    start = 1_704_067_200_000
    rows = [(1, "A", start, 1.0), (2, "A", start + 366 * 86_400_000, 2.0), (3, "A", start * 1000, 3.0), (-7, "B", start, 4.0)]
    ticks = spark.createDataFrame([(i, s, t, p) for i, s, t, p in rows], "id long, symbol string, event_time_ms long, price double")
    asked = [("A", 0, 1.0), ("A", start + 1, 2.0), ("A", start + 400 * 86_400_000, 3.0), ("A", start * 1000 + 1, None), ("B", start, 4.0),
             ("B", start + 1, None), ("C", start, None)]
    probes = spark.createDataFrame([(k, s, t) for k, (s, t, _) in enumerate(asked)], "k long, symbol string, target_ms long")
    got = {r["k"]: r["found_price"] for r in asof.asof_forward(probes, ticks).collect()}
    assert got == {k: p for k, (_, _, p) in enumerate(asked)}


@pytest.mark.parametrize("crowd", [5, 100_000])
def test_ranks_inside_a_crowded_bucket(spark, crowd):
    """Values that agree in many places, two far clusters, repeats and several groups: the same ranks however often a bucket is narrowed."""
    rng = random.Random(11)
    values = {
        "close": [0.5 + k * 1e-15 for k in range(400)],
        "clusters": [1.0 + rng.random() * 1e-12 for _ in range(300)] + [1.01 + rng.random() * 1e-9 for _ in range(300)],
        "repeats": [rng.choice([2.0, 2.0000001, 2.0000002, -2.0, 0.0]) for _ in range(500)],
        "wide": [rng.gauss(0, 1) * 10 ** rng.randint(-9, 9) for _ in range(500)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double").repartition(5)
    at = {f"q{k}": (lambda n, q=k / 10: F.least(F.floor(n * F.lit(q)).cast("bigint"), n - 1)) for k in range(11)}
    got = {r["g"]: r for r in exact_ranks(df, ["g"], "v", at, crowd=crowd).collect()}
    for g, vs in values.items():
        vs = sorted(vs)
        assert got[g]["n"] == len(vs)
        assert [got[g][f"q{k}"] for k in range(11)] == [vs[min(int(len(vs) * (k / 10)), len(vs) - 1)] for k in range(11)]


def test_a_million_values_of_one_bucket_are_not_one_task(spark):
    """What is left to sort after narrowing is small, though all values lie in one logarithmic bucket."""
    df = spark.range(1_000_000).select((F.lit(0.5) + F.col("id") * 1e-12).alias("v"))
    got = exact_ranks(df, [], "v", {"m": lambda n: F.floor(n / 2).cast("bigint")}, crowd=1000)
    assert got.first()["m"] == 0.5 + 500_000 * 1e-12
    assert ranks.value_bucket(F.lit(0.5)) is not None and df.select(ranks.value_bucket(F.col("v")).alias("b")).distinct().count() == 1
    counted = df.select(ranks.value_bucket(F.col("v")).alias("_vb"), F.col("v").alias("_v"), F.lit(1).cast("long").alias("_c"))
    extent = [F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    hit = counted.groupBy("_vb").agg(*extent).select("_vb", F.lit("m").alias("_name"), F.lit(10**6).alias("n"), F.lit(500_000).cast("long").alias("_k"), "_d", "_lo", "_hi")
    left = ranks._narrowed(counted, hit, [], extent).collect()
    assert len(left) == 1 and left[0]["_d"] < 100


@pytest.mark.parametrize("fan, levels", [(4, 6), (16, 3), (512, 4)])
def test_extremes_of_ranges(spark, fan, levels):
    """Ranges of one row, inside a block, over several blocks of blocks; nulls do not count."""
    rng = random.Random(7)
    values = {s: [None if rng.random() < 0.05 else rng.gauss(0, 1) for _ in range(n)] for s, n in (("A", 900), ("B", 37), ("C", 1))}
    rows = spark.createDataFrame([(s, i, v) for s, vs in values.items() for i, v in enumerate(vs, 1)], "symbol string, _rn long, v double")
    asked = []
    for s, vs in values.items():
        for _ in range(150):
            a = rng.randint(1, len(vs))
            asked.append((s, len(asked), a, rng.choice([a, min(len(vs), a + rng.randint(0, 9)), rng.randint(a, len(vs)), len(vs)])))
    ranges = spark.createDataFrame(asked, "symbol string, _q long, _a long, _b long")
    got = {r["_q"]: (r["highest"], r["lowest"]) for r in extremes.range_extremes(rows, ranges, "v", levels, fan).collect()}
    for s, q, a, b in asked:
        held = [v for v in values[s][a - 1 : b] if v is not None]
        assert got[q] == ((max(held), min(held)) if held else (None, None))


@pytest.mark.parametrize("most", [7, 200, 350, None])
def test_paths_and_rates_of_any_number_of_ticks(tape, most):
    """A dense tape: the path and the trade rate end at the minute or after `most` ticks, whichever is first."""
    rng = random.Random(3)
    t, rows = 0, []
    for _ in range(900):
        t += rng.choice([0, 1, 20, 150, 400])
        rows.append((t, 100 + rng.gauss(0, 1)))
    ticks = tape(rows)
    paths = {r["id"]: (r["path_ticks"], r["highest"], r["lowest"]) for r in labels.future_extremes(ticks, path_rows=most).collect()}
    rates = {r["id"]: r["trade_rate_1m"] for r in features.tick_features(ticks, rate_rows=most).collect()}
    seen = 0
    for k in range(100, 900, 10):
        ahead = [p for x, p in rows if rows[k][0] <= x <= rows[k][0] + 60_000][:most]
        assert paths.get(k + 1) == ((len(ahead), max(ahead), min(ahead)) if len(ahead) >= 5 else None)
        rate = sum(rows[k][0] - 60_000 <= x for x, _ in rows[:k])
        assert rates[k + 1] == (rate if most is None else min(rate, most))
        seen += rate > 200
    assert seen > 20
