"""Named queries over the test tables, and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import config
from tickloom.functions.scalars import clock, rnd
from tickloom.operators import (
    asof, backtest, candles, events, features, featurespec, labels, learning, outcomes, signals, spikes,
)
from tickloom.operators.layout import latest_ms, slot_start
from tickloom.plans import oracle as o
from tickloom.plans.oracle import CTES, d, move, nearest, pct, share, statement
from tickloom.session import fresh_path, materialize, scratch
from tickloom.sources import tables
from tickloom.sources import ticks as src
from tickloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with its oracle statement if there is one."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the event table holds zone-less UTC times
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = statement(sql)
        return fn

    return add


def on_ticks(name: str, sql: str | None = None):
    """Register a function of the tick table."""

    def add(fn: Callable[[DataFrame], DataFrame]):
        query(name, sql)(lambda spark, sf_dir: fn(src.read_ticks(spark, sf_dir)))
        return fn

    return add


sql_rnd = o.rnd

# ---- sources and scans -------------------------------------------------------------

MESSAGE_KINDS = "CASE event_type WHEN 'SIGNUP' THEN 'aggTrade' ELSE 'trade' END"


def tape_messages(ticks: DataFrame) -> DataFrame:
    """The ticks as raw messages; one symbol's messages are of another type."""
    return src.as_messages(ticks, F.when(F.col("symbol") == "SIGNUP", F.lit("aggTrade")).otherwise(F.lit("trade")))


@on_ticks("parse_trades", """SELECT symbol, event_type, price, quantity, event_time_ms, ingest_time_ms, trade_id, is_buyer_maker
  FROM ticks WHERE symbol <> 'SIGNUP'""")
def parse_trades(t):
    return src.parse_trades(tape_messages(t)).drop("raw")


@on_ticks("load_events", f"""SELECT id, symbol, price, quantity, event_time_ms, latency_ms, is_buyer_maker
  FROM ticks QUALIFY row_number() OVER ({o.W}) <= 10000""")
def load_events(t):
    return src.load_events(t)


@on_ticks("load_events_150", f"""SELECT id, symbol, price, quantity, event_time_ms, latency_ms, is_buyer_maker
  FROM ticks QUALIFY row_number() OVER ({o.W}) <= 150""")
def load_events_150(t):
    """A limit that every symbol passes."""
    return src.load_events(t, limit=150)


RETAIN_MS = 300_000


@on_ticks("retention_filter", f"""SELECT id, symbol, price, quantity, event_time_ms FROM ticks, latest
  WHERE event_time_ms >= now_ms - {RETAIN_MS}""")
def retention_filter(t):
    kept = tables.retain_recent(t, latest_ms(t), RETAIN_MS)
    return kept.select("id", "symbol", "price", "quantity", "event_time_ms")


EVENT_SQL = "id, symbol, price, quantity, event_time_ms, ingest_time_ms, latency_ms, is_buyer_maker, trade_id"


@on_ticks("events_latest", f"""SELECT {EVENT_SQL} FROM ticks
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 100""")
def events_latest(t):
    return events.events_latest(t)


REPLAY_FROM, REPLAY_TO = src.TICK_EPOCH_MS + 100_000, src.TICK_EPOCH_MS + 400_000


@on_ticks("replay_range", f"""SELECT {EVENT_SQL} FROM ticks WHERE event_time_ms BETWEEN {REPLAY_FROM} AND {REPLAY_TO}
  QUALIFY row_number() OVER ({o.W}) <= 500""")
def replay_range(t):
    return events.replay(t, REPLAY_FROM, REPLAY_TO)


CLOCK = "strftime(epoch_ms(event_time_ms), '%H:%M:%S')"


@on_ticks("tick_moves", f"""SELECT symbol, id, event_time_ms, {CLOCK} AS clock, price, prev_price, {sql_rnd('move_pct', 8)} AS move_pct
  FROM (SELECT * FROM moves WHERE rn > n - 500) WHERE move_pct > 0.001::DOUBLE""")
def tick_moves(t):
    return events.recent_real_moves(t)


@on_ticks("last_moves", f"""SELECT symbol, id, {CLOCK} AS clock, price, {sql_rnd('move_pct', 6)} AS move_pct FROM moves WHERE rn > n - 19""")
def last_moves(t):
    return events.last_moves(t)


@on_ticks("incremental_poll", "SELECT id, symbol, price, event_time_ms FROM ticks WHERE id > 5000")
def incremental_poll(t):
    return events.incremental_poll(t, 5000).select("id", "symbol", "price", "event_time_ms")


@on_ticks("poll_position", "SELECT symbol, count(*) AS new_events, max(id) AS last_id FROM ticks WHERE id > 5000 GROUP BY symbol")
def poll_position(t):
    return events.poll_position(t, 5000)


CTES["strided"] = f"""SELECT * EXCLUDE (rn, n), (rn - 1) // step AS idx FROM (
    SELECT *, greatest(1, n // 200) AS step FROM (
      SELECT ticks.*, row_number() OVER ({o.W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n
      FROM ticks, latest WHERE event_time_ms >= now_ms - 300000)) WHERE (rn - 1) % step = 0"""


@on_ticks("downsample_stride", "SELECT symbol, id, event_time_ms, price, step, idx FROM strided")
def downsample_stride(t):
    return events.downsample_stride(t, latest_ms(t)).select("symbol", "id", "event_time_ms", "price", "step", "idx")


@on_ticks("latency_strip", """SELECT symbol, id, pos, latency, CAST(round(avg(latency) OVER (PARTITION BY symbol)) AS BIGINT) AS avg_latency,
    max(latency) OVER (PARTITION BY symbol) AS max_latency, latency > 300 AS slow
  FROM (SELECT symbol, id, abs(latency_ms) AS latency, row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) AS pos FROM ticks)
  WHERE pos <= 60""")
def latency_strip(t):
    return events.latency_strip(t)


@on_ticks("price_change_since_open", f"""SELECT symbol, f AS first_price, l AS last_price, {sql_rnd(pct('l', 'f'), 3)} AS change_pct
  FROM (SELECT symbol, arg_min(price, (event_time_ms, id)) AS f, arg_max(price, (event_time_ms, id)) AS l FROM ticks GROUP BY symbol)""")
def price_change_since_open(t):
    return events.price_change_since_open(t)


@on_ticks("feed_spike_tags", f"""SELECT symbol, id, pos, price, CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side,
    coalesce(abs(price - above) > thr, false) AS is_spike, {sql_rnd(pct('price', 'above'), 3)} AS pct
  FROM (SELECT *, greatest(avg(abs(price - above)) OVER s + 2 * stddev_pop(abs(price - above)) OVER s, 0.01::DOUBLE) AS thr
    FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY pos) AS above FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) AS pos FROM ticks) WHERE pos <= 300)
    WINDOW s AS (PARTITION BY symbol)) WHERE pos <= 80""")
def feed_spike_tags(t):
    return events.feed_spike_tags(t)


@on_ticks("trade_side", "SELECT id, symbol, CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side FROM ticks")
def trade_side(t):
    return events.trade_side(t)


@on_ticks("top_moves", f"""SELECT kind, symbol, rank, time_ms, id, {sql_rnd('mv', 6)} AS move_pct, {sql_rnd('mv / 100 * 77000', 2)} AS move_value FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, symbol ORDER BY mv DESC, time_ms, id) AS rank FROM (
      SELECT 'candle' AS kind, symbol, time_ms, 0::BIGINT AS id, mv FROM candle_moves
      UNION ALL SELECT 'tick', symbol, event_time_ms, id, move_pct FROM moves WHERE move_pct IS NOT NULL))
  WHERE rank <= CASE kind WHEN 'candle' THEN 10 ELSE 20 END""")
def top_moves(t):
    return events.top_moves(t)


# ---- candles and metrics -----------------------------------------------------------

MINUTE_SQL = f"""count(*) AS trade_count, {sql_rnd('avg(latency_ms)', 6)} AS avg_latency_ms, max(latency_ms) AS max_latency_ms,
  min(price) AS price_low, max(price) AS price_high, {sql_rnd('sum(quantity)', 6)} AS volume"""


@on_ticks("metrics_1min", f"""SELECT event_time_ms // 60000 * 60000 AS bucket_ms, symbol, {MINUTE_SQL} FROM ticks, latest
  WHERE event_time_ms >= now_ms - 300000 GROUP BY 1, 2""")
def metrics_1min(t):
    return candles.metrics_1min(t, latest_ms(t), minutes=5)


@on_ticks("metrics_1min_slippage", f"""SELECT symbol, event_time_ms // 60000 * 60000 AS bucket_ms, {MINUTE_SQL},
    {sql_rnd('avg(abs(price - prev_price))', 6)} AS avg_slippage FROM moves GROUP BY 1, 2""")
def metrics_1min_slippage(t):
    return candles.metrics_1min_slippage(t)


def _ohlcv_sql(ms: int) -> str:
    return f"""SELECT symbol, event_time_ms // {ms} * {ms} AS time_ms, arg_min(price, (event_time_ms, id)) AS open, max(price) AS high,
      min(price) AS low, arg_max(price, (event_time_ms, id)) AS close, {sql_rnd('sum(quantity)', 6)} AS volume, count(*) AS trades
    FROM ticks GROUP BY 1, 2"""


def _ohlcv(ms: int):
    return lambda t: candles.candles(t, ms).withColumn("volume", rnd(F.col("volume"), 6))


for _name, _ms in (("ohlcv_1s", 1_000), ("ohlcv_1m", 60_000), ("ohlcv_5m", 300_000)):
    on_ticks(_name, _ohlcv_sql(_ms))(_ohlcv(_ms))


@on_ticks("candle_move_stats", f"""SELECT symbol, count(*) AS candles, {sql_rnd('avg(mv)', 6)} AS mean_move, {sql_rnd('stddev_samp(mv)', 6)} AS std_move,
  {sql_rnd(nearest('mv', .95), 6)} AS p95, {sql_rnd(nearest('mv', .99), 6)} AS p99 FROM candle_moves GROUP BY symbol""")
def candle_move_stats(t):
    return candles.candle_move_stats(t)


@on_ticks("tick_move_stats", f"""SELECT symbol, count(move_pct) AS moves, {sql_rnd('avg(move_pct)', 6)} AS mean_move,
  {sql_rnd('stddev_samp(move_pct)', 6)} AS std_move, {sql_rnd('median(move_pct)', 6)} AS median_move,
  {sql_rnd(nearest('move_pct', .99), 6)} AS p99, {sql_rnd(nearest('move_pct', .999), 6)} AS p999
  FROM (SELECT * FROM moves WHERE move_pct IS NOT NULL) GROUP BY symbol""")
def tick_move_stats(t):
    return candles.tick_move_stats(t)


@on_ticks("move_percentiles", "SELECT symbol, count(*) AS n, " + ", ".join(
    f"{sql_rnd(nearest('mv', p), 8)} AS {n}" for n, p in
    (("p50", .5), ("p75", .75), ("p90", .9), ("p95", .95), ("p99", .99))) + " FROM candle_moves GROUP BY symbol")
def move_percentiles(t):
    out = candles.move_percentiles(t)
    return out.select("symbol", "n", *[rnd(F.col(c), 8).alias(c) for c in ("p50", "p75", "p90", "p95", "p99")])


PROFILE_SQL = ", ".join(f"{sql_rnd(c, 8)} AS {c}" for c in ("p75", "p90", "p99", "mean", "std"))


@on_ticks("pct_profile", f"SELECT symbol, n, {PROFILE_SQL} FROM profile")
def pct_profile(t):
    out = signals.pct_profile(t, latest_ms(t))
    return out.select("symbol", "n", *[rnd(F.col(c), 8).alias(c) for c in ("p75", "p90", "p99", "mean", "std")])


CTES["last_400"] = "SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 400"
CTES["profile_400"] = o.profile_cte("last_400", 0)


@on_ticks("recent_profile_400", f"SELECT symbol, n, {PROFILE_SQL} FROM profile_400")
def recent_profile_400(t):
    """A limit that most symbols pass."""
    out = signals.recent_profile(t, last=400)
    return out.select("symbol", "n", *[rnd(F.col(c), 8).alias(c) for c in ("p75", "p90", "p99", "mean", "std")])


# ---- signals -----------------------------------------------------------------------

SERVED = [
    "id", "symbol", "price", "event_time_ms", "spike_pct", "signal", "classification", "bucket",
    "prob_reversal", "prob_continuation", "streak", "confidence", "zscore", "regime_n",
]


def enriched(t: DataFrame, **options) -> DataFrame:
    return signals.enriched_events(t, signals.pct_profile(t, latest_ms(t)), **options)


@on_ticks("enriched_events", "SELECT * FROM served")
def enriched_events(t):
    return enriched(t).select(*SERVED)


@on_ticks("enriched_events_desc", f"SELECT {o.ENRICHED_COLUMNS} FROM enriched_desc")
def enriched_events_desc(t):
    return enriched(t, descending=True).select(*SERVED)


@on_ticks("size_bucket", "SELECT id, symbol, spike_pct, bucket FROM served WHERE bucket IS NOT NULL")
def size_bucket(t):
    return enriched(t).filter(F.col("bucket").isNotNull()).select("id", "symbol", "spike_pct", "bucket")


@on_ticks("edge_lookup", "SELECT id, symbol, bucket, signal, prob_reversal, prob_continuation, classification FROM served")
def edge_lookup(t):
    return enriched(t).select("id", "symbol", "bucket", "signal", "prob_reversal", "prob_continuation", "classification")


CTES["recent_ticks"] = """SELECT * FROM ticks
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 10000"""
CTES["recent_profile"] = o.profile_cte("recent_ticks", 0)


@on_ticks("edge_lookup_v1", f"""SELECT id, symbol, bucket, bucket || '_' || e.s AS classification, e.r AS prob_reversal, e.c AS prob_continuation,
    CASE WHEN e.r > 0.60::DOUBLE THEN 'REV_EDGE' WHEN e.c > 0.60::DOUBLE THEN 'CONT_EDGE' ELSE 'NO_EDGE' END AS signal
  FROM (SELECT *, {o.EDGE_CASE_V1} AS e FROM (SELECT id, symbol, {o.bucket_case('move_pct')} AS bucket
    FROM moves JOIN recent_profile USING (symbol) WHERE move_pct IS NOT NULL))""")
def edge_lookup_v1(t):
    return signals.edge_signal_v1(signals.enriched_events(t, signals.recent_profile(t)))


@on_ticks("signal_streak", "SELECT id, symbol, signal, streak FROM served WHERE streak IS NOT NULL")
def signal_streak(t):
    return enriched(t).filter(F.col("streak").isNotNull()).select("id", "symbol", "signal", "streak")


@on_ticks("confidence", "SELECT id, symbol, bucket, confidence FROM served")
def confidence(t):
    return enriched(t).select("id", "symbol", "bucket", "confidence")


@on_ticks("regime_zscore", "SELECT id, symbol, zscore, regime_n FROM served")
def regime_zscore(t):
    return enriched(t).select("id", "symbol", "zscore", "regime_n")


@on_ticks("record_signals", "SELECT *, 'PENDING' AS result_10s, 'PENDING' AS result_30s FROM recorded")
def record_signals(t):
    return signals.record_signals(enriched(t)).drop("price_10s", "price_30s")


@on_ticks("signals_filtered", """SELECT id, symbol, price, event_time_ms, signal, bucket, confidence FROM (
    SELECT * FROM served QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 500)
  WHERE confidence >= 0.60::DOUBLE AND signal NOT IN ('NO_DATA', 'NO_EDGE')
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 50""")
def signals_filtered(t):
    newest = signals.latest_enriched(t, signals.pct_profile(t, latest_ms(t)), 500)
    return signals.signals_filtered(newest).select("id", "symbol", "price", "event_time_ms", "signal", "bucket", "confidence")


@on_ticks("signal_counts_5m", """SELECT symbol, count(*) FILTER (signal='REV_EDGE') AS rev, count(*) FILTER (signal='CONT_EDGE') AS cont,
  count(*) FILTER (signal='NO_EDGE') AS no_edge FROM served, latest WHERE now_ms - event_time_ms < 300000 GROUP BY symbol""")
def signal_counts_5m(t):
    return signals.signal_counts(enriched(t), latest_ms(t))


# ---- spikes, classes, edges --------------------------------------------------------


@on_ticks("detect_spikes", f"""SELECT symbol, id, rn - 1 AS idx, event_time_ms AS time_ms, price, prev_price, {sql_rnd('diff', 6)} AS diff,
  {sql_rnd('pct', 6)} AS pct, direction, latency_ms FROM spikes""")
def detect_spikes(t):
    return spikes.detect_spikes(t)


@on_ticks("detect_spikes_ui", f"""SELECT symbol, id, idx, price, {sql_rnd('diff', 6)} AS diff, {sql_rnd('pct', 6)} AS pct, event_time_ms AS time_ms, abs(latency_ms) AS latency
  FROM (SELECT *, avg(diff) OVER s AS a, stddev_pop(diff) OVER s AS sd, count(*) OVER s AS pts, {move('price', 'prev_price')} AS pct
    FROM (SELECT *, abs(price - prev_price) AS diff FROM (SELECT *, lag(price) OVER ({o.W}) AS prev_price FROM strided))
    WINDOW s AS (PARTITION BY symbol))
  WHERE pts >= 3 AND diff > greatest(a + 2 * sd, 2 * a, 0.05::DOUBLE) AND pct > 0.01::DOUBLE""")
def detect_spikes_ui(t):
    return spikes.detect_spikes_ui(events.downsample_stride(t, latest_ms(t)))


@on_ticks("spike_follow_through", f"""SELECT symbol, follow, revert, neutral, total, {share('follow', 'total')} AS follow_pct,
    {share('revert', 'total')} AS revert_pct, {share('neutral', 'total')} AS neutral_pct
  FROM (SELECT symbol, count(*) FILTER (m > 0.005::DOUBLE) AS follow, count(*) FILTER (m < -0.005::DOUBLE) AS revert,
      count(*) FILTER (abs(m) <= 0.005::DOUBLE) AS neutral, count(*) AS total
    FROM (SELECT symbol, CASE direction WHEN 'up' THEN 1 ELSE -1 END * {pct('price_5', 'price')} AS m FROM spikes WHERE price_10 IS NOT NULL)
    GROUP BY symbol)""")
def spike_follow_through(t):
    return spikes.spike_follow_through(t)


@on_ticks("spike_class", f"""SELECT symbol, id, spike_class, {sql_rnd('pct', 6)} AS pct, {sql_rnd('m5', 6)} AS move_5, {sql_rnd('m30', 6)} AS move_30,
  {sql_rnd('vol_5', 6)} AS volume FROM spike_classes""")
def spike_class(t):
    return spikes.spike_class(t)


@on_ticks("spike_class_shares", f"""SELECT symbol, spike_class, n, {share('n', 'sum(n) OVER (PARTITION BY symbol)')} AS pct
  FROM (SELECT symbol, spike_class, count(*) AS n FROM spike_classes GROUP BY ALL)""")
def spike_class_shares(t):
    return spikes.spike_class_shares(t)


@on_ticks("candle_class", f"""SELECT symbol, time_ms, {sql_rnd('body', 6)} AS body, {sql_rnd('after', 6)} AS after, candle_class FROM candle_classes""")
def candle_class(t):
    out = spikes.candle_class(t)
    return out.select("symbol", "time_ms", rnd(F.col("body"), 6).alias("body"), rnd(F.col("after"), 6).alias("after"), "candle_class")


@on_ticks("candle_class_pnl", f"""SELECT symbol, candle_class, count(*) AS n, {share('count(*) FILTER (pnl > 0)', 'count(pnl)')} AS win_rate,
    {sql_rnd('sum(pnl)', 4)} AS total_pnl, {sql_rnd('avg(pnl)', 4)} AS avg_pnl
  FROM (SELECT *, CASE WHEN candle_class LIKE '%\\_UP' ESCAPE '\\' THEN {pct('close_ahead', 'next_open')} - 0.02::DOUBLE
      WHEN candle_class LIKE '%\\_DOWN' ESCAPE '\\' THEN -{pct('close_ahead', 'next_open')} - 0.02::DOUBLE END AS pnl
    FROM candle_classes WHERE rn <= n - 20) GROUP BY symbol, candle_class""")
def candle_class_pnl(t):
    return spikes.candle_class_pnl(t)


@on_ticks("edge_table", "SELECT symbol, bucket, n, rev, cont, rev_pct, cont_pct, avg_after, edge FROM edge_labels")
def edge_table(t):
    return spikes.edge_table(t)


MEASURED = f"""SELECT symbol, bucket, edge AS signal, {sql_rnd('rev_pct / 100', 2)} AS prob_reversal, {sql_rnd('cont_pct / 100', 2)} AS prob_continuation
  FROM edge_labels WHERE edge IN ('REV_EDGE', 'CONT_EDGE')"""


@on_ticks("edge_map_calibrated", MEASURED)
def edge_map_calibrated(t):
    return spikes.edge_map_calibrated(t)


CTES["measured_edges"] = MEASURED


@on_ticks("enriched_calibrated", """SELECT s.id, s.symbol, s.bucket, coalesce(m.signal, 'NO_EDGE') AS signal,
    coalesce(m.prob_reversal, 0.5::DOUBLE) AS prob_reversal, coalesce(m.prob_continuation, 0.5::DOUBLE) AS prob_continuation
  FROM served s LEFT JOIN measured_edges m USING (symbol, bucket) WHERE s.bucket IS NOT NULL""")
def enriched_calibrated(t):
    out = enriched(t, edges=spikes.edge_map_calibrated(t)).filter(F.col("bucket").isNotNull())
    return out.select("id", "symbol", "bucket", "signal", "prob_reversal", "prob_continuation")


@on_ticks("symbol_profile", """SELECT symbol, candles, flat_pct, spike_pct, spike_thresh, rev_rate, cont_rate, avg_move, std_move, avg_volume,
  total_spikes, reversals, continuations FROM symbol_rates""")
def symbol_profile(t):
    return spikes.symbol_profile(t)


CTES["metric_rows"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS metric, {c}::DOUBLE AS v FROM symbol_rates" for c in spikes.COMPARED) + ")"


@on_ticks("symbol_compare", f"""SELECT metric, l AS left_value, r AS right_value, {sql_rnd('r - l', 5)} AS difference, {sql_rnd('r / nullif(l, 0)', 2)} AS ratio
  FROM (SELECT metric, max(v) FILTER (symbol='BTCUSDT') AS l, max(v) FILTER (symbol='ETHUSDT') AS r FROM metric_rows GROUP BY metric)""")
def symbol_compare(t):
    return spikes.symbol_compare(spikes.symbol_profile(t))


# ---- temporal joins ----------------------------------------------------------------


@on_ticks("asof_forward_10s", "SELECT symbol, id, event_time_ms, price, found_price, found_ms FROM (" + o.asof("ticks", "event_time_ms + 10000") + ")")
def asof_forward_10s(t):
    probes = t.select("symbol", "id", "event_time_ms", "price").withColumn("target_ms", F.col("event_time_ms") + 10_000)
    return asof.asof_forward(probes, t, offsets=(10_000,)).drop("target_ms")


@on_ticks("window_lookback_counts", "SELECT symbol, id, event_time_ms, " + ", ".join(
    f"count(*) OVER (PARTITION BY symbol ORDER BY event_time_ms RANGE BETWEEN {w} PRECEDING AND 1 PRECEDING) AS n_{w}ms"
    for w in (1000, 2000, 60000)) + " FROM ticks")
def window_lookback_counts(t):
    return features.lookback_counts(t)


# ---- features and labels -----------------------------------------------------------


@on_ticks("tick_features", "SELECT * FROM features")
def tick_features(t):
    return features.tick_features(t)


for _col in ("spread_est", "flip_rate", "micro_range"):
    _name = {"spread_est": "roll_spread"}.get(_col, _col)
    on_ticks(_name, f"SELECT symbol, id, {_col} AS {_name} FROM features")(
        lambda t, c=_col, n=_name: features.tick_features(t).select("symbol", "id", F.col(c).alias(n))
    )


CTES["snapshot_ticks"] = f"""SELECT *, price - lag(price) OVER ({o.W}) AS sd FROM (SELECT ticks.*, row_number() OVER ({o.W}) AS pos FROM ticks, latest
  WHERE event_time_ms >= now_ms - 5000) WHERE pos <= 200"""


@on_ticks("spread_snapshot", f"""SELECT symbol, count(*) AS ticks,
    CASE WHEN count(*) >= 10 AND covar_pop(sd, sdl) < 0 THEN {sql_rnd('2 * sqrt(abs(covar_pop(sd, sdl)))', 6)} ELSE CAST(0 AS DOUBLE) END AS roll_spread,
    CASE WHEN count(*) >= 10 THEN {sql_rnd('count(*) FILTER (sign(sd) * sign(sdl) < 0)::DOUBLE / (count(*) - 2)', 4)} ELSE CAST(0 AS DOUBLE) END AS flip_rate,
    CASE WHEN count(*) >= 10 THEN {sql_rnd('max(price) - min(price)', 6)} ELSE CAST(0 AS DOUBLE) END AS micro_range
  FROM (SELECT *, lag(sd) OVER ({o.W}) AS sdl FROM snapshot_ticks) GROUP BY symbol""")
def spread_snapshot(t):
    return features.spread_snapshot(t, latest_ms(t))


@on_ticks("orderflow_features", "SELECT * FROM flow")
def orderflow_features(t):
    return features.orderflow_features(t)


@on_ticks("path_label", o.path_label(0.01))
def path_label(t):
    return labels.path_label(t)


@on_ticks("path_label_wide", o.path_label(0.3))
def path_label_wide(t):
    return labels.path_label(t, cost=0.3)


CTES["whole_paths"] = """SELECT s.symbol, s.id, any_value(s.event_time_ms) AS event_time_ms, any_value(s.price) AS price,
    count(*) AS path_ticks, max(m.price) AS highest, min(m.price) AS lowest
  FROM sampled s JOIN ticks m ON m.symbol = s.symbol AND m.event_time_ms BETWEEN s.event_time_ms AND s.event_time_ms + 60000
  GROUP BY s.symbol, s.id HAVING count(*) >= 5"""


@on_ticks("path_extremes_whole", "SELECT symbol, id, event_time_ms, price, path_ticks, highest, lowest FROM whole_paths")
def path_extremes_whole(t):
    return labels.future_extremes(t, path_rows=None)


@on_ticks("trade_rate_whole", """SELECT s.symbol, s.id, count(m.id) AS trade_rate_1m FROM sampled s LEFT JOIN ticks m
  ON m.symbol = s.symbol AND m.event_time_ms >= s.event_time_ms - 60000 AND (m.event_time_ms, m.id) < (s.event_time_ms, s.id) GROUP BY s.symbol, s.id""")
def trade_rate_whole(t):
    return features.trade_rate(t)


CTES["tick_10"] = o.asof("sampled", "event_time_ms + 10000", "p10", "t10")
CTES["tick_30"] = o.asof("sampled", "event_time_ms + 30000", "p30", "t30")
CTES["tick_60"] = o.asof("sampled", "event_time_ms + 60000", "p60", "t60")
CTES["horizon_labels"] = f"""SELECT a.symbol, a.id, CASE WHEN {pct('p10', 'a.price')} < -0.001::DOUBLE THEN '1' ELSE '0' END AS outcome_10s,
  CASE WHEN {pct('p30', 'a.price')} < -0.001::DOUBLE THEN '1' ELSE '0' END AS outcome_30s
  FROM tick_10 a JOIN tick_30 b USING (symbol, id) WHERE p10 IS NOT NULL AND p30 IS NOT NULL"""


@on_ticks("horizon_label", "SELECT * FROM horizon_labels")
def horizon_label(t):
    return labels.horizon_label(features.sampled_ticks(t), t)


@on_ticks("vol_scaled_label", f"""SELECT symbol, id, CASE WHEN {pct('p30', 'f.price')} < -(k * 0.5::DOUBLE) THEN '1' ELSE '0' END AS label_30s,
    CASE WHEN {pct('p60', 'f.price')} < -(k * 0.5::DOUBLE) THEN '1' ELSE '0' END AS label_60s
  FROM (SELECT *, CASE WHEN volatility_1m > 0 THEN volatility_1m ELSE 0.001::DOUBLE END AS k FROM features) f
  JOIN tick_30 USING (symbol, id) JOIN tick_60 USING (symbol, id) WHERE p30 IS NOT NULL AND p60 IS NOT NULL""")
def vol_scaled_label(t):
    return labels.vol_scaled_label(features.tick_features(t), t)


@on_ticks("label_distribution", f"""SELECT micro_label AS label, n, {share('n', 'sum(n) OVER ()')} AS pct
  FROM (SELECT micro_label, count(*) AS n FROM labels_01 GROUP BY 1)""")
def label_distribution(t):
    return labels.label_distribution(labels.path_label(t, cost=0.1), "micro_label")


# ---- outcomes ----------------------------------------------------------------------


def resolved(t: DataFrame) -> DataFrame:
    return outcomes.resolve_outcomes(signals.record_signals(enriched(t)), t, latest_ms(t))


@on_ticks("outcomes_resolved", "SELECT * FROM outcomes")
def outcomes_resolved(t):
    return resolved(t)


@on_ticks("outcome_totals", """SELECT count(*) AS total, count(*) FILTER (result_10s='PENDING') AS pending,
  count(*) FILTER (result_10s='WIN') AS win, count(*) FILTER (result_10s='LOSS') AS loss FROM outcomes""")
def outcome_totals(t):
    return outcomes.outcome_totals(resolved(t))


@on_ticks("outcomes_by_bucket", f"""SELECT bucket, signal, count(*) AS n, count(*) FILTER (result_10s='WIN') AS wins,
  {sql_rnd('avg(confidence)', 3)} AS avg_conf, {share("count(*) FILTER (result_10s='WIN')", 'count(*)')} AS win_pct
  FROM outcomes WHERE result_10s <> 'PENDING' GROUP BY bucket, signal""")
def outcomes_by_bucket(t):
    return outcomes.outcomes_by_bucket(resolved(t))


@on_ticks("accuracy", f"""SELECT symbol, count(*) AS total, count(*) FILTER (result_10s <> 'PENDING') AS validated,
    {share("count(*) FILTER (result_10s='WIN')", "count(*) FILTER (result_10s <> 'PENDING')")} AS win_rate_10s,
    {share("count(*) FILTER (result_30s='WIN')", "count(*) FILTER (result_10s <> 'PENDING')")} AS win_rate_30s,
    {share("count(*) FILTER (result_30s='WIN')", "count(*) FILTER (result_30s <> 'PENDING')")} AS win_rate_30s_own,
    {sql_rnd('avg(confidence)', 3)} AS avg_confidence
  FROM (SELECT * FROM outcomes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 500) GROUP BY symbol""")
def accuracy(t):
    return outcomes.accuracy(resolved(t))


@on_ticks("micro_move_diag", f"""SELECT count(*) AS total, count(*) FILTER ({move('price_10s', 'price_entry')} < 0.001::DOUBLE) AS micro_moves,
  {sql_rnd(f"avg({move('price_10s', 'price_entry')})", 8)} AS avg_move_pct, {sql_rnd('avg(price_10s - price_entry)', 6)} AS avg_raw_move
  FROM outcomes WHERE price_10s IS NOT NULL""")
def micro_move_diag(t):
    return outcomes.micro_move_diag(resolved(t))


@on_ticks("outcome_sample", f"""SELECT id, symbol, signal, bucket, confidence, price_entry, price_10s,
  coalesce({sql_rnd(pct('price_10s', 'price_entry'), 6)}, 0) AS move_pct, result_10s FROM outcomes ORDER BY event_time_ms, id LIMIT 10""")
def outcome_sample(t):
    return outcomes.outcome_sample(resolved(t))


@on_ticks("outcome_price_match", """SELECT o.symbol, count(*) AS pairs FROM outcomes o JOIN ticks t ON o.price_entry = t.price GROUP BY o.symbol""")
def outcome_price_match(t):
    return outcomes.outcome_price_match(resolved(t), t)


# ---- strategies --------------------------------------------------------------------


@on_ticks("spike_follow_trades", f"""SELECT symbol, id, event_time_ms AS entry_time_ms, found_ms AS exit_time_ms, price AS entry_price, found_price AS exit_price,
  direction, {sql_rnd('pct', 6)} AS spike_pct, hold_ms, {sql_rnd('pnl', 8)} AS net_pnl_pct, pnl > 0 AS win, latency_ms FROM trades""")
def spike_follow_trades(t):
    return backtest.trade_rows(backtest.spike_follow_trades(t))


CTES["free_trades"] = o.trades_sql(o.held("spikes", [30]), fee=0.0)
CTES["free_stats"] = o.stats_sql("free_trades", "symbol")


@on_ticks("backtest_stats", "SELECT * FROM stats")
def backtest_stats(t):
    return backtest.trade_stats(backtest.spike_follow_trades(t)).drop("entries")


@on_ticks("backtest_stats_no_fee", "SELECT * FROM free_stats")
def backtest_stats_no_fee(t):
    return backtest.trade_stats(backtest.spike_follow_trades(t, fee=0.0)).drop("entries")


@on_ticks("max_drawdown", "SELECT symbol, max_drawdown_pct AS max_drawdown FROM free_stats")
def max_drawdown(t):
    out = backtest.max_drawdown(backtest.spike_follow_trades(t, fee=0.0))
    return out.select("symbol", rnd(F.col("max_drawdown"), 4).alias("max_drawdown"))


SHORT_VERDICT = """CASE WHEN win_rate_pct >= 55 AND total_pnl_pct > 0 THEN 'EDGE' WHEN total_pnl_pct > 0 THEN 'POSITIVE_PNL' ELSE 'NO_EDGE' END"""
LONG_VERDICT = """CASE WHEN win_rate_pct IS NULL THEN 'NO_TRADES' WHEN win_rate_pct >= 55 AND total_pnl_pct > 0 THEN 'EDGE'
  WHEN total_pnl_pct > 0 THEN 'POSITIVE_PNL' WHEN win_rate_pct >= 50 THEN 'FEES_EAT_PNL' ELSE 'NO_EDGE' END"""


@on_ticks("backtest_verdict", f"SELECT symbol, win_rate_pct, total_pnl_pct, {SHORT_VERDICT} AS verdict, {LONG_VERDICT} AS report_verdict FROM free_stats")
def backtest_verdict(t):
    return backtest.backtest_verdict(backtest.trade_stats(backtest.spike_follow_trades(t, fee=0.0)))


@on_ticks("mean_reversion_sweep", o.stats_sql("sweep_trades", "symbol, hold"))
def mean_reversion_sweep(t):
    return backtest.mean_reversion_sweep(t).drop("entries")


@on_ticks("backtest_by_class", o.stats_sql("class_trades", "symbol, spike_class, hold"))
def backtest_by_class(t):
    return backtest.backtest_by_class(t).drop("entries")


CTES["grid_stats"] = o.stats_sql("grid_trades", "symbol, hold, z")


@on_ticks("grid_search", """SELECT symbol, hold, z, total_trades, win_rate_pct, total_pnl_pct, max_drawdown_pct,
  row_number() OVER (PARTITION BY symbol ORDER BY total_pnl_pct DESC, hold, z) = 1 AS best FROM grid_stats""")
def grid_search(t):
    return backtest.grid_search(t)


CTES["real_moves"] = """SELECT symbol, id, price, prev_price, prev_ms FROM moves WHERE move_pct >= 0.005::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms, id) <= 200"""
CTES["cost_exits"] = o.asof("real_moves", "prev_ms + 10000")


@on_ticks("exec_cost_win_rate", f"""SELECT symbol, wins, total, {share('wins', 'total')} AS win_rate FROM (
  SELECT symbol, count(*) FILTER (price - found_price - prev_price * 0.00041::DOUBLE > 0) AS wins, count(*) AS total
  FROM cost_exits WHERE found_price IS NOT NULL GROUP BY symbol)""")
def exec_cost_win_rate(t):
    return backtest.exec_cost_win_rate(t)


@on_ticks("backtest_report", f"""SELECT symbol, events_loaded, coalesce(spikes_detected, 0) AS spikes_detected, coalesce(total_trades, 0) AS trades_executed,
    win_rate_pct, total_pnl_pct, avg_pnl_pct, best_trade_pct, worst_trade_pct, max_drawdown_pct, profit_factor, avg_hold_sec, avg_entry_latency_ms,
    {LONG_VERDICT} AS verdict
  FROM (SELECT symbol, count(*) AS events_loaded FROM ticks GROUP BY symbol HAVING count(*) >= 20)
  LEFT JOIN (SELECT symbol, count(*) AS spikes_detected FROM spikes GROUP BY symbol) USING (symbol) LEFT JOIN stats USING (symbol)""")
def backtest_report(t):
    return backtest.backtest_report(t)


# ---- feature spec ------------------------------------------------------------------

CTES["eth"] = "SELECT * FROM changes WHERE symbol = 'ETHUSDT'"


def _window_sql(name: str, ms: int) -> str:
    """n, signed volume and move deviation of [t - ms, t), without the first tick's change."""
    return f"""SELECT id, count(*) AS n_{name}, coalesce(sum(c) FILTER (k > 1), 0) AS signed_{name}, stddev_pop(x) FILTER (k > 1) AS std_{name} FROM (
      SELECT s.id, m.c, m.move_pct AS x, row_number() OVER (PARTITION BY s.id ORDER BY m.event_time_ms, m.id) AS k
      FROM eth s JOIN eth m ON m.event_time_ms >= s.event_time_ms - {ms} AND m.event_time_ms < s.event_time_ms) GROUP BY id"""


CTES["eth_fast"] = _window_sql("fast", 1000)
CTES["eth_medium"] = _window_sql("medium", 5000)
CTES["eth_base"] = _window_sql("base", 60000)
CTES["eth_back"] = """SELECT s.id, arg_max(m.price, (m.event_time_ms, m.id)) AS back FROM eth s JOIN eth m
  ON m.event_time_ms <= s.event_time_ms - 1000 GROUP BY s.id"""
CTES["eth_raw"] = """SELECT s.symbol, s.id, s.event_time_ms, s.move_pct, coalesce(signed_fast, 0::DOUBLE) AS signed_imbalance_1s,
    coalesce(n_fast, 0) / nullif(coalesce(n_base, 0) / 60::DOUBLE, 0) AS burst_1s, (s.price - back) / back AS ret_1s,
    std_fast / nullif(std_medium, 0) AS vol_ratio_1s_5s,
    coalesce(n_fast, 0) / nullif(coalesce(n_base, 0) / 60::DOUBLE, 0) - (coalesce(n_medium, 0) / 5::DOUBLE) / nullif(coalesce(n_base, 0) / 60::DOUBLE, 0) AS burst_accel_1s_5s
  FROM eth s LEFT JOIN eth_fast USING (id) LEFT JOIN eth_medium USING (id) LEFT JOIN eth_base USING (id) LEFT JOIN eth_back USING (id)"""
CTES["eth_norm"] = """SELECT s.id, """ + ", ".join(
    f"count(m.{f}) AS n_{f}, avg(m.{f}) AS a_{f}, stddev_pop(m.{f}) AS s_{f}" for f in ("signed_imbalance_1s", "ret_1s")
) + """ FROM eth_raw s JOIN eth_raw m ON m.event_time_ms >= s.event_time_ms - 60000 AND m.event_time_ms < s.event_time_ms GROUP BY s.id"""


def _z_sql(f: str) -> str:
    return f"CASE WHEN n_{f} >= 30 THEN {sql_rnd(f'(r.{f} - a_{f}) / nullif(s_{f}, 0)', 6)} END AS {f}"


@on_ticks("feature_spec_eth_flow", f"""SELECT r.symbol, r.id, r.event_time_ms, {_z_sql('signed_imbalance_1s')}, {sql_rnd('burst_1s', 6)} AS burst_1s,
    {_z_sql('ret_1s')}, {sql_rnd('vol_ratio_1s_5s', 6)} AS vol_ratio_1s_5s, {sql_rnd('burst_accel_1s_5s', 6)} AS burst_accel_1s_5s
  FROM eth_raw r LEFT JOIN eth_norm USING (id) JOIN profile p ON p.symbol = r.symbol WHERE r.move_pct >= p75""")
def feature_spec_eth_flow(t):
    return featurespec.spec_features(t, signals.pct_profile(t, latest_ms(t)))


# ---- learning ----------------------------------------------------------------------

STORE_COST = 0.1


_STORES: dict[str, tuple[list, DataFrame]] = {}


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, written once for each session and folder of tables: many queries read it."""
    places, store = _STORES.get(sf_dir, (None, None))
    if places is not scratch(spark):  # another session, or its scratch was dropped
        store = materialize(learning.feature_store(src.read_ticks(spark, sf_dir), STORE_COST), "feature_store")
        _STORES[sf_dir] = scratch(spark), store
    return store


def on_store(name: str, sql: str | None = None):
    """Register a function of the stored feature table."""

    def add(fn: Callable[[DataFrame], DataFrame]):
        query(name, sql)(lambda spark, sf_dir: fn(stored_features(spark, sf_dir)))
        return fn

    return add


FLOW = list(config.FLOW_FEATURES)
CTES["model_rows"] = f"""SELECT id, symbol, event_time_ms, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in FLOW)},
    CASE WHEN micro_label IN ('CONTINUATION_UP', 'CONTINUATION_DOWN') THEN 1 ELSE 0 END AS label
  FROM store WHERE micro_label IN ('CONTINUATION_UP', 'CONTINUATION_DOWN', 'ABSORPTION') AND abs(zscore) >= 0.5::DOUBLE
    AND {' AND '.join(f'{f} IS NOT NULL' for f in FLOW)}"""
CTES["split_at"] = """SELECT list_extract(list(event_time_ms ORDER BY event_time_ms), CAST(least(floor(count(*) * 0.7::DOUBLE), count(*) - 1) AS BIGINT) + 1) AS split_ms
  FROM model_rows"""
CTES["split_rows"] = """SELECT *, CASE WHEN event_time_ms <= split_ms - 60000 THEN 'train' ELSE 'test' END AS part FROM model_rows, split_at
  WHERE event_time_ms <= split_ms - 60000 OR event_time_ms >= split_ms + 60000"""
CTES["train_stats"] = "SELECT " + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FLOW) + " FROM split_rows WHERE part = 'train'"
CTES["scored_rows"] = """SELECT *, round(1 / (1 + exp(-(0.8::DOUBLE * zscore + 0.5::DOUBLE * imbalance_20))), 6) AS score FROM model_rows"""


def scored_rows(store: DataFrame) -> DataFrame:
    """Model rows with a fixed score, so that reports can be checked without a fitted model."""
    logit = F.lit(0.8) * F.col("zscore") + F.lit(0.5) * F.col("imbalance_20")
    return learning.dataset(store).withColumn("score", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 6))


@on_ticks("feature_store", "SELECT * EXCLUDE (signal, confidence) FROM store")
def feature_store(t):
    return learning.feature_store(t, STORE_COST).drop("signal", "confidence")


@on_store("ml_dataset", "SELECT * FROM model_rows")
def ml_dataset(store):
    return learning.dataset(store)


CTES["plain_rows"] = f"""SELECT id, symbol, event_time_ms, label, row_number() OVER (ORDER BY event_time_ms, id, symbol) AS rn, count(*) OVER () AS n FROM model_rows"""


@on_store("walk_forward_split", """SELECT id, symbol, event_time_ms, label, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM plain_rows""")
def walk_forward_split(store):
    return learning.walk_forward_split(learning.dataset(store).select("id", "symbol", "event_time_ms", "label"))


@on_store("purged_split", "SELECT id, symbol, event_time_ms, label, part FROM split_rows")
def purged_split(store):
    return learning.purged_split(learning.dataset(store)).select("id", "symbol", "event_time_ms", "label", "part")


@on_store("standardize", "SELECT id, symbol, part, " + ", ".join(
    sql_rnd(f"({f} - m_{f}) / CASE WHEN s_{f} > 0 THEN s_{f} ELSE 1 END", 6) + f" AS {f}" for f in FLOW) + " FROM split_rows, train_stats")
def standardize(store):
    split = learning.purged_split(learning.dataset(store))
    scaled = learning.standardize(split, FLOW, split.filter(F.col("part") == "train"))
    return scaled.select("id", "symbol", "part", *[rnd(F.col(f), 6).alias(f) for f in FLOW])


@on_store("class_weights", f"""SELECT label, n, {sql_rnd('sum(n) OVER () / (count(*) OVER () * n)', 6)} AS weight FROM (
  SELECT label, count(*) AS n FROM split_rows WHERE part = 'train' GROUP BY label)""")
def class_weights(store):
    train = learning.purged_split(learning.dataset(store)).filter(F.col("part") == "train")
    return learning.class_weights(train).withColumn("weight", rnd(F.col("weight"), 6))


CTES["score_ranks"] = """SELECT *, (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2::DOUBLE) AS r FROM scored_rows"""


@on_store("auc_brier", f"""SELECT count(*) AS n, sum(label) AS positives,
    {sql_rnd('(sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2::DOUBLE) / nullif(sum(label) * (count(*) - sum(label)), 0)', 6)} AS auc,
    {sql_rnd('avg((score - label) * (score - label))', 6)} AS brier FROM score_ranks""")
def auc_brier(store):
    return learning.auc_brier(scored_rows(store))


CTES["score_edges"] = "SELECT quantile_cont(score, [" + ", ".join(f"{i / 10}::DOUBLE" for i in range(1, 10)) + "]) AS edges FROM scored_rows"
CTES["score_bins"] = "SELECT *, len(list_filter(edges, lambda e: e < score)) AS bin FROM scored_rows, score_edges"


@on_store("calibration_curve", f"""SELECT bin, count(*) AS n, {sql_rnd('avg(score)', 6)} AS mean_predicted, {sql_rnd('avg(label)', 6)} AS fraction_positive,
    {sql_rnd('avg(label) - avg(score)', 6)} AS gap, CASE WHEN avg(label) - avg(score) < -0.1::DOUBLE THEN 'OVERCONFIDENT'
      WHEN avg(label) - avg(score) > 0.1::DOUBLE THEN 'UNDERCONFIDENT' ELSE '' END AS flag FROM score_bins GROUP BY bin""")
def calibration_curve(store):
    return learning.calibration_curve(scored_rows(store))


@on_store("confidence_buckets", f"""SELECT lo, hi, count(*) AS n, {sql_rnd('avg(label) * 100', 1)} AS hit_rate FROM scored_rows,
    (VALUES {', '.join(f'({lo}::DOUBLE, {hi}::DOUBLE)' for lo, hi in learning.CONFIDENCE_RANGES)}) AS ranges(lo, hi)
  WHERE score >= lo AND score < hi GROUP BY lo, hi HAVING count(*) > 10""")
def confidence_buckets(store):
    return learning.confidence_buckets(scored_rows(store))


@on_store("threshold_hit_rate", f"""SELECT threshold, count(*) AS n, {sql_rnd('avg(label) * 100', 1)} AS hit_rate FROM scored_rows,
    (VALUES (0.55::DOUBLE), (0.60::DOUBLE), (0.65::DOUBLE)) AS cuts(threshold) WHERE score > threshold GROUP BY threshold""")
def threshold_hit_rate(store):
    return learning.threshold_hit_rate(scored_rows(store))


# A fixed linear model for the checkable form of the scored signals.
SCORE_WEIGHTS = [0.9, 0.4, -0.3, 0.6, -0.2, 0.5, 0.3, 0.2, -0.4]
SCORE_INTERCEPT = 0.1
CTES["fresh_rows"] = f"""SELECT symbol, id, price, event_time_ms, bucket, {', '.join(f'coalesce(CAST({f} AS DOUBLE), 0) AS {f}' for f in FLOW)} FROM store
  WHERE imbalance_20 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 200"""
CTES["fresh_stats"] = "SELECT " + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FLOW) + " FROM model_rows"
_TERMS = [
    f"(({f} - m_{f}) / CASE WHEN s_{f} > 0 THEN s_{f} ELSE 1 END * {d(w)})" for f, w in zip(FLOW, SCORE_WEIGHTS)
]
CTES["fresh_parts"] = "SELECT r.*, [" + ", ".join(
    f"{{'c': -abs({term}), 'i': {i}, 'name': '{f}'}}" for i, (f, term) in enumerate(zip(FLOW, _TERMS))
) + f"] AS parts, 1 / (1 + exp(-({d(SCORE_INTERCEPT)} + " + " + ".join(_TERMS) + "))) AS s FROM fresh_rows r, fresh_stats"


@on_store("signals_scored", f"""SELECT symbol, id, price, event_time_ms, 'CONTINUATION' AS signal, bucket AS spike_type, {sql_rnd('s', 3)} AS score,
    CASE WHEN s >= 0.8::DOUBLE THEN 'HIGH' WHEN s >= 0.6::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
    bucket || ' spike — directional momentum detected. Continuation likely (' || printf('%.0f', s * 100) || '%).' AS interpretation,
    'FILTER_IN' AS action, list_aggregate(list_transform(list_sort(parts)[1:3], lambda p: p.name), 'string_agg', ',') AS drivers,
    row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) AS rank
  FROM fresh_parts WHERE s >= 0.5::DOUBLE QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time_ms DESC, id DESC) <= 20""")
def signals_scored(store):
    scaled = learning.standardize(learning.newest_feature_rows(store), FLOW, learning.dataset(store))
    return learning.score_signals(scaled, FLOW, SCORE_WEIGHTS, SCORE_INTERCEPT)


def scaled_split(store: DataFrame, features: list[str] = FLOW, **options) -> DataFrame:
    """Purged split with scaled inputs, written once because every fit reads it."""
    split = learning.purged_split(learning.dataset(store, features, **options))
    scaled = learning.standardize(split, features, split.filter(F.col("part") == "train"))
    return materialize(scaled, "scaled_split")


def parts(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.filter(F.col("part") == "train"), split.filter(F.col("part") == "test")


# Fitted weights have no SQL form: queries that return them, or scores that follow from them, have no twin and are compared with
# numpy in the tests. What SQL can say of them, the rows that they rest on, is in queries of its own.
MODEL = "id long, symbol string, event_time_ms long, label int"


@on_store("model_splits", "SELECT part, label, count(*) AS n, min(event_time_ms) AS first_ms, max(event_time_ms) AS last_ms FROM split_rows GROUP BY part, label")
def model_splits(store):
    return learning.purged_split(learning.dataset(store, FLOW)).groupBy("part", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time_ms").alias("first_ms"), F.max("event_time_ms").alias("last_ms"))


def fitted(store: DataFrame):
    """The training rows' model, or None without rows of both labels, and the test rows."""
    train, test = parts(scaled_split(store))
    model = learning.fit_logistic(train, FLOW) if train.select("label").distinct().count() == 2 else None
    return model, train, test


@on_store("logreg_fit")
def logreg_fit(store):
    """Each test row with its probability."""
    model, _, test = fitted(store)
    if model is None:
        return store.sparkSession.createDataFrame([], f"{MODEL}, score double")
    return learning.predict(model, test, FLOW).select("id", "symbol", "event_time_ms", "label", "score")


@on_store("logreg_report")
def logreg_report(store):
    """Rows, positives, AUC and Brier score on the test rows, and how far the weights are from their optimum."""
    model, train, test = fitted(store)
    if model is None:
        return store.sparkSession.createDataFrame([], "n long, positives long, auc double, brier double, gap double")
    gap = learning.optimality_gap(model, train, FLOW)
    return learning.auc_brier(learning.predict(model, test, FLOW)).withColumn("gap", F.lit(gap))


@on_store("coefficient_ranking")
def coefficient_ranking(store):
    """Inputs by size of their coefficient."""
    model, _, _ = fitted(store)
    named = [] if model is None else learning.coefficients(model, FLOW)
    return store.sparkSession.createDataFrame(
        [(k, f, w, abs(w)) for k, (f, w) in enumerate(named, 1)], "rank int, feature string, coefficient double, size double")


@on_store("isotonic_folds", """SELECT fold, label, count(*) AS n, min(event_time_ms) AS first_ms, max(event_time_ms) AS last_ms FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY event_time_ms, id, symbol) - 1) * 5 // count(*) OVER (PARTITION BY label) AS INTEGER) AS fold
  FROM split_rows WHERE part = 'train') GROUP BY fold, label""")
def isotonic_folds(store):
    train, _ = parts(learning.purged_split(learning.dataset(store, FLOW)))
    return learning.stratified_folds(train).groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time_ms").alias("first_ms"), F.max("event_time_ms").alias("last_ms"))


@on_store("isotonic_calibrated")
def isotonic_calibrated(store):
    """Each test row with the probability of one model and the mean of five calibrations."""
    train, test = parts(scaled_split(store))
    if train.select("label").distinct().count() < 2:
        return store.sparkSession.createDataFrame([], f"{MODEL}, score double, calibrated double")
    return learning.isotonic_scores(train, test, FLOW).select("id", "symbol", "event_time_ms", "label", "score", "calibrated")


@on_store("isotonic_report")
def isotonic_report(store):
    """AUC and Brier score of the test rows before and after calibration."""
    scored = materialize(isotonic_calibrated(store), "calibrated")
    stages = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(c).alias("score")) for n, c in (("raw", "score"), ("calibrated", "calibrated"))]))
    return learning.auc_brier(scored.select("label", stages.alias("_s")).select("label", "_s.*"), by=["stage"])


CTES["ablation_rows"] = f"""SELECT id, symbol, event_time_ms, CASE WHEN micro_label = 'CONTINUATION_UP' THEN 1 ELSE 0 END AS label FROM store
  WHERE micro_label IS NOT NULL AND {' AND '.join(f'{f} IS NOT NULL' for f in config.BASE_FEATURES)}"""
CTES["ablation_at"] = """SELECT list_extract(list(event_time_ms ORDER BY event_time_ms), CAST(least(floor(count(*) * 0.7::DOUBLE), count(*) - 1) AS BIGINT) + 1) AS at_ms
  FROM ablation_rows"""


def ablation_split(store: DataFrame) -> DataFrame:
    return scaled_split(store, list(config.BASE_FEATURES), positive=("CONTINUATION_UP",), labels=None, min_abs_z=None)


@on_store("ablation_splits", f"""SELECT part, count(*) AS n, sum(label) AS positives FROM (
  SELECT *, CASE WHEN event_time_ms <= at_ms - {learning.EMBARGO_MS} THEN 'train' WHEN event_time_ms >= at_ms + {learning.EMBARGO_MS} THEN 'test' END AS part
  FROM ablation_rows, ablation_at) WHERE part IS NOT NULL GROUP BY part""")
def ablation_splits(store):
    return ablation_split(store).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


@on_store("feature_ablation")
def feature_ablation(store):
    """AUC, Brier score, loss of AUC and leakage flag of the full model and of each model without one input."""
    return learning.feature_ablation(ablation_split(store), list(config.BASE_FEATURES))


@on_store("scoring_candidates", """SELECT symbol, count(*) AS candidates, min(id) AS first_id, max(id) AS last_id, min(event_time_ms) AS first_ms
  FROM fresh_rows GROUP BY symbol""")
def scoring_candidates(store):
    return learning.newest_feature_rows(store).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("candidates"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.min("event_time_ms").alias("first_ms"))


@on_store("signals_scored_fitted")
def signals_scored_fitted(store):
    """Signals of a fitted model that was saved and loaded again: at most 20 a symbol, from the newest, each with three drivers."""
    rows = learning.dataset(store)
    train = materialize(learning.standardize(rows, FLOW, rows), "scaled_all")
    fresh = learning.standardize(learning.newest_feature_rows(store), FLOW, rows)
    if train.select("label").distinct().count() < 2:  # nothing to fit
        return learning.score_signals(fresh.filter(F.lit(False)), FLOW, [0.0] * len(FLOW), 0.0)
    path = fresh_path(train.sparkSession, "model")
    learning.save_model(learning.fit_logistic(train, FLOW), FLOW, path)
    model, inputs = learning.load_model(path)
    return learning.score_signals(fresh, inputs, model.coefficients.toArray().tolist(), float(model.intercept))


@query("outcome_dataset", f"""SELECT id, symbol, event_time_ms, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in config.BASE_FEATURES)}, CAST(outcome_10s AS INTEGER) AS label
  FROM store JOIN horizon_labels USING (symbol, id) WHERE {' AND '.join(f'{f} IS NOT NULL' for f in config.BASE_FEATURES)}""")
def outcome_dataset(spark, sf_dir):
    store = stored_features(spark, sf_dir)
    found = labels.horizon_label(store.select("symbol", "id", "event_time_ms", "price"), src.read_ticks(spark, sf_dir))
    return learning.outcome_dataset(store, found)


# ---- tables and scalars ------------------------------------------------------------


@on_ticks("table_counts", """SELECT 'market_events' AS table_name, count(*) AS n_rows FROM ticks
  UNION ALL SELECT 'signal_outcomes', count(*) FROM outcomes UNION ALL SELECT 'feature_store', count(*) FROM features""")
def table_counts(t):
    return tables.table_counts({
        "market_events": t, "signal_outcomes": resolved(t), "feature_store": features.sampled_ticks(t),
    })


TABLE_SQL = "id, symbol, price, quantity, event_time_ms, trade_id, is_buyer_maker"


@on_ticks("tick_table", f"SELECT {TABLE_SQL}, CAST(epoch_ms(event_time_ms) AS DATE) AS date FROM ticks WHERE symbol <> 'SIGNUP'")
def tick_table(t):
    """Written in two appends, read back with its partitions."""
    path = fresh_path(t.sparkSession, "table")
    for part in (F.col("symbol") == "BTCUSDT", ~F.col("symbol").isin("BTCUSDT", "SIGNUP")):
        tables.write_ticks(t.filter(part), path)
    return tables.read_features(t.sparkSession, path, [*TABLE_SQL.split(", "), "date"])


@on_ticks("rebuilt_table", f"SELECT {TABLE_SQL} FROM ticks WHERE symbol = 'ETHUSDT' AND price > 78050")
def rebuilt_table(t):
    """Filled, emptied, and filled anew; columns and rows are chosen at the scan."""
    spark, path = t.sparkSession, fresh_path(t.sparkSession, "table")
    tables.replace_table(t.filter(F.col("symbol") == "BTCUSDT"), path)
    tables.truncate_table(spark, path)
    tables.append_rows(t.filter(F.col("symbol") == "ETHUSDT"), path)
    return tables.read_features(spark, path, TABLE_SQL.split(", "), F.col("price") > 78050)


@on_ticks("new_signals", "SELECT symbol, id, signal, bucket FROM recorded WHERE id % 3 <> 0")
def new_signals(t):
    recorded = materialize(signals.record_signals(enriched(t)), "recorded")
    return signals.new_signals(recorded, recorded.filter(F.col("id") % 3 == 0)).select("symbol", "id", "signal", "bucket")


@on_ticks("saved_backtest", """SELECT symbol, '2024-01-01T00:00:00Z' AS run_time, events_loaded, 30 AS hold_seconds, coalesce(total_trades, 0) AS trades_executed, win_rate_pct
  FROM (SELECT symbol, count(*) AS events_loaded FROM ticks GROUP BY symbol HAVING count(*) >= 20) LEFT JOIN stats USING (symbol)""")
def saved_backtest(t):
    """A run for each of two groups of symbols, appended to one results table and read from its JSON."""
    path = fresh_path(t.sparkSession, "results")
    for part in (F.col("symbol") == "BTCUSDT", F.col("symbol") != "BTCUSDT"):
        backtest.backtest_report(t.filter(part), save=path, run_time="2024-01-01T00:00:00Z")
    params = F.from_json("params", "events_loaded bigint, hold_seconds int")
    stats = F.from_json("stats", "trades_executed bigint, win_rate_pct double")
    saved = t.sparkSession.read.parquet(path)
    return saved.withColumns({"_p": params, "_s": stats}).select("symbol", "run_time", "_p.*", "_s.*")


@on_ticks("scalar_smoke", f"""SELECT id, abs(price - 78100) AS abs_gap, round(price, 1) AS rounded, {sql_rnd('sqrt(quantity)', 8)} AS root, CAST(floor(price) AS BIGINT) AS whole,
    greatest(least(quantity, 5::DOUBLE), 1::DOUBLE) AS clipped, CAST(sign(price - 78100) AS BIGINT) AS direction,
    event_time_ms // 60000 * 60000 AS minute_ms, event_time_ms // 3600000 % 24 AS hour, {CLOCK} AS clock,
    strftime(epoch_ms(event_time_ms), '%Y-%m-%dT%H:%M:%S') AS iso, upper(symbol) AS upper_symbol, symbol IN ('BTCUSDT', 'ETHUSDT') AS is_major,
    CASE WHEN quantity > 5 THEN 'big' ELSE 'small' END AS size, coalesce(nullif(quantity, 0), -1) AS quantity_or,
    printf('%.1f%%', quantity) AS pct_text, symbol AS decoded FROM ticks""")
def scalar_smoke(t):
    time = F.col("event_time_ms")
    as_json = F.to_json(F.struct("symbol", "id"))
    return t.select(
        "id",
        F.abs(F.col("price") - 78100).alias("abs_gap"),
        F.round("price", 1).alias("rounded"),
        rnd(F.sqrt("quantity"), 8).alias("root"),
        F.floor("price").alias("whole"),
        F.greatest(F.least("quantity", F.lit(5.0)), F.lit(1.0)).alias("clipped"),
        F.signum(F.col("price") - 78100).cast("bigint").alias("direction"),
        slot_start(time, 60_000).alias("minute_ms"),
        F.expr("event_time_ms div 3600000 % 24").alias("hour"),
        clock(time).alias("clock"),
        F.date_format(F.timestamp_millis(time), "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.upper("symbol").alias("upper_symbol"),
        F.col("symbol").isin("BTCUSDT", "ETHUSDT").alias("is_major"),
        F.when(F.col("quantity") > 5, F.lit("big")).otherwise(F.lit("small")).alias("size"),
        F.coalesce(F.nullif("quantity", F.lit(0.0)), F.lit(-1.0)).alias("quantity_or"),
        F.format_string("%.1f%%", "quantity").alias("pct_text"),
        F.from_json(as_json, "symbol string, id bigint")["symbol"].alias("decoded"),
    )


# ---- streams: the tables replayed with all input available ---------------------------


@query("stream_ingest", """SELECT symbol, event_type, price, quantity, event_time_ms, ingest_time_ms, trade_id, is_buyer_maker
  FROM ticks WHERE symbol <> 'SIGNUP'""")
def stream_ingest(spark, sf_dir):
    path, _ = jobs.ingest(tape_messages(jobs.tick_stream(spark, sf_dir)))
    stored = jobs.read_table(spark, path)
    return stored.select("symbol", "event_type", "price", "quantity", "event_time_ms", "ingest_time_ms", "trade_id", "is_buyer_maker")


def stretches(ticks: DataFrame, count: int) -> list[DataFrame]:
    """The ticks in `count` stretches of equal time."""
    first, last = ticks.agg(F.min("event_time_ms"), F.max("event_time_ms")).first()
    if first is None:
        return [ticks]
    step = -(-(last - first + 1) // count)
    return [ticks.filter(F.col("event_time_ms").between(first + k * step, first + (k + 1) * step - 1)) for k in range(count)]


@query("stream_retention", """SELECT symbol, price, quantity, event_time_ms, trade_id FROM ticks
  WHERE symbol <> 'SIGNUP' AND event_time_ms >= (SELECT max(event_time_ms) - 7200000 FROM ticks WHERE symbol <> 'SIGNUP')""")
def stream_retention(spark, sf_dir):
    """Eight micro-batches of raw messages, a stretch of time each; the stream keeps the last two hours.

    All tasks write a stretch; the job takes what has come as one micro-batch and goes on from there with the next.
    """
    path, job = fresh_path(spark, "files"), fresh_path(spark, "ticks")
    for part in stretches(src.read_ticks(spark, sf_dir), 8):
        messages = tape_messages(part)
        messages.write.mode("append").parquet(path)
        jobs.ingest(jobs.file_stream(spark, path, messages.schema), path=job, keep_ms=7_200_000)
    return jobs.recent_rows(spark, job, 7_200_000).select("symbol", "price", "quantity", "event_time_ms", "trade_id")


def _stream_candles(interval: str, ms: int):
    def run(spark, sf_dir):
        path, _ = jobs.keep_current(jobs.live_candles(jobs.tick_stream(spark, sf_dir), interval), "candles")
        return jobs.newest_rows(spark, path, ["symbol", "time_ms"]).withColumn("volume", rnd(F.col("volume"), 6))

    return _ohlcv_sql(ms), run


for _name, _interval, _ms in (("stream_candles", "1 second", 1_000), ("stream_candles_1m", "1 minute", 60_000)):
    _sql, _run = _stream_candles(_interval, _ms)
    query(_name, _sql)(_run)


def batch_profile(t: DataFrame) -> DataFrame:
    return materialize(signals.pct_profile(t, latest_ms(t)), "profile")


@query("stream_streak", "SELECT id, symbol, event_time_ms, signal, streak FROM served WHERE streak IS NOT NULL")
def stream_streak(spark, sf_dir):
    profile = batch_profile(src.read_ticks(spark, sf_dir))
    path, _ = jobs.streaks(jobs.tick_stream(spark, sf_dir), profile)
    return jobs.read_table(spark, path).drop("batch")


CTES["stream_found"] = " UNION ALL ".join(
    f"SELECT id, symbol, signal, bucket, price_entry, 'price_{h}s' AS horizon, p{h} AS price, CASE WHEN p{h} IS NULL THEN 'PENDING' ELSE result_{h}s END AS result FROM settled_{h}" for h in (10, 30))
for _h in (10, 30):
    CTES[f"settled_{_h}"] = f"""SELECT *, CASE WHEN signal='REV_EDGE' AND mv < -thr THEN 'WIN' WHEN signal='CONT_EDGE' AND mv > thr THEN 'WIN'
        WHEN abs(mv) < thr * 0.5::DOUBLE THEN 'NEUTRAL' ELSE 'LOSS' END AS result_{_h}s
      FROM (SELECT *, {pct(f'p{_h}', 'price_entry')} AS mv, CASE bucket WHEN 'MEDIUM' THEN 0.010::DOUBLE WHEN 'LARGE' THEN 0.020::DOUBLE ELSE 0.030::DOUBLE END AS thr
        FROM priced_{_h})"""


@query("stream_outcomes", "SELECT * FROM stream_found")
def stream_outcomes(spark, sf_dir):
    ticks = src.read_ticks(spark, sf_dir)
    waiting = signals.record_signals(enriched(ticks))
    path = fresh_path(spark, "signals")
    waiting.write.parquet(path)
    incoming = jobs.file_stream(spark, path, waiting.schema)
    out, _ = jobs.outcomes(incoming, jobs.tick_stream(spark, sf_dir))
    return jobs.outcome_rows(spark, out)


@query("stream_profile", f"SELECT symbol, n, {PROFILE_SQL} FROM profile")
def stream_profile(spark, sf_dir):
    path, _ = jobs.profiles(jobs.tick_stream(spark, sf_dir))
    runs = jobs.read_table(spark, path)
    newest = runs.filter(F.col("batch") == runs.agg(F.max("batch")).scalar())
    return newest.select("symbol", "n", *[rnd(F.col(c), 8).alias(c) for c in ("p75", "p90", "p99", "mean", "std")])


@query("stream_counts_5m", """SELECT symbol, start_ms, count(*) FILTER (signal='REV_EDGE') AS rev, count(*) FILTER (signal='CONT_EDGE') AS cont,
    count(*) FILTER (signal='NO_EDGE') AS no_edge
  FROM (SELECT *, event_time_ms // 60000 * 60000 - unnest([0, 60000, 120000, 180000, 240000]) AS start_ms FROM served)
  GROUP BY symbol, start_ms""")
def stream_counts_5m(spark, sf_dir):
    served = enriched(src.read_ticks(spark, sf_dir)).select("id", "symbol", "event_time_ms", "signal")
    path = fresh_path(spark, "enriched")
    served.write.parquet(path)
    out, _ = jobs.keep_current(jobs.live_counts(jobs.file_stream(spark, path, served.schema)), "counts")
    return jobs.newest_rows(spark, out, ["symbol", "start_ms"])
