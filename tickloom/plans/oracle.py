"""The same results as plain SQL for an independent engine (DuckDB dialect).

Common table expressions are written once; `statement` adds the ones a query
mentions, in order.
"""

from __future__ import annotations

import re

W = "PARTITION BY symbol ORDER BY event_time_ms, id"


def rnd(x: str, digits: int) -> str:
    return f"(round({x}, {digits}) + CAST(0 AS DOUBLE))"


def pct(new: str, old: str) -> str:
    return f"((({new}) - ({old})) / nullif({old}, 0) * CAST(100 AS DOUBLE))"


def move(new: str, old: str) -> str:
    return f"(abs(({new}) - ({old})) / nullif({old}, 0) * CAST(100 AS DOUBLE))"


def share(part: str, whole: str, digits: int = 1) -> str:
    return rnd(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * CAST(100 AS DOUBLE)", digits)


def d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def nearest(value: str, p: float) -> str:
    """Nearest rank s[floor(n*p)] of a column, as a list expression over a group."""
    return (
        f"list_extract(list({value} ORDER BY {value}), "
        f"CAST(least(floor(count({value}) * {d(p)}), count({value}) - 1) AS BIGINT) + 1)"
    )


# The edge maps, as in `config`.
EDGE_CASE = """CASE
  WHEN symbol='BTCUSDT' AND bucket='SMALL' THEN {'s':'REV_EDGE','r':0.63::DOUBLE,'c':0.37::DOUBLE}
  WHEN symbol='BTCUSDT' AND bucket='MEDIUM' THEN {'s':'REV_EDGE','r':0.73::DOUBLE,'c':0.27::DOUBLE}
  WHEN symbol='BTCUSDT' AND bucket='EXTREME' THEN {'s':'CONT_EDGE','r':0.13::DOUBLE,'c':0.87::DOUBLE}
  WHEN symbol='ETHUSDT' AND bucket='LARGE' THEN {'s':'CONT_EDGE','r':0.30::DOUBLE,'c':0.70::DOUBLE}
  WHEN symbol='ETHUSDT' AND bucket='EXTREME' THEN {'s':'CONT_EDGE','r':0.29::DOUBLE,'c':0.71::DOUBLE}
  ELSE {'s':'NO_EDGE','r':0.5::DOUBLE,'c':0.5::DOUBLE} END"""

EDGE_CASE_V1 = """CASE
  WHEN symbol='BTCUSDT' AND bucket='MEDIUM' THEN {'s':'REVERSAL','r':0.66::DOUBLE,'c':0.34::DOUBLE}
  WHEN symbol='BTCUSDT' AND bucket='LARGE' THEN {'s':'CONTINUATION','r':0.28::DOUBLE,'c':0.72::DOUBLE}
  WHEN symbol='ETHUSDT' AND bucket='SMALL' THEN {'s':'REVERSAL','r':0.61::DOUBLE,'c':0.39::DOUBLE}
  WHEN symbol='ETHUSDT' AND bucket='LARGE' THEN {'s':'CONTINUATION','r':0.40::DOUBLE,'c':0.60::DOUBLE}
  WHEN symbol='ETHUSDT' AND bucket='EXTREME' THEN {'s':'CONTINUATION','r':0.25::DOUBLE,'c':0.75::DOUBLE}
  ELSE {'s':'NOISE','r':0.5::DOUBLE,'c':0.5::DOUBLE} END"""


def bucket_case(x: str) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN NULL WHEN {x} < p75 THEN 'SMALL' WHEN {x} < p90 THEN 'MEDIUM' "
            f"WHEN {x} < p99 THEN 'LARGE' ELSE 'EXTREME' END")


def profile_cte(source: str, min_ticks: int) -> str:
    return f"""SELECT symbol, {nearest('mv', .75)} AS p75, {nearest('mv', .90)} AS p90, {nearest('mv', .99)} AS p99,
      avg(mv) AS mean, stddev_pop(mv) AS std, count(mv) AS n
    FROM (SELECT symbol, abs(c-o)/o*CAST(100 AS DOUBLE) AS mv, k FROM (
      SELECT symbol, arg_min(price, (event_time_ms, id)) AS o, arg_max(price, (event_time_ms, id)) AS c, count(*) AS k
      FROM {source} GROUP BY symbol, event_time_ms // 1000) WHERE o > 0)
    GROUP BY symbol HAVING sum(k) >= {min_ticks} AND count(mv) >= 20"""


def enriched_cte(order: str) -> str:
    """Change, bucket, edge, streak and confidence along one walking order."""
    return f"""SELECT *, least(row_number() OVER (PARTITION BY symbol, rated, island ORDER BY rn), 10) AS streak
    FROM (SELECT *, sum(brk) OVER (PARTITION BY symbol, rated ORDER BY rn) AS island FROM (
      SELECT *, e.s AS sig, CASE WHEN e.s IS DISTINCT FROM lag(e.s) OVER (PARTITION BY symbol, rated ORDER BY rn)
          THEN 1 ELSE 0 END AS brk FROM (
        SELECT *, {EDGE_CASE} AS e FROM (
          SELECT t.*, p.p75, p.p90, p.p99, p.mean, p.std, p.n,
            coalesce(t.prev > 0, false) AND t.price IS NOT NULL AND p.p75 IS NOT NULL AS rated,
            CASE WHEN t.prev > 0 THEN {pct('t.price', 't.prev')} END AS chg,
            {bucket_case('abs(CASE WHEN t.prev > 0 THEN ' + pct('t.price', 't.prev') + ' END)')} AS bucket
          FROM (SELECT *, lag(price) OVER w AS prev, row_number() OVER w AS rn FROM ticks
                WINDOW w AS (PARTITION BY symbol ORDER BY {order})) t
          LEFT JOIN profile p USING (symbol)))))"""


ENRICHED_COLUMNS = f"""id, symbol, price, event_time_ms,
  CASE WHEN rated THEN streak END AS streak,
  CASE WHEN chg IS NULL THEN CAST(0 AS DOUBLE) ELSE {rnd('chg', 6)} END AS spike_pct,
  CASE WHEN rated THEN sig ELSE 'NO_DATA' END AS signal,
  CASE WHEN rated THEN (CASE WHEN sig='NO_EDGE' THEN 'NOISE' ELSE sig END) || '_' || bucket ELSE 'UNKNOWN' END AS classification,
  CASE WHEN rated THEN bucket END AS bucket,
  CASE WHEN rated THEN e.r ELSE CAST(0.5 AS DOUBLE) END AS prob_reversal,
  CASE WHEN rated THEN e.c ELSE CAST(0.5 AS DOUBLE) END AS prob_continuation,
  CASE WHEN rated THEN {rnd(
    "least((CASE bucket WHEN 'SMALL' THEN 0.35::DOUBLE WHEN 'MEDIUM' THEN 0.62::DOUBLE WHEN 'LARGE' THEN 0.80::DOUBLE "
    "WHEN 'EXTREME' THEN 0.92::DOUBLE END) + least((streak-1) * 0.04::DOUBLE, 0.15::DOUBLE), 1::DOUBLE)", 3)}
    ELSE CAST(0 AS DOUBLE) END AS confidence,
  CASE WHEN rated THEN (CASE WHEN std > 0 THEN {rnd('(abs(chg) - mean) / std', 3)} ELSE CAST(0 AS DOUBLE) END) END AS zscore,
  CASE WHEN rated THEN n END AS regime_n"""


def asof(probes: str, target: str, price: str = "found_price", time: str = "found_ms") -> str:
    """First tick at or after `target` for each row of `probes`, smallest id among equal times."""
    return f"""SELECT p.*, f.price AS {price}, f.event_time_ms AS {time}
    FROM (SELECT *, {target} AS _target FROM {probes}) p ASOF LEFT JOIN first_ticks f
      ON p.symbol = f.symbol AND f.event_time_ms >= p._target"""


CTES: dict[str, str] = {
    "ticks": """SELECT event_id AS id,
      CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT' ELSE upper(event_type) END AS symbol,
      'trade' AS event_type, CAST(78000 AS DOUBLE) + value AS price,
      CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS quantity,
      1704067200000 + (epoch_us(ts) - 1704067200000000) // 4000000 AS event_time_ms,
      1704067200000 + (epoch_us(ts) - 1704067200000000) // 4000000 + (event_id * 37) % 400 AS ingest_time_ms,
      (event_id * 37) % 400 AS latency_ms,
      event_id AS trade_id, user_id % 2 = 0 AS is_buyer_maker
    FROM events""",
    "latest": "SELECT max(event_time_ms) AS now_ms FROM ticks",
    "first_ticks": "SELECT symbol, event_time_ms, arg_min(price, id) AS price FROM ticks GROUP BY symbol, event_time_ms",
    "moves": f"""SELECT *, {move('price', 'prev_price')} AS move_pct FROM (
      SELECT *, lag(price) OVER ({W}) AS prev_price, lag(event_time_ms) OVER ({W}) AS prev_ms,
        row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM ticks)""",
    "candles": """SELECT symbol, event_time_ms // 1000 * 1000 AS time_ms,
      arg_min(price, (event_time_ms, id)) AS open, max(price) AS high, min(price) AS low,
      arg_max(price, (event_time_ms, id)) AS close, sum(quantity) AS volume, count(*) AS trades
    FROM ticks GROUP BY symbol, event_time_ms // 1000 * 1000""",
    "candle_moves": "SELECT *, abs((close - open) / open * CAST(100 AS DOUBLE)) AS mv FROM candles WHERE open > 0",
    "candles_ahead": f"""SELECT *, (close - open) / open * CAST(100 AS DOUBLE) AS body, {pct('close_ahead', 'close')} AS after FROM (
      SELECT *, lead(open) OVER c AS next_open, lead(close, 10) OVER c AS close_ahead,
        row_number() OVER c AS rn, count(*) OVER (PARTITION BY symbol) AS n
      FROM candles WINDOW c AS (PARTITION BY symbol ORDER BY time_ms))""",
    "candle_classes": """SELECT *, CASE WHEN abs(body) < 0.005::DOUBLE THEN 'FLAT'
      WHEN body > 0 AND after > 0.003::DOUBLE THEN 'MOMENTUM_UP' WHEN body < 0 AND after < -0.003::DOUBLE THEN 'MOMENTUM_DOWN'
      WHEN body > 0 AND after < -0.003::DOUBLE THEN 'REVERSAL_DOWN' WHEN body < 0 AND after > 0.003::DOUBLE THEN 'REVERSAL_UP'
      ELSE 'NOISE' END AS candle_class FROM candles_ahead WHERE close_ahead IS NOT NULL""",
    "profile": profile_cte("ticks", 100),
    "enriched": enriched_cte("event_time_ms, id"),
    "enriched_desc": enriched_cte("event_time_ms DESC, id DESC"),
    "served": f"SELECT {ENRICHED_COLUMNS} FROM enriched",
    "recorded": """SELECT id, symbol, signal, bucket, confidence, price AS price_entry, event_time_ms FROM served
      WHERE confidence >= 0.62::DOUBLE AND bucket IN ('MEDIUM','LARGE','EXTREME') AND signal NOT IN ('NO_DATA','NO_EDGE')""",
    "priced_10": asof("recorded", "event_time_ms + 8000", "p10", "t10"),
    "priced_30": asof("recorded", "event_time_ms + 28000", "p30", "t30"),
    "settled": """SELECT r.*, CASE WHEN r.event_time_ms < now_ms - 10000 THEN p10 END AS price_10s,
        CASE WHEN r.event_time_ms < now_ms - 10000 THEN p30 END AS price_30s,
        CASE r.bucket WHEN 'SMALL' THEN 0.005::DOUBLE WHEN 'MEDIUM' THEN 0.010::DOUBLE WHEN 'LARGE' THEN 0.020::DOUBLE
          WHEN 'EXTREME' THEN 0.030::DOUBLE ELSE 0.010::DOUBLE END AS thr
      FROM recorded r JOIN priced_10 USING (symbol, id) JOIN priced_30 USING (symbol, id), latest""",
    "outcomes": "SELECT id, symbol, signal, bucket, confidence, price_entry, event_time_ms, price_10s, price_30s, "
    + ", ".join(
        f"""CASE WHEN price_{h}s IS NULL THEN 'PENDING'
        WHEN signal NOT IN ('REV_EDGE','CONT_EDGE') THEN 'NEUTRAL'
        WHEN signal='REV_EDGE' AND {pct(f'price_{h}s', 'price_entry')} < -thr THEN 'WIN'
        WHEN signal='CONT_EDGE' AND {pct(f'price_{h}s', 'price_entry')} > thr THEN 'WIN'
        WHEN abs({pct(f'price_{h}s', 'price_entry')}) < thr * 0.5::DOUBLE THEN 'NEUTRAL' ELSE 'LOSS' END AS result_{h}s"""
        for h in (10, 30)
    ) + " FROM settled",
    "move_stats": """SELECT symbol, avg(abs(price - prev_price)) AS a, stddev_pop(abs(price - prev_price)) AS s
      FROM moves GROUP BY symbol HAVING count(*) >= 10""",
    "spikes_z": """SELECT m.*, z, price - prev_price AS diff, move_pct AS pct,
        CASE WHEN price - prev_price > 0 THEN 'up' ELSE 'down' END AS direction
      FROM (SELECT *, lead(price, 5) OVER w AS price_5, lead(price, 10) OVER w AS price_10, lead(price, 30) OVER w AS price_30,
          sum(quantity) OVER (PARTITION BY symbol ORDER BY event_time_ms, id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS vol_5
        FROM moves WINDOW w AS (PARTITION BY symbol ORDER BY event_time_ms, id)) m
      JOIN move_stats USING (symbol), (SELECT unnest([1.5::DOUBLE, 2.0::DOUBLE, 2.5::DOUBLE, 3.0::DOUBLE]) AS z)
      WHERE abs(price - prev_price) > a + z * s AND move_pct >= 0.01::DOUBLE""",
    "spikes": "SELECT * FROM spikes_z WHERE z = 2",
    "spike_classes": f"""SELECT *, CASE WHEN abs(m30) < 0.005::DOUBLE THEN 'NOISE'
        WHEN abs(m5) > 0.01::DOUBLE AND abs(m30) > abs(m5) * 0.5::DOUBLE THEN 'MOMENTUM' ELSE 'ABSORPTION' END AS spike_class
      FROM (SELECT *, {pct('price_5', 'price')} AS m5, {pct('price_30', 'price')} AS m30 FROM spikes WHERE price_30 IS NOT NULL)""",
    "edge_levels": f"""SELECT symbol, {nearest('mv', .5)} AS p50, {nearest('mv', .75)} AS p75, {nearest('mv', .9)} AS p90,
      {nearest('mv', .99)} AS p99 FROM candle_moves WHERE close > 0 GROUP BY symbol HAVING count(*) >= 50""",
    "edges": f"""SELECT symbol, bucket, n, rev, cont, coalesce({share('rev', '(rev + cont)')}, 0) AS rev_pct,
        coalesce({share('cont', '(rev + cont)')}, 0) AS cont_pct, {rnd('avg_after', 5)} AS avg_after
      FROM (SELECT symbol, bucket, count(*) AS n,
          count(*) FILTER ((body > 0 AND after < -p50*0.5::DOUBLE) OR (body < 0 AND after > p50*0.5::DOUBLE)) AS rev,
          count(*) FILTER ((body > 0 AND after > p50*0.5::DOUBLE) OR (body < 0 AND after < -p50*0.5::DOUBLE)) AS cont,
          avg(after) AS avg_after
        FROM (SELECT *, CASE WHEN abs(body) >= p50 AND abs(body) < p75 THEN 'SMALL' WHEN abs(body) >= p75 AND abs(body) < p90 THEN 'MEDIUM'
            WHEN abs(body) >= p90 AND abs(body) < p99 THEN 'LARGE' WHEN abs(body) >= p99 AND abs(body) < 999 THEN 'EXTREME' END AS bucket
          FROM candles_ahead JOIN edge_levels USING (symbol) WHERE close_ahead IS NOT NULL AND open > 0)
        WHERE bucket IS NOT NULL GROUP BY symbol, bucket)""",
    "edge_labels": """SELECT *, CASE WHEN rev + cont < 5 THEN 'INSUF' WHEN rev_pct > 60 THEN 'REV_EDGE'
        WHEN cont_pct > 60 THEN 'CONT_EDGE' ELSE 'NO_EDGE' END AS edge FROM edges""",
    "symbol_rows": f"""SELECT symbol, count(*) AS candles, {share('count(*) FILTER (abs(body) < 0.002::DOUBLE)', 'count(*)')} AS flat_pct,
        {share('count(*) FILTER (abs(body) >= thr)', 'count(*)')} AS spike_pct, {rnd('max(thr)', 4)} AS spike_thresh,
        {rnd('avg(abs(body))', 5)} AS avg_move, {rnd('stddev_samp(abs(body))', 5)} AS std_move, {rnd('avg(volume)', 4)} AS avg_volume,
        count(*) FILTER (abs(body) >= thr) AS total_spikes,
        count(*) FILTER (abs(body) >= thr AND close_ahead IS NOT NULL AND ((body > 0 AND after < -thr*0.3::DOUBLE) OR (body < 0 AND after > thr*0.3::DOUBLE))) AS reversals,
        count(*) FILTER (abs(body) >= thr AND close_ahead IS NOT NULL AND ((body > 0 AND after > thr*0.3::DOUBLE) OR (body < 0 AND after < -thr*0.3::DOUBLE))) AS continuations
      FROM candles_ahead JOIN (SELECT symbol, {nearest('mv', .99)} AS thr FROM candle_moves GROUP BY symbol HAVING count(*) >= 20) USING (symbol)
      WHERE open > 0 GROUP BY symbol""",
    "symbol_rates": f"""SELECT *, {rnd('coalesce(reversals::DOUBLE / nullif(reversals + continuations, 0) * 100::DOUBLE, 0)', 1)} AS rev_rate,
        {rnd('100::DOUBLE - coalesce(reversals::DOUBLE / nullif(reversals + continuations, 0) * 100::DOUBLE, 0)', 1)} AS cont_rate FROM symbol_rows""",
}


def trades_sql(entries: str, fee: float = 0.001) -> str:
    """Closed trades of `entries` (symbol, id, event_time_ms, price, direction, hold, ...)."""
    return f"""SELECT *, found_ms - event_time_ms AS hold_ms,
      ((CASE WHEN direction='up' THEN (found_price - price) / price ELSE -((found_price - price) / price) END) - 2 * {d(fee)}) * 100::DOUBLE AS pnl
    FROM ({asof(entries, 'event_time_ms + hold * 1000')}) WHERE found_price IS NOT NULL"""


def stats_sql(trades: str, keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS total_trades, {share('count(*) FILTER (pnl > 0)', 'count(*)', 2)} AS win_rate_pct,
      {rnd('sum(pnl)', 4)} AS total_pnl_pct, {rnd('avg(pnl)', 4)} AS avg_pnl_pct, {rnd('max(pnl)', 4)} AS best_trade_pct,
      {rnd('min(pnl)', 4)} AS worst_trade_pct,
      {rnd('abs(coalesce(avg(pnl) FILTER (pnl > 0), 0) / nullif(coalesce(avg(pnl) FILTER (pnl <= 0), 0), 0))', 3)} AS profit_factor,
      {rnd('avg(hold_ms) / 1000', 1)} AS avg_hold_sec, {rnd('avg(latency_ms)', 1)} AS avg_entry_latency_ms,
      count(*) FILTER (pnl > 0) AS winners, count(*) FILTER (pnl <= 0) AS losers, {rnd('max(dd)', 4)} AS max_drawdown_pct
    FROM (SELECT *, greatest(0, max(cum) OVER (PARTITION BY {keys} ORDER BY event_time_ms, id ROWS UNBOUNDED PRECEDING)) - cum AS dd
      FROM (SELECT *, sum(pnl) OVER (PARTITION BY {keys} ORDER BY event_time_ms, id ROWS UNBOUNDED PRECEDING) AS cum FROM {trades}))
    GROUP BY {keys}"""


def held(source: str, holds: list[int], flip: str = "direction") -> str:
    return (f"(SELECT s.* REPLACE ({flip} AS direction), hold FROM {source} s, "
            f"(SELECT unnest({list(holds)}) AS hold))")


FLIPPED = "CASE WHEN direction='down' THEN 'up' ELSE 'down' END"
CTES |= {
    "trades": trades_sql(held("spikes", [30])),
    "stats": stats_sql("trades", "symbol"),
    "sweep_trades": trades_sql(held("spikes", [5, 10, 20, 30, 60], FLIPPED)),
    "class_trades": trades_sql(held(
        "(SELECT * FROM spike_classes WHERE spike_class <> 'MOMENTUM')", [5, 10, 30],
        f"CASE WHEN spike_class='ABSORPTION' THEN {FLIPPED} ELSE direction END")),
    "grid_trades": trades_sql(held("spikes_z", [5, 10, 20, 60])),
}


CTES |= {
    "changes": f"""SELECT *, price - prev_price AS dp, lag(price - prev_price) OVER ({W}) AS dp_prev,
      coalesce(sign(price - prev_price) * quantity, 0) AS c FROM moves""",
    "sampled": "SELECT * FROM changes WHERE rn > 100 AND (rn - 101) % 10 = 0",
    "past_moves": f"""SELECT s.symbol, s.id, avg(m.move_pct) AS mean, stddev_pop(m.move_pct) AS std,
        {nearest('m.move_pct', .75)} AS p75, {nearest('m.move_pct', .90)} AS p90, {nearest('m.move_pct', .99)} AS p99,
        count(*) FILTER (m.move_pct <= s.move_pct)::DOUBLE / count(*) AS rnk,
        covar_pop(m.dp, m.dp_prev) FILTER (m.rn > s.rn - 99) AS cov,
        count(*) FILTER (m.rn > s.rn - 99 AND sign(m.dp) * sign(m.dp_prev) < 0)::DOUBLE / 98 AS flips
      FROM sampled s JOIN changes m ON m.symbol = s.symbol AND m.rn BETWEEN s.rn - 99 AND s.rn - 1 GROUP BY s.symbol, s.id""",
    "past_prices": """SELECT s.symbol, s.id, max(m.price) FILTER (m.rn >= s.rn - 100) - min(m.price) FILTER (m.rn >= s.rn - 100) AS rng,
        count(*) FILTER (m.event_time_ms >= s.event_time_ms - 60000) AS rate
      FROM sampled s JOIN moves m ON m.symbol = s.symbol AND m.rn BETWEEN s.rn - 200 AND s.rn - 1 GROUP BY s.symbol, s.id""",
    "features": f"""SELECT s.id, s.symbol, s.event_time_ms, s.price, {rnd('s.move_pct', 8)} AS spike_pct, {rnd('rnk', 6)} AS spike_rank,
        CASE WHEN std > 0 THEN {rnd('(s.move_pct - mean) / std', 3)} ELSE CAST(0 AS DOUBLE) END AS zscore,
        {bucket_case('s.move_pct')} AS bucket, 'PENDING' AS signal, CAST(0 AS DOUBLE) AS confidence, s.quantity AS volume,
        CASE WHEN cov < 0 THEN {rnd('2 * sqrt(abs(cov))', 8)} ELSE CAST(0 AS DOUBLE) END AS spread_est,
        {rnd('flips', 4)} AS flip_rate, {rnd('rng', 6)} AS micro_range, {rnd('std', 8)} AS volatility_1m, rate AS trade_rate_1m,
        {rnd('(s.event_time_ms // 3600000 % 24)::DOUBLE / 24', 4)} AS hour_of_day, s.latency_ms
      FROM sampled s JOIN past_moves USING (symbol, id) JOIN past_prices USING (symbol, id)""",
    "pre_ticks": """SELECT s.symbol, s.id, m.c, m.quantity AS q, m.move_pct AS x, m.event_time_ms >= s.event_time_ms - 2000 AS in2,
        m.event_time_ms >= s.event_time_ms - 1000 AS in1,
        row_number() OVER (PARTITION BY s.symbol, s.id, m.event_time_ms >= s.event_time_ms - 2000 ORDER BY m.event_time_ms, m.id) AS k,
        row_number() OVER (PARTITION BY s.symbol, s.id ORDER BY m.event_time_ms DESC, m.id DESC) AS r
      FROM sampled s JOIN changes m ON m.symbol = s.symbol AND m.event_time_ms >= s.event_time_ms - 60000
        AND m.event_time_ms < s.event_time_ms""",
    "flow_raw": """SELECT symbol, id, count(*) FILTER (in2) AS n2, count(*) FILTER (in1) AS n1, count(*) AS n60,
        coalesce(sum(c) FILTER (in2 AND k > 1), 0) / greatest(coalesce(sum(q) FILTER (in2 AND k > 1), 0), 1e-10::DOUBLE) AS imb,
        stddev_pop(x) FILTER (in2 AND k > 1 AND r <= 5) AS s5, stddev_pop(x) FILTER (in2 AND k > 1) AS sall
      FROM pre_ticks GROUP BY symbol, id""",
    "post_ticks": """SELECT s.symbol, s.id, count(*) AS np, arg_max(m.price, (m.event_time_ms, m.id)) AS plast
      FROM sampled s JOIN ticks m ON m.symbol = s.symbol AND m.event_time_ms BETWEEN s.event_time_ms AND s.event_time_ms + 500
      GROUP BY s.symbol, s.id""",
    "flow": f"""SELECT s.symbol, s.id, s.event_time_ms,
        CASE WHEN n2 >= 3 THEN {rnd('imb', 6)} END AS imbalance_20,
        CASE WHEN n2 >= 3 THEN {rnd('n1 / (n60 / 60::DOUBLE)', 4)} END AS burst_1s,
        CASE WHEN n2 >= 3 THEN (CASE WHEN n2 >= 6 AND sall > 0 THEN {rnd('s5 / sall', 4)} ELSE CAST(1 AS DOUBLE) END) END AS vol_ratio,
        CASE WHEN n2 >= 3 THEN (CASE WHEN np >= 2 THEN {rnd(pct('plast', 's.price'), 8)} ELSE CAST(0 AS DOUBLE) END) END AS decay_500ms,
        CASE WHEN n2 >= 3 THEN {rnd('imb * (n1 / (n60 / 60::DOUBLE))', 6)} END AS dir_burst
      FROM sampled s LEFT JOIN flow_raw USING (symbol, id) LEFT JOIN post_ticks USING (symbol, id)""",
    "paths": """SELECT symbol, id, event_time_ms, p0, count(*) AS path_ticks, max(p) AS hi, min(p) AS lo FROM (
        SELECT s.symbol, s.id, s.event_time_ms, s.price AS p0, m.price AS p,
          row_number() OVER (PARTITION BY s.symbol, s.id ORDER BY m.event_time_ms, m.id) AS k
        FROM sampled s JOIN ticks m ON m.symbol = s.symbol AND m.event_time_ms BETWEEN s.event_time_ms AND s.event_time_ms + 60000)
      WHERE k <= 200 GROUP BY symbol, id, event_time_ms, p0 HAVING count(*) >= 5""",
}


def path_label(cost: float) -> str:
    up, down, c = pct("hi", "p0"), pct("lo", "p0"), d(cost)
    return f"""SELECT symbol, id, event_time_ms, path_ticks, {rnd(up, 6)} AS max_return, {rnd(down, 6)} AS min_return,
      CASE WHEN {up} > {c} AND {down} > -{c} / 2 THEN 'CONTINUATION_UP' WHEN {down} < -{c} AND {up} < {c} / 2 THEN 'CONTINUATION_DOWN'
        WHEN abs({up}) < {c} AND abs({down}) < {c} THEN 'NOISE' ELSE 'ABSORPTION' END AS micro_label FROM paths"""


CTES |= {
    "labels_01": path_label(0.1),
    "store": """SELECT f.*, imbalance_20, burst_1s, vol_ratio, decay_500ms, dir_burst, micro_label
      FROM features f LEFT JOIN flow USING (symbol, id) LEFT JOIN labels_01 USING (symbol, id)""",
}


def statement(body: str) -> str:
    """`body` with the common table expressions it needs, transitively, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"(?:\bFROM|\bJOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in CTES:
            if other in needed and other != name and re.search(rf"(?:\bFROM|\bJOIN|,)\s+{other}\b", CTES[name]):
                visit(other)
        order.append(name)

    for name in CTES:
        if name in needed:
            visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + "\n" + body
