"""Features from a declarative spec: windows, normalization, event filter, leakage guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import config
from tickloom.functions.scalars import pct_move, rnd
from tickloom.operators.asof import asof_forward
from tickloom.operators.layout import BEFORE_NOW, RANK_CHUNK, UNTIL_NOW, chunk_of_rank, chunk_window, with_rank
from tickloom.operators.tape import TOTALS, number, totals_at
from tickloom.session import materialize

UNITS = {"ms": 1, "s": 1_000, "m": 60_000}


def duration_ms(text: str) -> int:
    """'250ms', '1s', '5m' in milliseconds."""
    unit = "ms" if text.endswith("ms") else text[-1]
    return int(text[: -len(unit)]) * UNITS[unit]


def _rate(n: Column, window_ms: int, base: Column, base_ms: int) -> Column:
    """Ticks per second in a window over ticks per second in the baseline."""
    return F.try_divide(n / F.lit(window_ms / 1000.0), base / F.lit(base_ms / 1000.0))


def check_spec(spec: dict) -> None:
    names = {f["name"] for f in spec["features"]}
    leaky = names & (set(spec.get("excluded", ())) | config.LEAKY_COLUMNS)
    if leaky:
        raise ValueError(f"features computed from the future: {sorted(leaky)}")
    unknown = names - set(FORMULAS)
    if unknown:
        raise ValueError(f"no formula for: {sorted(unknown)}")
    if spec["normalization"]["method"] != "rolling_zscore":
        raise ValueError("only rolling_zscore is known")


# Each formula sees the windows `fast` and `medium`, the ticks in the baseline, and the price `back` at the start of `fast`.
FORMULAS = {
    "signed_imbalance_1s": lambda w: w["fast"]["signed"],
    "burst_1s": lambda w: _rate(w["fast"]["n"], w["fast_ms"], w["base_n"], w["base_ms"]),
    "ret_1s": lambda w: F.try_divide(F.col("p0") - w["back"], w["back"]),
    "vol_ratio_1s_5s": lambda w: F.try_divide(w["fast"]["std_x"], w["medium"]["std_x"]),
    "burst_accel_1s_5s": lambda w: _rate(w["fast"]["n"], w["fast_ms"], w["base_n"], w["base_ms"])
    - _rate(w["medium"]["n"], w["medium_ms"], w["base_n"], w["base_ms"]),
}


def _window(name: str) -> dict[str, Column]:
    """Ticks, signed volume and deviation of moves of a window, without its first tick's change, from its totals."""
    total = {c: number(*[F.col(f"{name}_{c}{k}") for k in range(3)]) for c in ("c", "x", "xx")}
    n_x = F.col(f"{name}_n_x")
    mean = F.try_divide(total["x"], n_x)
    # equal moves have no spread: counted exactly, not left to rounding of totals
    var = F.when(n_x <= 0, F.lit(None)).when(F.col(f"{name}_n_diff") - F.col(f"{name}_next_d") <= 0, F.lit(0.0)).otherwise(
        F.greatest(F.try_divide(total["xx"], n_x) - mean * mean, F.lit(0.0)))
    signed = F.when(F.col(f"{name}_n_q") > 0, total["c"]).otherwise(F.lit(0.0))
    return {"n": F.col("_rn_first") - F.col(name), "signed": signed, "std_x": F.sqrt(var)}


def _sums_between(rows: DataFrame, names: list[str]) -> DataFrame:
    """`rows` (symbol, _rn, _start, _rn_first, _n) with count, sum and sum of squares of each of `names` over the rows _start to _rn_first - 1.

    Sums run inside chunks of rows; sums of earlier chunks, a row each, cancel out where both ends lie in one chunk.
    """
    parts = {}
    for n in names:
        parts |= {f"n_{n}": F.col(n).isNotNull().cast("double"), f"s_{n}": F.coalesce(n, F.lit(0.0)), f"q_{n}": F.coalesce(F.col(n) * F.col(n), F.lit(0.0))}
    chunked = rows.withColumn("_chunk", chunk_of_rank(F.col("_rn"), RANK_CHUNK))
    run = chunk_window("_rn").rowsBetween(*UNTIL_NOW)
    totals = chunked.groupBy("symbol", "_chunk").agg(*[F.sum(v).alias(c) for c, v in parts.items()])
    earlier = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(*BEFORE_NOW)
    bases = totals.select("symbol", "_chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0.0)).alias(f"_b_{c}") for c in parts])
    state = chunked.select("symbol", "_chunk", "_rn", *[F.sum(v).over(run).alias(c) for c, v in parts.items()]).join(bases, ["symbol", "_chunk"])
    state = state.select("symbol", "_rn", F.struct(*parts, *[f"_b_{c}" for c in parts]).alias("_at"))
    met = rows
    for end, at in (("_to", F.col("_rn_first") - 1), ("_from", F.col("_start") - 1)):
        met = met.withColumn("_end", at).join(
            state.select("symbol", F.col("_rn").alias("_end"), F.col("_at").alias(end)), ["symbol", "_end"], "left").drop("_end")
    of = lambda end, c: F.coalesce(F.col(f"{end}.{c}"), F.lit(0.0))
    return met.withColumns({c: (of("_to", f"_b_{c}") - of("_from", f"_b_{c}")) + (of("_to", c) - of("_from", c)) for c in parts}).drop("_to", "_from")


def spec_features(ticks: DataFrame, profile: DataFrame, spec: dict | None = None) -> DataFrame:
    """The features of a spec for its asset's events.

    Windows are [t - w, t). A normalized feature is its z-score against the values of
    the baseline window, null with fewer than `min_periods` of them. Windows are ranges of row numbers, found by one as-of
    pass, and their sums differences of totals, so no task holds more than a chunk or a slot of ticks whatever the density.
    """
    spec = spec or config.ETH_FLOW_SPEC
    check_spec(spec)
    fast, medium, base = (duration_ms(spec["windows"][k]) for k in ("fast", "medium", "baseline"))
    norm = duration_ms(spec["normalization"]["baseline_window"])
    cols = ticks.filter(F.col("symbol") == spec["asset"]).select("id", "symbol", "event_time_ms", "price", "quantity")
    ranked = with_rank(cols, peers=True)
    ends = {"fast": -fast, "medium": -medium, "base": -base, "norm": -norm, "back": 1 - fast}
    steps = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ms).cast("bigint").alias("ms")) for n, ms in ends.items()])
    probes = ranked.withColumn("_e", F.explode(steps)).select(
        "symbol", "id", "event_time_ms", "price", F.col("_rn").alias("_own"), "_rn_first", "_n",
        F.col("_e.name").alias("_name"), (F.col("event_time_ms") + F.col("_e.ms")).alias("target_ms"))
    # a target is never after its tick, so there is always a tick at or after it
    found = asof_forward(probes, ranked, offsets=list(ends.values()), fetch=("_rn",), crowd=cols)
    name, end = F.col("_name"), F.col("found__rn")
    asked = found.select(
        "symbol", "id", "event_time_ms", F.col("price").alias("p0"), "_own", "_rn_first", "_n", "_name", end.alias("_end"),
        F.when(name.isin("fast", "medium"), end).when(name == "back", end - 1).when(name == "norm", F.col("_own") - 1)
        .otherwise(F.col("_rn_first") - 1).alias("_rn"))
    met = totals_at(ranked, asked, RANK_CHUNK)
    of = lambda n, c: F.max(F.when(name == n, F.col(c)))
    gaps = {}
    for w in ("fast", "medium"):
        sign = F.when(name == "base", F.lit(1)).when(name == w, F.lit(-1)).otherwise(F.lit(0)).cast("bigint")
        gaps |= {f"{w}_{c}": F.sum(sign * F.col(c)) for c in TOTALS if c[0] != "q"} | {f"{w}_next_d": of(w, "at_next_d")}
    rows = met.groupBy("symbol", "id", "event_time_ms", "p0", F.col("_own").alias("_rn"), "_rn_first", "_n").agg(
        *[of(n, "_end").alias(n) for n in ends if n != "back"], of("back", "at_price").alias("_back"), of("norm", "at_price").alias("p_prev"),
        *[v.alias(c) for c, v in gaps.items()])
    windows = {
        "fast": _window("fast"), "medium": _window("medium"), "fast_ms": fast, "medium_ms": medium, "base_ms": base,
        "base_n": F.col("_rn_first") - F.col("base"), "back": F.col("_back"),
    }
    names = [f["name"] for f in spec["features"]]
    raw = rows.select("symbol", "id", "event_time_ms", "p0", "p_prev", "_rn", "_rn_first", "_n", F.col("norm").alias("_start"),
                      *[FORMULAS[n](windows).alias(n) for n in names])
    scaled = [f["name"] for f in spec["features"] if f["normalize"]]
    # every job below reads these rows, so they are written once
    seen = _sums_between(materialize(raw, "spec_rows"), scaled)

    def zscore(n: str) -> Column:
        mean = F.try_divide(F.col(f"s_{n}"), F.col(f"n_{n}"))
        std = F.sqrt(F.greatest(F.try_divide(F.col(f"q_{n}"), F.col(f"n_{n}")) - mean * mean, F.lit(0.0)))
        return F.when(F.col(f"n_{n}") >= spec["normalization"]["min_periods"], F.try_divide(F.col(n) - mean, std))

    level = spec["event_filter"]["spike_percentile"].rstrip("+")
    bar = profile.filter(F.col("symbol") == spec["asset"]).agg(F.max(level).alias("bar")).scalar()
    return seen.filter(pct_move(F.col("p0"), F.col("p_prev")) >= bar).select(
        "symbol", "id", "event_time_ms",
        *[rnd(zscore(n) if n in scaled else F.col(n), 6).alias(n) for n in names],
    )
