"""The constants that results depend on, stated as plain tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Percentile buckets, smallest move first.
BUCKETS = ("SMALL", "MEDIUM", "LARGE", "EXTREME")

# Fixed values: (symbol, bucket, signal, probability of reversal, of continuation).
EDGE_MAP = [
    ("BTCUSDT", "SMALL", "REV_EDGE", 0.63, 0.37),
    ("BTCUSDT", "MEDIUM", "REV_EDGE", 0.73, 0.27),
    ("BTCUSDT", "EXTREME", "CONT_EDGE", 0.13, 0.87),
    ("ETHUSDT", "LARGE", "CONT_EDGE", 0.30, 0.70),
    ("ETHUSDT", "EXTREME", "CONT_EDGE", 0.29, 0.71),
]

# The first edition of the edge map, where the label is a word and
# the signal follows from the probabilities.
EDGE_MAP_V1 = [
    ("BTCUSDT", "MEDIUM", "REVERSAL", 0.66, 0.34),
    ("BTCUSDT", "LARGE", "CONTINUATION", 0.28, 0.72),
    ("ETHUSDT", "SMALL", "REVERSAL", 0.61, 0.39),
    ("ETHUSDT", "LARGE", "CONTINUATION", 0.40, 0.60),
    ("ETHUSDT", "EXTREME", "CONTINUATION", 0.25, 0.75),
]

# Base confidence and outcome threshold (percent) per bucket.
BASE_CONFIDENCE = {"SMALL": 0.35, "MEDIUM": 0.62, "LARGE": 0.80, "EXTREME": 0.92}
OUTCOME_THRESHOLD = {"SMALL": 0.005, "MEDIUM": 0.010, "LARGE": 0.020, "EXTREME": 0.030}
DEFAULT_THRESHOLD = 0.010

# Streak bonus per repeat, its ceiling, and the streak ceiling.
STREAK_STEP = 0.04
STREAK_BONUS_MAX = 0.15
STREAK_CAP = 10

# Gate for recording a signal.
RECORD_MIN_CONFIDENCE = 0.62
RECORD_BUCKETS = ("MEDIUM", "LARGE", "EXTREME")

# Model inputs, long and short form.
FLOW_FEATURES = [
    "spike_pct", "zscore", "spread_est", "volatility_1m", "latency_ms",
    "imbalance_20", "burst_1s", "vol_ratio", "dir_burst",
]
BASE_FEATURES = [
    "spike_pct", "zscore", "spread_est", "volatility_1m",
    "trade_rate_1m", "hour_of_day", "latency_ms",
]

# Columns computed from ticks after the row's own time; never model inputs.
LEAKY_COLUMNS = frozenset({
    "decay_500ms", "micro_label", "outcome_10s", "outcome_30s", "label_30s", "label_60s",
    "post_spike_decay", "max_adverse_excursion", "max_favorable_excursion", "retrace_ratio",
})


def keyed_case(key: Column, table: dict, default=None) -> Column:
    """A small fixed table as a CASE expression on `key` (no join, no shuffle)."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


# A declarative feature set. Windows, normalization, and features as
# published; `excluded` names what must never become an input.
ETH_FLOW_SPEC = {
    "name": "eth_flow_v1",
    "asset": "ETHUSDT",
    "target": "CONTINUATION_vs_ABSORPTION",
    "event_filter": {"spike_percentile": "p75+"},
    "windows": {"short": "250ms", "fast": "1s", "medium": "5s", "baseline": "60s"},
    "normalization": {"method": "rolling_zscore", "baseline_window": "60s", "min_periods": 30},
    "features": [
        {"name": "signed_imbalance_1s", "normalize": True},
        {"name": "burst_1s", "normalize": False},
        {"name": "ret_1s", "normalize": True},
        {"name": "vol_ratio_1s_5s", "normalize": False},
        {"name": "burst_accel_1s_5s", "normalize": False},
    ],
    "excluded": ["post_spike_decay", "max_adverse_excursion", "max_favorable_excursion", "retrace_ratio"],
}

# Texts of a scored signal.
CONTINUATION_TEXT = "%s spike — directional momentum detected. Continuation likely (%.0f%%)."
ABSORPTION_TEXT = "%s spike — absorption pattern. Reversal likely (%.0f%%)."
