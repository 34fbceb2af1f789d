"""Many logistic models at once by Newton steps.

All models look at the same rows, each at its own subset of the inputs. In each step one aggregate over
the rows gives every model its loss, its slopes and its matrix of second derivatives: tasks sum them up with
numpy over Arrow batches, a hash aggregate adds the tasks up, and the driver gets one small matrix a model,
whatever the number of rows. There a step is solved: in closed form for an L2 penalty, by coordinate
descent with soft thresholds for an L1 penalty (a proximal Newton step). A step that makes the loss larger is halved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import ship

MOST_STEPS = 60
CLOSE = 1e-10


@dataclass
class Fit:
    """Weights of one model; inputs that it does not use have weight 0."""

    features: tuple[str, ...]
    used: tuple[str, ...]
    weights: np.ndarray
    intercept: float
    steps: int = 0
    gap: float = field(default=float("inf"))  # the largest violated slope, against the size of its input

    def named(self) -> dict[str, float]:
        return {f: float(w) for f, w in zip(self.features, self.weights) if f in self.used}


def _moments(rows: DataFrame, features: Sequence[str], label: str, weight: str | None, at: np.ndarray) -> np.ndarray:
    """For each model (a row of `at`: weights, then the intercept) the loss, slopes, second derivatives and input sizes.

    Laid out as a (models, 1 + d + d * d + d) array.
    """
    ship(rows.sparkSession)
    models, d = at.shape
    width = 1 + d + d * d + d

    def add(batches):
        total = np.zeros((models, width))
        seen = False
        for batch in batches:
            seen = True
            x = np.column_stack([*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))), np.ones(batch.num_rows)])
            y, w = (batch.column(len(features) + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            z = x @ at.T
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            total[:, 0] += w @ (np.logaddexp(0.0, z) - y[:, None] * z)
            off, curve = w[:, None] * (p - y[:, None]), w[:, None] * p * (1.0 - p)
            total[:, 1 : 1 + d] += off.T @ x
            for m in range(models):
                total[m, 1 + d : 1 + d + d * d] += (x.T @ (x * curve[:, m : m + 1])).ravel()
            total[:, 1 + d + d * d :] += w @ np.abs(x)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(models * width, dtype=np.int32)), pa.array(total.ravel())], names=["k", "v"])

    inputs = [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    weighed = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    parts = rows.select(*inputs, F.col(label).cast("double").alias("y"), weighed.alias("w")).mapInArrow(add, "k int, v double")
    out = np.zeros(models * width)
    for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect():  # models * width numbers
        out[r["k"]] = r["v"]
    return out.reshape(models, width)


def _soft(x: float, by: float) -> float:
    return np.sign(x) * max(0.0, abs(x) - by)


def _step(w: np.ndarray, slopes: np.ndarray, curve: np.ndarray, free: np.ndarray, penalised: np.ndarray, l1: bool) -> np.ndarray:
    """The weights that minimise the quadratic model of c * loss around `w`, plus the penalty."""
    curve = curve + 1e-12 * np.eye(len(w))
    if not l1:
        a = (curve + np.diag(penalised.astype(float)))[np.ix_(free, free)]
        new = w.copy()
        new[free] -= np.linalg.solve(a, slopes[free] + np.where(penalised, w, 0.0)[free])
        return new
    new = w.copy()
    for _ in range(10_000):
        moved = 0.0
        for j in np.flatnonzero(free):
            g = slopes[j] + curve[j] @ (new - w)
            to = new[j] - g / curve[j, j]
            to = _soft(to, 1.0 / curve[j, j]) if penalised[j] else to
            moved = max(moved, abs(to - new[j]) * np.sqrt(curve[j, j]))
            new[j] = to
        if moved < 1e-13:
            break
    return new


def fit_subsets(
    rows: DataFrame, features: Sequence[str], subsets: Sequence[Sequence[str]], c: float = 0.1, penalty: str = "l2",
    weight: str | None = None, penalise_intercept: bool = False, label: str = "label", most_steps: int = MOST_STEPS,
) -> list[Fit]:
    """One model for each subset of `features`: the minimum of c * summed losses + penalty.

    Each step reads the rows once for all models. Without rows all weights are 0.
    """
    d, l1 = len(features) + 1, penalty == "l1"
    penalised = np.array([True] * len(features) + [penalise_intercept])
    free = [np.array([f in set(s) for f in features] + [True]) for s in subsets]
    at = np.zeros((len(subsets), d))
    fits = [Fit(tuple(features), tuple(s), at[m, :-1], 0.0) for m, s in enumerate(subsets)]
    best = [(np.inf, at[m].copy()) for m in range(len(subsets))]
    open_ = set(range(len(subsets)))
    for step in range(1, most_steps + 1):
        found = _moments(rows, features, label, weight, at)
        for m in sorted(open_):
            loss, slopes = c * found[m, 0], c * found[m, 1 : 1 + d]
            curve, sizes = c * found[m, 1 + d : 1 + d + d * d].reshape(d, d), c * found[m, 1 + d + d * d :]
            w = at[m].copy()
            size = np.abs(w[penalised]).sum() if l1 else 0.5 * (w[penalised] ** 2).sum()
            if loss + size > best[m][0] * (1 + 1e-12) + 1e-12:
                at[m] = (w + best[m][1]) / 2  # too far: half the way
                continue
            best[m] = (loss + size, w)
            if l1:
                pull = np.where(w != 0, np.abs(slopes + np.sign(w)), np.maximum(np.abs(slopes) - 1.0, 0.0))
            else:
                pull = np.abs(slopes + w)
            pull = np.where(penalised, pull, np.abs(slopes)) / np.maximum(sizes, 1.0)
            fits[m] = Fit(tuple(features), tuple(subsets[m]), w[:-1].copy(), float(w[-1]), step, float(pull[free[m]].max()))
            if fits[m].gap < CLOSE or not sizes.any():
                open_.discard(m)
            else:
                at[m] = _step(w, slopes, curve, free[m], penalised, l1)
        if not open_:
            break
    return fits
