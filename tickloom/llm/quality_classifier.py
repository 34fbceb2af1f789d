"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages (48 words each). Every passage is encoded as character statistics and
hashed character trigrams, a small layer turns the encoding into a vector, gated attention
(tanh times sigmoid, then a softmax over the text's passages) weighs the vectors, and the score is a
logistic of the weighted sum. Only labels of whole texts are needed; the attention weights say which
passages decide.

Scoring is a narrow map over all whole texts, with a model of some 30 KB. Fitting takes at most
`most` labelled texts (smallest hash of the id first); a longer text is a bag of `MOST_PASSAGES` of its
passages, drawn by hash over the whole text, and of fewer if all bags together would pass `MOST_FITTED`.
These three bounds are the only ones, and they concern fitting alone; of rows that share an id one is fitted.

Defined cases: a null or empty text is one empty passage and gets a score; a label that is null is
ignored and repeated labels of one id count as the largest; without labels of both kinds the score
is the smoothed share of label 1; an empty table gives an empty result; input columns named like a
result give way.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import SEPARATOR, append_columns, hashed_words, mix, repeated, slices, texts
from tickloom.llm.lean import lean
from tickloom.session import materialize

PASSAGE_WORDS = 48
TRIGRAMS = 96
MOST_PASSAGES = 512
MOST_TEXTS = 4096
#: Bytes of text that are encoded together; the working arrays are some sixty times as large.
ENCODED_BYTES = 1 << 18
#: Passages of all fitted texts together; the driver holds their encodings, 432 bytes each with its working copy.
MOST_FITTED = 1 << 18

_KINDS = np.zeros((256, 8), np.float32)  # separator, lower, upper, digit, stop, comma, other ASCII, beyond ASCII
for _c in range(256):
    _k = (0 if SEPARATOR[_c] else 1 if 97 <= _c <= 122 else 2 if 65 <= _c <= 90 else 3 if 48 <= _c <= 57
          else 4 if _c in b".?!" else 5 if _c in b",;:'\"()-" else 6 if _c < 128 else 7)
    _KINDS[_c, _k] = 1
_KIND = _KINDS.argmax(1).astype(np.int64)
WIDTH = 8 + 4 + TRIGRAMS


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of all passages of texts laid end to end, and each text's first passage (with the end)."""
    words = hashed_words(data, offsets)
    n, h = len(words.doc), words.hashes[0]
    first_word = np.concatenate([[0], np.cumsum(words.counts)])
    passages = np.maximum(1, -(-words.counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(passages)])
    of_word = first[words.doc] + (np.arange(n) - first_word[words.doc]) // PASSAGE_WORDS
    # bytes belong to the passage of the last word that began in their text
    of_byte = np.repeat(first[:-1], np.diff(offsets))
    begun = np.zeros(len(data) + 1, np.int64)
    begun[words.start] = 1
    rank = np.cumsum(begun[:-1]) - np.repeat(first_word[:-1], np.diff(offsets))
    of_byte += np.maximum(0, rank - 1) // PASSAGE_WORDS
    m = int(first[-1])
    size = np.maximum(1, np.bincount(of_byte, minlength=m)).astype(np.float32)[:, None]
    kinds = np.bincount(of_byte * 8 + _KIND[data], minlength=m * 8).reshape(m, 8) / size
    n_words = np.bincount(of_word, minlength=m).astype(np.float32)
    some = np.maximum(1, n_words)
    key = h ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = np.bincount(of_word, repeated(key), minlength=m) / some
    length = np.bincount(of_word, words.end - words.start, minlength=m) / some
    same = np.zeros(n, bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    next_same = np.bincount(of_word, same, minlength=m) / some
    b = data.astype(np.uint32)
    grams = np.zeros((m, TRIGRAMS), np.float32)
    if len(b) > 2:
        code = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D))
        code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(16)
        inside = of_byte[:-2] == of_byte[2:]
        at = of_byte[:-2] * TRIGRAMS + (code % np.uint32(TRIGRAMS))
        grams = np.bincount(at[inside], minlength=m * TRIGRAMS).reshape(m, TRIGRAMS) / size
    x = np.concatenate([kinds, again[:, None], next_same[:, None], np.log1p(length)[:, None] / 3,
                        np.log1p(n_words)[:, None] / 4, np.sqrt(grams)], axis=1)
    return x.astype(np.float32), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    """Weights of the encoder layer (W, b), of the gated attention (V, U, w) and of the output (o, c)."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    share: float | None = None  # the constant score, if there were no two kinds of labels

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p = self.weights
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * g) @ p["w"]
        bags = np.diff(first)
        top = np.maximum.reduceat(logit, first[:-1])
        e = np.exp(logit - np.repeat(top, bags))
        a = e / np.repeat(np.add.reduceat(e, first[:-1]), bags)
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["o"] + p["c"])}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(first) - 1, self.share)
        return self.forward(x, first)["y"].astype(np.float64)

    def gradients(self, f: dict, first: np.ndarray, y: np.ndarray) -> dict:
        p, bags = self.weights, np.diff(first)
        dy = (f["y"] - y) / len(y)
        dz = dy[:, None] * p["o"]
        each = np.repeat(dz, bags, axis=0)
        da = (each * f["h"]).sum(1)
        dlogit = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first[:-1]), bags))
        dt = dlogit[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = dlogit[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (each * f["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "o": f["z"].T @ dy, "c": dy.sum(keepdims=True), "w": (f["t"] * f["g"]).T @ dlogit,
            "V": f["h"].T @ dt, "U": f["h"].T @ dg, "W": f["x"].T @ dh, "b": dh.sum(0),
        }


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 32, gate: int = 16, epochs: int = 40,
             batch: int = 64, rate: float = 0.005, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the log loss. bags: passage encodings of each text; labels: 0 or 1."""
    rng = np.random.default_rng(seed)
    sizes = {"W": (WIDTH, hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "o": (hidden,), "c": (1,)}
    weights = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wo" else np.zeros(s)).astype(np.float32)
               for k, s in sizes.items()}
    if len(set(labels.tolist())) < 2:
        ones = float(labels.sum()) if len(labels) else 0.0
        return Model(weights, np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), (ones + 1) / (len(labels) + 2))
    every = np.concatenate(bags)
    model = Model(weights, every.mean(0), np.maximum(every.std(0), 0.02))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            take = order[i : i + batch]
            x = np.concatenate([bags[k] for k in take])
            first = np.concatenate([[0], np.cumsum([len(bags[k]) for k in take])])
            grads = model.gradients(model.forward(x, first), first, labels[take].astype(np.float32))
            step += 1
            pace = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                g = g + decay * weights[k]
                m1, m2 = moment[k]
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                weights[k] -= (pace * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, most: int) -> DataFrame:
    """At most `most` labelled texts: those whose id has the smallest hash.

    The hash bound keeps about a tenth more than `most` rows wherever they lie, so the final ordering is
    over a bounded number of ids whatever the size of the table.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).alias("_label"))
    n = known.count()
    order = F.xxhash64(F.col(id_col).cast("string"))
    if n > most:
        known = known.where(F.pmod(order, F.lit(1 << 30)) <= int((1 << 30) * min(1.0, (1.1 * most + 100) / n)))
    known = known.orderBy(F.pmod(order, F.lit(1 << 30)), id_col).limit(most)
    texts_ = docs.select(F.col(id_col), F.col(text)).join(F.broadcast(known), id_col)  # at most `most` rows of ids
    one = F.min(F.struct(F.xxhash64(text), F.col(text))).alias("_one")  # tasks keep one row of an id that repeats
    return texts_.groupBy(id_col, "_label").agg(one).select(id_col, F.col(f"_one.{text}").alias(text), "_label")


def drawn(passages: int, id_: str, most: int | None = None) -> np.ndarray:
    """Which of a text's passages are fitted: all, or `most` (`MOST_PASSAGES`) drawn over the whole text by hash."""
    most = MOST_PASSAGES if most is None else most
    if passages <= most:
        return np.arange(passages)
    order = mix(np.arange(passages, dtype=np.uint64) + (np.uint64(zlib.crc32(id_.encode())) << np.uint64(32)))
    return np.sort(np.argsort(order)[:most])


def bag_size(passages: list[int], total: int = MOST_FITTED, most: int = MOST_PASSAGES) -> int:
    """The largest size of a bag, `most` at most, with which all bags together have `total` passages at most."""
    left, rest = total, sorted(passages)
    for k, n in enumerate(rest):
        if n * (len(rest) - k) > left:
            return max(1, min(most, left // (len(rest) - k)))
        left -= n
    return most


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        most: int = MOST_TEXTS) -> Model:
    """A model of the labelled texts. Passages are encoded where the texts lie; the driver gets encodings."""

    @lean
    def passages(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in slices(offsets, ENCODED_BYTES):
                x, first = encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = [str(batch.column(0)[r]) for r in range(i, j)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.string()), batch.column(2).slice(i, j - i).cast(pa.int32()),
                    pa.array([x[first[r] + drawn(int(first[r + 1] - first[r]), ids[r], size)].astype(np.float16).tobytes() for r in range(j - i)], pa.binary()),
                ], names=["id", "label", "bag"])

    rows = materialize(sample(docs, labels, id_col, text, label, most).select(F.col(id_col), F.col(text), F.col("_label").cast("int")), "labelled")
    words = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != ""))
    counts = rows.select(F.greatest(F.ceil(words / PASSAGE_WORDS), F.lit(1)).alias("n")).collect()  # at most `most` numbers
    size = bag_size([r["n"] for r in counts])
    got = rows.mapInArrow(passages, "id string, label int, bag binary").collect()  # bounded by `most` and MOST_FITTED
    got.sort(key=lambda r: (r["id"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, WIDTH).astype(np.float32) for r in got]
    return fit_bags(bags, np.array([r["label"] for r in got], np.int64))


def scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each of the texts laid end to end."""
    return np.concatenate([model.score(*encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                           for i, j in slices(offsets, ENCODED_BYTES)])


def score(docs: DataFrame, model: Model, text: str = "text", least: float = 0.3) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 if the score is at least `least`)."""

    def rows(data: np.ndarray, offsets: np.ndarray, _: pa.RecordBatch) -> dict:
        y = scores(model, data, offsets)
        return {"score": y, "predicted": (y >= least).astype(np.int32)}

    return append_columns(docs, text, "score double, predicted int", rows)
