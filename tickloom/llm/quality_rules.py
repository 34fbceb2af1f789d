"""Quality rules by weak supervision.

Every rule votes good, votes bad or abstains on a text. How often the rules agree tells how
accurate each one is: expectation maximisation over the counts of vote patterns estimates each
rule's accuracy on good and on bad texts, and the posterior probability that a text is good replaces
"all rules must pass".

One narrow pass over the texts computes the statistics, which are written (without texts) to the
shared folder. There are at most 3^9 vote patterns whatever the number of texts, so their counts
over all texts are the whole input of the estimation, and the verdicts join back by pattern.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows are judged
one by one; an empty table gives an empty result; input columns named like a result give way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import append_columns, covered, hashed_words, mix, per_text, repeated, secret_hashers
from tickloom.session import materialize

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_letters long, n_marks long, n_digits long"
)


def _lines(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


#: Windows are compared inside a text only, so each process has a hasher of its own.
_OWN = secret_hashers(1)


def _statistics(data: np.ndarray, offsets: np.ndarray, _: pa.RecordBatch) -> dict:
    words = hashed_words(data, offsets, _OWN)
    n, h = len(words.doc), words.hashes[0]
    first = words.within(3)
    keys = mix(_OWN[0].windows(h, first, 3) ^ mix(words.doc[first].astype(np.uint64)))
    in_repeat = covered(first[repeated(keys)], 3, n) if n else np.zeros(0, bool)
    code_point = (data & 0xC0) != 0x80
    separator = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    raw = data.tobytes()
    lines = [_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_text(code_point & ~separator, offsets),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.array([x[1] for x in lines], np.int64),
        "n_repeat_words": np.bincount(words.doc, in_repeat, minlength=len(offsets) - 1).astype(np.int64),
        "n_lines": np.array([x[0] for x in lines], np.int64),
        "n_upper": per_text(upper, offsets),
        "n_letters": per_text(upper | lower, offsets),
        "n_marks": per_text(data == ord("!"), offsets),
        "n_digits": per_text((data >= 48) & (data <= 57), offsets),
    }


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    return append_columns(docs, text, STATISTICS, _statistics)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """1 good, 0 bad, 2 abstains (also without a value)."""
    return F.when(value.isNull(), 2).when(good, 1).when(bad, 0).otherwise(2)


def votes() -> list[Column]:
    """The rules. Each one has a band of values on which it abstains."""
    words, lines = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("n_lines"), F.lit(0))
    symbols, repeats = F.col("n_symbols") / words, F.col("n_repeat_words") / words
    dups, marks, digits = F.col("n_dup_lines") / lines, F.col("n_marks") / words, F.col("n_digits") / words
    length, upper = F.col("word_chars") / words, F.col("n_upper") / F.nullif(F.col("n_letters"), F.lit(0))
    return [
        _vote(words, words >= 80, words < 30),
        _vote(symbols, symbols < 0.02, symbols > 0.15),
        _vote(repeats, repeats < 0.1, repeats > 0.3),
        _vote(dups, dups < 0.1, dups > 0.4),
        _vote(upper, upper < 0.15, upper > 0.4),
        _vote(marks, marks < 0.02, marks > 0.15),
        _vote(length, length.between(3.0, 9.0), (length < 2.0) | (length > 14.0)),
        _vote(digits, digits < 0.3, digits > 1.0),
        _vote(words, (symbols + marks + repeats) < 0.1, (symbols + marks + repeats) > 0.5),
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior probability of "good" for each vote pattern.

    patterns: rows of votes 0, 1, 2; counts: texts with that pattern. Starts from the share of good
    votes, so "good" is the class that the rules themselves call good. An abstention says nothing.
    Rates are smoothed by three texts, two of them in favour of the rule being right.
    """
    if not len(patterns):
        return np.zeros(0)
    says_good, says_bad = (patterns == 1).astype(float), (patterns == 0).astype(float)
    good = (1.0 + says_good.sum(1)) / (2.0 + says_good.sum(1) + 3.0 * says_bad.sum(1))
    for _ in range(rounds):
        before, odds = good, 0.0
        for side, weight in ((-1, (1 - good) * counts), (1, good * counts)):
            # how often each rule says "good" of this class, among the texts on which it votes
            yes, no = weight @ says_good + 1.5 + 0.5 * side, weight @ says_bad + 1.5 - 0.5 * side
            odds += side * (says_good @ np.log(yes / (yes + no)) + says_bad @ np.log(no / (yes + no)))
            odds += side * np.log((weight.sum() + 1) / (counts.sum() + 2))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(good - before).max() < 1e-9:
            break
    return good


def judge(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Every column of `docs` but the text, the statistics, `base_failed`, `quality` (posterior) and `kept`."""
    spark = docs.sparkSession
    rules = votes()
    pattern = sum((v * 3**i for i, v in enumerate(rules)), F.lit(0))
    new = ["base_failed", "votes", "quality", "kept"]
    table = statistics(docs, text).drop(text, *new).withColumns({"base_failed": base_failed(), "votes": pattern.cast("int")})
    table = materialize(table, "quality-rules")
    found = table.groupBy("votes").count().collect()  # at most 3^9 rows
    codes = np.array([r["votes"] for r in found], np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(len(rules))) % 3
    quality = estimate(patterns, np.array([r["count"] for r in found], float))
    verdicts = spark.createDataFrame([(int(c), float(q)) for c, q in zip(codes, quality)], "votes int, quality double")
    joined = table.join(F.broadcast(verdicts), "votes", "left")  # a row for each pattern
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
