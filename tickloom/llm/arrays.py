"""Words, hashes and windows of many texts at once, as numpy arrays.

Arrow hands a batch's texts over as one byte buffer with offsets. The helpers below work on
that buffer, so a task never loops over words in Python. Texts are cut into slices of a few
megabytes (`slices`), and one very long text is hashed piece by piece (`hashed_words`), so
memory follows the slice, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from os import urandom

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.lean import lean

SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 20

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value; one to one."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """`n` fixed 64-bit values of a seed."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x1000003))


#: Longer words than this many bytes are hashed one by one.
LONG_WORD = 64
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_TURN = np.uint64(0xD6E8FEB86659FD93)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two stretches that follow one another."""
    return mix(a * _TURN + b)


@dataclass(frozen=True)
class Hasher:
    """64-bit hashes of words; two hashers with different seeds give 128 bits.

    Each eight bytes of a word pass through a mixing step that is neither a sum nor a product of what came before, and
    so do the halves of a window, so no words or windows share a hash by their structure, whatever the seed. Where equal hashes
    decide what is dropped or linked, the seeds are drawn anew for each run (`secret_hashers`): nobody can look for equal ones beforehand.
    """

    seed: int

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        held = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(data) + 1,), np.uint64, held, 0, (1,))  # the eight bytes from each place on
        size = end - start
        out = mix(size.astype(np.uint64) ^ np.uint64(self.seed))
        longest = int(size.max(initial=0))
        for at in range(0, min(longest, LONG_WORD), 8):
            some = slice(None) if at == 0 else np.flatnonzero(size > at)
            out[some] = mix(out[some] ^ (eight[start[some] + at] & _KEEP[np.minimum(size[some] - at, 8)]))
        if longest > LONG_WORD:
            key, raw = self.seed.to_bytes(8, "little"), memoryview(data)
            for k in np.flatnonzero(size > LONG_WORD):
                out[k] = int.from_bytes(blake2b(raw[start[k] : end[k]], digest_size=8, key=key).digest(), "little")
        return out

    def windows(self, words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
        """The hash of each run of `size` words that begins at one of `first`: halves joined, then halves of these."""
        if not len(first):
            return np.zeros(0, np.uint64)
        low, high = int(first.min()), int(first.max()) + size
        runs, first = words[low:high], first - low  # of 1, 2, 4, ... words
        out, taken, length = None, 0, 1
        while True:
            if size & length:
                part = runs[first + taken]
                out = part if out is None else _joined(out, part)
                taken += length
            if taken == size:
                return mix(out + np.uint64(size))
            runs, length = _joined(runs[:-length], runs[length:]), 2 * length


FIRST, SECOND = Hasher(int(numbers(11, 1)[0])), Hasher(int(numbers(23, 1)[0]))


def secret_hashers(n: int) -> tuple[Hasher, ...]:
    """Hashers that nobody knows before; all tasks of a run must be given the same ones."""
    return tuple(Hasher(int.from_bytes(urandom(8), "little")) for _ in range(n))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes of text; a longer text has a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


@dataclass
class Words:
    start: np.ndarray  # byte positions in the slice's data
    end: np.ndarray
    doc: np.ndarray  # row of the text within the slice
    hashes: list[np.ndarray]  # one array for each hasher
    counts: np.ndarray  # words of each text

    def within(self, size: int) -> np.ndarray:
        """Where runs of `size` words of one text begin."""
        n = len(self.doc)
        if n < size:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[: n - size + 1] == self.doc[size - 1 :])


def _cut(data: np.ndarray, a: int, limit: int) -> int:
    """The end of a piece from `a` that cuts no word."""
    n = len(data)
    b = min(n, a + limit)
    while b < n:
        near = np.flatnonzero(SEPARATOR[data[b : b + limit]])
        if len(near):
            return b + int(near[0])
        b = min(n, b + limit)
    return b


def hashed_words(data: np.ndarray, offsets: np.ndarray, hashers: tuple[Hasher, ...] = (FIRST,)) -> Words:
    """Words of texts laid end to end, with their hashes. A word is a run of non-separators within one text."""
    n, starts, ends, hashes = len(data), [], [], [[] for _ in hashers]
    opens = np.unique(offsets[:-1])
    a = 0
    while a < n:
        b = _cut(data, a, PIECE_BYTES)
        part = data[a:b]
        word = ~SEPARATOR[part]
        border = opens[np.searchsorted(opens, a) : np.searchsorted(opens, b)] - a  # a text begins here
        fresh = word.copy()
        fresh[1:] &= ~word[:-1]
        fresh[border] = word[border]
        last = word.copy()
        last[:-1] &= ~word[1:]
        closed = border[border > 0] - 1
        last[closed] = word[closed]
        s, e = np.flatnonzero(fresh), np.flatnonzero(last) + 1
        for out, h in zip(hashes, hashers):
            out.append(h.words(part, s, e))
        starts.append(s + a)
        ends.append(e + a)
        a = b
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = join(starts, np.int64)
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(start, join(ends, np.int64), doc, [join(h, np.uint64) for h in hashes],
                 np.bincount(doc, minlength=len(offsets) - 1)[: len(offsets) - 1])


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of byte-wise values by text; empty texts give 0."""
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def covered(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of `n` places lie in a window of `size` that begins at one of `first`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.subtract.at(edge, first + size, 1)
    return np.cumsum(edge[:-1]) > 0


Rows = Callable[[np.ndarray, np.ndarray, pa.RecordBatch], dict]


def append_columns(df: DataFrame, text: str, schema: str, rows: Rows) -> DataFrame:
    """`df` with the columns that `rows(bytes, offsets, slice)` computes from the texts.

    A narrow map: no exchange. Columns of `df` named like a new one give way to it.
    """
    new = StructType.fromDDL(schema)
    kept = [c for c in df.columns if c not in new.names]
    taken = list(dict.fromkeys([*kept, text]))
    frame = df.select(F.struct(*[F.col(f"`{c}`") for c in taken]).alias("_row"))
    out = StructType.fromDDL(schema)
    out = StructType([frame.schema["_row"], *out.fields])

    @lean
    def run(batches):
        for batch in batches:
            row = batch.column(0)
            data, offsets = texts(row.field(taken.index(text)))
            for i, j in slices(offsets):
                a, b = offsets[i], offsets[j]
                got = rows(data[a:b], offsets[i : j + 1] - a, batch.slice(i, j - i))
                columns = [x if isinstance(x := got[f.name], pa.Array) else pa.array(x) for f in new.fields]
                yield pa.RecordBatch.from_arrays([row.slice(i, j - i), *columns], names=out.names)

    done = frame.mapInArrow(run, out)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *[F.col(n) for n in new.names])
