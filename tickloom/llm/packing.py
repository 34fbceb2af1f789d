"""Harmonic packing of token sequences.

A class holds the pieces whose length lies between two reciprocals of the capacity: with the steps
1, 2, ..., 16, 18, 20, ..., a piece of class k fills at most capacity / k, and a sequence of the class
takes exactly k pieces. Nothing is compared between classes or workers, so every worker fills its
own sequences independently.

Documents may be cut, so a document gives up pieces of the exact size capacity / k, largest first,
until at most a sixteenth of the capacity is left; that rest is one piece. Only rests leave padding.

What does not fill a sequence at its worker (fewer than k pieces a class) is numbered over all workers
by counts for each class and worker and filled in the same way. The part sequences left after that,
at most one a class whatever the input, are put together by first fit.

Token ids come from a tokenizer file. Each worker remembers the ids of a bounded number of words.

Defined cases: a null or empty text is one piece with the end id alone; repeated rows are packed one by
one; an empty table gives an empty result; input columns named like a result give way. The pieces are
written to the shared folder once, since they feed several jobs.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.llm.arrays import LOWER, SEPARATOR, slices, texts
from tickloom.llm.lean import kept, lean
from tickloom.llm.recent import Recent
from tickloom.session import materialize

CAPACITY = 4096
END_ID = 2
WHOLE_BELOW = 16  # a rest of at most capacity / 16 stays whole
MOST_WORDS = 400_000
SLICE_BYTES = 2 << 20  # of texts that are coded together


@cache
def steps(capacity: int) -> np.ndarray:
    """Pieces a sequence, by class: 1 to 16, then eight steps to each doubling, and `capacity`."""
    out = list(range(1, WHOLE_BELOW + 1))
    while out[-1] < capacity:
        out.append(out[-1] + max(1, (1 << (out[-1].bit_length() - 1)) // 8))
    return np.array([k for k in out if k < capacity] + [capacity])


@cache
def step_of(length: int, capacity: int) -> int:
    """The largest step whose share of the capacity holds `length`."""
    ks = steps(capacity)
    return int(ks[np.searchsorted(ks, capacity // length, "right") - 1])


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    out, at = [], 0
    while length - at > capacity // WHOLE_BELOW:
        k = -(-capacity // (length - at))  # the largest reciprocal that the rest fills
        out.append((at, capacity // k))
        at += capacity // k
    if length > at:
        out.append((at, length - at))
    return out


#: What a byte is to the cutting of words: white space, an ASCII letter or digit, another ASCII character, beyond ASCII.
_SPACE, _LETTER, _MARK, _BEYOND = range(4)
_KIND = np.array([_SPACE if SEPARATOR[c] else _BEYOND if c > 127 else _LETTER if chr(c).isalnum() else _MARK for c in range(256)], np.uint8)


class WordCoder:
    """Ids of texts by a tokenizer that lower-cases and whose parts never reach over white space.

    White space only separates, so a text's ids are those of its words, which come from memory: numpy cuts the words of many
    texts, Arrow numbers the different ones, and only these are looked up; the ids of all follow by number. Words are
    cut after their first letters and digits, and a new word is split from its closing marks, where the tokenizer splits
    them in any case. New words of letters are encoded in one string and told apart by the ids that end a word; others one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.like_special = [t.translate(self._LOWER) for t in self.special]
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.ends = ends
        self.apart: dict[str, bool] = {}
        self.known = Recent(MOST_WORDS)

    _CLOSING = re.compile(rb"[!-/:-@\[-`{-~]+$")
    _LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    #: A run that ends in an ASCII letter or digit, where another ASCII character, white space or the end follows; or a whole word.
    _WORD = re.compile(rb"[a-z0-9\x80-\xff]++(?<=[a-z0-9])|[^\x09-\x0D ]+")

    def _words(self, text: bytes) -> list[bytes]:
        low = text.translate(self._LOWER)
        if any(t in low for t in self.like_special):  # special tokens count as written, so case matters
            return text.split()
        return self._WORD.findall(low)

    def _apart(self, c: str) -> bool:
        """Whether the tokenizer splits a character, normalised, from a mark after it."""
        if c not in self.apart:
            normal = self.tokenizer.normalizer.normalize_str(c + ".")
            self.apart[c] = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)[-1][0] == "."
        return self.apart[c]

    def _parts(self, word: bytes) -> list[bytes]:
        m = self._CLOSING.search(word)
        if m and m.start() and b"'" not in m[0] and self._apart(word[: m.start()].decode()[-1]) and not any(x in word for x in self.special):
            return [word[: m.start()], m[0]]
        return [word]

    def _encode(self, parts: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        letters = [p for p in parts if p.isalpha() or p.decode().isalpha()]
        for i in range(0, len(letters), 512):
            some = letters[i : i + 512]
            [found] = self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids):
                raw, stops = ids.tobytes(), (4 * stops).tolist()
                out |= {p: raw[a:b] for p, a, b in zip(some, [0, *stops], stops)}
        rest = [p for p in parts if p not in out]
        got = self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)
        return out | {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(rest, got)}

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of different words that are not remembered yet, and from now on are."""
        lost = self.known.lacking(words)
        known = self.known.now
        parts = {w: ps for w in lost if not w.isalnum() and len(ps := self._parts(w)) > 1}
        known |= self._encode(list({p for w in lost for p in parts.get(w, (w,)) if p not in known}))
        known |= {w: b"".join([known[p] for p in ps]) for w, ps in parts.items()}
        return known

    def _cut_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words of texts laid end to end, and each text's first word (with the end)."""
        low = LOWER[data]
        raw = low.tobytes()
        if any(t in raw for t in self.like_special):
            each = [self._words(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            return pa.array([w for ws in each for w in ws], pa.large_binary()), np.concatenate([[0], np.cumsum([len(ws) for ws in each])])
        kind = _KIND[low]
        word = kind != _SPACE
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        border = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[border] = word[border]
        # a word is cut at its first mark, if an ASCII letter or digit stands before that
        start, marks = np.flatnonzero(begins), np.flatnonzero(kind == _MARK)
        of = np.searchsorted(start, marks, "right") - 1
        first = np.ones(len(of), bool)
        first[1:] = of[1:] != of[:-1]
        marks, of = marks[first], of[first]
        begins[marks[(marks > start[of]) & (kind[marks - 1] == _LETTER)]] = True
        at = np.append(np.flatnonzero(begins[word]), np.count_nonzero(word))
        first_word = np.searchsorted(np.flatnonzero(begins), offsets)
        held = [None, pa.py_buffer(at), pa.py_buffer(low[word])]
        return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, held), first_word

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of UTF-8 texts laid end to end, as little-endian 32-bit numbers, and the byte where each text's begin (with the end)."""
        words, first_word = self._cut_words(data, offsets)
        coded = words.dictionary_encode()
        _, ends, held = coded.dictionary.buffers()
        raw, ends = held.to_pybytes() if held else b"", np.frombuffer(ends, np.int64)[: len(coded.dictionary) + 1].tolist()
        different = [raw[a:b] for a, b in zip(ends, ends[1:])]
        got = list(map(self.known.now.get, different))
        if None in got:
            known = self._learn([w for w, x in zip(different, got) if x is None])
            got = [known[w] if x is None else x for w, x in zip(different, got)]
        out = pa.array(got, pa.large_binary()).take(coded.indices)
        if not len(out):
            return pa.py_buffer(b""), np.zeros(len(offsets), np.int64)
        _, ends, ids = out.buffers()
        return ids, np.frombuffer(ends, np.int64)[out.offset : out.offset + len(out) + 1][first_word]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts as little-endian 32-bit numbers."""
        ids, at = self.ids(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        return [ids[a:b].to_pybytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


@kept
def _coder(path: str) -> WordCoder:
    return WordCoder(path)


PIECE = "start long, length long, doc_tokens long, ids binary"
PLACE = "step int, worker long, nth long, sequence_id long, offset long"
#: Sequence ids: the worker (or, above all workers, the class or the last bins) and a running number.
RUN_BITS, CLASSES_FROM, LAST_BINS = 33, 1 << 26, 1 << 28


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: the columns of `docs` but the text, PIECE and PLACE.

    A worker holds the open sequence of each class back (at most one capacity of ids a class) and lets it
    go when it is full. Pieces of sequences that never fill have no sequence id yet.
    """
    new = [*StructType.fromDDL(PIECE).names, *StructType.fromDDL(PLACE).names]
    kept = [c for c in docs.columns if c not in new and c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))
    frame = docs.select(row.alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))
    fields = StructType.fromDDL(f"{PIECE}, {PLACE}").fields
    out = StructType([StructField("_row", frame.schema["_row"].dataType), *fields])
    kinds = {f.name: pa.binary() if f.name == "ids" else pa.int32() if f.name == "step" else pa.int64() for f in fields}
    length_at = 1 + [f.name for f in fields].index("length")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = end_id.to_bytes(4, "little")
        worker, done = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple]] = {}  # step -> open sequence: (row, fields...)

        def let_go(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[1 + c] for r in rows], kinds[f.name]) for c, f in enumerate(fields)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays([r[0] for r in rows]), *columns], names=out.names)

        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                ids, at = _coder(tokenizer).ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at, ready = at.tolist(), []
                for r in range(i, j):
                    own = ids[at[r - i] : at[r - i + 1]].to_pybytes() + end
                    total = len(own) // 4
                    row = batch.column(0).slice(r, 1)
                    for start, length in cut(total, capacity):
                        step = step_of(length, capacity)
                        open_ = waiting.setdefault(step, [])
                        offset = open_[-1][length_at] + open_[-1][-1] if open_ else 0
                        open_.append((row, start, length, total, own[4 * start : 4 * (start + length)], step, worker,
                                      len(open_), None, offset))
                        if len(open_) == step:
                            ready += [(*x[:-2], (worker << RUN_BITS) + done, x[-1]) for x in waiting.pop(step)]
                            done += 1
                if ready:
                    yield let_go(ready)
        rest = [(*x[:-2], None, None) for xs in waiting.values() for x in xs]
        if rest:
            yield let_go(rest)

    done = frame.mapInArrow(run, out)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *new)


def first_fit(totals: list[tuple[int, int]], capacity: int) -> dict[int, tuple[int, int]]:
    """For each (key, total) a bin and the offset there, largest first."""
    used: list[int] = []
    out = {}
    for key, total in sorted(totals, key=lambda x: (-x[1], x[0])):
        b = next((i for i, u in enumerate(used) if u + total <= capacity), len(used))
        if b == len(used):
            used.append(0)
        out[key] = (b, used[b])
        used[b] += total
    return out


def pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with `sequence_id` and `offset`; `ids` holds a piece's ids as little-endian 32-bit numbers.

    Padding of a sequence is its class's; nothing else is stored of it.
    """
    spark = docs.sparkSession
    table = materialize(pieces(docs, tokenizer, text, capacity, end_id), "pieces")
    rest = table.where(F.col("sequence_id").isNull())
    counts = rest.groupBy("step", "worker").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("step").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy("step"))
    plan = counts.select("step", "worker", F.coalesce(before, F.lit(0)).alias("_before"), total.alias("_total"))
    rank = F.col("nth") + F.col("_before")
    rest = rest.join(plan, ["step", "worker"]).withColumns({
        "_bin": F.floor(rank / F.col("step")).cast("long"), "_slot": rank % F.col("step"),
        "_last": F.floor(F.col("_total") / F.col("step")).cast("long"),
    })
    # the last sequence of a class is not full: one part at most for each class, put together by first fit
    parts = rest.where(F.col("_bin") == F.col("_last")).groupBy("step").agg(F.sum("length").alias("t")).collect()
    put = first_fit([(r["step"], r["t"]) for r in parts], capacity)
    joined = spark.createDataFrame([(k, b, o) for k, (b, o) in put.items()], "step int, _to long, _at long")
    at = F.sum("length").over(Window.partitionBy("step", "_bin").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    at = F.coalesce(at, F.lit(0))
    rest = rest.withColumn("_offset", at).join(F.broadcast(joined), "step", "left")  # a row for each class
    is_part = F.col("_bin") == F.col("_last")
    run = F.lit(1 << RUN_BITS)
    rest = rest.withColumns({
        "sequence_id": F.when(is_part, F.lit(LAST_BINS) * run + F.col("_to")).otherwise((F.col("step") + CLASSES_FROM) * run + F.col("_bin")),
        "offset": F.when(is_part, F.col("_at") + F.col("_offset")).otherwise(F.col("_offset")),
    })
    out = [c for c in table.columns if c not in ("step", "worker", "nth")]
    return table.where(F.col("sequence_id").isNotNull()).select(out).unionByName(rest.select(out))
