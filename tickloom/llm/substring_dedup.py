"""Substring dedup: words of windows that stood earlier in the corpus go.

A window is `size` consecutive words of one document. A word goes if a window covers it whose words
also start earlier: in a document with a smaller id, or before in the same document. All windows are
judged on the input.

Five steps over blocks of documents (see `blocks`):

1. every block sketches its windows: for each row of a count-min sketch, the cells its windows fall
   into, and whether more than once;
2. owners of cell ranges merge the blocks' sketches by adding counts up, and tell each block which of
   its cells reach two. Counts are over-estimates, so no repeated window is lost;
3. a block's windows whose cells all reach two are candidates. It sends their 128-bit hashes, each
   distinct one once;
4. owners of hash ranges group candidates exactly and tell each block which stood in an earlier block;
5. the block drops the words of windows that stood in an earlier block, or before in the block.

The sketch has eight or more cells a window whatever the size of the corpus (its width follows the
bytes of text), so the share of unique windows that pass it does not grow. Nothing is broadcast.
Windows are equal when their 128-bit hashes are, whose seeds are drawn anew for each run; by chance that is wrong once in
10^12 corpora of 10^13 windows. The texts cross the network once, since all steps share one exchange.

Defined cases: null and empty texts have no words; texts shorter than a window keep all words; rows
with one id count as separate documents, in an order that follows from their texts; rows without an id come last;
an empty table gives an empty result; input columns named like a result give way. Ids are numbers.
"""

from __future__ import annotations

import re
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.arrays import Hasher, covered, hashed_words, mix, numbers, secret_hashers, slices, texts
from tickloom.llm.blocks import (
    BLOCK_BYTES, among, in_blocks, owner_bits, pack_sorted, ranges, text_bytes, unpack_sorted,
)
from tickloom.llm.lean import lean

SIZE = 20
DEPTH = 2
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MESSAGE = "_owner int, _block int, keys binary, more binary"
REPLY = "_block int, step int, _owner int, keys binary"


class Block:
    """The texts of one block in document order, with the hashes of their words."""

    def __init__(self, table: pa.Table, id_col: str, text: str):
        rows = table.column("_row").combine_chunks()
        rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
        names = [f.name for f in rows.type]
        ids, texts_ = rows.field(names.index(id_col)), rows.field(names.index(text))
        order = pa.compute.sort_indices(pa.table({"id": ids, "text": texts_}), [("id", "ascending"), ("text", "ascending")])
        self.rows, column = rows.take(order), texts_.take(order)
        self.data, self.offsets = texts(column)
        self.nulls = column.is_null().to_numpy(zero_copy_only=False)

    def windows(self, size: int, hashers: tuple[Hasher, Hasher]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all windows (numbered through the block) and the two halves of their hashes."""
        parts, before = [[], [], []], 0
        for i, j in slices(self.offsets):
            a, b = self.offsets[i], self.offsets[j]
            words = hashed_words(self.data[a:b], self.offsets[i : j + 1] - a, hashers)
            first = words.within(size)
            for out, x in zip(parts, (first + before, *(h.windows(w, first, size) for h, w in zip(hashers, words.hashes)))):
                out.append(x)
            before += len(words.doc)
        return tuple(np.concatenate(p) for p in parts) if parts[0] else (np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 2)


def without(text: bytes, lost: np.ndarray) -> bytes:
    """`text` without the words marked in `lost`."""
    spans = np.array([m.span() for m in _WORD.finditer(text)])
    stays = np.flatnonzero(~lost)
    if not len(stays):
        return b""
    # a stretch of words that stay, up to the next word that goes
    first = stays[np.diff(stays, prepend=-2) > 1]
    last = stays[np.diff(stays, append=len(lost) + 1) > 1]
    begin = np.where(first == 0, 0, spans[first, 0])
    end = np.append(spans[last[:-1] + 1, 0], spans[last[-1], 1] if last[-1] + 1 < len(lost) else len(text))
    return b"".join(text[a:b] for a, b in zip(begin, end))


def _cells(h: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    return mix(h ^ numbers(97 + row, 1)[0]) >> np.uint64(64 - width_bits)


def _batch(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), kinds[t]) for n, t, c in zip(names, types, columns)})


def _by_step(replies: pa.Table, step: int) -> list[dict]:
    return sorted((r for r in replies.to_pylist() if r["step"] == step), key=lambda r: r["_owner"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE, depth: int = DEPTH,
          block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """`docs` with `n_words`, `n_removed` and `kept_text`: the words that stay, joined by one space.

    With `cut` it is the text itself, out of which the removed words are cut with the white space that follows them, or at the
    end of the text with the white space before; a text that loses no word stays as it is, null included.
    """
    new = ["n_words", "n_removed", "kept_text"]
    kept = [c for c in docs.columns if c not in new]
    total = text_bytes(docs, text)
    rows, blocks = in_blocks(docs, id_col, total, block_bytes, text)
    bits = owner_bits(blocks)
    width_bits = max(bits + 8, 16, (2 * total).bit_length())  # a window takes four bytes of text or more
    by_block, hashers = rows.groupBy("_block"), secret_hashers(2)

    @lean
    def sketch(key: tuple, table: pa.Table) -> pa.Table:
        _, h, _ = Block(table, id_col, text).windows(size, hashers)
        out = []
        for row in range(depth):
            cells, counts = np.unique(_cells(h, row, width_bits), return_counts=True)
            for owner, i, j in ranges(cells, bits, width_bits):
                out.append(((row << bits) + owner, key[0].as_py(), pack_sorted(cells[i:j]), np.packbits(counts[i:j] > 1).tobytes()))
        return _batch(MESSAGE, out)

    @lean
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        sent = [(r["_block"], unpack_sorted(r["keys"]), r["more"]) for r in table.to_pylist()]
        every = np.sort(np.concatenate([k for _, k, _ in sent]))
        full = [every[1:][every[1:] == every[:-1]]]
        full += [k[np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool)] for _, k, m in sent]
        full = np.unique(np.concatenate(full))
        out = [(b, 0, key[0].as_py(), pack_sorted(hit)) for b, k, _ in sent if len(hit := k[among(k, full)])]
        return _batch(REPLY, out)

    def candidates(block: Block, replies: pa.Table) -> tuple:
        """First words of candidates, the sorted distinct hashes, and for each candidate its place among these."""
        first, h, g = block.windows(size, hashers)
        told = _by_step(replies, 0)
        for row in range(depth):
            full = [unpack_sorted(r["keys"]) for r in told if r["_owner"] >> bits == row]
            hit = among(_cells(h, row, width_bits), np.concatenate(full) if full else np.zeros(0, np.uint64))
            first, h, g = first[hit], h[hit], g[hit]
        order = np.lexsort((first, g, h))
        h, g, first = h[order], g[order], first[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        return first, h[fresh], g[fresh], np.cumsum(fresh) - 1, fresh

    @lean
    def send(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _batch(MESSAGE, [])
        _, h, g, _, _ = candidates(Block(table, id_col, text), replies)
        return _batch(MESSAGE, [(owner, key[0].as_py(), pack_sorted(h[i:j]), g[i:j].tobytes()) for owner, i, j in ranges(h, bits)])

    @lean
    def group(key: tuple, table: pa.Table) -> pa.Table:
        sent = sorted(((r["_block"], unpack_sorted(r["keys"]), np.frombuffer(r["more"], np.uint64)) for r in table.to_pylist()),
                      key=lambda x: x[0])
        h, g = np.concatenate([x[1] for x in sent]), np.concatenate([x[2] for x in sent])
        # a stable sort leaves equal hashes in the order of their blocks
        order = np.lexsort((g, h))
        later = np.zeros(len(h), bool)
        later[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] == g[order[:-1]])
        out, at = [], 0
        for block, k, _ in sent:
            out.append((block, 1, key[0].as_py(), np.packbits(later[at : at + len(k)]).tobytes()))
            at += len(k)
        return _batch(REPLY, out)

    frame = StructType([rows.schema["_row"], *StructType.fromDDL("n_words long, n_removed long, kept_text string").fields])

    @lean
    def drop(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        names = frame.names
        if not table.num_rows:
            return pa.table({"_row": table.column("_row"), **{n: pa.array([], pa.string() if n == "kept_text" else pa.int64()) for n in names[1:]}})
        block = Block(table, id_col, text)
        first, h, _, place, fresh = candidates(block, replies)
        told = {r["_owner"]: r["keys"] for r in _by_step(replies, 1)}
        earlier = np.zeros(len(h), bool)
        for owner, i, j in ranges(h, bits):
            earlier[i:j] = np.unpackbits(np.frombuffer(told[owner], np.uint8), count=j - i)
        gone = np.sort(first[earlier[place] | ~fresh])
        raw, counts, removed, out, before = block.data.tobytes(), [], [], [], 0
        nulls = block.nulls if cut else None
        for a, b in zip(block.offsets[:-1], block.offsets[1:]):
            words = raw[a:b].split()
            n = len(words)
            here = gone[np.searchsorted(gone, before) : np.searchsorted(gone, before + n)] - before
            before += n
            counts.append(n)
            lost = covered(here, size, n) if len(here) else None
            removed.append(int(lost.sum()) if lost is not None else 0)
            if not cut:
                out.append(b" ".join(words if lost is None else compress(words, ~lost)))
            elif not removed[-1]:
                out.append(raw[a:b])
            else:
                out.append(without(raw[a:b], lost))
        return pa.table({"_row": block.rows, "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(out, pa.binary(), mask=nulls).cast(pa.string())})

    full = by_block.applyInArrow(sketch, MESSAGE).groupBy("_owner").applyInArrow(merge, REPLY)
    sent = by_block.cogroup(full.groupBy("_block")).applyInArrow(send, MESSAGE)
    known = full.unionByName(sent.groupBy("_owner").applyInArrow(group, REPLY))
    done = by_block.cogroup(known.groupBy("_block")).applyInArrow(drop, frame)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *new)
