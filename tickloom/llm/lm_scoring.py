"""Language-model scoring.

A gated recurrent network (see `recurrent`) reads the lower-cased words of each whole document and an
end token. Its vocabulary grows with the training corpus: of V distinct words the 2 sqrt(V) most frequent
(1,024 at least; at the border words whose counts differ by less than a tenth are chosen by hash) have an
embedding and an output of their own, in as many classes as the root of their number. All rarer words are
dealt by hash to a quarter as many classes, each with an embedding and an output, inside which a word's
probability follows from its count in the training corpus. So every text has a probability, and the whole
vocabulary is covered by counts over all training documents.

Steps:

1. word counts over all training documents: tasks send their distinct words, packed, to the owners of
   hash ranges (see `blocks`), whose counts are written to the shared folder;
2. training: the training documents, as word ids, are dealt by hash to shards of some four million tokens and to rounds. In each
   round every shard trains by truncated backpropagation from the common weights, and the shards' weights are averaged by
   tokens, in levels of groups. Shards follow from the texts, so what is learned does not depend on partitions or tasks;
3. scoring by blocks of documents: a block asks the owners once for each distinct word's count,
   then computes the base score and the network's score of each document. The texts cross the network
   once, since asking and scoring share one exchange.

The weights take some 270 bytes a word of the network; they are the only thing that tasks get whole. Words are told apart by
64-bit hashes: among 10^10 distinct words some three pairs share a hash, and then their counts.

Defined cases: null and empty texts consist of the end token; repeated rows count and are scored one by
one; without training rows, counts are 0 and the network is untrained; an empty table gives an
empty result; input columns named like a result give way. Ids are numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.arrays import FIRST, LOWER, hashed_words, mix, numbers, slices, texts
from tickloom.llm.blocks import BLOCK_BYTES, in_blocks, owner_bits, pack, pack_sorted, ranges, text_bytes, unpack, unpack_sorted
from tickloom.llm.lean import lean
from tickloom.llm.recurrent import Adam, Network
from tickloom.session import fresh_path, materialize

END = numbers(3, 1)[0]
WORDS = 1024
#: Levels of counts in each doubling.
LEVELS = 8
HIDDEN = 16
ROUNDS = 2
TRAIN_LANES, SCORE_LANES = 512, 1024
#: Training tokens of a shard, which one task trains on, a part in each round.
SHARD_TOKENS = 4_000_000
#: In training the state starts anew after so many tokens of a document, so that a long one is no longer than a lane.
SEGMENT = 4096
LM_BLOCK_BYTES = 3 * BLOCK_BYTES
#: A task hands its counts on when it holds so many distinct words.
HELD = 2_000_000
RESULTS = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of texts laid end to end, and each text's number of tokens."""
    words = hashed_words(LOWER[data], offsets)
    lengths = words.counts + 1
    out = np.full(int(lengths.sum()), END, np.uint64)
    out[np.arange(len(words.doc)) + words.doc] = words.hashes[0]
    return out, lengths


def _parts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = texts(column)
    for i, j in slices(offsets):
        yield token_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their total counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def count_words(texts_: DataFrame, bits: int) -> DataFrame:
    """(_owner, keys, counts): the counts of all words of a one-column table, an owner's in one row."""

    @lean
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def hand_on() -> pa.RecordBatch:
            k, c = _added(keys, counts)
            rows = [(owner, pack_sorted(k[i:j]), pack(c[i:j])) for owner, i, j in ranges(k, bits)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[n] for r in rows], pa.binary()) for n in (1, 2))],
                                              names=["_owner", "keys", "counts"])

        for batch in batches:
            for hashes, _ in _parts(batch.column(0)):
                k, c = np.unique(hashes, return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > HELD:
                    k, c = _added(keys, counts)
                    keys, counts, held = [k], [c], len(k)
                    if held > HELD // 2:
                        yield hand_on()
                        keys, counts, held = [], [], 0
        if keys:
            yield hand_on()

    @lean
    def total(key: tuple, table: pa.Table) -> pa.Table:
        k, c = _added([unpack_sorted(x.as_py()) for x in table.column("keys")], [unpack(x.as_py()).astype(np.int64) for x in table.column("counts")])
        return pa.table({"_owner": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([pack_sorted(k)]), "counts": pa.array([pack(c)])})

    schema = "_owner int, keys binary, counts binary"
    return texts_.mapInArrow(local, schema).groupBy("_owner").applyInArrow(total, schema)


def network_words(distinct: int) -> int:
    """How many of the distinct words the network knows one by one."""
    return min(distinct, max(WORDS, int(2 * distinct**0.5)))


def rare_classes(words: int) -> int:
    return max(1, round(words**0.5) // 4)


def _rare_class(hashes: np.ndarray, classes: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(classes)).astype(np.int64)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(LEVELS * np.log2(counts)).astype(np.int64)


@dataclass
class Vocabulary:
    """The most frequent words (hashes, by falling count), the corpus totals and those of each class of rarer words."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    rare_tokens: np.ndarray
    rare_distinct: np.ndarray

    def __post_init__(self):
        order = np.argsort(self.words)
        self._sorted, self._rank = self.words[order], order

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        n = len(self.words)
        if not n:
            return 1 + _rare_class(hashes, len(self.rare_tokens))  # rarer than the network's one word
        at = np.minimum(np.searchsorted(self._sorted, hashes), n - 1)
        out = self._rank[at]
        rare = np.flatnonzero(self._sorted[at] != hashes)
        out[rare] = n + _rare_class(hashes[rare], len(self.rare_tokens))
        return out


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals and the most frequent words.

    Words are counted by level of their count; whole levels are taken from the top, and of the level at the
    border those with the smallest hashes. So no task sorts or gathers words, and the driver gets those taken.
    """

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for keys, numbers_ in zip(batch.column(1), batch.column(2)):
                yield unpack_sorted(keys.as_py()), unpack(numbers_.as_py()).astype(np.int64)

    def by_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, c in held(batches):
            level = _levels(c)
            some = np.unique(level)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.bincount(level)[some]), pa.array(np.bincount(level, c)[some].astype(np.int64))],
                                             names=["level", "n", "tokens"])

    packed = counts.select("_owner", "keys", "counts")
    levels = packed.mapInArrow(by_level, "level long, n long, tokens long").groupBy("level").agg(
        F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).collect()
    levels.sort(key=lambda x: -x["level"])
    distinct = sum(x["n"] for x in levels)
    wanted = network_words(distinct)
    classes, left, border, share = rare_classes(wanted), wanted, 0, 1.0
    for x in levels:
        border, share = x["level"], min(1.0, left / x["n"])
        left -= x["n"]
        if left <= 0:
            break

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, c in held(batches):
            level = _levels(c)
            taken = (level > border) | (level == border) & ((mix(~k) >> np.uint64(11)).astype(np.float64) < share * 2.0**53)
            kind, rest = _rare_class(k[~taken], classes), c[~taken]
            some = np.unique(kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(np.full(int(taken.sum()), -1), some)),
                pa.array(np.append(k[taken].view(np.int64), np.bincount(kind, minlength=1)[some])),
                pa.array(np.append(c[taken], np.bincount(kind, rest, 1)[some].astype(np.int64)))], names=["kind", "word", "n"])

    rows = packed.mapInArrow(dealt, "kind long, word long, n long")
    top = rows.where("kind < 0").select("word", "n").collect()
    words, n = np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64)
    order = np.lexsort((words, -n))
    rare = np.zeros((2, classes), np.int64)
    for r in rows.where("kind >= 0").groupBy("kind").agg(F.sum("n").alias("t"), F.sum("word").alias("d")).collect():
        rare[:, r["kind"]] = r["t"], r["d"]
    return Vocabulary(words[order], n[order], sum(x["tokens"] for x in levels), distinct, *rare)


def shards(texts_: DataFrame, known: Vocabulary, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, int]:
    """(_shard, _key, ids, _round) of the texts of a one-column table, and the number of shards.

    A text's shard and round follow from its words alone, so they are the same however the table is partitioned; equal texts are
    dealt in turn, so that copies do not gather in one shard. The table is written by round.
    """
    count = max(1, round(known.tokens / shard_tokens))
    kind = np.uint16 if len(known.words) + len(known.rare_tokens) < 1 << 16 else np.uint32
    schema = "_shard int, _key long, ids binary, _round int"

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, lengths in _parts(batch.column(0)):
                first = np.cumsum(lengths) - lengths
                key = mix(np.add.reduceat(mix(hashes + mix(np.arange(len(hashes), dtype=np.uint64) - np.repeat(first, lengths).astype(np.uint64))), first))
                order = np.argsort(key, kind="stable")
                fresh = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
                turn = np.empty(len(key), np.uint64)
                turn[order] = np.arange(len(key)) - np.repeat(fresh, np.diff(fresh, append=len(key)))
                ids = known.ids(hashes).astype(kind)
                yield pa.RecordBatch.from_arrays([
                    pa.array(((key + turn) % np.uint64(count)).astype(np.int32)), pa.array(key.view(np.int64)),
                    pa.array([ids[i : i + n].tobytes() for i, n in zip(first, lengths)], pa.binary()),
                    pa.array(((key >> np.uint64(32)) % np.uint64(rounds)).astype(np.int32))], names=["_shard", "_key", "ids", "_round"])

    path = fresh_path(texts_.sparkSession, "training")
    dealt = texts_.mapInArrow(deal, schema)
    dealt.write.partitionBy("_round").parquet(path)
    return texts_.sparkSession.read.schema(dealt.schema).parquet(path), count


def train_lanes(tokens: int, rounds: int, most: int = TRAIN_LANES) -> int:
    """Lanes side by side: all of them for a round of SHARD_TOKENS, fewer for fewer tokens, which so make more updates."""
    return int(max(4, min(most, most * (rounds * tokens / SHARD_TOKENS) ** 1.5)))


def train(texts_: DataFrame, known: Vocabulary, rounds: int = ROUNDS, hidden: int = HIDDEN, rate: float = 0.01,
          shard_tokens: int = SHARD_TOKENS) -> Network:
    """Weights after `rounds` rounds. In each of them every shard trains on its texts of that round from the common weights, and
    weights are averaged by tokens. What is learned depends on the texts, not on partitions or tasks."""
    n = max(1, len(known.words))
    net = Network(n, round(n**0.5), hidden, rare=len(known.rare_tokens)).with_frequencies(
        known.counts if len(known.words) else np.ones(1), known.rare_tokens)
    rows, count = shards(texts_, known, rounds, shard_tokens)
    kind = np.uint16 if len(known.words) + len(known.rare_tokens) < 1 << 16 else np.uint32
    schema = "slot int, n long, weights binary"

    def result(slot: int, n: int, flat: np.ndarray) -> pa.Table:
        return pa.table({"slot": pa.array([slot], pa.int32()), "n": pa.array([n], pa.int64()), "weights": pa.array([flat.astype(np.float32).tobytes()], pa.binary())})

    def average(key: tuple, table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        flat = sum(np.frombuffer(w.as_py(), np.float32) * np.float64(k) for w, k in zip(table.column("weights"), sizes)) / max(1, sum(sizes))
        return result(key[0].as_py(), sum(sizes), flat)

    for r in range(rounds):
        begun, pace = net, rate / (1 + r)

        @lean
        def learn(key: tuple, table: pa.Table) -> pa.Table:
            own = begun.from_flat(begun.flat())
            table = table.sort_by([("_key", "ascending")])
            texts_of = [np.frombuffer(x.as_py(), kind) for x in table.column("ids")]
            lengths = np.array([n for x in texts_of for n in (*[SEGMENT] * ((len(x) - 1) // SEGMENT), (len(x) - 1) % SEGMENT + 1)])
            ids = np.concatenate(texts_of).astype(np.int64)
            own.train(ids, lengths, Adam(own.p, pace), train_lanes(len(ids), rounds))
            return result(key[0].as_py(), len(ids), own.flat())

        # as many tasks as shards: they are small, but each is some seconds of work
        learned = rows.where(F.col("_round") == r).select("_shard", "_key", "ids").repartition(count, "_shard").groupBy("_shard").applyInArrow(learn, schema)
        for groups in (1024, 32, 1):
            if groups < count or groups == 1:
                learned = learned.withColumn("slot", F.col("slot") % groups).groupBy("slot").applyInArrow(average, schema)
        for x in learned.collect():  # one row
            net = begun.from_flat(np.frombuffer(x["weights"], np.float32))
    return net


def score(docs: DataFrame, counts: DataFrame, known: Vocabulary, net: Network, id_col: str, text: str, total: int, bits: int,
          block_bytes: int = LM_BLOCK_BYTES) -> DataFrame:
    """`docs` with RESULTS."""
    new = StructType.fromDDL(RESULTS).names
    kept = [c for c in docs.columns if c not in new]
    rows, _ = in_blocks(docs, id_col, total, block_bytes, text)
    place = docs.columns.index(text)
    by_block = rows.groupBy("_block")
    asks, told = "_owner int, _block int, keys binary", "_block int, _owner int, counts binary"

    def tokens(table: pa.Table) -> tuple[pa.Array, list]:
        column = table.column("_row").combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        return column, list(_parts(column.field(place)))

    def distinct(parts: list) -> np.ndarray:
        return np.unique(np.concatenate([np.unique(h) for h, _ in parts]))

    @lean
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        keys = distinct(tokens(table)[1])
        out = [(owner, key[0].as_py(), pack_sorted(keys[i:j])) for owner, i, j in ranges(keys, bits)]
        return pa.table({"_owner": pa.array([x[0] for x in out], pa.int32()), "_block": pa.array([x[1] for x in out], pa.int32()),
                         "keys": pa.array([x[2] for x in out], pa.binary())})

    @lean
    def answer(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        k, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if held.num_rows:
            k, c = unpack_sorted(held.column("keys")[0].as_py()), unpack(held.column("counts")[0].as_py()).astype(np.int64)
        out = []
        for block, keys in zip(asked.column("_block").to_pylist(), asked.column("keys")):
            want = unpack_sorted(keys.as_py())
            at = np.minimum(np.searchsorted(k, want), max(0, len(k) - 1))
            out.append((block, pack(np.where(k[at] == want, c[at], 0) if len(k) else np.zeros(len(want)))))
        return pa.table({"_block": pa.array([x[0] for x in out], pa.int32()), "_owner": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "counts": pa.array([x[1] for x in out], pa.binary())})

    frame = StructType([rows.schema["_row"], *StructType.fromDDL(RESULTS).fields])
    base_of, rare_of = np.log10(known.tokens + known.distinct + 1), np.log(known.rare_tokens + known.rare_distinct + 1)

    @lean
    def scored(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        column, parts = tokens(table)
        out = {n: [] for n in new}
        if table.num_rows:
            keys = distinct(parts)
            sent = sorted(zip(replies.column("_owner").to_pylist(), replies.column("counts").to_pylist()), key=lambda x: x[0])
            counts_ = np.concatenate([unpack(x) for _, x in sent]).astype(np.int64)
            id_of = known.ids(keys)
            rare = id_of >= net.words
            in_class = np.where(rare, np.log(counts_ + 1) - rare_of[np.where(rare, id_of - net.words, 0)], 0)
            at = [np.searchsorted(keys, h) for h, _ in parts]
            network = net.score(np.concatenate([id_of[a] for a in at]), np.concatenate([x for _, x in parts]), SCORE_LANES)
            done = 0
            for a, (hashes, lengths) in zip(at, parts):
                c = counts_[a]
                logs = network[done : done + len(hashes)] + in_class[a]
                done += len(hashes)
                first = np.cumsum(lengths) - lengths
                out["n_tokens"].append(lengths)
                out["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), first))
                out["train_tokens"].append(np.full(len(lengths), known.tokens))
                out["base_score"].append(np.add.reduceat(np.log10(c + 1) - base_of, first))
                out["score"].append(np.add.reduceat(logs, first) / np.log(10))
        kinds = [pa.float64() if "score" in n else pa.int64() for n in new]
        return pa.table({"_row": column, **{n: pa.array(np.concatenate(out[n]) if out[n] else [], k) for n, k in zip(new, kinds)}})

    asked = by_block.applyInArrow(ask, asks)
    replies = asked.groupBy("_owner").cogroup(counts.groupBy("_owner")).applyInArrow(answer, told)
    done = by_block.cogroup(replies.groupBy("_block")).applyInArrow(scored, frame)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *new)


def fit_and_score(docs: DataFrame, learns_from, id_col: str = "doc_id", text: str = "text", block_bytes: int = LM_BLOCK_BYTES,
                  shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Learns from the rows where the column `learns_from` holds, scores all."""
    total = text_bytes(docs, text)
    bits = owner_bits(max(1, -(-total // block_bytes)))
    training = docs.where(learns_from)
    counts = materialize(count_words(training.select(text), bits), "word-counts")
    known = vocabulary(counts)
    net = train(training.select(text), known, shard_tokens=shard_tokens)
    return score(docs, counts, known, net, id_col, text, total, bits, block_bytes)
