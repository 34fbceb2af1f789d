"""Phrase collocations by sort-merge joins of occurrence relations (SETM).

Texts are lower-cased (A-Z) and cut at `[.,;:!?]` and line ends into pieces, pieces at spaces and tabs into words.
The relation R(k) says where phrases of k words stand: (place, phrase), sorted by place. Places of neighbours
in a piece differ by one, and between two pieces there is a gap, so a place names the piece and the position.
A block, some megabytes of texts of one language, keeps its part of the relation; a piece never leaves its block.

1. A narrow map writes R(1) of each block, with the block's distinct words and their counts.
2. Group-count: a block sends its distinct phrases with their counts, packed, to the owners of hash ranges, one row for
   each owner. The owners add the counts up exactly, number the phrases that are frequent, and answer.
3. Semi-join: the block drops the rows of R(k) whose phrase is not frequent.
4. Merge-join: rows at places p and p+1 of what is left meet in R'(k+1), whose phrase is the pair (phrase at p, phrase at
   p+1); it is written to the shared folder, and step 2 goes on with it.

Words are told apart by their bytes and longer phrases by pairs of numbers, never by hashes: hashes only deal out. A phrase
that stands everywhere arrives once a block. The number of owners follows that of blocks, and a message holds one
phrase at least, so there are never more rows than distinct phrases of blocks.

Scores come from joins on the frequent phrases alone: the pair gives each phrase the counts of its beginnings and ends.
A longer phrase that covers a shorter one to the wanted share leaves one word more that does so too, so
one word more is looked at.

Defined cases: null and empty texts have no words; a null language is `und`; repeated rows count again; texts of any
length are cut between pieces, so memory follows the longest piece; an empty table or one without frequent
phrases gives an empty result; columns other than language and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import LOWER, mix, slices, texts
from tickloom.llm.blocks import pack, pack_sorted, unpack, unpack_sorted
from tickloom.llm.lean import lean
from tickloom.session import materialize

LEAST = 30
LONGEST = 4
TOP = 2000
COVERS = 80  # percent
SCALE = 2_000_000
SHARES = 64
BLOCK_BYTES = 8 << 20

#: Bytes that end a piece, and bytes that separate words.
BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK = np.zeros(256, bool)
BLANK[list(b" \t")] = True
_LETTER = ~(BREAK | BLANK)

FIRST_RELATION = "block long, lang string, tokens long, places binary, codes binary, words array<string>, counts binary"
RELATION = "block long, places binary, codes binary, p binary, s binary, counts binary"
COUNTED = "block long, owner long, ids binary, id array<long>, f array<long>, lang array<string>, word array<string>, p array<long>, s array<long>"
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    parts = [None if v is None else pa.array(v, kind.value_type) for v in values]
    edges = np.cumsum([0, *[0 if x is None else len(x) for x in parts]])
    flat = [x for x in parts if x is not None]
    offsets = pa.array([None if i < len(parts) and parts[i] is None else int(e) for i, e in enumerate(edges)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(flat) if flat else pa.array([], kind.value_type))


def _batch(schema: str, rows: list[dict]) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([_column([r.get(n) for r in rows], _KINDS[k]) for n, k in fields], names=[n for n, _ in fields])


def portions(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts in portions of about `limit` bytes; a longer text is cut after pieces."""
    for i, j in slices(offsets, limit):
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= limit:
            yield data[a:b], offsets[i : j + 1] - a
            continue
        while a < b:
            to = min(b, a + limit)
            while to < b:
                ends = np.flatnonzero(BREAK[data[to : to + limit]])
                if len(ends):
                    to += int(ends[0])
                    break
                to = min(b, to + limit)
            yield data[a:to], np.array([0, to - a])
            a = to


def occurrences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The places of all words of texts laid end to end, and the words."""
    letter = _LETTER[data]
    opens = np.unique(offsets[:-1])
    opens = opens[opens < len(data)]
    fresh, last = letter.copy(), letter.copy()
    fresh[1:] &= ~letter[:-1]
    fresh[opens] = letter[opens]
    last[:-1] &= ~letter[1:]
    closed = opens[opens > 0] - 1
    last[closed] = letter[closed]
    start, length = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    length -= start
    ends = BREAK[data]
    ends[closed] = True  # whatever it is: a text's last byte closes its last piece
    piece = np.cumsum(ends, dtype=np.int32)[start] - ends[start]
    places = np.arange(len(start), dtype=np.int64)
    places[1:] += np.cumsum(piece[1:] != piece[:-1])
    at = np.zeros(len(start) + 1, np.int32)
    np.cumsum(length, out=at[1:])
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(LOWER[data[letter]]))
    return places, words.dictionary_encode()


def first_relation(docs: DataFrame, lang: str, text: str, block_bytes: int) -> DataFrame:
    """FIRST_RELATION: a row for each block."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            langs, column = batch.column(0).dictionary_encode(), batch.column(1)
            for k, name in enumerate(langs.dictionary.to_pylist()):
                own = column.filter(pc.equal(langs.indices, k))
                for data, offsets in portions(*texts(own), block_bytes):
                    places, words = occurrences(data, offsets)
                    if not len(places):
                        continue
                    block = (TaskContext.get().partitionId() << 32) + made
                    made += 1
                    codes = words.indices.to_numpy()
                    yield _batch(FIRST_RELATION, [{
                        "block": block, "lang": name, "tokens": len(places), "places": pack_sorted(places), "codes": pack(codes),
                        "words": words.dictionary, "counts": pack(np.bincount(codes, minlength=len(words.dictionary)))}])

    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, FIRST_RELATION)


def _dealt(owners: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(owner, from, to) for each run of equal owners."""
    edges = np.flatnonzero(np.diff(owners, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(owners[a]), int(a), int(b)


def _word_owners(words: pa.Array, bits: int) -> np.ndarray:
    """Owners of words: a hash of length, first and last bytes would be uneven, so all bytes count."""
    data, offsets = texts(words)
    held = np.zeros(len(words), np.uint64)
    for start in range(0, int(np.diff(offsets).max(initial=0)), 8):  # eight bytes a step
        at = offsets[:-1] + start
        some = np.flatnonzero(at < offsets[1:])
        lane = np.zeros(len(some), np.uint64)
        for byte in range(8):
            there = at[some] + byte
            lane |= np.where(there < offsets[1:][some], data[np.minimum(there, len(data) - 1)], 0).astype(np.uint64) << np.uint64(8 * byte)
        held[some] = mix(held[some] ^ lane)
    return (mix(held + np.diff(offsets).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _pair_owners(p: np.ndarray, s: np.ndarray, bits: int) -> np.ndarray:
    return (mix(mix(p.astype(np.uint64)) ^ s.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _numbered(owner: int, sums: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent ones of an owner's phrases, and the number of each phrase: 0 if it is not frequent."""
    found = np.flatnonzero(sums >= least)
    ids = np.zeros(len(sums), np.int64)
    ids[found] = (owner << 32) + 1 + np.arange(len(found))
    return found, ids


def _replies(owner: int, blocks: list[int], sizes: np.ndarray, ids: np.ndarray, phrases: dict) -> pa.Table:
    edges = np.cumsum([0, *sizes])
    rows = [{"block": b, "owner": owner, "ids": pack(ids[i:j])} for b, i, j in zip(blocks, edges[:-1], edges[1:])]
    return pa.Table.from_batches([_batch(COUNTED, [*rows, {"owner": owner, **phrases}])])


def counted_words(relation: DataFrame, bits: int, least: int) -> DataFrame:
    """COUNTED: the owners' answers to the blocks, and a row for each owner with its frequent words."""
    sent = "owner long, block long, lang string, words array<string>, counts binary"

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, words, counts in zip(*(batch.column(n) for n in ("block", "lang", "words", "counts"))):
                words, counts = words.values, unpack(counts.as_py())
                owners = _word_owners(words, bits)
                order = np.argsort(owners, kind="stable")
                words, counts = words.take(pa.array(order)), counts[order]
                yield _batch(sent, [{"owner": o, "block": block.as_py(), "lang": lang.as_py(), "words": words[i:j], "counts": pack(counts[i:j])}
                                    for o, i, j in _dealt(owners[order])])

    @lean
    def add(key: tuple, table: pa.Table) -> pa.Table:
        owner = key[0].as_py()
        lists = table.column("words").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy()
        words = lists.flatten().dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        many = max(1, len(langs.dictionary))
        codes = words.indices.to_numpy().astype(np.int64) * many + np.repeat(langs.indices.to_numpy(), sizes)
        each, inverse = np.unique(codes, return_inverse=True)
        sums = np.zeros(len(each), np.int64)
        np.add.at(sums, inverse, np.concatenate([unpack(x.as_py()) for x in table.column("counts")]).astype(np.int64))
        found, ids = _numbered(owner, sums, least)
        return _replies(owner, table.column("block").to_pylist(), sizes, ids[inverse], {
            "id": ids[found], "f": sums[found], "lang": langs.dictionary.take(pa.array(each[found] % many)),
            "word": words.dictionary.take(pa.array(each[found] // many))})

    asked = relation.select("block", "lang", "words", "counts").mapInArrow(send, sent)
    return asked.groupBy("owner").applyInArrow(add, COUNTED)


def counted_pairs(relation: DataFrame, bits: int, least: int) -> DataFrame:
    """COUNTED: the owners' answers to the blocks, and a row for each owner with its frequent pairs."""
    sent = "owner long, block long, p binary, s binary, counts binary"

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *packed in zip(*(batch.column(n) for n in ("block", "p", "s", "counts"))):
                p, s, counts = (unpack(x.as_py()) for x in packed)
                yield _batch(sent, [{"owner": o, "block": block.as_py(), "p": pack_sorted(p[i:j]), "s": pack(s[i:j]), "counts": pack(counts[i:j])}
                                    for o, i, j in _dealt(_pair_owners(p, s, bits))])

    @lean
    def add(key: tuple, table: pa.Table) -> pa.Table:
        owner = key[0].as_py()
        parts = [unpack_sorted(x.as_py()) for x in table.column("p")]
        sizes = np.array([len(x) for x in parts])
        p = np.concatenate(parts)
        s, counts = (np.concatenate([unpack(x.as_py()) for x in table.column(n)]) for n in ("s", "counts"))
        order = np.lexsort((s, p))
        fresh = np.ones(len(p), bool)
        fresh[1:] = (np.diff(p[order]) != 0) | (np.diff(s[order]) != 0)
        first = np.flatnonzero(fresh)
        sums = np.add.reduceat(counts[order].astype(np.int64), first)
        found, ids = _numbered(owner, sums, least)
        inverse = np.empty(len(p), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        one = order[first[found]]
        return _replies(owner, table.column("block").to_pylist(), sizes, ids[inverse], {
            "id": ids[found], "f": sums[found], "p": p[one].astype(np.int64), "s": s[one].astype(np.int64)})

    asked = relation.select("block", "p", "s", "counts").mapInArrow(send, sent)
    return asked.groupBy("owner").applyInArrow(add, COUNTED)


def joined(places: np.ndarray, codes: np.ndarray, ids: np.ndarray, bits: int) -> dict | None:
    """R'(k+1) of a block from R'(k) and the numbers of its phrases (0: not frequent).

    Phrases are coded in the order in which they are sent: by owner, then by number.
    """
    stays = ids[codes] > 0  # the semi-join
    places, codes = places[stays], codes[stays]
    by_id = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    ids, codes = ids[by_id], rank[codes]
    next_ = np.flatnonzero(np.diff(places) == 1)  # the merge-join on places
    if not len(next_):
        return None
    key = codes[next_] * len(ids) + codes[next_ + 1]
    each, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    p, s = ids[each // len(ids)], ids[each % len(ids)]
    order = np.argsort(_pair_owners(p, s, bits), kind="stable")
    rank = np.empty(len(each), np.int64)
    rank[order] = np.arange(len(each))
    return {"places": pack_sorted(places[next_]), "codes": pack(rank[inverse]), "p": pack(p[order]), "s": pack(s[order]), "counts": pack(counts[order])}


def extended(relation: DataFrame, counted: DataFrame, bits: int) -> DataFrame:
    """RELATION: the next length's rows of each block."""
    first = "words" in relation.columns

    @lean
    def extend(key: tuple, held: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        told = sorted(zip(told.column("owner").to_pylist(), told.column("ids")), key=lambda x: x[0])
        if held.num_rows and told:
            ids = np.concatenate([unpack(x.as_py()) for _, x in told]).astype(np.int64)
            places, codes = unpack_sorted(held.column("places")[0].as_py()).astype(np.int64), unpack(held.column("codes")[0].as_py()).astype(np.int64)
            if first:  # words are coded as they came, answers come by owner
                order = np.argsort(_word_owners(held.column("words")[0].values, bits), kind="stable")
                ids[order] = ids.copy()
            if (met := joined(places, codes, ids, bits)) is not None:
                rows.append({"block": key[0].as_py(), **met})
        return pa.Table.from_batches([_batch(RELATION, rows)])

    held = relation.select("block", "places", "codes", *(["words"] if first else []))
    told = counted.where("block is not null").select("block", "owner", "ids")
    return held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(extend, RELATION)


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
             block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length and the words of each language (lang, n).

    Words are (id, lang, f, word), longer phrases (id, f, p, s): the numbers of the phrase without its last and without its
    first word.
    """
    relation = materialize(first_relation(docs, lang, text, block_bytes), "occurrences")
    totals = relation.groupBy("lang").agg(F.sum("tokens").alias("n"))
    bits = max(2, (relation.select("block").count() - 1).bit_length())
    counted = materialize(counted_words(relation, bits, least), "phrases")
    rows = lambda *names: counted.where("block is null").select(F.explode(F.arrays_zip(*names)).alias("_x")).select("_x.*")
    found = [rows("id", "lang", "f", "word")]
    for k in range(2, longest + 1):
        relation = materialize(extended(relation, counted, bits), "occurrences")
        counted = materialize(counted_pairs(relation, bits, least), "phrases")
        found.append(rows("id", "f", "p", "s"))
    return found, totals


def scored(found: list[DataFrame], totals: DataFrame, covers: int = COVERS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more that no longer one covers."""
    whole = found[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
                            F.array("f").alias("starts"), F.array("f").alias("ends"))
    out = []
    big = lambda c: c.cast("decimal(20,0)")  # noqa: E731  counts are longs, their products are not
    for k, pairs in enumerate(found[1:], 2):
        side = lambda x: whole.select(*[F.col(c).alias(f"{x}_{c}") for c in whole.columns])
        met = pairs.join(side("p"), F.col("p") == F.col("p_id")).join(side("s"), F.col("s") == F.col("s_id"))
        whole = met.select(
            "id", F.col("p_lang").alias("lang"), F.concat_ws(" ", "p_phrase", "s_last").alias("phrase"), F.col("s_last").alias("last"),
            F.concat("p_starts", F.array("f")).alias("starts"), F.concat("s_ends", F.array("f")).alias("ends"))
        whole = materialize(whole, "phrases") if k < len(found) else whole
        cuts = []
        for cut in range(1, k):
            left, right = F.col("starts")[cut - 1], F.col("ends")[k - cut - 1]
            score = F.expr(f"(cast(starts[{k - 1}] as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div "
                           f"(cast(starts[{cut - 1}] as decimal(20,0)) + cast(ends[{k - cut - 1}] as decimal(20,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), left.alias("l"), right.alias("r")))
        rows = whole.withColumn("cut", F.array_min(F.array(*cuts))).select(
            "id", "lang", "phrase", F.col("starts")[k - 1].alias("a"), "cut.l", "cut.r", "cut.score")
        if k < len(found):
            longer = found[k].select(F.explode(F.array("p", "s")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("longer"))
            rows = rows.join(longer, "id", "left").where(
                F.col("longer").isNull() | (big(F.col("longer")) * 100 < big(F.col("a")) * covers)).drop("longer")
        out.append(rows.drop("id"))
    every = out[0]
    for rows in out[1:]:
        every = every.unionByName(rows)
    return every.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, covers: int = COVERS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's `top` phrases by score, count and bytes: lang, rank, phrase, a, l, r, n, score."""
    rows = scored(*frequent(docs, lang, text, least, longest, block_bytes), covers)
    order = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    # the best of each share of a language first, so that at most SHARES * top phrases of a language meet in one task
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    best = rows.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
