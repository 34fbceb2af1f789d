"""Operators that compare texts with the whole corpus, packing, and the pipeline."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import STRANGE, lower, mirrored, words
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import blocks, exact_dedup, lean, lm_scoring, minhash_dedup, packing, queries, recurrent, substring_dedup
from tickloom.session import materialize

# ---- packed messages ------------------------------------------------------------------


@pytest.mark.parametrize("values", [[], [0], [5, 5, 9, 2**64 - 1], [1, 2, 3, 300, 70_000]])
def test_messages(values):
    keys = np.array(values, np.uint64)
    assert blocks.unpack(blocks.pack(keys)).tolist() == blocks.unpack_sorted(blocks.pack_sorted(keys)).tolist() == values
    cut = list(blocks.ranges(keys, 3))
    assert [v for _, i, j in cut for v in values[i:j]] == values
    assert all(k >> 61 == owner for owner, i, j in cut for k in values[i:j])


def test_blocks_follow_ids(spark):
    docs = spark.range(1000).select((F.col("id") * 7 % 1000).alias("doc_id"), F.lit("xx").alias("text"))
    placed, n = blocks.in_blocks(docs, "doc_id", 2000, 150)
    rows = sorted((r["_row"]["doc_id"], r["_block"]) for r in placed.collect())
    assert n > 5 and [b for _, b in rows] == sorted(b for _, b in rows) and len({b for _, b in rows}) == n
    assert max(Counter(b for _, b in rows).values()) < 200


def test_a_hot_id_and_rows_without_one_are_spread(spark):
    """A third of the rows share an id and a third have none: no block holds many of them, and blocks still follow the ids."""
    key = F.when(F.col("id") < 400, F.lit(77)).when(F.col("id") < 800, F.lit(None)).otherwise(F.col("id") - 800)
    docs = spark.range(1200).select(key.cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    placed, n = blocks.in_blocks(docs, "doc_id", 12_000, 600, "text")
    rows = [(r["_row"]["doc_id"], r["_block"]) for r in placed.collect()]
    assert max(Counter(b for _, b in rows).values()) < 150 and len({b for _, b in rows}) >= 15
    known = sorted((i, b) for i, b in rows if i is not None)
    for (i, b), (j, c) in zip(known, known[1:]):
        assert b <= c or i == j
    assert max(b for _, b in known) <= min(b for i, b in rows if i is None)


def test_blocks_of_two_levels(spark, monkeypatch, corpus, documents):
    monkeypatch.setattr(blocks, "ONE_LEVEL", 4)
    docs = spark.range(3000).select((F.col("id") * 7 % 3000).alias("doc_id"), F.lit("xx").alias("text"))
    placed, n = blocks.in_blocks(docs, "doc_id", 6000, 150)
    rows = sorted((r["_row"]["doc_id"], r["_block"]) for r in placed.collect())
    assert n == 40 and [b for _, b in rows] == sorted(b for _, b in rows) and len({b for _, b in rows}) >= 36
    assert max(Counter(b for _, b in rows).values()) < 200
    got = substring_dedup.dedup(documents, block_bytes=20_000).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(tuple(r) for r in got.collect()) == without_repeats(corpus)


# ---- substring dedup ------------------------------------------------------------------


def without_repeats(rows, size=20):
    """Brute force over (id, text) in document order."""
    seen, out = set(), []
    for i, text in rows:
        ws = words(text)
        gone = [False] * len(ws)
        for k in range(len(ws) - size + 1):
            window = tuple(ws[k : k + size])
            if window in seen:
                gone[k : k + size] = [True] * size
            seen.add(window)
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def test_removed_words(spark, sf_dir, corpus, documents):
    want = without_repeats(corpus)
    assert sum(w[2] for w in want) > 1000
    got = queries.QUERIES["op3_substring_dedup"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == [(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in want]
    small = substring_dedup.dedup(documents, block_bytes=40_000)  # many blocks and owners
    assert sorted(tuple(r) for r in small.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == want


def test_crowded_sketch_loses_nothing(documents, corpus, monkeypatch):
    """With a handful of cells nearly every window is a candidate, and the result is the same."""
    cells = substring_dedup._cells
    monkeypatch.setattr(substring_dedup, "_cells", lambda h, row, bits: cells(h, row, bits) >> np.uint64(6) << np.uint64(6))
    got = substring_dedup.dedup(documents, block_bytes=100_000).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(tuple(r) for r in got.collect()) == without_repeats(corpus)


def test_strange_substrings(strange, nothing):
    got = substring_dedup.dedup(strange, block_bytes=100_000)
    want = without_repeats(sorted(STRANGE, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()), key=key) == sorted(want, key=key)
    assert set(got.columns) == {*strange.columns, "n_words", "n_removed", "kept_text"}
    assert substring_dedup.dedup(nothing).count() == 0


def test_mirrored_words_are_no_repeat(spark):
    """Words of equal hashes under a polynomial modulo a power of two: different, and nothing of them is dropped or linked."""
    a, b = mirrored(512)
    rest = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
    pair = [(1, f"q {a} r s"), (2, f"q {b} r s"), (3, f"q {a} r s")]
    near = {r["doc_id"]: r["component_id"] for r in minhash_dedup.dedup(spark.createDataFrame(pair, docs.schema)).collect()}
    assert near == {1: 1, 2: 2, 3: 1}
    scored = lm_scoring.fit_and_score(spark.createDataFrame([(1, a), (2, b)], docs.schema), F.col("doc_id") == 1)
    assert {r["doc_id"]: r["n_known"] for r in scored.collect()} == {1: 2, 2: 1}


def test_cut_texts_keep_the_rest_as_it_is(spark):
    twenty = " ".join(f"w{k}" for k in range(20))
    spread = twenty.replace(" ", "\n\t ")
    rows = [(1, f"  {twenty}"), (2, "def f(x):\n    return x  "), (3, f"begin\n {spread}  \n\nend\t"), (4, f"\t{spread}  "), (5, f"start \n{twenty}\n"), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup(docs, cut=True).collect()}
    assert got == {1: (0, rows[0][1]), 2: (0, rows[1][1]), 3: (20, "begin\n end\t"), 4: (20, ""), 5: (20, "start"), 6: (0, None), 7: (0, "")}


# ---- exact dedup ----------------------------------------------------------------------


def test_copies(spark, sf_dir):
    sql = queries.ORACLES["op8_exact_dedup"]
    ok, note = compare(queries.QUERIES["op8_exact_dedup"](spark, sf_dir), connect(sf_dir), sql)
    assert ok, note


def test_digest_collisions_are_told_apart(documents):
    """A digest of one byte: the check of the full bytes has to part the texts."""
    weak = exact_dedup.dedup(documents, digest=lambda n: F.unhex(F.substring(F.sha2(n, 256), 1, 1))).drop("digest")
    strong = exact_dedup.dedup(documents).drop("digest")
    assert weak.exceptAll(strong).count() == 0 == strong.exceptAll(weak).count()


def test_state_goes_on_after_a_restart(spark, tmp_path):
    path, state = str(tmp_path / "arrivals"), str(tmp_path / "state")
    schema = "id long, digest binary, locator string"

    def arrive(*rows):
        spark.createDataFrame([(i, d.encode(), f"file {i}") for i, d in rows], schema).coalesce(1).write.mode("append").parquet(path)

    def known():
        rows = exact_dedup.remember(path, spark.read.schema(schema).parquet(path).schema, spark, state_path=state).collect()
        return {bytes(r["digest"]).decode(): (r["keep_id"], r["locator"], r["size"]) for r in rows}

    arrive((1, "a"), (2, "b"), (5, "a"))
    assert known() == {"a": (5, "file 5", 2), "b": (2, "file 2", 1)}
    arrive((9, "b"), (3, "a"))
    arrive((4, "c"))
    assert known() == {"a": (5, "file 5", 3), "b": (9, "file 9", 2), "c": (4, "file 4", 1)}
    assert known() == {"a": (5, "file 5", 3), "b": (9, "file 9", 2), "c": (4, "file 4", 1)}


def test_strange_copies(strange, nothing):
    got = exact_dedup.dedup(strange).collect()
    groups = defaultdict(list)
    for i, t in STRANGE:
        groups[lower(t)].append(i)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep) for i in ids]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=key) == sorted(want, key=key)
    assert exact_dedup.dedup(nothing).count() == 0


# ---- near-dedup -----------------------------------------------------------------------


def shingles(text):
    ws = words(lower(text))
    return frozenset(tuple(ws[i : i + 4]) for i in range(len(ws) - 3)) if len(ws) >= 4 else frozenset([tuple(ws)] if ws else [])


def near_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    held, top = defaultdict(list), {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in sorted(sets.items()):
        for j, n in Counter(j for g in s for j in held[g]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                top[b] = a
        for g in s:
            held[g].append(i)
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_near_copies(spark, sf_dir, corpus):
    got = queries.QUERIES["op7_minhash_dedup"](spark, sf_dir).collect()
    assert {tuple(r) for r in got} == near_components(corpus) and len(got) == len(corpus)


def test_groups_around_several_centres(spark):
    """Chains and stars: copies of copies, where the smallest id is like a few of the others only."""
    rng = np.random.default_rng(3)
    rows = []
    for group in range(4):
        text = [f"g{group}w{k}" for k in range(120)]
        for step in range(30):
            if step % 3 == 0:  # the base drifts
                text[rng.integers(0, 120)] = f"d{group}s{step}"
            own = list(text)
            own[rng.integers(0, 120)] = f"o{group}s{step}"
            rows.append((len(rows), " ".join(own)))
    order = rng.permutation(len(rows)).tolist()
    rows = [(order[i], t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in minhash_dedup.dedup(docs).collect()} == near_components(rows)


def test_links_across_unsettled_lists(spark, monkeypatch):
    """Without the stars every link has to come from the search across components."""
    rows = [(i, " ".join(f"w{(i // 5) * 1000 + k}" for k in range(60)) + f" end{i}") for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    confirmed, calls = minhash_dedup.confirmed, []
    monkeypatch.setattr(minhash_dedup, "confirmed", lambda p, s, a: calls.append(1) or (confirmed(p, s, a) if len(calls) > 1 else p.limit(0)))
    assert {tuple(r) for r in minhash_dedup.dedup(docs).collect()} == near_components(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (70, 71)]
    labels = minhash_dedup.components(spark.createDataFrame(links, "a long, b long"))
    want = {**{i: 1 for i in range(1, 41)}, 50: 50, 55: 50, 60: 50, 70: 70, 71: 70}
    assert {r["id"]: r["comp"] for r in labels.collect()} == want
    more = minhash_dedup.components(spark.createDataFrame([(71, 3), (80, 55)], "a long, b long"), labels)
    want |= {70: 1, 71: 1, 80: 50}
    assert {r["id"]: r["comp"] for r in more.collect()} == want


def test_strange_near_copies(strange, nothing):
    got = minhash_dedup.dedup(strange).collect()
    assert len(got) == len(STRANGE)
    comp = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert comp[1, 0] == 1 and comp[2, 0] == 2 and comp[3, 0] == 3  # empty sets stay apart
    assert comp[5, 1] == comp[6, 1] == 5 and comp[7, 26] == comp[8, 26] == 7
    assert minhash_dedup.dedup(nothing).count() == 0


# ---- packing --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return queries.tokenizer("word_bpe_49k.json")


def check_packed(rows, ids_of, capacity=4096):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == ids_of.keys()
    for i, pieces in by_doc.items():
        ids = b"".join(x["ids"] for x in sorted(pieces, key=lambda x: x["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == ids_of[i]
        at = 0
        for x in sorted(pieces, key=lambda x: x["start"]):
            assert x["start"] == at and len(x["ids"]) == 4 * x["length"] and x["length"] > 0 and x["doc_tokens"] == len(ids_of[i])
            at += x["length"]
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= capacity
    return 1 - sum(map(len, ids_of.values())) / (capacity * len(by_sequence))


@pytest.mark.parametrize("parts", [1, 5])
def test_packed_documents(documents, corpus, vocabulary, parts):
    from tokenizers import Tokenizer

    coded = Tokenizer.from_file(vocabulary).encode_batch([t for _, t in corpus], add_special_tokens=False)
    ids_of = {i: [*e.ids, 2] for (i, _), e in zip(corpus, coded)}
    padding = check_packed(packing.pack(documents.select("doc_id", "text").repartition(parts), vocabulary).collect(), ids_of)
    assert padding < 0.05


def test_coder_equals_the_tokenizer(vocabulary):
    from tokenizers import Tokenizer

    texts = ["", "a", "It's the END. of,it<|endoftext|>x <|ENDOFTEXT|>", "Éà ﬁ İstanbul Σίσυφος ΟΔΟΣ ǅ", "x\x1cy\x85z\xa0w 12 a1b2 ½ ²", "é Á! q̸",
             "don't we'll ''' 's.", "a...b ,.;:", "日本 語　x 😀!", "\x00\x01 \x7f", "<|startoftext|>", "ﬀ'S 'Re"]
    tokenizer = Tokenizer.from_file(vocabulary)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.WordCoder(vocabulary).encode([t.encode() for t in texts])]
    assert got == want


def test_special_tokens_count_as_written(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    for text in ("<|ENDOFTEXT|>", "END. x<|StartOfText|>. Of", "<|endoftext|> <|ENDOFTEXT|>.", "<|ENDOFTEXT|", "A<|endoftext|>B."):
        [got] = packing.WordCoder(vocabulary).encode([text.encode()])
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_encoded_once_whatever_follows_it(vocabulary, monkeypatch):
    from tokenizers import Tokenizer

    marks = [".", ",", "&&&", ").", "!?", "'s", "'st.", "''", "_", "-b.", "\x1c", "\x00y", "1", "1.", "½.", "–.", "é.", "̸.", "İ.", "\u0958.", "\ufb1d,", "n't"]
    text = "Rätselhaft " + " ".join(f"Rätselhaft{m} 12{m} Σ{m} K{m}" for m in marks)
    asked, encode = [], packing.WordCoder._encode
    monkeypatch.setattr(packing.WordCoder, "_encode", lambda self, parts: asked.extend(parts) or encode(self, parts))
    coder = packing.WordCoder(vocabulary)
    [got] = coder.encode([text.encode()])
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(vocabulary).encode(text, add_special_tokens=False).ids
    before = len(asked)
    assert asked.count("rätselhaft".encode()) == 1
    assert coder.known.now.keys().isdisjoint({f"rätselhaft{m}".encode() for m in (".", ",", "&&&", ").", "!?", "'s", "''")})
    assert coder.encode([text.encode()]) == [got] and len(asked) == before


def test_a_word_is_looked_up_once_a_slice(vocabulary):
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    coder = packing.WordCoder(vocabulary)
    texts = [b"one two, Three. two three", b"one"] * 1000
    want = coder.encode(texts)
    coder.known.now = Counted(coder.known.now)
    assert coder.encode(texts) == want
    assert coder.known.now.asked <= 20


def test_coder_keeps_neighbouring_texts_apart(vocabulary):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(vocabulary), np.random.default_rng(3)
    parts = ["a", "B", "7", "é", "İ", "\u0958", ".", ",", "'s", "'", "-", "(", " ", "\n", "\x0b", "\x1c", "\x85", "word", "😀", "\u0338"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(3000)]
    special = [*texts[:50], "x<|endoftext|>.", "<|ENDOFTEXT|>", *texts[50:60]]
    coder = packing.WordCoder(vocabulary)
    coder.known.most = 200  # memories change over again and again
    for some in (texts[:1000], texts[1000:], texts, special, ["", ""], []):
        want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in some])] == want


def test_cuts_and_classes():
    for capacity in (1, 16, 100, 4096):
        for length in (1, 2, capacity // 3 + 1, capacity, capacity + 1, 5 * capacity - 1):
            pieces = packing.cut(length, capacity)
            assert [s for s, _ in pieces] == [sum(x for _, x in pieces[:k]) for k in range(len(pieces))]
            assert sum(x for _, x in pieces) == length
            assert all(packing.step_of(x, capacity) * x <= capacity for _, x in pieces)


def test_strange_packing(strange, nothing, vocabulary):
    rows = packing.pack(strange, vocabulary, capacity=64).collect()
    ends = [r for r in rows if r["start"] + r["length"] == r["doc_tokens"]]
    assert len(ends) == len(STRANGE) and rows[0]["kept"] == "own kept"
    assert {(r["doc_id"], r["length"]) for r in ends if r["doc_tokens"] == 1} == {(1, 1), (2, 1), (3, 1)}
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 64
    assert packing.pack(nothing, vocabulary).count() == 0


# ---- language model -------------------------------------------------------------------


def test_recurrent_slopes(monkeypatch):
    """Slopes of whole windows against differences, in double precision."""
    monkeypatch.setattr(recurrent, "F32", np.float64)
    monkeypatch.setattr(recurrent, "WINDOW", 60)
    rng = np.random.default_rng(0)
    net = recurrent.Network(10, 3, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, lengths = rng.integers(0, 11, 40), np.array([15, 5, 20])
    found = {}

    class Keep:
        def update(self, p, g, rows, x):
            found.update(g, X=np.zeros_like(p["X"]))
            found["X"][rows] = x

    net.train(ids, lengths, Keep(), 1)
    weight = len(ids) / max(len(ids), recurrent.WINDOW // 4)

    for k, v in net.p.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in v.shape)
            kept, e = v[at], 1e-5
            v[at] = kept + e
            up = -net.score(ids, lengths, 2).mean()
            v[at] = kept - e
            down = -net.score(ids, lengths, 2).mean()
            v[at] = kept
            assert weight * (up - down) / (2 * e) == pytest.approx(found[k][at], rel=1e-4, abs=1e-8), k


def test_state_crosses_windows(monkeypatch):
    rng = np.random.default_rng(2)
    net = recurrent.Network(20, 4, 8)
    ids, lengths = rng.integers(0, 21, 900), np.array([500, 1, 150, 249])
    whole = net.score(ids, lengths, 1)
    monkeypatch.setattr(recurrent, "WINDOW", 3)
    np.testing.assert_allclose(net.score(ids, lengths, 4), whole, rtol=1e-4, atol=1e-4)
    np.testing.assert_allclose(net.score(ids[500:501], np.array([1])), whole[500:501], rtol=1e-4)  # the state starts at zero


def test_probabilities_add_up():
    net = recurrent.Network(10, 3, 4).with_frequencies(np.arange(10, 0, -1.0), 7.0)
    before = np.repeat(np.array([[3, 10, 2]]), 11, axis=0)
    ids = np.column_stack([before, np.arange(11)]).ravel()
    last = net.score(ids, np.full(11, 4))[3::4]
    assert np.exp(last).sum() == pytest.approx(1, abs=1e-5)


def test_base_scores(spark, sf_dir, corpus):
    tokens = {i: [*words(lower(t)), None] for i, t in corpus}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_lm_scoring"](spark, sf_dir).collect()}
    assert got.keys() == tokens.keys()
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws), rel=1e-9)
        assert r["score"] < 0
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_what_is_learned_does_not_depend_on_partitions(spark, sf_dir, monkeypatch):
    """Held-out probability over that of counts alone: the same from 1 and from 64 partitions, and well above the base score."""
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text")
    gains = {}
    for parts, shard in ((1, lm_scoring.SHARD_TOKENS), (64, lm_scoring.SHARD_TOKENS), (8, 50_000)):
        scored = lm_scoring.fit_and_score(docs.repartition(parts), ~queries.held_out(7, 2), shard_tokens=shard)
        r = scored.where(queries.held_out(7, 2)).agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
        gains[parts] = (r["s"] - r["b"]) / -r["b"]
    assert gains[1] > 0.035 and gains[64] == pytest.approx(gains[1], rel=0.1)
    assert gains[8] > 0.01  # shards far too small still learn


def test_network_words_grow_with_the_corpus(spark):
    """Far more than 512 words are known one by one, and the others are told apart by classes."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{k}" for k in np.minimum(rng.zipf(1.2, 2000), 10**7))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tally = Counter(w for _, t in rows for w in [*words(t), None])
    known = lm_scoring.vocabulary(lm_scoring.count_words(docs.select("text"), 3))
    assert (known.tokens, known.distinct) == (sum(tally.values()), len(tally))
    n = len(known.words)
    assert n == pytest.approx(lm_scoring.network_words(len(tally)), rel=0.1) and n >= 900
    top = sorted(tally.values(), reverse=True)
    assert known.counts.sum() >= 0.99 * sum(top[:n]) and known.counts[:100].tolist() == top[:100]
    assert known.counts.sum() + known.rare_tokens.sum() == known.tokens and n + known.rare_distinct.sum() == known.distinct
    assert len(known.rare_tokens) >= 8 and (known.rare_distinct > 0).all()
    hashes, _ = lm_scoring.token_hashes(np.frombuffer(" ".join(w for w in tally if w).encode(), np.uint8), np.array([0, len(" ".join(w for w in tally if w))]))
    assert set(known.ids(hashes).tolist()) == set(range(n + len(known.rare_tokens)))
    assert lm_scoring.network_words(10**8) == 20_000


def test_probabilities_add_up_over_rare_classes():
    net = recurrent.Network(50, 7, 4, rare=5).with_frequencies(1000.0 / np.arange(1, 51), np.arange(5.0))
    assert net.edges[0] == 0 and net.edges[-1] == 50 and len(net.edges) == 8 and (np.diff(net.edges) > 0).all()
    assert np.diff(net.edges)[0] < np.diff(net.edges)[-1]  # frequent words lie in small classes
    ids = np.column_stack([np.repeat(np.array([[3, 52, 2]]), 55, axis=0), np.arange(55)]).ravel()
    assert np.exp(net.score(ids, np.full(55, 4))[3::4]).sum() == pytest.approx(1, abs=1e-5)
    same = net.from_flat(net.flat())
    np.testing.assert_allclose(same.score(ids, np.full(55, 4)), net.score(ids, np.full(55, 4)), rtol=1e-5)


def test_strange_scores(strange, nothing):
    rows = lm_scoring.fit_and_score(strange, F.col("doc_id") != 9, block_bytes=100_000).collect()
    assert len(rows) == len(STRANGE) and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert rows[0]["kept"] == "own kept"
    assert {(r["doc_id"], r["n_tokens"]) for r in rows if r["n_tokens"] == 1} == {(1, 1), (2, 1), (3, 1)}
    assert lm_scoring.fit_and_score(nothing, F.lit(True)).count() == 0
    untrained = lm_scoring.fit_and_score(strange, F.lit(False)).collect()
    assert len(untrained) == len(STRANGE) and {(r["train_tokens"], r["n_known"]) for r in untrained} == {(0, 0)}


# ---- pipeline -------------------------------------------------------------------------


def test_pipeline(spark, sf_dir, documents, vocabulary, tmp_path):
    """Every stage against brute force on what its predecessor kept."""
    from tokenizers import Tokenizer

    docs = documents
    columns = documents.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or out.columns == columns
        steps[name] = ({r["doc_id"]: r["text"] for r in docs.collect()}, out.collect())
        docs = out

    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = steps["quality_classifier"]
    kept = {r["doc_id"] for r in after}
    known = [(quality[i], i in kept) for i in before if i in quality]
    assert np.mean([k for q, k in known if q]) > 0.97 and np.mean([k for q, k in known if not q]) < 0.2

    before, after = steps["exact_dedup"]
    last = {lower(t): i for i, t in sorted(before.items())}
    assert {r["doc_id"] for r in after} == set(last.values())

    before, after = steps["minhash_dedup"]
    assert {r["doc_id"] for r in after} == {i for i, _, _, k in near_components(before.items()) if k}

    before, after = steps["substring_dedup"]
    # the words that stay; how the rest of a text stays is the next test's
    assert {(r["doc_id"], " ".join(words(r["text"]))) for r in after} == {(i, t) for i, _, _, t in without_repeats(sorted(before.items()))}
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = steps["packing"]
    coded = Tokenizer.from_file(vocabulary).encode_batch(list(before.values()), add_special_tokens=False)
    assert check_packed(after, {i: [*e.ids, 2] for i, e in zip(before, coded)}) < 0.05
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in after)


def test_stages_leave_unrepeated_texts_alone(spark, sf_dir, documents):
    """What a stage keeps is, byte for byte, what it was given; only words that the fourth stage removes are cut."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, docs, sf_dir), name)
        assert after.columns == documents.columns
        if name == "substring_dedup":
            gone = {r[0]: r[2] for r in without_repeats(sorted((r["doc_id"], r["text"]) for r in docs.collect()))}
            same = {i for i, n in gone.items() if not n}
            assert len(same) > 100 and max(gone.values()) > 0
            kept = after.where(F.col("doc_id").isin(sorted(same)))
            assert kept.count() == len(same) and kept.exceptAll(docs).count() == 0
        else:
            assert after.exceptAll(docs).count() == 0
        docs = after


def test_stages_bound_what_workers_hold(spark, sf_dir, documents):
    name, size = corpus_pipeline.BATCH
    before = spark.conf.get(name, None)
    try:
        for own in (None, "9m"):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            corpus_pipeline.pack(spark, documents.limit(1), sf_dir)
            assert spark.conf.get(name) == (own or size)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_memories_go_with_their_operator():
    asked = []

    def made(of):
        @lean.kept
        def memory(key):
            asked.append(of)
            return key

        return memory

    kept = made("one")
    owner = lean._KEPT[kept.__wrapped__.__module__]
    try:
        kept(1), kept(1)
        lean.turn_to(kept.__wrapped__.__module__)
        assert kept(1) and asked == ["one"]
        lean.turn_to("another operator")
        assert kept(1) and asked == ["one", "one"]
    finally:
        owner.remove(kept)
    assert packing._coder in lean._KEPT["tickloom.llm.packing"]


def test_pipeline_on_strange_rows(spark, sf_dir, strange, nothing):
    for docs, n in ((strange.where("doc_id is not null"), 1), (nothing, 0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert name == "packing" or out.columns == columns
            docs = corpus_pipeline.materialize(out, name)
        assert (docs.count() > 0) == bool(n)


def test_dedup_stages_judge_rows(spark, sf_dir):
    """Null and repeated ids: a row stays or goes by its own text, and one row of each group stays."""
    text = lambda k: " ".join(f"{k}w{n}" for n in range(60))
    a, b, u, v, s = (text(k) for k in "abuvs")
    rows = [(1, a), (1, b), (5, a), (None, u), (None, v), (None, v), (6, s), (6, s.upper()), (6, s), (7, "x"), (None, "X"), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    pairs = lambda t: sorted(((r["doc_id"], lower(r["text"])) for r in t.collect()), key=str)
    once = corpus_pipeline.materialize(corpus_pipeline.drop_copies(spark, docs, sf_dir), "copies")
    assert once.columns == docs.columns
    assert pairs(once) == sorted([(1, b), (5, a), (None, u), (None, v), (6, s), (7, "x"), (9, "")], key=str)

    near = f"{b} more"
    more = [(1, b), (1, near), (2, a), (None, f"{a} more"), (None, u), (None, f"{u} more"), (3, s), (3, v)]
    docs = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in more], docs.schema)
    left = pairs(corpus_pipeline.drop_near_copies(spark, docs, sf_dir))
    assert [r for r in left if r[1].startswith("b")] in ([(1, b)], [(1, near)])
    assert [r for r in left if r[1].startswith("u")] in ([(None, u)], [(None, f"{u} more")])
    assert sorted((r for r in left if r[1][0] in "asv"), key=str) == sorted([(2, a), (3, s), (3, v)], key=str) and len(left) == 5


def test_pipeline_keeps_one_of_strange_rows(spark, sf_dir, strange):
    """Null and repeated ids go through the dedup stages."""
    docs = strange
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "strange")
        assert docs.columns == strange.columns
    left = Counter(lower(r["text"]) for r in docs.collect())
    assert max(left.values()) == 1 and left.keys() <= {lower(t) for _, t in STRANGE} and lower(STRANGE[7][1]) in left
