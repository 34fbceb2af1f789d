"""Phrase collocations, the filter audit and near copies by SimHash, against brute force."""

import re
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import pytest
import xxhash
from llm_rows import STRANGE, lower, words
from oracle_check import compare, connect
from pyspark.sql import functions as F

from tickloom.llm import collocations, filter_audit, queries, simhash_dedup, skew

# ---- collocations ---------------------------------------------------------------------


def phrases(rows, least=30, longest=4, top=2000, covers=80):
    """Brute force over (lang, text)."""
    n, counts = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        held = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                held.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for i, j in combinations(range(len(p) + 1), 2):
                if j - i < len(p):
                    longer[p[i:j]] = max(longer[p[i:j]], a)
        ranked = []
        for p, a in found.items():
            if 100 * longer[p] < covers * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"least": 3, "block_bytes": 20_000}, {"least": 2, "longest": 6, "top": 50, "covers": 50}])
def test_phrases(documents, options):
    rows = [(r["lang"], r["text"]) for r in documents.select("lang", "text").collect()]
    want = phrases(rows, **{k: v for k, v in options.items() if k != "block_bytes"})
    assert len(want) > 40
    got = collocations.collocations(documents.repartition(3), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in got.dtypes[3:]} == {"bigint"}
    assert sorted(tuple(r) for r in got.collect()) == want


def test_phrases_equal_the_sql(spark, sf_dir):
    ok, note = compare(queries.QUERIES["op11_collocations"](spark, sf_dir), connect(sf_dir), queries.ORACLES["op11_collocations"])
    assert ok, note


def test_a_long_text_is_cut_between_pieces(spark):
    text = "; ".join(["a b c d", "Wörter, é ß\x0b漢字 😀\tx y"] * 3000) + " no end"
    rows = [("de", text), (None, "a b. a b"), ("de", "x" * 50_000 + " y")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=2, block_bytes=1000)
    assert sorted(tuple(r) for r in got.collect()) == phrases(rows, least=2)


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts whose products pass 64 bits: the larger score wins by one unit in the last place."""
    big = 9_000_000_000_000_000_000
    f = [big, big - 1, big - 2]
    words_ = spark.createDataFrame([(1, "x", f[0], "v"), (2, "x", f[1], "w")], "id long, lang string, f long, word string")
    pairs = spark.createDataFrame([(3, f[2], 1, 2), (4, 30, 2, 1)], "id long, f long, p long, s long")
    got = {r["phrase"]: r["score"] for r in collocations.scored([words_, pairs], spark.createDataFrame([("x", 5)], "lang string, n long")).collect()}
    assert got == {"v w": 2_000_000 * f[2] // (f[0] + f[1]), "w v": 0}


def test_phrases_of_strange_rows(strange, nothing):
    want = phrases([("xx", t) for _, t in STRANGE], least=2)
    assert sorted(tuple(r) for r in collocations.collocations(strange, least=2).collect()) == want
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(strange, least=10**9).count() == 0


# ---- the filter audit -----------------------------------------------------------------


def audited(rows, labels):
    """Brute force over (id, part, text) and {id: (quality, toxic)}: every order, one document after the other."""
    seen, fails = {}, []
    for i, _, t in rows:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    for i, part, text in rows:
        t, ws = text or "", words(text)
        bad = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
               "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and seen[t] < i}
        fails.append((part or "", {c for c, x in bad.items() if x}, labels.get(i, (0, 0))))
    out = []
    for part in {f[0] for f in fails}:
        own, shapley, lines = [f[1:] for f in fails if f[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone, stay = [x for x in left if c in x[0]], [x for x in left if c not in x[0]]
                shapley[c] += len(gone)
                lines.append((c, (part, "".join(order), step, len(stay), len(gone), sum(c in x[0] for x in own) - len(gone),
                                  sum(x[0] == {c} for x in own), sum(x[1][0] == 1 for x in gone), sum(x[1][1] == 1 for x in gone))))
                left = stay
        out += [(*line, shapley[c]) for c, line in lines]
    return sorted(out)


def test_audit(spark, sf_dir, documents):
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in documents.collect()]
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = filter_audit.filter_audit(documents, marks)
    want = audited(rows, {r["doc_id"]: (r["quality"], r["toxic"]) for r in marks.collect()})
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 600 * len({r[1] for r in rows})
    assert dict(got.dtypes)["step"] == "int" and {t for c, t in got.dtypes if c not in ("part", "filter_order", "step")} == {"bigint"}
    ok, note = compare(queries.QUERIES["op12_filter_audit"](spark, sf_dir), connect(sf_dir), queries.ORACLES["op12_filter_audit"])
    assert ok, note


def test_audit_of_strange_rows(spark, strange, nothing):
    marks = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (6, 1, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    docs = strange.withColumn("lang", F.when(F.col("doc_id") < 5, F.lit(None)).when(F.col("doc_id") < 8, "").otherwise(F.lit("xx")))
    rows = [(i, "" if i is not None and i < 8 else "xx", t) for i, t in STRANGE]
    got = filter_audit.filter_audit(docs, marks)
    assert sorted(tuple(r) for r in got.collect()) == audited(rows, {1: (1, 0), 6: (1, 1)})
    assert filter_audit.filter_audit(nothing, marks).count() == 0
    assert filter_audit.filter_audit(docs, marks.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


@pytest.mark.parametrize("letters", ["A", "AB", "ABCD"])
def test_intervals_cover_every_order_once(spark, letters):
    orders = filter_audit.orders(letters)
    assert orders == sorted("".join(p) for p in permutations(letters))
    got = {}
    for r in filter_audit.intervals(spark, letters).collect():
        for rank in range(r["from"], r["to"]):
            assert got.setdefault((r["mask"], rank), r["step"]) == r["step"]
    want = {(m, k): min(s for s, c in enumerate(o, 1) if m >> letters.index(c) & 1) for m in range(1, 1 << len(letters)) for k, o in enumerate(orders)}
    assert got == want


# ---- near copies by SimHash -----------------------------------------------------------


def near(rows, radius=2, size=3):
    """Brute force over (id, text): {(id, fingerprint, smallest id in reach)}."""
    fps = []
    for _, text in rows:
        ws = words(lower(text))
        shingles = [" ".join(ws[k : k + size]) for k in range(max(1, len(ws) - size + 1))] if ws else []
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    every = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(every[i + 1 :] ^ every[i]) <= radius):
            top[root(i)] = root(i + 1 + int(j))
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return Counter((i, f"{fps[k]:016x}", least[root(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("crowd", [simhash_dedup.CROWD, 2])
def test_fingerprints_and_components(documents, corpus, crowd):
    got = simhash_dedup.dedup(documents, crowd=crowd)
    assert Counter(tuple(r) for r in got.collect()) == near(corpus)


def test_hash_is_the_one_that_spark_has(spark):
    texts = ["", "a b c", "éß漢字 😀 x", "word " * 100]
    want = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert [xxhash.xxh64_intdigest(t.encode(), simhash_dedup.SEED) for t in texts] == want


@pytest.mark.parametrize("radius", [2, 4])
def test_every_pair_in_the_radius_collides(radius):
    masks = simhash_dedup.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for differing in combinations(range(64), radius):
        if radius == 2 or sum(differing) % 97 == 0:
            assert any(all(not m >> b & 1 for b in differing) for m in masks)


@pytest.mark.parametrize("crowd", [10_000, 5])
def test_chains_of_fingerprints(spark, crowd):
    """A hot neighbourhood: thousands of fingerprints around one centre, and chains that only joined links hold together."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 1 << 63))
    ball = [centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    far = [int(x) for x in rng.integers(0, 1 << 63, 500)]
    chain = [far[0]]
    for k in range(40):
        chain.append(chain[-1] ^ (1 << (3 * k) % 64) ^ (1 << (3 * k + 1) % 64))
    fps = list(dict.fromkeys([*ball, *far, *chain]))
    every = np.array(fps, np.uint64)
    classes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    found = simhash_dedup.links(classes, crowd=crowd).collect()
    assert all(bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 2 for r in found)
    # a forest in each table, or a star around each point: never the pairs
    assert len(found) < (8 if crowd > len(fps) else 65) * len(fps)
    top = {int(x): int(x) for x in every.view(np.int64)}

    def root(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for r in found:
        top[root(r["a"])] = root(r["b"])
    signed = every.view(np.int64).tolist()
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(every[i + 1 :] ^ every[i]) <= 2):
            assert root(signed[i]) == root(signed[i + 1 + int(j)])


def test_votes_of_many_hashes():
    h = np.random.default_rng(3).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert simhash_dedup.votes(h).tolist() == [int((h >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]


def test_strange_fingerprints(strange, nothing):
    got = Counter(tuple(r) for r in simhash_dedup.dedup(strange).collect())
    assert got == near(STRANGE)
    assert simhash_dedup.dedup(nothing).count() == 0
    with pytest.raises(ValueError):
        simhash_dedup.links(nothing.select(F.col("doc_id").alias("fp")), radius=3)


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_look_up_treats_hot_keys_apart(spark, hot):
    rows = spark.range(1000).select("id", (F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 50)).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = skew.look_up(rows, table, "k", "n", hot)
    want = rows.join(table.drop("n"), "k").select(got.columns)
    assert got.count() == 1000 and got.exceptAll(want).count() == 0
