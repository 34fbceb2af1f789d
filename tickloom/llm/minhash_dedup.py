"""MinHash near-dedup by an inverted join over signature coordinates.

A document's set holds its distinct shingles; two documents are linked when 100 |A n B| >= 80 |A u B|.

1. Documents with equal sets form a class (128-bit digest of the set), and one of them stands for it.
2. A signature has `COORDINATES` minima. Linked sets agree in at least `MATCHES` of them, save once in
   a million pairs. Representatives are posted under (coordinate, value) pairs. Pairs are ordered by
   how many documents hold them, rarest first, and a document is posted only under the first
   COORDINATES - MATCHES + 1: two documents that agree often enough share one of those (prefix).
   Pairs that one document holds alone are counted, not posted.
3. Each posting list is a star around its smallest id. Collisions with a centre are counted over the
   lists, the full signatures compared, and each document's best centre is checked on the full
   sets. Confirmed links give components.
4. Lists that hold several components are unsettled. Their documents are dealt into cells around the
   centre they share most lists with, and two cells that meet in a list are compared in one task, on the full
   sets: every pair that shares a list and lies in two components, skipping those joined on the way.

So most near copies cost one check each, pairs are never rows, and no link between different
texts is left out. Lists, candidates and links stay distributed; a hot list or centre is a skewed join,
which Spark splits. Components come from hooking and pointer doubling on tables in the shared folder.

Defined cases: null and empty texts have an empty set, are linked with nothing and kept; texts shorter than a
shingle are one shingle; rows that repeat an id are linked through it; rows without an id take part with
the documents of the same set only; an empty table gives an empty result; input columns named like a
result give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import FIRST, LOWER, Hasher, hashed_words, mix, numbers, secret_hashers, slices, texts
from tickloom.llm.blocks import among
from tickloom.llm.lean import lean
from tickloom.session import materialize

SHINGLE = 4
COORDINATES = 32
MATCHES = 14
ALIKE = 80  # percent
CELL = 512
JUMPS = 3


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, hasher: Hasher = FIRST) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of texts laid end to end."""
    words = hashed_words(LOWER[data], offsets, (hasher,))
    h = words.hashes[0]
    first = words.within(size)
    keys = hasher.windows(h, first, size)
    edges = np.searchsorted(words.doc[first], np.arange(len(offsets)))
    ends = np.cumsum(words.counts)
    out = []
    for d, n in enumerate(words.counts):
        if n >= size:
            out.append(np.unique(keys[edges[d] : edges[d + 1]]))
        elif n:
            out.append(hasher.windows(h, np.array([ends[d] - n]), int(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Minima of each non-empty set (rows) under each of the hash functions."""
    keys = np.concatenate(sets)
    first = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    factors, terms = numbers(41, coordinates) | np.uint64(1), numbers(43, coordinates)
    out = np.empty((len(sets), coordinates), np.int32)
    for k in range(coordinates):
        values = ((keys * factors[k] + terms[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, first).view(np.int32)
    return out


def _digest(keys: np.ndarray) -> bytes:
    return np.array([mix(keys).sum(), mix(keys ^ numbers(47, 1)[0]).sum()], np.uint64).tobytes()


def features(docs: DataFrame, id_col: str, text: str, size: int, coordinates: int, hasher: Hasher = FIRST) -> DataFrame:
    """(id, n_shingles, digest, sig) of each document; null digest and signature for empty sets."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in slices(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size, hasher)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full, coordinates).tolist() if full else [])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ], names=["id", "n_shingles", "digest", "sig"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`")).mapInArrow(
        run, f"id {kind}, n_shingles long, digest binary, sig array<int>")


def full_sets(docs: DataFrame, id_col: str, text: str, size: int, hasher: Hasher = FIRST) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in slices(offsets, 1 << 20):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size, hasher)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                                 names=["id", "set"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`")).mapInArrow(run, f"id {kind}, set array<long>")


def postings(reps: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(coord, val, id): each representative under its rarest pairs that others hold too."""
    posted = reps.select("id", F.posexplode("sig").alias("coord", "val"))
    held = posted.groupBy("coord", "val").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = posted.join(held, ["coord", "val"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "coord", "val"))).alias("pairs"))
    # pairs held alone come first in the order and take up places of the prefix
    places = F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("pairs"))
    shared = shared.where(places > 0).select("id", F.explode(F.slice("pairs", F.lit(1), places)).alias("p"))
    return shared.select("p.coord", "p.val", "id")


def compared(pairs: DataFrame, reps: DataFrame, matches: int, alike: int) -> DataFrame:
    """Pairs (a, b) whose signatures match often enough and whose sizes allow a link, with `same`."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    size = 100 * F.least("n_a", "n_b") >= alike * F.greatest("n_a", "n_b")
    return both.withColumn("same", same).where((F.col("same") >= matches) & size).select("a", "b", "same")


def confirmed(pairs: DataFrame, sets: DataFrame, alike: int) -> DataFrame:
    """Pairs whose full sets are alike."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    both = both.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * common >= alike * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, comp) with the smallest id that links (a, b) reach; goes on from earlier `labels`.

    In each round every component hooks onto its smallest neighbour, and pointers are doubled until they
    end at a root. At least half of the components that still have links vanish in a round.
    """
    ids = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    start = ids.select("id", F.col("id").alias("comp"))
    if labels is not None:
        start = labels.unionByName(start.join(labels, "id", "left_anti"))
    labels = materialize(start, "labels")
    while True:
        of = lambda x: labels.select(F.col("id").alias(x), F.col("comp").alias(f"c_{x}"))
        between = links.join(of("a"), "a").join(of("b"), "b").where(F.col("c_a") != F.col("c_b"))
        hooks = between.groupBy(F.greatest("c_a", "c_b").alias("root")).agg(F.min(F.least("c_a", "c_b")).alias("to"))
        hooks = materialize(hooks, "hooks")
        if hooks.isEmpty():
            return labels
        while True:
            up = hooks.select(F.col("root").alias("to"), F.col("to").alias("up"))
            further = materialize(hooks.join(up, "to", "left").select("root", F.coalesce("up", "to").alias("to"), F.col("up").isNotNull().alias("moved")), "hooks")
            hooks = further.select("root", "to")
            if further.where("moved").isEmpty():
                break
        moved = hooks.select(F.col("root").alias("comp"), "to")
        labels = materialize(labels.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")


def _cross_links(near: list[dict], far: list[dict], alike: int) -> list[tuple]:
    """Links (a, b) that join components: documents of two cells that share a list.

    Components that were joined on the way are one, so a pair between them is skipped.
    """
    within = near is far
    top: dict = {}

    def root(c):
        while c in top:
            c = top[c]
        return c

    lists = [np.concatenate([d["lists"] for d in cell]) for cell in (near, far)]
    names = np.unique(np.concatenate(lists))
    held = []
    for cell, keys in zip((near, far), lists):
        at = np.zeros((len(cell), len(names)), np.float32)
        at[np.repeat(np.arange(len(cell)), [len(d["lists"]) for d in cell]), np.searchsorted(names, keys)] = 1
        held.append(at)
    shared = held[0] @ held[1].T > 0
    sizes = np.array([len(d["set"]) for d in far])
    out = []
    for i, d in enumerate(near):
        own = len(d["set"])
        met = shared[i] & (100 * np.minimum(sizes, own) >= alike * np.maximum(sizes, own))
        if within:
            met[: i + 1] = False
        met = [j for j in np.flatnonzero(met) if root(far[j]["comp"]) != root(d["comp"])]
        if not met:
            continue
        sets = [far[j]["set"] for j in met]
        first = np.cumsum([0, *[len(x) for x in sets[:-1]]])
        common = np.add.reduceat(among(np.concatenate(sets), d["set"]).astype(np.int64), first)
        union = own + sizes[met] - common
        for j in np.array(met)[100 * common >= alike * union]:
            c1, c2 = root(d["comp"]), root(far[j]["comp"])
            if c1 != c2:
                top[max(c1, c2)] = min(c1, c2)
                out.append((d["id"], far[j]["id"]))
    return out


def cross_links(lists: DataFrame, labels: DataFrame, stars: DataFrame, sets: DataFrame, alike: int) -> DataFrame:
    """(a, b): links between components, among all pairs that share a list; one at least for each two that are linked.

    Documents of unsettled lists (those with several components) are dealt into cells: around the centre
    that they share most lists with, CELL documents at most in the mean. Two cells that meet in a list are
    compared by one task, which holds both cells' sets; pairs are never rows.
    """
    placed = lists.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    several = placed.groupBy("coord", "val").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") != F.col("hi"))
    unsettled = placed.join(several.select("coord", "val"), ["coord", "val"]).withColumn("list", F.xxhash64("coord", "val"))
    homes = stars.groupBy(F.col("b").alias("id")).agg(F.max_by("a", F.struct("lists", -F.col("a"))).alias("home"))
    docs = unsettled.groupBy("id").agg(F.first("comp").alias("comp"), F.collect_list("list").alias("lists"))
    docs = docs.join(homes, "id", "left").withColumn("home", F.coalesce("home", "id"))
    for _ in range(JUMPS):  # centres gather around their own centres, so a group has few, full cells
        up = docs.select(F.col("id").alias("home"), F.col("home").alias("up"))
        docs = materialize(docs.join(up, "home", "left").withColumn("home", F.coalesce("up", "home")).drop("up"), "unsettled")
    cells = docs.groupBy("home").agg(F.ceil(F.count("*") / CELL).cast("long").alias("cells"))
    docs = docs.join(cells, "home").withColumn("cell", F.xxhash64("home", F.pmod(F.xxhash64("id"), F.col("cells")))).drop("home", "cells")
    docs = materialize(docs, "unsettled")
    seen = docs.select(F.explode("lists").alias("list"), "cell", "comp").groupBy("list", "cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    one = lambda n: seen.select("list", F.col("cell").alias(f"c{n}"), F.col("lo").alias(f"lo{n}"), F.col("hi").alias(f"hi{n}"))
    apart = (F.col("lo1") != F.col("hi1")) | (F.col("lo2") != F.col("hi2")) | (F.col("lo1") != F.col("lo2"))
    meet = one(1).join(one(2), "list").where((F.col("c1") <= F.col("c2")) & apart).select("c1", "c2").distinct()
    full = docs.join(sets, "id")
    side = lambda n: meet.join(full.withColumnRenamed("cell", f"c{n}"), f"c{n}").select(
        "c1", "c2", F.lit(n).alias("side"), "id", "comp", "lists", "set")
    sent = side(1).unionByName(side(2).where(F.col("c1") != F.col("c2")))
    kind = dict(lists.dtypes)["id"]

    @lean
    def check(key: tuple, table: pa.Table) -> pa.Table:
        cell: dict[int, list[dict]] = {1: [], 2: []}
        columns = {n: table.column(n) for n in ("side", "id", "comp", "lists", "set")}
        for k in range(table.num_rows):
            row = {n: columns[n][k] for n in columns}
            cell[row["side"].as_py()].append({
                "id": row["id"].as_py(), "comp": row["comp"].as_py(), "lists": row["lists"].values.to_numpy(),
                "set": np.sort(row["set"].values.to_numpy())})
        found = _cross_links(cell[1], cell[2] or cell[1], alike)
        of = lambda n: pa.array([x[n] for x in found], table.schema.field("id").type)
        return pa.table({"a": of(0), "b": of(1)})

    return sent.groupBy("c1", "c2").applyInArrow(check, f"a {kind}, b {kind}")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, coordinates: int = COORDINATES,
          matches: int = MATCHES, alike: int = ALIKE) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each document; one document of each component is kept."""
    (hasher,) = secret_hashers(1)
    rows = materialize(features(docs, id_col, text, size, coordinates, hasher), "shingles")
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    classes = materialize(classes, "classes")
    reps = classes.where(F.col("id").isNotNull()).select("id", "n_shingles", "sig")
    lists = materialize(postings(reps, coordinates, matches), "postings")
    wanted = lists.select("id").distinct()
    sets = materialize(full_sets(docs.join(wanted.withColumnRenamed("id", id_col), id_col, "left_semi"), id_col, text, size, hasher), "sets")

    centres = lists.groupBy("coord", "val").agg(F.min("id").alias("a"))
    stars = lists.join(centres, ["coord", "val"]).where(F.col("id") != F.col("a")).groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("lists"))
    stars = materialize(stars, "stars")
    near = compared(stars, reps, matches, alike)
    best = near.groupBy("b").agg(F.max_by("a", F.struct("same", -F.col("a"))).alias("a"))
    links = materialize(confirmed(best, sets, alike), "links")
    labels = components(links)
    more = materialize(cross_links(lists, labels, stars, sets, alike), "links")
    labels = components(more, labels)

    named = classes.select("digest", F.col("id").alias("rep")).join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("comp", "rep").alias("comp"))
    found = rows.join(named, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("comp", "id").alias("component_id"))
    return found.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
