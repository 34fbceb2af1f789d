"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has a bit set where more than half of its shingles' 64-bit hashes have it. Documents are linked when
their fingerprints differ in at most `radius` bits, and linked documents form components.

Structured masks: each of the 64 bits is named by a non-zero vector of radius + 1 binary places (the vectors in turn), and table
v, for each of the 2^(radius+1) - 1 non-zero vectors v, masks out the bits whose vector is orthogonal to v. At most
`radius` vectors span no more than `radius` dimensions, so some v is orthogonal to all of them: two fingerprints that differ in at
most `radius` bits agree on all that this v's table looks at. *Every* linked pair collides in some table; nothing
rests on chance. A table keeps 36 or 37 of the 64 bits.

1. A narrow map gives each document its fingerprint; documents with one fingerprint are one class, whose smallest id stands
   for it, so exact copies and texts without words meet nothing but their class.
2. Classes are posted in each table under the bits it keeps. In a bucket of at most CROWD classes one task compares them and
   returns a spanning forest of the links, never the pairs.
3. A crowded bucket is split instead: its classes are posted under their fingerprint with up to radius / 2 of the masked bits
   flipped, and two of them are linked if and only if they share such a point (hence the radius is even). So a point's
   classes are a star around its smallest, and it has at most 65 of them (radius 2), whatever the bucket holds.
4. Components come from hooking and pointer doubling on tables in the shared folder.

Rows meet their class and classes their component by joins that treat hot keys apart (`skew.look_up`).

Defined cases: null and empty texts have fingerprint zero, which links like any other; texts shorter than a shingle are one
shingle; repeated rows and ids share what their texts give; rows without an id belong to their text's component, and a component of
such rows alone has a null id; an empty table gives an empty result; columns other than id and text are not looked at. Memory
follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import LOWER, texts
from tickloom.llm.lean import lean
from tickloom.llm.minhash_dedup import components
from tickloom.llm.skew import look_up
from tickloom.session import materialize

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
CROWD = 8192
_LANES = np.uint64(0x0101010101010101)


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit (bit 0 first)."""
    out = np.zeros((8, 8), np.int64)  # shift, byte
    if len(hashes):
        firsts = np.arange(0, len(hashes), 255)  # so many ones fit in a byte
        for shift in range(8):
            sums = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, firsts)
            out[shift] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.T.reshape(64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; zero without hashes."""
    return sum(1 << int(k) for k in np.flatnonzero(2 * votes(hashes) > len(hashes)))


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hashes of a lower-cased text's shingles, repeats included."""
    words = text.split()  # at ASCII white space, as bytes do
    if not words:
        return np.zeros(0, np.uint64)
    line, hash_ = b" ".join(words), xxhash.xxh64_intdigest
    at = [0, *accumulate(len(w) + 1 for w in words)]
    last = min(size, len(words))
    return np.fromiter((hash_(line[a : b - 1], seed) for a, b in zip(at, at[last:])), np.uint64, len(at) - last)


def fingerprints(docs: DataFrame, id_col: str, text: str, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp) of each document; the fingerprint is a signed long."""
    lower = LOWER.tobytes()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            found = [fingerprint(shingle_hashes(data[a:b].tobytes().translate(lower), size, seed)) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`")).mapInArrow(run, f"id {kind}, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """What each table looks at, as numbers of `bits` bits."""
    some = (1 << radius + 1) - 1
    vectors = [k % some + 1 for k in range(bits)]
    return [sum(1 << k for k, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, some + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to hold each component of some fingerprints together, as places (from, to)."""
    left = np.arange(len(fps))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    ahead: list[int] = []
    while len(left):
        if not ahead:
            ahead, left = [int(left[0])], left[1:]
            continue
        at = ahead.pop()
        near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
        met, left = left[near], left[~near]
        out.append((np.full(len(met), at), met))
        ahead.extend(met.tolist())
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def links(classes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp`, enough to hold the components together."""
    if radius % 2 or radius < 2:
        raise ValueError("the radius is an even number")
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("kept"))
                                 for v, m in enumerate(masks)]))
    posted = classes.select("fp", tables.alias("x")).select("x.table", "x.kept", "fp")
    sizes = posted.groupBy("table", "kept").agg(F.count("*").alias("size")).where("size > 1")
    met = posted.join(sizes, ["table", "kept"])
    buckets = met.where(F.col("size") <= crowd).groupBy("table", "kept").agg(F.collect_list("fp").alias("fps"))

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for held in batch.column(0):
                fps = held.values.to_numpy()
                i, j = forest(fps.view(np.uint64), radius)
                a.append(fps[i])
                b.append(fps[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    inside = buckets.select("fps").mapInArrow(compare, "a long, b long")
    flips = [[_signed(sum(1 << k for k in some)) for n in range(radius // 2 + 1) for some in combinations([k for k in range(BITS) if not m >> k & 1], n)]
             for m in masks]
    flips_of = F.element_at(F.array(*[F.array(*[F.lit(x) for x in f]) for f in flips]), F.col("table") + 1)
    crowded = met.where(F.col("size") > crowd).select("fp", F.explode(F.transform(flips_of, lambda x: x.bitwiseXOR(F.col("fp")))).alias("point"))
    stars = crowded.groupBy("point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    around = stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")
    return inside.unionByName(around).distinct()


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(id, fingerprint, component_id) of each document; the component's name is its smallest id."""
    rows = materialize(fingerprints(docs, id_col, text, size), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "classes")
    labels = components(materialize(links(classes, radius, crowd), "links"))
    named = classes.join(labels.withColumnRenamed("id", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    named = materialize(named, "named")
    least = named.groupBy("comp").agg(F.min("id").alias("component_id"), F.count("*").alias("classes"))
    known = look_up(named.select("fp", "rows", "comp"), materialize(least, "components"), "comp", "classes")
    found = look_up(rows, materialize(known, "known"), "fp", "rows")
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
