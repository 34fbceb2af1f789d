"""Which filter removes what, for every order of the filters.

A document's failures are a mask of filters. In the order p it is removed at the step of p's first letter that the
mask holds. Orders are numbered as their letters sort (Lehmer ranks), so the orders with one beginning are an
interval of ranks: all letters before the removing one lie outside the mask, and each such beginning of s letters
gives one interval of (n - s)! ranks. Instead of going through all orders, a mask adds its counts at the start of each of its
intervals and takes them away after the end; a running sum over the ranks then gives the removals of every
order and step.

So documents are read once, into counts by part and mask (at most 2^n masks a part); whatever comes after is small.
Equal texts are found by their SHA-256 digests and lengths: rows are counted by digest and what else they have in
common before they meet, so a text that a third of all rows share arrives as a few rows.

Defined cases: a null text is empty; an empty text has no words, so it fails A (too short) but neither B, C nor D; a null
part is the empty string; a row without an id never fails E and makes no other row fail it; rows that
repeat an id and a text are equal and, if the id is the smallest, all pass E; labels that repeat an id count once, a label
that is 1 in any of them holds; a filter that nobody fails has zeros; an empty table gives an empty result; columns other than
id, text and part are not looked at. Memory follows the longest text.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import materialize

#: The limits of the filters A to D.
WORDS = 200
DISTINCT = 50   # percent
CAPITALS = 3    # percent
SYMBOLS = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "[ \\t-\\r]+"
LETTERS = "ABCDE"

COUNTS = ("n", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n, points = F.size(words), F.char_length(text).cast("long")
    return {
        "A": n < WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT * n.cast("long"),
        "C": 100 * (points - F.char_length(F.translate(text, UPPER, ""))) > CAPITALS * points,
        "D": text.rlike(SYMBOLS),
    }


def mask_of(fails: dict[str, Column], letters: str) -> Column:
    """The failures as bits; the first letter is the lowest."""
    bits = [F.when(F.coalesce(fails[c], F.lit(False)), 1 << i).otherwise(0) for i, c in enumerate(letters) if c in fails]
    return sum(bits[1:], bits[0]).cast("int")


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents by their failures of A to E."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), whole.alias("text"),
    ).select("id", "part", mask_of(text_filters(F.col("text")), LETTERS).alias("mask"),
             F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("bytes"))
    marks = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = rows.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # an id's rows first, then the rows of a text that have all else in common
    same = ["digest", "bytes", "part", "mask", "good", "toxic"]
    by_id = marked.groupBy("id", *same).agg(F.count("*").alias("n"))
    alike = by_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"))
    of_text = Window.partitionBy("digest", "bytes")
    first = F.when(F.col("least") == F.min("least").over(of_text), F.col("at_least")).otherwise(0)
    judged = alike.withColumn("passes", F.col("without_id") + first)
    fails = 1 << LETTERS.index("E")
    both = F.explode(F.array(F.struct("mask", F.col("passes").alias("n")),
                             F.struct((F.col("mask") + fails).alias("mask"), (F.col("n") - F.col("passes")).alias("n"))))
    counted = judged.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
    return counted.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def orders(letters: str) -> list[str]:
    """All orders, each at its Lehmer rank."""
    return ["".join(p) for p in permutations(sorted(letters))]


def intervals(spark: SparkSession, letters: str) -> DataFrame:
    """(mask, step, from, to): the ranks of the orders in which a document with the mask goes at the step; `to` is after the last."""
    every, rows = orders(letters), []
    rank = {}
    for r, order in enumerate(every):
        for s in range(1, len(letters) + 1):
            rank.setdefault(order[:s], r)  # of an order's beginning: its first rank
    for mask in range(1, 1 << len(letters)):
        held = {c for i, c in enumerate(letters) if mask >> i & 1}
        rows += [(mask, len(b), r, r + factorial(len(letters) - len(b))) for b, r in rank.items() if b[-1] in held and not held & set(b[:-1])]
    return spark.createDataFrame(rows, "mask int, step int, from int, to int")


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The report on `masks`: a row for each part, order of the filters and step."""
    spark, n = counted.sparkSession, len(letters)
    every = orders(letters)
    # edges: what begins at a rank and what has ended before it
    edge = F.explode(F.array(F.struct(F.col("from").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("to").alias("rank"), F.lit(-1).alias("sign"))))
    edges = counted.join(intervals(spark, letters), "mask").withColumn("edge", edge).select(
        "part", "step", "edge.rank", *[(F.col(c) * F.col("edge.sign")).alias(c) for c in COUNTS])
    bit = lambda c: F.col("mask").bitwiseAND(1 << letters.index(c)) != 0
    alone = lambda c: F.col("mask") == 1 << letters.index(c)
    totals = counted.groupBy("part").agg(
        F.sum("n").alias("all"),
        F.create_map(*[x for c in letters for x in (F.lit(c), F.struct(
            F.sum(F.when(bit(c), F.col("n")).otherwise(0)).alias("fails"), F.sum(F.when(alone(c), F.col("n")).otherwise(0)).alias("alone")))]).alias("of"))
    spine = totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(every) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    added = spine.unionByName(edges).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    running = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = added.select("part", "step", "rank", *[F.sum(c).over(running).alias(c) for c in COUNTS]).where(F.col("rank") < len(every))
    named = gone.withColumn("filter_order", F.element_at(F.array(*[F.lit(o) for o in every]), F.col("rank") + 1)).withColumn(
        "filter", F.substring("filter_order", F.col("step"), F.lit(1))).join(totals, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.element_at("of", F.col("filter"))
    return named.select(
        "part", "filter_order", "step", (F.col("all") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (own["fails"] - F.col("n")).alias("redundant"), own["alone"].alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return audit(materialize(masks(docs, labels, part, id_col, text), "masks"))
