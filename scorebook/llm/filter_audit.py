"""Filter interaction audit: what each filter removes, in every order of the filters, from counts per failure mask.

A document's *mask* holds the filters that it fails. In an order of n filters it goes at the first one of its mask.
The n! orders are numbered lexicographically (their Lehmer rank), so all orders that begin alike are one interval of
ranks: a mask's removal step covers a few intervals. For each (part, step) the counts of a mask are added where such
an interval starts and taken off where it ends; a running sum over the ranks gives the totals of all orders. The
documents are read once, for their masks; what follows has at most 2^n rows a part.

Defined results: a null text is empty and a null source the part ''. A null doc_id is never smaller than another and
has no label. Rows of one doc_id count one by one; labels of one doc_id are joined (any 1 is a 1). An empty table
gives no rows. Columns of other names change nothing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

# The five filters of the contract.
FILTERS = "ABCDE"
WORD_GAP = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ODD_SIGNS = "[#$%&*|]"

MAX_FILTERS = 7  # 5,040 orders and 128 masks: the table of intervals stays a few megabytes
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def orders(filters: str) -> list[str]:
    """All orders of the filters; the index of each is its Lehmer rank."""
    return ["".join(p) for p in itertools.permutations(sorted(filters))]


def mask_intervals(mask: int, n: int) -> list[tuple[int, str, int, int]]:
    """(step, state, first rank, end rank) of one mask: 'removed' at the step, 'redundant' (the step's filter fails, an
    earlier one did too) or 'kept' after it. All orders with one prefix of k filters are (n - k)! ranks in a row; side
    by side intervals of one state are joined."""

    def below(left: tuple[int, ...], first: int, gone: bool) -> Iterator[tuple[int, str, int, int]]:
        step, size = n - len(left) + 1, math.factorial(len(left) - 1)
        for digit, f in enumerate(left):
            lo, hit = first + digit * size, bool(mask >> f & 1)
            if hit:
                yield step, "redundant" if gone else "removed", lo, lo + size
            elif not gone:
                yield step, "kept", lo, lo + size
            if len(left) > 1:
                yield from below(left[:digit] + left[digit + 1 :], lo, gone or hit)

    out: list[tuple[int, str, int, int]] = []
    for step, state, lo, hi in sorted(below(tuple(range(n)), 0, False)):
        if out and out[-1][:2] == (step, state) and out[-1][3] == lo:
            out[-1] = (step, state, out[-1][2], hi)
        else:
            out.append((step, state, lo, hi))
    return out


def text_mask(text: Column) -> Column:
    """The bits of the filters A to D, which depend on the text alone."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    n_words, n_signs = F.size(words), F.length(text)
    fails = (
        n_words < 50,
        100 * F.size(F.array_distinct(words)) < 65 * n_words,
        100 * (n_signs - F.length(F.translate(text, CAPITALS, ""))).cast("long") > 5 * n_signs.cast("long"),
        text.rlike(ODD_SIGNS),
    )
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per failure mask, and how many of them are labelled 1.

    Copies are found by a digest of the text. Equal texts share the bits A to D, so they are counted per (digest, part,
    labels) before they meet: a text with any number of copies is a few rows there, and no row but counts is compared.
    """
    text = F.coalesce("text", F.lit(""))
    facts = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
                        text_mask(text).alias("bits"))
    once = facts.groupBy("doc_id", "part", "digest", "bits").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Null ids meet no label; a salt keeps them from one task.
    salted = once.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    known = salted.join(marks.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left")
    mark = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    held = known.groupBy("digest", "bits", "part", mark("good"), mark("toxic")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    sound = F.col("nameless") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    split = held.withColumn("sound", sound).select(
        "part", "good", "toxic",
        F.explode(F.array(F.struct(F.col("bits").alias("mask"), F.col("sound").alias("n")),
                          F.struct(F.col("bits").bitwiseOR(1 << 4).alias("mask"), (F.col("n") - F.col("sound")).alias("n")))).alias("s"))
    return split.where("s.n > 0").groupBy("part", "s.mask").agg(
        F.sum("s.n").alias("n"), F.sum(F.col("s.n") * F.col("good")).alias("good"), F.sum(F.col("s.n") * F.col("toxic")).alias("toxic"))


def interactions(spark: SparkSession, counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, ``MEASURES``, shapley) for every part, order and step, zeros included, from the
    counts per mask (``mask_counts``)."""
    n = len(filters)
    if not 1 <= n <= MAX_FILTERS or len(set(filters)) != n:
        raise ValueError(f"1 to {MAX_FILTERS} different filters can be audited, got {filters!r}")
    total = math.factorial(n)
    spans = [(m, *span, bin(m).count("1") == 1) for m in range(1 << n) for span in mask_intervals(m, n)]
    # A fixed table: its size depends on the number of filters only.
    table = F.broadcast(spark.createDataFrame(spans, "mask int, step int, state string, lo int, hi int, single boolean"))
    counts = materialise(spark, counts, "mask-counts")
    here = lambda state, c="n": F.when(F.col("state") == state, F.col(c)).otherwise(0)
    amounts = {"kept": here("kept"), "removed": here("removed"), "redundant": here("redundant"),
               "unique_fails": F.when(F.col("single"), here("removed")).otherwise(0),
               "good_lost": here("removed", "good"), "toxic_lost": here("removed", "toxic")}
    covered = counts.join(table, "mask").select("part", "step", "lo", "hi", *[v.alias(k) for k, v in amounts.items()])
    ends = F.array(F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign")))
    changes = covered.withColumn("end", F.explode(ends)).where(F.col("end.rank") < total).select(
        "part", "step", F.col("end.rank").alias("rank"), *[(F.col(c) * F.col("end.sign")).alias(c) for c in MEASURES])
    grid = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in MEASURES])
    differences = changes.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in MEASURES])
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = F.array(*[F.lit(o) for o in orders(filters)])
    rows = differences.select("part", F.element_at(names, F.col("rank") + 1).alias("filter_order"), "step",
                              *[F.sum(c).over(ranks).alias(c) for c in MEASURES])
    letter = F.expr("substring(filter_order, step, 1)")
    shapley = F.sum("removed").over(Window.partitionBy("part", letter)).alias("shapley")
    return rows.select("part", "filter_order", "step", *MEASURES, shapley)


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over whole documents: every part, order and step."""
    return interactions(spark, mask_counts(docs, labels))
