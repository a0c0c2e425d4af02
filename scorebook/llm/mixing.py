"""Mixing sources to target weights by a low-discrepancy source schedule.

1. *Targets.* Source i gets ``weights[i mod len]``; its target is ``level * weight``, but at most ``max_repeats``
   times its size. The level at which the targets add up to the mix is the largest of
   ``(mix - sizes of smaller caps) / (weights of the rest)`` along the caps by weight, so no round of resharing is
   iterated.
2. *Schedule.* A target is ``ceil(words / block_words)`` blocks. Slot t of the schedule takes the van der Corput point
   of t (its bits reversed) through the cumulative blocks of the sources; points above the last source are no slot. A
   source of K blocks owns K neighbouring points, so it gets exactly K slots, spread over the whole schedule, and any
   stretch of the schedule is close to the weights. All in integers: reruns agree.
3. *Blocks.* The documents of a source lie in a fixed random order, one after the other, and from the start again
   after its end: block j is words ``j * block_words`` and on, its last one cut at the target. The j-th slot of
   a source takes its block j.

Every step is a join, a running sum or a window over bounded parts: documents are laid out by range partitioning of
(source, order) and slots are ranked in buckets of their order, so no source is one task.

Defined results: a null text or one of white space has size 0 and is taken 0 times; null and '' are two sources; a
mix of no words has targets 0; rows of one doc_id are separate documents, and equal rows are interchangeable. Columns
of other names change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorebook.operators.ranks import SINGLE_TASK_ROWS, exact_ranks, prefix_sums, range_partitions, range_ranks

from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 4 << 20
SLOTS_PER_ROW = 1 << 16
SLOTS_PER_BUCKET = 1 << 17

# Masks of every other group of 1, 2, 4, 8, 16 and 32 bits.
BIT_GROUPS = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
              (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF))


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)  # of the sources by code point, repeating
    percent: int = 150  # words of the mix, in percent of all words
    max_repeats: int = 2  # no document is taken more often
    block_words: int = 1024
    seed: int = 11  # of the order of a source's documents


@dataclass(frozen=True)
class Mix:
    """``documents`` (row, doc_id, source, size, sid), ``sources`` (sid, source, source_size, target, words, blocks,
    first) and ``pieces`` (slot, offset, sid, row, doc_id, start, length): words ``start`` and on of a document at
    ``offset`` of a slot; the slots in ascending order are the mix, their numbers may have gaps."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(spark: SparkSession, documents: DataFrame, cfg: MixConfig, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """The sources by code point (null last) with sizes, targets and their blocks in the schedule."""
    sizes = materialise(spark, documents.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "last", F.col("source").isNull().cast("int")), "mix-sizes")
    facts = sizes.agg(F.count("*").alias("n"), F.sum("source_size").alias("size")).first()
    n, mix = facts["n"], cfg.percent * (facts["size"] or 0) / 100
    order = ["last", "source"]
    if n <= single_task_rows:
        ranked = exact_ranks(sizes, order, largest_group=n, single_task_rows=single_task_rows)
    else:
        ranked = range_ranks(sizes, order, partitions=range_partitions(n))
    weight = F.element_at(F.array(*[F.lit(w) for w in cfg.weights]), (F.col("rank") % len(cfg.weights) + 1).cast("int"))
    capped = ranked.select(F.col("rank").alias("sid"), "source", "source_size", weight.cast("long").alias("weight"),
                           (cfg.max_repeats * F.col("source_size")).alias("cap"))
    along = prefix_sums(capped.withColumn("fill", F.col("cap") / F.col("weight")), ["fill", "sid"],
                        {"cap": F.col("cap"), "weight": F.col("weight")}, buckets=max(8, n // 250_000),
                        largest_group=n, single_task_rows=single_task_rows)
    level = along.agg(F.max((mix - F.col("cap_before")) / (F.col("weight_total") - F.col("weight_before")))).first()[0] or 0.0
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    blocks = capped.withColumn("target", target).withColumn("words", F.floor(F.col("target") + 0.5)).withColumn(
        "blocks", F.ceil(F.col("words") / cfg.block_words).cast("long"))
    placed = prefix_sums(blocks, ["sid"], {"blocks": F.col("blocks")}, buckets=max(8, n // 250_000), largest_group=n,
                         single_task_rows=single_task_rows)
    return materialise(spark, placed.select("sid", "source", "source_size", "target", "words", "blocks",
                                            F.col("blocks_before").alias("first")), "mix-sources")


def with_source(spark: SparkSession, rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source; the sources are broadcast only below a measured byte bound."""
    small = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 100)).first()[0] or 0
    side = sources.withColumnRenamed("source", "named")
    side = F.broadcast(side) if small <= BROADCAST_BYTES else side
    return rows.join(side, F.col("source").eqNullSafe(F.col("named"))).drop("named")


def reversed_bits(v: Column, bits: int) -> Column:
    """The van der Corput point of ``v`` as an integer: its lowest ``bits`` bits in reverse order."""
    for width, mask in BIT_GROUPS:
        low = F.lit(mask).cast("long")
        v = F.shiftleft(v.bitwiseAND(low), width).bitwiseOR(F.shiftrightunsigned(v, width).bitwiseAND(low))
    return F.shiftrightunsigned(v, 64 - bits) if bits else F.lit(0).cast("long")


def schedule(spark: SparkSession, sources: DataFrame, single_task_slots: int = SLOTS_PER_BUCKET) -> DataFrame:
    """(slot, sid, block): the j-th slot of each source, in slot order, takes its block j."""
    total = sources.agg(F.sum("blocks")).first()[0] or 0
    bits = max(total - 1, 0).bit_length()
    runs = sources.where("blocks > 0").select("sid", "first", "blocks", F.explode(F.expr(f"sequence(0, blocks - 1, {SLOTS_PER_ROW})")).alias("lo"))
    points = runs.repartition("sid", "lo").select(
        "sid", F.explode(F.sequence(F.col("lo"), F.least(F.col("lo") + SLOTS_PER_ROW, F.col("blocks")) - 1)).alias("k"), "first")
    # Written first: Spark cannot tell from the few sources how many slots there are, and would broadcast them.
    slots = materialise(spark, points.select(reversed_bits(F.col("first") + F.col("k"), bits).alias("slot"), "sid"), "mix-slots")
    cut = min(bits, max(3, (total // single_task_slots).bit_length()))
    ranked = exact_ranks(slots, ["slot"], ["sid"], bucket=(F.shiftright("slot", bits - cut), 1 << cut))
    return ranked.select("slot", "sid", F.col("rank").alias("block"))


def laid_out(spark: SparkSession, documents: DataFrame, cfg: MixConfig, partitions: int | None = None) -> DataFrame:
    """Documents with words, and ``at``: the words of their source before them in its fixed random order."""
    filled = documents.where("size > 0").withColumn("order", F.xxhash64("doc_id", "size", F.lit(cfg.seed)))
    keys = ["sid", "order", "doc_id", "size", "row"]
    laid = filled.repartitionByRange(partitions or range_partitions(documents.count()), *keys)
    laid = materialise(spark, laid.select(*keys, F.spark_partition_id().alias("part")), "mix-order")
    sums = laid.groupBy("sid", "part").agg(F.sum("size").alias("held"))
    offsets = sums.select("sid", "part", (F.sum("held").over(Window.partitionBy("sid").orderBy("part")) - F.col("held")).alias("before"))
    inside = Window.partitionBy("sid", "part").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return laid.join(offsets, ["sid", "part"]).select(
        "sid", "row", "doc_id", "size", (F.col("before") + F.sum("size").over(inside) - F.col("size")).alias("at"))


def mixed(spark: SparkSession, docs: DataFrame, cfg: MixConfig = MixConfig(), partitions: int | None = None,
          single_task_rows: int = SINGLE_TASK_ROWS) -> Mix:
    """The whole mix of the documents (doc_id, text, source)."""
    read = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row"))
    read = materialise(spark, read, "mix-documents")  # the row numbers stay as they are
    sources = source_table(spark, read, cfg, single_task_rows)
    documents = with_source(spark, read, sources)
    slots = schedule(spark, sources)
    side = F.broadcast if sources.count() * 50 <= BROADCAST_BYTES else (lambda df: df)
    laid = laid_out(spark, documents, cfg, partitions).join(side(sources.select("sid", "source_size", "words")), "sid")
    width = cfg.block_words
    turns = laid.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(cfg.max_repeats - 1)))).withColumn(
        "lo", F.col("turn") * F.col("source_size") + F.col("at")).withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("words")))
    cut = turns.where("lo < hi").withColumn("block", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})"))).withColumn(
        "from", F.greatest(F.col("lo"), F.col("block") * width)).withColumn("to", F.least(F.col("hi"), (F.col("block") + 1) * width))
    pieces = cut.join(slots.hint("merge"), ["sid", "block"]).select(
        "slot", (F.col("from") - F.col("block") * width).alias("offset"), "sid", "row", "doc_id",
        (F.col("from") - F.col("lo")).alias("start"), (F.col("to") - F.col("from")).alias("length"))
    return Mix(documents, sources, pieces)


def takings(mix: Mix) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and the words that the mix takes of it."""
    taken = mix.pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    return mix.documents.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
