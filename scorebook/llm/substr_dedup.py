"""Removal of passages that repeat across documents, by level-wise doubling of word windows.

Windows grow level by level from ``first_length`` words to ``size`` (12, 25, 50). At each level a window that occurs in
one document only goes, as nothing longer around it can repeat; what repeats is extended to twice that length. Below
``size``, the windows of a text are the *anchors* of the next level: of every longer window, the half-size window of
least hash, so equal windows have equal anchors, and a text has few of them. All lengths of an anchor are computed in
one scan of the texts and written as one narrow row; the loop over the levels joins these rows with the windows that
repeat, shortest first, until ``size`` is next or no candidate survives. Then only windows of ``size`` words whose anchor
survived are hashed (128 bits) and joined; the least doc_id of each window decides. A word covered by a window whose
words also start in a document of a smaller id is removed. Removal ends there: every longer repeat is covered by its
windows of ``size`` words. ``longest_repeats`` goes on doubling until no candidate survives.

No position travels: a document's candidate windows are recomputed from its text next to the short list of its
surviving anchors. Minima are pre-aggregated before each shuffle, so a passage that a third of the documents share is
one row a task. The text is shuffled once by doc_id and that exchange serves both passes.

Defined results: null and empty texts have no words. Rows with a null doc_id have no place in the order: nothing is
removed from them and they take nothing from others. Rows that share a doc_id do not count as smaller than each
other. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .common import Roller, Texts, carrying, leased, materialise, space_words, text_slices, to_signed, uncarried, window_owner


@dataclass(frozen=True)
class SubstringConfig:
    size: int = 50  #: words of a window
    first_length: int = 8  #: windows are halved from ``size`` while they keep so many words

    def lengths(self) -> list[int]:
        """Lengths of the levels below ``size``, shortest first; at least one."""
        out = [max(self.size // 2, 1)]
        while out[0] // 2 >= self.first_length:
            out.insert(0, out[0] // 2)
        return out


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    if len(a) < width:
        return a[:0]
    span, m = 1, a
    while 2 * span <= width:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


class Windows:
    """Word and window hashes of a slice of texts."""

    def __init__(self, texts: Texts, rollers: tuple[Roller, Roller]):
        self.rollers = rollers
        self.starts, self.ends, self.first = space_words(texts)
        self.words = rollers[0].spans(texts.data, self.starts, self.ends)
        self.words2 = None
        self.texts = texts

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, text, inside) of every window of ``size`` words; inside: it does not cross its text's end."""
        half = size // 2
        least = sliding_min(self.rollers[0].windows(self.words, half), size - half + 1)
        owner, inside = window_owner(self.first, size, len(self.words))
        return least, owner, inside

    def nested(self, lengths: list[int], size: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(text, anchors by length) of the distinct neighbouring anchors: of each window of ``size`` words its anchor of
        the longest length, of that one its own anchor of the length below, and so on."""
        least, owner, inside = self.anchors(size)
        least, owner, at = least[inside], owner[inside], np.flatnonzero(inside)
        fresh = np.ones(len(least), dtype=bool)  # neighbours mostly share their anchor
        fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        least, owner, at = least[fresh], owner[fresh], at[fresh]
        found, outer = [least], size
        for k in range(len(lengths) - 1, 0, -1):
            half, below = lengths[k], lengths[k - 1]
            inner = sliding_min(self.rollers[0].windows(self.words, below), half - below + 1)
            spots = at[:, None] + np.arange(outer - half + 1)
            at = at + (self.rollers[0].windows(self.words, half)[spots] == found[0][:, None]).argmax(axis=1) if len(at) else at
            found.insert(0, inner[at])
            outer = half
        return owner, found

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """128-bit identity of every window of ``size`` words, as two arrays."""
        if self.words2 is None:
            self.words2 = self.rollers[1].spans(self.texts.data, self.starts, self.ends)
        return self.rollers[0].windows(self.words, size), self.rollers[1].windows(self.words2, size)


def _rollers() -> tuple[Roller, Roller]:
    return Roller(101), Roller(202)


def _list_column(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def document_anchors(docs: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """(doc_id, w12, w25, ...): the distinct anchors of each text with the shorter ones inside them, one scan."""
    lengths = cfg.lengths()
    names = [f"w{n}" for n in lengths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for t in text_slices(batch.column("text")):
                owner, found = Windows(t, rollers).nested(lengths, cfg.size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[t.lo + owner].astype(np.int64)), *(pa.array(to_signed(f)) for f in found)], ["doc_id", *names])

    schema = ", ".join(f"{n} long" for n in ["doc_id", *names])
    return docs.where("doc_id is not null and text is not null").mapInArrow(leased("text", run), schema)


def level_survivors(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig) -> list[tuple[int, DataFrame]]:
    """(length, anchors left) of every level below ``size`` that was run, shortest first. The last one's windows repeat
    at all lengths; the loop ends early when none is left."""
    rows, done = materialise(spark, document_anchors(docs, cfg), "anchors"), []
    for length in cfg.lengths():
        shared = rows.groupBy(f"w{length}").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select(f"w{length}")
        rows = materialise(spark, rows.join(shared, f"w{length}", "left_semi"), "level")
        done.append((length, rows))
        if rows.isEmpty():
            break
    return done


def surviving_anchors(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """(doc_id, anchors array<long>): anchors of ``size // 2`` words of each document that repeat at every level."""
    rows = level_survivors(spark, docs, cfg)[-1][1]
    return materialise(spark, rows.groupBy("doc_id").agg(F.collect_set(f"w{cfg.lengths()[-1]}").alias("anchors")), "anchor-lists")


def _candidates(batch: pa.RecordBatch, size: int, rollers):
    """Per text with anchors: (row, Windows, first word, number of words, places of its candidate windows, keys)."""
    anchors = batch.column("anchors")
    have = np.flatnonzero(np.asarray(anchors.is_valid()))
    if not len(have):
        return
    sub = batch.take(pa.array(have))
    lists = sub.column("anchors")
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    for t in text_slices(sub.column("text")):
        w = Windows(t, rollers)
        least, _, _ = w.anchors(size)
        k1, k2 = w.keys(size)
        least = to_signed(least)
        for i in range(len(t)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            stop = max(a, b - size + 1)
            own = flat[ends[t.lo + i] : ends[t.lo + i + 1]]
            yield int(have[t.lo + i]), t.raw(i), b - a, np.flatnonzero(np.isin(least[a:stop], own)), k1[a:stop], k2[a:stop]


def first_holders(joined: DataFrame, size: int) -> DataFrame:
    """(doc_id, firsts array<long>): the candidate windows of which each document is the least holder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)  # a null would make the ids floats
            for row, _, _, places, k1, k2 in _candidates(batch, size, rollers):
                _, keep = np.unique(k1[places], return_index=True)
                at = places[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), int(ids[row]))), pa.array(to_signed(k1[at])), pa.array(to_signed(k2[at]))],
                    ["doc_id", "k1", "k2"],
                )

    rows = joined.mapInArrow(leased("text", _coalesced(run, ("doc_id", "k1", "k2"))), "doc_id long, k1 long, k2 long")
    least = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    return least.groupBy("doc_id").agg(F.collect_list("k1").alias("firsts"))


def _coalesced(run, names, rows: int = 50_000):
    """Joins a generator's many small batches into larger ones."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return whole


def remove_repeats(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed array<struct<lo, hi>>) of every row of (doc_id, text).

    ``kept`` is the kept words joined by one space; ``removed`` holds word ranges [lo, hi).
    """
    ranges = "removed array<struct<lo:int,hi:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        for batch in batches:
            n_words, n_removed, kept, removed = _kept_words(batch, cfg.size, rollers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, kind)],
                ["doc_id", "n_words", "n_removed", "kept", "removed"],
            )

    done = _with_lists(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cfg)
    return done.mapInArrow(leased("text", run), f"doc_id long, n_words long, n_removed long, kept string, {ranges}")


def cleaned(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """``docs``, all columns, with ``text`` (and ``n_chars``, its length) after removal.

    Texts that lose nothing are unchanged; texts that lose every word go.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            n_words, n_removed, kept, _ = _kept_words(batch, cfg.size, rollers)
            changed = pa.array(n_removed > 0)
            text = pc.if_else(changed, pa.array(kept, pa.binary()).cast(pa.string()), batch.column("text").cast(pa.string()))
            whole = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, batch.column("carry"), changed], ["doc_id", "text", "carry", "changed"]
            )
            yield whole.filter(pa.array((n_removed == 0) | (n_removed < n_words)))

    packed = carrying(docs)
    out = _with_lists(spark, packed, cfg).mapInArrow(leased("text", run), StructType([*packed.schema.fields, StructField("changed", BooleanType())]))
    if "n_chars" in docs.columns:
        length = F.when(F.col("changed"), F.length("text")).otherwise(F.col("carry.n_chars"))
        out = out.withColumn("carry", F.col("carry").withField("n_chars", length.cast(docs.schema["n_chars"].dataType)))
    return uncarried(out, docs.columns)


def _with_lists(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """``docs`` with each document's surviving anchors and the candidate windows of which it is the least holder."""
    lists = surviving_anchors(spark, docs.select("doc_id", "text"), cfg)
    joined = docs.join(lists, "doc_id", "left")
    return joined.join(first_holders(joined.select("doc_id", "text", "anchors"), cfg.size), "doc_id", "left")


def _kept_words(batch: pa.RecordBatch, size: int, rollers):
    """Per row: number of words, number removed, kept words joined by one space, removed word ranges."""
    n = batch.num_rows
    n_words, n_removed = np.zeros(n, np.int64), np.zeros(n, np.int64)
    kept: list[bytes] = [b""] * n
    removed: list[list] = [[]] * n
    firsts = batch.column("firsts")
    for row, raw, count, places, k1, _ in _candidates(batch, size, rollers):
        own = firsts[row].values
        first = own.to_numpy(zero_copy_only=False) if own is not None else np.zeros(0, np.int64)
        later = places[~np.isin(to_signed(k1[places]), first)]
        if not len(later):
            continue
        steps = np.zeros(count + 1, np.int64)
        np.add.at(steps, later, 1)
        np.add.at(steps, later + size, -1)
        gone = np.cumsum(steps[:-1]) > 0
        words = raw.split()
        kept[row] = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
        n_words[row], n_removed[row] = count, int(gone.sum())
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        removed[row] = [{"lo": int(a), "hi": int(b)} for a, b in edges.reshape(-1, 2)]
    for t in text_slices(batch.column("text")):
        for i in range(len(t)):
            if not n_removed[t.lo + i]:
                words = t.raw(i).split()
                n_words[t.lo + i], kept[t.lo + i] = len(words), b" ".join(words)
    return n_words, n_removed, kept, removed


def longest_repeats(spark: SparkSession, docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """(doc_id, longest): the longest level (size, 2 size, 4 size, ...) at which a window of the document repeats elsewhere.

    Each level hashes only windows of which both halves repeat; the loop ends when no candidate survives.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    lists = surviving_anchors(spark, texts, cfg)
    out, level = None, cfg.size
    while True:
        rows = materialise(spark, texts.join(lists, "doc_id").mapInArrow(leased("text", _level_windows(level, level == cfg.size)), "doc_id long, k1 long, k2 long"), "level")
        shared = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("k1", "k2")
        found = rows.join(shared, ["k1", "k2"], "left_semi").groupBy("doc_id").agg(F.collect_set("k1").alias("anchors"))
        lists = materialise(spark, found, "level-lists")
        if lists.isEmpty():
            break
        here = lists.select("doc_id", F.lit(level).cast("long").alias("longest"))
        out = here if out is None else out.unionByName(here)
        level *= 2
    empty = spark.createDataFrame([], "doc_id long, longest long")
    return (out if out is not None else empty).groupBy("doc_id").agg(F.max("longest").alias("longest"))


def _level_windows(level: int, base: bool):
    """Candidate windows of a level: by their anchors at the base, by both halves above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            if base:
                found = ((row, places, k1, k2) for row, _, _, places, k1, k2 in _candidates(batch, level, rollers))
            else:
                found = _halves(batch, level, rollers)
            for row, at, k1, k2 in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), int(ids[row]))), pa.array(to_signed(k1[at])), pa.array(to_signed(k2[at]))],
                    ["doc_id", "k1", "k2"],
                )

    return _coalesced(run, ("doc_id", "k1", "k2"))


def _halves(batch: pa.RecordBatch, level: int, rollers):
    lists, half = batch.column("anchors"), level // 2
    for t in text_slices(batch.column("text")):
        w = Windows(t, rollers)
        below, (k1, k2) = to_signed(w.keys(half)[0]), w.keys(level)
        for i in range(len(t)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            stop = max(a, b - level + 1)
            known = np.isin(below[a : stop + half], lists[t.lo + i].values.to_numpy(zero_copy_only=False))
            both = known[: stop - a] & known[half : half + stop - a]
            yield t.lo + i, np.flatnonzero(both), k1[a:stop], k2[a:stop]
