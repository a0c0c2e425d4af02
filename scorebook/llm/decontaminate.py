"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, scanning each text once.

Texts and items are normalised alike (A-Z lowered; words are runs of digits, a-z and bytes of non-ASCII letters and
signs; one space between words). Every window of ``window`` consecutive item words is a pattern (an item of fewer
words is one window); patterns and text carry a space at both ends, so matches fall on whole words. The automaton
walks a text once and reports the end of each match; word numbers are mapped back to byte offsets of the original.

The benchmark's size is measured first. Up to ``shard_bytes`` of item text make one automaton. A larger benchmark is
cut into several, and a task takes a slab of texts through one automaton after the other, so that it holds one of them
at a time and the texts are read once. The item texts are broadcast, ``broadcast_bytes`` at most; only a benchmark
beyond that takes the texts through again for each further part.

Defined results: null or empty texts have no words and no hit; null or empty items, or items of null id, are never
found; items of equal text are all reported; repeated document rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carrying, leased, materialise, process_cache, text_slices, uncarried, word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True
#: Lowers A-Z and turns every other byte that is not of a word into a space.
NORMAL = bytes(int(_LOWER[b]) if _INSIDE[_LOWER[b]] else 32 for b in range(256))

HITS = "lo: int, hi: int"
FOUND = ("n_words", "ranges", "items")


@dataclass(frozen=True)
class DecontaminateConfig:
    window: int = 10
    shard_bytes: int = 1 << 20  #: item text that one automaton holds, about; a sign of it takes some 400 bytes there
    broadcast_bytes: int = 256 << 20  #: item text that is broadcast at once
    slab_bytes: int = 64 << 20  #: texts that a task holds while it goes through several automata


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def item_windows(items: list[tuple[str, str]], window: int) -> dict[str, list[str]]:
    """Pattern (latin-1 view of the bytes, a space at both ends) -> ids of the items that have it."""
    out: dict[str, set[str]] = {}
    for item_id, text in items:
        words = normal_words(text.encode("utf-8"))
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            out.setdefault((b" " + b" ".join(words[i : i + window]) + b" ").decode("latin-1"), set()).add(item_id)
    return {p: sorted(ids) for p, ids in sorted(out.items())}


def build_automaton(patterns: dict[str, list[str]]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for k, p in enumerate(patterns):
        automaton.add_word(p, (p.count(" ") - 1, k))
    automaton.make_automaton()
    return automaton


def scan(automaton, raw: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
    """(number of words, merged word ranges [lo, hi) inside matches, pattern numbers) of one text."""
    words = normal_words(raw)
    if not words or not len(automaton):
        return len(words), [], set()
    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
    ends, sizes, found = [], [], set()
    for at, (n, k) in automaton.iter(text):
        ends.append(at)
        sizes.append(n)
        found.add(k)
    if not ends:
        return len(words), [], found
    space_after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    hi = np.searchsorted(space_after, np.array(ends)) + 1
    return len(words), merge_ranges(zip((hi - np.array(sizes)).tolist(), hi.tolist())), found


def merge_ranges(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def byte_ranges(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as (start, length) in bytes of the original text."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _INSIDE[_LOWER[data]])
    return [(int(starts[lo]), int(ends[hi - 1] - starts[lo])) for lo, hi in ranges]


def _scan_batches(shards: list, window: int, slab_bytes: int):
    """Task over texts with what was found so far; ``shards`` are broadcast lists of (item_id, text)."""

    def scanned(batches: list[pa.RecordBatch], shard, key: str) -> list[pa.RecordBatch]:
        cache = process_cache("automaton")
        if cache.get("key") != key:
            cache.clear()
            patterns = item_windows(shard.value, window)
            cache.update(key=key, automaton=build_automaton(patterns), owners=list(patterns.values()))
        automaton, owners, out = cache["automaton"], cache["owners"], []
        for batch in batches:
            given = [c for c in batch.schema.names if c not in FOUND]
            old_ranges, old_items = batch.column("ranges").to_pylist(), batch.column("items").to_pylist()
            n_words, ranges, items = [], [], []
            for t in text_slices(batch.column("text")):
                for i in range(len(t)):
                    n, r, found = scan(automaton, t.raw(i))
                    k = len(n_words)
                    n_words.append(n)
                    if old_ranges[k]:
                        r = merge_ranges([*r, *((x["lo"], x["hi"]) for x in old_ranges[k])])
                    ranges.append([{"lo": lo, "hi": hi} for lo, hi in r])
                    items.append(sorted({x for f in found for x in owners[f]} | set(old_items[k] or ())))
            out.append(pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in given), pa.array(n_words, pa.int64()),
                 pa.array(ranges, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), pa.array(items, pa.list_(pa.string()))],
                [*given, *FOUND],
            ))
        return out

    names = [f"{s.id}:{k}" for k, s in enumerate(shards)]  # a broadcast's id names its automaton in the worker's cache

    def through(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        for shard, key in zip(shards, names):
            batches = scanned(batches, shard, key)
        return batches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if len(shards) == 1 or size >= slab_bytes:
                yield from through(held)
                held, size = [], 0
        if held:
            yield from through(held)

    return run


class _Shard:
    """A broadcast list with its id, which tasks can see."""

    def __init__(self, spark: SparkSession, items: list[tuple[str, str]]):
        self.held, self.id = spark.sparkContext.broadcast(items), hashlib.sha256(repr(items).encode()).hexdigest()

    @property
    def value(self):
        return self.held.value


def contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, cfg: DecontaminateConfig = DecontaminateConfig(),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, text, carried columns, n_words, ranges of hit words, ids of the found items) of every row of (doc_id, text)."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // cfg.broadcast_bytes))
    shards = max(1, -(-total // (parts * cfg.shard_bytes)))
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *carry, F.lit(0).cast("long").alias("n_words"),
        F.array().cast(f"array<struct<{HITS}>>").alias("ranges"), F.array().cast("array<string>").alias("items"),
    )
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts * shards))
    for k in range(parts):
        part = items.where(F.pmod(place, F.lit(parts)) == k).select(F.floor(place / parts).alias("shard"), "item_id", "text")
        held: dict[int, list[tuple[str, str]]] = {}
        for r in part.orderBy("item_id", "text").collect():
            held.setdefault(r.shard, []).append((r.item_id, r.text))
        sent = [_Shard(spark, held[s]) for s in sorted(held)] or [_Shard(spark, [])]
        out = out.mapInArrow(_scan_batches(sent, cfg.window, cfg.slab_bytes), out.schema)
        if k + 1 < parts:
            out = materialise(spark, out, "contamination")
    return out


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, cfg: DecontaminateConfig = DecontaminateConfig()) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of a benchmark item occurs."""
    found = contamination(spark, carrying(docs), benchmark, cfg, ("carry",))
    return uncarried(found.where(F.size("ranges") == 0), docs.columns)


def spans(found: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<start, length>>): the hit ranges of ``contamination`` as bytes of the original text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                pairs = byte_ranges((text or "").encode("utf-8"), [(r["lo"], r["hi"]) for r in ranges]) if ranges else []
                out.append([{"start": a, "length": b} for a, b in pairs])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    return found.select("doc_id", "text", "ranges").mapInArrow(leased("text", run), "doc_id long, spans array<struct<start:long,length:long>>")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``."""
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + (r["hi"] - r["lo"]).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
