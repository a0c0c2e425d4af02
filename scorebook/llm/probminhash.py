"""Near-duplicate documents by ProbMinHash: weighted shingles, banding, verification, connected groups.

A document is the multiset of its five-word shingles (A-Z lowered; fewer words make one shingle), the weights are the
multiplicities. Each shingle emits a Poisson process of rate weight (exponential gaps from its own hash); each arrival
falls on one of ``registers`` registers, and a register keeps its earliest arrival's shingle. A shingle stops as soon
as its next arrival is later than the latest register, so most emit once. Two registers agree with the probability
Jaccard of the two documents: the sum over common d of 1 / sum_e max(a_e / a_d, b_e / b_d), plain Jaccard for weights 0
and 1. Equal documents are joined by a 128-bit digest first; only one of each class goes on. Classes that agree in a
whole band of registers are candidates, and candidates are verified on the exact probability Jaccard.

Large buckets are not expanded into pairs. First each bucket's members are verified against one leader, the member
with the most company over all bands. Links give components; then pairs of a bucket that lie in different components
and agree in enough registers are verified inside tasks, in pairs of chunks of bounded size: the documents concerned
travel with their shingles, and only links that join components come back. Documents in one component need no further
link, so the groups equal those of all candidate pairs.

Defined results: null and empty texts (no words) are groups of their own; rows with a null doc_id get no group and are
kept; rows that share a doc_id are one document; ties go to the smallest doc_id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.operators.ranks import range_partitions, range_ranks

from .common import Roller, Texts, leased, materialise, mix, sorted_groups, space_words, text_slices, to_signed
from .components import connected_components

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class MinHashConfig:
    words: int = 5
    similarity: float = 0.8
    bands: int = 20
    rows: int = 4
    slack: float = 4.0  #: standard deviations below ``similarity`` at which register agreement rules a pair out
    block: int = 256  #: documents of a bucket compared at once

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        s = self.similarity
        return int(np.ceil(self.registers * s - self.slack * np.sqrt(self.registers * s * (1 - s))))


# ---------------------------------------------------------------- shingles and sketches


def weighted_shingles(texts: Texts, roller: Roller, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, multiplicity), sorted by text and hash."""
    low = _LOWER[texts.data]
    starts, ends, first = space_words(texts)
    words = roller.spans(low, starts, ends)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n)
    whole = roller.windows(words, size)
    at = np.arange(len(whole))
    inside = at + size <= first[1:][owner[: len(whole)]] if len(whole) else np.zeros(0, bool)
    docs, hashes = [owner[: len(whole)][inside]], [whole[inside]]
    for short in range(1, size):
        few = np.flatnonzero(n == short)
        if len(few):
            docs.append(few)
            hashes.append(roller.windows(words, short)[first[few]])
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    fresh = np.ones(len(d), dtype=bool)
    fresh[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    place = np.flatnonzero(fresh)
    return d[place], h[place], np.diff(np.append(place, len(d)))


def registers(n_docs: int, doc: np.ndarray, item: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
    """(n_docs, m) shingle hashes of the registers; every document needs at least one shingle."""
    best = np.full(n_docs * m, np.inf)
    holder = np.zeros(n_docs * m, np.uint64)
    x = np.zeros(len(doc))
    live = np.arange(len(doc))
    turn = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(live):
            turn += np.uint64(1)
            draw = mix(item[live] + turn * _GOLD)
            u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            x[live] -= np.log(u) / weight[live]
            cell = doc[live] * m + (mix(draw + _GOLD) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, cell, x[live])
            won = x[live] == best[cell]
            holder[cell[won]] = item[live[won]]
            latest = best.reshape(n_docs, m).max(axis=1)
            live = live[x[live] < latest[doc[live]]]
    return holder.reshape(n_docs, m)


def sketch(docs: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """(doc_id, h1, h2, bands array<long>, prints binary); bands and prints are null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(303)
        names = ["doc_id", "h1", "h2", "bands", "prints"]
        for batch in batches:
            for t in text_slices(batch.column("text")):
                n = len(t)
                doc, item, weight = weighted_shingles(t, roller, cfg.words)
                have, compact = np.unique(doc, return_inverse=True)
                holder = registers(len(have), compact, item, weight, cfg.registers)
                keys = np.zeros((len(have), cfg.bands), np.uint64)
                with np.errstate(over="ignore"):
                    for b in range(cfg.bands):
                        k = np.full(len(have), np.uint64(b + 1) * _GOLD)
                        for r in range(cfg.rows):
                            k = mix(k ^ holder[:, b * cfg.rows + r]) + np.uint64(r + 1)
                        keys[:, b] = k
                prints = (mix(holder) >> np.uint64(56)).astype(np.uint8)
                bands: list = [None] * n
                marks: list = [None] * n
                for j, i in enumerate(have.tolist()):
                    bands[i], marks[i] = to_signed(keys[j]), prints[j].tobytes()
                digests = b"".join(hashlib.blake2b(b" ".join(t.raw(i).lower().split()), digest_size=16).digest() for i in range(n))
                h = np.frombuffer(digests, np.int64).reshape(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(t.lo, n), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())], names)

    schema = "doc_id long, h1 long, h2 long, bands array<long>, prints binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(leased("text", run), schema)


def shingle_table(docs: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """(doc_id, items binary, weights binary): sorted uint64 shingles; weights (uint32) are empty when all are 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(303)
        for batch in batches:
            for t in text_slices(batch.column("text")):
                doc, item, weight = weighted_shingles(t, roller, cfg.words)
                edge = np.searchsorted(doc, np.arange(len(t) + 1))
                items = [item[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
                weights = [b"" if (weight[a:b] == 1).all() else weight[a:b].astype(np.uint32).tobytes() for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(t.lo, len(t)), pa.array(items, pa.binary()), pa.array(weights, pa.binary())],
                    ["doc_id", "items", "weights"])

    return docs.select("doc_id", "text").mapInArrow(leased("text", run), "doc_id long, items binary, weights binary")


def probability_jaccard(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray) -> float:
    """Of two weighted sets: sorted distinct items x, y with positive weights a, b."""
    if not len(x) or not len(y):
        return 0.0
    common, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    ca, cb = a[ix].astype(float), b[iy].astype(float)
    only_a, only_b = float(a.sum() - ca.sum()), float(b.sum() - cb.sum())
    if (a == 1).all() and (b == 1).all():
        return len(common) / (len(x) + len(y) - len(common))
    ratio = cb / ca
    order = np.argsort(ratio, kind="stable")
    ra, below = ratio[order], np.concatenate([[0.0], np.cumsum(ca[order])])
    above = float(cb.sum()) - np.concatenate([[0.0], np.cumsum(cb[order])])
    # sum_e max(a_e, b_e / t) for t = ratio of d: items of ratio <= t count a_e, the others b_e / t
    cut = np.searchsorted(ra, ratio, side="right")
    total = below[cut] + only_a + (above[cut] + only_b) / ratio
    return float((ca / total).sum())


# ---------------------------------------------------------------- links


def verified(pairs: DataFrame, shingles: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """(u, v, similarity) of the distinct pairs (u, v) whose probability Jaccard reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpack(items, weights):
            x = np.frombuffer(items, np.uint64)
            return x, np.frombuffer(weights, np.uint32) if weights else np.ones(len(x), np.uint32)

        for batch in batches:
            cols = {c: batch.column(c) for c in ("xi", "xw", "yi", "yw")}
            sim = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                x, a = unpack(cols["xi"][i].as_py(), cols["xw"][i].as_py())
                y, b = unpack(cols["yi"][i].as_py(), cols["yw"][i].as_py())
                if min(len(x), len(y)):
                    sim[i] = probability_jaccard(x, a, y, b)
            hit = np.flatnonzero(sim >= cfg.similarity - 1e-12)
            yield pa.RecordBatch.from_arrays(
                [batch.column("u").take(pa.array(hit)), batch.column("v").take(pa.array(hit)), pa.array(sim[hit])],
                ["u", "v", "similarity"])

    left = shingles.select(F.col("doc_id").alias("u"), F.col("items").alias("xi"), F.col("weights").alias("xw"))
    right = shingles.select(F.col("doc_id").alias("v"), F.col("items").alias("yi"), F.col("weights").alias("yw"))
    return pairs.select("u", "v").join(right, "v").join(left, "u").mapInArrow(leased("text", run), "u long, v long, similarity double")


def chunk_pairs(rows: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """Deals each bucket's documents into chunks of about ``block`` and each pair of chunks (lo, hi) that may hold
    unlinked documents to one group. The documents of the bucket's largest component have chunks of their own, which
    meet the chunks of all others but not each other: a million linked copies and one stranger are a row each, twice.

    ``rows``: (key, band, doc_id, comp, prints, bands, n) with n the bucket's size.
    """
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("m"))
    large = parts.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("large")).select(
        "key", F.col("large.comp").alias("main"), F.col("large.m").alias("main_size"))
    mains = F.ceil(F.col("main_size") / cfg.block).cast("int")
    others = F.ceil((F.col("n") - F.col("main_size")) / cfg.block).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    dealt = rows.join(large, "key").withColumn("mains", mains).withColumn("others", others).where("others > 0")
    dealt = dealt.withColumn("linked", F.col("comp") == F.col("main")).withColumn(
        "own", F.when(F.col("linked"), spot(F.col("mains"))).otherwise(F.col("mains") + spot(F.col("others"))))
    start = F.when(F.col("linked"), F.col("mains")).otherwise(0)
    return dealt.withColumn("other", F.explode(F.sequence(start, F.col("mains") + F.col("others") - 1))).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "band", "own", "doc_id", "comp", "prints", "bands"
    )


def _agreeing(prints: np.ndarray, i: int, j: np.ndarray, least: int) -> np.ndarray:
    return (prints[j] == prints[i]).sum(axis=1) >= least


def hopeful(dealt: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """(key, lo, hi, own, doc_id, comp, prints): documents of a group with a partner that may be near and is not yet linked.

    A pair is looked at in its first common band only. Documents leave, not pairs, so the result grows with the
    group's size and not with its square.
    """
    least, width = cfg.least_agreement, cfg.registers
    names = ["key", "lo", "hi", "own", "doc_id", "comp", "prints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ("key", "lo", "hi")):
            t = t.combine_chunks()
            comp, own = t.column("comp").to_numpy(), t.column("own").to_numpy()
            if len(comp) < 2 or (comp == comp[0]).all():
                continue
            cross = t.column("lo")[0] != t.column("hi")[0]
            p = np.frombuffer(b"".join(t.column("prints").to_pylist()), np.uint8).reshape(-1, width)
            earlier = np.array(t.column("bands").to_pylist(), np.int64)[:, : t.column("band")[0].as_py()]
            flag = np.zeros(len(comp), dtype=bool)
            for i in range(len(comp) - 1):
                j = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
                if cross:
                    j = j[own[j] != own[i]]
                j = j[_agreeing(p, i, j, least)]
                j = j[~(earlier[j] == earlier[i]).any(axis=1)]
                if len(j):
                    flag[i] = True
                    flag[j] = True
            if flag.any():
                yield from t.filter(pa.array(flag)).select(names).combine_chunks().to_batches()

    spread = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "doc_id")
    kinds = "key long, lo int, hi int, own int, doc_id long, comp long, prints binary"
    return spread.mapInArrow(leased("text", run), kinds)


def common_counts(items: list[np.ndarray], tile: int = 4096) -> np.ndarray:
    """Number of common items of all pairs of sets, by products of membership tiles."""
    n = len(items)
    owner = np.repeat(np.arange(n), [len(x) for x in items])
    _, code, times = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(times), -1)
    rank[shared] = np.arange(len(shared))
    column = rank[code]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float32)
    for a in range(0, len(shared), tile):
        i, j = np.searchsorted(column, [a, a + tile])
        member = np.zeros((n, min(tile, len(shared) - a)), np.float32)
        member[owner[i:j], column[i:j] - a] = 1
        total += member @ member.T
    return total


def spanning_links(near: np.ndarray, similarity: np.ndarray) -> list[tuple[int, int, float]]:
    """Links (i, j, similarity) that keep the components of a symmetric relation: one per member but the first."""
    out, left = [], np.ones(len(near), dtype=bool)
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            i = front.pop()
            new = np.flatnonzero(near[i] & left)
            left[new] = False
            out.extend((i, int(j), float(similarity[i, j])) for j in new)
            front.extend(new.tolist())
    return out


def group_links(rows: DataFrame, shingles: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """(u, v, similarity): verified links that join the components of each group's documents.

    All pairs of a group's documents are verified on their exact shingles, in the task; of the links found, one per
    document joined leaves it.
    """
    least, width, limit = cfg.least_agreement, cfg.registers, cfg.similarity - 1e-12

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ("key", "lo", "hi")):
            t = t.combine_chunks()
            doc, comp = t.column("doc_id").to_numpy(), t.column("comp").to_numpy()
            items = [np.frombuffer(x, np.uint64) for x in t.column("items").to_pylist()]
            weights = [np.frombuffer(x, np.uint32) if x else None for x in t.column("weights").to_pylist()]
            size = np.array([len(x) for x in items], np.float64)
            both = common_counts(items)
            sim = both / (size[:, None] + size[None, :] - both)
            heavy = np.array([w is not None for w in weights])
            p = np.frombuffer(b"".join(t.column("prints").to_pylist()), np.uint8).reshape(-1, width)
            weights = [np.ones(len(x), np.uint32) if w is None else w for x, w in zip(items, weights)]
            for i in range(len(doc) - 1):  # multiplicities need the exact sum, pair by pair
                j = np.arange(i + 1, len(doc))
                j = j[(heavy[j] | heavy[i]) & (comp[j] != comp[i])]
                sim[i, j] = sim[j, i] = 0.0
                for k in j[_agreeing(p, i, j, least)]:
                    sim[i, k] = sim[k, i] = probability_jaccard(items[i], weights[i], items[k], weights[k])
            near = (sim >= limit) & (comp[:, None] != comp[None, :])
            links = spanning_links(near, sim)
            u, v = [min(doc[i], doc[j]) for i, j, _ in links], [max(doc[i], doc[j]) for i, j, _ in links]
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array([s for _, _, s in links], pa.float64())], ["u", "v", "similarity"])

    sets = rows.join(shingles, "doc_id").select("key", "lo", "hi", "doc_id", "comp", "prints", "items", "weights")
    spread = sets.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "doc_id")
    return spread.mapInArrow(leased("text", run), "u long, v long, similarity double").dropDuplicates(["u", "v"])


@dataclass
class NearDuplicates:
    documents: DataFrame  #: doc_id, class_id (least doc_id of equal texts), group_id, kept
    links: DataFrame  #: u, v, similarity between class representatives


def near_duplicates(spark: SparkSession, docs: DataFrame, cfg: MinHashConfig = MinHashConfig()) -> NearDuplicates:
    """Groups of (doc_id, text): see the module text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sk = materialise(spark, sketch(texts, cfg), "sketch")
    named = sk.where("doc_id is not null and bands is not null")
    classes = materialise(spark, named.groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id")), "classes")
    reps = named.join(classes.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    reps = reps.select("doc_id", "bands", "prints")
    rows = reps.select("doc_id", F.posexplode("bands").alias("band", "key")).distinct()
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialise(spark, rows.join(sizes, "key"), "buckets")

    company = buckets.join(buckets.groupBy("doc_id").agg(F.sum("n").alias("company")), "doc_id")
    lead = company.groupBy("key").agg(F.max(F.struct("company", (-F.col("doc_id")).alias("d"))).alias("m"))
    star = buckets.join(lead.select("key", (-F.col("m.d")).alias("leader")), "key").where("doc_id <> leader")
    star = materialise(spark, star.select(F.col("leader").alias("u"), F.col("doc_id").alias("v")).distinct(), "star")

    # The ids in buckets grow with the corpus: never broadcast them, whatever their size is estimated at.
    needed = buckets.select("doc_id").distinct().hint("merge")
    shingles = materialise(spark, shingle_table(texts.where("doc_id is not null").join(needed, "doc_id"), cfg), "shingles")
    links = materialise(spark, verified(star, shingles, cfg), "star-links")
    comps = materialise(spark, connected_components(spark, links), "components")

    tagged = buckets.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    tagged = tagged.withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    mixed = tagged.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
    rest = tagged.join(mixed, "key", "left_semi").join(reps.dropDuplicates(["doc_id"]), "doc_id")
    hopes = materialise(spark, hopeful(chunk_pairs(rest, cfg), cfg), "hopeful")
    more = materialise(spark, group_links(hopes, shingles, cfg), "more-links")

    joined = comps.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more.select("u", "v"))
    groups = connected_components(spark, joined)
    membership = classes.join(groups.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "h1", "h2", "class_id", F.coalesce("component", "class_id").alias("group_id")
    )
    worded = sk.where("bands is not null").join(membership, ["h1", "h2"], "left").select("doc_id", "class_id", "group_id")
    bare = sk.where("bands is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("group_id"))
    out = worded.unionByName(bare).select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("group_id")).alias("group_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("group_id"), F.lit(True)))
    return NearDuplicates(out, links.unionByName(more))


def deduplicated(spark: SparkSession, docs: DataFrame, cfg: MinHashConfig = MinHashConfig()) -> DataFrame:
    """The rows of ``docs``, all columns, of the first document of each near-duplicate group.

    A document is a doc_id and a text; documents stand in order of doc_id, those of one doc_id in order of the md5 of their
    texts, so a text is never judged by another one that shares its id. Of rows that repeat a document, the one whose
    other columns are least as JSON stays. Rows with a null doc_id all stay.
    """
    digest = F.md5(F.coalesce("text", F.lit("\x00null")).cast("binary"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn("__digest", digest).where("doc_id is not null")
    facts = materialise(spark, keyed.groupBy("doc_id", "__digest").agg(F.count("*").alias("n")), "dedup-ids")
    per_id = facts.groupBy("doc_id").agg(F.count("*").alias("texts"), F.sum("n").alias("n"), F.max("n").alias("copies"))
    size = per_id.agg(F.max("texts").alias("texts"), F.max("copies").alias("copies"), F.sum("texts").alias("documents")).first()
    if (size.texts or 0) <= 1:
        keyed = keyed.withColumn("__node", F.col("doc_id").cast("long"))
    else:
        ranks = range_ranks(facts.select("doc_id", "__digest"), ["doc_id", "__digest"], partitions=range_partitions(size.documents))
        nodes = materialise(spark, ranks.select("doc_id", "__digest", F.col("rank").alias("__node")), "dedup-nodes")
        keyed = materialise(spark, keyed.join(nodes.hint("merge"), ["doc_id", "__digest"]), "dedup-documents")
    found = near_duplicates(spark, keyed.select(F.col("__node").alias("doc_id"), "text"), cfg).documents
    gone = found.where("not kept").select(F.col("doc_id").alias("__node")).distinct()
    first = keyed.join(gone, "__node", "left_anti")
    if (size.copies or 0) > 1:
        rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
        order = F.to_json(F.struct(*rest, F.lit(0).alias("__"))) if rest else F.lit("")
        once = first.groupBy("doc_id", "__digest").agg(F.min_by(F.struct(*columns), order).alias("__row"))
        first = once.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
    return first.select(*columns).unionByName(docs.where("doc_id is null"))
