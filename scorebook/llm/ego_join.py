"""Embedding near-duplicates by an epsilon grid order join.

Vectors of cosine >= c lie within eps = sqrt(2 - 2c) of each other once scaled to length 1. They are rotated to their
principal axes, given grid cells of side eps on the leading axes, and sorted by cell, lexicographically: the grid
order. The sequence is cut into intervals of ``block`` vectors, with a bounding box each; a tree of intervals is
descended level by level, from pairs of large intervals to pairs of their parts, and a pair goes on only if its boxes
are within eps. The pairs of blocks that remain are dealt to a square grid of tiles, ``width`` consecutive blocks on each
side, so that a block travels once to each tile of its row and column, not once to each of its pairs: of n blocks,
about sqrt(n) times each while a tile's vectors stay below ``tile_bytes``. In a tile the recursion goes on in memory,
pair by pair, down to ``leaf`` vectors, and the surviving leaves are compared exactly, in double precision on the given
components.

No pair of vectors leaves a tile: each block pair returns, per vector with a link there, its number of links and one
representative of its component there; sums and connected components finish the job. Equal vectors are collapsed
first (a vector repeated any number of times is one row with a count) and counted back.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; shorter
vectors count as padded with zeros; rows with a null vec_id are returned with no links and a null component; rows that
share a vec_id and are equal count as linked copies; if they differ, they share one entry. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, sorted_groups
from .components import connected_components


@dataclass(frozen=True)
class EgoConfig:
    cosine: float = 0.95
    axes: int = 8  #: leading principal axes with grid cells
    box_axes: int = 16  #: leading principal axes of the bounding boxes
    block: int = 2048  #: vectors of an interval that travels as one row
    leaf: int = 256  #: vectors compared at once
    fan: int = 8  #: parts of an interval one level below
    tile_bytes: int = 128 << 20  #: vectors (in double precision) that meet in one tile
    tasks: int = 4096  #: bound of the tasks that tiles are dealt to

    @property
    def eps(self) -> float:
        return float(np.sqrt(2.0 - 2.0 * self.cosine))


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) of a list column without nulls, shorter lists padded with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(offsets)
    out = np.zeros((len(size), dim))
    if len(size) and (size == dim).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, dim)
    for i, (a, n) in enumerate(zip(offsets[:-1], size)):
        out[i, :n] = flat[a : a + n]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that can link."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))
    )


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """(dim, dim) orthonormal axes, by falling variance, from one sum of products over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = unit(rows_of(batch.column("v"), dim))
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["cell", "s"])

    rows = classes.select("v").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((dim + 1) ** 2)
    for r in rows:
        total[r.cell] = r.s
    total = total.reshape(dim + 1, dim + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[:-1, -1] / n
    _, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return axes[:, ::-1].copy()


def grid_order(classes: DataFrame, axes: np.ndarray, cfg: EgoConfig) -> DataFrame:
    """(vec_id, copies, v, y, c0, c1, ...): leading coordinates and grid cells."""
    dim, k, boxed, eps = axes.shape[0], min(cfg.axes, axes.shape[0]), min(cfg.box_axes, axes.shape[0]), cfg.eps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = unit(rows_of(batch.column("v"), dim)) @ axes[:, :boxed]
            cells = np.floor(y[:, :k] / eps).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(y) + 1) * boxed).astype(np.int32)), pa.array(y.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("copies"), batch.column("v"), lists, *(pa.array(cells[:, j].copy()) for j in range(k))],
                ["vec_id", "copies", "v", "y", *(f"c{j}" for j in range(k))])

    cols = "".join(f", c{j} int" for j in range(k))
    return classes.select("vec_id", "copies", "v").mapInArrow(run, f"vec_id long, copies long, v array<double>, y array<double>{cols}")


def sequence_blocks(spark: SparkSession, ordered: DataFrame, dim: int, cfg: EgoConfig) -> DataFrame:
    """(block, lo, hi, n, ids, copies, data): consecutive intervals of the grid order, one row each."""
    cells = sorted((c for c in ordered.columns if c[0] == "c" and c[1:].isdigit()), key=lambda c: int(c[1:]))
    order = [*cells, "vec_id"]
    placed = materialise(
        spark,
        ordered.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("vec_id", "copies", "v", "y", F.monotonically_increasing_id().alias("at")),
        "grid-order",
    )
    part = F.shiftright("at", 33)
    counts = {r.p: r.n for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # a row a partition
    before, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, before))
        before += counts[p]
    table = spark.createDataFrame(offsets, "p long, before long")
    ranked = placed.withColumn("p", part).join(F.broadcast(table), "p").select(
        (F.expr("before + at - shiftleft(p, 33)")).alias("rank"), "vec_id", "copies", "v", "y"
    ).withColumn("block", F.expr(f"rank div {cfg.block}"))
    names = ["block", "lo", "hi", "n", "ids", "copies", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def one(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            x, y = rows_of(t.column("v").chunk(0), dim), np.array(t.column("y").to_pylist())
            narrow = x.astype(np.float32)
            data = narrow.tobytes() if (narrow == x).all() else x.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([t.column("block")[0].as_py()], pa.int64()), pa.array([y.min(axis=0).tolist()]), pa.array([y.max(axis=0).tolist()]),
                 pa.array([t.num_rows], pa.int64()), pa.array([t.column("vec_id").to_numpy().tobytes()], pa.binary()),
                 pa.array([t.column("copies").to_numpy().tobytes()], pa.binary()), pa.array([data], pa.binary())], names)

        for batch in batches:  # sorted by block; a block may go on in the next batch
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for a, b in zip(edges[:-1], edges[1:]):
                piece = batch.slice(a, b - a)
                if held and b > a and held[0].column("block")[0].as_py() != block[a]:
                    yield one(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(piece)
        if held:
            yield one(pa.Table.from_batches(held))

    schema = "block long, lo array<double>, hi array<double>, n long, ids binary, copies binary, data binary"
    return materialise(spark, ranked.repartition("block").sortWithinPartitions("block", "rank").mapInArrow(run, schema), "blocks")


def near_boxes(eps: float):
    """Whether the boxes (alo, ahi) and (blo, bhi) are within eps."""
    gaps = F.zip_with(
        F.zip_with("alo", "bhi", lambda a, b: a - b), F.zip_with("blo", "ahi", lambda a, b: a - b),
        lambda p, q: F.pow(F.greatest(p, q, F.lit(0.0)), 2),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x) <= (eps + 1e-9) ** 2


def block_pairs(blocks: DataFrame, cfg: EgoConfig) -> DataFrame:
    """(a, b), a <= b: pairs of blocks that may hold links, by descent through the tree of intervals."""
    boxes = blocks.select("block", "lo", "hi")
    top = boxes.agg(F.max("block")).first()[0]
    levels = 1
    while cfg.fan**levels <= (top or 0):
        levels += 1
    width = len(blocks.select("lo").first()[0])

    def nodes(level: int) -> DataFrame:
        side = cfg.fan**level
        if level == 0:
            return boxes.select(F.col("block").alias("node"), "lo", "hi")
        return boxes.groupBy(F.expr(f"block div {side}").alias("node")).agg(
            F.array(*(F.min(F.col("lo")[i]) for i in range(width))).alias("lo"),
            F.array(*(F.max(F.col("hi")[i]) for i in range(width))).alias("hi"),
        )

    pairs = nodes(levels).select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in range(levels - 1, -1, -1):
        below = nodes(level).withColumn("up", F.expr(f"node div {cfg.fan}"))
        left = below.select(F.col("up").alias("a"), F.col("node").alias("na"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        right = below.select(F.col("up").alias("b"), F.col("node").alias("nb"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        pairs = pairs.join(left, "a").join(right, "b").where("na <= nb").where(near_boxes(cfg.eps)).select(
            F.col("na").alias("a"), F.col("nb").alias("b")
        )
    return pairs


def box_gap(a: np.ndarray, b: np.ndarray) -> float:
    gap = np.maximum(0.0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(np.sqrt((gap * gap).sum()))


def recursive_join(
    x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, same: bool, cosine: float, leaf: int, eps: float
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of two sequence intervals with cosine >= the threshold; i < j if they are the same interval.

    x, y: unit vectors; px, py: the same on the principal axes, for the boxes.
    """
    out = []
    stack = [(0, len(x), 0, len(y))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if a0 >= a1 or b0 >= b1 or (same and b1 <= a0 + 1):
            continue
        if not (same and a0 == b0) and box_gap(px[a0:a1], py[b0:b1]) > eps + 1e-9:
            continue
        if a1 - a0 <= leaf and b1 - b0 <= leaf:
            i, j = np.nonzero(x[a0:a1] @ y[b0:b1].T >= cosine)
            if same:
                ok = i + a0 < j + b0
                i, j = i[ok], j[ok]
            if len(i):
                out.append((i + a0, j + b0))
            continue
        am, bm = (a0 + a1) // 2 if a1 - a0 > leaf else a1, (b0 + b1) // 2 if b1 - b0 > leaf else b1
        stack += [(p, q, r, s) for p, q in ((a0, am), (am, a1)) for r, s in ((b0, bm), (bm, b1))
                  if not (same and (a0, a1) == (b0, b1) and r < p)]
    return out


def smallest_labels(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each node's component under the links (i, j)."""
    label = ids.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            return label
        label = new


def tile_width(n_blocks: int, dim: int, cfg: EgoConfig) -> int:
    """Blocks on each side of a tile: the square root of all, or what ``tile_bytes`` can hold."""
    held = cfg.tile_bytes // (2 * 8 * cfg.block * dim)
    return max(1, min(isqrt(n_blocks), held))


def tile_members(pairs: DataFrame, width: int) -> DataFrame:
    """(tile, block, partners): the blocks of each tile, and those (of a number >= its own) that it is compared with there."""
    ta, tb = F.expr(f"a div {width}"), F.expr(f"b div {width}")
    tile = F.expr("tb * (tb + 1) div 2 + ta").alias("tile")  # the triangle ta <= tb, numbered without gaps
    sides = F.array(F.struct(F.col("a").alias("block"), F.col("b").alias("partner")), F.struct(F.col("b").alias("block"), F.lit(None).cast("long").alias("partner")))
    ends = pairs.withColumn("ta", ta).withColumn("tb", tb).select(tile, F.explode(sides).alias("end"))
    return ends.groupBy("tile", F.col("end.block").alias("block")).agg(F.sort_array(F.collect_set("end.partner")).alias("partners"))


def join_blocks(spark: SparkSession, blocks: DataFrame, pairs: DataFrame, axes: np.ndarray, cfg: EgoConfig) -> DataFrame:
    """(vec_id, links, root): per block pair and vector with links there, their number and its component's least id."""
    dim = axes.shape[0]
    members = materialise(spark, tile_members(pairs, tile_width(blocks.count(), dim, cfg)), "tiles")
    tiles = members.agg(F.count_distinct("tile")).first()[0]
    tasks = max(1, min(tiles, cfg.tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpack(t: pa.Table, i: int):
            ids = np.frombuffer(t.column("ids")[i].as_py(), np.int64)
            copies = np.frombuffer(t.column("copies")[i].as_py(), np.int64)
            raw = t.column("data")[i].as_py()
            kind = np.float32 if len(raw) == 4 * dim * len(ids) else np.float64
            x = unit(np.frombuffer(raw, kind).reshape(len(ids), dim).astype(np.float64))
            return ids, copies, x, x @ axes[:, : cfg.box_axes]

        for t in sorted_groups(batches, ("tile",)):
            held = {block: unpack(t, i) for i, block in enumerate(t.column("block").to_pylist())}
            for a, partners in zip(t.column("block").to_pylist(), t.column("partners").to_pylist()):
                for b in partners:
                    same = a == b
                    ids, copies, x, px = held[a]
                    other, more, y, py = held[b]
                    hits = recursive_join(x, y, px, py, same, cfg.cosine, cfg.leaf, cfg.eps)
                    if not hits:
                        continue
                    p = np.concatenate([h[0] for h in hits])
                    q = np.concatenate([h[1] for h in hits]) + (0 if same else len(ids))
                    both = ids if same else np.concatenate([ids, other])
                    every = copies if same else np.concatenate([copies, more])
                    links = np.bincount(p, weights=every[q], minlength=len(both)) + np.bincount(q, weights=every[p], minlength=len(both))
                    have = np.flatnonzero(links)
                    root = smallest_labels(len(both), p, q, both)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(both[have]), pa.array(links[have].astype(np.int64)), pa.array(root[have])], ["vec_id", "links", "root"])

    dealt = members.join(blocks.select("block", "ids", "copies", "data"), "block").repartitionById(
        tasks, F.expr(f"int(tile % {tasks})")
    ).sortWithinPartitions("tile", "block")
    return dealt.select("tile", "block", "partners", "ids", "copies", "data").mapInArrow(run, "vec_id long, links long, root long")


def near_duplicates(spark: SparkSession, vectors: DataFrame, cfg: EgoConfig = EgoConfig()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    good = usable(vectors).withColumn("digest", F.md5(F.to_json("v")))
    classes = materialise(
        spark, good.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("v").alias("v")), "classes"
    )
    dim = classes.agg(F.max(F.size("v"))).first()[0]
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if not dim:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    axes = principal_axes(classes, dim)
    blocks = sequence_blocks(spark, grid_order(classes, axes, cfg), dim, cfg)
    found = materialise(spark, join_blocks(spark, blocks, block_pairs(blocks, cfg), axes, cfg), "links")
    groups = connected_components(spark, found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    named = (
        classes.select("digest", "vec_id", "copies").join(sums, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    linked = good.select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", "component_id")
    # Rows that cannot link keep themselves.
    v = F.col("embedding").cast("array<double>")
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNull() | F.col("v").isNull()
        | F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
        | ~F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
