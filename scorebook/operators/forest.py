"""Fit of the random forest (M5-M7) by level-wise histograms in numpy; the model is Spark's own.

``RandomForestClassifier`` writes the counts of a whole level (up to ``maxMemoryInMB`` a task) in random order, one
number at a time, for rows in and out of the bag, and keeps a bag count and a node id per row and tree as Java arrays: at a
hundred trees of depth 12 nearly all of its time is spent waiting for memory. This is the same algorithm (Poisson bags, a
random subset of the features per node, bins, level by level, best gain, sibling leaves of one class merged) over the
same rows, laid out for the cache:

* each column is binned once and kept as one or two bytes a row; the indicators of one text column, of which a row has at
  most one, are a single code, and the counts of "not this value" follow from the node's total;
* a pass per level takes one tree after the other through all rows of a partition. Bag counts are drawn again in every
  pass from (seed, tree, partition, block), and a row finds its node by going down the tree, so no state is kept a row;
* counts travel in the narrowest type that holds them, by (tree, chunk of nodes). The task that adds a chunk up also
  picks the best splits, so the driver sees one row per node only.

The grown trees are written in the format of Spark's saved models and loaded as a ``RandomForestClassificationModel``.
Code that runs inside tasks travels by value, so executors need numpy and pyarrow but no copy of this package.
"""

from __future__ import annotations

import json
import math
import sys
import time
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.session import scratch_path
from scorebook.sources.catalog import delete_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 17  # rows of a piece of a binned table
STEP_ROWS = 1 << 15  # rows that are taken down a tree at once, at least
ROWS_PER_TASK = 100_000  # fewer rows do not get a task of their own in a level's pass
FEW_VALUES = 10_000  # up to so many distinct values of a column are counted one by one for its bins
SKETCH_ACCURACY = 10_000
MAX_BINS = 4096  # bins of all columns; wider vectors go to Spark's trainer, which counts only each node's features
MAX_SCORED = 1024  # positions of rows that are scored here, as dense arrays; wider ones are scored by the model itself
MAX_CLASSES = 100  # as Spark's
CHUNK_CELLS = 1 << 16  # counts of the nodes that travel as one row
SLICE_CELLS = 1 << 23  # counts that a task holds at once
JOB_CELLS = 1 << 26  # counts of the trees that grow in one job
BLOCKS = "part int, block int, n int, labels binary, codes binary"


class Codes(NamedTuple):
    """A column of codes: a number's bin (``thresholds``), or 0 and 1 + place of a text column's value (``width``)."""

    start: int  # its first position in the vector
    thresholds: np.ndarray | None
    width: int

    @property
    def bins(self) -> int:
        return len(self.thresholds) + 1 if self.thresholds is not None else self.width + 1


class Plan(NamedTuple):
    """What the tasks need to know beside the trees."""

    columns: list[Codes]
    positions: int
    classes: int
    seed: int
    bootstrap: bool
    rate: float
    subset: int  # features per node
    impurity: str
    min_rows: int
    min_gain: float

    @property
    def cells(self) -> int:
        return sum(c.bins for c in self.columns) * self.classes

    @property
    def code_type(self) -> type:
        return np.uint8 if max(c.bins for c in self.columns) < 256 else np.uint16

    @property
    def chunk(self) -> int:
        return max(1, CHUNK_CELLS // self.cells)

    def candidates(self) -> tuple[np.ndarray, ...]:
        """(feature, column, lo, hi, threshold) of each possible split, in the order of ``left_counts``: a row goes right where
        lo < code <= hi, which is value > threshold."""
        most = np.iinfo(self.code_type).max
        out = []
        for i, c in enumerate(self.columns):
            if c.thresholds is not None:
                out += [(c.start, i, t, most, v) for t, v in enumerate(c.thresholds)]
            else:
                out += [(c.start + j, i, j, j + 1, 0.5) for j in range(c.width)]
        kinds = (np.int64, np.int64, self.code_type, self.code_type, np.float64)
        return tuple(np.array([o[k] for o in out], dtype=kind) for k, kind in enumerate(kinds))


# ---------------------------------------------------------------- bins

def stride_thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark's rule: between all neighbours where values are few, else where the running count is nearest to the next
    multiple of rows / bins."""
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= bins - 1:
        return between
    stride = counts.sum() / bins
    run, target, out = np.cumsum(counts), stride, []
    for i in range(1, len(values)):
        if abs(run[i - 1] - target) < abs(run[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out[:bins - 1])


def find_thresholds(vectors: DataFrame, features: str, numeric: int, rows: int, max_bins: int) -> list[np.ndarray]:
    """The thresholds of the first ``numeric`` positions, from all rows: by Spark's rule on exact counts where a column's values are
    few, and otherwise the quantiles of a sketch (a row equal to a threshold goes left)."""
    bins = min(max_bins, rows)
    values = vectors.select(vector_to_array(features).alias("x")).select(*[F.col("x")[i].alias(f"x{i}") for i in range(numeric)])
    few = list(range(numeric))
    found: dict[int, np.ndarray] = {}
    if rows > FEW_VALUES:
        steps = F.array(*[F.lit(k / bins) for k in range(1, bins)])
        facts = values.agg(*[x for i in few for x in (
            F.approx_count_distinct(f"x{i}", 0.02).alias(f"d{i}"), F.max(f"x{i}").alias(f"m{i}"),
            F.percentile_approx(f"x{i}", steps, SKETCH_ACCURACY).alias(f"q{i}"))]).first()
        for i in few:
            if facts[f"d{i}"] * 1.1 > FEW_VALUES:
                cuts = np.unique(np.array(facts[f"q{i}"], dtype=np.float64))
                found[i] = cuts[cuts < facts[f"m{i}"]]
        few = [i for i in few if i not in found]
    if few:
        pairs = values.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x")) for i in few])).alias("p"))
        counted: dict[int, list] = {i: [] for i in few}
        for r in pairs.groupBy("p.i", "p.x").count().collect():
            counted[r["i"]].append((r["x"], r["count"]))
        for i, held in counted.items():
            held.sort()
            found[i] = stride_thresholds(np.array([v for v, _ in held], dtype=np.float64), np.array([n for _, n in held], dtype=np.float64), bins)
    return [found[i] for i in range(numeric)]


def encode(x: np.ndarray, plan: Plan) -> np.ndarray:
    """(columns, rows) codes of dense vectors (rows, positions)."""
    codes = np.zeros((len(plan.columns), len(x)), dtype=plan.code_type)
    x = np.ascontiguousarray(x.T)
    for i, c in enumerate(plan.columns):
        if c.thresholds is not None:
            codes[i] = np.searchsorted(c.thresholds, x[c.start], side="left")
            continue
        for j in range(c.width):
            hot = x[c.start + j] != 0
            if codes[i][hot].any() or not np.array_equal(x[c.start + j], hot):
                raise ValueError(f"positions {c.start} to {c.start + c.width - 1} are not the indicators of one column")
            codes[i][hot] = j + 1
    return codes


def _write_blocks(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, n = 0, 0, [], 0

        def row(labels: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(labels)], pa.int32()),
                 pa.array([labels.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(codes).tobytes()], pa.binary())],
                names=["part", "block", "n", "labels", "codes"])

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, plan.positions)
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            held.append((batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8), encode(x, plan)))
            n += batch.num_rows
            while n >= BLOCK_ROWS:
                labels, codes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1)
                yield row(labels[:BLOCK_ROWS], codes[:, :BLOCK_ROWS])
                held, n, block = [(labels[BLOCK_ROWS:], codes[:, BLOCK_ROWS:])], n - BLOCK_ROWS, block + 1
        if n:
            yield row(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1))

    return run


# ---------------------------------------------------------------- bags

def poisson_cells(rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(count per 16-bit number, 255 where the number does not settle it; cumulative probabilities)."""
    steps = [math.exp(-rate)]
    while len(steps) < 60:
        steps.append(steps[-1] * rate / len(steps))
    cdf = np.cumsum(steps)
    edges = cdf * 65536.0
    cells = np.arange(65536)
    first, last = np.searchsorted(edges, cells, side="right"), np.searchsorted(edges, cells + 1, side="left")
    return np.where(first == last, first, 255).astype(np.uint8), cdf


def bag_counts(plan: Plan, table: tuple[np.ndarray, np.ndarray], tree: int, part: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bag: Poisson with replacement, else 0 or 1."""
    rng = np.random.Generator(np.random.PCG64(np.random.SeedSequence((plan.seed, 0, tree, part, block))))
    if not plan.bootstrap:
        return np.ones(n, np.uint8) if plan.rate >= 1.0 else (rng.random(n) < plan.rate).astype(np.uint8)
    drawn = rng.integers(0, 65536, n, dtype=np.uint16)
    out = table[0].take(drawn)
    open_ = np.flatnonzero(out == 255)
    if len(open_):
        out[open_] = np.searchsorted(table[1], (drawn[open_] + rng.random(len(open_))) / 65536.0, side="right")
    return out


# ---------------------------------------------------------------- one level

class Tree(NamedTuple):
    """A growing tree's nodes as arrays: a row of node i goes to ``child[i]``, or the next one where lo < code <= hi; a leaf
    keeps it. ``slot`` is the place of an open node among those of this level, else -1."""

    column: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    child: np.ndarray
    slot: np.ndarray
    n_open: int


def go_down(tree: Tree, codes: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
    """The nodes of ``rows`` after ``depth`` steps from the root; ``codes`` is (columns, rows of the block)."""
    flat, start, child = codes.ravel(), tree.column * codes.shape[1], tree.child
    node = np.zeros(len(rows), dtype=np.intp)
    for _ in range(depth):
        at = start.take(node)
        at += rows
        code = flat.take(at)
        right = code > tree.lo.take(node)
        right &= code <= tree.hi.take(node)
        node = child.take(node)
        node += right
    return node


def _count_level(plan: Plan, trees, depth: int):
    """``trees`` is a broadcast of {tree: Tree}. Yields (tree, chunk of nodes, counts, their width in bytes)."""
    k, chunk, widest = plan.classes, plan.chunk, max(c.bins for c in plan.columns) * plan.classes
    per_slice = max(1, SLICE_CELLS // (plan.cells * chunk)) * chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for part, block, n, labels, codes in zip(*[batch.column(i) for i in range(5)]):
                held = np.frombuffer(codes.as_buffer(), dtype=plan.code_type).reshape(len(plan.columns), n.as_py()).copy()
                label = np.frombuffer(labels.as_buffer(), dtype=np.uint8)
                # The class goes into the code of a count's place.
                both = [(held[i].astype(np.uint16) * k + label).astype(np.uint8 if c.bins * k <= 256 else np.uint32 if c.bins * k > 65536 else np.uint16)
                        for i, c in enumerate(plan.columns)]
                blocks.append((part.as_py(), block.as_py(), held, both))
        if not blocks:
            return
        table = poisson_cells(plan.rate)
        for number, packed in trees.value.items():
            tree = packed._replace(column=packed.column.astype(np.intp), child=packed.child.astype(np.intp), slot=packed.slot.astype(np.intp))
            for lo in range(0, tree.n_open, per_slice):
                n = min(per_slice, tree.n_open - lo)
                parts = [np.zeros(n * c.bins * k) for c in plan.columns]
                # As many rows at once as make the counting dearer than adding up its result.
                step = max(STEP_ROWS, n * widest)
                for part, block, held, both in blocks:
                    bag = bag_counts(plan, table, number, part, block, held.shape[1])
                    in_bag = np.flatnonzero(bag > 0)
                    for first in range(0, len(in_bag), step):
                        rows = in_bag[first:first + step]
                        slot = tree.slot.take(go_down(tree, held, rows, depth))
                        here = np.flatnonzero((slot >= lo) & (slot < lo + n))
                        if len(here) < len(rows):
                            rows, slot = rows.take(here), slot.take(here)
                        if not len(rows):
                            continue
                        if lo:
                            slot -= lo
                        weight = bag.take(rows).astype(np.float64)
                        for i, c in enumerate(plan.columns):
                            at = slot * (c.bins * k)
                            at += both[i].take(rows)
                            parts[i] += np.bincount(at, weights=weight, minlength=len(parts[i]))
                counts = np.concatenate([p.reshape(n, -1) for p in parts], axis=1)
                most = counts.max()
                kind = np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32 if most < 2**32 else np.uint64
                counts = counts.astype(kind)
                cuts = range(0, n, chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(cuts), pa.int32()), pa.array([(lo + j) // chunk for j in cuts], pa.int32()),
                     pa.array([counts.itemsize] * len(cuts), pa.int32()), pa.array([counts[j:j + chunk].tobytes() for j in cuts], pa.binary())],
                    names=["tree", "chunk", "bytes", "counts"])

    return run


def impurities(counts: np.ndarray, totals: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy (in bits) over the last axis; 0 for no rows."""
    share = counts / np.maximum(totals, 1.0)[..., None]
    if kind == "gini":
        return np.where(totals > 0, 1.0 - (share * share).sum(axis=-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1.0))).sum(axis=-1)


def left_counts(plan: Plan, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """(nodes, candidates, classes): what goes left at each possible split; ``counts`` is (nodes, bins, classes)."""
    out, at = [], 0
    for c in plan.columns:
        held = counts[:, at:at + c.bins]
        out.append(np.cumsum(held, axis=1)[:, :-1] if c.thresholds is not None else totals[:, None] - held[:, 1:])
        at += c.bins
    return np.concatenate(out, axis=1)


def drawn_features(plan: Plan, tree: int, depth: int, chunk: int, nodes: int) -> np.ndarray:
    """(nodes, positions): whether a node may split by a position; ``subset`` of them, uniformly."""
    if plan.subset >= plan.positions:
        return np.ones((nodes, plan.positions), dtype=bool)
    rng = np.random.Generator(np.random.PCG64(np.random.SeedSequence((plan.seed, 1, tree, depth, chunk))))
    out = np.zeros((nodes, plan.positions), dtype=bool)
    np.put_along_axis(out, rng.random((nodes, plan.positions)).argpartition(plan.subset - 1, axis=1)[:, :plan.subset], True, axis=1)
    return out


def best_splits(plan: Plan, counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """(candidate, gain, class counts, class counts going left) per node; the first of equal gains, -1 without a split."""
    totals = counts[:, :plan.columns[0].bins].sum(axis=1).astype(np.float64)
    feature = plan.candidates()[0]
    if not len(feature):
        return np.full(len(counts), -1), np.zeros(len(counts)), totals, totals
    left = left_counts(plan, counts, totals).astype(np.float64)
    n, n_left = totals.sum(axis=-1), left.sum(axis=-1)
    right = totals[:, None] - left
    n_right = n[:, None] - n_left
    inside = (n_left * impurities(left, n_left, plan.impurity) + n_right * impurities(right, n_right, plan.impurity)) / np.maximum(n, 1.0)[:, None]
    gain = impurities(totals, n, plan.impurity)[:, None] - inside
    fits = (n_left >= plan.min_rows) & (n_right >= plan.min_rows) & allowed[:, feature] & (gain >= plan.min_gain)
    gain = np.where(fits, gain, -np.inf)
    best = gain.argmax(axis=1)
    rows = np.arange(len(counts))
    return np.where(np.isfinite(gain[rows, best]), best, -1), gain[rows, best], totals, left[rows, best]


def _add_up(plan: Plan, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, chunk, width, counts in zip(*[batch.column(i) for i in range(4)]):
                key = (tree.as_py(), chunk.as_py())
                held = np.frombuffer(counts.as_buffer(), dtype=f"u{width.as_py()}")
                if key in sums:
                    sums[key] += held
                else:
                    sums[key] = held.astype(np.int64)
        for (tree, chunk), held in sums.items():
            counts = held.reshape(-1, plan.cells // plan.classes, plan.classes)
            found = best_splits(plan, counts, drawn_features(plan, tree, depth, chunk, len(counts)))
            packed = [np.ascontiguousarray(f, dtype=t).tobytes() for f, t in zip(found, (np.int64, np.float64, np.float64, np.float64))]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([chunk], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]],
                                             names=["tree", "chunk", "best", "gain", "totals", "lefts"])

    return run


# ---------------------------------------------------------------- trees

class Grower:
    """One tree on the driver: node arrays in the order of creation, so children come after their parent."""

    def __init__(self, plan: Plan, max_depth: int):
        self.plan, self.max_depth = plan, max_depth
        self.split = np.full(1, -1, dtype=np.int64)  # candidate, -1 for a leaf
        self.child = np.zeros(1, dtype=np.int64)
        self.gain = np.full(1, -1.0)
        self.counts = np.zeros((1, plan.classes))
        self.open = np.zeros(1, dtype=np.int64)

    def tree(self, candidates: tuple[np.ndarray, ...]) -> Tree:
        _, column, lo, hi, _ = candidates
        inner = self.split >= 0
        pick = lambda values, leaf: np.where(inner, values[self.split], leaf).astype(values.dtype) if len(values) else np.full(len(inner), leaf, values.dtype)
        most = np.iinfo(self.plan.code_type).max
        slot = np.full(len(inner), -1, dtype=np.int32)
        slot[self.open] = np.arange(len(self.open))
        return Tree(pick(column, 0).astype(np.int16), pick(lo, most), pick(hi, most), self.child.astype(np.int32), slot, len(self.open))

    def grow(self, depth: int, best: np.ndarray, gain: np.ndarray, totals: np.ndarray, lefts: np.ndarray) -> None:
        """The open nodes' splits become part of the tree, and their children that may split are open."""
        self.counts[self.open] = totals
        go = (best >= 0) & (gain > 0) & (depth < self.max_depth)
        nodes = self.open[go]
        first = len(self.split) + 2 * np.arange(len(nodes))
        self.split[nodes], self.gain[nodes], self.child[nodes] = best[go], gain[go], first
        counts = np.stack([lefts[go], totals[go] - lefts[go]], axis=1).reshape(-1, self.plan.classes)
        new = len(self.split) + np.arange(len(counts))
        self.split = np.concatenate([self.split, np.full(len(new), -1)])
        self.gain = np.concatenate([self.gain, np.full(len(new), -1.0)])
        self.child = np.concatenate([self.child, new])
        self.counts = np.concatenate([self.counts, counts])
        mixed = (counts > 0).sum(axis=1) > 1
        self.open = new[mixed] if depth + 1 < self.max_depth else new[:0]

    def pruned(self) -> dict[str, np.ndarray]:
        """The node arrays after sibling leaves of one predicted class have become their parent, children after parents."""
        predicted = self.counts.argmax(axis=1)
        inner = self.split >= 0
        for node in np.flatnonzero(inner)[::-1]:  # children first
            a, b = self.child[node], self.child[node] + 1
            if not inner[a] and not inner[b] and predicted[a] == predicted[b]:
                inner[node] = False
        kept = np.zeros(len(inner), dtype=bool)
        kept[0] = True
        for node in np.flatnonzero(inner):  # parents first
            if kept[node]:
                kept[self.child[node]:self.child[node] + 2] = True
        inner &= kept
        at = np.cumsum(kept) - 1
        left = np.where(inner, at[np.where(inner, self.child, 0)], -1)
        return {"split": np.where(inner, self.split, -1)[kept], "left": left[kept], "right": np.where(inner, left + 1, -1)[kept],
                "gain": np.where(inner, self.gain, -1.0)[kept], "counts": self.counts[kept], "prediction": predicted[kept].astype(np.float64)}


def subset_size(strategy: str, positions: int, trees: int) -> int:
    """Features per node, as Spark reads ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    if strategy == "all":
        return positions
    if strategy == "sqrt":
        return math.ceil(math.sqrt(positions))
    if strategy == "log2":
        return max(1, math.ceil(math.log2(positions)))
    if strategy == "onethird":
        return math.ceil(positions / 3.0)
    return min(int(strategy), positions) if strategy.isdigit() else math.ceil(float(strategy) * positions)


def grow_trees(vectors: DataFrame, blocks: DataFrame, plan: Plan, n_trees: int, max_depth: int, tasks: int) -> list[Grower]:
    sc, candidates = vectors.sparkSession.sparkContext, plan.candidates()
    growers = [Grower(plan, max_depth) for _ in range(n_trees)]
    for depth in range(max(1, max_depth)):
        left = [t for t in range(n_trees) if len(growers[t].open)]
        while left:
            here, cells = [], 0
            while left and (not here or cells + len(growers[left[0]].open) * plan.cells <= JOB_CELLS):
                cells += len(growers[left[0]].open) * plan.cells
                here.append(left.pop(0))
            keys = sum(math.ceil(len(growers[t].open) / plan.chunk) for t in here)
            trees = sc.broadcast({t: growers[t].tree(candidates) for t in here})
            try:
                counted = blocks.mapInArrow(_count_level(plan, trees, depth), "tree int, chunk int, bytes int, counts binary")
                summed = counted.repartition(min(keys, max(tasks, 1)), "tree", "chunk").mapInArrow(
                    _add_up(plan, depth), "tree int, chunk int, best binary, gain binary, totals binary, lefts binary")
                found = sorted(summed.collect(), key=lambda r: (r["tree"], r["chunk"]))  # one number or class count per node
            finally:
                trees.destroy()
            for t in here:
                mine = [r for r in found if r["tree"] == t]
                joined = lambda name, kind: np.frombuffer(b"".join(r[name] for r in mine), dtype=kind)
                if len(joined("best", np.int64)) != len(growers[t].open):
                    raise RuntimeError(f"tree {t}: {len(joined('best', np.int64))} of {len(growers[t].open)} nodes came back")
                growers[t].grow(depth, joined("best", np.int64), joined("gain", np.float64),
                                joined("totals", np.float64).reshape(-1, plan.classes), joined("lefts", np.float64).reshape(-1, plan.classes))
    return growers


# ---------------------------------------------------------------- the model

class Nodes(NamedTuple):
    """A grown tree's nodes: a value above ``threshold`` goes to the second of a node's ``kids``; a leaf's are the leaf itself."""

    feature: np.ndarray
    threshold: np.ndarray
    kids: np.ndarray  # two per node, side by side
    shares: np.ndarray  # (classes, nodes): of each class among a node's rows
    depth: int


def scoring_nodes(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Nodes:
    """Nodes from a model's fields, where a leaf has feature -1; children come after their parent."""
    own, inner = np.arange(len(feature)), feature >= 0
    level = np.zeros(len(feature), dtype=np.int64)
    for node in np.flatnonzero(inner):
        level[left[node]] = level[right[node]] = level[node] + 1
    kids = np.stack([np.where(inner, left, own), np.where(inner, right, own)], axis=1).ravel()
    shares = (counts / np.maximum(counts.sum(axis=1), 1.0)[:, None]).T
    return Nodes(np.where(inner, feature, 0).astype(np.int32), np.where(inner, threshold, np.inf), kids.astype(np.int32), np.ascontiguousarray(shares), int(level.max()))


def read_nodes(path: str) -> list[Nodes]:
    """The trees of a forest that Spark saved, in the form that scores rows."""
    n = "nodeData"
    fields = [F.col(f"{n}.split.featureIndex"), F.col(f"{n}.split.leftCategoriesOrThreshold"), F.col(f"{n}.leftChild"), F.col(f"{n}.rightChild"), F.col(f"{n}.impurityStats")]
    saved = SparkSession.active().read.parquet(f"{path}/data").select("treeID", F.col(f"{n}.id"), *fields).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, _, feature, cuts, left, right, stats = (c.combine_chunks() for c in saved.columns)
    feature, left, right = (c.to_numpy() for c in (feature, left, right))
    threshold = np.full(len(feature), np.inf)
    threshold[feature >= 0] = cuts.flatten().to_numpy()
    counts = stats.flatten().to_numpy().reshape(len(feature), -1)
    ends = [0, *(np.flatnonzero(np.diff(tree.to_numpy())) + 1), len(feature)]
    return [scoring_nodes(*(f[a:b] for f in (feature, threshold, left, right, counts))) for a, b in zip(ends, ends[1:])]


def class_votes(trees: list[Nodes], x: np.ndarray) -> np.ndarray:
    """(classes, rows) sums of the leaves' class shares, tree after tree as Spark adds them; ``x`` is (rows, positions)."""
    flat, start = np.ascontiguousarray(x).ravel(), np.arange(len(x), dtype=np.intp) * x.shape[1]
    votes = np.zeros((len(trees[0].shares), len(x)))
    for tree in trees:
        feature, kids = tree.feature.astype(np.intp), tree.kids.astype(np.intp)
        node = np.zeros(len(x), dtype=np.intp)
        for _ in range(tree.depth):
            at = feature.take(node)
            at += start
            right = flat.take(at) > tree.threshold.take(node)
            node *= 2
            node += right
            node = kids.take(node)
        for k, share in enumerate(tree.shares):
            votes[k] += share.take(node)
    return votes


def predicted_class(trees: list[Nodes], features: str) -> Column:
    """The class with the most votes (the first of equals), as the model's own ``transform`` says. There a row visits a hundred
    trees of scattered Java objects; here a batch of rows goes down one tree after the other."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.int32())
                continue
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield pa.array(class_votes(trees, x).argmax(axis=0).astype(np.int32))

    return F.arrow_udf(run, "int")(vector_to_array(features))


def _metadata(name: str, uid: str, spark_version: str, params: dict, defaults: dict, **facts) -> str:
    return json.dumps({"class": f"org.apache.spark.ml.classification.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark_version,
                       "uid": uid, "paramMap": params, "defaultParamMap": defaults, **facts})


def _node_table(number: int, nodes: dict[str, np.ndarray], plan: Plan, candidates: tuple[np.ndarray, ...]) -> pa.Table:
    feature, _, _, _, threshold = candidates
    n, inner, counts = len(nodes["split"]), nodes["split"] >= 0, nodes["counts"]
    offsets = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, feature[nodes["split"]] if len(feature) else -1, -1).astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(threshold[nodes["split"][inner]].astype(np.float64))),
         pa.array(np.full(n, -1, dtype=np.int32))], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * plan.classes).astype(np.int32)), pa.array(counts.ravel().astype(np.float64)))
    node = pa.StructArray.from_arrays(
        [pa.array(np.arange(n, dtype=np.int32)), pa.array(nodes["prediction"]), pa.array(impurities(counts, counts.sum(axis=1), plan.impurity)), stats,
         pa.array(counts.sum(axis=1).astype(np.int64)), pa.array(nodes["gain"]), pa.array(nodes["left"].astype(np.int32)),
         pa.array(nodes["right"].astype(np.int32)), split],
        names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": pa.array(np.full(n, number, dtype=np.int32)), "nodeData": node})


def spark_model(stage: RandomForestClassifier, vectors: DataFrame, plan: Plan, trees: list[dict[str, np.ndarray]]) -> RandomForestClassificationModel:
    """The trees as Spark's model: written as it saves one, and loaded."""
    spark, candidates = vectors.sparkSession, plan.candidates()
    path = scratch_path(spark, "forest")
    params = {p.name: v for p, v in stage._paramMap.items()}
    defaults = {p.name: v for p, v in stage._defaultParamMap.items()}
    of_tree = lambda given: {k: v for k, v in given.items() if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    try:
        own = _metadata("RandomForestClassificationModel", stage.uid, spark.version, params, defaults,
                        numFeatures=plan.positions, numClasses=plan.classes, numTrees=len(trees))
        spark.createDataFrame([(own,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        each = [(t, _metadata("DecisionTreeClassificationModel", f"{stage.uid}_tree{t}", spark.version, of_tree(params), of_tree(defaults)), 1.0)
                for t in range(len(trees))]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = pa.concat_tables(_node_table(t, tree, plan, candidates) for t, tree in enumerate(trees))
        spark.createDataFrame(nodes).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)
    finally:
        delete_path(spark, path)


def fit_forest(stage: RandomForestClassifier, vectors: DataFrame, numeric: int, widths: list[int],
               tasks: int | None = None) -> RandomForestClassificationModel:
    """``stage.fit(vectors)`` for vectors of ``numeric`` complete numbers, then the indicators of text columns with
    ``widths`` values each. ``vectors`` is read three times: keep it. Labels that are no classes, and vectors with more
    than ``MAX_BINS`` bins, go to Spark's trainer."""
    label, features = stage.getLabelCol(), stage.getFeaturesCol()
    y = F.col(label)
    facts = vectors.agg(F.count("*").alias("rows"), F.max(y).alias("most"),
                        F.count_if(y.isNull() | (y < 0) | (y != F.floor(y))).alias("odd")).first()
    most_bins = stage.getOrDefault(stage.maxBins)
    if not facts["rows"] or facts["odd"] or facts["most"] >= MAX_CLASSES or numeric * most_bins + sum(widths) + len(widths) > MAX_BINS:
        return stage.fit(vectors)
    thresholds = find_thresholds(vectors, features, numeric, facts["rows"], most_bins) if numeric else []
    starts = numeric + np.cumsum([0, *widths])
    columns = [Codes(i, t, 1) for i, t in enumerate(thresholds)] + [Codes(int(s), None, w) for s, w in zip(starts, widths) if w]
    positions, n_trees = numeric + sum(widths), stage.getNumTrees()
    plan = Plan(columns, positions, int(facts["most"]) + 1, stage.getSeed() & (2**64 - 1), stage.getBootstrap(), stage.getSubsamplingRate(),
                subset_size(stage.getFeatureSubsetStrategy(), positions, n_trees), stage.getImpurity(), stage.getMinInstancesPerNode(),
                stage.getMinInfoGain())
    # The partition is a column: a task of several partitions has one number only.
    blocks = vectors.select(F.col(label).cast("int"), vector_to_array(features), F.spark_partition_id()).mapInArrow(_write_blocks(plan), BLOCKS)
    tasks = tasks or max(1, min(vectors.rdd.getNumPartitions(), math.ceil(facts["rows"] / ROWS_PER_TASK)))
    # Blocks carry the partition that they were made in, so fewer tasks change no bag.
    blocks = blocks.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        growers = grow_trees(vectors, blocks, plan, n_trees, stage.getMaxDepth(), tasks)
    finally:
        blocks.unpersist()
    trees = [g.pruned() for g in growers]
    model, (feature, *_, threshold) = spark_model(stage, vectors, plan, trees), plan.candidates()
    if positions > MAX_SCORED:
        return model
    model.scoring = [scoring_nodes(*((np.where(t["split"] >= 0, feature[t["split"]], -1), np.where(t["split"] >= 0, threshold[t["split"]], np.inf))
                                     if len(feature) else (t["split"], np.full(len(t["split"]), np.inf))), t["left"], t["right"], t["counts"]) for t in trees]
    return model
