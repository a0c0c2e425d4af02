"""Vector code compression: product quantisation in integers, with memoised grid cells.

Each component becomes an integer, a vector is cut into equal parts, and each part position has a codebook, which a
fixed number of rounds moves to the floored means of its parts. A part looks for its nearest entry through its
*coarse cell*, the box of ``cell`` integers a side that it lies in: an entry whose least distance to the box is
above the largest distance of another entry can be nearest to no point in it. The entries that are left are kept per
cell, by a hash of the cell, and only they are compared exactly. Cells are kept while a task runs, ``cells`` at most
(then they are learnt anew: memory is bounded, results do not change); a hash that two cells share is noticed, and
the second one is compared with all entries.

Each round reads a table of packed integers in tasks; a task returns one sum and count per entry, which Spark adds
up. The driver holds the codebooks only. All arithmetic is exact, so ties and results do not depend on the layout.

Defined results: vectors that are null or hold null or non-finite components are dropped, and so are those with
another number of components than the row of the smallest vec_id; a number of components that the parts do not divide is
filled with zeros; fewer rows than entries give as many entries as rows; rows of one vec_id all count, the first ones
by their packed components start the codebooks; null vec_ids come last. Components beyond a bound (2^27 for 64
components, 32,768 before scaling) are set to it, so that distances stay in a long. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import leased, materialise, mix

BROADCAST_BYTES = 4 << 20


@dataclass(frozen=True)
class CodeConfig:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    cell: int = 384  # side of a coarse cell, in scaled integers
    cells: int = 1 << 16  # cells kept per task and part


def bound(dims: int) -> int:
    """Largest size of a component for which the distances of vectors of ``dims`` components fit a long."""
    return 1 << max((62 - math.ceil(math.log2(max(dims, 1)))) // 2 - 1, 1)


# ---------------------------------------------------------------- integers


def packing(scale: int):
    """Task: (vec_id, label, embedding) to (vec_id, label, dims, packed), without the rows that are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)  # a null is NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            ok = np.asarray(lists.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
            sizes = np.diff(offsets)
            inside = np.zeros(len(values) + 1, np.int64)
            np.add.at(inside, offsets[:-1][ok], 1)
            np.add.at(inside, offsets[1:][ok], -1)
            kept, dims = values[np.cumsum(inside[:-1]) > 0], sizes[ok]
            tops = np.array([bound(d) for d in range(int(dims.max()) + 1)] if len(dims) else [1], dtype=np.float64)
            limit = np.repeat(tops[dims], dims)
            with np.errstate(over="ignore"):
                ints = np.clip(np.floor(kept * scale), -limit, limit).astype("<i4")
            ends = np.concatenate([[0], np.cumsum(dims)]).astype(np.int32) * 4
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(dims), [None, pa.py_buffer(ends), pa.py_buffer(ints)])
            mask = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(mask), batch.column("label").filter(mask), pa.array(dims, pa.int32()), packed],
                ["vec_id", "label", "dims", "packed"])

    return leased("code_cells", run)


def unpacked(column: pa.Array, dims: int, parts: int) -> np.ndarray:
    """(rows, parts, components of a part), filled with zeros."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(len(column), dims)
    width = -(-dims // parts)
    out = np.zeros((len(column), parts * width), np.int64)
    out[:, :dims] = flat
    return out.reshape(len(column), parts, width)


# ---------------------------------------------------------------- cells


class Cells:
    """The entries of one codebook that can be nearest somewhere in a coarse cell, memoised by cell."""

    def __init__(self, book: np.ndarray, cell: int, most: int):
        self.book, self.cell, self.most = book, cell, most
        width = book.shape[1]
        self.factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.forget()

    def forget(self) -> None:
        entries, width = self.book.shape
        self.keys = np.zeros(0, np.uint64)
        self.boxes = np.zeros((0, width), np.int64)
        self.near = np.zeros((0, entries), bool)

    def undominated(self, boxes: np.ndarray) -> np.ndarray:
        """(cells, entries): whether the entry's least distance to the box is within every entry's largest one."""
        out = np.empty((len(boxes), len(self.book)), bool)
        for a in range(0, len(boxes), 2048):
            lo = (boxes[a : a + 2048] * self.cell)[:, None, :]
            below, above = lo - self.book[None], self.book[None] - (lo + self.cell - 1)
            least = np.maximum(np.maximum(below, above), 0)
            most = np.maximum(np.abs(below), np.abs(above))
            least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
            out[a : a + 2048] = least <= most.min(axis=1)[:, None]
        return out

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """(points, entries): the entries to compare exactly."""
        boxes = np.floor_divide(points, self.cell)
        with np.errstate(over="ignore"):
            hashed = mix((boxes.astype(np.uint64) * self.factors).sum(axis=1, dtype=np.uint64))
        keys, at, back = np.unique(hashed, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.keys, keys)
        known = spot < len(self.keys)
        known[known] = self.keys[spot[known]] == keys[known]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            if len(self.keys) + len(fresh) > self.most:
                self.forget()
                fresh = np.arange(len(keys))
            order = np.argsort(np.concatenate([self.keys, keys[fresh]]), kind="stable")
            new = boxes[at[fresh]]
            self.near = np.concatenate([self.near, self.undominated(new)])[order]
            self.boxes = np.concatenate([self.boxes, new])[order]
            self.keys = np.concatenate([self.keys, keys[fresh]])[order]
            spot = np.searchsorted(self.keys, keys)
        mine = spot[back.ravel()]
        return self.near[mine] | (self.boxes[mine] != boxes).any(axis=1)[:, None]

    def nearest(self, points: np.ndarray, distances: bool) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each point (ties: the lower one) and its squared distance. Without ``distances``, a point
        with one candidate is not compared, and its distance means nothing."""
        near = self.candidates(points)
        entry, best = near.argmax(axis=1), np.full(len(points), np.iinfo(np.int64).max)
        if not distances:
            near = near & (near.sum(axis=1) > 1)[:, None]
        for e in range(len(self.book)):
            rows = np.flatnonzero(near[:, e])
            if len(rows):
                gap = points[rows] - self.book[e]
                here = (gap * gap).sum(axis=1)
                closer = here < best[rows]
                best[rows[closer]], entry[rows[closer]] = here[closer], e
        return entry, best


# ---------------------------------------------------------------- rounds


def adding(books: np.ndarray, dims: int, cfg: CodeConfig):
    """Task: (packed) to one row (part, entry, n, s0, s1, ...) per entry, the sums of the parts nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        cells = [Cells(b, cfg.cell, cfg.cells) for b in books]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            points = unpacked(batch.column("packed"), dims, parts)
            for p in range(parts):
                entry, _ = cells[p].nearest(points[:, p], distances=False)
                counts[p] += np.bincount(entry, minlength=entries)
                for e in range(entries):
                    sums[p, e] += points[entry == e, p].sum(axis=0)
        if counts.any():
            at = np.indices((parts, entries)).reshape(2, -1).astype(np.int32)
            columns = [pa.array(at[0]), pa.array(at[1]), pa.array(counts.ravel()), *(pa.array(sums[:, :, i].ravel()) for i in range(width))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return leased("code_cells", run)


def coding(books: np.ndarray, dims: int, cfg: CodeConfig):
    """Task: (vec_id, label, packed) to (vec_id, label, code, error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, _ = books.shape
        cells = [Cells(b, cfg.cell, cfg.cells) for b in books]
        digits = np.array([list(b"%02x" % e) for e in range(entries)], np.uint8)
        for batch in batches:
            points = unpacked(batch.column("packed"), dims, parts)
            found = [cells[p].nearest(points[:, p], distances=True) for p in range(parts)]
            signs = digits[np.stack([f[0] for f in found], axis=1)].tobytes()
            ends = np.arange(len(points) + 1, dtype=np.int32) * (2 * parts)
            code = pa.StringArray.from_buffers(len(points), pa.py_buffer(ends), pa.py_buffer(signs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), code, pa.array(sum(f[1] for f in found))],
                ["vec_id", "label", "code", "error"])

    return leased("code_cells", run)


def integers(spark: SparkSession, vectors: DataFrame, cfg: CodeConfig) -> DataFrame:
    """(vec_id, label, dims, packed) of the rows that are kept, written once."""
    label = vectors.schema["label"].dataType.simpleString()
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return materialise(spark, given.mapInArrow(packing(cfg.scale), f"vec_id long, label {label}, dims int, packed binary"), "code-integers")


def learnt(rows: DataFrame, cfg: CodeConfig) -> tuple[np.ndarray, int] | None:
    """The codebooks (part, entry, component) after all rounds, and the number of components; None without rows."""
    if not 1 <= cfg.entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    order = (F.asc_nulls_last("vec_id"), F.asc("packed"))
    least = rows.orderBy(*order).limit(1).collect()
    if not least:
        return None
    dims = least[0]["dims"]
    same = rows.where(F.col("dims") == dims)
    start = same.orderBy(*order).limit(cfg.entries).select("packed").collect()  # the feature: as many as entries
    books = unpacked(pa.array([bytes(r["packed"]) for r in start], pa.binary()), dims, cfg.parts).transpose(1, 0, 2).copy()
    width = books.shape[2]
    names = [f"s{i}" for i in range(width)]
    schema = ", ".join(["part int", "entry int", "n long", *(f"{s} long" for s in names)])
    for _ in range(cfg.rounds):
        sums = same.select("packed").mapInArrow(adding(books, dims, cfg), schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in names])
        for r in sums.where("n > 0").collect():  # a row per entry
            books[r["part"], r["entry"]] = [int(r[s]) // r["n"] for s in names]
    return books, dims


def digest(books: np.ndarray) -> str:
    """sha256 of all components of all entries by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(spark: SparkSession, vectors: DataFrame, cfg: CodeConfig = CodeConfig()) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the vectors (vec_id, label, embedding)."""
    label = vectors.schema["label"].dataType.simpleString()
    rows = integers(spark, vectors, cfg)
    found = learnt(rows, cfg)
    if found is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books, dims = found
    coded = rows.where(F.col("dims") == dims).select("vec_id", "label", "packed").mapInArrow(
        coding(books, dims, cfg), f"vec_id long, label {label}, code string, error long")
    coded = materialise(spark, coded, "codes")
    sums = materialise(spark, coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "code-errors")
    size = sums.agg(F.sum(F.coalesce(F.octet_length(F.col("same").cast("string")), F.lit(0)) + 50)).first()[0]
    side = F.broadcast(sums) if size <= BROADCAST_BYTES else sums
    return coded.join(side, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
