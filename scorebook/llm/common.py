"""Shared helpers: Arrow text buffers, word tables and rolling hashes in numpy, scratch tables.

All text work runs inside Spark tasks on Arrow batches (``mapInArrow``). A batch is cut into slices of bounded
bytes (one very long text is a slice of its own), so temporaries stay small while every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.session import scratch_path
from scorebook.sources.catalog import delete_path

SLICE_BYTES = 1 << 20
CHUNK_BYTES = 1 << 19
BATCH_BYTES = 4 << 20  # of an Arrow batch between Spark and a Python worker, in what an operator writes
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# The white space that separates words (space and 0x09-0x0D).
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(WHITE_SPACE)] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that the innermost open ``scratch_scope`` removes at its end; None outside of one.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end or after a failure, the tables that operators have put into the scratch folder inside it.

    What outlives the scope is written inside it with ``written``. Tables of an outer scope stay until that one ends.
    """
    folders: list[str] = []
    token = _scope.set(folders)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in folders:
            delete_path(spark, path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared scratch folder, removed with the open ``scratch_scope`` if there is one."""
    path = scratch_path(spark, name)
    folders = _scope.get()
    if folders is not None:
        folders.append(path)
    return path


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send Arrow batches of about ``BATCH_BYTES`` to Python workers, unless the session sets a size.

    The executor and its worker each hold a task's batch outside the heap; Spark's own bound on one is 64 MB.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back."""
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: a lineage cut that survives lost executors."""
    return written(spark, df, scratch(spark, name))


def carrying(docs: DataFrame) -> DataFrame:
    """(doc_id, text, carry): all other columns in one struct, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("__")).alias("carry"))


def uncarried(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the table that went through ``carrying``, in their order."""
    return df.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"carry.`{c}`").alias(c) for c in columns))


def crc_mod(col: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (the contract's folds); null ids give null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


# ---------------------------------------------------------------- Arrow text


class Texts:
    """Rows ``lo..hi`` of one Arrow batch as raw UTF-8: ``data`` (uint8) and ``offsets`` (n + 1, from 0)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, valid: np.ndarray):
        self.data, self.offsets, self.lo, self.valid = data, offsets, lo, valid

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, valid) of a string column; a null has length 0."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    n = len(array)
    valid = np.ones(n, dtype=bool) if array.null_count == 0 else np.asarray(array.is_valid())
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, off, dat = array.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), valid
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    data = np.frombuffer(dat, dtype=np.uint8) if dat is not None else np.zeros(0, np.uint8)
    return data, offsets, valid


def text_slices(array: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Consecutive rows of a string column, at most ``max_bytes`` each (or one longer text alone)."""
    data, offsets, valid = text_buffers(array)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo, valid[lo:hi])
        lo = hi


# ---------------------------------------------------------------- words


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the maximal runs where ``inside`` holds; no run crosses a text's end.

    Text i owns the words ``first[i]:first[i + 1]``.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    cuts = offsets[:-1][offsets[:-1] < n]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[(offsets[1:] - 1)[offsets[1:] > 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def space_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space."""
    return word_spans(texts.data, texts.offsets, ~IS_SPACE[texts.data])


# ---------------------------------------------------------------- hashes


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection on 64-bit integers that spreads every bit."""
    x = np.array(x, dtype=np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Roller:
    """Polynomial hashes modulo 2^64 of byte or value runs, over randomised symbols, finished with ``mix``."""

    def __init__(self, seed: int):
        s = mix(np.arange(1, 260, dtype=np.uint64) * _ODD + np.uint64(seed))
        self.symbols = s[:256]
        self.base = int(s[256]) | 1
        self.salt = s[257]
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(CHUNK_BYTES, self.base, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(
                np.concatenate([[np.uint64(1)], np.full(CHUNK_BYTES, _inverse(self.base), np.uint64)]), dtype=np.uint64
            )

    def _power(self, at: int, inverse: bool = False) -> np.uint64:
        return np.uint64(pow(_inverse(self.base) if inverse else self.base, int(at), 1 << 64))

    def _shift_back(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """values / base^at, with ``at`` in two digits so that the power table stays short."""
        hi, lo = np.divmod(at, CHUNK_BYTES)
        out = values * self.down[lo]
        if len(hi) and hi.max() > 0:
            step = self._power(CHUNK_BYTES, inverse=True)
            table = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(hi.max()), step, np.uint64)]), dtype=np.uint64)
            out = out * table[hi]
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte run ``data[starts:ends]``; prefix sums are kept for one chunk at a time."""
        head = np.zeros(len(starts), np.uint64)
        tail = np.zeros(len(ends), np.uint64)
        carry = np.uint64(0)
        with np.errstate(over="ignore"):
            for a in range(0, max(len(data), 1), CHUNK_BYTES):
                part = data[a : a + CHUNK_BYTES]
                sums = np.empty(len(part) + 1, np.uint64)
                sums[0] = 0
                np.cumsum(self.symbols[part] * self.up[: len(part)], out=sums[1:], dtype=np.uint64)
                sums *= self._power(a)
                sums += carry
                b = a + len(part)
                i, j = np.searchsorted(starts, [a, b])
                head[i:j] = sums[starts[i:j] - a]
                i, j = np.searchsorted(ends, [a + 1, b + 1])
                tail[i:j] = sums[ends[i:j] - a]
                carry = sums[-1]
            return mix(self._shift_back(tail - head, starts) + (ends - starts).astype(np.uint64) * self.salt)

    def windows(self, values: np.ndarray, size: int) -> np.ndarray:
        """Hash of each run of ``size`` consecutive values (length n - size + 1, or none)."""
        n = len(values)
        if n < size:
            return np.zeros(0, np.uint64)
        out = np.empty(n - size + 1, np.uint64)
        step = CHUNK_BYTES - size
        if step <= 0:
            raise ValueError("window longer than the power table")
        with np.errstate(over="ignore"):
            for a in range(0, n - size + 1, step):
                part = values[a : a + step + size - 1]
                sums = np.empty(len(part) + 1, np.uint64)
                sums[0] = 0
                np.cumsum(part * self.up[: len(part)], out=sums[1:], dtype=np.uint64)
                m = len(part) - size + 1
                out[a : a + m] = mix((sums[size:] - sums[:-size]) * self.down[:m] + self.salt)
        return out


def to_signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as Spark longs."""
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def window_owner(first: np.ndarray, size: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows of ``size`` words over all words of a slice: (text index, whether it ends inside its text)."""
    n = max(total - size + 1, 0)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    return owner, (np.arange(n) + size) <= first[1:][owner] if n else np.zeros(0, bool)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """One table per run of equal keys, over batches that are sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            here = tuple(c[a] for c in cols)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield pa.Table.from_batches(held)


# ---------------------------------------------------------------- per-process cache


def process_cache(use: str) -> dict:
    """What the Python worker keeps between tasks of one use; a task of another use drops it all.

    Task code travels by value, so its own globals are new in every task; an entry in ``sys.modules`` is not.
    Workers outlive the stages of a job, so each task first gives back the memory that others left free.
    """
    import sys
    import types

    holder = sys.modules.setdefault("scorebook_llm_process_cache", types.ModuleType("scorebook_llm_process_cache"))
    if getattr(holder, "use", None) != use:
        holder.use, holder.kept = use, {}
        release_memory()
    return holder.kept


def release_memory() -> None:
    """Return freed memory to the system: Python's, Arrow's and, where the C library can, malloc's."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def leased(use: str, run):
    """A task function that drops what other uses kept before it starts, and gives free memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_cache(use)
        yield from run(batches)
        release_memory()

    return task
