"""Exact, reproducible stratified train/test split (M1).

Sizes follow the documented rule of the reference's splitter: ``n_test = ceil(test_size * N)``; each class
gets ``floor(n_train * n_c / N)`` train rows and the leftover seats go to the largest fractions (ties: the
smaller label). The rows a class sends to train are the first ones in ``md5(keys | seed)`` order, then in the
order of a hash of the whole row (which orders the copies of a duplicated key).

No row is ranked or shuffled to find its side. One pass over the keys and the label counts rows per (class, leading
digits of the order); the running sum names, per class, the one prefix in which the train seats end. A second pass
reads that prefix's rows only and finds the exact *boundary value*, the order of the last row that goes to train. The
split itself is then one expression, ``order <= boundary``, on the frame as it is. Rows that share a boundary key are
told apart by a boundary of the row hash, found the same way; only where copies of one whole row lie across the
seats are those copies numbered, and any of them may sit on either side.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.config import normalize_keys
from scorebook.functions.expressions import split_order_hash
from scorebook.operators.ranks import SINGLE_TASK_ROWS
from scorebook.session import scratch_root

TRAIN, TEST = "train", "test"
DIGITS = 3  # hex digits of the order counted in the first pass, and added by each further cut
BROADCAST_BYTES = 8 << 20
MD5_DIGITS, ROW_DIGITS = 32, 16
PAST_ALL = "g"  # above every hex digit
CASE_CLASSES = 64  # more classes are joined instead of written as a CASE expression
COLLECTED_CELLS = 1 << 16  # counts per (class, prefix) that may be summed up on the driver


def _approximate_mode(counts: list[int], n_draws: int) -> list[int]:
    total = sum(counts)
    continuous = [c / total * n_draws for c in counts]
    floored = [math.floor(x) for x in continuous]
    need = n_draws - sum(floored)
    # Largest remainders first; equal remainders go to the earlier (smaller) label.
    order = sorted(range(len(counts)), key=lambda i: (-(continuous[i] - floored[i]), i))
    for i in order[:need]:
        floored[i] += 1
    return floored


def split_sizes(class_counts: dict, test_size: float | int) -> dict:
    """label -> (n_train, n_test) for the whole frame; raises where the split is impossible."""
    if None in class_counts:
        raise ValueError("the label column holds nulls; drop or fix them before splitting")
    labels = sorted(class_counts)
    counts = [class_counts[k] for k in labels]
    n = sum(counts)
    if isinstance(test_size, float):
        if not 0.0 < test_size < 1.0:
            raise ValueError(f"test_size must be in (0, 1), got {test_size}")
        n_test = math.ceil(test_size * n)
    else:
        n_test = int(test_size)
    n_train = n - n_test
    if n_train <= 0 or n_test <= 0:
        raise ValueError(f"split of {n} rows with test_size={test_size} leaves an empty side")
    if len(labels) < 2:
        raise ValueError("a stratified split needs at least two classes")
    if min(counts) < 2:
        raise ValueError("the least populated class has fewer than 2 rows; a stratified split is impossible")
    if n_train < len(labels) or n_test < len(labels):
        raise ValueError(f"train ({n_train}) and test ({n_test}) must each hold at least one row per class")
    train = _approximate_mode(counts, n_train)
    return {k: (t, c - t) for k, c, t in zip(labels, counts, train)}


def class_counts(df: DataFrame, label_col: str, count_col: str | None = None, max_classes: int | None = None) -> dict:
    """label -> rows; with ``count_col`` the frame is already counted (rows are summed). ``max_classes`` makes
    more classes an error; by default there is no bound but the driver's memory for one number per class."""
    agg = df.groupBy(label_col).agg(F.sum(count_col).alias("count")) if count_col else df.groupBy(label_col).count()
    rows = (agg if max_classes is None else agg.limit(max_classes + 1)).collect()
    if max_classes is not None and len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label_col!r}")
    return {r[label_col]: r["count"] for r in rows}


def _by_class(df: DataFrame, label_col: str, facts: dict, schema: str) -> DataFrame:
    """``df`` with the facts of its row's class (a tuple per class, named by ``schema``); null where a class has none.
    Few classes are a CASE expression; many are joined, broadcast below a byte bound."""
    fields = T._parse_datatype_string(schema).fields
    if len(facts) <= CASE_CLASSES:
        out = {f.name: F.lit(None).cast(f.dataType) for f in fields}
        for i, f in enumerate(fields):
            for label, row in facts.items():
                out[f.name] = F.when(F.col(label_col) == F.lit(label), F.lit(row[i]).cast(f.dataType)).otherwise(out[f.name])
        return df.withColumns(out)
    key = T.StructField("_l", df.schema[label_col].dataType)
    side = df.sparkSession.createDataFrame([(k, *row) for k, row in facts.items()], T.StructType([key, *fields]))
    if sum(len(str(k)) + 150 for k in facts) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return df.join(side, F.col(label_col) == F.col("_l"), "left").drop("_l")


def _edges(cells: DataFrame, label_col: str, goals: dict) -> dict:
    """label -> (cell, rows before it, rows in it) of the cell that holds the class's row number ``seats + 1``, where
    ``goals`` is label -> (rows before all cells, seats); ``cells`` is (label, _p, n)."""
    w = Window.partitionBy(label_col).orderBy("_p")
    run = _by_class(cells, label_col, goals, "_base long, _seats long").withColumn(
        "_before", F.col("_base") + F.sum("n").over(w) - F.col("n"))
    held = run.where((F.col("_before") <= F.col("_seats")) & (F.col("_seats") < F.col("_before") + F.col("n")))
    return {r[0]: tuple(r)[1:] for r in held.select(label_col, "_p", "_before", "n").collect()}


def _edges_of_rows(cells: list, goals: dict) -> dict:
    """``_edges`` of cells that are already on the driver."""
    out, before = {}, {k: base for k, (base, _) in goals.items()}
    for label, cell, n in sorted(cells, key=lambda c: c[1]):
        if before[label] <= goals[label][1] < before[label] + n:
            out[label] = (cell, before[label], n)
        before[label] += n
    return out


def _boundaries(rows: DataFrame, label_col: str, edges: dict, seats: dict, digits: int, total: int, single_task_rows: int) -> dict:
    """label -> (value, taken, copies): rows with an order below ``value`` are train, ``taken`` of the ``copies`` rows equal
    to it too, and all others test. ``rows`` is (label, _o) with orders of ``total`` digits; ``edges`` their edge cells of
    ``digits`` digits. A cell with no seat inside is a boundary itself."""
    done = {}
    while True:
        done |= {k: (p, 0, 0) for k, (p, before, _) in edges.items() if before == seats[k]}
        edges = {k: e for k, e in edges.items() if k not in done}
        if not edges or digits >= total:
            break
        finer = total if max(n for _, _, n in edges.values()) <= single_task_rows else min(digits + DIGITS, total)
        inside = _by_class(rows, label_col, {k: (p,) for k, (p, _, _) in edges.items()}, "_up string").where(
            F.substring("_o", 1, digits) == F.col("_up"))
        goals = {k: (before, seats[k]) for k, (_, before, _) in edges.items()}
        if sum(n for _, _, n in edges.values()) <= min(COLLECTED_CELLS, single_task_rows):
            # So few rows, counted before, that their orders alone are taken.
            held = Counter(tuple(r) for r in inside.select(label_col, "_o").collect())
            edges, digits = _edges_of_rows([(*k, n) for k, n in held.items()], goals), total
            break
        cells = inside.groupBy(label_col, F.substring("_o", 1, finer).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
        edges = _edges(cells, label_col, goals)
        digits = finer
    return done | {k: (p, seats[k] - before, n) for k, (p, before, n) in edges.items()}


def assign_split(df: DataFrame, label_col: str, keys: str | Sequence[str], test_size: float | int = 0.2,
                 seed: int = 42, split_col: str = "split", single_task_rows: int = SINGLE_TASK_ROWS,
                 max_classes: int | None = None, unlabelled: str = "error") -> DataFrame:
    """All rows of ``df`` plus ``split_col`` = 'train' / 'test'. At most ``single_task_rows`` rows of a class are
    ordered in one task. ``unlabelled='keep'`` leaves rows without a label on no side (null); they count nowhere."""
    return split_with_sizes(df, label_col, keys, test_size, seed, split_col, single_task_rows, max_classes, unlabelled)[0]


def split_with_sizes(df: DataFrame, label_col: str, keys: str | Sequence[str], test_size: float | int = 0.2,
                     seed: int = 42, split_col: str = "split", single_task_rows: int = SINGLE_TASK_ROWS,
                     max_classes: int | None = None, unlabelled: str = "error") -> tuple[DataFrame, dict]:
    """``assign_split`` and the per-class (train, test) sizes it enforces."""
    if unlabelled not in ("error", "keep"):
        raise ValueError(f"unlabelled must be 'error' or 'keep', got {unlabelled!r}")
    keys = normalize_keys(keys)
    order = split_order_hash(keys, seed)
    # The passes that find the boundary read the label and the keys only.
    ordered = df.select(label_col, order.alias("_o"))
    if unlabelled == "keep":
        ordered = ordered.where(F.col(label_col).isNotNull())
    cells = ordered.groupBy(label_col, F.substring("_o", 1, DIGITS).alias("_p")).agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        few = [tuple(r) for r in cells.limit(COLLECTED_CELLS + 1).collect()]
        if len(few) <= COLLECTED_CELLS:
            counts: dict = {}
            for label, _, n in few:
                counts[label] = counts.get(label, 0) + n
            if max_classes is not None and len(counts) > max_classes:
                raise ValueError(f"more than {max_classes} classes in {label_col!r}")
        else:
            counts = class_counts(cells, label_col, "n", max_classes)
        sizes = split_sizes(counts, test_size)
        goals = {k: (0, t) for k, (t, _) in sizes.items()}
        edges = _edges_of_rows(few, goals) if len(few) <= COLLECTED_CELLS else _edges(cells, label_col, goals)
    finally:
        cells.unpersist()
    seats = {k: t for k, (t, _) in sizes.items()}
    bounds = _boundaries(ordered, label_col, edges, seats, DIGITS, MD5_DIGITS, single_task_rows)
    bounds |= {k: (PAST_ALL, 0, 0) for k in sizes if k not in bounds}  # no test seats

    # Rows of one boundary key on both sides: their whole rows decide, by a second boundary among them.
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # The row hash as 16 hex digits in its numeric order (the sign bit flipped).
    row_hex = F.lower(F.lpad(F.hex(row.bitwiseXOR(F.lit(-(2**63)).cast("long"))), ROW_DIGITS, "0"))
    shared = {k: (b, t) for k, (b, t, n) in bounds.items() if 0 < t < n}
    inner = {}
    if shared:
        tied = _by_class(df, label_col, {k: (b,) for k, (b, _) in shared.items()}, "_bound string").where(
            order == F.col("_bound")).select(label_col, row_hex.alias("_o"))
        inner = _boundaries(tied, label_col, {k: ("", 0, bounds[k][2]) for k in shared}, {k: t for k, (_, t) in shared.items()},
                            0, ROW_DIGITS, single_task_rows)
    facts = {}
    for k, (bound, taken, n) in bounds.items():
        rows_bound, rows_taken, copies = inner.get(k, (PAST_ALL if n and taken == n else "", 0, 0))
        if copies and rows_taken == copies:
            rows_bound, rows_taken, copies = rows_bound + "g", 0, 0  # all copies of the row are train
        facts[k] = (bound, rows_bound, rows_taken, copies)
    marked = _by_class(df, label_col, {k: f[:2] for k, f in facts.items()}, "_bound string, _row_bound string")
    tie = row_hex < F.col("_row_bound") if inner else F.col("_row_bound") != ""
    train = (order < F.col("_bound")) | ((order == F.col("_bound")) & tie)
    side = F.when(F.col(label_col).isNull(), F.lit(None).cast("string")).when(train, F.lit(TRAIN)).otherwise(F.lit(TEST))
    cols = [*[F.col(f"`{c}`") for c in df.columns], F.col(split_col)]
    across = {k: (b, r, t, c) for k, (b, r, t, c) in facts.items() if c}
    if not across:
        return marked.withColumn(split_col, side).select(*cols), sizes
    copy = (order == F.col("_bound")) & (row_hex == F.col("_row_bound"))
    clear = marked.where(~F.coalesce(copy, F.lit(False))).withColumn(split_col, side)
    close = _by_class(df, label_col, across, "_bound string, _row_bound string, _need long, _copies long").where(copy)
    numbered = _numbered_copies(close, label_col, max(c for _, _, _, c in across.values()) <= single_task_rows)
    decided = numbered.withColumn(split_col, F.when(F.col("_rank") <= F.col("_need"), F.lit(TRAIN)).otherwise(F.lit(TEST)))
    return clear.select(*cols).unionByName(decided.select(*cols)), sizes


def _numbered_copies(close: DataFrame, label_col: str, one_task: bool) -> DataFrame:
    """``close`` (copies of one row per class) with ``_rank`` from 1: in one task when proven few, else across
    partitions of the written rows."""
    if one_task:
        return close.withColumn("_rank", F.row_number().over(Window.partitionBy(label_col).orderBy("_need")))
    scratch_root(close.sparkSession)
    close = close.checkpoint(eager=True).withColumn("_part", F.spark_partition_id())
    per_part = close.groupBy(label_col, "_part").count()
    w = Window.partitionBy(label_col).orderBy("_part")  # a row per partition and class
    offsets = per_part.select(label_col, "_part", (F.sum("count").over(w) - F.col("count")).alias("_off"))
    copy = F.row_number().over(Window.partitionBy(label_col, "_part").orderBy("_need"))
    return close.join(offsets, [label_col, "_part"]).withColumn("_rank", F.col("_off") + copy)
