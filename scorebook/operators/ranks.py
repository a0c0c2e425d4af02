"""Exact running sums and ranks without a single-task window.

A plain ``sum(...) OVER (PARTITION BY g ORDER BY k)`` or ``row_number()`` puts a whole group in one task; a
binary label, one numeric column or one model name can hold a third of all rows. Here each group is cut into
ordered buckets instead:

1. every row gets a bucket that is monotone in the order (a caller-supplied expression such as a hash prefix,
   or approximate quantile bounds of the first order column, learnt per group in one aggregation pass);
2. bucket totals are a small table (groups x buckets rows); their running sum gives each bucket's offset;
3. the rows join their offset on (group, bucket) and a window per (group, bucket) adds the running sum
   inside the bucket; join and window share one shuffle, and each task holds whole buckets only.

The result is exact: offsets are exact counts and the order inside a bucket is the full order.

``range_ranks`` serves plain ranks where the order may hold long runs of one value (many runs of one model
name with one timestamp): Spark's range partitioning samples bounds of the whole composite key, so such a run
spans many partitions; positions come from the sorted partitions and a small per-partition offsets table.
Joins to the small tables are null-safe on the group, so a null group keeps its rows.
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.session import scratch_root

BUCKET = "_bucket"
GROUP = "_grp"
# A group proven to hold at most this many rows may be one window task (a bounded group); larger or
# unknown groups are cut into buckets.
SINGLE_TASK_ROWS = 1_000_000


def join_on_groups(rows: DataFrame, small: DataFrame, group_cols: Sequence[str], other: Sequence[str] = ()) -> DataFrame:
    """Inner join of ``rows`` to ``small`` on ``group_cols`` (null-safe: a null group is a group, and keeps its
    rows) and on the columns ``other`` (plain equality), keeping one copy of the join columns."""
    keys = [*group_cols, *other]
    side = small.select(*[F.col(f"`{c}`").alias(f"_j{i}") for i, c in enumerate(keys)],
                        *[c for c in small.columns if c not in keys])
    cond = [rows[f"`{c}`"].eqNullSafe(side[f"_j{i}"]) if c in group_cols else rows[f"`{c}`"] == side[f"_j{i}"]
            for i, c in enumerate(keys)]
    return rows.join(side, on=cond, how="inner").drop(*[f"_j{i}" for i in range(len(keys))])


def quantile_bucket(df: DataFrame, order_col: str, group_cols: Sequence[str], buckets: int,
                    known_groups: int | None = None) -> DataFrame:
    """Adds ``_bucket``: the number of approximate quantile bounds (per group) strictly below the value."""
    probs = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 4 * buckets)
    key = list(group_cols) or ["_all"]
    src = df if group_cols else df.withColumn("_all", F.lit(0))
    bounds = src.groupBy(*key).agg(
        F.array_distinct(F.percentile_approx(F.col(order_col), probs, accuracy)).alias("_bounds")
    ).withColumn("_coarse", F.filter(F.col("_bounds"), lambda b, i: i % CHUNK == 0))
    # One row per group, each an array of at most `buckets` numbers; AQE broadcasts it while it is small.
    out = src.join(bounds, on=key, how="inner").withColumn(
        BUCKET, count_below(F.col("_bounds"), F.col("_coarse"), F.col(order_col))
    )
    return out.drop("_bounds", "_coarse", *([] if group_cols else ["_all"]))


# Width of the chunks of sorted bounds that ``count_below`` scans.
CHUNK = 32


def count_below(bounds: Column, coarse: Column, value: Column) -> Column:
    """Number of elements of the ascending array ``bounds`` strictly below ``value``, where ``coarse`` holds every
    ``CHUNK``-th element of ``bounds`` (indices 0, CHUNK, ...). Equal to ``size(filter(bounds, b -> b < value))``
    but scans two short arrays per row instead of the whole one. With k chunks starting below the value, the
    first k - 1 chunks lie wholly below it and only chunk k - 1 needs a scan."""
    k = F.size(F.filter(coarse, lambda b: b < value))
    last = F.slice(bounds, (k - 1) * CHUNK + 1, CHUNK)
    return F.when(k == 0, F.lit(0)).otherwise((k - 1) * CHUNK + F.size(F.filter(last, lambda b: b < value)))


def prefix_sums(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    sums: Mapping[str, Column],
    group_cols: Sequence[str] = (),
    bucket: tuple[Column, int] | None = None,
    buckets: int = 1024,
    known_groups: int | None = None,
    largest_group: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """For every row add ``<name>_before``: the sum of ``sums[name]`` over the rows of its group that come
    strictly before it in ``order_cols`` (which must be a total order inside a group), and ``<name>_total``.

    ``bucket`` is (expression, number of buckets) with the expression monotone in the order; when None,
    ``buckets`` quantile buckets of the first order column are used. ``known_groups`` bounds the number of
    groups when the caller knows it (it bounds the broadcast quantile bounds). When the caller has proven
    ``largest_group <= single_task_rows``, a plain window per group is used (one bounded task per group).
    """
    group_cols = list(group_cols)
    if largest_group is not None and largest_group <= single_task_rows:
        return _plain_prefix_sums(df, order_cols, sums, group_cols)
    if group_cols and group_cols != [GROUP]:
        # One non-null struct column stands for the group: struct keys with null fields match in the joins, so
        # a null group keeps its rows, and the join and the window below still share one shuffle.
        grouped = df.withColumn(GROUP, F.struct(*[F.col(f"`{c}`") for c in group_cols]))
        out = prefix_sums(grouped, order_cols, sums, [GROUP], bucket, buckets, known_groups, None, single_task_rows)
        return out.drop(GROUP)
    if bucket is not None:
        staged = df.withColumn(BUCKET, bucket[0])
        buckets = bucket[1]
    else:
        first = order_cols[0]
        if not isinstance(first, str):
            raise TypeError("quantile buckets need the first order column by name")
        staged = quantile_bucket(df, first, group_cols, buckets, known_groups)

    value_cols = {name: f"_v_{name}" for name in sums}
    staged = staged.select("*", *[expr.alias(value_cols[name]) for name, expr in sums.items()])

    totals = staged.groupBy(*group_cols, BUCKET).agg(
        *[F.sum(F.col(v)).alias(f"_b_{name}") for name, v in value_cols.items()]
    )
    # Small table: one row per (group, non-empty bucket).
    over_buckets = Window.partitionBy(*group_cols).orderBy(BUCKET) if group_cols else Window.orderBy(BUCKET)
    running = over_buckets.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    offsets = totals.select(
        *group_cols,
        BUCKET,
        *[(F.sum(f"_b_{name}").over(running) - F.col(f"_b_{name}")).alias(f"_o_{name}") for name in sums],
        *[F.sum(f"_b_{name}").over(whole).alias(f"{name}_total") for name in sums],
    )
    # No broadcast: the window below needs the rows hash-partitioned by (group, bucket) anyway, so an
    # equi-join on those keys shares that single shuffle (the offsets side is small).
    joined = staged.join(offsets, on=[*group_cols, BUCKET], how="inner")

    inside = Window.partitionBy(*group_cols, BUCKET).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = joined.select(
        *[c for c in joined.columns if not c.startswith("_o_") and not c.startswith("_v_")],
        *[
            (F.sum(F.col(v)).over(inside) - F.col(v) + F.col(f"_o_{name}")).alias(f"{name}_before")
            for name, v in value_cols.items()
        ],
    )
    return out.drop(BUCKET)


def _plain_prefix_sums(df: DataFrame, order_cols, sums: Mapping[str, Column], group_cols: list[str]) -> DataFrame:
    spec = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    running = spec.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value_cols = {name: f"_v_{name}" for name in sums}
    staged = df.select("*", *[expr.alias(value_cols[name]) for name, expr in sums.items()])
    out = staged.select(
        *df.columns,
        *[(F.sum(F.col(v)).over(running) - F.col(v)).alias(f"{name}_before") for name, v in value_cols.items()],
        *[F.sum(F.col(v)).over(spec).alias(f"{name}_total") for name, v in value_cols.items()],
    )
    return out


def exact_ranks(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    group_cols: Sequence[str] = (),
    bucket: tuple[Column, int] | None = None,
    buckets: int = 1024,
    known_groups: int | None = None,
    largest_group: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Adds ``rank``: the 0-based position of each row inside its group (order must be total)."""
    out = prefix_sums(
        df, order_cols, {"rank": F.lit(1).cast("long")}, group_cols, bucket, buckets, known_groups,
        largest_group, single_task_rows,
    )
    return out.withColumnRenamed("rank_before", "rank")


def range_ranks(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (), partitions: int = 8,
                known_groups: int | None = None) -> DataFrame:
    """Adds ``rank`` (0-based position inside the group; the order must be total inside a group) and
    ``rank_total``, with no group and no repeated order value in one task.

    Rows are range-partitioned on (group, order). Spark samples bounds of that whole composite key, so a
    group holding a third of all rows, or one first-order value repeated many times, still spans many
    partitions. Inside a partition the rows are sorted, and ``monotonically_increasing_id`` gives each row's
    index (partition number in the upper bits). The sorted rows are checkpointed to the shared folder, so
    every later read sees the same indices. Then a small table, (group, partition) -> first index and row
    count with at most ``partitions + groups`` rows, gives each group's offset per partition. AQE joins it
    back without shuffling the rows while its measured size allows a broadcast.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = [*group_cols, *order_cols]
    scratch_root(df.sparkSession)  # the shared checkpoint folder
    laid = (df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
            .withColumn("_mid", F.monotonically_increasing_id())
            .checkpoint(eager=True))
    with_pos = laid.select("*", F.shiftright("_mid", 33).alias("_part"),
                           F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_idx"))
    stats = with_pos.groupBy(*group_cols, "_part").agg(F.min("_idx").alias("_first"),
                                                       F.count(F.lit(1)).alias("_n"))
    in_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    before = in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = stats.select(*group_cols, "_part", "_first",
                           (F.sum("_n").over(before) - F.col("_n")).alias("_off"),
                           F.sum("_n").over(in_group).alias("rank_total"))
    joined = join_on_groups(with_pos, offsets, group_cols, ["_part"])
    rank = (F.col("_off") + F.col("_idx") - F.col("_first")).cast("long").alias("rank")
    return joined.select(*df.columns, rank, F.col("rank_total").cast("long").alias("rank_total"))


def range_partitions(n_rows: int, rows_per_partition: int = 250_000, lo: int = 8) -> int:
    """Partitions for ``range_ranks`` so that one task sorts about ``rows_per_partition`` rows."""
    return int(max(lo, math.ceil(max(n_rows, 1) / rows_per_partition)))
