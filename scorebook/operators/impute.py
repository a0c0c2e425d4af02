"""Exact-median imputation (M2) as a persistable ``pyspark.ml`` Estimator.

``Imputer`` in Spark ML uses an approximate quantile (2.0 for 1, 2, 10, 20 where the median is 6.0), and the
exact ``median`` aggregate merges one value->count map per column in a single task. So the built-in runs
only while a sketch proves the distinct values few; beyond that a sketch brackets the middle rank, one pass
counts what lies below, and only the values inside the bracket are shuffled and ranked. NaN and null both count
as missing.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.operators.ranks import SINGLE_TASK_ROWS, prefix_sums


def _value(c: str):
    v = F.col(f"`{c}`").cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


# The bracket around the middle rank, as quantiles; the sketch's error (1 / ACCURACY) is far smaller.
BRACKET = (0.498, 0.502)
ACCURACY = 10_000
VALUES_PER_BUCKET = 250_000


def exact_medians(df: DataFrame, cols: Sequence[str], buckets: int | None = None,
                  single_task_rows: int = SINGLE_TASK_ROWS) -> dict[str, float | None]:
    """Interpolated median of each column (as Spark's ``percentile(c, 0.5)``), ignoring null and NaN.
    A column with no value gives None.

    While all columns together hold at most ``single_task_rows`` distinct values, the built-in exact
    ``median`` runs (its final merge holds one value->count map per column, bounded by that count); otherwise
    the bracketed path below runs. The bound comes from the row count when that suffices, else from a sketch.
    Every pass reads ``df`` again: keep it, or let ``ExactMedianImputer`` do so."""
    cols = list(cols)
    if not cols:
        return {}
    bounded = df.count() * len(cols) <= single_task_rows
    if not bounded:
        # One pass: per column a distinct-count sketch and a quantile sketch (merged map-side).
        quantiles = F.array(*[F.lit(q) for q in BRACKET])
        sizes = df.agg(*[x for i, c in enumerate(cols) for x in (
            F.approx_count_distinct(_value(c), 0.02).alias(f"d{i}"),
            F.percentile_approx(_value(c), quantiles, ACCURACY).alias(f"q{i}"))]).first()
        bounded = sum(sizes[f"d{i}"] for i in range(len(cols))) * 1.1 <= single_task_rows
    if bounded:
        row = df.agg(*[F.median(_value(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        return {c: row[f"m{i}"] for i, c in enumerate(cols)}
    brackets = {c: sizes[f"q{i}"] for i, c in enumerate(cols) if sizes[f"q{i}"]}
    return {c: None for c in cols} | (_bracketed_medians(df, brackets, buckets) if brackets else {})


def _bracketed_medians(df: DataFrame, brackets: dict[str, list[float]], buckets: int | None) -> dict[str, float | None]:
    """Exact middle ranks: one pass counts the values below and inside each bracket, and only the values inside
    (about 1 in 250) are counted per value and ranked. A middle rank outside its bracket (a sketch gone wrong)
    falls back to the whole range."""
    cols = list(brackets)
    facts = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(_value(c)).alias(f"n{i}"), F.count_if(_value(c) < brackets[c][0]).alias(f"b{i}"),
        F.count_if(_value(c).between(*brackets[c])).alias(f"w{i}"))]).first()
    limits, below = {}, {}
    for i, c in enumerate(cols):
        middle = ((facts[f"n{i}"] - 1) // 2, facts[f"n{i}"] // 2)
        held = facts[f"b{i}"] <= middle[0] and middle[1] < facts[f"b{i}"] + facts[f"w{i}"]
        limits[c], below[c] = (brackets[c], facts[f"b{i}"]) if held else ([float("-inf"), float("inf")], 0)
    stacked = df.select(F.explode(F.filter(
        F.array(*[F.when(_value(c).between(*limits[c]), F.struct(F.lit(i).alias("i"), _value(c).alias("value")))
                  for i, c in enumerate(cols)]), lambda s: s.isNotNull())).alias("s")).select("s.i", "s.value")
    counted = stacked.groupBy("i", "value").agg(F.count(F.lit(1)).alias("cnt"))
    inside = sum(facts[f"w{i}"] for i in range(len(cols)))
    ranked = prefix_sums(counted, ["value"], {"cnt": F.col("cnt")}, ["i"], known_groups=len(cols),
                         buckets=buckets or max(8, math.ceil(inside / VALUES_PER_BUCKET)))
    base = spark_values(df, [(i, below[c], (facts[f"n{i}"] - 1) // 2, facts[f"n{i}"] // 2) for i, c in enumerate(cols)])
    at = ranked.join(base, "i").withColumn("first", F.col("below") + F.col("cnt_before"))
    covers = lambda r: (F.col("first") <= F.col(r)) & (F.col("first") + F.col("cnt") > F.col(r))
    picked = at.where(covers("lo") | covers("hi")).groupBy("i").agg(
        F.max(F.when(covers("lo"), F.col("value"))).alias("v_lo"), F.max(F.when(covers("hi"), F.col("value"))).alias("v_hi"))
    # As percentile does: half of each of the two middle values, or the one middle value itself.
    return {cols[r["i"]]: r["v_lo"] if r["v_lo"] == r["v_hi"] else 0.5 * r["v_lo"] + 0.5 * r["v_hi"] for r in picked.collect()}


def spark_values(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, "i int, below long, lo long, hi long")


class ExactMedianImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "learnt median per input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, medians: list[float] | None = None):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = {}
        for c, m in zip(self.getInputCols(), self.getOrDefault(self.medians)):
            v = F.col(f"`{c}`").cast("double")
            fills[c] = F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(float(m)))
        return dataset.withColumns(fills)


class ExactMedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns exact medians of ``inputCols``; the model fills null and NaN with them (columns become double). The
    input is computed once: its ``inputCols`` are persisted for the passes, unless ``keepInput`` is off because the
    caller keeps them."""

    keepInput = Param(Params._dummy(), "keepInput", "persist the input columns during the fit", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, keepInput: bool = True):
        super().__init__()
        self._setDefault(keepInput=True)
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> ExactMedianImputerModel:
        cols = self.getInputCols()
        read = dataset.select(*[F.col(f"`{c}`") for c in cols])
        if not self.getOrDefault(self.keepInput):
            medians = exact_medians(read, cols)
        else:
            read = read.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                medians = exact_medians(read, cols)
            finally:
                read.unpersist()
        empty = [c for c, m in medians.items() if m is None]
        if empty:
            raise ValueError(f"column(s) {empty} have no value in the training data; cannot learn a median")
        return ExactMedianImputerModel(inputCols=cols, medians=[medians[c] for c in cols])
