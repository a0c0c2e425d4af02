"""Category dictionaries and feature vectors (M3, M4) that never pass through the driver.

A ``StringIndexer`` brings every distinct value of a column to the driver, and the assembler writes one attribute per
vector position into the schema. Here the distinct values of all text columns are ranked on the executors and written
as a table (column, value, index). Rows find their index by a join: broadcast below a byte bound that the fit has
measured, shuffled beyond it. The sparse vector is built from the indexes by built-in functions. The model holds
the number of values per column and the place of its dictionary; the dictionary is saved with it.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.operators.ranks import SINGLE_TASK_ROWS, exact_ranks, range_partitions, range_ranks
from scorebook.session import scratch_path

BROADCAST_BYTES = 16 << 20  # of one column's dictionary
DENSE_POSITIONS = 64  # vectors up to this width are dense
ENTRY_BYTES = 64  # of a dictionary row beside its value, as held by a hash join


def write_dictionary(df: DataFrame, cols: list[str], single_task_rows: int = SINGLE_TASK_ROWS) -> str:
    """Folder of the table (col, value, idx): the distinct non-null values of each column (by its place in ``cols``)
    with their index in ascending order. Values are deduplicated map-side first; a column with more values than one task should
    order is ranked over a range partitioning."""
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(cols)])).alias("s"))
    distinct = values.select("s.col", "s.value").where("value is not null").distinct().persist()
    try:
        counts = distinct.groupBy("col").count().agg(F.max("count"), F.sum("count")).first()
        largest, total = counts[0] or 0, counts[1] or 0
        if largest <= single_task_rows:
            ranked = exact_ranks(distinct, ["value"], ["col"], largest_group=largest, single_task_rows=single_task_rows)
        else:
            ranked = range_ranks(distinct, ["value"], ["col"], partitions=range_partitions(total))
        path = scratch_path(df.sparkSession, "dictionary")
        ranked.select("col", "value", F.col("rank").cast("long").alias("idx")).write.partitionBy("col").parquet(path)
    finally:
        distinct.unpersist()
    return path


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, idx long, col int").parquet(path)


def sparse_vector(size: int, numeric: list[Column], hot: list[Column]) -> Column:
    """A vector of ``size``: the numeric columns first, then 1.0 at each position of ``hot`` that is not null. A narrow one
    is made of an array of all its positions. A wide one's fields are written as text and read back as a vector, all by
    built-in functions: there is no cast from a structure to a vector."""
    if size <= DENSE_POSITIONS:
        at = F.array(*[F.coalesce(h.cast("int"), F.lit(-1)) for h in hot]) if hot else F.array().cast("array<int>")
        places = F.array(*[F.lit(p) for p in range(len(numeric), size)]).cast("array<int>")
        ones = F.transform(places, lambda p: F.array_contains(at, p).cast("double"))
        return array_to_vector(F.concat(F.array(*[n.cast("double") for n in numeric]).cast("array<double>"), ones))
    places = F.concat_ws(",", *[F.lit(str(i)) for i in range(len(numeric))], *[h.cast("string") for h in hot])
    values = F.concat_ws(",", *[n.cast("double").cast("string") for n in numeric], *[F.when(h.isNotNull(), "1.0") for h in hot])
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":['), places, F.lit('],"values":['), values, F.lit("]}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]), {"mode": "FAILFAST"}).getField("v")


class _Columns(HasInputCols, HasOutputCol):
    """``inputCols`` are text columns, ``numericCols`` complete double columns; ``outputCol`` is the vector."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns, first in the vector", TypeConverters.toListString)

    def numeric(self) -> list[str]:
        return self.getOrDefault(self.numericCols)


class _DictionaryWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        model = self.instance
        if model.getInputCols():
            read_dictionary(model.session(), model.getOrDefault(model.place)).write.partitionBy("col").parquet(f"{path}/dictionary")


class _DictionaryReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(place=f"{path}/dictionary")


class FeatureEncoderModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    place = Param(Params._dummy(), "place", "folder of the dictionary", TypeConverters.toString)
    widths = Param(Params._dummy(), "widths", "number of values per text column", TypeConverters.toListInt)
    sizes = Param(Params._dummy(), "sizes", "bytes of each text column's dictionary", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, numericCols=None, outputCol=None, place=None, widths=None, sizes=None):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**kwargs)

    @staticmethod
    def session() -> SparkSession:
        return SparkSession.active()

    def write(self):
        return _DictionaryWriter(self)

    @classmethod
    def read(cls):
        return _DictionaryReader(cls)

    def width(self) -> int:
        return len(self.numeric()) + sum(self.getOrDefault(self.widths))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, widths = self.getInputCols(), self.getOrDefault(self.widths)
        out, hot, start = dataset, [], len(self.numeric())
        for i, c in enumerate(cols):
            entries = read_dictionary(dataset.sparkSession, self.getOrDefault(self.place)).where(F.col("col") == i)
            side = entries.select(F.col("value").alias(f"__sb_value{i}"), (F.col("idx") + start).alias(f"__sb_at{i}"))
            if self.getOrDefault(self.sizes)[i] <= BROADCAST_BYTES:
                side = F.broadcast(side)
            out = out.join(side, F.col(f"`{c}`").cast("string") == F.col(f"__sb_value{i}"), "left")  # a value is there once
            hot.append(F.col(f"__sb_at{i}"))
            start += widths[i]
        vector = sparse_vector(self.width(), [F.col(f"`{n}`") for n in self.numeric()], hot)
        kept = [F.col(f"`{c}`") for c in dataset.columns if c != self.getOutputCol()]
        return out.select(*kept, vector.alias(self.getOutputCol()))


class FeatureEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the dictionary of ``inputCols``. Any number of values is allowed unless ``maxCategories`` bounds it
    (``names`` are what an error calls the columns); a value unseen at fit time, or a null, is nowhere in the vector."""

    maxCategories = Param(Params._dummy(), "maxCategories", "most values of a column; 0: any number", TypeConverters.toInt)
    names = Param(Params._dummy(), "names", "names of inputCols in messages", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, numericCols=None, outputCol=None, maxCategories=0, names=None):
        super().__init__()
        self._setDefault(maxCategories=0)
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> FeatureEncoderModel:
        cols, most = self.getInputCols(), self.getOrDefault(self.maxCategories)
        place, widths, sizes = "", [], []
        if cols:
            place = write_dictionary(dataset, cols)
            entries = read_dictionary(dataset.sparkSession, place)
            bytes_ = F.sum(F.octet_length("value") + ENTRY_BYTES)
            facts = {r["col"]: r for r in entries.groupBy("col").agg(F.count("*").alias("n"), bytes_.alias("bytes")).collect()}
            widths = [facts[i]["n"] if i in facts else 0 for i in range(len(cols))]
            sizes = [min(facts[i]["bytes"], 2**31 - 1) if i in facts else 0 for i in range(len(cols))]
            names = self.getOrDefault(self.names) if self.isDefined(self.names) else cols
            wide = [n for n, w in zip(names, widths) if most and w > most]
            if wide:
                raise ValueError(f"column(s) {wide} have more than {most} categories")
        return FeatureEncoderModel(inputCols=cols, numericCols=self.numeric(), outputCol=self.getOutputCol(),
                                   place=place, widths=widths, sizes=sizes)
