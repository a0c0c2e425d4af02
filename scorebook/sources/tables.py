"""Sources (S1-S8): catalog tables, paths in a given format, CSV ingest, id ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (qualified) name; lazy, so filters and column pruning reach the scan."""
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A path in a configured format."""
    return spark.read.format(fmt).load(path)


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver-generated tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, timestamp_format: str | None = None) -> DataFrame:
    """Raw CSV with a header and an explicit schema (no inference pass over the data)."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def id_range(spark: SparkSession, n: int, start: int = 0) -> DataFrame:
    """``id`` from ``start`` to ``start + n - 1``, generated in parallel on the executors."""
    return spark.range(start, start + n)
