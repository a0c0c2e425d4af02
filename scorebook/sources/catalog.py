"""Sinks and catalog operations.

Every overwrite goes through ``replace_table``: a fresh snapshot folder first, then a swap of names, so a failed
write never loses the previous table, and a job may rewrite a table it reads from. Old snapshots are removed but
for the last ``KEPT_SNAPSHOTS``.
"""

from __future__ import annotations

import math
import uuid
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.config import FeatureTableConfig, LabelsTableConfig, normalize_keys


def sql_string(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """K8: create the database when absent. K9 (switching the current database) is not needed: names are
    always qualified, and session state is left alone."""
    where = f" LOCATION {sql_string(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    """K10."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def comment_table(spark: SparkSession, name: str, description: str | None) -> None:
    """K3: set the table comment; nothing when there is no description."""
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {sql_string(description)}")


def point_table(spark: SparkSession, name: str, location: str, fmt: str) -> None:
    """K5: (re)create ``name`` as an external table over ``location``."""
    drop_table(spark, name)
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION {sql_string(location)}")


def write_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> str:
    """K7 (and K4): write a frame to a path in a configured format."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def table_root(spark: SparkSession, location: str | None, name: str) -> str:
    """Root folder of a table's snapshots: the given one, else one under the warehouse (never the checkpoint
    folder, which Spark makes per application)."""
    base = location or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/external"
    return base.rstrip("/") + "/" + name.replace(".", "/")


# Snapshots of a table that stay on disk, the current one included: readers of the one before can finish.
KEPT_SNAPSHOTS = 2


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content in one atomic step; False where ``path`` is there already. The text
    goes to a file of its own first, which then gets the name: by a hard link on a local disk, by a rename that
    refuses to replace elsewhere (atomic where the file system's rename is)."""
    fs, p = _file_system(spark, path)
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    try:
        if fs.makeQualified(p).toUri().getScheme() == "file":
            place = lambda q: jvm.java.nio.file.Paths.get(fs.makeQualified(q).toUri())
            jvm.java.nio.file.Files.createLink(place(p), place(own))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(own, p, none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        if fs.exists(own):
            fs.delete(own, False)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def prune_snapshots(spark: SparkSession, root: str, current: str, keep: int = KEPT_SNAPSHOTS) -> None:
    """Remove the oldest ``snapshot-*`` folders under ``root`` but the newest ``keep`` and ``current``."""
    fs, p = _file_system(spark, root)
    found = [s for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("snapshot-")]
    found.sort(key=lambda s: s.getModificationTime(), reverse=True)
    for s in found[keep:]:
        if s.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]:
            fs.delete(s.getPath(), True)


def replace_table(spark: SparkSession, df: DataFrame, name: str, root: str, fmt: str = "parquet",
                  buckets: int | None = None, bucket_keys: Sequence[str] = (), partition_by: Sequence[str] = (),
                  keep: int = KEPT_SNAPSHOTS) -> str:
    """Overwrite table ``name`` so that a failure at any point keeps the old rows: write a fresh snapshot folder
    under ``root`` behind a staging table, rename the old table aside, the new one in, and only then drop the old
    entry. If the second rename fails, the old table gets its name back. The frame may read the table itself."""
    tag = uuid.uuid4().hex[:12]
    staging, aside, snapshot = f"{name}__new_{tag}", f"{name}__old_{tag}", f"{root}/snapshot-{tag}"
    writer = (df.repartition(buckets, *bucket_keys) if buckets else df).write.format(fmt).option("path", snapshot)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_keys).sortBy(*bucket_keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(staging)
    except Exception:
        drop_table(spark, staging)
        delete_path(spark, snapshot)
        raise
    swap_table(spark, staging, name, aside)
    prune_snapshots(spark, root, snapshot, keep)
    return name


def swap_table(spark: SparkSession, staging: str, name: str, aside: str) -> None:
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if had:
        drop_table(spark, aside)


# A bucket above this many times the mean bucket (and above a task's row bound) is oversized: "auto" bucketing
# is dropped, and a join input with such a bucket reads the feature table unbucketed.
MAX_BUCKET_SKEW = 2.0


def bucket_count(df: DataFrame, cfg: FeatureTableConfig) -> int | None:
    """The configured bucket count. For "auto": one bucket per ``cfg.rows_per_bucket`` rows, unless a key is so
    hot that one bucket would be oversized. A bucketed table cannot be split by AQE's skew join, so such a
    table is written unbucketed and the joins shuffle it. Costs a count and a histogram of bucket ids (bucket
    id = pmod(murmur3(keys), n), as Spark buckets; partial counts keep the shuffle at <= n rows per task)."""
    if cfg.buckets != "auto":
        return int(cfg.buckets) if cfg.buckets else None
    n_rows = df.count()
    n = max(cfg.min_buckets, math.ceil(n_rows / cfg.rows_per_bucket))
    if n_rows <= cfg.rows_per_bucket:  # no bucket can be oversized: skip the histogram
        return n
    bucket_id = F.pmod(F.hash(*[F.col(f"`{k}`") for k in cfg.keys]), F.lit(n))
    largest = df.groupBy(bucket_id.alias("b")).count().agg(F.max("count")).first()[0] or 0
    if largest > max(MAX_BUCKET_SKEW * n_rows / n, cfg.rows_per_bucket):
        return None
    return n


def table_layout(spark: SparkSession, name: str) -> dict[str, str]:
    """Catalog facts of a table (``Num Buckets``, ``Location``, ``Provider``...): a few rows of metadata."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] and not r["col_name"].startswith("#")}


def feature_side(spark: SparkSession, name: str, other: DataFrame, keys: Sequence[str],
                 rows_per_bucket: int = 5_000_000) -> DataFrame:
    """The feature table to join with ``other`` on ``keys``. Bucketed, the table is not shuffled for the join,
    but then each bucket of ``other`` is one task, and AQE cannot split a bucketed scan. So one pass counts
    ``other`` per bucket id (keys cast to the table's types, as the bucket hash depends on them; partial counts
    keep the shuffle at <= buckets rows per task). If one bucket would be oversized (a hot key), the table is
    read from its files without the bucket spec; both sides then shuffle and AQE splits the hot partition."""
    table = spark.table(name)
    layout = table_layout(spark, name)
    n = int(layout.get("Num Buckets", "0") or 0)
    if n <= 0:
        return table
    types = {f.name: f.dataType for f in table.schema.fields}
    bucket_id = F.pmod(F.hash(*[F.col(f"`{k}`").cast(types[k]) for k in keys]), F.lit(n))
    row = other.groupBy(bucket_id.alias("b")).count().agg(F.sum("count").alias("rows"),
                                                          F.max("count").alias("largest")).first()
    rows, largest = (row["rows"] or 0), (row["largest"] or 0)
    if largest > max(MAX_BUCKET_SKEW * rows / n, rows_per_bucket):
        return spark.read.format(layout.get("Provider", "parquet")).load(layout["Location"])
    return table


def write_feature_table(spark: SparkSession, df: DataFrame, cfg: FeatureTableConfig) -> str:
    """K1-K3, K8: overwrite the feature table (its schema may change), keyed by ``cfg.primary_keys``."""
    keys = cfg.keys
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"primary key column(s) {missing} not in the feature frame")
    ensure_database(spark, cfg.database_name)
    # Bucketed: one task per bucket (the shuffle hashes the keys as bucketing does), so each bucket is one file.
    replace_table(spark, df, cfg.name, table_root(spark, cfg.location, cfg.name), cfg.format,
                  bucket_count(df, cfg), keys)
    if not spark.catalog.tableExists(cfg.name):  # K2
        raise RuntimeError(f"table {cfg.name} was not created")
    comment_table(spark, cfg.name, cfg.description)
    return cfg.name


def write_labels_table(spark: SparkSession, df: DataFrame, cfg: LabelsTableConfig) -> str:
    """Overwrite the labels as an external table; ``cfg.path`` is the root of its snapshots."""
    if cfg.primary_keys is not None:
        normalize_keys(cfg.primary_keys)
    ensure_database(spark, cfg.database_name)
    return replace_table(spark, df, cfg.name, (cfg.path or table_root(spark, None, cfg.name)).rstrip("/"), cfg.format)


BATCH = "batch_id"  # partition column of predictions that are appended batch by batch


def write_predictions(spark: SparkSession, df: DataFrame, table: str, mode: str = "overwrite",
                      fmt: str = "parquet", location: str | None = None,
                      partition_by: Sequence[str] = (), batch_id: str | None = None) -> str:
    """K6: write predictions with ``mode`` append or overwrite. An overwrite is a fresh snapshot under ``location``
    (the table stays external there); an append adds files to the current one. Appending a different schema raises
    (Spark's own check).

    With ``batch_id`` the rows get it as a column, and the table is partitioned by it. An append then replaces the
    rows of its own batch and no others, so a job that failed half-way, or ran twice, can simply run again."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
    database = table.split(".")[0] if "." in table else None
    if database:
        ensure_database(spark, database)
    partition_by = list(partition_by)
    if batch_id is not None:
        if BATCH in df.columns:
            raise ValueError(f"the predictions have a column {BATCH!r} of their own")
        df, partition_by = df.withColumn(BATCH, F.lit(batch_id)), [BATCH, *partition_by]
    if mode == "append" and spark.catalog.tableExists(table):
        if batch_id is not None:
            return _append_batch(spark, df, table, batch_id)
        writer = df.write.format(fmt).mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        return table
    root = (location or table_root(spark, None, table)).rstrip("/")
    return replace_table(spark, df, table, root, fmt, partition_by=partition_by)


def _append_batch(spark: SparkSession, df: DataFrame, table: str, batch_id: str) -> str:
    """Replace the rows of one batch. Its partition is exchanged when the job commits, so a run that fails leaves the
    batch as it was (with partitions inside the batch, its rows go before the new ones are written)."""
    columns = spark.table(table).columns
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if BATCH not in parts:
        raise ValueError(f"table {table} is not partitioned by {BATCH!r}; write its first batch with a batch id")
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns {sorted(df.columns)} do not match those of table {table}: {sorted(columns)}")
    layout = table_layout(spark, table)
    rows = df.select(*[F.col(f"`{c}`").cast(spark.table(table).schema[c].dataType).alias(c) for c in columns])
    if len(parts) > 1 or df.isEmpty():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{BATCH}` = {sql_string(batch_id)})")
        # An external table keeps the files of a dropped partition.
        delete_path(spark, f"{layout['Location'].rstrip('/')}/{spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(BATCH, batch_id)}")
    rows.write.format(layout.get("Provider", "parquet")).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *parts).save(layout["Location"])
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    return table
