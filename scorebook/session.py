"""Session helpers: a local session for tests and bench, and the shared scratch folder.

Every intermediate table, model artifact and lineage cut lives under the folder the cluster names in
``spark.checkpoint.dir``. Only when the session has none (tests, a laptop) do we pick one ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "scorebook") -> SparkSession:
    """A local session with the settings the library expects (AQE on, UTC, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # A local session has one machine, whose temporary folder every task sees.
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="scorebook-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique identifier (database or table name)."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
