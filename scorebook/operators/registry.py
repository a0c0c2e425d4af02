"""Model selection over a versions table (R1-R8), for all model names at once.

``versions(name, version, run_id, stage, last_updated)`` and ``runs(run_id, metrics map<string,double>,
conf string)`` are ordinary tables. Every decision is an aggregation or a join keyed by model name, so one
busy model name never lands whole in one task (``max_by`` merges partial results map-side).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any, Mapping, Sequence
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.config import ARCHIVED, NO_STAGE, PRODUCTION
from scorebook.operators.ranks import SINGLE_TASK_ROWS, exact_ranks, range_partitions, range_ranks

VERSIONS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
])
RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("conf", T.StringType()),
])
METRIC = "test_accuracy"


def number_versions(df: DataFrame, name_col: str, order_cols: str | Sequence[str],
                    single_task_rows: int = SINGLE_TASK_ROWS, partitions: int | None = None) -> DataFrame:
    """Version = 1 + position of the row among its name's rows in ``order_cols`` order (a total order inside
    a name). One small count per name decides: while every name has few rows, one window task per name;
    otherwise exact ranks over a range partitioning of (name, order), which spreads a busy name and a
    repeated order value (many runs of one name with one timestamp) over many tasks."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    sizes = df.groupBy(name_col).count().agg(F.count(F.lit(1)).alias("g"), F.max("count").alias("m"),
                                             F.sum("count").alias("n")).first()
    largest, groups, rows = (sizes["m"] or 0), (sizes["g"] or 0), (sizes["n"] or 0)
    if largest <= single_task_rows:
        ranked = exact_ranks(df, order_cols, [name_col], largest_group=largest, single_task_rows=single_task_rows)
    else:
        ranked = range_ranks(df, order_cols, [name_col], partitions or range_partitions(rows), known_groups=groups)
    return ranked.withColumn("version", (F.col("rank") + 1).cast("long")).drop("rank", "rank_total")


def run_metric(runs: DataFrame, metric: str = METRIC) -> DataFrame:
    """(run_id, metric value), 0.0 where the run lacks it."""
    return runs.select("run_id", F.coalesce(F.col("metrics")[metric], F.lit(0.0)).alias("metric"))


def register(versions: DataFrame, new_runs: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """New rows ``(name, version, run_id, stage, last_updated)``; version continues after the name's
    highest one (1 for a new name). ``new_runs`` has ``name, run_id, last_updated``; several runs of one
    name in one batch get consecutive versions in (last_updated, run_id) order, numbered like
    ``number_versions`` (a busy name is cut into buckets, not one window task)."""
    latest = versions.groupBy("name").agg(F.max("version").alias("_max"))
    runs = new_runs.select("name", "run_id", F.col("last_updated").cast("timestamp").alias("last_updated"))
    numbered = number_versions(runs, "name", ["last_updated", "run_id"], single_task_rows)
    return (
        numbered.join(latest, on="name", how="left")
        .select(
            "name",
            (F.coalesce(F.col("_max"), F.lit(0)) + F.col("version")).cast("long").alias("version"),
            "run_id",
            F.lit(NO_STAGE).alias("stage"),
            "last_updated",
        )
    )


def champions(versions: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Per name, the version in ``stage`` with the latest ``last_updated`` (then highest version)."""
    best = F.max_by(F.struct("version", "run_id", "last_updated"), F.struct("last_updated", "version"))
    return (
        versions.where(F.col("stage") == stage)
        .groupBy("name")
        .agg(best.alias("c"))
        .select("name", F.col("c.version").alias("champion_version"), F.col("c.run_id").alias("champion_run_id"))
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """The candidate of each name: its highest version."""
    best = F.max_by(F.struct("version", "run_id"), F.col("version"))
    return versions.groupBy("name").agg(best.alias("c")).select(
        "name", F.col("c.version").alias("candidate_version"), F.col("c.run_id").alias("candidate_run_id")
    )


def promotion_decisions(versions: DataFrame, runs: DataFrame, candidates: DataFrame | None = None,
                        metric: str = METRIC) -> DataFrame:
    """Promote when the name has no champion, or when the candidate's metric is strictly higher.
    A promotion over an existing champion archives every other production version."""
    cands = candidates if candidates is not None else latest_versions(versions)
    scores = run_metric(runs, metric)
    cand_score = scores.select(F.col("run_id").alias("candidate_run_id"), F.col("metric").alias("candidate_metric"))
    champ_score = scores.select(F.col("run_id").alias("champion_run_id"), F.col("metric").alias("champion_metric"))
    out = (
        cands.join(champions(versions), on="name", how="left")
        .join(cand_score, on="candidate_run_id", how="left")
        .join(champ_score, on="champion_run_id", how="left")
        .withColumn("candidate_metric", F.coalesce("candidate_metric", F.lit(0.0)))
        .withColumn("champion_metric", F.when(F.col("champion_version").isNotNull(),
                                              F.coalesce("champion_metric", F.lit(0.0))))
    )
    promote = F.col("champion_version").isNull() | (F.col("candidate_metric") > F.col("champion_metric"))
    return out.select(
        "name", "candidate_version", "candidate_run_id", "candidate_metric",
        "champion_version", "champion_run_id", "champion_metric",
        promote.alias("promote"),
        (promote & F.col("champion_version").isNotNull()).alias("archive"),
    )


def apply_promotion(versions: DataFrame, decisions: DataFrame) -> DataFrame:
    """The versions table after the decisions: the promoted candidate becomes Production; with a former
    champion, every other Production version of that name becomes Archived."""
    d = decisions.select("name", "candidate_version", "promote", "archive")
    joined = versions.join(d, on="name", how="left")
    stage = (
        F.when(F.col("promote") & (F.col("version") == F.col("candidate_version")), F.lit(PRODUCTION))
        .when(F.col("archive") & (F.col("stage") == PRODUCTION), F.lit(ARCHIVED))
        .otherwise(F.col("stage"))
    )
    return joined.select("name", "version", "run_id", stage.alias("stage"), "last_updated")


def resolve_stage(versions: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Per name, the newest version in ``stage``."""
    best = F.max_by(F.struct("version", "run_id"), F.col("version"))
    return versions.where(F.col("stage") == stage).groupBy("name").agg(best.alias("c")).select(
        "name", F.lit(stage).alias("stage"), F.col("c.version").alias("version"), F.col("c.run_id").alias("run_id")
    )


def conf_json(conf: Mapping[str, Any] | None, allowed: Sequence[str]) -> str:
    """The run's configuration, allow-listed keys only (no environment dump)."""
    return json.dumps({k: conf[k] for k in allowed if conf and k in conf}, sort_keys=True, default=str)


class Conflict(RuntimeError):
    """Another job committed first."""


KEPT_VERSIONS = 10  # snapshots of the versions that stay on disk, so that a slow reader can finish
ATTEMPTS = 20


@dataclass
class Registry:
    """Versions, runs and model artifacts under one shared folder.

    The versions are a log of snapshots: commit n is a file ``_log/n`` that names the snapshot's folder, created in
    one atomic step (``create_once``). A change reads commit n, writes its snapshot and tries to create n + 1; where
    another job was first, it starts again from that job's commit, so no version is lost or numbered twice. The table
    ``model_versions`` points at the latest commit for SQL readers. A run is a folder of its own: jobs that log runs at
    once never share one, and a repeated run replaces itself. A log that vanished is an error, never an empty history."""

    spark: SparkSession
    database: str
    root: str

    def __post_init__(self):
        from scorebook.sources.catalog import ensure_database, path_exists

        ensure_database(self.spark, self.database)
        if not path_exists(self.spark, self._log()):
            if self.spark.catalog.tableExists(self._table()) or path_exists(self.spark, f"{self.root}/model_runs"):
                raise RuntimeError(f"the log of versions under {self._log()} is gone")
            self._make(self._log())
            self._make(f"{self.root}/model_runs")
            try:
                self._commit(self.spark.createDataFrame([], VERSIONS_SCHEMA), 0)
            except Conflict:  # another job has just created the registry
                pass
        self._point()

    def _table(self) -> str:
        return f"{self.database}.model_versions"

    def _log(self) -> str:
        return f"{self.root}/model_versions/_log"

    def _make(self, folder: str) -> None:
        from scorebook.sources.catalog import _file_system

        fs, p = _file_system(self.spark, folder)
        fs.mkdirs(p)

    def _latest(self) -> tuple[int, str]:
        """(number, snapshot folder) of the latest commit."""
        from scorebook.sources.catalog import _file_system, path_exists, read_small

        if not path_exists(self.spark, self._log()):
            raise RuntimeError(f"the log of versions under {self._log()} is gone; restore it before registering or resolving models")
        fs, p = _file_system(self.spark, self._log())
        numbers = [int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()]
        if not numbers:
            raise RuntimeError(f"the log of versions under {self._log()} is gone: it holds no commit")
        return max(numbers), read_small(self.spark, f"{self._log()}/{max(numbers):020d}")

    def _commit(self, df: DataFrame, base: int) -> None:
        """Write ``df`` as commit ``base + 1``; ``Conflict`` if there is one already."""
        from scorebook.sources.catalog import create_once, delete_path, prune_snapshots

        folder = f"{self.root}/model_versions/snapshot-{uuid.uuid4().hex[:12]}"
        df.write.parquet(folder)
        if not create_once(self.spark, f"{self._log()}/{base + 1:020d}", folder):
            delete_path(self.spark, folder)
            raise Conflict(f"commit {base + 1} of {self._log()} was made by another job")
        prune_snapshots(self.spark, f"{self.root}/model_versions", folder, KEPT_VERSIONS)

    def _point(self) -> None:
        """Let the table show the latest commit, also where two jobs set it at once."""
        from scorebook.sources.catalog import sql_string

        for _ in range(ATTEMPTS):
            number, folder = self._latest()
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in VERSIONS_SCHEMA.fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table()} ({columns}) USING parquet LOCATION {sql_string(folder)}")
            self.spark.sql(f"ALTER TABLE {self._table()} SET LOCATION {sql_string(folder)}")
            self.spark.catalog.refreshTable(self._table())
            if self._latest()[0] == number:
                return

    def versions(self) -> DataFrame:
        return self.spark.read.schema(VERSIONS_SCHEMA).parquet(self._latest()[1])

    def runs(self) -> DataFrame:
        from scorebook.sources.catalog import path_exists

        if not path_exists(self.spark, f"{self.root}/model_runs"):
            raise RuntimeError(f"the runs under {self.root}/model_runs are gone; restore them before registering or resolving models")
        return self.spark.read.schema(RUNS_SCHEMA).parquet(f"{self.root}/model_runs").select(*RUNS_SCHEMA.names)

    def model_path(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}/model"

    def signature(self, run_id: str) -> list[tuple[str, str, str]]:
        """(column, type, role) of the run's training rows."""
        stored = self.spark.read.schema("column string, type string, role string").json(f"{self.root}/runs/{run_id}/signature")
        return [tuple(r) for r in stored.collect()]  # a row per column

    def log_run(self, run_id: str, metrics: DataFrame, conf: str) -> None:
        """Write the run's row to its own folder; ``metrics`` is a one-row frame."""
        m = metrics.select(F.create_map(*[x for c in metrics.columns for x in (F.lit(c), F.col(c).cast("double"))]).alias("metrics"),
                           F.lit(conf).alias("conf"))
        m.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/model_runs/run_id={quote(run_id, safe='')}")

    def register_and_promote(self, name: str, run_id: str) -> DataFrame:
        """R1 + R5 + R6 in one commit: register ``run_id`` as the next version of ``name``, decide against the current
        champion and write the versions once; from the start again if another job commits meanwhile. Returns the
        decision row."""
        for _ in range(ATTEMPTS):
            base, folder = self._latest()
            try:
                after, decisions = self._decided(self.spark.read.schema(VERSIONS_SCHEMA).parquet(folder), name, run_id)
                self._commit(apply_promotion(after, decisions), base)
            except Conflict:
                continue
            self._point()
            return decisions
        raise Conflict(f"{ATTEMPTS} other commits came first; try again")

    def _decided(self, versions: DataFrame, name: str, run_id: str) -> tuple[DataFrame, DataFrame]:
        new = self.spark.range(1).select(F.lit(name).alias("name"), F.lit(run_id).alias("run_id"),
                                         F.current_timestamp().alias("last_updated"))
        row = register(versions, new).collect()  # one row
        registered = self.spark.createDataFrame(row, VERSIONS_SCHEMA)
        cand = registered.select("name", F.col("version").alias("candidate_version"),
                                 F.col("run_id").alias("candidate_run_id"))
        after = versions.unionByName(registered)
        found = promotion_decisions(after, self.runs(), cand)
        return after, self.spark.createDataFrame(found.collect(), found.schema)  # one row

    def resolved_run(self, name: str, stage: str = PRODUCTION) -> str:
        """The run of the newest version of ``name`` in ``stage``."""
        row = resolve_stage(self.versions().where(F.col("name") == name), stage).first()
        if row is None:
            raise LookupError(f"no version of {name!r} in stage {stage!r}")
        return row["run_id"]

    def resolve(self, name: str, stage: str = PRODUCTION) -> PipelineModel:
        """The newest version of ``name`` in ``stage``, loaded."""
        return PipelineModel.load(self.model_path(self.resolved_run(name, stage)))
