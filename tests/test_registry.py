"""Promotion rules over a versions table."""

import datetime as dt
import threading

import pytest

from pyspark.sql import functions as F

from scorebook.operators.registry import (
    RUNS_SCHEMA,
    Registry,
    VERSIONS_SCHEMA,
    apply_promotion,
    champions,
    number_versions,
    promotion_decisions,
    register,
    resolve_stage,
)
from scorebook.session import scratch_path, unique_name
from scorebook.sources.catalog import delete_path

T0 = dt.datetime(2024, 1, 1)


def _versions(spark, rows):
    return spark.createDataFrame([(n, v, r, s, T0 + dt.timedelta(hours=h)) for n, v, r, s, h in rows], VERSIONS_SCHEMA)


def _runs(spark, rows):
    return spark.createDataFrame([(r, m, None) for r, m in rows], RUNS_SCHEMA)


def _decide(spark, versions, runs):
    return {r.name: r for r in promotion_decisions(_versions(spark, versions), _runs(spark, runs)).collect()}


def test_first_model_is_promoted_without_archive(spark):
    d = _decide(spark, [("m", 1, "r1", "None", 0)], [("r1", {"test_accuracy": 0.5})])["m"]
    assert d.promote and not d.archive


def test_equal_candidate_not_promoted(spark):
    versions = [("m", 1, "r1", "Production", 0), ("m", 2, "r2", "None", 1)]
    d = _decide(spark, versions, [("r1", {"test_accuracy": 0.7}), ("r2", {"test_accuracy": 0.7})])["m"]
    assert not d.promote


def test_missing_champion_metric_counts_as_zero(spark):
    versions = [("m", 1, "r1", "Production", 0), ("m", 2, "r2", "None", 1)]
    d = _decide(spark, versions, [("r1", {}), ("r2", {"test_accuracy": 0.01})])["m"]
    assert d.champion_metric == 0.0 and d.promote and d.archive


def test_two_production_versions_latest_is_champion_both_archived(spark):
    versions = [("m", 1, "r1", "Production", 5), ("m", 2, "r2", "Production", 3), ("m", 3, "r3", "None", 9)]
    runs = [("r1", {"test_accuracy": 0.6}), ("r2", {"test_accuracy": 0.9}), ("r3", {"test_accuracy": 0.7})]
    vdf, rdf = _versions(spark, versions), _runs(spark, runs)
    champ = champions(vdf).first()
    assert champ.champion_version == 1  # latest last_updated, not highest metric
    applied = {r.version: r.stage for r in apply_promotion(vdf, promotion_decisions(vdf, rdf)).collect()}
    assert applied == {1: "Archived", 2: "Archived", 3: "Production"}
    assert resolve_stage(apply_promotion(vdf, promotion_decisions(vdf, rdf))).first().version == 3


def test_register_continues_versions(spark):
    vdf = _versions(spark, [("m", 1, "r1", "None", 0), ("m", 2, "r2", "None", 1)])
    new = spark.createDataFrame([("m", "r3", T0), ("n", "r4", T0)], "name string, run_id string, last_updated timestamp")
    got = {(r.name, r.version, r.stage) for r in register(vdf, new).collect()}
    assert got == {("m", 3, "None"), ("n", 1, "None")}


def test_register_busy_name_bucketed_equals_plain(spark):
    vdf = _versions(spark, [("m", 4, "r0", "None", 0)])
    new = spark.range(0, 2000).select(
        F.when(F.col("id") % 4 == 0, "n").otherwise("m").alias("name"),
        F.format_string("r%05d", (F.col("id") * 13) % 2000).alias("run_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 7)).alias("last_updated"))
    plain = {(r.name, r.run_id, r.version) for r in register(vdf, new).collect()}
    bucketed = {(r.name, r.run_id, r.version) for r in register(vdf, new, single_task_rows=0).collect()}
    assert plain == bucketed
    assert sorted(v for n, _, v in plain if n == "m") == list(range(5, 5 + 1500))
    assert sorted(v for n, _, v in plain if n == "n") == list(range(1, 1 + 500))
    # (last_updated, run_id) order: the first version of a name is its earliest run, ties by run id
    first_m = min((r for r in plain if r[0] == "m"), key=lambda r: r[2])
    assert first_m[1] == min(
        r.run_id for r in new.where("name = 'm'").where(F.col("last_updated") == F.lit(T0).cast("timestamp")).collect())


def test_number_versions_bucketed_equals_plain(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).cast("string").alias("name"), (F.col("id") * 7 % 3001).alias("eid"))
    plain = {(r.name, r.eid, r.version) for r in number_versions(df, "name", "eid").collect()}
    bucketed = {(r.name, r.eid, r.version) for r in number_versions(df, "name", "eid", single_task_rows=0).collect()}
    assert plain == bucketed
    assert max(v for _, _, v in plain) == 1000


def test_a_lost_table_is_an_error_not_an_empty_history(spark):
    db, root = unique_name("lost"), scratch_path(spark, "lost")
    registry = Registry(spark, db, root)
    registry.log_run("a", spark.createDataFrame([(0.9,)], "test_accuracy double"), "{}")
    first = registry.register_and_promote("m", "a").first()
    assert first.candidate_version == 1 and first.promote
    now = spark.sql("SELECT current_timestamp() AS t").first().t
    assert abs((registry.versions().first().last_updated - now).total_seconds()) < 600
    assert spark.table(f"{db}.model_versions").first().version == 1
    # The catalog entry is a pointer to the log: a dropped one comes back.
    spark.sql(f"DROP TABLE {db}.model_versions")
    assert Registry(spark, db, root).versions().count() == 1 and spark.table(f"{db}.model_versions").count() == 1
    delete_path(spark, f"{root}/model_versions/_log")
    with pytest.raises(RuntimeError, match="gone"):
        registry.register_and_promote("m", "a")
    with pytest.raises(RuntimeError, match="gone"):
        Registry(spark, db, root)


def test_two_jobs_at_once_get_consecutive_versions(spark):
    db, root = unique_name("both"), scratch_path(spark, "both")
    registry = Registry(spark, db, root)
    score = lambda v: spark.createDataFrame([(v,)], "test_accuracy double")
    registry.log_run("first", score(0.5), "{}")
    registry.register_and_promote("m", "first")
    jobs = {f"job{i}": 0.6 + i / 10 for i in range(4)}
    start, failed = threading.Barrier(len(jobs)), []

    def job(run_id, accuracy):
        try:
            own = Registry(spark, db, root)
            start.wait()
            own.log_run(run_id, score(accuracy), "{}")
            own.register_and_promote("m", run_id)
        except Exception as e:  # told to the test's own thread
            failed.append(e)

    threads = [threading.Thread(target=job, args=j) for j in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    rows = registry.versions().collect()
    assert sorted(r.version for r in rows) == [1, 2, 3, 4, 5] and {r.run_id for r in rows} == {"first", *jobs}
    assert [r.run_id for r in rows if r.stage == "Production"] == ["job3"]  # the best one, whatever the order
    assert registry.runs().count() == 5 and spark.table(f"{db}.model_versions").count() == 5


def test_a_job_that_lost_starts_from_the_other_commit(spark, monkeypatch):
    db, root = unique_name("lost"), scratch_path(spark, "race")
    mine, other = Registry(spark, db, root), Registry(spark, db, root)
    for run in ("a", "b"):
        mine.log_run(run, spark.createDataFrame([(0.5,)], "test_accuracy double"), "{}")
    decided, raced = mine._decided, []

    def slow(*args):
        out = decided(*args)
        if not raced:
            raced.append(other.register_and_promote("m", "b"))  # commits while this job has decided already
        return out

    monkeypatch.setattr(mine, "_decided", slow)
    row = mine.register_and_promote("m", "a").first()
    assert row.candidate_version == 2 and not row.promote  # decided again, against the other job's champion
    assert {(r.run_id, r.version, r.stage) for r in mine.versions().collect()} == {("b", 1, "Production"), ("a", 2, "None")}


def test_a_file_is_created_once(spark):
    from scorebook.sources.catalog import create_once, read_small

    path = scratch_path(spark, "once")
    assert create_once(spark, path, "mine") and not create_once(spark, path, "other")
    assert read_small(spark, path) == "mine"
