"""Sinks and catalog operations."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from scorebook.config import FeatureTableConfig, LabelsTableConfig
from scorebook.plans.pipelines import smoke
from scorebook.session import scratch_path, unique_name
from scorebook.sources.catalog import (
    ensure_database,
    replace_table,
    swap_table,
    table_layout,
    write_feature_table,
    write_labels_table,
    write_predictions,
)
from scorebook.sources.tables import id_range


def test_smoke_round_trip(spark):
    back = smoke(spark, id_range(spark, 1000), scratch_path(spark, "smoke"), "parquet")
    assert back.count() == 1000


def test_feature_table_overwrite_changes_schema_and_comment(spark):
    cfg = FeatureTableConfig(unique_name("ft"), "t", "k", description="it's a table")
    write_feature_table(spark, spark.createDataFrame([(1, 2.0)], "k long, x double"), cfg)
    comment = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {cfg.name}").collect() if r.col_name == "Comment"]
    assert comment and comment[0].data_type == "it's a table"
    # Overwrite from a frame that reads the table itself, with a new schema.
    again = spark.table(cfg.name).selectExpr("k", "x * 2 AS y")
    write_feature_table(spark, again, cfg)
    assert spark.table(cfg.name).columns == ["k", "y"]
    assert spark.table(cfg.name).first().y == 4.0


def test_feature_table_needs_key(spark):
    cfg = FeatureTableConfig(unique_name("ft"), "t", "missing")
    with pytest.raises(ValueError):
        write_feature_table(spark, spark.createDataFrame([(1,)], "k long"), cfg)


def test_labels_external_table(spark):
    cfg = LabelsTableConfig(unique_name("lb"), "labels", "y", "k", path=scratch_path(spark, "labels"))
    write_labels_table(spark, spark.createDataFrame([(1, 1), (2, 0)], "k long, y int"), cfg)
    kind = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {cfg.name}").collect() if r.col_name == "Type"]
    assert kind[0].data_type == "EXTERNAL"
    assert spark.table(cfg.name).count() == 2


def test_predictions_append_and_schema_mismatch(spark):
    table = f"{unique_name('pr')}.predictions"
    df = spark.createDataFrame([(1, 0)], "k long, prediction int")
    write_predictions(spark, df, table, "overwrite", location=scratch_path(spark, "pred"))
    write_predictions(spark, df, table, "append")
    assert spark.table(table).count() == 2
    with pytest.raises(AnalysisException):
        write_predictions(spark, spark.createDataFrame([(1, 0, 5)], "k long, prediction int, extra int"), table, "append")
    with pytest.raises(ValueError):
        write_predictions(spark, df, table, "merge")


def _failing(spark, schema):
    return spark.range(0, 50).selectExpr("id AS k", "if(id = 49, raise_error('stop'), cast(id as int)) AS y").to(schema)


def _table_of(spark, kind):
    """(name, write) of a table with rows (1, 1), (2, 0)."""
    db = unique_name("safe")
    if kind == "features":
        cfg = FeatureTableConfig(db, "t", "k", buckets=2)
        return cfg.name, lambda df: write_feature_table(spark, df, cfg)
    if kind == "labels":
        cfg = LabelsTableConfig(db, "t", "y", "k", path=scratch_path(spark, "labels"))
        return cfg.name, lambda df: write_labels_table(spark, df, cfg)
    location = scratch_path(spark, "pred")
    return f"{db}.t", lambda df: write_predictions(spark, df, f"{db}.t", "overwrite", location=location)


@pytest.mark.parametrize("kind", ["features", "labels", "predictions"])
def test_overwrites_are_safe(spark, kind):
    name, write = _table_of(spark, kind)
    write(spark.createDataFrame([(1, 1), (2, 0)], "k long, y int"))
    with pytest.raises(Exception, match="stop"):
        write(_failing(spark, spark.table(name).schema))
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, 1), (2, 0)}
    # From itself, then with another schema, each time external under its root.
    write(spark.table(name).where("y = 1"))
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 1)]
    write(spark.createDataFrame([(7, 0, "z")], "k long, y int, extra string"))
    assert [tuple(r) for r in spark.table(name).collect()] == [(7, 0, "z")]
    facts = table_layout(spark, name)
    assert facts["Type"] == "EXTERNAL" and "/snapshot-" in facts["Location"]
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {name.split('.')[0]}").collect()]
    assert tables == ["t"]
    root = facts["Location"].rsplit("/", 1)[0].removeprefix("file:")
    assert len([f for f in os.listdir(root) if f.startswith("snapshot-")]) == 2


def test_a_failed_swap_keeps_the_old_table(spark):
    db = unique_name("swap")
    ensure_database(spark, db)
    replace_table(spark, spark.range(3), f"{db}.t", scratch_path(spark, "swap"))
    with pytest.raises(AnalysisException):
        swap_table(spark, f"{db}.never_written", f"{db}.t", f"{db}.aside")
    assert spark.table(f"{db}.t").count() == 3


def test_partitioned_predictions_overwrite_and_append(spark):
    table, location = f"{unique_name('pp')}.p", scratch_path(spark, "pp")
    df = spark.createDataFrame([(1, 0, "a"), (2, 1, "b")], "k long, prediction int, day string")
    for _ in range(2):
        write_predictions(spark, df, table, "overwrite", location=location, partition_by=["day"])
    write_predictions(spark, df, table, "append", partition_by=["day"])
    assert spark.table(table).where("day = 'a'").count() == 2 and table_layout(spark, table)["Type"] == "EXTERNAL"


def test_a_repeated_append_of_one_batch_gives_its_rows_once(spark):
    table, location = f"{unique_name('batch')}.p", scratch_path(spark, "batch")
    rows = lambda *ks: spark.createDataFrame([(k, k % 2) for k in ks], "k long, prediction int")
    held = lambda: sorted(tuple(r) for r in spark.table(table).collect())
    write_predictions(spark, rows(1, 2), table, "append", location=location, batch_id="d 1")
    for _ in range(2):
        write_predictions(spark, rows(3, 4), table, "append", batch_id="d 2")
    assert held() == [(1, 1, "d 1"), (2, 0, "d 1"), (3, 1, "d 2"), (4, 0, "d 2")]
    failing = spark.range(0, 50).selectExpr("id AS k", "if(id = 49, raise_error('stop'), cast(id as int)) AS prediction")
    with pytest.raises(Exception, match="stop"):
        write_predictions(spark, failing, table, "append", batch_id="d 2")
    assert len(held()) == 4  # a failed run leaves the batch as it was
    write_predictions(spark, rows(5).select("prediction", "k"), table, "append", batch_id="d 2")  # by name
    assert held() == [(1, 1, "d 1"), (2, 0, "d 1"), (5, 1, "d 2")]
    write_predictions(spark, rows(), table, "append", batch_id="d 2")  # the batch has no rows any more
    assert held() == [(1, 1, "d 1"), (2, 0, "d 1")]
    with pytest.raises(ValueError, match="do not match"):
        write_predictions(spark, rows(1).withColumn("extra", F.lit(1)), table, "append", batch_id="d 2")
    write_predictions(spark, rows(9), table, "overwrite", location=location)
    with pytest.raises(ValueError, match="not partitioned"):
        write_predictions(spark, rows(9), table, "append", batch_id="d 3")


def test_a_failed_write_leaves_no_snapshot(spark):
    db, root = unique_name("left"), scratch_path(spark, "left")
    ensure_database(spark, db)
    replace_table(spark, spark.range(3), f"{db}.t", root)
    with pytest.raises(Exception, match="stop"):
        replace_table(spark, spark.range(9).selectExpr("if(id = 8, raise_error('stop'), id) AS id"), f"{db}.t", root)
    assert len([f for f in os.listdir(root.removeprefix("file:")) if f.startswith("snapshot-")]) == 1
