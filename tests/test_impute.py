"""Exact medians: documented values, missing handling, and the scalable path."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from scorebook.operators.impute import ExactMedianImputer, exact_medians
from scorebook.session import scratch_path
from tests.conftest import SF01


def test_median_of_1_2_10_20(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 6.0}
    assert exact_medians(df, ["x"], single_task_rows=0) == {"x": 6.0}


def test_nan_and_null_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 1.5}
    assert exact_medians(df, ["x"], single_task_rows=0) == {"x": 1.5}


def test_all_missing_column_raises(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    with pytest.raises(ValueError, match="'y'"):
        ExactMedianImputer(inputCols=["x", "y"]).fit(df)


def test_bucketed_equals_builtin_on_orders(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    cols = ["o_totalprice", "o_custkey"]
    fast = exact_medians(orders, cols)
    bucketed = exact_medians(orders, cols, buckets=64, single_task_rows=0)
    assert fast == pytest.approx(bucketed, rel=0, abs=1e-9)


def test_fill_and_persist_in_pipeline(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 10.0), (4, float("nan")), (5, 20.0), (6, 2.0)], "k long, x double")
    model = Pipeline(stages=[ExactMedianImputer(inputCols=["x"])]).fit(df)
    path = scratch_path(spark, "imputer")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    got = {r.k: r.x for r in loaded.transform(df).collect()}
    assert got == {1: 1.0, 2: 6.0, 3: 10.0, 4: 6.0, 5: 20.0, 6: 2.0}


def test_bracketed_medians_are_exact(spark):
    df = spark.range(0, 20_001).selectExpr(
        "cast(hash(id) as double) AS spread", "if(id % 3 = 0, 7.0, cast(id as double)) AS hot", "cast(null as double) AS none",
        "if(id % 2 = 0, double('nan'), cast(id % 5 as double)) AS few", "if(id < 10000, 0.0, 1.0e6 + id) AS gap")
    cols = ["spread", "hot", "none", "few", "gap"]
    assert exact_medians(df, cols, single_task_rows=0) == exact_medians(df, cols)
    even = df.limit(20_000)
    assert exact_medians(even, ["hot", "gap"], single_task_rows=0) == exact_medians(even, ["hot", "gap"])
