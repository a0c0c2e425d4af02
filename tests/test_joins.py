"""Joins: fan-out, vanishing rows, composite keys, key validation, shared columns."""

import pytest

from scorebook.config import normalize_keys
from scorebook.operators.joins import score_join, training_join


def test_duplicate_keys_fan_out_and_missing_vanish(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "k long, y int")
    feats = spark.createDataFrame([(1, 1.0), (1, 1.5), (2, 2.0)], "k long, x double")
    out = training_join(labels, feats, "k")
    assert out.columns == ["k", "y", "x"]
    assert sorted((r.k, r.x) for r in out.collect()) == [(1, 1.0), (1, 1.5), (2, 2.0)]


def test_composite_keys(spark):
    a = spark.createDataFrame([(1, "a", 1), (1, "b", 0)], "k1 long, k2 string, y int")
    b = spark.createDataFrame([(1, "b", 9.0)], "k1 long, k2 string, x double")
    assert [tuple(r) for r in score_join(a, b, ["k1", "k2"]).collect()] == [(1, "b", 0, 9.0)]


def test_keys_as_number_rejected():
    with pytest.raises(TypeError):
        normalize_keys(5)


def test_shared_non_key_column_rejected(spark):
    a = spark.createDataFrame([(1, 1)], "k long, y int")
    b = spark.createDataFrame([(1, 2)], "k long, y int")
    with pytest.raises(ValueError, match="'y'"):
        score_join(a, b, "k")
