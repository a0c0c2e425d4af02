"""Whole jobs: features -> train -> register/promote -> score, and the job-level quirks."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from scorebook.config import FeaturizerConfig, FeatureTableConfig, InferenceConfig, LabelsTableConfig, SplitConfig, TrainConfig
from scorebook.operators.registry import Registry
from scorebook.plans.pipelines import batch_inference, create_feature_tables, score, train
from scorebook.session import scratch_path, unique_name
from scorebook.sources.catalog import write_feature_table

SMALL = {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 1, "max_features": "sqrt", "random_state": 42}


def _raw(spark, n=60, weird_every=None):
    rows = []
    for i in range(n):
        status = "Canceled" if i % 3 == 0 else "Not_Canceled"
        if weird_every and i % weird_every == 0:
            status = "unknown"
        rows.append((f"B{i:03d}", i % 4, "Suite" if i % 2 else "Standard", float(i * 10 % 37), status))
    return spark.createDataFrame(rows, "Booking_ID string, adults int, room_type string, price double, booking_status string")


def _configs(spark, buckets=None):
    db = unique_name("jobs")
    features = FeatureTableConfig(db, "features", "Booking_ID", description="booking features", buckets=buckets)
    labels = LabelsTableConfig(db, "labels", "booking_status", "Booking_ID", path=scratch_path(spark, "labels"))
    cfg = TrainConfig(features, labels, SplitConfig(0.25, 42), SMALL, model_name="booking")
    return db, features, labels, cfg


def test_features_train_promote_score(spark):
    db, features, labels, cfg = _configs(spark, buckets=4)
    create_feature_tables(spark, _raw(spark), FeaturizerConfig(drop_missing=False), features, labels)
    assert "booking_status" not in spark.table(features.name).columns
    assert spark.table(labels.name).columns == ["Booking_ID", "booking_status"]
    registry = Registry(spark, unique_name("registry"), scratch_path(spark, "registry"))

    first = train(spark, cfg, registry).first()
    assert first.version == 1 and first.promote and not first.archive
    # Same data and seed: equal accuracy, so the second version is not promoted (strictly better only).
    second = train(spark, cfg, registry).first()
    assert second.version == 2 and not second.promote
    assert second.test_accuracy == first.test_accuracy
    stages = {r.version: r.stage for r in registry.versions().collect()}
    assert stages == {1: "Production", 2: "None"}

    out = f"{db}.predictions"
    inference = InferenceConfig("booking", labels.name, features.name, "Booking_ID", out,
                                output_location=scratch_path(spark, "pred"))
    batch_inference(spark, inference, registry)
    preds = spark.table(out)
    assert preds.count() == 60
    assert {"Booking_ID", "booking_status", "prediction"} <= set(preds.columns)
    assert preds.where(~F.col("prediction").isin(0, 1)).count() == 0


def test_null_labels_fail_training_loudly(spark):
    db, features, labels, cfg = _configs(spark)
    create_feature_tables(spark, _raw(spark, weird_every=7), FeaturizerConfig(drop_missing=False), features, labels)
    with pytest.raises(ValueError, match="null"):
        train(spark, cfg, Registry(spark, unique_name("registry"), scratch_path(spark, "registry")))


def test_missing_output_table_rejected_before_scoring(spark):
    registry = Registry(spark, unique_name("registry"), scratch_path(spark, "registry"))
    cfg = InferenceConfig("nothing", "no.input", "no.features", "k", None)
    with pytest.raises(ValueError, match="output_table"):
        batch_inference(spark, cfg, registry)
    with pytest.raises(LookupError):
        registry.resolve("nothing")


def test_names_cleaned_keys_included_when_one_hot(spark):
    raw = _raw(spark).withColumnRenamed("Booking_ID", "Booking ID").withColumnRenamed("price", "price (usd)")
    db = unique_name("jobs")
    features = FeatureTableConfig(db, "features", "Booking ID")
    labels = LabelsTableConfig(db, "labels", "booking_status", "Booking ID", path=scratch_path(spark, "labels"))
    create_feature_tables(spark, raw, FeaturizerConfig(ohe=True, cat_cols=("room_type",), drop_missing=True),
                          features, labels)
    assert spark.table(features.name).columns == ["BookingID", "adults", "price_usd", "room_type_Standard", "room_type_Suite"]
    assert spark.table(labels.name).columns == ["BookingID", "booking_status"]


def _scored(spark):
    """A promoted model and the inference job over its tables."""
    db, features, labels, cfg = _configs(spark)
    create_feature_tables(spark, _raw(spark), FeaturizerConfig(drop_missing=False), features, labels)
    registry = Registry(spark, unique_name("registry"), scratch_path(spark, "registry"))
    train(spark, cfg, registry)
    job = InferenceConfig("booking", labels.name, features.name, "Booking_ID", f"{db}.predictions",
                          output_location=scratch_path(spark, "pred"), mode="append", batch_id="today")
    return registry, features, job


def test_scoring_checks_the_signature(spark):
    registry, features, job = _scored(spark)
    stored = spark.createDataFrame(spark.table(features.name).collect(), spark.table(features.name).schema)
    write_feature_table(spark, stored.withColumn("extra", F.lit(1)), features)
    assert score(spark, job, registry).count() == 60  # further columns are ignored
    write_feature_table(spark, stored.drop("price", "adults"), features)
    with pytest.raises(ValueError, match=r"missing column\(s\) \['adults', 'price'\]"):
        score(spark, job, registry)
    write_feature_table(spark, stored.withColumn("adults", F.col("adults").cast("string")), features)
    with pytest.raises(ValueError, match="adults: int at training, string now"):
        score(spark, job, registry)


def test_a_scoring_job_can_run_again(spark):
    registry, _, job = _scored(spark)
    for _ in range(2):
        batch_inference(spark, job, registry)
    assert spark.table(job.output_table).count() == 60
    batch_inference(spark, dataclasses.replace(job, batch_id="tomorrow"), registry)
    assert spark.table(job.output_table).groupBy("batch_id").count().collect().__len__() == 2
