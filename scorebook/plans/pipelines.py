"""The three jobs and their chaining (B1-B5). Data stays in Spark from scan to write; the driver sees category
lists, class counts, medians, metrics and tree structure only."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.config import (
    FeaturizerConfig,
    FeatureTableConfig,
    InferenceConfig,
    LabelsTableConfig,
    TrainConfig,
    normalize_keys,
)
from scorebook.functions.expressions import clean_name
from scorebook.operators import model as M
from scorebook.operators.featurize import feature_frame, featurize, labels_frame
from scorebook.operators.joins import score_join, training_join
from scorebook.operators.metrics import metrics_row
from scorebook.operators.registry import Registry, conf_json
from scorebook.operators.split import TRAIN, split_with_sizes
from scorebook.sources.catalog import (
    feature_side,
    write_feature_table,
    write_labels_table,
    write_path,
    write_predictions,
)
from scorebook.session import scratch_root
from scorebook.sources.tables import read_path, read_table


def create_feature_tables(spark: SparkSession, raw: DataFrame | None, featurizer: FeaturizerConfig,
                          features: FeatureTableConfig, labels: LabelsTableConfig) -> tuple[str, str]:
    """B1: raw table -> feature table (no label) + labels table (keys + label). Without a frame, the raw table is
    ``featurizer.input_table``. The featurized frame is persisted across the two writes so the chain runs once."""
    if raw is None:
        if not featurizer.input_table:
            raise ValueError("give a raw frame or set input_table")
        raw = read_table(spark, featurizer.input_table)
    keys = features.keys
    if featurizer.ohe:  # names are cleaned, keys included
        keys = [clean_name(k) for k in keys]
        features = dataclasses.replace(features, primary_keys=tuple(keys))
    label = featurizer.label_out
    if labels.label_col != label:
        raise ValueError(f"labels table expects label {labels.label_col!r}, featurizer writes {label!r}")
    prepared = featurize(raw, featurizer).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_feature_table(spark, feature_frame(prepared, label), features)
        label_keys = normalize_keys(labels.primary_keys) if labels.primary_keys is not None else keys
        if featurizer.ohe:
            label_keys = [clean_name(k) for k in label_keys]
        write_labels_table(spark, labels_frame(prepared, label_keys, label), labels)
    finally:
        prepared.unpersist()
    return features.name, labels.name


def train(spark: SparkSession, cfg: TrainConfig, registry: Registry | None = None) -> DataFrame:
    """B2: join, split, fit, evaluate, log, register and promote. Returns the one-row metrics record with the
    row counts of both sides, the registered version and the promotion decision. The run's folder keeps the
    model, its signature, the input example and the test predictions that the metrics come from."""
    keys = cfg.feature_table.keys
    label = cfg.labels_table.label_col
    labels = read_table(spark, cfg.labels_table.name)
    joined = training_join(labels, feature_side(spark, cfg.feature_table.name, labels, keys), keys)
    marked, sizes = split_with_sizes(joined, label, keys, cfg.split.test_size, cfg.split.random_state, "_split",
                                     max_classes=cfg.max_classes)
    # Lineage cut in the shared checkpoint folder: train and test are read from it, and a lost executor
    # does not recompute the join and the ranks.
    scratch_root(spark)
    marked = marked.checkpoint(eager=True)
    train_df = marked.where(F.col("_split") == TRAIN).drop("_split")
    test_df = marked.where(F.col("_split") != TRAIN).drop("_split")
    n_train = sum(t for t, _ in sizes.values())
    model = M.fit(train_df, label, keys, cfg.model_params, cfg.include_keys, cfg.fit_partitions, n_train,
                  cfg.max_categories)
    run_id = uuid.uuid4().hex
    model_path = registry.model_path(run_id) if registry else f"{scratch_root(spark)}/runs/{run_id}/model"
    M.save_model(model, model_path)
    artifacts = model_path.rsplit("/", 1)[0]
    write_path(M.input_example(train_df, keys), f"{artifacts}/input_example", "parquet")
    spark.createDataFrame(M.signature(joined, label), "column string, type string, role string").coalesce(1) \
        .write.mode("overwrite").json(f"{artifacts}/signature")
    write_path(M.predict(model, test_df).select(*keys, label, M.PREDICTION), f"{artifacts}/test_predictions", "parquet")
    found = metrics_row(read_path(spark, f"{artifacts}/test_predictions", "parquet"), label, M.PREDICTION, run_id)
    metrics = spark.createDataFrame(found.collect(), found.schema)  # one row
    n_test = sum(t for _, t in sizes.values())
    counts = [F.lit(n_train).cast("long").alias("n_train"), F.lit(n_test).cast("long").alias("n_test")]
    if registry is None or cfg.model_name is None:
        return metrics.select("*", *counts)
    registry.log_run(run_id, metrics.drop("run_id"), conf_json(cfg.conf, cfg.logged_conf_keys))
    decision = registry.register_and_promote(cfg.model_name, run_id)
    return metrics.select("*", *counts).join(
        decision.select("name", F.col("candidate_run_id").alias("run_id"), F.col("candidate_version").alias("version"),
                        "promote", "archive"),
        on="run_id", how="left")


def score(spark: SparkSession, cfg: InferenceConfig, registry: Registry) -> DataFrame:
    """Resolve the model for (name, stage), join input keys to features, check the columns against the model's
    signature (M10), predict. The result is lazy; resolving the model and sizing the join's buckets run small jobs."""
    run_id = registry.resolved_run(cfg.model_name, cfg.stage)
    keys = normalize_keys(cfg.lookup_keys)
    inputs = read_table(spark, cfg.input_table)
    joined = score_join(inputs, feature_side(spark, cfg.feature_table, inputs, keys), keys)
    M.check_signature(registry.signature(run_id), joined.schema)
    return M.predict(M.load_model(registry.model_path(run_id)), joined)


def batch_inference(spark: SparkSession, cfg: InferenceConfig, registry: Registry) -> str:
    """Score and write the predictions table (append or overwrite)."""
    if cfg.output_table is None:
        raise ValueError("output_table must be set to write predictions")
    return write_predictions(spark, score(spark, cfg, registry), cfg.output_table, cfg.mode, cfg.format,
                             cfg.output_location, batch_id=cfg.batch_id)


def run_initial_train(spark: SparkSession, raw: DataFrame | None, featurizer: FeaturizerConfig,
                      cfg: TrainConfig, registry: Registry) -> DataFrame:
    """Features, then training, in that order."""
    create_feature_tables(spark, raw, featurizer, cfg.feature_table, cfg.labels_table)
    return train(spark, cfg, registry)


def smoke(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a frame to a path in a format and read it back."""
    write_path(df, path, fmt)
    return read_path(spark, path, fmt)
