"""One query per operator of the inventory, each ``(spark, sf_dir) -> DataFrame`` over the whole test tables,
with the equivalent DuckDB SQL where one exists. Writes go to fresh folders under the session's shared
checkpoint folder and to uniquely named databases."""

from __future__ import annotations

import dataclasses
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from scorebook.config import (
    FeaturizerConfig,
    FeatureTableConfig,
    InferenceConfig,
    LabelsTableConfig,
    SplitConfig,
    TrainConfig,
)
from scorebook.operators import model as M
from scorebook.operators.featurize import (
    clean_column_names,
    drop_missing,
    feature_frame,
    featurize,
    labels_frame,
    one_hot,
    process_label,
)
from scorebook.operators.impute import ExactMedianImputer
from scorebook.operators.joins import score_join, training_join
from scorebook.operators.metrics import METRIC_NAMES, binary_metrics, metrics_row, multiclass_auc, pairwise_auc, roc_auc
from scorebook.operators.registry import (
    Registry,
    apply_promotion,
    champions,
    conf_json,
    promotion_decisions,
    register,
    resolve_stage,
)
from scorebook.operators.split import TRAIN, assign_split
from scorebook.plans import bindings as B
from scorebook.plans.pipelines import batch_inference, create_feature_tables, run_initial_train, smoke, train
from scorebook.session import scratch_path, scratch_root, unique_name
from scorebook.sources.catalog import (
    ensure_database,
    feature_side,
    point_table,
    write_feature_table,
    write_labels_table,
    write_path,
    write_predictions,
)
from scorebook.sources.tables import id_range, read_csv, read_parquet_table, read_path, read_table

# The shipped training configuration.
SHIPPED_SPLIT = SplitConfig(test_size=0.2, random_state=42)
SHIPPED_FOREST = {"n_estimators": 100, "max_depth": 12, "min_samples_leaf": 1, "max_features": 10, "random_state": 42}
# A small forest for the save / load round trip (not a shipped value).
SMALL_FOREST = {"n_estimators": 6, "max_depth": 4, "min_samples_leaf": 2, "max_features": "log2", "random_state": 7}

# Buckets of the feature tables the jobs write: sized from the row count (at least 8).
FEATURE_BUCKETS = "auto"

ORDER_KEY = "o_orderkey"
DOC_KEY = "doc_id"


def _database(spark: SparkSession, prefix: str) -> str:
    """A fresh database whose folder is under the shared scratch folder (not the warehouse)."""
    name = unique_name(prefix)
    ensure_database(spark, name, scratch_path(spark, f"db-{prefix}"))
    return name


def _r(col: str, places: int = 6):
    return F.round(F.col(col), places).alias(col)


# ---------------------------------------------------------------- O binding helpers

def _order_featurizer(ohe: bool, drop: bool) -> FeaturizerConfig:
    return FeaturizerConfig(label_col="o_orderstatus", ohe=ohe, cat_cols=B.ORDER_CATEGORICALS if ohe else None,
                            drop_missing=drop, rename_to="label", label_map=B.ORDER_LABEL_MAP)


def _labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_label(B.raw_orders(spark, sf_dir), "o_orderstatus", B.ORDER_LABEL_MAP, "label")


def _raw_table(spark: SparkSession, sf_dir: str) -> str:
    """The raw input registered as a catalog table (S1's input)."""
    db = _database(spark, "raw")
    path = write_path(B.raw_orders(spark, sf_dir), scratch_path(spark, "raw_orders"))
    point_table(spark, f"{db}.orders_raw", path, "parquet")
    return f"{db}.orders_raw"


ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _onehot_sql(clean: bool) -> str:
    name = (lambda s: s.replace(" ", "").replace("(", "_").replace(")", "")) if clean else (lambda s: s)
    cols = [f'CAST(CASE WHEN o_orderpriority = \'{v}\' THEN 1 ELSE 0 END AS BIGINT) AS "{name("o_orderpriority_" + v)}"'
            for v in ORDER_PRIORITIES]
    cols += [f'CAST(CASE WHEN c_mktsegment = \'{v}\' THEN 1 ELSE 0 END AS BIGINT) AS "{name("c_mktsegment_" + v)}"'
             for v in SEGMENTS]
    return (f"SELECT o_orderkey, o_custkey, {B.ORDER_LABEL_SQL} AS label, o_totalprice, c_nationkey, c_acctbal, "
            + ", ".join(cols) + f" FROM ({B.RAW_ORDERS_SQL}) raw")


# ---------------------------------------------------------------- sources

def q_scan_input(spark, sf_dir):
    """S1."""
    return read_table(spark, _raw_table(spark, sf_dir))


def q_csv_ingest(spark, sf_dir):
    """Raw CSV with an explicit schema into a table."""
    raw = B.raw_orders(spark, sf_dir)
    csv_dir = scratch_path(spark, "raw_csv")
    raw.write.option("header", True).mode("overwrite").csv(csv_dir)
    loaded = read_csv(spark, csv_dir, raw.schema)
    db = _database(spark, "ingest")
    path = write_path(loaded, scratch_path(spark, "ingested"))
    point_table(spark, f"{db}.orders_raw", path, "parquet")
    return read_table(spark, f"{db}.orders_raw")


def q_range_smoke(spark, sf_dir):
    """S6 + K7 + S7 (B5): one id per lineitem row, written and read back."""
    n = read_parquet_table(spark, sf_dir, "lineitem").count()
    return smoke(spark, id_range(spark, n), scratch_path(spark, "smoke"), "parquet")


# ---------------------------------------------------------------- projections

def q_label_encode(spark, sf_dir):
    return _labelled_orders(spark, sf_dir)


def q_one_hot(spark, sf_dir):
    return one_hot(_labelled_orders(spark, sf_dir), B.ORDER_CATEGORICALS)


def q_clean_column_names(spark, sf_dir):
    df = one_hot(_labelled_orders(spark, sf_dir), B.ORDER_CATEGORICALS)
    return clean_column_names(df.withColumn("price (usd)", F.col("o_totalprice")))


def q_drop_missing(spark, sf_dir):
    return drop_missing(_labelled_orders(spark, sf_dir))


def q_featurize(spark, sf_dir):
    return featurize(B.raw_orders(spark, sf_dir), _order_featurizer(ohe=True, drop=True))


def q_column_roles(spark, sf_dir):
    """Role of every column of the training join (keys and label excluded from the features)."""
    joined = training_join(B.doc_labels(spark, sf_dir), B.doc_features(spark, sf_dir), DOC_KEY)
    numeric, categorical = M.column_roles(joined.schema, [DOC_KEY, "quality"])
    return M.column_profile(joined, {**{c: "numeric" for c in numeric}, **{c: "categorical" for c in categorical}})


# ---------------------------------------------------------------- sinks

def q_feature_table_write(spark, sf_dir):
    """Shipped featurizer (no one-hot, keep missing), label dropped, written, read back."""
    prepared = featurize(B.raw_orders(spark, sf_dir), _order_featurizer(ohe=False, drop=False))
    cfg = FeatureTableConfig(_database(spark, "features"), "orders_features", ORDER_KEY,
                             description="Order features; one quote ' inside")
    name = write_feature_table(spark, feature_frame(prepared, "label"), cfg)
    return read_table(spark, name)


def q_labels_table_write(spark, sf_dir):
    """K4, K5, K10, P9."""
    prepared = featurize(B.raw_orders(spark, sf_dir), _order_featurizer(ohe=False, drop=False))
    cfg = LabelsTableConfig(_database(spark, "labels"), "orders_labels", "label", ORDER_KEY,
                            path=scratch_path(spark, "labels"))
    return read_table(spark, write_labels_table(spark, labels_frame(prepared, ORDER_KEY, "label"), cfg))


def _rule_predictions(spark, sf_dir):
    joined = training_join(B.doc_labels(spark, sf_dir), B.doc_features(spark, sf_dir), DOC_KEY)
    return joined.withColumn("prediction", (F.col("n_chars") > B.RULE_MIN_CHARS).cast("int"))


def q_predictions_overwrite(spark, sf_dir):
    """K6: the daily job's normal path, an overwrite of an existing table (here of other rows)."""
    table = f"{_database(spark, 'pred')}.predictions"
    location = scratch_path(spark, "predictions")
    rows = _rule_predictions(spark, sf_dir)
    write_predictions(spark, rows.withColumn("prediction", 1 - F.col("prediction")), table, "overwrite", location=location)
    write_predictions(spark, rows, table, "overwrite", location=location)
    return read_table(spark, table)


def q_predictions_append(spark, sf_dir):
    """K6: two batches, the second one run twice as after a failure; its rows are there once."""
    table = f"{_database(spark, 'pred')}.predictions"
    location = scratch_path(spark, "predictions")
    rows = _rule_predictions(spark, sf_dir)
    write_predictions(spark, rows, table, "append", location=location, batch_id="monday")
    write_predictions(spark, rows.withColumn("prediction", 1 - F.col("prediction")), table, "append", batch_id="tuesday")
    write_predictions(spark, rows, table, "append", batch_id="tuesday")
    return read_table(spark, table)


# ---------------------------------------------------------------- joins

def q_training_join(spark, sf_dir):
    return training_join(B.doc_labels(spark, sf_dir), B.doc_features(spark, sf_dir), DOC_KEY)


def q_score_join(spark, sf_dir):
    """J2 over written tables (S4, S5): the input table and the bucketed feature table, as the scoring job reads them."""
    db = _database(spark, "score")
    path = write_path(read_parquet_table(spark, sf_dir, "labels").select(DOC_KEY, "toxic"), scratch_path(spark, "score_input"))
    point_table(spark, f"{db}.score_input", path, "parquet")
    features = FeatureTableConfig(db, "doc_features", DOC_KEY, buckets=FEATURE_BUCKETS)
    write_feature_table(spark, B.doc_features(spark, sf_dir), features)
    inputs = read_table(spark, f"{db}.score_input")
    return score_join(inputs, feature_side(spark, features.name, inputs, [DOC_KEY]), DOC_KEY)


# ---------------------------------------------------------------- learning

def _doc_split(spark, sf_dir):
    return assign_split(q_training_join(spark, sf_dir), "quality", DOC_KEY,
                        SHIPPED_SPLIT.test_size, SHIPPED_SPLIT.random_state)


def q_stratified_split(spark, sf_dir):
    return _doc_split(spark, sf_dir).select(DOC_KEY, "quality", "split")


def q_split_counts(spark, sf_dir):
    return _doc_split(spark, sf_dir).groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


def q_median_impute(spark, sf_dir):
    """M2: medians learnt on the train rows of the orders split, applied to every row."""
    every = _labelled_orders(spark, sf_dir).select(ORDER_KEY, "label", "o_totalprice", "c_acctbal")
    scratch_root(spark)
    # Written once: the fit and the fill read it. Rows without a label are on no side, and are imputed all the same.
    marked = assign_split(every, "label", ORDER_KEY, SHIPPED_SPLIT.test_size, SHIPPED_SPLIT.random_state,
                          unlabelled="keep").checkpoint(eager=True)
    imputer = ExactMedianImputer(inputCols=["o_totalprice", "c_acctbal"], keepInput=False)
    model = imputer.fit(marked.where(F.col("split") == TRAIN))
    return model.transform(marked).select(ORDER_KEY, "split", _r("o_totalprice"), _r("c_acctbal"))


def _docs_with_null_sources(spark, sf_dir):
    docs = B.doc_features(spark, sf_dir)
    return docs.withColumn("source", F.when(F.col(DOC_KEY) % 50 != 0, F.col("source")))


def q_one_hot_unknown(spark, sf_dir):
    """M3: categories learnt without src0 (nulls are a category); src0 rows get the zero vector."""
    docs = _docs_with_null_sources(spark, sf_dir)
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=M.preprocess_stages([], ["source"])).fit(docs.where(F.coalesce(F.col("source"), F.lit("")) != "src0"))
    arr = vector_to_array(F.col(M.FEATURES))
    return fitted.transform(docs).select(
        DOC_KEY, "source",
        (F.array_position(arr, 1.0) - 1).cast("long").alias("hot_index"),
        F.size(arr).cast("long").alias("width"),
    )


def _doc_train_test(spark, sf_dir):
    scratch_root(spark)
    marked = _doc_split(spark, sf_dir).checkpoint(eager=True)  # read by the fit and by the prediction
    return (marked.where(F.col("split") == TRAIN).drop("split"), marked.where(F.col("split") != TRAIN).drop("split"))


def q_assemble(spark, sf_dir):
    train_df, _ = _doc_train_test(spark, sf_dir)
    numeric, categorical = M.column_roles(train_df.schema, [DOC_KEY, "quality"])
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=M.preprocess_stages(numeric, categorical)).fit(train_df)
    # One row per (document, vector position): the assembled matrix in long form, scalar columns only.
    return fitted.transform(train_df).select(DOC_KEY, F.posexplode(vector_to_array(M.FEATURES)).alias("pos", "value"))


def flagship(spark, sf_dir):
    """Shipped forest fitted on train, predictions for the test rows."""
    train_df, test_df = _doc_train_test(spark, sf_dir)
    model = M.fit(train_df, "quality", [DOC_KEY], SHIPPED_FOREST)
    return M.predict(model, test_df)


def q_train_score(spark, sf_dir):
    """M5-M8, P10, P12 on binding R: the shipped forest, and its prediction for every test row."""
    scratch_root(spark)
    joined = training_join(B.rule_labels(spark, sf_dir), B.doc_features(spark, sf_dir), DOC_KEY)
    marked = assign_split(joined, "continental", DOC_KEY, SHIPPED_SPLIT.test_size, SHIPPED_SPLIT.random_state).checkpoint(eager=True)
    model = M.fit(marked.where(F.col("split") == TRAIN).drop("split"), "continental", [DOC_KEY], SHIPPED_FOREST)
    return M.predict(model, marked.where(F.col("split") != TRAIN).drop("split"))


def q_model_round_trip(spark, sf_dir):
    """M9: predictions before and after save/load."""
    train_df, test_df = _doc_train_test(spark, sf_dir)
    model = M.fit(train_df, "quality", [DOC_KEY], SMALL_FOREST)
    path = M.save_model(model, scratch_path(spark, "model"))
    before = M.predict(model, test_df).select(DOC_KEY, "prediction")
    after = M.predict(M.load_model(path), test_df).select(DOC_KEY, F.col("prediction").alias("reloaded"))
    same = (F.col("prediction") == F.col("reloaded")).cast("int").alias("same")
    return before.join(after, DOC_KEY).select(DOC_KEY, same)


def q_signature(spark, sf_dir):
    """The input signature of the training rows (type and role per column, with non-missing counts)."""
    train_df, _ = _doc_train_test(spark, sf_dir)
    return M.column_profile(train_df, {c: role for c, _, role in M.signature(train_df, "quality")})


def q_input_example(spark, sf_dir):
    train_df, _ = _doc_train_test(spark, sf_dir)
    return M.input_example(train_df, [DOC_KEY])


# ---------------------------------------------------------------- metrics

def q_binary_metrics(spark, sf_dir):
    m = binary_metrics(_rule_predictions(spark, sf_dir), "quality", "prediction")
    return m.select(*[_r(c, 9) for c in m.columns])


def q_roc_auc(spark, sf_dir):
    joined = q_training_join(spark, sf_dir)
    return roc_auc(joined, "quality", "n_chars").select(_r("roc_auc_score", 9))


def _language_scores(spark, sf_dir):
    """Scores of a rule for each language: some noise of the document, and a part of the truth."""
    docs = B.doc_features(spark, sf_dir).where("lang is not null")
    return docs.select(DOC_KEY, "lang", *[
        (((F.col("n_chars") * p + F.col(DOC_KEY)) % 101 + F.when(F.col("lang") == k, 20 + p).otherwise(0)) / 128.0).alias(f"score_{k}")
        for k, p in B.LANGUAGE_FACTORS])


def q_roc_auc_ovo(spark, sf_dir):
    """E5 for several classes: one against one over the languages, weighted by prevalence."""
    scores = {k: f"score_{k}" for k, _ in B.LANGUAGE_FACTORS}
    return multiclass_auc(_language_scores(spark, sf_dir), "lang", scores).select(_r("roc_auc_score", 9))


def q_roc_auc_pairs(spark, sf_dir):
    """E5: the AUC of each pair of languages."""
    scores = {k: f"score_{k}" for k, _ in B.LANGUAGE_FACTORS}
    return pairwise_auc(_language_scores(spark, sf_dir), "lang", scores).select("first", "second", _r("auc", 9), "rows")


def q_metrics_row(spark, sf_dir):
    m = metrics_row(_rule_predictions(spark, sf_dir), "quality", "prediction", "rule_n_chars")
    conf = conf_json({"model_params": {"rule": "n_chars"}, "token": "not logged"}, ("model_params", "run_name"))
    return m.select("run_id", *[_r(c, 9) for c in m.columns if c != "run_id"], F.lit(conf).alias("conf"))


# ---------------------------------------------------------------- registry

def q_register_version(spark, sf_dir):
    events = read_parquet_table(spark, sf_dir, "events")
    new_runs = events.groupBy(F.col("event_type").alias("name")).agg(F.max("ts").alias("last_updated")) \
        .withColumn("run_id", F.concat(F.lit("new-"), F.col("name")))
    return register(B.versions_from_events(spark, sf_dir), new_runs)


def q_champion_select(spark, sf_dir):
    return champions(B.versions_from_events(spark, sf_dir))


def _decisions(spark, sf_dir, versions: DataFrame | None = None):
    versions = versions if versions is not None else B.versions_from_events(spark, sf_dir)
    return promotion_decisions(versions, B.runs_from_events(spark, sf_dir))


def q_promotion_decision(spark, sf_dir):
    d = _decisions(spark, sf_dir)
    return d.withColumn("promote", F.col("promote").cast("int")).withColumn("archive", F.col("archive").cast("int"))


def q_apply_promotion(spark, sf_dir):
    # One versions frame for both uses: its shuffles appear once in the plan and are reused.
    versions = B.versions_from_events(spark, sf_dir)
    return apply_promotion(versions, _decisions(spark, sf_dir, versions))


def q_resolve_stage(spark, sf_dir):
    return resolve_stage(q_apply_promotion(spark, sf_dir))


# ---------------------------------------------------------------- jobs

def _doc_tables(spark, sf_dir, by_rule: bool = False) -> TrainConfig:
    """Feature and labels tables for binding D (or R: ``by_rule``), written as the features job would."""
    label = "continental" if by_rule else "quality"
    db = _database(spark, "docs")
    features = FeatureTableConfig(db, "doc_features", DOC_KEY, description="document features",
                                  buckets=FEATURE_BUCKETS)
    labels = LabelsTableConfig(db, "doc_labels", label, DOC_KEY, path=scratch_path(spark, "doc_labels"))
    write_feature_table(spark, B.doc_features(spark, sf_dir), features)
    write_labels_table(spark, B.rule_labels(spark, sf_dir) if by_rule else B.doc_labels(spark, sf_dir), labels)
    return TrainConfig(features, labels, SHIPPED_SPLIT, SHIPPED_FOREST, model_name=f"doc_{label}",
                       conf={"pipeline_params": {"test_size": 0.2, "random_state": 42},
                             "model_params": SHIPPED_FOREST})


def q_features_job(spark, sf_dir):
    """B1: features and labels tables written, read back and joined."""
    db = _database(spark, "orders")
    features = FeatureTableConfig(db, "orders_features", ORDER_KEY, description="orders features",
                                  buckets=FEATURE_BUCKETS)
    labels = LabelsTableConfig(db, "orders_labels", "label", ORDER_KEY, path=scratch_path(spark, "orders_labels"))
    start = dataclasses.replace(_order_featurizer(True, True), input_table=_raw_table(spark, sf_dir))
    f_name, l_name = create_feature_tables(spark, None, start, features, labels)
    lab = read_table(spark, l_name)
    feat = read_table(spark, f_name)
    return lab.join(feat, ORDER_KEY)


def _registry(spark) -> Registry:
    return Registry(spark, _database(spark, "registry"), scratch_path(spark, "registry"))


def _job_facts(spark, registry: Registry, result: DataFrame, label: str) -> DataFrame:
    """A training job's row counts and decision, and whether each metric follows from the stored predictions."""
    row = result.collect()[0]
    stored = read_path(spark, registry.model_path(row["run_id"]).rsplit("/", 1)[0] + "/test_predictions", "parquet")
    again = binary_metrics(stored, label, M.PREDICTION)
    logged = registry.runs().where(F.col("run_id") == row["run_id"]).select("metrics")
    ok = lambda m: (F.abs(F.col("metrics")[f"test_{m}"] - F.col(m)) < 1e-12).cast("int").alias(f"{m}_ok")
    facts = [F.lit(row[c]).alias(c) for c in ("name", "version", "n_train", "n_test")]
    flags = [F.lit(int(row[c])).alias(c) for c in ("promote", "archive")]
    return again.join(logged).select(*facts, *flags, *[ok(m) for m in METRIC_NAMES])  # one row with one row


def q_train_job(spark, sf_dir):
    """B2 on binding D: row counts, registered version, promotion decision, metrics against stored predictions."""
    registry = _registry(spark)
    return _job_facts(spark, registry, train(spark, _doc_tables(spark, sf_dir), registry), "quality")


def q_score_job(spark, sf_dir):
    """B3 on binding R: train + promote, then score the labels table (keys + label) and write predictions."""
    cfg = _doc_tables(spark, sf_dir, by_rule=True)
    registry = _registry(spark)
    train(spark, cfg, registry)
    out = f"{_database(spark, 'scored')}.predictions"
    batch_inference(spark, InferenceConfig(cfg.model_name, cfg.labels_table.name, cfg.feature_table.name, DOC_KEY, out,
                                           output_location=scratch_path(spark, "scored")), registry)
    return read_table(spark, out)


def q_batch_inference(spark, sf_dir):
    """M12 on binding R (lazy scoring of the labels input through the promoted model)."""
    from scorebook.plans.pipelines import score

    cfg = _doc_tables(spark, sf_dir, by_rule=True)
    registry = _registry(spark)
    train(spark, cfg, registry)
    return score(spark, InferenceConfig(cfg.model_name, cfg.labels_table.name, cfg.feature_table.name, DOC_KEY), registry)


def q_initial_train_job(spark, sf_dir):
    """B4 on binding O: features job (no one-hot; rows with a missing value dropped), then training."""
    db = _database(spark, "orders")
    features = FeatureTableConfig(db, "orders_features", ORDER_KEY)
    labels = LabelsTableConfig(db, "orders_labels", "label", ORDER_KEY, path=scratch_path(spark, "orders_labels"))
    cfg = TrainConfig(features, labels, SHIPPED_SPLIT, SHIPPED_FOREST, model_name="order_filled")
    registry = _registry(spark)
    done = run_initial_train(spark, B.raw_orders(spark, sf_dir), _order_featurizer(False, True), cfg, registry)
    return _job_facts(spark, registry, done, "label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_input": q_scan_input,
    "csv_ingest": q_csv_ingest,
    "range_smoke": q_range_smoke,
    "label_encode": q_label_encode,
    "one_hot": q_one_hot,
    "clean_column_names": q_clean_column_names,
    "drop_missing": q_drop_missing,
    "featurize": q_featurize,
    "column_roles": q_column_roles,
    "feature_table_write": q_feature_table_write,
    "labels_table_write": q_labels_table_write,
    "predictions_overwrite": q_predictions_overwrite,
    "predictions_append": q_predictions_append,
    "training_join": q_training_join,
    "score_join": q_score_join,
    "stratified_split": q_stratified_split,
    "split_counts": q_split_counts,
    "median_impute": q_median_impute,
    "one_hot_unknown": q_one_hot_unknown,
    "assemble": q_assemble,
    "train_score": q_train_score,
    "model_round_trip": q_model_round_trip,
    "signature": q_signature,
    "input_example": q_input_example,
    "binary_metrics": q_binary_metrics,
    "roc_auc": q_roc_auc,
    "roc_auc_ovo": q_roc_auc_ovo,
    "roc_auc_pairs": q_roc_auc_pairs,
    "metrics_row": q_metrics_row,
    "register_version": q_register_version,
    "champion_select": q_champion_select,
    "promotion_decision": q_promotion_decision,
    "apply_promotion": q_apply_promotion,
    "resolve_stage": q_resolve_stage,
    "features_job": q_features_job,
    "train_job": q_train_job,
    "score_job": q_score_job,
    "batch_inference": q_batch_inference,
    "initial_train_job": q_initial_train_job,
}
