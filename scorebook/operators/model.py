"""Preprocessing + random forest as one ``pyspark.ml`` Pipeline.

Numeric columns: exact-median imputation. String (and date) columns: nulls become their own category, and a
dictionary table gives each category its place (``operators.categories``), so a category unseen at fit time is
nowhere in the vector. Everything is one sparse vector for a distributed random forest.

The pipeline's first stage copies each feature column to an internal name, so feature columns may hold dots or
spaces in their names, and an input may have a ``prediction``, ``features`` or ``probability`` column of its own
(``predict`` replaces ``prediction``). Column names starting with ``__sb_`` are reserved.
"""

from __future__ import annotations

import math
import warnings
from typing import Any, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.operators.categories import FeatureEncoder
from scorebook.operators.forest import MAX_SCORED, fit_forest, predicted_class, read_nodes
from scorebook.operators.impute import ExactMedianImputer
from scorebook.session import scratch_root

PREDICTION = "prediction"
BROADCAST_BYTES = 8 << 20
FEATURES, LABEL, OUTPUT = "__sb_features", "__sb_label", "__sb_prediction"
RAW, PROBABILITY = "__sb_raw", "__sb_probability"
MAX_DEPTH = 30  # Spark's limit for tree depth

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType, T.BooleanType)
CATEGORICAL_TYPES = (T.StringType, T.DateType)


def column_roles(schema: T.StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns by type; other types are rejected by name."""
    numeric, categorical, bad = [], [], []
    for f in schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            numeric.append(f.name)
        elif isinstance(f.dataType, CATEGORICAL_TYPES):
            categorical.append(f.name)
        else:
            bad.append(f"{f.name}: {f.dataType.simpleString()}")
    if bad:
        raise TypeError(f"unsupported feature column type(s): {bad}")
    return numeric, categorical


def forest_params(model_params: Mapping[str, Any]) -> dict:
    """Translate the reference's forest parameter names to ``RandomForestClassifier`` ones."""
    out: dict[str, Any] = {}
    for key, value in model_params.items():
        if key == "n_estimators":
            out["numTrees"] = int(value)
        elif key == "max_depth":
            if value is None:
                warnings.warn(f"unlimited depth is not available here: trees stop at depth {MAX_DEPTH}", stacklevel=2)
            depth = MAX_DEPTH if value is None else int(value)
            if depth > MAX_DEPTH:
                raise ValueError(f"max_depth={depth} is above Spark's limit of {MAX_DEPTH}")
            out["maxDepth"] = depth
        elif key == "min_samples_leaf":
            out["minInstancesPerNode"] = int(value)
        elif key == "max_features":
            if value is None:
                out["featureSubsetStrategy"] = "all"
            elif value in ("sqrt", "log2"):
                out["featureSubsetStrategy"] = value
            elif value == "auto":
                out["featureSubsetStrategy"] = "sqrt"
            elif isinstance(value, bool):
                raise ValueError(f"max_features={value!r} is not supported")
            elif isinstance(value, int):
                out["featureSubsetStrategy"] = str(value)
            elif isinstance(value, float) and 0.0 < value <= 1.0:
                out["featureSubsetStrategy"] = repr(value)
            else:
                raise ValueError(f"max_features={value!r} is not supported")
        elif key == "random_state":
            if value is not None:
                out["seed"] = int(value)
        elif key == "criterion":
            out["impurity"] = {"gini": "gini", "entropy": "entropy"}[value]
        elif key == "bootstrap":
            out["bootstrap"] = bool(value)
        elif key == "max_samples":
            if value is not None:
                out["subsamplingRate"] = float(value)
        else:
            raise ValueError(f"unknown model parameter {key!r}")
    return out


def numeric_name(i: int) -> str:
    return f"__sb_n{i}"


def category_name(i: int) -> str:
    return f"__sb_c{i}"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def internal_columns(numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """Adds each feature column under its internal name. A category is written with a leading 'v', a null is 'n':
    no text of the data can be taken for a missing value."""
    added = [f"CAST({_quoted(c)} AS DOUBLE) AS {numeric_name(i)}" for i, c in enumerate(numeric)]
    added += [f"coalesce(concat('v', CAST({_quoted(c)} AS STRING)), 'n') AS {category_name(i)}" for i, c in enumerate(categorical)]
    return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")


def preprocess_stages(numeric: Sequence[str], categorical: Sequence[str], max_categories: int | None = None,
                      keep_input: bool = True) -> list:
    """M2-M4 stages: impute numerics, learn the categories (of any number, unless ``max_categories`` bounds them) and
    write the vector ``FEATURES``: numerics first, then one position per category and text column, ascending.
    ``keep_input`` persists the numeric columns while their medians are learnt."""
    if not numeric and not categorical:
        raise ValueError("no feature columns")
    numbers, texts = [numeric_name(i) for i in range(len(numeric))], [category_name(i) for i in range(len(categorical))]
    imputer = [ExactMedianImputer(inputCols=numbers, keepInput=keep_input)] if numeric else []
    encoder = FeatureEncoder(inputCols=texts, numericCols=numbers, outputCol=FEATURES, maxCategories=max_categories or 0,
                             names=list(categorical))
    return [internal_columns(numeric, categorical), *imputer, encoder]


# Execution settings of the forest (they do not change the model): node-statistics memory per iteration,
# and node ids cached between levels with a lineage cut every 10 iterations (deep trees on big data).
FOREST_EXECUTION = {"maxMemoryInMB": 1024, "cacheNodeIds": True, "checkpointInterval": 10}


# The forest holds every row as a dense array of all positions (4 bytes each): a wider vector is refused by name.
MAX_POSITIONS = 1_000_000


def forest_stage(model_params: Mapping[str, Any]) -> RandomForestClassifier:
    """M5; its label column is ``LABEL``."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, predictionCol=OUTPUT, rawPredictionCol=RAW,
                                  probabilityCol=PROBABILITY, **FOREST_EXECUTION, **forest_params(model_params))


def fit_layout(df: DataFrame, keys: Sequence[str], partitions: int, copies_per_task: int = 100_000,
               n_rows: int | None = None) -> DataFrame:
    """A fixed partition layout: the forest's result for a seed depends on it, so fix it for reproducibility. Rows go
    to the partition of their hash, in one shuffle. Only a row with more than ``copies_per_task`` copies would make
    one task large: a pass over the row hashes finds such rows, which then travel as one row with a number and are
    written out in runs that are partitions of their own. The same rows always land in the same place."""
    columns = [F.col(_quoted(c)) for c in df.columns]
    hashed = df.withColumn("__sb_row", F.xxhash64(*columns))
    order = [*[F.col(_quoted(k)) for k in keys], "__sb_row"]
    place = lambda rows: rows.repartition(partitions, "__sb_row").sortWithinPartitions(*order).select(*columns)
    if n_rows is not None and n_rows <= copies_per_task:
        return place(hashed)
    hot = hashed.groupBy("__sb_row").count().where(F.col("count") > copies_per_task).select("__sb_row").persist()
    try:
        n_hot = hot.count()  # at most rows / copies_per_task
        if not n_hot:
            return place(hashed)
        scratch_root(df.sparkSession)
        hot = hot.checkpoint(eager=True)
    finally:
        hot.unpersist()
    side = F.broadcast(hot) if n_hot * 16 <= BROADCAST_BYTES else hot
    counted = hashed.join(side, "__sb_row", "left_semi").groupBy(*columns, "__sb_row").agg(F.count(F.lit(1)).alias("__sb_n"))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__sb_n") - 1) / copies_per_task))
    cut = counted.withColumn("__sb_run", F.explode(runs))
    here = F.least(F.lit(copies_per_task).cast("long"), F.col("__sb_n") - F.col("__sb_run") * copies_per_task)
    laid = cut.withColumn("__sb_n", here).repartition(partitions, "__sb_row", "__sb_run").sortWithinPartitions(*order, "__sb_run")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__sb_n"))).alias("__sb_copy")
    return place(hashed.join(side, "__sb_row", "left_anti")).unionByName(laid.select(*columns, each).drop("__sb_copy"))


def default_fit_partitions(n_rows: int, rows_per_partition: int = 1_000_000) -> int:
    """Deterministic in the row count, so the same data always gets the same layout."""
    return max(8, math.ceil(n_rows / rows_per_partition))


def fit(train: DataFrame, label_col: str, keys: Sequence[str], model_params: Mapping[str, Any],
        include_keys: bool = False, partitions: int | None = None, n_rows: int | None = None,
        max_categories: int | None = None, max_positions: int | None = MAX_POSITIONS) -> PipelineModel:
    """M6, M7: fit the whole pipeline on ``train`` (keys excluded from the features unless ``include_keys``). Text
    columns may have any number of categories (a table beside the model) unless ``max_categories`` bounds it; the
    forest takes vectors of up to ``max_positions``."""
    exclude = [label_col] + ([] if include_keys else list(keys))
    numeric, categorical = column_roles(train.schema, exclude)
    labelled = train.withColumn(LABEL, F.col(_quoted(label_col)).cast("double"))
    n_rows = n_rows if n_rows is not None else train.count()
    # Every stage fit reads the same rows: keep the fixed layout materialised for the duration of the fit.
    laid_out = fit_layout(labelled, keys, partitions or default_fit_partitions(n_rows), n_rows=n_rows).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        prepared = Pipeline(stages=preprocess_stages(numeric, categorical, max_categories, keep_input=False)).fit(laid_out)
        width = prepared.stages[-1].width()
        if max_positions is not None and width > max_positions:
            raise ValueError(f"{width} feature positions: the forest holds dense rows, so {max_positions} is the most; "
                             "leave wide text columns out or set max_categories")
        # The forest reads its input several times (size, splits, bins): labels and vectors, computed once.
        vectors = prepared.transform(laid_out).select(LABEL, FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            encoder = prepared.stages[-1]
            forest = fit_forest(forest_stage(model_params), vectors, len(encoder.numeric()), encoder.getOrDefault(encoder.widths))
            return PipelineModel(stages=[*prepared.stages, forest])
        finally:
            vectors.unpersist()
    finally:
        laid_out.unpersist()


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every input column plus ``prediction`` as the label's int class; an input column of that name is
    replaced."""
    *prepared, forest = model.stages
    trees = getattr(forest, "scoring", None)  # as left there by the fit or by ``load_model``
    scored = PipelineModel(prepared).transform(df) if trees else model.transform(df)
    kept = [F.col(_quoted(c)) for c in df.columns if c != PREDICTION]
    return scored.select(*kept, (predicted_class(trees, FEATURES) if trees else F.col(OUTPUT).cast("int")).alias(PREDICTION))


def save_model(model: PipelineModel, path: str) -> str:
    """M9."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    model = PipelineModel.load(path)
    last = len(model.stages) - 1
    if isinstance(model.stages[last], RandomForestClassificationModel) and model.stages[last].numFeatures <= MAX_SCORED:
        model.stages[last].scoring = read_nodes(PipelineSharedReadWrite.getStagePath(model.stages[last].uid, last, last + 1, f"{path}/stages"))
    return model


def signature(df: DataFrame, label_col: str) -> list[tuple[str, str, str]]:
    """(column, type, role) of the model input and its label."""
    return [(f.name, f.dataType.simpleString(), "label" if f.name == label_col else "input") for f in df.schema.fields]


def check_signature(expected: Sequence[tuple[str, str, str]], schema: T.StructType) -> None:
    """Refuse input that the model was not trained on: missing input columns and changed types, all named in one
    error. Further columns are ignored."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    inputs = [(c, t) for c, t, role in expected if role == "input"]
    missing = [c for c, _ in inputs if c not in types]
    changed = [f"{c}: {t} at training, {types[c]} now" for c, t in inputs if c in types and types[c] != t]
    problems = [f"missing column(s) {missing}"] * bool(missing) + [f"changed type(s) {changed}"] * bool(changed)
    if problems:
        raise ValueError("the input does not fit the model's signature: " + "; ".join(problems))


def column_profile(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """``(column, type, role, non_missing)`` for the given columns, the counts from one aggregation pass over
    the whole frame (null and NaN count as missing), unpivoted on the executors."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(roles)

    def present(c):
        v = F.col(f"`{c}`")
        return F.count(F.when(~F.isnan(v), 1)) if isinstance(types[c], (T.FloatType, T.DoubleType)) else F.count(v)

    counts = df.agg(*[present(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c].simpleString()).alias("type"),
                 F.lit(roles[c]).alias("role"), F.col(f"c{i}").alias("non_missing"))
        for i, c in enumerate(cols)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def input_example(train: DataFrame, keys: Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` training rows by key (a top-n: the limit is the feature)."""
    return train.orderBy(*keys).limit(n)
