"""Forest pipeline: predicted classes, wide and oddly named columns, parameter map, unseen categories, reproducibility, persistence."""

import datetime

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorebook.operators import model as M
from scorebook.operators.featurize import one_hot
from scorebook.session import scratch_path

LOANS = "loan string, term int, rate double, purpose string, opened date, label int"
SMALL = {"n_estimators": 6, "max_depth": 4, "min_samples_leaf": 1, "max_features": "sqrt", "random_state": 11}


def _loans(spark, n):
    rows = [(f"L-{i}", 12 * (i % 5 + 1), 0.5 * (i % 9), ("car", "home", None)[i % 3], datetime.date(2020, 1, 1 + i % 28), int(i % 4 == 0))
            for i in range(n)]
    return spark.createDataFrame(rows, LOANS)


@pytest.mark.parametrize("include_keys", [False, True])
def test_pipeline_predicts_classes(spark, include_keys):
    df = _loans(spark, 40)
    model = M.fit(df, "label", ["loan"], SMALL, include_keys=include_keys)
    preds = [r.prediction for r in M.predict(model, df).collect()]
    assert len(preds) == 40 and set(preds) <= {0, 1}


def test_wide_text_columns_are_not_capped(spark):
    df = spark.range(0, 5000).selectExpr("concat('k', id) AS k", "concat('c', id) AS code", "cast(id % 2 as int) AS label")
    for include_keys in (False, True):
        tiny = SMALL | {"n_estimators": 1, "max_depth": 2}
        model = M.fit(df, "label", ["k"], tiny, include_keys=include_keys)
        assert M.predict(model, df).where("prediction in (0, 1)").count() == 5000


def test_dotted_and_reserved_column_names(spark):
    df = spark.createDataFrame([(i, f"v{i % 3}.0 x", float(i), i % 2, 9, "f") for i in range(30)],
                               "id long, version string, `size.mb` double, label int, prediction int, probability string")
    wide = one_hot(df, ["version"])
    assert "version_v1.0 x" in wide.columns
    out = M.predict(M.fit(wide, "label", ["id"], SMALL), wide)
    assert sorted(out.columns) == sorted(wide.columns) and out.count() == 30
    assert {r.prediction for r in out.collect()} <= {0, 1}


def test_a_null_is_not_a_text(spark):
    df = spark.createDataFrame([("n",), ("v",), (None,), ("__missing__",)], "c string")
    fitted = Pipeline(stages=M.preprocess_stages([], ["c"])).fit(df)
    vectors = {tuple(r.v) for r in fitted.transform(df).select(vector_to_array(M.FEATURES).alias("v")).collect()}
    assert len(vectors) == 4


def test_layout_spreads_copies_of_one_row(spark):
    df = spark.range(0, 6000).selectExpr("if(id % 3 = 0, 0, id) AS k", "cast(if(id % 3 = 0, 1, id % 2) as int) AS y")
    laid = M.fit_layout(df, ["k"], 8, copies_per_task=100)
    per = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 6000 and max(per) < 1500
    assert laid.groupBy("k", "y").count().exceptAll(df.groupBy("k", "y").count()).isEmpty()


def test_forest_params_map():
    assert M.forest_params({"n_estimators": 100, "max_depth": 12, "min_samples_leaf": 1, "max_features": 10,
                            "random_state": 42}) == {"numTrees": 100, "maxDepth": 12, "minInstancesPerNode": 1,
                                                     "featureSubsetStrategy": "10", "seed": 42}
    with pytest.warns(UserWarning, match="depth"):
        assert M.forest_params({"max_depth": None})["maxDepth"] == 30
    with pytest.raises(ValueError, match="bogus"):
        M.forest_params({"bogus": 1})
    with pytest.raises(ValueError):
        M.forest_params({"max_depth": 31})


def test_column_roles_reject_timestamps(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k long, c string, x double").withColumn("t", F.current_timestamp())
    with pytest.raises(TypeError, match="t: timestamp"):
        M.column_roles(df.schema, ["k"])
    assert M.column_roles(df.drop("t").schema, ["k"]) == (["x"], ["c"])


def test_unseen_and_null_categories(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    fitted = Pipeline(stages=M.preprocess_stages([], ["c"])).fit(train)
    test = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None)], "k int, c string")
    rows = {r.k: r.v for r in fitted.transform(test).select("k", vector_to_array(M.FEATURES).alias("v")).collect()}
    assert sum(rows[1]) == 1 and sum(rows[2]) == 0 and sum(rows[3]) == 1
    assert rows[1] != rows[3]


def _docs(spark):
    from tests.conftest import SF01
    from scorebook.plans import queries as Q

    return Q._doc_train_test(spark, SF01)


def test_fit_is_reproducible_and_persists(spark):
    train, test = _docs(spark)
    a = M.fit(train, "quality", ["doc_id"], SMALL)
    b = M.fit(train.repartition(3), "quality", ["doc_id"], SMALL)
    pa = {r.doc_id: r.prediction for r in M.predict(a, test).collect()}
    pb = {r.doc_id: r.prediction for r in M.predict(b, test).collect()}
    assert pa == pb and set(pa.values()) <= {0, 1} and len(pa) == 80
    path = M.save_model(a, scratch_path(spark, "model"))
    pc = {r.doc_id: r.prediction for r in M.predict(M.load_model(path), test).collect()}
    assert pc == pa


def test_predict_keeps_every_row_and_column(spark):
    train, test = _docs(spark)
    model = M.fit(train, "quality", ["doc_id"], SMALL)
    out = M.predict(model, test)
    assert out.columns == test.columns + ["prediction"]
    assert out.count() == test.count()


def test_wide_categorical_feature_rejected(spark):
    df = spark.range(0, 300).selectExpr("id", "cast(id as string) AS code", "cast(id % 2 as int) AS label")
    with pytest.raises(ValueError, match="code"):
        M.fit(df, "label", ["id"], SMALL, max_categories=50)


def test_layout_has_one_wide_shuffle_and_ignores_the_input_layout(spark):
    df = spark.range(0, 900).selectExpr("id % 300 AS k", "cast(id % 2 as int) AS y", "concat('t', id % 7) AS t")
    plan = M.fit_layout(df, ["k"], 8, n_rows=900)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    places = lambda d, **kw: sorted(map(tuple, M.fit_layout(d, ["k"], 8, **kw).withColumn("p", F.spark_partition_id()).collect()))
    assert places(df) == places(df.orderBy(F.rand(3)).repartition(5)) == places(df, n_rows=900)
    one = df.selectExpr("k % 2 AS k", "cast(k % 2 as int) AS y", "'t' AS t")  # two rows, 450 copies each
    assert places(one, copies_per_task=100) == places(one.orderBy(F.rand(4)).repartition(3), copies_per_task=100)


def test_dictionary_ranked_in_one_task_or_many(spark):
    from scorebook.operators import categories as C

    df = spark.range(0, 3000).selectExpr("concat('v', id % 700) AS a", "if(id % 3 = 0, 'hot', concat('x', id)) AS b", "cast(null as string) AS c")
    read = lambda p: sorted(map(tuple, C.read_dictionary(spark, p).collect()))
    one = read(C.write_dictionary(df, ["a", "b", "c"]))
    assert one == read(C.write_dictionary(df, ["a", "b", "c"], single_task_rows=0))
    values = sorted({f"v{i}" for i in range(700)})
    assert [(v, i, 0) for i, v in enumerate(values)] == sorted(r for r in one if r[2] == 0)


def test_encoder_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    from scorebook.operators import categories as C

    df = spark.range(0, 400).selectExpr("id", "if(id % 3 = 0, 'hot', concat('x', id)) AS a", "if(id % 5 = 0, null, 'n') AS b", "id / 8.0 AS x")
    model = C.FeatureEncoder(inputCols=["a", "b"], numericCols=["x"], outputCol="f").fit(df)
    assert model.width() == 1 + 267 + 1
    broadcast = sorted(model.transform(df).select("id", vector_to_array("f")).collect())
    monkeypatch.setattr(C, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = model.transform(df)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.select("id", vector_to_array("f")).collect()) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    names = sorted({"hot"} | {f"x{i}" for i in range(400) if i % 3})
    for i, v in broadcast:
        want = [0.0] * 269
        want[0], want[1 + names.index("hot" if i % 3 == 0 else f"x{i}")] = i / 8.0, 1.0
        want[268] = float(i % 5 != 0)
        assert v == want


def test_too_wide_vectors_are_refused_before_the_forest(spark):
    df = spark.range(0, 200).selectExpr("id", "concat('c', id) AS code", "cast(id % 2 as int) AS label")
    with pytest.raises(ValueError, match="200 feature positions"):
        M.fit(df, "label", ["id"], SMALL, max_positions=100)
