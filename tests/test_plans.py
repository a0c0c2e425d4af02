"""Physical-plan properties that matter at scale: pruning, pushdown, bucketed joins, shared shuffles."""

from pyspark.sql import functions as F

from scorebook.config import FeatureTableConfig
from scorebook.operators.joins import score_join
from scorebook.operators.split import assign_split
from scorebook.plans import queries as Q
from scorebook.session import unique_name
from scorebook.sources.catalog import write_feature_table
from scorebook.sources.tables import read_parquet_table
from tests.conftest import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_join_prunes_text_and_pushes_null_filter(spark):
    plan = _plan(Q.q_training_join(spark, SF01))
    schemas = [part.split(",")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert schemas and not any("text:" in sc for sc in schemas)
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan
    assert "PushedFilters: [IsNotNull(doc_id)]" in plan


def test_bucketed_feature_table_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = FeatureTableConfig(unique_name("plan"), "features", "doc_id", buckets=8)
        write_feature_table(spark, Q.B.doc_features(spark, SF01), cfg)
        joined = score_join(Q.B.doc_labels(spark, SF01), spark.table(cfg.name), "doc_id")
        plan = _plan(joined)
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1  # the labels side only
        assert joined.count() == 399
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_is_one_expression_over_one_scan(spark):
    df = read_parquet_table(spark, SF01, "orders").selectExpr("o_orderkey", "o_totalprice", "cast(o_orderkey % 2 as int) AS y")
    plan = _plan(assign_split(df, "y", "o_orderkey"))
    assert plan.count("Scan parquet") == 1
    assert not any(step in plan for step in ("Exchange", "Window", "Union", "Join"))
    # A key with several rows across the seats is decided by a second boundary, still without a shuffle.
    doubled = df.withColumn("o_orderkey", (F.col("o_orderkey") / 40).cast("long"))
    assert not any(step in _plan(assign_split(doubled, "y", "o_orderkey")) for step in ("Exchange", "Window", "Union", "Join"))


def test_split_passes_read_keys_and_labels_only(spark):
    joined = Q.q_training_join(spark, SF01)
    plan = _plan(assign_split(joined, "quality", "doc_id"))
    assert plan.count("Scan parquet") == 2  # labels and documents, once each


def test_bucketed_write_is_one_file_per_bucket(spark):
    import os

    from pyspark.sql import functions as F

    from scorebook.sources.catalog import bucket_count

    docs = Q.B.doc_features(spark, SF01).repartition(5)  # several writing tasks
    cfg = FeatureTableConfig(unique_name("plan"), "features", "doc_id", buckets="auto")
    assert bucket_count(docs, cfg) == 8
    assert bucket_count(docs, FeatureTableConfig("d", "t", "doc_id", buckets="auto", rows_per_bucket=100)) == 10
    write_feature_table(spark, docs, cfg)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {cfg.name}").where("col_name = 'Location'").first()[1]
    files = [f for f in os.listdir(location.removeprefix("file:")) if f.endswith(".parquet")]
    assert 0 < len(files) <= 8
    assert spark.table(cfg.name).count() == docs.count()
    # A key holding a third of the rows would make one bucket (one task) hold them: no bucketing then.
    hot = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(0)).otherwise(F.col("doc_id")))
    assert bucket_count(hot, FeatureTableConfig("d", "t", "doc_id", buckets="auto", rows_per_bucket=100)) is None
    assert bucket_count(hot, FeatureTableConfig("d", "t", "doc_id", buckets=4)) == 4  # explicit: as asked


def test_hot_input_key_reads_the_features_unbucketed(spark):
    from pyspark.sql import functions as F

    from scorebook.sources.catalog import feature_side

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = FeatureTableConfig(unique_name("plan"), "features", "doc_id", buckets=8)
        write_feature_table(spark, Q.B.doc_features(spark, SF01), cfg)
        labels = Q.B.doc_labels(spark, SF01)
        plain = feature_side(spark, cfg.name, labels, ["doc_id"], rows_per_bucket=10)
        assert "Bucketed: true" in _plan(score_join(labels, plain, "doc_id"))
        # A third of the input rows on one key: one bucket would be one oversized task.
        first = labels.agg(F.min("doc_id")).first()[0]
        hot = labels.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(first)).otherwise(F.col("doc_id")))
        side = feature_side(spark, cfg.name, hot, ["doc_id"], rows_per_bucket=10)
        joined = score_join(hot, side, "doc_id")
        assert "Bucketed: true" not in _plan(joined)
        assert joined.count() == score_join(hot, spark.table(cfg.name), "doc_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unbucketed_feature_table_is_returned_as_is(spark):
    from scorebook.sources.catalog import feature_side, table_layout

    cfg = FeatureTableConfig(unique_name("plan"), "features", "doc_id")
    write_feature_table(spark, Q.B.doc_features(spark, SF01), cfg)
    assert "Num Buckets" not in table_layout(spark, cfg.name)
    side = feature_side(spark, cfg.name, Q.B.doc_labels(spark, SF01), ["doc_id"])
    assert side.columns == spark.table(cfg.name).columns and side.count() == 1000
