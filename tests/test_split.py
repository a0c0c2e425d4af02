"""Stratified split: the documented size rule, errors, and the scalable path."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorebook.operators.split import assign_split, split_sizes
from scorebook.plans import queries as Q
from tests.conftest import SF01


def test_two_of_each_class_split_in_half(spark):
    df = spark.createDataFrame([("p", "x", -1), ("q", "x", -2), ("r", "y", -3), ("s", "y", -4)], "name string, kind string, v int")
    marked = assign_split(df, "kind", "name", 0.5, 3)
    assert marked.columns == ["name", "kind", "v", "split"]
    got = {(r.kind, r.split) for r in marked.collect()}
    assert got == {("x", "train"), ("x", "test"), ("y", "train"), ("y", "test")}


def test_sizes_rule_matches_measured_values():
    sizes = split_sizes({0: 58, 1: 341}, 0.2)
    assert sizes == {0: (46, 12), 1: (273, 68)}


def test_split_on_documents(spark):
    counts = {(r.quality, r.split): r.n for r in Q.q_split_counts(spark, SF01).collect()}
    assert counts == {(0, "train"): 46, (0, "test"): 12, (1, "train"): 273, (1, "test"): 68}


def test_many_classes(spark):
    df = spark.range(0, 30_000).selectExpr("id", "id % 12000 AS y")
    marked = assign_split(df.where("id < 24000"), "y", "id", 0.5)
    assert marked.where("split = 'train'").count() == 12_000
    assert marked.groupBy("y", "split").count().where("count <> 1").isEmpty()
    with pytest.raises(ValueError, match="classes"):
        assign_split(df, "y", "id", 0.5, max_classes=100)


def test_bucketed_ranks_equal_plain_window(spark):
    joined = Q.q_training_join(spark, SF01)
    plain = assign_split(joined, "quality", "doc_id", 0.2, 42)
    bucketed = assign_split(joined, "quality", "doc_id", 0.2, 42, single_task_rows=0)
    a = {(r.doc_id, r.split) for r in plain.collect()}
    b = {(r.doc_id, r.split) for r in bucketed.collect()}
    assert a == b and len(a) == 399


def test_same_split_twice(spark):
    joined = Q.q_training_join(spark, SF01)
    one = {(r.doc_id, r.split) for r in assign_split(joined, "quality", "doc_id").collect()}
    two = {(r.doc_id, r.split) for r in assign_split(joined.repartition(7), "quality", "doc_id").collect()}
    assert one == two


@pytest.mark.parametrize("counts", [{0: 1, 1: 5}, {1: 6}])
def test_impossible_splits_raise(counts):
    with pytest.raises(ValueError):
        split_sizes(counts, 0.5)


def test_null_labels_rejected(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 0), (4, 1), (5, 0)], "id long, label int")
    with pytest.raises(ValueError, match="null"):
        assign_split(df, "label", "id", 0.4)


def test_unlabelled_rows_can_stay_on_no_side(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(50)], "id long, label int")
    kept = {(r.id, r.split) for r in assign_split(df, "label", "id", 0.25, unlabelled="keep").collect()}
    only = {(r.id, r.split) for r in assign_split(df.where("label is not null"), "label", "id", 0.25).collect()}
    assert kept == only | {(i, None) for i in range(0, 50, 5)}
    with pytest.raises(ValueError, match="unlabelled"):
        assign_split(df, "label", "id", unlabelled="drop")


def test_boundary_of_shared_keys_equals_a_plain_ranking(spark):
    # Every key has several rows, and some rows several copies: the plain rank by (md5, row hash) decides.
    df = spark.range(0, 600).selectExpr("id div 7 AS k", "id div 3 AS v", "cast(id % 2 as int) AS y")
    order = [F.md5(F.concat_ws("|", F.col("k").cast("string"), F.lit("5"))), F.xxhash64("k", "v", "y")]
    ranked = df.withColumn("rk", F.row_number().over(Window.partitionBy("y").orderBy(*order)))
    for test_size in (0.1, 0.33, 0.5):
        for rows in (1_000_000, 0):
            got = assign_split(df, "y", "k", test_size, 5, single_task_rows=rows)
            seats = split_sizes({0: 300, 1: 300}, test_size)
            want = ranked.withColumn("split", F.when(F.col("rk") <= F.when(F.col("y") == 0, seats[0][0]).otherwise(seats[1][0]), "train").otherwise("test"))
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.drop("rk").collect()))


def test_composite_keys(spark):
    df = spark.createDataFrame([(i % 3, i, i % 2) for i in range(20)], "a long, b long, label int")
    marked = assign_split(df, "label", ["a", "b"], 0.25, 7)
    got = marked.groupBy("label", "split").count().collect()
    # 15 train seats, 7.5 per class: the tie goes to the smaller label.
    assert {(r.label, r.split): r["count"] for r in got} == {(0, "train"): 8, (0, "test"): 2, (1, "train"): 7, (1, "test"): 3}
    assert marked.where(F.col("split").isNull()).count() == 0
