"""Metrics as aggregations: undefined ratios, ties in AUC, measured AUC, scalable path."""

import random

import pytest

from scorebook.operators.metrics import auc_of_totals, binary_metrics, multiclass_auc, pairwise_auc, roc_auc
from scorebook.plans import queries as Q
from tests.conftest import SF01


def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "y int, p int")
    r = binary_metrics(df, "y", "p").first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)
    assert r.accuracy == pytest.approx(1 / 3)


def test_metrics_values(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "y int, p int")
    r = binary_metrics(df, "y", "p", prefix="test_").first()
    assert r.test_accuracy == pytest.approx(0.6)
    assert r.test_precision == pytest.approx(2 / 3)
    assert r.test_recall == pytest.approx(2 / 3)
    assert r.test_f1 == pytest.approx(2 / 3)


def test_auc_ties_get_half_credit(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert roc_auc(df, "y", "s").first()[0] == pytest.approx(0.875)
    assert roc_auc(df, "y", "s", single_task_rows=0, buckets=4).first()[0] == pytest.approx(0.875)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert roc_auc(df, "y", "s").first()[0] is None


def test_auc_documents_measured_value(spark):
    joined = Q.q_training_join(spark, SF01)
    assert round(roc_auc(joined, "quality", "n_chars").first()[0], 9) == 0.512109415
    assert round(roc_auc(joined, "quality", "n_chars", buckets=16, single_task_rows=0).first()[0], 9) == 0.512109415


def test_null_labels_are_refused(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (None, 1, 0.8), (0, 0, 0.1)], "y int, p int, s double")
    for query in (lambda: binary_metrics(df, "y", "p"), lambda: roc_auc(df, "y", "s")):
        with pytest.raises(Exception, match="holds nulls"):
            query().collect()


def test_null_predictions_and_scores_are_refused(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, None, None), (0, 0, 0.1)], "y int, p int, s double")
    with pytest.raises(Exception, match="prediction column 'p' holds nulls"):
        binary_metrics(df, "y", "p").collect()
    for kw in ({}, {"buckets": 4, "single_task_rows": 0}):
        with pytest.raises(Exception, match="score column 's' holds nulls"):
            roc_auc(df, "y", "s", **kw).collect()


def _three_classes(n=240):
    rng = random.Random(4)
    rows = []
    for _ in range(n):
        y = rng.choice("aabccc")
        rows.append((y, *[round(rng.random() + 0.3 * (y == k), 1) for k in "abc"]))
    return rows


def _pair(rows, a, b):
    """AUC of a by its own score against b, by comparing all pairs of rows."""
    i = 1 + "abc".index(a)
    pos, neg = [r[i] for r in rows if r[0] == a], [r[i] for r in rows if r[0] == b]
    return sum((x > y) + 0.5 * (x == y) for x in pos for y in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("kw", [{}, {"single_task_rows": 0, "buckets": 3}])
def test_multiclass_auc_equals_all_pairs_of_rows(spark, kw):
    rows = _three_classes()
    df = spark.createDataFrame(rows, "y string, a double, b double, c double").repartition(3)
    scores = {k: k for k in "abc"}
    want = {(a, b): (_pair(rows, a, b) + _pair(rows, b, a)) / 2 for a, b in (("a", "b"), ("a", "c"), ("b", "c"))}
    got = {(r["first"], r["second"]): r.auc for r in pairwise_auc(df, "y", scores, **kw).collect()}
    assert got == pytest.approx(want)
    size = {p: sum(r[0] in p for r in rows) for p in want}
    assert multiclass_auc(df, "y", scores, **kw).first()[0] == pytest.approx(sum(want[p] * size[p] for p in want) / sum(size.values()))
    assert multiclass_auc(df, "y", scores, "macro", **kw).first()[0] == pytest.approx(sum(want.values()) / 3)


def test_multiclass_auc_edges(spark):
    scores = {k: k for k in "abc"}
    schema = "y string, a double, b double, c double"
    two = spark.createDataFrame([("a", 0.9, 0.1, 0.0), ("b", 0.2, 0.8, 0.0), ("b", 0.95, 0.7, 0.0)], schema)  # no c
    assert multiclass_auc(two, "y", scores).first()[0] == pytest.approx((0.5 + 1.0) / 2)
    assert multiclass_auc(two.where("y = 'a'"), "y", scores).first()[0] is None
    assert multiclass_auc(spark.createDataFrame([], schema), "y", scores).first()[0] is None
    for row, message in ((("z", 0.1, 0.1, 0.1), "without a score"), ((None, 0.1, 0.1, 0.1), "holds nulls"), (("a", 0.1, None, 0.1), "score column 'b' holds nulls")):
        with pytest.raises(Exception, match=message):
            multiclass_auc(two.union(spark.createDataFrame([row], schema)), "y", scores).collect()
    with pytest.raises(ValueError, match="two classes"):
        pairwise_auc(two, "y", {"a": "a"})
    with pytest.raises(ValueError, match="average"):
        multiclass_auc(two, "y", scores, "micro")


def test_auc_of_billions(spark):
    totals = spark.createDataFrame([(0.75 * 5e9 * 5e9, 5_000_000_000, 5_000_000_000)], "area double, P long, N long")
    assert totals.select(auc_of_totals()).first()[0] == pytest.approx(0.75)
