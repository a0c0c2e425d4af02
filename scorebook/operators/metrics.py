"""Binary classification metrics (E1-E6) as aggregations; nothing is collected but the final numbers."""

from __future__ import annotations

import math
from typing import Any, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.functions.expressions import ratio_or_zero
from scorebook.operators.ranks import SINGLE_TASK_ROWS, prefix_sums

SCORES_PER_BUCKET = 250_000
METRIC_NAMES = ("accuracy", "precision", "recall", "f1")


def _null_message(kind: str, col: str):
    return F.lit(f"the {kind} column {col!r} holds nulls; drop or fix them before computing metrics")


def _present(kind: str, col: str, result, type_: str):
    """``result``, or an error where the column is null when the row is read."""
    return F.when(F.col(col).isNull(), F.raise_error(_null_message(kind, col)).cast(type_)).otherwise(result)


def _equals(kind: str, col: str, positive):
    """Whether the column is the positive class; a null is an error."""
    return _present(kind, col, F.col(col) == F.lit(positive), "boolean")


def confusion(df: DataFrame, label_col: str, pred_col: str, positive=1) -> DataFrame:
    """One row: tp, fp, fn, tn, n (longs), in one aggregation pass with map-side partial sums. A null label or
    prediction is an error."""
    marked = df.select(_equals("label", label_col, positive).alias("y"), _equals("prediction", pred_col, positive).alias("p"))
    y, p = F.col("y"), F.col("p")
    return marked.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
        F.count(F.lit(1)).cast("long").alias("n"),
    )


def binary_metrics(df: DataFrame, label_col: str, pred_col: str, prefix: str = "", positive=1) -> DataFrame:
    """Accuracy, precision, recall, F1 (positive class ``positive``); an undefined ratio is 0.0."""
    c = confusion(df, label_col, pred_col, positive)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    return c.select(
        ratio_or_zero(tp + tn, n).alias(f"{prefix}accuracy"),
        ratio_or_zero(tp, tp + fp).alias(f"{prefix}precision"),
        ratio_or_zero(tp, tp + fn).alias(f"{prefix}recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias(f"{prefix}f1"),
    )


def auc_of_totals():
    """area / (P * N) as doubles: the product of two counts can pass the range of a long."""
    p, n = F.col("P").cast("double"), F.col("N").cast("double")
    return F.when((p > 0) & (n > 0), F.col("area").cast("double") / (p * n))


def roc_auc(df: DataFrame, label_col: str, score_col: str, metric_prefix: str = "", positive=1,
            buckets: int | None = None, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """E5: ROC AUC with ties at half credit: sum over distinct scores of p * (negatives below + n / 2),
    divided by P * N; null when a class is absent. A null label or score is an error. Scores are first reduced to one row per distinct score;
    the running count of negatives is one window task only while the distinct scores are proven few (a
    sketch pass), and bucketed prefix sums otherwise."""
    y = F.col(label_col) == F.lit(positive)
    # One group of null scores, and its size, come out of the same pass; whether any is there is asked at the end.
    per_score = df.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"), F.count_if(F.col(label_col).isNull()).alias("unlabelled"),
        F.count_if(F.col(score_col).isNull()).alias("unscored"),
    )
    distinct = df.agg(F.approx_count_distinct(score_col, 0.02).alias("d")).first()["d"]
    buckets = buckets or max(8, math.ceil(distinct * 1.1 / SCORES_PER_BUCKET))
    ranked = prefix_sums(per_score, ["score"], {"neg": F.col("neg")}, buckets=buckets,
                         largest_group=int(distinct * 1.1) + 1, single_task_rows=single_task_rows)
    total = ranked.agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("area"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum("unlabelled").alias("unlabelled"),
        F.sum("unscored").alias("unscored"),
    )
    refused = F.when(F.col("unlabelled") > 0, F.raise_error(_null_message("label", label_col)).cast("double")).when(
        F.col("unscored") > 0, F.raise_error(_null_message("score", score_col)).cast("double"))
    return total.select(refused.otherwise(auc_of_totals()).alias(f"{metric_prefix}roc_auc_score"))


def pairwise_auc(df: DataFrame, label_col: str, score_cols: Mapping[Any, str], single_task_rows: int = SINGLE_TASK_ROWS,
                 buckets: int | None = None) -> DataFrame:
    """One row per pair of classes: first, second, auc (the mean of the AUC of the first class by its own score and
    that of the second by its own, among the rows of both) and rows. ``score_cols`` gives each class its score column.

    A row of class c meets each other class d twice: as a positive by the score of c, as a negative by the score of
    d. Rows are counted per (scored class, other class, score) before any shuffle, and the running count of negatives
    is taken per ordered pair; no pair of rows is ever formed. A null label or score, and a label without a score
    column, are errors when the row is read; a pair with an absent class has a null auc."""
    classes = list(score_cols)
    if len(classes) < 2:
        raise ValueError("pairwise AUC needs at least two classes")
    place = F.lit(None).cast("int")
    for i, k in enumerate(classes):
        place = F.when(F.col(label_col) == F.lit(k), F.lit(i)).otherwise(place)
    unknown = F.raise_error(F.concat(F.lit(f"label without a score column in {label_col!r}: "), F.col(label_col).cast("string"))).cast("int")
    own = _present("label", label_col, F.coalesce(place, unknown), "int")
    scores = F.array(*[_present("score", c, F.col(c).cast("double"), "double") for c in score_cols.values()])
    rows = df.select(own.alias("own"), scores.alias("scores")).select("own", "scores", F.explode(F.sequence(F.lit(0), F.lit(len(classes) - 1))).alias("other")).where("own <> other")
    sides = rows.select(F.explode(F.array(
        F.struct(F.col("own").alias("scored"), F.col("other").alias("against"), F.col("scores")[F.col("own")].alias("score"), F.lit(1).alias("pos")),
        F.struct(F.col("other").alias("scored"), F.col("own").alias("against"), F.col("scores")[F.col("other")].alias("score"), F.lit(0).alias("pos")),
    )).alias("s")).select("s.*")
    counted = sides.groupBy("scored", "against", "score").agg(F.sum("pos").alias("pos"), (F.count("*") - F.sum("pos")).alias("neg")).persist()
    try:
        sizes = counted.groupBy("scored", "against").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    finally:
        counted.unpersist()
    ranked = prefix_sums(counted, ["score"], {"neg": F.col("neg")}, ["scored", "against"], known_groups=len(classes) ** 2,
                         largest_group=sizes, buckets=buckets or max(8, math.ceil(sizes / SCORES_PER_BUCKET)), single_task_rows=single_task_rows)
    ordered = ranked.groupBy("scored", "against").agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("area"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    names = F.array(*[F.lit(k) for k in classes])
    pairs = ordered.groupBy(F.least("scored", "against").alias("i"), F.greatest("scored", "against").alias("j")).agg(
        F.when(F.count(auc_of_totals()) == 2, F.avg(auc_of_totals())).alias("auc"), F.max(F.col("P") + F.col("N")).alias("rows"))
    return pairs.select(names[F.col("i")].alias("first"), names[F.col("j")].alias("second"), "auc", "rows")


def multiclass_auc(df: DataFrame, label_col: str, score_cols: Mapping[Any, str], average: str = "weighted",
                   metric_prefix: str = "", **kwargs) -> DataFrame:
    """E5 for several classes, one against one: the mean of ``pairwise_auc`` over the pairs of the classes that occur,
    'weighted' by how many rows each pair has, or 'macro' (all pairs alike). Null where fewer than two classes occur."""
    if average not in ("weighted", "macro"):
        raise ValueError(f"average must be 'weighted' or 'macro', got {average!r}")
    pairs = pairwise_auc(df, label_col, score_cols, **kwargs).where("auc is not null")
    weight = F.col("rows").cast("double") if average == "weighted" else F.lit(1.0)
    total = pairs.agg(F.sum(F.col("auc") * weight).alias("area"), F.sum(weight).alias("weight"))
    return total.select((F.col("area") / F.nullif("weight", F.lit(0.0))).alias(f"{metric_prefix}roc_auc_score"))


def metrics_row(df: DataFrame, label_col: str, pred_col: str, run_id: str) -> DataFrame:
    """One row ``run_id, test_accuracy, test_precision, test_recall, test_f1``."""
    return binary_metrics(df, label_col, pred_col, prefix="test_").select(
        F.lit(run_id).alias("run_id"), *[f"test_{m}" for m in METRIC_NAMES]
    )
