"""The forest's fit: Spark's tree where nothing is drawn, a plain grower with the same draws, the same trees however the
work is cut, and what goes to Spark's trainer."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorebook.operators import forest as FO
from scorebook.operators import model as M
from scorebook.operators.categories import sparse_vector
from scorebook.session import scratch_path

N_NUMERIC, WIDTHS = 2, [3, 2]
SMALL = {"n_estimators": 6, "max_depth": 4, "min_samples_leaf": 1, "max_features": "sqrt", "random_state": 11}


def _vectors(spark, n=700, classes=2):
    """Two numbers (few and many values), three indicators of one text column and two of another, and a noisy label."""
    h = lambda seed, mod: F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(mod))
    base = spark.range(0, n, numPartitions=1).select("id", (h(1, 9) - 4).cast("double").alias("a"), (h(2, 5000) / 7.0).alias("b"), h(3, 4).alias("c"), h(4, 2).alias("d"))
    noisy = F.when(h(5, 5) == 0, h(6, classes)).otherwise(F.pmod((F.col("a") > 0).cast("long") + (F.col("b") > 300).cast("long") + (F.col("c") == 1).cast("long"), F.lit(classes)))
    hot = [F.when(F.col("c") < 3, F.col("c") + 2), F.col("d") + 5]  # a value of c that was never learnt is nowhere
    return base.select(noisy.cast("double").alias(M.LABEL), sparse_vector(7, [F.col("a"), F.col("b")], hot).alias(M.FEATURES)).persist()


def _stage(**params):
    return M.forest_stage({"n_estimators": 1, "max_depth": 6, "min_samples_leaf": 3, "max_features": None, "random_state": 5, "bootstrap": False} | params)


@pytest.mark.parametrize("classes, criterion", [(2, "gini"), (3, "entropy")])
def test_one_tree_without_draws_is_sparks_tree(spark, classes, criterion):
    vectors, stage = _vectors(spark, classes=classes), _stage(criterion=criterion)
    ours, theirs = FO.fit_forest(stage, vectors, N_NUMERIC, WIDTHS), stage.fit(vectors)
    assert ours.toDebugString == theirs.toDebugString and ours.numClasses == classes
    scored = [sorted(map(str, m.transform(vectors).select(M.RAW, M.OUTPUT).collect())) for m in (ours, theirs)]
    assert scored[0] == scored[1]
    assert {p.name: v for p, v in ours.extractParamMap().items()} == {p.name: v for p, v in theirs.extractParamMap().items()}
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


def _gini(counts):
    n = counts.sum()
    return 1.0 - ((counts / n) ** 2).sum()


def _plain_votes(plan, x, y, number, max_depth):
    """Class shares of each row by one tree, grown node by node; draws come from the module under test."""
    bag = FO.bag_counts(plan, FO.poisson_cells(plan.rate), number, 0, 0, len(x)).astype(float)
    splits = [(f, t) for f, *_, t in zip(*plan.candidates())]
    tally = lambda rows: np.array([bag[rows][y[rows] == k].sum() for k in range(plan.classes)])
    every = np.arange(len(x))
    nodes = [{"rows": every, "kids": None}]
    level = [0]
    for depth in range(max_depth):
        drawn, nxt = FO.drawn_features(plan, number, depth, 0, len(level)), []
        for place, i in enumerate(level):
            rows, best = nodes[i]["rows"], (0.0, None)
            total = tally(rows)
            for f, t in splits:
                left = rows[x[rows, f] <= t]
                a, b = tally(left), total - tally(left)
                if drawn[place, f] and min(a.sum(), b.sum()) >= plan.min_rows:
                    gain = _gini(total) - (a.sum() * _gini(a) + b.sum() * _gini(b)) / total.sum()
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, t))
            if best[1]:
                f, t = best[1]
                nodes[i]["kids"] = len(nodes)
                for part in (rows[x[rows, f] <= t], rows[x[rows, f] > t]):
                    if (tally(part) > 0).sum() > 1 and depth + 1 < max_depth:
                        nxt.append(len(nodes))
                    nodes.append({"rows": part, "kids": None})
        level = nxt
    for node in reversed(nodes):
        if node["kids"] and all(nodes[node["kids"] + s]["kids"] is None for s in (0, 1)):
            if len({tally(nodes[node["kids"] + s]["rows"]).argmax() for s in (0, 1)}) == 1:
                node["kids"] = None
    votes, todo = np.zeros((len(x), plan.classes)), [0]
    while todo:
        node = nodes[todo.pop()]
        if node["kids"]:
            todo += [node["kids"], node["kids"] + 1]
        else:
            votes[node["rows"]] = tally(node["rows"]) / tally(node["rows"]).sum()
    return votes


def test_forest_is_that_of_a_plain_grower(spark, monkeypatch):
    vectors = _vectors(spark, 400)
    stage = _stage(n_estimators=4, max_depth=5, max_features=3, bootstrap=True)
    plans = []
    grow = FO.grow_trees
    monkeypatch.setattr(FO, "grow_trees", lambda v, b, plan, *rest: plans.append(plan) or grow(v, b, plan, *rest))
    model = FO.fit_forest(stage, vectors, N_NUMERIC, WIDTHS)
    rows = vectors.select(M.LABEL, vector_to_array(M.FEATURES).alias("x")).collect()
    x, y = np.array([r.x for r in rows]), np.array([r[0] for r in rows], dtype=int)
    want = sum(_plain_votes(plans[0], x, y, t, 5) for t in range(4))
    got = np.array([r[0] for r in model.transform(vectors).select(vector_to_array(M.RAW)).collect()])
    assert np.allclose(got, want)


def test_the_cut_of_the_work_changes_no_tree(spark, monkeypatch):
    vectors = _vectors(spark, 900).repartition(3).persist()
    stage = _stage(n_estimators=5, max_features="sqrt", bootstrap=True)
    monkeypatch.setattr(FO, "CHUNK_CELLS", 200)  # a few nodes a row, so the drawn features stay the same below
    grown = FO.fit_forest(stage, vectors, N_NUMERIC, WIDTHS).toDebugString
    monkeypatch.setattr(FO, "SLICE_CELLS", 400)
    monkeypatch.setattr(FO, "JOB_CELLS", 900)
    assert FO.fit_forest(stage, vectors, N_NUMERIC, WIDTHS, tasks=3).toDebugString == grown


def test_many_values_are_binned_from_all_rows(spark, monkeypatch):
    vectors = _vectors(spark, 5000)
    few = FO.find_thresholds(vectors, M.FEATURES, N_NUMERIC, 5000, 32)
    monkeypatch.setattr(FO, "FEW_VALUES", 100)  # the second number has far more
    many = FO.find_thresholds(vectors, M.FEATURES, N_NUMERIC, 5000, 32)
    assert list(few[0]) == list(many[0]) == [i - 3.5 for i in range(8)]
    b = np.array([r.b for r in vectors.select(vector_to_array(M.FEATURES)[1].alias("b")).collect()])
    for cuts in (few[1], many[1]):
        sizes = np.diff([0, *[(b <= t).sum() for t in cuts], len(b)])
        assert len(sizes) == 32 and abs(sizes - 5000 / 32).max() < 10


def test_bags_are_poisson():
    table, cdf = FO.poisson_cells(0.7)
    plan = FO.Plan([], 1, 2, 9, True, 0.7, 1, "gini", 1, 0.0)
    drawn = FO.bag_counts(plan, (table, cdf), 0, 0, 0, 400_000)
    shares = np.bincount(drawn, minlength=8)[:8] / len(drawn)
    assert np.allclose(shares, np.diff([0, *cdf[:8]]), atol=0.004)
    settled = np.flatnonzero(table != 255)
    assert (table[settled] == np.searchsorted(cdf, (settled + 0.5) / 65536)).all() and len(settled) > 65500
    assert (FO.bag_counts(plan, (table, cdf), 0, 0, 0, 1000) == drawn[:1000]).mean() > 0.99
    assert (FO.bag_counts(plan, (table, cdf), 1, 0, 0, 1000) != drawn[:1000]).any()
    assert set(FO.bag_counts(plan._replace(bootstrap=False), (table, cdf), 0, 0, 0, 1000)) == {0, 1}


def test_positions_must_be_indicators():
    plan = FO.Plan([FO.Codes(0, None, 2)], 2, 2, 1, True, 1.0, 1, "gini", 1, 0.0)
    assert FO.encode(np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 0.0]]), plan).tolist() == [[0, 2, 1]]
    for bad in ([1.0, 1.0], [0.0, 0.5]):
        with pytest.raises(ValueError, match="indicators"):
            FO.encode(np.array([bad]), plan)


def test_subset_sizes():
    assert [FO.subset_size(s, 14, 100) for s in ("auto", "all", "sqrt", "log2", "onethird", "10", "20", "0.5")] == [4, 14, 4, 4, 5, 10, 14, 7]
    assert FO.subset_size("auto", 14, 1) == 14


def test_a_fit_counts_levels_and_leaves_wide_vectors_to_spark(spark, monkeypatch):
    theirs = []
    fit = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: theirs.append(1) or fit(self, df))
    df = spark.range(0, 60).selectExpr("id", "id % 7 AS x", "concat('c', id % 3) AS c", "cast(id % 2 as int) AS label")
    params = {"n_estimators": 2, "max_depth": 3, "random_state": 1}
    M.fit(df, "label", ["id"], params)
    assert not theirs
    monkeypatch.setattr(FO, "MAX_BINS", 5)
    assert M.predict(M.fit(df, "label", ["id"], params), df).count() == 60
    assert len(theirs) == 1


def test_edges(spark):
    vectors = _vectors(spark, 60)
    stump = FO.fit_forest(_stage(max_depth=0), vectors, N_NUMERIC, WIDTHS)
    assert stump.totalNumNodes == 1 and stump.transform(vectors).count() == 60
    one = vectors.withColumn(M.LABEL, F.lit(0.0))
    assert FO.fit_forest(_stage(n_estimators=3, bootstrap=True), one, N_NUMERIC, WIDTHS).totalNumNodes == 3
    empty = FO.fit_forest(_stage(n_estimators=12, bootstrap=True, max_samples=0.01), vectors, N_NUMERIC, WIDTHS)
    bags = [float(t.shares[:, 0].sum()) for t in empty.scoring]
    assert 0.0 in bags and 1.0 in bags  # a tree without a row votes for nothing
    x = np.array([r.x for r in vectors.select(vector_to_array(M.FEATURES).alias("x")).collect()])
    raw = [r.r for r in empty.transform(vectors).select(vector_to_array(M.RAW).alias("r")).collect()]
    assert (FO.class_votes(empty.scoring, x).T == np.array(raw)).all()
    with pytest.raises(Exception, match="(?i)label"):
        FO.fit_forest(_stage(), vectors.withColumn(M.LABEL, F.lit(0.5)), N_NUMERIC, WIDTHS)
    flat = vectors.select(M.LABEL, sparse_vector(1, [F.lit(2.0)], []).alias(M.FEATURES))
    assert FO.fit_forest(_stage(), flat, 1, []).totalNumNodes == 1


def test_rows_are_scored_as_sparks_model_does(spark):
    df = spark.range(0, 500).selectExpr("id", "pmod(xxhash64(id, 1), 90) / 8.0 AS x", "concat('c', pmod(xxhash64(id, 2), 5)) AS c", "cast(pmod(xxhash64(id, 3), 3) as int) AS label")
    model = M.fit(df, "label", ["id"], SMALL)
    want = sorted(model.transform(df).select("id", F.col(M.OUTPUT).cast("int")).collect())
    loaded = M.load_model(M.save_model(model, scratch_path(spark, "model")))
    for m in (model, loaded):
        assert m.stages[-1].scoring
        assert sorted(M.predict(m, df).select("id", "prediction").collect()) == want
        x = np.array([r.x for r in model.transform(df).select(vector_to_array(M.FEATURES).alias("x")).collect()])
        raw = np.array([r.r for r in model.transform(df).select(vector_to_array(M.RAW).alias("r")).collect()])
        assert (FO.class_votes(m.stages[-1].scoring, x).T == raw).all()  # to the last bit
    assert M.predict(model, df.limit(0)).count() == 0
    del loaded.stages[-1].scoring  # any other pipeline
    assert sorted(M.predict(loaded, df).select("id", "prediction").collect()) == want


def test_narrow_vectors_are_those_of_the_text_form(spark, monkeypatch):
    from scorebook.operators import categories as C

    df = spark.createDataFrame([(1.5, -0.0, 2, None), (float("inf"), 3.0, None, None), (-1e-300, 7.0, 4, 5)], "a double, b double, h int, g int")
    made = lambda: [list(r.v) for r in df.select(vector_to_array(sparse_vector(6, [F.col("a"), F.col("b")], [F.col("h"), F.col("g")])).alias("v")).collect()]
    narrow = made()
    assert narrow == [[1.5, 0.0, 1.0, 0.0, 0.0, 0.0], [float("inf"), 3.0, 0.0, 0.0, 0.0, 0.0], [-1e-300, 7.0, 0.0, 0.0, 1.0, 1.0]]
    monkeypatch.setattr(C, "DENSE_POSITIONS", -1)
    assert made()[::2] == narrow[::2]
