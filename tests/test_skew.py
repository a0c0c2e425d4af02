"""A third of all rows in one value or one group: the bucketed paths stay exact."""

from pyspark.sql import functions as F

from scorebook.operators.impute import exact_medians
from scorebook.operators.metrics import roc_auc
from scorebook.operators.ranks import exact_ranks


def _hot(spark, n=3000):
    # A third of the rows hold x = 7.0 (and label 1); the rest spread.
    return spark.range(0, n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 1001).cast("double")).alias("x"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 2).cast("int")).alias("y"),
    )


def test_median_with_hot_value(spark):
    df = _hot(spark)
    assert exact_medians(df, ["x"], buckets=8, single_task_rows=0) == exact_medians(df, ["x"])


def test_auc_with_hot_score(spark):
    df = _hot(spark)
    a = roc_auc(df, "y", "x").first()[0]
    b = roc_auc(df, "y", "x", buckets=8, single_task_rows=0).first()[0]
    assert abs(a - b) < 1e-12


def test_ranks_in_a_hot_group(spark):
    df = _hot(spark).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")))
    bucketed = exact_ranks(df, ["id"], ["g"], buckets=16, single_task_rows=0)
    plain = exact_ranks(df, ["id"], ["g"])
    a = {(r.id, r.rank) for r in bucketed.collect()}
    b = {(r.id, r.rank) for r in plain.collect()}
    assert a == b
    assert max(r for _, r in a) == 1999


def test_split_with_a_hot_key(spark):
    # Key 0 holds a third of the rows (copies that differ in `v`); the rest are unique keys.
    from scorebook.operators.split import assign_split

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        (F.col("id") % 2).cast("int").alias("y"),
    )
    plain = {(r.v, r.split) for r in assign_split(df, "y", "k", 0.2, 42).collect()}
    for rows in (0, 7):
        cut = {(r.v, r.split) for r in assign_split(df, "y", "k", 0.2, 42, single_task_rows=rows).collect()}
        assert plain == cut and len(plain) == 3000


def test_split_with_copies_of_one_row(spark):
    # As the schema makes them: labels repeat a key, the features join to it, and all copies are one row.
    from scorebook.operators.joins import training_join
    from scorebook.operators.split import assign_split

    labels = spark.range(0, 3000, 1, 6).selectExpr("if(id % 3 = 0, 0, id) AS k", "cast(id % 3 = 0 or id % 2 = 0 as int) AS y")
    features = spark.range(0, 3000).selectExpr("id AS k", "id * 2 AS x")
    joined = training_join(labels, features, "k")
    for seed in range(6):  # the hot row falls on either side of the seats, or across them
        plain = assign_split(joined, "y", "k", 0.2, seed).groupBy("y", "split").count().collect()
        cut = assign_split(joined, "y", "k", 0.2, seed, single_task_rows=20)
        assert cut.groupBy("y", "split").count().collect().__len__() == 4
        assert sorted(map(tuple, cut.groupBy("y", "split").count().collect())) == sorted(map(tuple, plain))
        assert cut.drop("split").exceptAll(joined).isEmpty() and cut.count() == 3000
    seats = assign_split(joined, "y", "k", 0.7, 1, single_task_rows=20)
    assert seats.where("y = 1 and split = 'train'").count() == 600


def test_versions_with_a_hot_name_and_one_timestamp(spark):
    # A third of the rows are runs of one name that share one timestamp; the order is (ts, run_id).
    from scorebook.operators.ranks import range_ranks
    from scorebook.operators.registry import number_versions

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (F.col("id") % 7).cast("string")))
        .alias("name"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("timestamp").alias("ts"),
        F.format_string("r%05d", (F.col("id") * 7919) % 3001).alias("run_id"),
    )
    plain = {(r.name, r.run_id, r.version) for r in number_versions(df, "name", ["ts", "run_id"]).collect()}
    ranged = {(r.name, r.run_id, r.version)
              for r in number_versions(df, "name", ["ts", "run_id"], single_task_rows=0, partitions=16).collect()}
    assert plain == ranged and len(plain) == 3000
    assert sorted(v for n, _, v in plain if n == "hot") == list(range(1, 1001))
    # The tied rows of the hot name are spread over many tasks, not one.
    spread = (df.repartitionByRange(16, "name", "ts", "run_id").where(F.col("name") == "hot")
              .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread >= 4
    # A null name is a group of its own; none of its rows is lost.
    nulls = df.withColumn("name", F.when(F.col("name") != "hot", F.col("name")))
    a = {(r.run_id, r.version) for r in number_versions(nulls, "name", ["ts", "run_id"]).collect()}
    b = {(r.run_id, r.version) for r in number_versions(nulls, "name", ["ts", "run_id"], single_task_rows=0,
                                                        partitions=16).collect()}
    assert a == b and len(a) == 3000
    # Without groups: one global order.
    whole = range_ranks(df, ["ts", "run_id", "name"], partitions=5)
    assert sorted(r.rank for r in whole.collect()) == list(range(3000))
    assert {r.rank_total for r in whole.select("rank_total").distinct().collect()} == {3000}


def test_count_below_equals_a_whole_scan(spark):
    from scorebook.operators.ranks import CHUNK, count_below

    for n in (0, 1, 31, 32, 33, 65, 700):
        bounds = [i * 0.5 for i in range(n)]
        df = spark.range(0, 800).select((F.col("id") * 0.25 - 2.0).alias("v")).crossJoin(
            spark.createDataFrame([(bounds, bounds[::CHUNK])], "_b array<double>, _c array<double>"))
        fast = count_below(F.col("_b"), F.col("_c"), F.col("v"))
        slow = F.size(F.filter("_b", lambda b: b < F.col("v")))
        # As in quantile_bucket: a projection over the joined rows.
        rows = df.select(fast.alias("fast"), slow.alias("slow")).collect()
        assert len(rows) == 800 and all(r.fast == r.slow for r in rows)


def test_bucketed_ranks_keep_a_null_group(spark):
    df = _hot(spark).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("a")))
    bucketed = {(r.id, r.rank) for r in exact_ranks(df, ["id"], ["g"], buckets=16, single_task_rows=0).collect()}
    plain = {(r.id, r.rank) for r in exact_ranks(df, ["id"], ["g"]).collect()}
    assert bucketed == plain and len(bucketed) == 3000


def test_range_ranks_with_two_group_columns(spark):
    from scorebook.operators.ranks import range_ranks

    df = _hot(spark).select(
        "id", "x",
        F.when(F.col("id") % 5 == 0, F.lit(None).cast("int")).otherwise(F.col("y")).alias("g1"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("g2"),
    )
    ranged = {(r.id, r.rank, r.rank_total) for r in range_ranks(df, ["x", "id"], ["g1", "g2"], partitions=12).collect()}
    plain = {(r.id, r.rank, r.rank_total)
             for r in exact_ranks(df, ["x", "id"], ["g1", "g2"]).select("id", "rank", "rank_total").collect()}
    assert ranged == plain and len(ranged) == 3000
