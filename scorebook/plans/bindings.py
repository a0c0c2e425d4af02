"""Bindings of the jobs to the driver's test tables (and the same bindings as DuckDB SQL for the oracles).

* D: labels = ``labels(doc_id, quality)``, features = ``documents(doc_id, lang, source, n_chars)``.
* R: labels = ``labels`` joined to ``documents``, the label a fixed rule of the language, and the features of D: a
  forest learns the rule exactly, so its predictions can be told in SQL.
* O: raw = ``orders`` joined to ``customer``; label text ``o_orderstatus`` (F -> 1, O -> 0, P unmapped);
  numerics nulled on every tenth order key so imputation and missing-row drops have work.
* V: a versions table from ``events``: name = event_type, version = position by event_id, metric = value,
  last_updated = ts, stage Production on every 97th event id (never for ``signup``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.config import NO_STAGE, PRODUCTION
from scorebook.operators.registry import number_versions
from scorebook.sources.tables import read_parquet_table

# Fixed values of the bindings.
ORDER_LABEL_MAP = (("F", 1), ("O", 0))
ORDER_CATEGORICALS = ("o_orderpriority", "c_mktsegment")
NULL_EVERY = 10
PRODUCTION_EVERY = 97
NEVER_PROMOTED = "signup"
RULE_MIN_CHARS = 1000  # rule model: predict quality 1 iff n_chars > 1000


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_parquet_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = read_parquet_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    kept = F.col("o_orderkey") % NULL_EVERY != 0
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(kept, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority", "c_nationkey",
        F.when(kept, F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )


RAW_ORDERS_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % {NULL_EVERY} <> 0 THEN o_totalprice END AS o_totalprice,
       o_orderpriority, c_nationkey,
       CASE WHEN o_orderkey % {NULL_EVERY} <> 0 THEN c_acctbal END AS c_acctbal,
       c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""

ORDER_LABEL_SQL = "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS INTEGER)"


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, "labels").select("doc_id", "quality")


DOC_JOIN_SQL = "SELECT doc_id, quality, lang, source, n_chars FROM labels JOIN documents USING (doc_id)"


# Languages whose documents have label 1 in binding R.
RULE_LANGS = ("de", "fr")


# The languages of the scores in ``roc_auc_ovo``, and a factor of each one's noise.
LANGUAGE_FACTORS = (("de", 7), ("en", 13), ("es", 29), ("fr", 31))


def rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet_table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("lang").isin(*RULE_LANGS), F.lit(False)).cast("int").alias("continental"))
    return read_parquet_table(spark, sf_dir, "labels").select("doc_id").join(docs, "doc_id")


_RULE_SQL = f"CAST(coalesce(lang IN ({', '.join(repr(x) for x in RULE_LANGS)}), false) AS INTEGER) AS continental"
RULE_JOIN_SQL = f"SELECT doc_id, {_RULE_SQL}, lang, source, n_chars FROM labels JOIN documents USING (doc_id)"


def versions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_parquet_table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    stage = F.when((F.col("event_id") % PRODUCTION_EVERY == 0) & (F.col("name") != NEVER_PROMOTED),
                   F.lit(PRODUCTION)).otherwise(F.lit(NO_STAGE))
    numbered = number_versions(events.withColumnRenamed("event_type", "name"), "name", "event_id")
    return numbered.select(
        "name", "version", F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        stage.alias("stage"), F.col("ts").alias("last_updated"),
    )


def runs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_parquet_table(spark, sf_dir, "events").select("event_id", "value")
    return events.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.create_map(F.lit("test_accuracy"), F.col("value")).alias("metrics"),
        F.lit(None).cast("string").alias("conf"),
    )


VERSIONS_SQL = f"""
SELECT event_type AS name,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS version,
       'run-' || CAST(event_id AS VARCHAR) AS run_id,
       CASE WHEN event_id % {PRODUCTION_EVERY} = 0 AND event_type <> '{NEVER_PROMOTED}'
            THEN 'Production' ELSE 'None' END AS stage,
       ts AS last_updated
FROM events"""

RUNS_SQL = "SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, value AS metric FROM events"


def split_sql(base_sql: str, key: str, label: str, test_size: float, seed: int) -> str:
    """The exact stratified split in SQL: same sizes rule and md5 row order as ``operators.split``."""
    return f"""
WITH base AS ({base_sql}),
cnt AS (SELECT {label} AS lbl, count(*) AS n_c FROM base GROUP BY {label}),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({test_size} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM cnt),
fl AS (SELECT lbl, n_c,
              CAST(n_c AS DOUBLE) / (SELECT n FROM tot) * ((SELECT n FROM tot) - (SELECT n_test FROM tot)) AS cont
       FROM cnt),
fl2 AS (SELECT lbl, floor(cont) AS fl, cont - floor(cont) AS rem FROM fl),
seats AS (SELECT lbl,
                 fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, lbl)
                           <= ((SELECT n FROM tot) - (SELECT n_test FROM tot)) - (SELECT sum(fl) FROM fl2)
                      THEN 1 ELSE 0 END AS seats
          FROM fl2),
ranked AS (SELECT base.*,
                  row_number() OVER (PARTITION BY {label}
                                     ORDER BY md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}')), {key}) - 1 AS rk
           FROM base)
SELECT ranked.* EXCLUDE (rk), CASE WHEN rk < seats THEN 'train' ELSE 'test' END AS split
FROM ranked JOIN seats ON ranked.{label} = seats.lbl"""
