"""DuckDB SQL equivalent to each query in ``plans.queries`` (tables are pre-registered views).

A fitted forest's classes cannot be computed in SQL where the label is not a function of the features. So the queries
that return predictions learn a label that is a fixed rule of a category (binding R), which a forest learns exactly:
their twins say every prediction. The training jobs compare row counts, versions and decisions, and flags that must
be 1: the logged metrics follow from the stored predictions, the reloaded model predicts the same.
"""

from __future__ import annotations

from scorebook.plans import bindings as B
from scorebook.plans.queries import ORDER_PRIORITIES, SEGMENTS, _onehot_sql  # noqa: F401

RAW = B.RAW_ORDERS_SQL
LABELLED = (f"SELECT o_orderkey, o_custkey, {B.ORDER_LABEL_SQL} AS label, o_totalprice, o_orderpriority, "
            f"c_nationkey, c_acctbal, c_mktsegment FROM ({RAW}) raw")
RULE = (f"SELECT doc_id, quality, lang, source, n_chars, CAST(n_chars > {B.RULE_MIN_CHARS} AS INTEGER) AS prediction "
        f"FROM ({B.DOC_JOIN_SQL}) j")
DOC_SPLIT = B.split_sql(B.DOC_JOIN_SQL, "doc_id", "quality", 0.2, 42)
RULE_SPLIT = B.split_sql(B.RULE_JOIN_SQL, "doc_id", "continental", 0.2, 42)
ORDER_SPLIT = B.split_sql(f"SELECT * FROM ({LABELLED}) l WHERE label IS NOT NULL", "o_orderkey", "label", 0.2, 42)

CONFUSION = f"""
SELECT sum(CASE WHEN quality = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
       sum(CASE WHEN quality <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN quality = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS fn,
       sum(CASE WHEN quality <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS tn,
       count(*) AS n
FROM ({RULE}) r"""


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


METRICS = f"""
SELECT round({_ratio('tp + tn', 'n')}, 9) AS {{p}}accuracy,
       round({_ratio('tp', 'tp + fp')}, 9) AS {{p}}precision,
       round({_ratio('tp', 'tp + fn')}, 9) AS {{p}}recall,
       round({_ratio('2 * tp', '2 * tp + fp + fn')}, 9) AS {{p}}f1
FROM ({CONFUSION}) c"""

VERSIONS = B.VERSIONS_SQL
CHAMPIONS = f"""
SELECT name, version AS champion_version, run_id AS champion_run_id
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY last_updated DESC, version DESC) AS rn
      FROM ({VERSIONS}) v WHERE stage = 'Production') x
WHERE rn = 1"""
DECISIONS = f"""
WITH runs AS ({B.RUNS_SQL}),
cand AS (SELECT name, version AS candidate_version, run_id AS candidate_run_id
         FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn FROM ({VERSIONS}) v) x
         WHERE rn = 1),
champ AS ({CHAMPIONS}),
j AS (SELECT c.name, c.candidate_version, c.candidate_run_id, coalesce(rc.metric, 0.0) AS candidate_metric,
             h.champion_version, h.champion_run_id,
             CASE WHEN h.champion_version IS NOT NULL THEN coalesce(rh.metric, 0.0) END AS champion_metric
      FROM cand c LEFT JOIN champ h ON c.name = h.name
      LEFT JOIN runs rc ON rc.run_id = c.candidate_run_id
      LEFT JOIN runs rh ON rh.run_id = h.champion_run_id)
SELECT *, CAST(champion_version IS NULL OR candidate_metric > champion_metric AS INTEGER) AS promote,
       CAST(champion_version IS NOT NULL AND candidate_metric > champion_metric AS INTEGER) AS archive
FROM j"""
APPLIED = f"""
SELECT v.name, v.version, v.run_id,
       CASE WHEN d.promote = 1 AND v.version = d.candidate_version THEN 'Production'
            WHEN d.archive = 1 AND v.stage = 'Production' THEN 'Archived'
            ELSE v.stage END AS stage,
       v.last_updated
FROM ({VERSIONS}) v LEFT JOIN ({DECISIONS}) d ON v.name = d.name"""

ORDER_FEATURIZED = f"SELECT * FROM ({_onehot_sql(True)}) x WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ("o_orderkey", "o_custkey", "label", "o_totalprice", "c_nationkey", "c_acctbal"))


def _profile_sql(source: str, cols: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, '{r}' AS role, count({c}) AS non_missing FROM ({source}) s"
        for c, t, r in cols)


FILLED_SPLIT = B.split_sql(f"SELECT * FROM ({LABELLED}) l WHERE label IS NOT NULL AND o_totalprice IS NOT NULL "
                           "AND c_acctbal IS NOT NULL", "o_orderkey", "label", 0.2, 42)


_NAMED = ", ".join(f"('{k}', {p})" for k, p in B.LANGUAGE_FACTORS)
# Every document's score for every language; AUC of (a by its score, against b) as the share of won pairs of rows.
PAIRS = f"""
WITH k AS (SELECT col0 AS lang, col1 AS p FROM (VALUES {_NAMED}) v),
s AS (SELECT d.lang AS own, k.lang AS scored,
             ((d.n_chars * k.p + d.doc_id) % 101 + CASE WHEN d.lang = k.lang THEN 20 + k.p ELSE 0 END) / 128.0 AS score
      FROM documents d, k WHERE d.lang IS NOT NULL),
c AS (SELECT scored, own, score, count(*) AS n FROM s GROUP BY ALL),
won AS (SELECT x.scored, y.own AS against,
               sum(CASE WHEN x.score > y.score THEN 1.0 WHEN x.score = y.score THEN 0.5 ELSE 0.0 END * x.n * y.n) AS area,
               sum(CAST(x.n AS DOUBLE) * y.n) AS total
        FROM c x JOIN c y ON x.scored = y.scored AND x.own = x.scored AND y.own <> y.scored GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)
SELECT a.scored AS "first", b.scored AS "second", (a.area / a.total + b.area / b.total) / 2 AS auc, na.n + nb.n AS rows
FROM won a JOIN won b ON a.scored = b.against AND b.scored = a.against AND a.scored < b.scored
JOIN n na ON na.lang = a.scored JOIN n nb ON nb.lang = b.scored"""


def _job_sql(name: str, split: str) -> str:
    """A first training job: version 1, promoted, nothing archived, metrics that follow from the predictions."""
    return (f"SELECT '{name}' AS name, CAST(1 AS BIGINT) AS version, count_if(split = 'train') AS n_train, "
            "count_if(split = 'test') AS n_test, 1 AS promote, 0 AS archive, 1 AS accuracy_ok, 1 AS precision_ok, "
            f"1 AS recall_ok, 1 AS f1_ok FROM ({split}) s")


ORACLE_SQL: dict[str, str] = {
    "scan_input": RAW,
    "csv_ingest": RAW,
    "range_smoke": "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS id FROM lineitem",
    "label_encode": LABELLED,
    "one_hot": _onehot_sql(False),
    "clean_column_names": f"SELECT *, o_totalprice AS price_usd FROM ({_onehot_sql(True)}) x",
    "drop_missing": f"SELECT * FROM ({LABELLED}) l WHERE label IS NOT NULL AND o_totalprice IS NOT NULL "
                    "AND c_acctbal IS NOT NULL",
    "featurize": ORDER_FEATURIZED,
    "feature_table_write": f"SELECT * EXCLUDE (label) FROM ({LABELLED}) l",
    "labels_table_write": f"SELECT o_orderkey, label FROM ({LABELLED}) l",
    "predictions_overwrite": RULE,
    "predictions_append": f"SELECT *, unnest(['monday', 'tuesday']) AS batch_id FROM ({RULE}) a",
    "training_join": B.DOC_JOIN_SQL,
    "score_join": "SELECT doc_id, toxic, lang, source, n_chars FROM labels JOIN documents USING (doc_id)",
    "stratified_split": f"SELECT doc_id, quality, split FROM ({DOC_SPLIT}) s",
    "split_counts": f"SELECT quality, split, count(*) AS n FROM ({DOC_SPLIT}) s GROUP BY quality, split",
    "median_impute": f"""
WITH sp AS ({ORDER_SPLIT}),
med AS (SELECT median(o_totalprice) AS m1, median(c_acctbal) AS m2 FROM sp WHERE split = 'train')
SELECT l.o_orderkey, sp.split,
       round(coalesce(l.o_totalprice, (SELECT m1 FROM med)), 6) AS o_totalprice,
       round(coalesce(l.c_acctbal, (SELECT m2 FROM med)), 6) AS c_acctbal
FROM ({LABELLED}) l LEFT JOIN sp USING (o_orderkey)""",
    "one_hot_unknown": """
WITH docs AS (SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN source END AS source FROM documents),
learnt AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS BIGINT) AS idx
           FROM (SELECT DISTINCT coalesce('v' || source, 'n') AS cat FROM docs
                 WHERE coalesce(source, '') <> 'src0') d)
SELECT doc_id, source, coalesce(idx, -1) AS hot_index, (SELECT count(*) FROM learnt) AS width
FROM docs LEFT JOIN learnt ON coalesce('v' || source, 'n') = cat""",
    # The assembled vectors of the train rows in long form (doc_id, pos, value): n_chars (no missing value to impute), then one indicator per
    # category of lang and of source learnt on train, ascending; a null is a category of its own, before all others.
    "assemble": f"""
WITH tr AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, coalesce('v' || lang, 'n') AS lang,
                   coalesce('v' || source, 'n') AS source
            FROM ({DOC_SPLIT}) s WHERE split = 'train'),
cats AS (SELECT (SELECT list(DISTINCT lang ORDER BY lang) FROM tr) AS langs,
                (SELECT list(DISTINCT source ORDER BY source) FROM tr) AS sources),
vec AS (SELECT doc_id,
                list_concat(list_concat([n_chars],
                                        list_transform(langs, lambda x: CASE WHEN lang = x THEN 1.0 ELSE 0.0 END::DOUBLE)),
                            list_transform(sources, lambda x: CASE WHEN source = x THEN 1.0 ELSE 0.0 END::DOUBLE)) AS f
         FROM tr, cats)
SELECT doc_id, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS pos, unnest(f) AS value FROM vec""",
    "input_example": f"SELECT doc_id, quality, lang, source, n_chars FROM ({DOC_SPLIT}) s "
                     "WHERE split = 'train' ORDER BY doc_id LIMIT 100",
    "binary_metrics": METRICS.format(p=""),
    "roc_auc": f"""
WITH s AS (SELECT CAST(n_chars AS DOUBLE) AS score,
                  sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN quality = 1 THEN 0 ELSE 1 END) AS neg
           FROM ({B.DOC_JOIN_SQL}) j GROUP BY 1),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM s)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                  THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END, 9) AS roc_auc_score
FROM r""",
    "roc_auc_ovo": f"SELECT round(sum(auc * rows) / sum(rows), 9) AS roc_auc_score FROM ({PAIRS}) p",
    "roc_auc_pairs": f'SELECT "first", "second", round(auc, 9) AS auc, CAST(rows AS BIGINT) AS rows FROM ({PAIRS}) p',
    "metrics_row": "SELECT 'rule_n_chars' AS run_id, *, '{\"model_params\": {\"rule\": \"n_chars\"}}' AS conf FROM ("
                   + METRICS.format(p="test_") + ") m",
    "register_version": f"""
WITH nr AS (SELECT event_type AS name, 'new-' || event_type AS run_id, max(ts) AS last_updated
            FROM events GROUP BY event_type),
mx AS (SELECT name, max(version) AS mv FROM ({VERSIONS}) v GROUP BY name)
SELECT nr.name, CAST(coalesce(mx.mv, 0) + 1 AS BIGINT) AS version, nr.run_id, 'None' AS stage, nr.last_updated
FROM nr LEFT JOIN mx ON nr.name = mx.name""",
    "champion_select": CHAMPIONS,
    "promotion_decision": DECISIONS,
    "apply_promotion": APPLIED,
    "resolve_stage": f"""
SELECT name, 'Production' AS stage, version, run_id
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn
      FROM ({APPLIED}) a WHERE stage = 'Production') x
WHERE rn = 1""",
    "features_job": ORDER_FEATURIZED,
    "train_score": f"SELECT doc_id, continental, lang, source, n_chars, continental AS prediction FROM ({RULE_SPLIT}) s WHERE split = 'test'",
    "model_round_trip": f"SELECT doc_id, 1 AS same FROM ({DOC_SPLIT}) s WHERE split = 'test'",
    "train_job": _job_sql("doc_quality", DOC_SPLIT),
    "score_job": f"SELECT *, continental AS prediction FROM ({B.RULE_JOIN_SQL}) j",
    "batch_inference": f"SELECT *, continental AS prediction FROM ({B.RULE_JOIN_SQL}) j",
    "initial_train_job": _job_sql("order_filled", FILLED_SPLIT),
    "column_roles": _profile_sql(B.DOC_JOIN_SQL, [("n_chars", "bigint", "numeric"), ("lang", "string", "categorical"),
                                                  ("source", "string", "categorical")]),
    "signature": _profile_sql(f"SELECT * FROM ({DOC_SPLIT}) x WHERE split = 'train'",
                              [("doc_id", "bigint", "input"), ("quality", "int", "label"), ("lang", "string", "input"),
                               ("source", "string", "input"), ("n_chars", "bigint", "input")]),
}
