"""A training-corpus pipeline over ``documents``: each stage calls one operator of ``scorebook.llm``.

toxicity (rejected documents go) -> MinHash near-dedup (one document of each group stays) -> substring dedup (repeated
passages go from the texts) -> benchmark decontamination (contaminated documents go) -> packing into sequences.

A stage is a function of (spark, docs, sf_dir). ``run`` writes each stage's result as Parquet to the shared scratch
folder and reads it again as the next one's docs, so a lost executor costs at most a part of one stage. When a stage is
written, the tables that its operators put into the scratch folder are removed; the five results stay. All but the
last stage return the columns of ``documents``.

Defined results: rows that share a doc_id are judged by their own texts, and of rows that repeat both, one stays;
rows with a null doc_id are judged by their texts like any other and never dropped as copies; null
texts pass every filter; a document of which substring dedup leaves no word goes, one that had no words stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scorebook.llm import decontaminate, packing, probminhash, queries, substr_dedup, toxic_crf
from scorebook.llm.common import scratch_scope, table, written
from scorebook.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field does not find toxic (score below 0.5).

    The model learns from the labelled rows that are not held out, among the documents given.
    """
    cfg = toxic_crf.CrfConfig()
    model = toxic_crf.fit(docs, queries.training_labels(spark, sf_dir, "toxic"), cfg)
    return toxic_crf.filtered(docs.select(*COLUMNS), model, cfg, 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group: of least doc_id, and of least text digest where texts share one."""
    return probminhash.deduplicated(spark, docs.select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start in a document of a smaller id; texts without such passages are unchanged."""
    return substr_dedup.cleaned(spark, docs.select(*COLUMNS), substr_dedup.SubstringConfig())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(spark, docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of token sequences."""
    return packing.packed(docs, queries.packing_config())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL cannot express the learned and hashed stages; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark):
            docs = written(spark, stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return docs
