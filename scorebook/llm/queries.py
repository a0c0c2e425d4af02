"""The thin queries op1_... to op13_...: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    code_cells, decontaminate, ego_join, filter_audit, langid, mixing, packing, probminhash, quality_qda, substr_dedup,
    toxic_crf, url_filter, warc_merkle,
)
from .common import crc_mod, materialise, scratch, table
from .oracle import ORACLE_SQL  # noqa: F401


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cfg = langid.LangIdConfig()
    model = langid.fit(docs.where(crc_mod("doc_id", 3) != 1), cfg)
    out = langid.predict(docs, model, cfg)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substr_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def training_labels(spark: SparkSession, sf_dir: str, col: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(col).cast("int").alias("label")).where("label is not null")


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = quality_qda.QdaConfig()
    stats = materialise(spark, quality_qda.statistics(table(spark, sf_dir, "documents")), "quality-stats")
    model = quality_qda.fit(stats.join(training_labels(spark, sf_dir, "quality"), "doc_id"), cfg)
    return _judged(quality_qda.score(stats, model, cfg), 0.3)


# The rules of the contract, as (verdict, host and path).
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(spark, table(spark, sf_dir, "pages"), url_filter.UrlConfig(URL_RULES))


def op5_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, cfg = table(spark, sf_dir, "documents"), toxic_crf.CrfConfig()
    model = toxic_crf.fit(docs, training_labels(spark, sf_dir, "toxic"), cfg)
    return _judged(toxic_crf.score(docs, model, cfg, spans=False), 0.5)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(spark, docs, items))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a sound replica of all pages against one in which a sign of some payloads has changed.

    Damage is part of the exercise: the second replica ends the html of every 97th page_id with another sign.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    hurt = F.when((F.col("page_id") % 97 == 13) & (F.length("html") > 0), F.concat(F.expr("left(html, length(html) - 1)"), F.lit("~")))
    path = scratch(spark, "warc")
    warc_merkle.write_warc(pages, path, replicas={"ours": F.col("html"), "theirs": F.coalesce(hurt, "html")})
    return warc_merkle.audited(spark, f"{path}/replica=ours", f"{path}/replica=theirs")


def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(spark, table(spark, sf_dir, "documents")).documents


def packing_config() -> packing.PackingConfig:
    import public_tokenizers

    return packing.PackingConfig(tokenizer=public_tokenizers.path("word_bpe_49k.json"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), packing_config())


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.takings(mixing.mixed(spark, table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_cells.compressed(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality": op3_quality,
    "op4_url_filter": op4_url_filter,
    "op5_embedding_near_dup": op5_embedding_near_dup,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_warc_audit": op8_warc_audit,
    "op9_probminhash": op9_probminhash,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}
