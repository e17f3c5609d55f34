"""The registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clvspark.llm import fill_middle, html_text, language_id, minhash, mixing, personal_data, pieces, pivot_index, quality_rules_ensemble, secret_scan, stratum_index, suffix_dedup, text_rules
from clvspark.llm.frames import crc_mod, table
from clvspark.llm.oracle import ORACLE  # noqa: F401  (the entry point takes both)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, with the digest of the text that decoding gives back."""
    return pieces.encode(table(spark, sf_dir, "documents"), decoded=True).select(
        "doc_id", "pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    taught = labels.filter((crc_mod("doc_id", 5) != 0) & F.col("quality").isNotNull())
    model = quality_rules_ensemble.fit(docs.select("doc_id", "text").join(taught, "doc_id"))
    return quality_rules_ensemble.score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"), html_text.fit())
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[personal_data.count_of("spans", k).alias(f"n_{k}") for k in personal_data.KINDS],
        F.sha2(personal_data.written("spans", kinds=4).cast("binary"), 256).alias("base_sha256"),
        personal_data.written("spans").alias("spans"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source`` stands for the host: the table has no other name of a text's origin."""
    return text_rules.judge(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep="none")
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(crc_mod("doc_id", 4) != 2))
    held = crc_mod("doc_id", 4) == 2
    return language_id.predict(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every rearranged text and of the text rebuilt from it; null texts are empty, and empty ones plain."""
    rows = fill_middle.restored(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every text; null texts have none."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    return found.select(
        "doc_id", *[secret_scan.count_of("spans", k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.written("spans", kinds=3).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written("spans").alias("spans"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item; null texts have no terms, equal scores rank by doc_id."""
    index = stratum_index.build(table(spark, sf_dir, "documents"))
    return stratum_index.search(index, table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_minhash": op2_minhash,
    "op3_pivot_index": op3_pivot_index,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_html_text": op5_html_text,
    "op6_personal_data": op6_personal_data,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_language_id": op9_language_id,
    "op10_mixing": op10_mixing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_secret_scan": op12_secret_scan,
    "op13_ranked_search": op13_ranked_search,
}
