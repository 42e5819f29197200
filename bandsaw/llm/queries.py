"""The registered queries of this subpackage, and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.llm import (
    chat_parts, edit_counts, langid, line_windows, permutation_index, phrases, repair, segment_bpe, superminhash, templates, url_templates, warc,
    whitening,
)

END_ID = 2


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = url_templates.page_labels(table(spark, sf_dir, "labels"))
    return url_templates.judged(table(spark, sf_dir, "pages"), labels)


def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return superminhash.components(docs, k=4).drop("same_text").withColumnRenamed("key", "doc_id")


def op3_error_correcting_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted(table(spark, sf_dir, "documents"))


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.recounted(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op5_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repair.tokenized(spark, docs, vocabulary("byte_bpe_50k.json"), END_ID)


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_windows.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op8_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaked_items(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"))


def op10_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = segment_bpe.decode(segment_bpe.encode(docs, path).drop("text"), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_parts.digested(chat_parts.formatted(chat_parts.with_planted(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        op1_url_templates,
        op2_superminhash,
        op3_error_correcting_codes,
        op4_edit_counts,
        op5_repair_ids,
        op6_line_windows,
        op7_permutation_index,
        op8_benchmark_templates,
        op9_warc,
        op10_segment_tree_bpe,
        op11_whitening,
        op12_misra_gries_phrases,
        op13_chat_parts,
    ]
}

ORACLE: dict[str, str] = {
    "op1_url_templates": url_templates.SQL,
    "op6_line_windows": line_windows.SQL,
    "op9_warc": warc.SQL,
    "op12_misra_gries_phrases": phrases.SQL,
    "op13_chat_parts": chat_parts.SQL,
}
