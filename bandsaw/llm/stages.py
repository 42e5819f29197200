"""The stages of ``corpus_pipeline.py``. Each takes and returns documents; the last returns their tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.llm import langid, line_windows, segment_bpe, superminhash, templates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that can be told: texts without a letter, null ones and ambiguous ones go.

    The classifiers learn from the rows with a ``lang`` of this input. If no row has
    one, nothing can be told and nothing goes but texts without a letter.
    """
    model = langid.train(docs)
    told = langid.predict(docs.select(*COLUMNS), model)
    known = F.col("lang_pred") != langid.UNKNOWN
    if model is None:
        known = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    return told.filter(known & ~F.col("ambiguous")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines of repeated windows; documents of which no line is left go. ``n_chars`` follows the text."""
    cut = line_windows.drop_repeated(docs.select(*COLUMNS))
    left = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that with the smallest id; of rows of equal id and text one stays."""
    own = lambda key, same_text: [F.xxhash64(key, F.lit(1)).alias("__a"), same_text.alias("__b")]
    kept = superminhash.components(docs).filter("kept").select(*own(F.col("key"), F.col("same_text"))).distinct()
    rows = docs.select(*COLUMNS, *own(F.col("doc_id").cast("bigint"), F.xxhash64("text")))
    return rows.join(kept, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"]).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.clean(docs.select(*COLUMNS), items).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of the bytes they decode to, which must be the text's own."""
    import public_tokenizers

    path = public_tokenizers.path(RANKS)
    rows = segment_bpe.decode(segment_bpe.encode(docs.select(*COLUMNS), path), path)
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == whole).alias("round_trip"),
    )
