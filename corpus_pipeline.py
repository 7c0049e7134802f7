"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatloom.llm import bpe, decontaminate, language, line_dedup, minhash
from threatloom.llm.common import prepare, stage
from threatloom.llm.queries import table, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no learned language: null texts and texts without a letter."""
    prepare(spark)
    found = language.identify(docs, language.train(docs))
    gone = found.where(language.rejected(F.col("lang_pred"))).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take recurring lines out; a document that loses all its text goes, n_chars follows the text."""
    prepare(spark)
    left = line_dedup.drop_recurring_lines(docs.select(*COLUMNS))
    emptied = (F.col("lines_dropped") > 0) & (F.trim("text") == "")
    n_chars = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates: five words, similarity 0.8."""
    prepare(spark)
    return minhash.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of the benchmark."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of their decoding."""
    prepare(spark)
    encoded = bpe.encode(docs, vocabulary("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding", encode),
]

# A trained network and MinHash candidates are not expressible in SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{i}")
    return docs
