"""The operators over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatloom.llm import bpe, chat, decontaminate, divergence, embedding_dedup, language, line_dedup, minhash, neighbours, periodic, secrets, token_counts, url_filter
from threatloom.llm.checks import SQL  # noqa: F401
from threatloom.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_counts(spark, folder):
    """Counts under the scores of the public piece vocabulary, read as a unigram vocabulary."""
    pieces = token_counts.read_vocabulary(vocabulary("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, folder, "documents"), pieces)


@query
def op2_embedding_dedup(spark, folder):
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


@query
def op3_bpe(spark, folder):
    encoded = bpe.encode(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_url_filter(spark, folder):
    labels = table(spark, folder, "labels")
    bad = F.when(F.col("quality").isNotNull(), (1 - F.col("quality")).cast("long"))
    return url_filter.filter_urls(table(spark, folder, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")))


@query
def op5_chat_quotes(spark, folder):
    return chat.link_conversations(table(spark, folder, "conversations"))


@query
def op6_line_dedup(spark, folder):
    left = line_dedup.drop_recurring_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "lines_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query
def op7_decontaminate(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), k=2)


@query
def op10_secrets(spark, folder):
    found = secrets.scan(table(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query
def op11_periodic_runs(spark, folder):
    """Runs of the texts, a tenth of which is made periodic first: from word a on, the p words there repeat."""
    docs = table(spark, folder, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.where("h % 10 = 0").withColumn("words", words).withColumn("n", F.size("words"))
    shaped = chosen.withColumns({"g": F.expr("h div 10"), "a": F.expr("cast((h div 10) % n as int)")}).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("cast(1 + (n - a) div p as int)")))
    periodic_words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    made = shaped.select("doc_id", F.when(F.col("n") > 0, F.array_join(periodic_words, " ")).otherwise(F.col("text")).alias("text"))
    found = periodic.detect(docs.where("h % 10 <> 0 OR h IS NULL").select("doc_id", "text").unionByName(made))
    best = F.col("best")
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_source_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))


@query
def op13_nearest(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)
