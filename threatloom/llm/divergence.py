"""How far the sources of a language differ in their use of terms.

Per language a CountVectorizer keeps every term that enough documents hold and turns each document into an exact sparse
vector of counts. Vectors are summed per source, non-zero entries only, and pairs of sources are compared on those sums:
a term that neither source has adds the same to every pair, so it is counted and never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threatloom.llm.common import stage
from threatloom.operators.shaping import top_per_group
from threatloom.session import work_dir

# Fixed values of the contract: smoothing, and the unit of shares.
SMOOTHING, UNIT = 5, 1_000_000_000
MIN_DOCUMENTS, TOP_TERMS = 30, 50
LARGEST_VOCABULARY = 2**31 - 1
# Stands in every document, so that a vocabulary is never empty; no term can hold this character.
_ALWAYS = "\0"


# What each byte of a text becomes: a-z and bytes beyond ASCII stay, A-Z are lowered, all others separate terms.
_BYTES = bytes(c if 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def split_terms(texts: pa.Array) -> pa.Array:
    """Terms of each text, runs of letters (A-Z as a-z) and characters beyond ASCII, and ``_ALWAYS`` after them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    changed = pa.py_buffer((data.to_pybytes() if data else b"").translate(_BYTES))
    spaced = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, changed], offset=texts.offset)
    ended = pc.binary_join_element_wise(spaced, pa.scalar(_ALWAYS, pa.large_string()), pa.scalar(" ", pa.large_string()))
    return pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(ended))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = split_terms(batch.column(2)).cast(pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), held], names=["language", "source", "held"])


def _shares(count: Column, total: Column, terms_kept: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)) in whole numbers of any size."""
    wide = "decimal(38,0)"
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above.cast(wide), (total + SMOOTHING * terms_kept).cast(wide))


def _nonzero(vector: str) -> Column:
    """(term number, count) of the entries of a sparse vector."""
    parts = F.unwrap_udt(F.col(vector))
    return F.arrays_zip(parts["indices"].alias("indices"), parts["values"].alias("values"))


def _vocabulary(spark: SparkSession, model: CountVectorizerModel) -> DataFrame:
    """(number, term) of a fitted vocabulary, read from the saved model: the list does not pass through Python."""
    path = work_dir(spark, "vocabulary")
    model.write().save(path)
    words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("number", "term"))
    return words.where(F.col("term") != _ALWAYS)


def count_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (lang, source, documents), vocabulary (lang, term) and counts (lang, source, term, n > 0), all stored.

    One vectorizer per language that has ``min_documents`` documents: another one can keep no term. Their list, one
    entry per language, is all that reaches the driver besides the vocabulary that a vectorizer keeps there itself.
    """
    spark = docs.sparkSession
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = stage(filled.groupBy("lang", "source").agg(F.count("*").alias("documents")), "divergence-groups")
    languages = groups.groupBy("lang").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= min_documents)
    names = [r.lang for r in languages.select("lang").sort("lang").collect()]
    # Stored, so that Spark knows how small it is and need not shuffle the texts for the join.
    numbered = stage(spark.createDataFrame(list(enumerate(names)), "language int, lang string").coalesce(1), "divergence-languages")
    path = work_dir(spark, "divergence-terms")
    # Dealt into folders by language, so that each vectorizer reads its own documents only.
    held = filled.join(numbered, "lang").select("language", "source", "text").mapInArrow(_held, "language int, source string, held array<string>")
    held.write.partitionBy("language").parquet(path)
    words, counts = work_dir(spark, "divergence-vocabulary"), work_dir(spark, "divergence-counts")
    for number, name in enumerate(names):
        own = spark.read.schema("source string, held array<string>").parquet(f"{path}/language={number}")
        model = CountVectorizer(inputCol="held", outputCol="vector", minDF=float(min_documents), vocabSize=LARGEST_VOCABULARY).fit(own)
        kept = stage(_vocabulary(spark, model), "divergence-words")
        kept.select(F.lit(name).alias("lang"), "term").write.mode("append").parquet(words)
        entries = model.transform(own).select("source", F.explode(_nonzero("vector")).alias("e"))
        sums = entries.groupBy("source", F.col("e.indices").alias("number")).agg(F.sum(F.col("e.values").cast("long")).alias("n"))
        sums.join(kept, "number").select(F.lit(name).alias("lang"), "source", "term", "n").write.mode("append").parquet(counts)
    kinds = ("lang string, term string", "lang string, source string, term string, n long")
    if not names:
        return groups, spark.createDataFrame([], kinds[0]), spark.createDataFrame([], kinds[1])
    return groups, spark.read.schema(kinds[0]).parquet(words), spark.read.schema(kinds[1]).parquet(counts)


def _pair_values(sized: DataFrame, shared: DataFrame) -> DataFrame:
    """(lang, source, item, value): the distance of every two sources of a language, both ways.

    With p0 the share of a term that a source does not have, a pair's distance is V * |p0 - q0|, plus for each source's
    own terms what they change against the other's q0, plus for common terms what both change together. Own terms are
    taken by their count: a source has few different counts, however many terms it has.
    """
    other = [F.col(c).alias(f"{c}_2") for c in ("source", "absent")]
    groups = sized.select("lang", "source", "kept", "absent")
    every = groups.join(groups.select("lang", *other), "lang").where("source <> source_2")
    even = F.abs(F.col("absent") - F.col("absent_2"))
    by_count = shared.groupBy("lang", "source", "absent", "p").agg(F.count("*").alias("times"))
    alone = by_count.join(groups.select("lang", *other), "lang").where("source <> source_2")
    changed = F.sum(F.col("times") * (F.abs(F.col("p") - F.col("absent_2")) - even)).alias("change")
    alone = alone.groupBy("lang", "source", "source_2").agg(changed)
    both_ways = alone.unionByName(alone.select("lang", F.col("source_2").alias("source"), F.col("source").alias("source_2"), "change"))
    twin = shared.select("lang", "term", *other, F.col("p").alias("p_2"))
    met = shared.join(twin, ["lang", "term"]).where("source <> source_2")
    together = F.abs(F.col("p") - F.col("p_2")) - F.abs(F.col("p") - F.col("absent_2")) - F.abs(F.col("absent") - F.col("p_2")) + even
    met = met.groupBy("lang", "source", "source_2").agg(F.sum(together).alias("change"))
    base = every.select("lang", "source", "source_2", (F.col("kept") * even).alias("change"))
    parts = base.unionByName(both_ways).unionByName(met)
    return parts.groupBy("lang", "source", F.col("source_2").alias("item")).agg(F.sum("change").alias("value"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source); nulls count as empty text.

    Part ``pair``: every other source of the language with the sum, over all kept terms, of the absolute difference of
    shares. Part ``term``: the ``top`` terms that a source uses more than its language does, with the difference. Ranks
    go from 1 per group and part by falling value, then item in UTF-8 order. All values are whole numbers, so ties are
    exact. A language without kept terms has pairs of value 0 and no terms; a single source has no pairs. Repeated rows
    are documents of their own; very long texts count whole; other columns are ignored; an empty table gives no rows.

    A source with most of the rows is summed in the map tasks, entry by entry; a term meets once per source.
    """
    groups, words, counts = count_terms(docs, min_documents)
    sizes = words.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.select("lang", "source").join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    sized = sized.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("kept", "total")})
    # A language without kept terms has no shares at all: its pairs are 0.
    absent = F.when(F.col("kept") > 0, _shares(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(0))
    sized = stage(sized.withColumn("absent", absent), "divergence-sizes")
    shared = counts.join(sized, ["lang", "source"]).withColumn("p", _shares(F.col("n"), F.col("total"), F.col("kept")))
    shared = stage(shared.select("lang", "source", "term", "n", "absent", "p"), "divergence-shares")
    pairs = _pair_values(sized, shared)
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    lang_sizes = sized.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    usual = whole.join(lang_sizes, "lang").select("lang", "term", _shares(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    above = shared.join(usual, ["lang", "term"]).where("p > q")
    more = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = (F.col("value").desc(), F.col("item"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    ranked = pairs.withColumn("rank", place).withColumn("part", F.lit("pair"))
    ranked = ranked.unionByName(top_per_group(more, ["lang", "source"], top, *order).withColumn("part", F.lit("term")))
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
