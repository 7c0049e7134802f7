"""Recurring lines by a tree of line templates, with DataFrame functions only.

A line is cut into tokens at white space, or into pairs of characters where it has next to none, and runs of digits in
a token become one mark. The tree has a fixed depth: token count, then the leading tokens, then the rest in four
fields. A template keeps all of them, or generalises one of the four fields into a wildcard; a line of few tokens has
one template, its exact tokens. A template that recurs across documents of different content is dropped from all
documents but the first that has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import free_name, stage

MIN_TOKENS = 5
LEADING = 2
FIELDS = 4
MIN_DOCUMENTS = 5
# Lines of so many tokens do not recur by chance: from so many documents on.
LONG_TOKENS, LONG_DOCUMENTS = 50, 2
# Lines of one or two tokens recur by chance: so many times as many documents.
CHANCE = {1: 16, 2: 8}
# White space besides the space and the line feed.
WHITE = "\\t\\x0B\\f\\r\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
# A line of more bytes a token has no white space to cut at: a script without spaces, an address, a block of code.
TOKEN_BYTES = 30
# The template's lowest bits hold the token count of a short line, LONG of a long one, else 0.
COUNT_BITS = LONG = 7


def _tokens(line: Column) -> Column:
    words = F.array_remove(F.split(line, " "), "")
    return F.when(F.octet_length(line) > TOKEN_BYTES * F.size(words), F.array_remove(F.split(F.replace(line, F.lit(" ")), r"(?<=\G..)"), "")).otherwise(words)



def _fields(tokens: Column, exact: Column) -> Column:
    """What the templates of one line are made of: token count, and hashes of the leading tokens and each field.

    Of a short line, the hash of all its tokens with their digits; of a blank one nothing.
    """
    count = F.size(tokens)
    width = F.ceil((count - LEADING) / FIELDS).cast("int")
    fields = [F.xxhash64(F.slice(tokens, width * i + LEADING + 1, width)) for i in range(FIELDS)]
    return F.struct(
        count.alias("count"),
        F.when(count >= MIN_TOKENS, F.array(F.xxhash64(count, F.slice(tokens, 1, LEADING)), *fields))
        .when(count > 0, F.array(F.xxhash64(count, exact)))
        .alias("parts"),
    )


def _templates(count: Column, parts: Column) -> Column:
    """Hashes of the templates of one line: without a wildcard, then with each field generalised."""
    lead, *fields = [F.get(parts, F.lit(i)) for i in range(FIELDS + 1)]
    wild = [F.xxhash64(lead, F.lit(i), *fields[:i], *fields[i + 1 :]) for i in range(FIELDS)]
    # A short line has no field that could vary and still leave most of it fixed.
    found = F.when(count < LEADING + FIELDS, F.array(F.xxhash64(parts))).otherwise(F.array(F.xxhash64(parts), *wild))
    kind = F.when(count < MIN_TOKENS, count).when(count >= LONG_TOKENS, LONG).otherwise(0).cast("long")
    return F.transform(found, lambda t: t.bitwiseAND(F.lit(~COUNT_BITS)).bitwiseOR(kind))


def _floor(template: Column, min_documents: int) -> Column:
    """Documents that a template recurs from."""
    kind = template.bitwiseAND(F.lit(COUNT_BITS))
    floor = F.when(kind == LONG, min(min_documents, LONG_DOCUMENTS)).otherwise(min_documents)
    for tokens, times in CHANCE.items():
        floor = F.when(kind == tokens, min_documents * times).otherwise(floor)
    return floor


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, line, template): one row per line of a document and template of it.

    ``line`` is a hash of the line, ``content`` one of the set of all lines with a template: only copies share it.
    """
    spaced = F.when(F.col("text").rlike(f"[{WHITE}]"), F.regexp_replace("text", f"[{WHITE}]", " ")).otherwise(F.col("text"))
    marked = F.when(F.col("spaced").rlike("[0-9]"), F.regexp_replace("spaced", "[0-9]+", "#")).otherwise(F.col("spaced"))
    docs = docs.withColumn("spaced", spaced).withColumn("marked", marked)
    pairs = F.arrays_zip(F.transform(F.split("marked", "\n"), _tokens).alias("tokens"), F.split("spaced", "\n").alias("exact"))
    parsed = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id",
        F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x)).alias("line"),
        F.transform(pairs, lambda x: _fields(x["tokens"], _tokens(x["exact"]))).alias("fields"),
    )
    parsed = parsed.withColumn("parts", F.filter("fields.parts", lambda p: p.isNotNull()))
    content = F.xxhash64(F.array_sort(F.array_distinct(F.transform("parts", lambda p: F.xxhash64(p)))))
    one = parsed.select("doc_id", content.alias("content"), F.explode(F.arrays_zip("line", "fields")).alias("f"))
    one = one.where("f.fields.parts IS NOT NULL")
    return one.select(
        "doc_id", "content", F.col("f.line").alias("line"), F.explode(_templates(F.col("f.fields.count"), F.col("f.fields.parts"))).alias("template")
    )


def recurring(rows: DataFrame, min_documents: int) -> DataFrame:
    """(template, first_id) of the templates found in different contents, at least ``_floor``.

    Counted in two aggregations that both start in the map tasks, so a template in every document is one row a task.
    """
    by_content = rows.groupBy("template", "content").agg(F.min("doc_id").alias("first_id"))
    counted = by_content.groupBy("template").agg(F.count("*").alias("documents"), F.min("first_id").alias("first_id"))
    return counted.where(F.col("documents") >= _floor(F.col("template"), min_documents)).select("template", "first_id")


def drop_recurring_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with recurring lines taken out of ``text``, plus ``lines_dropped``.

    Lines end at a line feed; a blank line stays. A line recurs from ``min_documents`` documents on, one of LONG_TOKENS
    tokens or more from LONG_DOCUMENTS, one of one or two tokens from CHANCE times ``min_documents``; one of fewer than
    MIN_TOKENS tokens is compared with its digits. It stays in the document with the smallest doc_id of one of its
    recurring templates, so one copy of each remains. Copies (the same set of lines, but for digits) count once, near copies each. A null text stays null, an
    empty one empty; rows that share a doc_id lose the same lines; a null doc_id keeps its text. Other columns pass
    through, a ``lines_dropped`` of the input is replaced.
    """
    rows = stage(lines(docs.select("doc_id", "text")), "lines")
    hits = rows.join(recurring(rows, min_documents), "template")
    gone = hits.groupBy("doc_id", "line").agg(F.max(F.col("doc_id") == F.col("first_id")).alias("first"))
    listed = free_name("gone", docs.columns)
    gone = gone.where("NOT first").groupBy("doc_id").agg(F.collect_list("line").alias(listed))
    kept = docs.drop("lines_dropped").join(gone, "doc_id", "left").select(*[F.col(f"`{c}`") for c in docs.columns if c != "lines_dropped"], listed)
    split = F.split("text", "\n")
    left = F.filter(split, lambda x: ~F.array_contains(listed, F.xxhash64(x)))
    hit = F.col(listed).isNotNull()
    dropped = F.when(hit & F.col("text").isNotNull(), F.size(split) - F.size(left)).otherwise(0)
    text = F.when(hit, F.array_join(left, "\n")).otherwise(F.col("text"))
    return kept.withColumns({"text": text, "lines_dropped": dropped.cast("long")}).drop(listed)
