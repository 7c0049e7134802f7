"""Which CVEs and hosts to look up, and what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S


def score_per_cve(scores: DataFrame) -> DataFrame:
    """Highest score per CVE with the position at which the CVE was first seen.

    ``scores`` has text ``cve`` and ``epss`` with ``page, pos``; values that are not CVE ids are dropped.
    """
    shaped = scores.where(S.looks_like_cve(F.col("cve")))
    if "cve_is_text" in scores.columns:
        shaped = shaped.where(F.col("cve_is_text"))
    return shaped.groupBy("cve").agg(
        F.max(S.probability(F.col("epss"))).alias("score"), F.min(F.struct("page", "pos")).alias("first_seen")
    )


def top_cves(scores: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` CVEs with the highest score; ties keep arrival order."""
    return score_per_cve(scores).orderBy(F.desc("score"), "first_seen").limit(n)


def seeds(feed: DataFrame, configured: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` distinct addresses, feed order before configured order.

    Both inputs are ``(ip, ord)`` with an ``ord`` of one type that sorts in arrival order.
    """
    parts = feed.select("ip", F.lit(0).alias("rank"), "ord").unionByName(
        configured.select("ip", F.lit(1).alias("rank"), "ord")
    )
    return distinct_in_order(parts.where(F.col("ip").isNotNull())).orderBy("first_seen").limit(n)


def distinct_in_order(parts: DataFrame) -> DataFrame:
    """One row per address with the first position it was seen at."""
    return parts.groupBy("ip").agg(F.min(F.struct("rank", "ord")).alias("first_seen"))


def lookup_results(candidates: DataFrame, responses: DataFrame, key: str, base_url: str) -> DataFrame:
    """One row per candidate: found with its payload, or failed with request, HTTP status and error.

    ``responses`` are landed answers, unique per key, with a JSON text ``payload`` or an ``error`` message, and perhaps a
    ``status_code``, else taken from the message; a candidate without any answer has failed too.
    """
    known = F.col("status_code") if "status_code" in responses.columns else F.lit(None).cast("int")
    answers = responses.select(key, "payload", "error", known.cast("int").alias("_status"))
    joined = candidates.join(answers, key, "left")
    valid = F.try_parse_json("payload").isNotNull()
    error = F.coalesce(
        F.col("error"), F.when(F.col("payload").isNull(), F.lit("no response")), F.lit("Invalid JSON response")
    )
    return joined.select(
        *candidates.columns,
        F.concat(F.lit(base_url + "/"), F.col(key)).alias("request_url"),
        F.coalesce(valid, F.lit(False)).alias("found"),
        F.when(valid, F.col("payload")).alias("payload"),
        F.when(F.coalesce(~valid, F.lit(True)), F.coalesce("_status", S.http_status(error))).alias("status_code"),
        F.when(~valid, error).alias("error"),
    )


def lookup_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("requested"),
        F.count_if("found").alias("successful"),
        F.count_if(~F.col("found")).alias("failed"),
    )


def type_breakdown(items: DataFrame) -> DataFrame:
    """Indicators per type as a sorted JSON map, and how many elements the feed sent in all."""
    item = F.col("item")
    return label_counts(items, F.when(S.is_object(item), S.ioc_type_label(item)))


def label_counts(rows: DataFrame, label: Column) -> DataFrame:
    """Count per label as one sorted JSON map, and the count of all rows; a null label is not in the map.

    Rows are counted per label first, so one entry per distinct label reaches the last step.
    """
    counted = rows.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n"))))
    return counted.agg(
        F.to_json(F.map_from_entries(entries)).alias("ioc_type_breakdown"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("ioc_count"),
    )


def in_window(df: DataFrame, moment: str, end: Column, hours: int) -> DataFrame:
    """Rows whose ``moment`` lies in the ``hours`` up to ``end``, both ends included."""
    return df.where(F.col(moment).between(S.window_start(end, hours), end))
