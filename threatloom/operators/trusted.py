"""Trusted zone: information-preserving cleaning. Rows are flagged or set aside, never lost."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatloom.functions import scalars as S
from threatloom.operators.shaping import keep_one, row_hash
from threatloom.operators.writes import Split, split_rejects
from threatloom.schemas import TRUSTED, TRUSTED_COLUMNS


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def align(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Columns in snake_case; with a schema, exactly its columns, absent ones as typed nulls."""
    renamed = df.withColumnsRenamed({c: snake_case(c) for c in df.columns})
    if schema is None:
        return renamed
    return renamed.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in renamed.columns else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema
        ]
    )


def declared(df: DataFrame, columns: list[T.StructField]) -> DataFrame:
    """Exactly the declared columns, and ``_extra``: absent ones are typed nulls, unknown ones are kept aside as JSON."""
    names = {f.name for f in columns}
    unknown = sorted(c for c in df.columns if c not in names)
    extra = F.to_json(F.struct(*[F.col(f"`{c}`") for c in unknown])) if unknown else F.lit(None).cast("string")
    kept = align(df.withColumn("_extra", F.nullif(extra, F.lit("{}"))), T.StructType([*columns, T.StructField("_extra", T.StringType())]))
    return kept


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Text to dates and numbers; text that does not fit becomes null."""
    return df.withColumns({c: S.strip(F.col(c).cast("string")).try_cast(t) for c, t in casts.items() if c in df.columns})


def warn(df: DataFrame, broken: Column) -> DataFrame:
    """Set ``_quality_warn`` where ``broken`` holds; earlier warnings stay, null counts as fine."""
    before = F.col("_quality_warn") if "_quality_warn" in df.columns else F.lit(False)
    return df.withColumn("_quality_warn", before | F.coalesce(broken, F.lit(False)))


def warn_outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return warn(df, ~F.col(column).between(low, high))


def warn_not_in(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return warn(df, ~F.col(column).isin(allowed))


def warn_bad_url(df: DataFrame, column: str = "url") -> DataFrame:
    return warn(df, ~S.looks_like_url(F.col(column)))


def dedup(df: DataFrame, keys: list[str], recency: str = "retrieved_at_utc") -> DataFrame:
    """Latest row per natural key; equal times are settled by row content."""
    return keep_one(df, keys, F.col(recency).desc_nulls_last(), row_hash(df))


def clean(df: DataFrame, table: str) -> Split:
    """Clean and rejected rows of one feed table by its declared columns, key, mandatory fields and casts.

    One pass over ``df``. Clean rows have the declared columns whatever the feed has; rejected ones stay as they came.
    """
    rules = TRUSTED[table]
    split = split_rejects(align(df), rules["mandatory"])
    columns = TRUSTED_COLUMNS[table]
    good = cast_columns(dedup(split.clean, rules["key"]), rules["casts"])
    good = declared(good, [f for f in columns if f.name != "_quality_warn"])
    if table == "epss":
        good = warn_outside(good, "epss", 0.0, 1.0)
    if table == "urlhaus":
        good = warn_bad_url(good)
    return split._replace(clean=good.select(*[f.name for f in columns], "_extra"))


def flatten_cvss(records: DataFrame) -> DataFrame:
    """CVSS v3.1 score, vector and severity of the first metric block (VARIANT ``cve``); none gives nulls."""
    blocks = F.try_variant_get("cve", "$.metrics.cvssMetricV31", "array<variant>")
    data = F.try_variant_get(F.get(blocks, F.lit(0)), "$.cvssData", "variant")
    return records.withColumns(
        {
            "cvss_v3_score": F.try_variant_get(data, "$.baseScore", "double"),
            "cvss_v3_vector": F.try_variant_get(data, "$.vectorString", "string"),
            "cvss_v3_severity": F.try_variant_get(data, "$.baseSeverity", "string"),
        }
    )


def circl_profile(rows: DataFrame) -> DataFrame:
    """Weakness ids and number of references per CVE, from either published layout of the payload."""
    payload = F.col("payload")
    if not isinstance(rows.schema["payload"].dataType, T.VariantType):
        payload = F.try_parse_json("payload")
    cna = "$.containers.cna"
    legacy_cwe = S.json_string(payload, "$.cwe")
    problems = F.try_variant_get(
        payload, f"{cna}.problemTypes", "array<struct<descriptions array<struct<cweId string>>>>"
    )
    listed = F.flatten(F.transform(problems, lambda p: F.transform(p["descriptions"], lambda d: d["cweId"])))
    cwes = F.coalesce(
        F.array_sort(F.array_distinct(F.array_compact(listed))),
        F.when(legacy_cwe.isNotNull(), F.array(legacy_cwe)),
        F.array().cast("array<string>"),
    )
    references = F.coalesce(S.json_items(payload, f"{cna}.references"), S.json_items(payload, "$.references"))
    return rows.withColumns(
        {"cwe_ids": cwes, "reference_count": F.coalesce(F.size(references), F.lit(0)).cast("bigint")}
    ).drop("payload")


def check_events(events: DataFrame) -> Split:
    """Events with type, time and source; an unreadable time becomes the sentinel and is flagged. One pass over ``events``."""
    texts = {f.name: F.make_valid_utf8(f.name) for f in events.schema if isinstance(f.dataType, T.StringType)}
    split = split_rejects(events.withColumns(texts), ["event_type", "timestamp_utc", "src_ip"])
    parsed = S.strip(F.col("timestamp_utc")).try_cast("timestamp")
    good = split.clean.withColumns(
        {
            "event_ts": F.coalesce(parsed, F.lit(S.SENTINEL_TIMESTAMP).cast("timestamp")),
            "_ts_malformed": parsed.isNull(),
        }
    )
    return split._replace(clean=good)


def dedup_events(events: DataFrame, *order: Column) -> DataFrame:
    """Drop repeats of an event inside one replay run; the same event in two runs stays."""
    keys = ["replay_run_id", "flow_id", "timestamp_utc", "event_type"]
    return keep_one(events, keys, *(order or (row_hash(events),)))


def clean_warm_aggregates(
    rows: DataFrame, key: list[str], counts: list[str], dimensions: list[str], *order: Column
) -> Split:
    """Window aggregates: counts must be whole numbers, dimensions present, one row per window key."""
    typed = rows.withColumns({c: S.text_int(F.col(c).cast("string")) for c in counts})
    split = split_rejects(typed, [*dimensions, *counts])
    return split._replace(clean=keep_one(split.clean, key, *(order or (row_hash(split.clean),))))


def quality_report(vulns: DataFrame) -> DataFrame:
    """Violation counts of the enriched vulnerability table, in one pass of partial aggregates.

    Ids are counted per value first and the counts summed, so uniqueness needs no set of all ids.
    """

    def outside(column, low, high):
        return F.count_if((F.col(column) < low) | (F.col(column) > high))

    per_id = vulns.groupBy("cve_id").agg(
        F.count("*").alias("n"),
        outside("epss_score", 0.0, 1.0).alias("epss"),
        outside("cvss_v3_score", 0.0, 10.0).alias("cvss"),
        F.count_if(F.col("vuln_priority_score") < 0).alias("score"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_id.agg(
        total("n").alias("rows"),
        total(F.when(F.col("cve_id").isNull(), F.col("n"))).alias("null_cve_id"),
        total(F.when(F.col("cve_id").isNotNull(), F.col("n") - 1)).alias("repeated_cve_id"),
        total("epss").alias("epss_out_of_range"),
        total("cvss").alias("cvss_out_of_range"),
        total("score").alias("negative_score"),
    )
