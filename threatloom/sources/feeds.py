"""Landed vulnerability and indicator feeds.

A feed page is one JSON object per file with the records in one array, so a page is one task and pages are
the unit of parallelism. Every scan keeps ``(page, pos)``, the position in which a record arrived, because
ties are broken by it later; nothing depends on the order Spark happens to read files in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.schemas import EPSS_FIELDS, KEV_FIELDS, THREATFOX_FIELDS
from threatloom.sources.files import read_sidecars
from threatloom.sources.lines import objects_only, read_lines

# Words in a query status that mean the feed refused us, and the page number in paths.
REFUSED_STATUS = ["unauthor", "forbidden", "auth"]
PAGE_IN_PATH = r".*page=(\d+)"
CSV_HEADER_START = "id,"


def read_pages(spark: SparkSession, path: str | list[str], items: str, *values: str) -> DataFrame:
    """One row per page file: the record array, other named top-level values, file path and page number.

    Records are read as VARIANT one by one, so only a single record is limited in size, not the page. A
    record field that holds no array reads as null; a file that does not hold a JSON object stops the job.
    """
    schema = ", ".join([f"`{items}` array<variant>", *[f"`{v}` variant" for v in values], "_misfit string"])
    raw = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_misfit")
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    misfit = F.col("_misfit")
    broken = misfit.isNotNull() & ~(F.ltrim(misfit).startswith("{") & F.try_parse_json(misfit).isNotNull())
    stop = F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("file_path")))
    page = F.regexp_extract("file_path", PAGE_IN_PATH, 1).try_cast("bigint")
    return raw.select(
        "file_path",
        F.coalesce(page, F.lit(0).cast("bigint")).alias("page"),
        *[F.when(broken, stop).otherwise(F.col(f)).alias(f) for f in (items, *values)],
    )


def explode_items(pages: DataFrame, field: str) -> DataFrame:
    """``(file_path, page, pos, item)`` per record; a page without records gives no rows."""
    return pages.select("file_path", "page", F.posexplode(field).alias("pos", "item"))


def spread(items: DataFrame, partitions: int | None) -> DataFrame:
    """Few large page files leave few tasks; repartition before heavy per-record work."""
    return items.repartition(partitions) if partitions else items


def _texts(item: Column, names: list[str]) -> list[Column]:
    return [S.json_text(item, f"$.{name}").alias(name) for name in names]


def read_kev(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """Known-exploited vulnerabilities. Only JSON landings hold rows; a CSV landing stays raw."""
    items = spread(explode_items(read_pages(spark, path, "vulnerabilities"), "vulnerabilities"), partitions)
    item = F.col("item")
    return items.select(
        *_texts(item, KEV_FIELDS),
        F.try_variant_get(item, "$.cwes", "array<string>").alias("cwes"),
        S.canonical_json(item).alias("raw_json"),
        "file_path",
        "page",
        "pos",
    )


def nvd_records(items: DataFrame) -> DataFrame:
    """Vulnerability records of a page, with the first English description and the raw record."""
    cve = F.try_variant_get("item", "$.cve", "variant")
    descriptions = F.try_variant_get(cve, "$.descriptions", "array<struct<lang string, value string>>")
    return items.select(
        S.json_text(cve, "$.id").alias("cve_id"),
        S.json_text(cve, "$.published").alias("published"),
        S.json_text(cve, "$.lastModified").alias("last_modified"),
        S.json_text(cve, "$.vulnStatus").alias("vuln_status"),
        S.first_where(descriptions, lambda d: d["lang"] == "en")["value"].alias("description_en"),
        cve.alias("cve"),
        *[c for c in items.columns if c != "item"],
    )


def read_nvd(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    items = explode_items(read_pages(spark, path, "vulnerabilities"), "vulnerabilities")
    return nvd_records(spread(items, partitions))


def read_epss(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """Exploit probabilities, all values still text, plus whether ``cve`` was JSON text at all."""
    items = spread(explode_items(read_pages(spark, path, "data"), "data"), partitions)
    item = F.col("item")
    return items.where(S.is_object(item)).select(
        *_texts(item, EPSS_FIELDS),
        (S.json_kind(item, "$.cve") == "STRING").alias("cve_is_text"),
        "file_path",
        "page",
        "pos",
    )


def read_threatfox(spark: SparkSession, path) -> DataFrame:
    """All elements of the indicator array as VARIANT, objects or not; a refused query stops the job."""
    pages = read_pages(spark, path, "data", "query_status")
    status = F.lower(S.strip(S.safe_str(F.col("query_status"), "$")))
    refused = F.lit(False)
    for word in REFUSED_STATUS:
        refused = refused | status.contains(word)
    refuse = F.raise_error(F.concat(F.lit("indicator feed refused the query: "), status))
    checked = pages.withColumn("data", F.when(refused, refuse).otherwise(F.col("data")))
    return explode_items(checked, "data")


def threatfox_records(items: DataFrame) -> DataFrame:
    """Indicator objects as flat text columns; nested values become JSON text, non-objects are dropped."""
    item = F.col("item")
    return items.where(S.is_object(item)).select(
        *_texts(item, THREATFOX_FIELDS), S.canonical_json(item).alias("raw_json"), "file_path", "page", "pos"
    )


def read_commented_csv(spark: SparkSession, path) -> DataFrame:
    """CSV whose header is the last ``# id,…`` comment of each file; every column is text.

    The columns are those named in any file's header, in header order; their names are all that is read ahead. Each
    line is then cut once, and its values are placed by the header of its own file, however many formats there are.
    A name that a header repeats has its first value; values beyond the header are left out.
    """
    lines = read_lines(spark, path)
    comment = F.regexp_replace("line", "^#+", "")
    header = S.strip(comment)
    headers = (
        lines.where(F.col("line").startswith("#") & header.startswith(CSV_HEADER_START))
        .groupBy("file_path")
        .agg(F.max_by(header, "seq").alias("header"))
        .select("file_path", F.transform(F.split("header", ","), S.strip).alias("names"))
    )
    listed = headers.select("names").distinct().select(F.posexplode("names").alias("pos", "name"))
    named = listed.groupBy("name").agg(F.min("pos").alias("pos"), F.max("pos").alias("last")).orderBy("pos", "name").collect()
    names = [r["name"] for r in named]
    if not names:
        return lines.select(F.col("line").alias("id"), "file_path", "seq").where(F.lit(False))
    options = {"quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": ""}
    cells = [f"c{i}" for i in range(1 + max(r["last"] for r in named))]
    cut = F.from_csv("line", F.lit(", ".join(f"{c} string" for c in cells)), options)
    data = lines.where(~F.col("line").startswith("#")).join(headers, "file_path").withColumn("r", cut)
    values = F.array(*[F.col(f"r.{c}") for c in cells])
    placed = [F.get(values, F.array_position("names", name) - 1).alias(name) for name in names]
    return data.select(*placed, "file_path", "seq")


def csv_rows(spark: SparkSession, path) -> DataFrame:
    """Non-blank, non-comment lines."""
    return read_lines(spark, path).where(~F.col("line").startswith("#"))


def csv_row_count(spark: SparkSession, path) -> DataFrame:
    """Non-blank, non-comment lines per file."""
    return csv_rows(spark, path).groupBy("file_path").agg(F.count("*").alias("record_count"))


def read_enrichment(spark: SparkSession, path, key: str) -> DataFrame:
    """Lookup responses, one JSON object per line: key, request, time, payload as VARIANT."""
    lines = objects_only(read_lines(spark, path)).select("line")
    rows = S.parsed(lines, "line", "doc").where(F.col("doc").isNotNull())
    return rows.select(
        S.json_text(F.col("doc"), "$.source_id").alias("source_id"),
        S.json_text(F.col("doc"), f"$.{key}").alias(key),
        S.json_text(F.col("doc"), "$.request_url").alias("request_url"),
        S.json_text(F.col("doc"), "$.retrieved_at_utc").alias("retrieved_at_utc"),
        F.try_variant_get("doc", "$.payload", "variant").alias("payload"),
    )


def read_failures(spark: SparkSession, path, key: str) -> DataFrame:
    """``(key, request_url, status_code, error)`` of the failed requests that the sidecars of lookups list."""
    failed = S.json_items(F.col("sidecar"), "$.failed_requests")
    each = read_sidecars(spark, path).select(F.explode(failed).alias("f"))
    doc = F.col("f")
    return each.select(
        S.json_text(doc, f"$.{key}").alias(key),
        S.json_text(doc, "$.request_url").alias("request_url"),
        S.safe_int(doc, "$.status_code").cast("int").alias("status_code"),
        S.json_text(doc, "$.error").alias("error"),
    ).where(F.col(key).isNotNull())
