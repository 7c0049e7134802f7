"""Binary artifacts, selection rules and stored tables."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threatloom.functions import scalars as S

CHUNK_BYTES = 1024 * 1024


def _uri(path: str) -> str:
    """A URI as Arrow knows it: the Hadoop names of S3 connectors are one scheme there."""
    return re.sub(r"^s3[an]://", "s3://", path)


def _hash_files(batches):
    """SHA-256 of each path, one chunk in memory at a time, from whatever filesystem the URI names."""
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch["path"]:
            filesystem, name = fs.FileSystem.from_uri(_uri(path))
            digest = hashlib.sha256()
            with filesystem.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "size_bytes": batch["size_bytes"], "sha256": digests})


def read_artifacts(spark: SparkSession, path, glob: str = "*") -> DataFrame:
    """Path, size, SHA-256 and hive parts of landed files.

    Spark lists the files (the column selection reaches the scan, so no content is read there); every file, whatever
    its size, is hashed by one stream of chunks in the task that got it, so no file has to fit in memory. Empty files are
    not listed by Spark. Schemes are those of Arrow: local files, ``s3``, ``gs``, ``abfs`` and, with libhdfs, ``hdfs``;
    another one stops the job.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"))
    )
    hashed = listed.mapInPandas(_hash_files, "path string, size_bytes bigint, sha256 string")
    return hashed.select(
        "*",
        *[S.path_part(F.col("path"), part).alias(part) for part in ("source", "scenario", "ingest_date")],
        F.element_at(F.split("path", "/"), -1).alias("artifact_name"),
    )


def read_selection_rules(spark: SparkSession, path: str) -> DataFrame:
    """Ordered ``(profile, mode, rule_index, label, pattern)`` with the scenario range and link pattern."""
    text = spark.read.text(path, wholetext=True)
    config = F.parse_json("value")
    rule = "array<struct<label string, pattern string>>"
    profiles = F.try_variant_get(config, "$.profiles", f"map<string, struct<mode string, selection_rules {rule}>>")
    return (
        text.select(
            S.json_text(config, "$.scenario_pattern").alias("scenario_pattern"),
            S.safe_int(config, "$.scenario_range.start").alias("scenario_start"),
            S.safe_int(config, "$.scenario_range.end").alias("scenario_end"),
            F.explode(profiles).alias("profile", "body"),
        )
        .select("*", "body.mode", F.posexplode("body.selection_rules").alias("rule_index", "rule"))
        .select(
            "profile", "mode", "rule_index", "rule.label", "rule.pattern",
            "scenario_pattern", "scenario_start", "scenario_end",
        )
    )


def profile_rules(rules: DataFrame, profile: str) -> list[tuple[str, str]]:
    """Ordered rules of one profile, all of them: they are a hand-written configuration file, never data."""
    rows = rules.where(F.col("profile") == profile).orderBy("rule_index").select("label", "pattern").collect()
    if not rows:
        raise ValueError(f"unknown profile '{profile}'")
    return [(r["label"], r["pattern"]) for r in rows]


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Parquet folder with ``position``, their place in the order in which they were written, from 0.

    The files of one write are numbered in order; places inside a file come from its row index, so no row is sorted.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # one row per file
    return rows.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


# What a sidecar tells of its artifact, as text and as numbers.
SIDECAR_TEXTS = ["source_id", "source_url", "request_url", "retrieved_at_utc", "landing_path", "relative_landing_path", "sha256"]
SIDECAR_NUMBERS = ["size_bytes", "page_index", "offset", "results_per_page", "total_results", "record_count"]
SIDECAR_SUFFIX = ".meta.json"


def read_sidecars(spark: SparkSession, path) -> DataFrame:
    """One row per sidecar file: its fields, and ``sidecar`` with all of it as VARIANT; one that is no object is skipped."""
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("sidecar_path"))
    rows = S.parsed(text, "value", "sidecar").where(S.is_object(F.col("sidecar")))
    doc = F.col("sidecar")
    return rows.select(
        *[S.json_text(doc, f"$.{name}").alias(name) for name in SIDECAR_TEXTS],
        *[S.safe_int(doc, f"$.{name}").alias(name) for name in SIDECAR_NUMBERS],
        "sidecar",
        "sidecar_path",
    )


def relative_path(path: Column, root: str) -> Column:
    """A path below ``root`` without it, whatever scheme either is written with."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", root).strip("/")
    return F.substring_index(path, f"{bare}/", -1)


def read_table(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """A stored table: the newest complete snapshot if it is kept as snapshots, else the folder itself."""
    from threatloom.operators.writes import finish_merges, table_root

    root = table_root(spark, path)
    finish_merges(spark, root)
    table = spark.read.parquet(root)
    if "ingest_date" in table.columns:
        table = table.withColumn("ingest_date", F.col("ingest_date").cast("string"))
        if ingest_date:
            table = table.where(F.col("ingest_date") == ingest_date)
    return table
