"""Line files: manifests, event logs, alert logs."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators.shaping import told
from threatloom.schemas import ALERT

# Where line files are landed.
MANIFEST_PATH = "metadata/manifests/ingest_date={date}/{{,of=}}{source}.jsonl"
ALERT_PATHS = {
    "synthetic": "stream/ids_alerts/ingest_date=*/hour=*",
    "replay": "stream/ids_alerts/source=suricata/ingest_date=*/hour=*",
}


def if_landed(spark: SparkSession, scan: Callable[[], DataFrame], schema: str) -> DataFrame:
    """The scan, or no rows when nothing has been landed at its path yet."""
    try:
        return scan()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Non-blank stripped lines with their file and ``seq``, the order of lines inside and across files.

    Folders come in name order, the files of one folder in the order they were written. A file split is one
    scan task and keeps line order, so (split start, row in task) is the order inside a file.
    """
    file = F.col("_metadata.file_path")
    return (
        spark.read.text(path)
        .select(
            S.strip(F.make_valid_utf8("value")).alias("line"),
            file.alias("file_path"),
            F.struct(
                F.regexp_extract(file, "^(.*)/", 1).alias("folder"),
                F.col("_metadata.file_modification_time").alias("written"),
                file.alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("seq"),
        )
        .where(F.col("line") != "")
    )


def read_manifest(spark: SparkSession, root: str, source_id: str, ingest_date: str | None = None) -> DataFrame:
    """Manifest entries of one source, one date or all; broken and non-object lines are skipped.

    The manifest of a date is one file ``<source>.jsonl`` or a folder ``of=<source>.jsonl`` of files.
    """
    path = f"{root}/" + MANIFEST_PATH.format(date=ingest_date or "*", source=source_id)
    seq = "struct<folder: string, written: timestamp, file: string, block: bigint, row: bigint>"
    landed = if_landed(spark, lambda: read_lines(spark, path), f"line string, file_path string, seq {seq}")
    lines = objects_only(landed).select(
        "line", S.path_part(F.col("file_path"), "ingest_date").alias("manifest_date"), "seq"
    )
    return S.parsed(lines, "line", "entry").where(F.col("entry").isNotNull())


def objects_only(lines: DataFrame) -> DataFrame:
    """Lines that can only be JSON objects, told by their first character before any parsing."""
    return lines.where(F.col("line").startswith("{"))


def read_eve(spark: SparkSession, root: str, event_types: list[str], ingest_date: str | None = None) -> DataFrame:
    """Landed event logs under ``scenario=/artifact_sha256=/ingest_date=``; wanted event types only.

    Hive parts come from partition discovery as text, so a date filter prunes folders.
    """
    schema = "value string, scenario string, artifact_sha256 string, ingest_date string"
    files = if_landed(spark, lambda: spark.read.schema(schema).option("basePath", root).text(root), schema)
    if ingest_date:
        files = files.where(F.col("ingest_date") == ingest_date)
    events = files.select(F.make_valid_utf8("value").alias("value"), "artifact_sha256", "ingest_date")
    return wanted_events(S.parsed(events, "value", "event"), event_types)


def wanted_events(events: DataFrame, event_types: list[str]) -> DataFrame:
    """Events whose type is in the list; only an object has a type, so other JSON values drop out."""
    return events.where(F.try_variant_get("event", "$.event_type", "string").isin(event_types))


def event_type_list(text: str | None, default: list[str]) -> list[str]:
    """Event types named in a comma list."""
    wanted = [part.strip() for part in (text or "").split(",") if part.strip()]
    return wanted or default


def read_alert_logs(spark: SparkSession, root: str) -> DataFrame:
    """Alerts of both producers. Their folders differ in depth, so each is read on its own."""
    parts = None
    for producer, pattern in ALERT_PATHS.items():
        base = f"{root}/stream/ids_alerts" + ("/source=suricata" if producer == "replay" else "")
        body = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in ALERT if f.name != "ingest_date"
        )
        schema = f"{body}, ingest_date string, hour string"
        reader = spark.read.schema(schema).option("basePath", base)
        part = if_landed(spark, partial(reader.json, f"{root}/{pattern}"), schema)
        parts = part if parts is None else parts.unionByName(part)
    return told(parts.select(*ALERT.names, "hour"), ("ingest_date", "hour"))
