"""Replayed captures: normalized events, alerts, run rows and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators.shaping import keep_one, lookup
from threatloom.schemas import ALERT, EVENT, REPLAY_RUN

# Defaults that appear in stored rows and messages.
EVENT_SOURCE = "suricata"
REPLAY_SOURCE_ID = "ctu13_pcap_replay"
DEFAULT_EVENT_TYPES = ["alert", "flow", "dns", "http", "tls"]
EVENTS_TOPIC = "suricata.events"
ALERTS_TOPIC = "ids.alerts"
SUCCEEDED = "succeeded"
EVENT_FIELDS = (
    "struct<timestamp string, event_type string, src_ip string, src_port bigint, dest_ip string, dest_port bigint, "
    "proto string, app_proto string, flow_id string, pcap_cnt bigint, pcap_filename string, "
    "alert struct<signature string, severity bigint, category string>>"
)


def stamp_artifact(events: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Add the replayed artifact's columns to each event by hash.

    Artifacts are reduced to one row per hash first, so events never multiply. One capture may hold most of
    the events: the artifact side is small and broadcast when its size allows, else skewed parts are split.
    """
    one = keep_one(
        artifacts, ["sha256"], S.sort_date_value(F.col("ingest_date")).desc(), F.col("artifact_name")
    ).select(
        F.col("sha256").alias("artifact_sha256"),
        "artifact_name",
        "scenario_number",
        F.col("relative_landing_path").alias("relative_pcap_landing_path"),
        *[c for c in ("replay_run_id",) if c in artifacts.columns],
    )
    return lookup(events, one, ["artifact_sha256"])


def normalize_events(stamped: DataFrame, ingest_date: str, replay_run_id: Column | None = None) -> DataFrame:
    """Flat event rows of VARIANT ``event`` with its artifact columns.

    All fields are read by one declared structure: a value that does not fit its type, a missing key and an
    ``alert`` that is no object each read as null, which then takes the default. The structure passes
    through a generator so that it is read once per row and not once per column.
    """
    opened = stamped.withColumn("_fields", F.explode(F.array(F.try_variant_get("event", "$", EVENT_FIELDS))))
    fields = F.col("_fields")

    def text(name):
        return F.coalesce(fields[name], F.lit(""))

    def number(name):
        return F.coalesce(fields[name], F.lit(0).cast("bigint"))

    def of_artifact(name):
        return F.coalesce(F.col(name), F.lit(""))

    alert = fields["alert"]
    run = replay_run_id if replay_run_id is not None else F.col("replay_run_id")
    columns = {
        "source": F.lit(EVENT_SOURCE),
        "timestamp_utc": text("timestamp"),
        "src_port": number("src_port"),
        "dest_port": number("dest_port"),
        "pcap_cnt": number("pcap_cnt"),
        "signature": F.coalesce(alert["signature"], F.lit("")),
        "severity": F.coalesce(alert["severity"], F.lit(0).cast("bigint")),
        "category": F.coalesce(alert["category"], F.lit("")),
        "pcap_filename": F.coalesce(S.non_empty(fields["pcap_filename"]), of_artifact("artifact_name")),
        "scenario_number": F.coalesce("scenario_number", F.lit(0).cast("bigint")),
        "artifact_name": of_artifact("artifact_name"),
        "artifact_sha256": of_artifact("artifact_sha256"),
        "relative_pcap_landing_path": of_artifact("relative_pcap_landing_path"),
        "replay_run_id": F.coalesce(run, F.lit("")),
        "ingest_date": F.lit(ingest_date),
        "event_payload_json": S.canonical_json(F.col("event")),
    }
    plain = ("event_type", "src_ip", "dest_ip", "proto", "app_proto", "flow_id")
    return opened.select(*[(text(c) if c in plain else columns[c]).alias(c) for c in EVENT.names])


def alerts(events: DataFrame) -> DataFrame:
    """Alert rows of normalized events."""
    renamed = {"dst_ip": "dest_ip", "dst_port": "dest_port"}
    return events.where(F.col("event_type") == "alert").select(
        *[F.col(renamed.get(c, c)).alias(c) for c in ALERT.names]
    )


def counts_per_run(events: DataFrame, run: str = "replay_run_id", allowed: list[str] | None = None) -> DataFrame:
    """Events per type as a sorted JSON map, the total and the alert count, per run.

    Counted by (run, type) first, so a run with most of the events is already small when its map is built;
    the map has one entry per event type.
    """
    rows = events.where(F.col("event_type").isin(allowed)) if allowed else events
    per_type = rows.groupBy(run, "event_type").agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("event_type", "n")))
    return per_type.groupBy(run).agg(
        F.to_json(F.map_from_entries(entries)).alias("event_counts_json"),
        F.sum("n").alias("total_events"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "alert", F.col("n"))), F.lit(0).cast("bigint")).alias(
            "alert_events"
        ),
    )


def run_rows(attempts: DataFrame, events: DataFrame, event_types: list[str], ingest_date: str, binary: str) -> DataFrame:
    """One row per replay attempt.

    ``attempts`` are candidates with ``replay_run_id, status, error, started_at, completed_at,
    eve_landing_path``; events of failed attempts are not counted twice, they have none.
    """
    counted = attempts.join(counts_per_run(events), "replay_run_id", "left")
    stamp_format = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    zero = F.lit(0).cast("bigint")
    columns = {
        "source_id": F.lit(REPLAY_SOURCE_ID),
        "error_summary": S.error_tail(F.coalesce("error", F.lit(""))),
        "suricata_bin": F.lit(binary),
        "event_types": F.lit(",".join(event_types)),
        "event_counts_json": F.coalesce("event_counts_json", F.lit("{}")),
        "total_events": F.coalesce("total_events", zero),
        "alert_events": F.coalesce("alert_events", zero),
        "started_at_utc": F.date_format("started_at", stamp_format),
        "completed_at_utc": F.date_format("completed_at", stamp_format),
        "duration_seconds": S.duration_seconds(F.col("started_at"), F.col("completed_at")),
        "artifact_sha256": F.col("sha256"),
        "artifact_size_bytes": F.coalesce("size_bytes", zero),
        "relative_pcap_landing_path": F.col("relative_landing_path"),
        "pcap_landing_path": F.col("landing_path"),
        "ingest_date": F.lit(ingest_date),
    }
    return counted.select(*[columns.get(c, F.col(c)).alias(c) for c in REPLAY_RUN.names])


def replay_summary(runs: DataFrame) -> DataFrame:
    """Candidates, successes, failures, events and alerts of one replay job."""
    ok = F.col("status") == SUCCEEDED
    return runs.agg(
        F.count("*").alias("candidate_artifacts"),
        F.count_if(ok).alias("successful_replays"),
        F.count_if(~ok).alias("failed_replays"),
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("normalized_events"),
        F.coalesce(F.sum("alert_events"), F.lit(0)).alias("alert_events"),
    )


def assert_replayed(summary: DataFrame) -> DataFrame:
    """Stop the job when any replay failed."""
    failed = F.raise_error(F.concat(F.col("failed_replays").cast("string"), F.lit(" replay(s) failed")))
    checked = F.when(F.col("failed_replays") > 0, failed).otherwise(F.col("failed_replays"))
    return summary.withColumn("failed_replays", checked)
