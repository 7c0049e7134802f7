"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(text=(), **typed) -> list[T.StructField]:
    fields = [T.StructField(name, T.StringType()) for name in text]
    return fields + [T.StructField(name, kind) for name, kind in typed.items()]


_LONG, _DOUBLE, _BOOL = T.LongType(), T.DoubleType(), T.BooleanType()

# Column names and order of the stored tables.
KEV_FIELDS = [
    "cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription",
    "requiredAction", "dueDate", "knownRansomwareCampaignUse", "notes",
]
EPSS_FIELDS = ["cve", "epss", "percentile", "date"]
THREATFOX_FIELDS = [
    "id", "ioc", "ioc_type", "ioc_value", "ip", "host", "threat_type", "malware", "malware_printable",
    "confidence_level", "first_seen", "last_seen", "reference", "reporter", "tags",
]

ARTIFACT_KEYS = ["source_id", "scenario_number", "artifact_name", "ingest_date", "sha256"]

ARTIFACT = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("scenario_number", _LONG),
        *_table(
            ["scenario_directory", "scenario_url", "artifact_name", "artifact_url", "artifact_format",
             "compression"]
        ),
        T.StructField("is_compressed", _BOOL),
        *_table(["profile", "selection_rule", "retrieved_at_utc", "cataloged_at_utc", "content_type"]),
        T.StructField("size_bytes", _LONG),
        *_table(["sha256", "landing_path", "relative_landing_path", "ingest_date"]),
    ]
)

EVENT = T.StructType(
    [
        *_table(["source", "event_type", "timestamp_utc", "src_ip"]),
        T.StructField("src_port", _LONG),
        T.StructField("dest_ip", T.StringType()),
        T.StructField("dest_port", _LONG),
        *_table(["proto", "app_proto", "signature"]),
        T.StructField("severity", _LONG),
        *_table(["category", "flow_id"]),
        T.StructField("pcap_cnt", _LONG),
        T.StructField("pcap_filename", T.StringType()),
        T.StructField("scenario_number", _LONG),
        *_table(
            ["artifact_name", "artifact_sha256", "relative_pcap_landing_path", "replay_run_id",
             "ingest_date", "event_payload_json"]
        ),
    ]
)

ALERT = T.StructType(
    [
        *_table(["timestamp_utc", "src_ip", "dst_ip"]),
        T.StructField("src_port", _LONG),
        T.StructField("dst_port", _LONG),
        T.StructField("signature", T.StringType()),
        T.StructField("severity", _LONG),
        *_table(["source", "event_type", "category"]),
        T.StructField("scenario_number", _LONG),
        *_table(["artifact_sha256", "replay_run_id", "ingest_date"]),
    ]
)

REPLAY_RUN = T.StructType(
    [
        *_table(["source_id", "replay_run_id", "status", "error_summary", "suricata_bin", "event_types",
                 "event_counts_json"]),
        T.StructField("total_events", _LONG),
        T.StructField("alert_events", _LONG),
        *_table(["started_at_utc", "completed_at_utc"]),
        T.StructField("duration_seconds", _DOUBLE),
        T.StructField("scenario_number", _LONG),
        *_table(["artifact_name", "artifact_sha256"]),
        T.StructField("artifact_size_bytes", _LONG),
        *_table(["relative_pcap_landing_path", "pcap_landing_path", "eve_landing_path", "ingest_date"]),
    ]
)

LINEAGE = T.StructType(
    [
        *_table(["run_id", "dag_id", "task_id"]),
        T.StructField("source_paths", T.ArrayType(T.StringType())),
        *_table(["target_path", "transformation_name"]),
        T.StructField("rows_read", _LONG),
        T.StructField("rows_written", _LONG),
        T.StructField("rows_rejected", _LONG),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)

_LOADED = ["ingest_date", "retrieved_at_utc"]
_TEXTS = T.ArrayType(T.StringType())

# Declared columns of each trusted table; what a feed has besides goes into ``_extra`` as JSON.
TRUSTED_COLUMNS = {
    "kev": _table(
        ["cve_id", "vendor_project", "product", "vulnerability_name", "short_description", "required_action",
         "known_ransomware_campaign_use", "notes", "raw_json", *_LOADED],
        date_added=T.DateType(), due_date=T.DateType(), cwes=_TEXTS,
    ),
    "epss": _table(["cve", "date", *_LOADED], epss=_DOUBLE, percentile=_DOUBLE, _quality_warn=_BOOL),
    "nvd": _table(
        ["cve_id", "published", "last_modified", "vuln_status", "description_en", "cvss_v3_vector", "cvss_v3_severity", *_LOADED],
        cvss_v3_score=_DOUBLE,
    ),
    "circl_vulnlookup": _table(["cve_id", "source_id", "request_url", *_LOADED], cwe_ids=_TEXTS, reference_count=_LONG),
    "urlhaus": _table(
        ["id", "dateadded", "url", "url_status", "last_online", "threat", "tags", "urlhaus_link", "reporter", *_LOADED],
        _quality_warn=_BOOL,
    ),
    "threatfox": _table([*THREATFOX_FIELDS, "raw_json", *_LOADED]),
}

# Natural key, mandatory fields and casts of each trusted table.
TRUSTED = {
    "kev": {
        "key": ["cve_id"],
        "mandatory": ["cve_id", "vulnerability_name"],
        "casts": {"date_added": "date", "due_date": "date"},
    },
    "epss": {
        "key": ["cve", "date"],
        "mandatory": ["cve", "date"],
        "casts": {"epss": "double", "percentile": "double"},
    },
    "nvd": {"key": ["cve_id"], "mandatory": ["cve_id"], "casts": {"cvss_v3_score": "double"}},
    "circl_vulnlookup": {"key": ["cve_id"], "mandatory": ["cve_id"], "casts": {}},
    "urlhaus": {"key": ["id"], "mandatory": ["id"], "casts": {}},
    "threatfox": {"key": ["id"], "mandatory": ["id"], "casts": {}},
}
