"""The streaming jobs on the supplied events, run to the end of the input and read back from their sinks."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.plans.event_queries import customer_vulns
from threatloom.plans.registry import Tables, query
from threatloom.session import work_dir
from threatloom.streaming import alerts as streams


def event_stream(t: Tables) -> DataFrame:
    return streams.read_files(t.spark, f"{t.folder}/events*.parquet", t.events.schema, "parquet")


def _run(start, stream: DataFrame, folder: str) -> str:
    sink = f"{folder}/sink"
    start(stream, path=sink, checkpoint=f"{folder}/checkpoint", available_now=True).awaitTermination()
    return sink


def _run_backwards(t: Tables, deliveries: list[list[int]], shape, start) -> str:
    """Events landed third by third, the latest first; after each delivery the stream goes on from its checkpoint.

    ``ts`` is text, and unreadable in some rows; ``true_ts`` always has the time. A delivery lands whole thirds of the
    table, in as many files as Spark writes, and is one micro-batch.
    """
    folder = work_dir(t.spark, "landed")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    part = F.when(F.dayofmonth("ts") > 20, 0).when(F.dayofmonth("ts") > 10, 1).otherwise(2)
    rows = t.events.select(
        "event_id", "user_id", "event_type", F.when(F.col("event_id") % 100 != 7, text).otherwise("none").alias("ts"), text.alias("true_ts"), part.alias("part")
    )
    sink = ""
    for parts in deliveries:
        for i in parts:
            rows.where(F.col("part") == i).drop("part").write.mode("append").parquet(f"{folder}/events")
        stream = streams.read_files(t.spark, f"{folder}/events", rows.drop("part").schema, "parquet")
        sink = _run(start, shape(stream), folder)
    return sink


SIGNATURE = "'ET CVE_2021_' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')"


@query(f"""
WITH vulns AS (
  SELECT 'CVE-2021-' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS cve_id, c_acctbal, c_mktsegment FROM customer),
alerts AS (SELECT event_id, CASE WHEN event_type = 'error' THEN {SIGNATURE} ELSE event_type END AS signature,
  CASE WHEN event_type = 'error' THEN 'CVE-2021-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') END AS cve FROM events)
SELECT event_id, signature, cve AS cve_id, c_acctbal AS vuln_priority_score, c_mktsegment AS cvss_v3_severity
FROM alerts LEFT JOIN vulns ON cve_id = cve
""")
def q_stream_enrich(t: Tables) -> DataFrame:
    """Alerts enriched by the CVE in their signature as they arrive."""
    named = F.concat(F.lit("ET CVE_2021_"), S.padded("user_id", 6))
    alerts = event_stream(t).select(
        "event_id", F.when(F.col("event_type") == "error", named).otherwise(F.col("event_type")).alias("signature")
    )
    sink = _run(streams.append_to, streams.warm_enrichment(alerts, customer_vulns(t)), work_dir(t.spark, "enrich"))
    return t.spark.read.parquet(sink)


@query("""
SELECT CASE WHEN event_id % 100 = 7 THEN '1970-01-01 00' ELSE strftime(date_trunc('hour', ts), '%Y-%m-%d %H') END AS window_start,
  event_type AS signature, count(*) AS alerts FROM events GROUP BY ALL
""")
def q_stream_window(t: Tables) -> DataFrame:
    """Alerts per hour and signature, counted continuously, the latest first and some without a readable time."""
    count = partial(streams.counts_to, width="1 hour", dimensions=["signature"])
    sink = _run_backwards(
        t, [[0], [1], [2]], lambda s: streams.with_event_time(s.withColumnRenamed("event_type", "signature"), "ts"), count
    )
    rows = streams.total_counts(t.spark, sink, ["window_start", "signature"])
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "signature", "alerts")


@query("""
SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_utc FROM events
""")
def q_stream_dedup(t: Tables) -> DataFrame:
    """Every event delivered twice, in one micro-batch or in two, late ones last, kept once."""
    keys = ["user_id", "event_type", "timestamp_utc"]
    shape = lambda s: s.select("user_id", "event_type", F.col("true_ts").alias("timestamp_utc"))
    return t.spark.read.parquet(_run_backwards(t, [[0], [1, 1], [2, 0, 2]], shape, partial(streams.first_to, keys=keys)))


@query("""
SELECT CAST(event_id AS VARCHAR) AS key, 'suricata.events' AS topic,
  '{"event_type":"' || event_type || '","flow_id":' || event_id || ',"user_id":' || user_id || '}' AS value FROM events
""")
def q_stream_pass(t: Tables) -> DataFrame:
    """Events forwarded unchanged as messages."""
    events = event_stream(t).select("event_type", F.col("event_id").alias("flow_id"), "user_id")
    sink = _run(streams.append_to, streams.pass_through(events, "suricata.events"), work_dir(t.spark, "pass"))
    return t.spark.read.parquet(sink)


