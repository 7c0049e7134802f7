"""Event, alert and indicator operators on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators import anomaly, events, exploitation, trusted, writes
from threatloom.plans.registry import Tables, query
from threatloom.plans.storage_queries import SEED_SQL, ip_tokens
from threatloom.schemas import ALERT, EVENT
from threatloom.session import work_dir
from threatloom.sources.lines import event_type_list, read_alert_logs, read_eve, wanted_events

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
KINDS = {"error": "alert", "view": "flow", "click": "http", "purchase": "dns", "signup": "stats"}
KIND_SQL = (
    "CASE event_type WHEN 'error' THEN 'alert' WHEN 'view' THEN 'flow' WHEN 'click' THEN 'http' "
    "WHEN 'purchase' THEN 'dns' ELSE 'stats' END"
)


# -- event logs -------------------------------------------------------------------------------------


def kind_of(column: str = "event_type"):
    return F.coalesce(*[F.when(F.col(column) == k, v) for k, v in KINDS.items()])


def eve_lines(t: Tables) -> DataFrame:
    """Supplied events as event-log lines ``(value, artifact_sha256, event_id)``.

    Ports come as numbers, as text and as text that is no whole number; ``alert`` is an object or plain text.
    """
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    is_error, is_click = F.col("event_type") == "error", F.col("event_type") == "click"
    port = F.when(is_error, F.concat(F.lit('" '), k, F.lit(' "'))).when(is_click, F.concat(F.lit('"'), k, F.lit('.5"')))
    alert = F.when(
        is_error,
        F.concat(
            F.lit('"alert":{"category":"c'), k, F.lit('","severity":'), k, F.lit(',"signature":"ET CVE-2021-'),
            S.padded("user_id", 6), F.lit('"},'),
        ),
    ).otherwise(F.when(is_click, F.lit('"alert":"none",')).otherwise(F.lit("")))
    user = F.col("user_id")
    line = F.concat(
        F.lit('{"timestamp":"'), F.date_format("ts", ISO), F.lit('",'), alert,
        F.lit('"src_ip":"10.0.'), (user / 256).cast("int").cast("string"), F.lit("."), (user % 256).cast("string"),
        F.lit('","src_port":'), F.coalesce(port, k), F.lit(',"flow_id":'), F.col("event_id").cast("string"),
        F.lit(',"event_type":"'), kind_of(), F.lit('"}'),
    )
    return t.events.select(line.alias("value"), S.sha256((user % 25).cast("string")).alias("artifact_sha256"), "event_id")


EVE = f"""
WITH base AS (
  SELECT event_id, user_id, {KIND_SQL} AS kind, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp,
    regexp_extract(props, '"k": (\\d+)', 1) AS k, '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src_ip,
    user_id % 25 AS nation FROM events),
eve AS (
  SELECT event_id, 'suricata' AS source, kind AS event_type, stamp AS timestamp_utc, src_ip,
    CAST(CASE WHEN kind = 'http' THEN 0 ELSE CAST(k AS BIGINT) END AS BIGINT) AS src_port,
    '' AS dest_ip, CAST(0 AS BIGINT) AS dest_port, '' AS proto, '' AS app_proto,
    CASE WHEN kind = 'alert' THEN 'ET CVE-2021-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') ELSE '' END AS signature,
    CAST(CASE WHEN kind = 'alert' THEN CAST(k AS BIGINT) ELSE 0 END AS BIGINT) AS severity,
    CASE WHEN kind = 'alert' THEN 'c' || k ELSE '' END AS category,
    CAST(event_id AS VARCHAR) AS flow_id, CAST(0 AS BIGINT) AS pcap_cnt,
    n_name || '.pcap' AS pcap_filename, CAST(n_nationkey + 42 AS BIGINT) AS scenario_number,
    n_name || '.pcap' AS artifact_name, sha256(CAST(nation AS VARCHAR)) AS artifact_sha256,
    'raw/' || n_name AS relative_pcap_landing_path, 'run-' || n_nationkey AS replay_run_id, '2026-03-12' AS ingest_date,
    '{{' || CASE kind
        WHEN 'alert' THEN '"alert":{{"category":"c' || k || '","severity":' || k || ',"signature":"ET CVE-2021-'
          || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') || '"}},'
        WHEN 'http' THEN '"alert":"none",' ELSE '' END
      || '"event_type":"' || kind || '","flow_id":' || event_id || ',"src_ip":"' || src_ip || '","src_port":'
      || CASE kind WHEN 'alert' THEN '" ' || k || ' "' WHEN 'http' THEN '"' || k || '.5"' ELSE k END
      || ',"timestamp":"' || stamp || '"}}' AS event_payload_json
  FROM base JOIN nation ON n_nationkey = nation WHERE kind <> 'stats'),
alerts AS (
  SELECT timestamp_utc, src_ip, dest_ip AS dst_ip, src_port, dest_port AS dst_port, signature, severity, source, event_type,
    category, scenario_number, artifact_sha256, replay_run_id, ingest_date, flow_id FROM eve WHERE event_type = 'alert')
"""


def nation_artifacts(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    return t.nation.select(
        S.sha256(key.cast("string")).alias("sha256"),
        F.concat("n_name", F.lit(".pcap")).alias("artifact_name"),
        (key + 42).cast("bigint").alias("scenario_number"),
        F.concat(F.lit("raw/"), F.col("n_name")).alias("relative_landing_path"),
        F.concat(F.lit("run-"), key.cast("string")).alias("replay_run_id"),
        F.lit("2026-03-12").alias("ingest_date"),
    )


def normalized(t: Tables) -> DataFrame:
    parsed = S.parsed(eve_lines(t).drop("event_id"), "value", "event")
    kept = wanted_events(parsed, event_type_list("alert, flow,dns,http,tls", []))
    return events.normalize_events(events.stamp_artifact(kept, nation_artifacts(t)), "2026-03-12")


@query(EVE + f"SELECT {', '.join(EVENT.names)} FROM eve")
def q_eve_normalize(t: Tables) -> DataFrame:
    return normalized(t)


@query(
    EVE
    + """
SELECT event_type, artifact_sha256, count(*) AS events, count(*) FILTER (src_port > 50) AS high_ports
FROM eve WHERE event_type IN ('alert', 'dns') GROUP BY ALL
"""
)
def q_eve_scan(t: Tables) -> DataFrame:
    """Event logs landed per capture with broken lines between, scanned back for two event types."""
    root = work_dir(t.spark, "eve")
    noisy = F.concat(F.col("value"), F.lit("\n\n{broken\n[]\n"))
    lines = eve_lines(t).select(
        noisy.alias("value"), F.lit("42").alias("scenario"), "artifact_sha256", F.lit("2026-03-12").alias("ingest_date")
    )
    lines.write.partitionBy("scenario", "artifact_sha256", "ingest_date").text(root)
    scanned = read_eve(t.spark, root, ["alert", "dns"], "2026-03-12")
    counted = scanned.groupBy(S.safe_str(F.col("event"), "$.event_type").alias("event_type"), "artifact_sha256")
    return counted.agg(
        F.count("*").alias("events"),
        F.count_if(S.safe_int(F.col("event"), "$.src_port", 0) > 50).alias("high_ports"),
    )


@query(
    EVE
    + f"""
SELECT {', '.join(ALERT.names)}, '08' AS hour FROM alerts
UNION ALL
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'), '10.0.0.1', '10.0.0.2', user_id, 443, 'SYNTH ' || event_type, 3, 'synthetic', 'alert',
  'synthetic', 0, '', '', '2026-03-12', strftime(ts, '%H') FROM events WHERE event_type = 'signup'
"""
)
def q_alert_projection(t: Tables) -> DataFrame:
    """Alerts of both producers written to their two log layouts and read back as one table."""
    root = work_dir(t.spark, "stream")
    replayed = events.alerts(normalized(t)).withColumn("hour", F.lit("08"))
    fixed = {
        "timestamp_utc": F.date_format("ts", ISO), "src_ip": F.lit("10.0.0.1"), "dst_ip": F.lit("10.0.0.2"),
        "src_port": F.col("user_id"), "dst_port": F.lit(443).cast("bigint"),
        "signature": F.concat(F.lit("SYNTH "), F.col("event_type")), "severity": F.lit(3).cast("bigint"),
        "source": F.lit("synthetic"), "event_type": F.lit("alert"), "category": F.lit("synthetic"),
        "scenario_number": F.lit(0).cast("bigint"), "artifact_sha256": F.lit(""), "replay_run_id": F.lit(""),
        "ingest_date": F.lit("2026-03-12"),
    }
    synthetic = t.events.where(F.col("event_type") == "signup").select(
        *[fixed[c].alias(c) for c in ALERT.names], S.hour_partition(F.col("ts")).alias("hour")
    )
    base = f"{root}/stream/ids_alerts"
    writes.write_json_log(synthetic, base, ["ingest_date", "hour"])
    writes.write_json_log(replayed, f"{base}/source=suricata", ["ingest_date", "hour"])
    return read_alert_logs(t.spark, root)


@query(r"""
SELECT CASE WHEN event_type = 'click' THEN 'run-' || user_id WHEN event_type = 'view' THEN sha256(CAST(user_id AS VARCHAR))
    WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) END AS key,
  '{"artifact_sha256":"' || CASE WHEN event_type = 'view' THEN sha256(CAST(user_id AS VARCHAR)) ELSE '' END
    || '","event_type":"' || event_type || '","flow_id":"' || CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) ELSE '' END
    || '","replay_run_id":' || CASE WHEN event_type = 'click' THEN '"run-' || user_id || '"' ELSE 'null' END
    || ',"user":' || user_id || '}' AS value,
  'suricata.events' AS topic
FROM events
""")
def q_publish_envelope(t: Tables) -> DataFrame:
    kind, empty = F.col("event_type"), F.lit("")
    user = F.col("user_id").cast("string")
    records = t.events.select(
        F.when(kind == "click", F.concat(F.lit("run-"), user)).alias("replay_run_id"),
        F.when(kind == "view", S.sha256(user)).otherwise(empty).alias("artifact_sha256"),
        F.when(kind == "error", F.col("event_id").cast("string")).otherwise(empty).alias("flow_id"),
        "event_type",
        F.col("user_id").alias("user"),
    )
    return writes.envelope(records, events.EVENTS_TOPIC)


COUNTS = f"""
WITH typed AS (SELECT CAST(user_id AS VARCHAR) AS replay_run_id, {KIND_SQL} AS kind FROM events),
per_type AS (SELECT replay_run_id, kind, count(*) AS n FROM typed WHERE kind <> 'stats' GROUP BY ALL),
counts AS (
  SELECT replay_run_id, '{{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}}' AS event_counts_json,
    CAST(sum(n) AS BIGINT) AS total_events, CAST(coalesce(sum(n) FILTER (kind = 'alert'), 0) AS BIGINT) AS alert_events
  FROM per_type GROUP BY replay_run_id)
"""


def counts(t: Tables) -> DataFrame:
    typed = t.events.select(F.col("user_id").cast("string").alias("replay_run_id"), kind_of().alias("event_type"))
    return events.counts_per_run(typed, allowed=events.DEFAULT_EVENT_TYPES)


@query(COUNTS + "SELECT * FROM counts")
def q_counts_per_run(t: Tables) -> DataFrame:
    return counts(t)


@query(
    COUNTS
    + """
SELECT count(*) AS candidate_artifacts, count(*) FILTER (alert_events > 12) AS successful_replays,
  count(*) FILTER (alert_events <= 12) AS failed_replays, CAST(sum(total_events) AS BIGINT) AS normalized_events,
  CAST(sum(alert_events) AS BIGINT) AS alert_events FROM counts
"""
)
def q_replay_summary(t: Tables) -> DataFrame:
    """One summary row of all runs; runs with few alerts count as failed."""
    status = F.when(F.col("alert_events") > 12, events.SUCCEEDED).otherwise("failed")
    return events.replay_summary(counts(t).withColumn("status", status))


# -- trusted zone -----------------------------------------------------------------------------------

RAW_SCORES = """
WITH raw AS (
  SELECT user_id, event_type, CASE WHEN event_type = 'view' AND value < 5 THEN NULL WHEN event_type = 'click' AND value > 50
    THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS score_text, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS retrieved_at_utc
  FROM events)
"""


@query(
    RAW_SCORES
    + """
, latest AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY retrieved_at_utc DESC) AS rn
  FROM raw WHERE score_text IS NOT NULL)
SELECT user_id, event_type, CASE WHEN score_text <> 'n/a' THEN value END AS score_text, retrieved_at_utc,
  coalesce(CASE WHEN score_text <> 'n/a' THEN value > 100 END, false) OR event_type = 'error' AS _quality_warn,
  CAST(NULL AS VARCHAR) AS _reject_reason
FROM latest WHERE rn = 1
UNION ALL
SELECT user_id, event_type, CAST(NULL AS DOUBLE), retrieved_at_utc, CAST(NULL AS BOOLEAN), 'score_text' FROM raw WHERE score_text IS NULL
"""
)
def q_trusted_clean(t: Tables) -> DataFrame:
    """Rename, reject, deduplicate, cast and flag; the rejected rows are kept with their reason."""
    kind, value = F.col("event_type"), F.col("value")
    text = F.when((kind == "click") & (value > 50), "n/a").when(~((kind == "view") & (value < 5)), value.cast("string"))
    raw = t.events.select(
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        text.alias("scoreText"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("retrieved_at_utc"),
    )
    good, bad, _, _ = writes.split_rejects(trusted.align(raw), ["score_text"])
    good = trusted.cast_columns(trusted.dedup(good, ["user_id", "event_type"]), {"score_text": "double"})
    good = trusted.warn_not_in(
        trusted.warn_outside(good, "score_text", 0.0, 100.0), "event_type", ["view", "click", "signup", "purchase"]
    )
    bad = bad.withColumn("score_text", F.col("score_text").try_cast("double"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("""
WITH shaped AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS run, CAST(l_linenumber AS VARCHAR) AS flow,
    CASE WHEN l_returnflag = 'R' THEN 'soon' ELSE strftime(l_shipdate, '%Y-01-01T00:00:00Z') END AS stamp,
    CASE WHEN l_tax = 0 AND l_linestatus = 'O' THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS src, l_linestatus AS kind,
    l_partkey, l_extendedprice FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run, flow, stamp, kind ORDER BY l_partkey, src, l_extendedprice) AS rn
  FROM shaped WHERE src <> '')
SELECT run AS replay_run_id, flow AS flow_id, kind AS event_type, src AS src_ip, l_partkey AS part_key,
  CASE WHEN stamp = 'soon' THEN '1970-01-01' ELSE stamp[1:10] END AS event_date, stamp = 'soon' AS _ts_malformed, '' AS _reject_reason
FROM ranked WHERE rn = 1
UNION ALL
SELECT run, flow, kind, src, l_partkey, NULL, NULL, 'src_ip' FROM shaped WHERE src = ''
""")
def q_event_quality(t: Tables) -> DataFrame:
    """Line items as replayed events: missing sources set aside, bad times flagged, repeats in a run dropped."""
    year = F.date_format("l_shipdate", "yyyy-'01-01T00:00:00Z'")
    shaped = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("replay_run_id"),
        F.col("l_linenumber").cast("string").alias("flow_id"),
        F.when(F.col("l_returnflag") == "R", "soon").otherwise(year).alias("timestamp_utc"),
        F.when((F.col("l_tax") == 0) & (F.col("l_linestatus") == "O"), "")
        .otherwise(F.col("l_suppkey").cast("string"))
        .alias("src_ip"),
        F.col("l_linestatus").alias("event_type"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_extendedprice").alias("price"),
    )
    good, bad, _, _ = trusted.check_events(shaped)
    good = trusted.dedup_events(good, F.col("part_key"), F.col("src_ip"), F.col("price"))
    good = good.withColumns({"event_date": F.date_format("event_ts", "yyyy-MM-dd"), "_reject_reason": F.lit("")})
    columns = [
        "replay_run_id", "flow_id", "event_type", "src_ip", "part_key", "event_date", "_ts_malformed", "_reject_reason",
    ]
    none = {"event_date": F.lit(None).cast("string"), "_ts_malformed": F.lit(None).cast("boolean")}
    return good.select(*columns).unionByName(bad.withColumns(none).select(*columns))


@query("""
WITH counted AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT day, event_type, n AS alerts, '' AS _reject_reason FROM counted WHERE event_type <> 'error'
UNION ALL SELECT day, event_type, CAST(NULL AS BIGINT), 'alerts' FROM counted WHERE event_type = 'error'
UNION ALL SELECT day, event_type, CAST(NULL AS BIGINT), 'alerts' FROM counted WHERE event_type = 'error'
""")
def q_warm_clean(t: Tables) -> DataFrame:
    """Window aggregates delivered twice; counts that are no whole numbers are set aside."""
    counted = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))
    text = F.when(F.col("event_type") == "error", F.concat(F.col("n").cast("string"), F.lit(".5"))).otherwise(
        F.col("n").cast("string")
    )
    rows = counted.select("day", "event_type", text.alias("alerts"))
    good, bad, _, _ = trusted.clean_warm_aggregates(
        rows.unionByName(rows), ["day", "event_type"], ["alerts"], ["day", "event_type"]
    )
    return good.withColumn("_reject_reason", F.lit("")).unionByName(bad)


# -- exploitation zone ------------------------------------------------------------------------------


@query(
    EVE
    + """
SELECT timestamp_utc, event_type, src_ip, src_port, dest_ip AS dst_ip, signature, severity, scenario_number, proto, flow_id,
  'suricata_events' AS origin FROM eve
UNION ALL
SELECT timestamp_utc, event_type, src_ip, src_port, dst_ip, signature, severity, scenario_number, NULL, NULL, 'ids_alerts' FROM alerts
"""
)
def q_network_events(t: Tables) -> DataFrame:
    rows = normalized(t)
    return exploitation.network_events(rows, events.alerts(rows)).select(
        "timestamp_utc", "event_type", "src_ip", "src_port", "dst_ip", "signature", "severity", "scenario_number",
        "proto", "flow_id", "origin",
    )


@query("""
WITH iocs AS (SELECT CAST(s_suppkey AS VARCHAR) AS value, s_name FROM supplier),
offered AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, 'src' AS matched_side, CAST(l_suppkey AS VARCHAR) AS v FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, 'dst', CAST(l_partkey AS VARCHAR) FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, matched_side, value AS matched_value, 'threatfox,urlhaus' AS sources,
  s_name AS malware FROM offered JOIN iocs ON value = v
""")
def q_ioc_ip(t: Tables) -> DataFrame:
    """Line items whose supplier or part number is an indicator, by either side."""
    listed = t.supplier.select(
        F.lit("ip").alias("ioc_type"), F.col("s_suppkey").cast("string").alias("value"), F.col("s_name").alias("malware")
    )
    twice = listed.withColumn("source", F.lit("threatfox")).unionByName(listed.withColumn("source", F.lit("urlhaus")))
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_suppkey").cast("string").alias("src"),
        F.col("l_partkey").cast("string").alias("dst"),
    )
    matched = exploitation.correlate_ip(lines, exploitation.one_per_indicator(twice), "src", "dst")
    return matched.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "matched_side", "matched_value",
        F.array_join("sources", ",").alias("sources"), F.array_join("malware", ",").alias("malware"),
    )


@query(r"""
WITH hosts AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host FROM pages),
iocs AS (
  SELECT 'url' AS ioc_type, url AS value, 'urlhaus' AS source, CAST(NULL AS VARCHAR) AS malware FROM hosts WHERE url LIKE 'http:%'
  UNION SELECT 'domain', host, 'urlhaus', NULL FROM hosts WHERE url LIKE 'http:%'
  UNION SELECT 'domain', host, 'threatfox', 'family-' || right(host, 3) FROM hosts WHERE host LIKE '%.org'),
one AS (
  SELECT ioc_type, value, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, coalesce(max(malware), '') AS malware
  FROM iocs GROUP BY ALL)
SELECT page_id, ioc_type, value AS matched_value, sources, malware FROM hosts JOIN one ON ioc_type = 'domain' AND value = host
UNION ALL
SELECT page_id, ioc_type, value, sources, malware FROM hosts JOIN one ON ioc_type = 'url' AND value = url
""")
def q_ioc_host(t: Tables) -> DataFrame:
    """Pages as observed requests against domain and URL indicators of two feeds."""
    host, none = S.url_host(F.col("url")), F.lit(None).cast("string")
    http = F.struct(host.alias("hostname"), F.col("url").alias("url"))
    requests = t.pages.select(
        "page_id", none.alias("src_ip"), none.alias("dst_ip"), F.to_json(F.struct(http.alias("http"))).alias("event_payload_json")
    )
    threatfox = t.pages.where(host.endswith(".org")).select(
        F.upper(host).alias("ioc"), none.alias("ioc_value"), none.alias("malware"),
        F.concat(F.lit("family-"), F.right(host, F.lit(3))).alias("malware_printable"),
    )
    urlhaus = t.pages.where(F.col("url").startswith("http:")).select("url")
    matched = exploitation.ioc_correlations(requests, exploitation.indicators(threatfox, urlhaus), ["page_id"])
    return matched.select(
        "page_id", "ioc_type", "matched_value", F.array_join("sources", ",").alias("sources"),
        F.array_join("malware", ",").alias("malware"),
    )


@query(
    SEED_SQL
    + r""", mentions AS (
  SELECT 'ip' AS ioc_type, ip AS value, CASE origin WHEN 0 THEN 'documents' ELSE 'pages' END AS source FROM valid
  UNION ALL SELECT 'domain', lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), 'pages' FROM pages
  UNION ALL SELECT 'cve', 'CVE-2021-' || p_size, 'part' FROM part)
SELECT ioc_type, value, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM mentions GROUP BY ALL
"""
)
def q_indicators(t: Tables) -> DataFrame:
    """Addresses, hosts and CVE ids mentioned anywhere, one row each with the tables that mention it."""

    def mention(df, kind, value, source):
        return df.select(F.lit(kind).alias("ioc_type"), value.alias("value"), F.lit(source).alias("source"))

    mentions = (
        mention(ip_tokens(t.documents, "doc_id", "text"), "ip", F.col("ip"), "documents")
        .unionByName(mention(ip_tokens(t.pages, "page_id", "html"), "ip", F.col("ip"), "pages"))
        .unionByName(mention(t.pages, "domain", F.upper(F.try_parse_url("url", F.lit("HOST"))), "pages"))
        .unionByName(mention(t.part, "cve", F.concat(F.lit("cve-2021-"), F.col("p_size").cast("string")), "part"))
    )
    canonical = exploitation.canonical_entity(F.col("ioc_type"), F.col("value"))
    found = mentions.withColumn("value", canonical).where(F.col("value").isNotNull())
    return exploitation.resolve_entities(found).withColumn("sources", F.array_join("sources", ","))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderstatus AS run_status, s_name AS raw_path
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND l_returnflag <> 'N'
  LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def q_trace(t: Tables) -> DataFrame:
    """Line items to their order and supplier; a large share has an empty run id and must stay."""
    run = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_orderkey").cast("string"))
    alerts = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", run.alias("replay_run_id"),
        F.col("l_suppkey").cast("string").alias("artifact_sha256"),
    )
    runs = t.orders.select(F.col("o_orderkey").cast("string").alias("replay_run_id"), F.col("o_orderstatus").alias("run_status"))
    artifacts = t.supplier.select(F.col("s_suppkey").cast("string").alias("artifact_sha256"), F.col("s_name").alias("raw_path"))
    return exploitation.trace_alerts(alerts, runs, artifacts).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "run_status", "raw_path"
    )


# -- counts, features, risk -------------------------------------------------------------------------

BAND = "CASE WHEN value < 20 THEN 3 WHEN value < 60 THEN 2 ELSE 1 END"


def as_alerts(t: Tables) -> DataFrame:
    band = F.when(F.col("value") < 20, 3).when(F.col("value") < 60, 2).otherwise(1).cast("bigint")
    return t.events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("signature"),
        band.alias("severity"),
        F.col("user_id").alias("src_ip"),
    )


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS window_start, count(*) AS alerts FROM events GROUP BY 1
""")
def q_alerts_per_window(t: Tables) -> DataFrame:
    counted = exploitation.alerts_per_window(as_alerts(t), "1 hour")
    return counted.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "alerts")


@query("""
WITH counted AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id AS src_ip, count(*) AS alerts FROM events GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY alerts DESC, src_ip) AS rank FROM counted)
SELECT day, src_ip, alerts, rank FROM ranked WHERE rank <= 3
UNION ALL
SELECT 'all', src_ip, alerts, 0 FROM (SELECT user_id AS src_ip, count(*) AS alerts FROM events GROUP BY ALL ORDER BY alerts DESC, src_ip LIMIT 10)
""")
def q_top_talkers(t: Tables) -> DataFrame:
    """The three busiest users per day and the ten busiest of all."""
    per_day = exploitation.top_talkers(as_alerts(t), "src_ip", 3, "1 day")
    overall = exploitation.top_talkers(as_alerts(t), "src_ip", 10).withColumn("rank", F.lit(0))
    day = F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit("all")).alias("day")
    return per_day.unionByName(overall).select(day, "src_ip", "alerts", F.col("rank").cast("bigint").alias("rank"))


@query(f"SELECT event_type AS signature, CAST({BAND} AS BIGINT) AS severity, count(*) AS alerts FROM events GROUP BY ALL")
def q_signatures(t: Tables) -> DataFrame:
    return exploitation.signature_counts(as_alerts(t))


@query(
    f"SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS signature, CAST({BAND} AS BIGINT) AS severity, count(*) AS alerts "
    "FROM events GROUP BY ALL"
)
def q_daily_counts(t: Tables) -> DataFrame:
    return exploitation.daily_alert_counts(as_alerts(t)).withColumn("date", F.col("date").cast("string"))


@query(
    EVE
    + """, flows AS (SELECT src_ip AS flow_id, severity, category, src_port, dest_port FROM eve),
led AS (SELECT *, row_number() OVER (PARTITION BY flow_id ORDER BY severity = 0, severity, category, src_port, dest_port) AS rn,
  count(*) OVER (PARTITION BY flow_id) AS event_count FROM flows)
SELECT flow_id, event_count, category, severity, src_port, dest_port AS dst_port FROM led WHERE rn = 1
"""
)
def q_features(t: Tables) -> DataFrame:
    """Per source address: event count and the fields of its gravest event."""
    return exploitation.flow_features(_flows(t))


def _flows(t: Tables) -> DataFrame:
    return normalized(t).select(
        F.col("src_ip").alias("flow_id"), "severity", "category", "src_port", F.col("dest_port").alias("dst_port")
    )


RISK = EVE + """, vulns AS (
  SELECT 'CVE-2021-' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS cve_id, c_acctbal AS vuln_priority_score, c_mktsegment AS cvss_v3_severity
  FROM customer)
"""


def customer_vulns(t: Tables) -> DataFrame:
    cve = F.concat(F.lit("CVE-2021-"), S.padded("c_custkey", 6))
    return t.customer.select(
        cve.alias("cve_id"), F.col("c_acctbal").alias("vuln_priority_score"), F.col("c_mktsegment").alias("cvss_v3_severity")
    )


@query(
    RISK
    + """
SELECT right(signature, 15) AS cve_id, count(*) AS alerts, max(vuln_priority_score) AS vuln_priority_score
FROM alerts LEFT JOIN vulns ON cve_id = right(signature, 15) GROUP BY 1
"""
)
def q_risk_summary(t: Tables) -> DataFrame:
    """Alerts per CVE named in their signatures, with the score of that CVE where it is known."""
    enriched = exploitation.enrich_alerts(events.alerts(normalized(t)), customer_vulns(t))
    return exploitation.risk_summary(enriched)


ORDER_FLOWS = """
WITH led AS (SELECT CAST(l_orderkey AS VARCHAR) AS flow_id, l_linenumber AS severity, l_returnflag || l_linestatus AS category,
  l_suppkey AS src_port, l_partkey AS dst_port, count(*) OVER (PARTITION BY l_orderkey) AS event_count,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag || l_linestatus, l_suppkey, l_partkey) AS rn FROM lineitem),
flows AS (SELECT * FROM led WHERE rn = 1)
"""


def order_features(t: Tables) -> DataFrame:
    """Features of the flows of all line items, stored."""
    lines = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("flow_id"),
        F.col("l_linenumber").cast("bigint").alias("severity"),
        F.concat("l_returnflag", "l_linestatus").alias("category"),
        F.col("l_suppkey").alias("src_port"),
        F.col("l_partkey").alias("dst_port"),
    )
    stored = work_dir(t.spark, "features")
    anomaly.feature_matrix(exploitation.flow_features(lines)).write.parquet(stored)
    return t.spark.read.parquet(stored)


@query(
    ORDER_FLOWS
    + """, d AS (SELECT flow_id, md5(flow_id || '#7') AS m FROM flows),
n AS (SELECT flow_id, CAST('0x' || substr(m, 1, 12) AS BIGINT) AS a, CAST('0x' || substr(m, 13, 12) AS BIGINT) AS b FROM d)
SELECT tree_id, flow_id, row_number() OVER (PARTITION BY tree_id ORDER BY (a + tree_id * b) % 281474976710656, flow_id) AS rank
FROM n, range(100) t(tree_id) QUALIFY rank <= 256
"""
)
def q_anomaly_draw(t: Tables) -> DataFrame:
    """The flows that each tree of the forest is grown from."""
    return anomaly.draws(order_features(t)).select(
        F.col("tree_id").cast("bigint").alias("tree_id"), F.col("k").alias("flow_id"), F.col("rank").cast("bigint").alias("rank")
    )


# Growing repeated in SQL: rows go down level by level; each node's split comes from the digest of seed, tree and place.
_LOWS, _HIGHS = (", ".join(f"{f}(f[{i}]) OVER node" for i in range(1, 6)) for f in ("min", "max"))
GROWN = f"""
, d AS (SELECT *, md5(flow_id || '#7') AS m FROM flows),
n AS (SELECT *, CAST('0x' || substr(m, 1, 12) AS BIGINT) AS a, CAST('0x' || substr(m, 13, 12) AS BIGINT) AS b FROM d),
drawn AS (SELECT tree_id, [CAST(CAST('0x' || substr(md5(category), 1, 12) AS BIGINT) AS DOUBLE), CAST(severity AS DOUBLE), CAST(src_port AS DOUBLE),
    CAST(dst_port AS DOUBLE), CAST(event_count AS DOUBLE)] AS f
  FROM n, range(100) t(tree_id) QUALIFY row_number() OVER (PARTITION BY tree_id ORDER BY (a + tree_id * b) % 281474976710656, flow_id) <= 256),
sizes AS (SELECT tree_id, count(*) AS sample, ceil(log2(greatest(count(*), 2))) AS most FROM drawn GROUP BY tree_id),
grown AS (
  SELECT tree_id, CAST(1 AS BIGINT) AS place, 0 AS depth, most, f, CAST(NULL AS BIGINT) AS feature, CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS rows_here, false AS ended
  FROM drawn JOIN sizes USING (tree_id)
  UNION ALL
  SELECT tree_id, next_place, depth, most, f, feature, threshold, rows_here, ended FROM (
    SELECT *, CASE WHEN feature IS NULL THEN place ELSE 2 * place + CASE WHEN f[feature + 1] <= threshold THEN 0 ELSE 1 END END AS next_place, feature IS NULL AS ended
    FROM (
      SELECT tree_id, place, depth + 1 AS depth, most, f, rows_here, CASE WHEN depth < most AND rows_here > 1 THEN pick END AS feature,
        lows[pick + 1] + (highs[pick + 1] - lows[pick + 1]) * (CAST(CAST('0x' || substr(m, 13, 12) AS BIGINT) AS DOUBLE) / CAST(281474976710656 AS DOUBLE)) AS threshold
      FROM (SELECT *, usable[1 + CAST('0x' || substr(m, 1, 12) AS BIGINT) % greatest(len(usable), 1)] AS pick
        FROM (SELECT *, list_filter([0, 1, 2, 3, 4], lambda i: highs[i + 1] > lows[i + 1]) AS usable, md5('7/' || tree_id || '/' || place) AS m
          FROM (SELECT tree_id, place, depth, most, f, count(*) OVER node AS rows_here, [{_LOWS}] AS lows, [{_HIGHS}] AS highs
            FROM grown WHERE NOT ended WINDOW node AS (PARTITION BY tree_id, place))))))),
nodes AS (
  SELECT DISTINCT tree_id, CASE WHEN ended THEN place ELSE place // 2 END AS place, depth - 1 AS depth, feature, CASE WHEN NOT ended THEN threshold END AS threshold, rows_here
  FROM grown WHERE rows_here > 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY place) - 1 AS node_id FROM nodes)
"""


@query(
    ORDER_FLOWS.replace("WITH led", "WITH RECURSIVE led")
    + GROWN
    + """
SELECT p.tree_id, p.node_id, coalesce(p.feature, -1) AS feature, CAST(floor(coalesce(p.threshold, 0) * 1024) AS BIGINT) AS threshold_1024,
  coalesce(l.node_id, p.node_id) AS "left", coalesce(r.node_id, p.node_id) AS "right",
  CASE WHEN p.feature IS NOT NULL THEN 0 ELSE round(p.depth + CASE WHEN p.rows_here <= 1 THEN 0 WHEN p.rows_here = 2 THEN 1
    ELSE 2 * (ln(p.rows_here - 1) + CAST(0.5772156649015329 AS DOUBLE)) - 2 * CAST(p.rows_here - 1 AS DOUBLE) / p.rows_here END, 6) END AS path,
  sample
FROM numbered p JOIN sizes USING (tree_id)
LEFT JOIN numbered l ON l.tree_id = p.tree_id AND l.place = 2 * p.place LEFT JOIN numbered r ON r.tree_id = p.tree_id AND r.place = 2 * p.place + 1
"""
)
def q_anomaly_tree(t: Tables) -> DataFrame:
    """All nodes of the forest that the flows of all line items grow."""
    whole = {c: F.col(c).cast("bigint") for c in ("tree_id", "node_id", "feature", "left", "right", "sample")}
    exact = {"threshold_1024": F.floor(F.col("threshold") * 1024), "path": F.round("path", 6)}  # codes are too long to round
    return anomaly.train(order_features(t)).withColumns({**whole, **exact}).drop("threshold")


# Two small trees: by event count, then source port; by category code, then severity.
SMALL_FOREST = [
    (0, 0, 4, 3.0, 1, 2, 0.0, 256),
    (0, 1, -1, 0.0, 1, 1, 1.5, 256),
    (0, 2, 2, 50.0, 3, 4, 0.0, 256),
    (0, 3, -1, 0.0, 3, 3, 4.0, 256),
    (0, 4, -1, 0.0, 4, 4, 6.25, 256),
    (1, 0, 0, 140737488355328.0, 1, 2, 0.0, 256),
    (1, 1, -1, 0.0, 1, 1, 3.0, 256),
    (1, 2, 1, 1.0, 3, 4, 0.0, 256),
    (1, 3, -1, 0.0, 3, 3, 7.5, 256),
    (1, 4, -1, 0.0, 4, 4, 2.0, 256),
]


@query(
    ORDER_FLOWS
    + """, paths AS (SELECT flow_id,
  CASE WHEN event_count <= 3 THEN 1.5 WHEN src_port <= 50 THEN 4.0 ELSE 6.25 END AS one,
  CASE WHEN CAST('0x' || substr(md5(category), 1, 12) AS BIGINT) <= 140737488355328 THEN 3.0 WHEN severity <= 1 THEN 7.5 ELSE 2.0 END AS other
  FROM flows),
norm AS (SELECT 2 * (ln(255) + CAST(0.5772156649015329 AS DOUBLE)) - 2 * CAST(255 AS DOUBLE) / 256 AS c)
SELECT flow_id, round(pow(2, -(one + other) / 2 / c), 6) AS anomaly_score FROM paths, norm
"""
)
def q_anomaly_score(t: Tables) -> DataFrame:
    """Every flow under two given trees."""
    model = t.spark.createDataFrame(SMALL_FOREST, anomaly.MODEL)
    return anomaly.score(order_features(t), model).select("flow_id", F.round("anomaly_score", 6).alias("anomaly_score"))


@query()
def q_anomaly(t: Tables) -> DataFrame:
    """Isolation Forest over the flows of all line items: training draws by hash, scoring covers every flow."""
    matrix = order_features(t)
    path = anomaly.save_model(anomaly.train(matrix), work_dir(t.spark, "model"), "2026-03-12")
    scored = anomaly.score(matrix, t.spark.read.parquet(path))
    return anomaly.anomalies(scored).select(
        "flow_id", "event_count", "severity", "src_port", "dst_port", F.round("anomaly_score", 6).alias("anomaly_score")
    )
