"""The jobs of the lakehouse: load feeds, catalog captures, record replays, clean, enrich.

Folders under one root: the landing zone as files, ``silver/<table>``, ``trusted/<table>``,
``trusted/rejected/<table>``, ``exploitation/<table>``. Each job reads stored tables and writes stored
tables; nothing is handed on in memory.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatloom.functions import scalars as S
from threatloom.functions.addresses import seed_ip
from threatloom.operators import anomaly, catalog, enrichment, events, exploitation, lineage, trusted, writes
from threatloom.operators.shaping import flatten, keep_one, row_hash, stamp
from threatloom.operators.upsert import merge_manifest, split_existing
from threatloom.schemas import ALERT, ARTIFACT_KEYS, EVENT, KEV_FIELDS
from threatloom.sources import feeds, files, lines
from threatloom.streaming import alerts as streams

# Natural keys of the feed tables and where their landings lie.
FEED_KEYS = {
    "kev": ["cveID"],
    "nvd": ["cve_id"],
    "epss": ["cve", "date"],
    "urlhaus": ["id"],
    "threatfox": ["id"],
    "circl_vulnlookup": ["cve_id"],
    "shodan_seeded": ["ip_str"],
}
FEED_PATHS = {
    "kev": "structured/kev/ingest_date={date}/*.json",
    "nvd": "semi_structured/nvd/ingest_date={date}/*page=*.json",
    "epss": "structured/epss/ingest_date={date}/*page=*.json",
    "urlhaus": "semi_structured/urlhaus/ingest_date={date}/*.csv",
    "threatfox": "semi_structured/threatfox/ingest_date={date}/*.json",
    "circl_vulnlookup": "semi_structured/circl_vulnlookup/ingest_date={date}/*.jsonl",
    "shodan_seeded": "semi_structured/shodan_seeded/ingest_date={date}/*.jsonl",
}
ARTIFACT_MANIFEST = "ctu13_remote_pcap"


@dataclass
class Lake:
    """One lakehouse root and the time of the current run."""

    spark: SparkSession
    root: str
    ingest_date: str
    retrieved_at_utc: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def landed(self, feed: str) -> str:
        return self.path(FEED_PATHS[feed].format(date=self.ingest_date))

    def table(self, zone: str, name: str, ingest_date: str | None = None) -> DataFrame:
        return files.read_table(self.spark, self.path(zone, name), ingest_date)

    def has(self, zone: str, name: str) -> bool:
        return writes.table_exists(self.spark, self.path(zone, name))


# -- landing → silver -------------------------------------------------------------------------------

_POSITION = ["file_path", "page", "pos", "seq", "cve_is_text"]


def feed_records(lake: Lake, feed: str) -> DataFrame:
    """Rows of one landed feed as they are stored: flat, with load date and retrieval time.

    Records of several pages with one key keep the last one, the row that merging page by page would leave.
    """
    spark, path = lake.spark, lake.landed(feed)
    key = FEED_KEYS[feed]
    if feed in ("circl_vulnlookup", "shodan_seeded"):
        answers = feeds.read_enrichment(spark, path, "cve_id" if feed == "circl_vulnlookup" else "ip")
        flat = flatten(answers.withColumnRenamed("ip", "ip_str"))
        flat = flat.withColumn("ingest_date", F.lit(lake.ingest_date))
        # Of several answers for one key the last in the order of their content stays, the same on every run.
        named = F.col(key[0]).isNotNull()
        return keep_one(flat.where(named), key, F.desc(row_hash(flat))).unionByName(flat.where(~named))
    if feed == "kev":
        # A day may have been landed as CSV only, which has no rows to store.
        kev = ", ".join([*[f"{c} string" for c in KEV_FIELDS], "cwes array<string>, raw_json string, file_path string, page bigint, pos int"])
        rows = lines.if_landed(spark, lambda: feeds.read_kev(spark, path), kev)
    elif feed == "nvd":
        rows = feeds.read_nvd(spark, path)
        rows = rows.withColumn("metrics_json", F.to_json(F.try_variant_get("cve", "$.metrics", "variant"))).drop("cve")
    elif feed == "epss":
        rows = feeds.read_epss(spark, path)
    elif feed == "threatfox":
        rows = feeds.threatfox_records(feeds.read_threatfox(spark, path))
    else:
        rows = feeds.read_commented_csv(spark, path)
    last = F.struct("page", "pos").desc() if "page" in rows.columns else F.col("seq").desc()
    has_key = F.lit(True)
    for name in key:
        has_key = has_key & F.col(name).isNotNull()
    unique = keep_one(rows.where(has_key), key, last).unionByName(rows.where(~has_key))
    return stamp(unique.drop(*_POSITION), lake.ingest_date, lake.retrieved_at_utc)


def load_feed(lake: Lake, feed: str) -> int:
    """Merge one landed feed into its silver table; returns the batch size."""
    return writes.write_or_merge(
        feed_records(lake, feed), lake.path("silver", feed), FEED_KEYS[feed], ["ingest_date"]
    )


def feed_metrics(lake: Lake, feed: str) -> DataFrame:
    """Measured size and hash of each landed file of one feed, its record count, and what its sidecar tells.

    A vulnerability list landed as CSV is measured, but its rows are not read: its count is null.
    """
    spark, path = lake.spark, lake.landed(feed)
    folder = path.rsplit("/", 1)[0]
    pattern = "*.{json,csv}" if feed == "kev" else path.rsplit("/", 1)[1]
    if feed == "urlhaus":
        counted = feeds.csv_rows(spark, path)
    elif feed in ("circl_vulnlookup", "shodan_seeded"):
        counted = lines.read_lines(spark, path)
    else:
        field = "vulnerabilities" if feed in ("kev", "nvd") else "data"
        counted = lines.if_landed(
            spark, lambda: feeds.explode_items(feeds.read_pages(spark, path, field), field), "file_path string"
        )
    found = files.read_artifacts(spark, folder, pattern).where(~F.col("path").endswith(files.SIDECAR_SUFFIX))
    found = found.withColumn("relative_landing_path", files.relative_path(F.col("path"), lake.root))
    # Told by the sidecar: relative_landing_path; where it tells none, the sidecar's own place.
    sidecars = landed_sidecars(lake, folder)
    measured = lineage.ingest_metrics(found, counted, F.col("artifact_name").endswith(".csv") if feed == "kev" else None)
    counts = measured.select("relative_landing_path", "record_count")
    return lineage.sidecar_metrics(measured, sidecars).drop("record_count").join(counts, "relative_landing_path")


def landed_sidecars(lake: Lake, folder: str) -> DataFrame:
    """Sidecars beside the landed files of a folder, if there are any."""
    schema = ", ".join(
        [*[f"{c} string" for c in files.SIDECAR_TEXTS], *[f"{c} bigint" for c in files.SIDECAR_NUMBERS], "sidecar variant", "sidecar_path string"]
    )
    rows = lines.if_landed(lake.spark, lambda: files.read_sidecars(lake.spark, f"{folder}/*{files.SIDECAR_SUFFIX}"), schema)
    beside = files.relative_path(F.regexp_replace("sidecar_path", r"\.meta\.json$", ""), lake.root)
    return rows.withColumn("relative_landing_path", F.coalesce(S.non_empty(F.col("relative_landing_path")), beside))


def lookup_candidates(lake: Lake, n: int = 200) -> DataFrame:
    """The CVEs to look up next, from the landed probability pages of the run's date."""
    top = enrichment.top_cves(feeds.read_epss(lake.spark, lake.landed("epss")), n)
    if top.isEmpty():
        raise RuntimeError("no CVE candidates for this date; load the probability feed first")
    return top


def seeds_of(lake: Lake, items: DataFrame, configured: list[str], n: int) -> DataFrame:
    """Addresses in scanned indicator elements, in landing order, then the configured ones."""
    from threatloom.functions.addresses import normalize_ip

    order = F.struct(F.col("page").alias("a"), F.col("pos").cast("bigint").alias("b"))
    feed = items.where(S.is_object(F.col("item"))).select(seed_ip(F.col("item")).alias("ip"), order.alias("ord"))
    listed = lake.spark.createDataFrame(
        [(text, 0, i) for i, text in enumerate(configured)], "text string, a bigint, b bigint"
    ).select(normalize_ip(F.col("text")).alias("ip"), F.struct("a", "b").alias("ord"))
    return enrichment.seeds(feed, listed, n)


def seed_addresses(lake: Lake, configured: list[str], n: int = 50) -> DataFrame:
    """The addresses to look up next: those of the landed indicator feed, then the configured ones.

    A refused query stops the job before any address is used.
    """
    return seeds_of(lake, feeds.read_threatfox(lake.spark, lake.landed("threatfox")), configured, n)


def lookup_report(lake: Lake, candidates: DataFrame, feed: str, base_url: str) -> DataFrame:
    """One row per wanted CVE or host: its landed answer, or why there is none.

    Failures and their causes are those that the sidecar of the answers lists; an answer wins over a failure.
    """
    spark, key = lake.spark, "cve_id" if feed == "circl_vulnlookup" else "ip"
    answers = feeds.read_enrichment(spark, lake.landed(feed), key).select(
        key, F.to_json("payload").alias("payload"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("status_code")
    )
    folder = lake.landed(feed).rsplit("/", 1)[0]
    failures = lines.if_landed(
        spark, lambda: feeds.read_failures(spark, f"{folder}/*{files.SIDECAR_SUFFIX}", key),
        f"{key} string, request_url string, status_code int, error string",
    ).select(key, F.lit(None).cast("string").alias("payload"), "error", "status_code")
    both = answers.unionByName(failures)
    return enrichment.lookup_results(candidates, keep_one(both, [key], F.col("payload").asc_nulls_last(), F.col("error")), key, base_url)


def current_manifest(lake: Lake, source_id: str, ingest_date: str | None = None) -> DataFrame:
    """The manifest with every identity once, its last entry at its first position."""
    entries = lines.read_manifest(lake.spark, lake.root, source_id, ingest_date)
    text = entries.select(
        S.manifest_identity(F.col("entry")).alias("identity"), F.to_json("entry").alias("line"), "manifest_date", "seq"
    )
    return merge_manifest(text)


# -- captures ---------------------------------------------------------------------------------------


def plan_artifacts(
    lake: Lake, index: DataFrame, listings: DataFrame, rules: DataFrame, profile: str, force: bool = False
) -> DataFrame:
    """What to land: per scenario the chosen file, and whether it is landed already.

    ``index`` has ``(page_url, html)`` of the root page, ``listings`` the same per scenario page.
    """
    first = rules.where(F.col("profile") == profile).first()
    if first is None:
        raise ValueError(f"unknown profile '{profile}'")
    scenarios = catalog.discover_scenarios(
        catalog.extract_links(index), first["scenario_pattern"], first["scenario_start"], first["scenario_end"]
    )
    listed = catalog.list_files(catalog.extract_links(listings), ["page_url"]).withColumnRenamed("page_url", "scenario_url")
    candidates = scenarios.join(listed, "scenario_url")
    chosen = catalog.select_artifacts(
        candidates, files.profile_rules(rules, profile), ["scenario_number", "scenario_directory", "scenario_url"]
    )
    target = F.concat(
        F.lit("unstructured/pcap/source=ctu13/scenario="), F.col("scenario_number").cast("string"),
        F.lit(f"/ingest_date={lake.ingest_date}/"), F.col("artifact_name"),
    )
    selected = catalog.apply_mode(chosen, first["mode"]).withColumns(
        {
            "artifact_url": S.url_join(F.col("scenario_url"), F.col("artifact_name")),
            "relative_landing_path": target,
        }
    )
    landed = lines.read_manifest(lake.spark, lake.root, ARTIFACT_MANIFEST).select(
        S.safe_str(F.col("entry"), "$.relative_landing_path").alias("relative_landing_path")
    )
    return split_existing(selected, landed, ["relative_landing_path"], force)


def catalog_captures(lake: Lake, ingest_date: str | None = None) -> tuple[DataFrame, int]:
    """Merge the capture manifest into ``pcap_artifacts``; returns the catalog and the batch size."""
    manifest = lines.read_manifest(lake.spark, lake.root, ARTIFACT_MANIFEST, ingest_date)
    rows = catalog.build_catalog(catalog.artifact_records(manifest, lake.retrieved_at_utc))
    size = writes.write_or_merge(rows, lake.path("silver", "pcap_artifacts"), ARTIFACT_KEYS, ["ingest_date"])
    return rows, size


def list_captures(lake: Lake) -> str:
    """Store the whole capture catalog in catalog order, for listings; returns the folder of the newest one."""
    return writes.write_snapshot(catalog.in_catalog_order(lake.table("silver", "pcap_artifacts")), lake.path("trusted", "pcap_catalog"))


def plan_replays(lake: Lake, max_artifacts: int, allow_decompress: bool = False, max_bytes: int | None = None) -> DataFrame:
    """The captures to replay next; one whose landed file has another hash than its catalog row stops the job."""
    chosen = catalog.replay_candidates(lake.table("silver", "pcap_artifacts"), max_artifacts, allow_decompress, max_bytes)
    return catalog.assert_integrity(catalog.integrity(chosen, _landed_captures(lake)))


def load_alert_logs(lake: Lake) -> int:
    """Append the alerts that other producers have logged on the run's date; replays append their own."""
    rows = lines.read_alert_logs(lake.spark, lake.root).where(F.col("ingest_date") == lake.ingest_date)
    own = ~F.col("source").eqNullSafe(events.EVENT_SOURCE)
    return writes.write_or_merge(rows.where(own).select(*ALERT.names), lake.path("silver", "ids_alerts"), None, ["ingest_date"])


def check_replays(lake: Lake, summary: DataFrame) -> None:
    """Stop the run if any replay has failed; everything is stored by then."""
    events.assert_replayed(summary).collect()  # one row


def record_replays(
    lake: Lake,
    attempts: DataFrame,
    hour: str,
    event_types: list[str] | None = None,
    binary: str = "suricata",
    topic_path: str | None = None,
) -> DataFrame:
    """Store what a batch of replays produced: events, alerts, run rows, messages; returns the summary.

    ``attempts`` are candidates with their run id, status, error, times and event log path, as a stored
    table: run ids must not be made anew on each read. The event log is read once into ``suricata_events``;
    everything later is derived from the stored rows of these runs.
    """
    wanted = event_types or events.DEFAULT_EVENT_TYPES
    spark, events_path = lake.spark, lake.path("silver", "suricata_events")
    succeeded = attempts.where(F.col("status") == events.SUCCEEDED)
    raw = lines.read_eve(spark, lake.path("unstructured/pcap_replay/source=ctu13"), wanted, lake.ingest_date)
    raw = raw.join(succeeded.select(F.col("sha256").alias("artifact_sha256")).distinct(), "artifact_sha256", "left_semi")
    rows = events.normalize_events(events.stamp_artifact(raw, succeeded), lake.ingest_date)
    writes.append(rows, events_path, ["ingest_date"])

    # With the declared columns: replays that found nothing leave a table without files.
    log = spark.read.schema(EVENT).parquet(events_path).where(F.col("ingest_date") == lake.ingest_date)
    stored = log.join(attempts.select("replay_run_id"), "replay_run_id", "left_semi")
    alert_rows = events.alerts(stored)
    writes.write_json_log(
        alert_rows.withColumn("hour", F.lit(hour)), lake.path("stream/ids_alerts/source=suricata"), ["ingest_date", "hour"]
    )
    writes.append(alert_rows, lake.path("silver", "ids_alerts"), ["ingest_date"])
    runs = events.run_rows(attempts, stored, wanted, lake.ingest_date, binary)
    writes.write_or_merge(runs, lake.path("silver", "pcap_replay_runs"), ["replay_run_id"], ["ingest_date"])
    runs = lake.table("silver", "pcap_replay_runs", lake.ingest_date).join(attempts.select("replay_run_id"), "replay_run_id", "left_semi")
    entries = runs.select(writes.sorted_json(runs).alias("line"), "ingest_date")
    writes.append_manifest(entries, lake.root, events.REPLAY_SOURCE_ID)
    if topic_path:
        writes.publish(stored, events.EVENTS_TOPIC, path=topic_path)
        writes.publish(alert_rows, events.ALERTS_TOPIC, path=topic_path)
    return events.replay_summary(runs)


# -- silver → trusted -------------------------------------------------------------------------------


def clean_feed(lake: Lake, feed: str, run_id: str) -> None:
    """Clean one silver feed table into the trusted zone, its rejects beside it, one lineage row."""
    job = lineage.Job(lake.spark, run_id, "trusted_zone", feed, "clean_feed")
    rows = lake.table("silver", feed)
    if feed == "nvd":
        metrics = F.concat(F.lit('{"metrics":'), F.coalesce("metrics_json", F.lit("null")), F.lit("}"))
        rows = trusted.flatten_cvss(rows.withColumn("cve", F.try_parse_json(metrics))).drop("cve", "metrics_json")
    if feed == "circl_vulnlookup":
        rows = trusted.circl_profile(rows)
    if feed == "kev":
        rows = rows.withColumnRenamed("cveID", "cve_id")
    split = trusted.clean(rows, feed)
    job.told(read=split.read, rejected=split.refused)
    target = lake.path("trusted", feed)
    writes.write_snapshot(job.count("written", split.clean), target)
    writes.write_snapshot(split.rejected, lake.path("trusted", "rejected", feed))
    job.finish([lake.path("silver", feed)], target, lake.path("exploitation", "lineage"))


def clean_events(lake: Lake, run_id: str) -> None:
    """Clean the run date's events and alerts into the same date of the trusted tables.

    A replay run lies in one date, so repeats do too: only that partition is read, and replaced.
    """
    for name in ("suricata_events", "ids_alerts"):
        job = lineage.Job(lake.spark, run_id, "trusted_zone", name, "clean_events")
        rows = lake.table("silver", name, lake.ingest_date)
        split = trusted.check_events(rows)
        job.told(read=split.read, rejected=split.refused)
        good = trusted.dedup_events(split.clean) if name == "suricata_events" else split.clean
        target = lake.path("trusted", name)
        _replace_date(lake, job.count("written", good), target)
        _replace_date(lake, split.rejected, lake.path("trusted", "rejected", name))
        job.finish([lake.path("silver", name)], target, lake.path("exploitation", "lineage"))


def _replace_date(lake: Lake, df: DataFrame, path: str) -> None:
    writes.replace_partition(df, path, "ingest_date", lake.ingest_date)


def clean_warm(lake: Lake, state_path: str, run_id: str) -> None:
    """Clean the streamed window counts into the trusted zone."""
    job = lineage.Job(lake.spark, run_id, "trusted_zone", "warm_aggregates", "clean_warm")
    key = ["window_start", "signature"]
    split = trusted.clean_warm_aggregates(streams.total_counts(lake.spark, state_path, key), key, ["alerts"], key)
    job.told(read=split.read, rejected=split.refused)
    target = lake.path("trusted", "warm_aggregates")
    writes.write_snapshot(job.count("written", split.clean), target)
    writes.write_snapshot(split.rejected, lake.path("trusted", "rejected", "warm_aggregates"))
    job.finish([state_path], target, lake.path("exploitation", "lineage"))


def _landed_captures(lake: Lake) -> DataFrame:
    found = files.read_artifacts(lake.spark, lake.path("unstructured/pcap"), "*.pcap*")
    found = found.where(~F.col("path").endswith(files.SIDECAR_SUFFIX))
    return found.withColumn("relative_landing_path", files.relative_path(F.col("path"), lake.root))


def check_captures(lake: Lake) -> DataFrame:
    """The capture catalog with ``integrity_fail``, hashes recomputed from the landed files."""
    checked = catalog.integrity(lake.table("silver", "pcap_artifacts"), _landed_captures(lake))
    writes.write_snapshot(checked, lake.path("trusted", "pcap_artifacts"))
    return checked


# -- trusted → exploitation -------------------------------------------------------------------------


def _empty(lake: Lake, schema: str) -> DataFrame:
    return lake.spark.createDataFrame([], schema)


def build_vuln_enriched(lake: Lake) -> DataFrame:
    def feed(name, columns):
        return lake.table("trusted", name) if lake.has("trusted", name) else _empty(lake, columns)

    kev = feed("kev", "cve_id string, date_added date, due_date date, vulnerability_name string")
    nvd = feed(
        "nvd",
        "cve_id string, cvss_v3_score double, cvss_v3_vector string, cvss_v3_severity string, description_en string, "
        "published string",
    )
    epss = feed("epss", "cve string, epss double, percentile double, date string").withColumnRenamed("cve", "cve_id")
    circl = feed("circl_vulnlookup", "cve_id string, cwe_ids array<string>, reference_count bigint")
    return exploitation.vuln_enriched(kev, nvd, epss, circl)


def build_network_events(lake: Lake) -> DataFrame:
    parts = [
        lake.table("trusted", name, lake.ingest_date).drop("event_ts", "_ts_malformed")
        for name in ("suricata_events", "ids_alerts")
    ]
    return exploitation.network_events(*parts)


def build_correlations(lake: Lake) -> DataFrame:
    iocs = exploitation.indicators(lake.table("trusted", "threatfox"), lake.table("trusted", "urlhaus"))
    log = lake.table("exploitation", "network_events", lake.ingest_date)
    keyed = log.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return exploitation.ioc_correlations(keyed, iocs, ["_file", "_row"]).drop("_file", "_row")


def build_flow_features(lake: Lake) -> DataFrame:
    log = lake.table("exploitation", "network_events").where(F.col("origin") == "suricata_events")
    return anomaly.feature_matrix(exploitation.flow_features(log))


def build_anomalies(lake: Lake) -> DataFrame:
    """Train on the stored features of all flows, store the model by date, flag the anomalous flows."""
    matrix = lake.table("exploitation", "flow_features")
    path = anomaly.save_model(anomaly.train(matrix), lake.path("models", "ids_anomaly_detector"), lake.ingest_date)
    return anomaly.anomalies(anomaly.score(matrix, lake.spark.read.parquet(path)))


def build_daily_counts(lake: Lake) -> DataFrame:
    log = lake.table("exploitation", "network_events")
    timed = log.withColumn("ts", F.coalesce(F.col("timestamp_utc").try_cast("timestamp"), F.lit(S.SENTINEL_TIMESTAMP).cast("timestamp")))
    return exploitation.daily_alert_counts(timed)


# In building order. ``daily`` tables grow by date and replace the run's date; the others are recomputed.
GOLD: dict[str, tuple[Callable[[Lake], DataFrame], str]] = {
    "vuln_enriched": (build_vuln_enriched, "full"),
    "network_events": (build_network_events, "daily"),
    "ioc_correlations": (build_correlations, "daily"),
    "flow_features": (build_flow_features, "full"),
    "anomaly_flags": (build_anomalies, "full"),
    "kpi/kpi_vuln_priority_top50": (
        lambda lake: exploitation.top_priority(lake.table("exploitation", "vuln_enriched")),
        "full",
    ),
    "kpi/kpi_daily_alert_counts": (build_daily_counts, "full"),
    "kpi/kpi_kev_rolling7d": (
        lambda lake: exploitation.kev_rolling(lake.table("trusted", "kev"), F.lit(lake.ingest_date).cast("date")),
        "full",
    ),
}


def build_gold(lake: Lake, name: str, run_id: str) -> int:
    """Build one exploitation table and move readers to it; idempotent; appends one lineage row."""
    build, mode = GOLD[name]
    job = lineage.Job(lake.spark, run_id, "exploitation_zone", name, f"build {name}")
    target = lake.path("exploitation", name)
    rows = job.count("written", build(lake))
    if mode == "daily":
        _replace_date(lake, rows, target)
    else:
        writes.write_snapshot(rows, target)
    job.finish([lake.path("trusted")], target, lake.path("exploitation", "lineage"))
    return job.rows("written")


# -- streams ----------------------------------------------------------------------------------------

# Columns that tell a repeat of an event inside one replay run.
EVENT_IDENTITY = ["replay_run_id", "flow_id", "timestamp_utc", "event_type"]


def alert_stream(lake: Lake, servers: str | None = None) -> DataFrame:
    """Alerts of all producers: the Kafka topic where servers are named, else the landed alert logs of both layouts."""
    if servers:
        return streams.read_topic(lake.spark, servers, events.ALERTS_TOPIC)
    return streams.read_files(lake.spark, lake.path("stream", "ids_alerts"), ALERT)


def event_stream(lake: Lake, servers: str | None = None) -> DataFrame:
    """Normalized events: the Kafka topic where servers are named, else the stored event table as it grows."""
    if servers:
        return streams.read_topic(lake.spark, servers, events.EVENTS_TOPIC, EVENT)
    return streams.read_files(lake.spark, lake.path("silver", "suricata_events"), EVENT, "parquet")


def _enrich(lake: Lake, servers: str | None, **run) -> StreamingQuery:
    vulns = lake.table("exploitation", "vuln_enriched")
    return streams.append_to(streams.warm_enrichment(alert_stream(lake, servers), vulns), **run)


def _count(lake: Lake, servers: str | None, **run) -> StreamingQuery:
    timed = streams.with_event_time(alert_stream(lake, servers), "timestamp_utc")
    return streams.counts_to(timed, "1 minute", ["signature"], **run)


def _forward(lake: Lake, servers: str | None, **run) -> StreamingQuery:
    return streams.append_to(streams.pass_through(event_stream(lake, servers), events.EVENTS_TOPIC), **run)


def _once(lake: Lake, servers: str | None, **run) -> StreamingQuery:
    return streams.first_to(event_stream(lake, servers), EVENT_IDENTITY, **run)


# Name of each stream, how it is started, and where it writes.
STREAMS: dict[str, tuple[Callable[..., StreamingQuery], str]] = {
    "warm_enriched": (_enrich, "exploitation/warm_enriched"),
    "stream_aggregates": (_count, "warm/stream_aggregates"),
    "hot_events": (_forward, "hot/suricata_events"),
    "events_once": (_once, "warm/suricata_events"),
}


def start_stream(lake: Lake, name: str, servers: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start one stream of the lake; its checkpoint lies in the lake, so a restart goes on where it stopped.

    ``available_now`` works off what has arrived and ends, for schedules; otherwise a micro-batch runs every 10 seconds.
    """
    start, target = STREAMS[name]
    return start(lake, servers, path=lake.path(target), checkpoint=lake.path("checkpoints", name), available_now=available_now)
