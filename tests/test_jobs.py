"""The jobs end to end over a small landing zone, and the streaming and anomaly operators."""

import hashlib
import json
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tests.test_operators import ALERT, FLOW
from tests.test_sources import CONFIG, URLHAUS
from threatloom.operators import anomaly, catalog, exploitation, writes
from threatloom.operators.events import SUCCEEDED
from threatloom.plans import jobs
from threatloom.schemas import ALERT as ALERT_SCHEMA
from threatloom.schemas import EVENT as EVENT_SCHEMA
from threatloom.sources import files
from threatloom.streaming import alerts as streams

DATE = "2026-03-12"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def lake(spark, lake_dir):
    kev = [
        {"cveID": "CVE-2021-0001", "vulnerabilityName": "one", "dateAdded": "2026-03-10", "dueDate": "2026-04-01"},
        {"cveID": "CVE-2021-0009", "dateAdded": "2026-03-10"},
    ]
    data = {"baseScore": 8.0, "vectorString": "AV:N", "baseSeverity": "HIGH"}
    nvd = [{"cve": {"id": "CVE-2021-0001", "metrics": {"cvssMetricV31": [{"cvssData": data}]}}}, {"cve": {"id": "CVE-2021-0002"}}]
    epss = [{"cve": "CVE-2021-0001", "epss": "0.5", "percentile": "0.9", "date": "2026-03-11"}]
    later = [{"cve": "CVE-2021-0001", "epss": "0.9", "percentile": "0.9", "date": "2026-03-12"}]
    fox = [{"id": "1", "ioc": "172.16.4.9:80", "ioc_type": "ip:port", "malware": "m", "malware_printable": "Mal"}]
    put = lake_dir.put
    put(f"structured/kev/ingest_date={DATE}/kev_latest.json", json.dumps({"vulnerabilities": kev}))
    put(f"semi_structured/nvd/ingest_date={DATE}/nvd_cves_page=000.json", json.dumps({"vulnerabilities": nvd}))
    put(f"structured/epss/ingest_date={DATE}/epss_page=000.json", json.dumps({"data": epss}))
    put(f"structured/epss/ingest_date={DATE}/epss_page=001.json", json.dumps({"data": later}))
    put(f"semi_structured/urlhaus/ingest_date={DATE}/urlhaus_recent.csv", URLHAUS)
    put(f"semi_structured/threatfox/ingest_date={DATE}/threatfox_iocs.json", json.dumps({"query_status": "ok", "data": fox}))
    answer = {"cve_id": "CVE-2021-0001", "source_id": "c", "request_url": "u", "retrieved_at_utc": "t", "payload": {"cwe": "CWE-1", "references": [1]}}
    put(f"semi_structured/circl_vulnlookup/ingest_date={DATE}/circl_cve_details.jsonl", json.dumps(answer) + "\n")
    host = {"ip": "172.16.4.9", "source_id": "s", "retrieved_at_utc": "t", "payload": {"ports": [80]}}
    put(f"semi_structured/shodan_seeded/ingest_date={DATE}/shodan_hosts.jsonl", json.dumps(host) + "\n")
    return jobs.Lake(spark, lake_dir.root, DATE, "2026-03-12T08:15:00+00:00")


FEEDS = {"kev": 2, "nvd": 2, "epss": 2, "urlhaus": 2, "threatfox": 1, "circl_vulnlookup": 1, "shodan_seeded": 1}


def test_whole_lake(spark, lake, lake_dir):
    for feed, size in FEEDS.items():
        assert jobs.load_feed(lake, feed) == size
        assert jobs.load_feed(lake, feed) == size  # a rerun merges onto itself
        assert lake.table("silver", feed).count() == size
    assert rows(lake.table("silver", "shodan_seeded"), "ip_str", "payload") == [("172.16.4.9", '{"ports":[80]}')]
    metrics = rows(jobs.feed_metrics(lake, "epss"), "artifact_name", "record_count", "ingest_date", "url")
    assert metrics == [("epss_page=000.json", 1, DATE, None), ("epss_page=001.json", 1, DATE, None)]
    assert [r["cve"] for r in jobs.lookup_candidates(lake).collect()] == ["CVE-2021-0001"]
    assert [r["ip"] for r in jobs.seed_addresses(lake, ["::1", "172.16.4.9"]).collect()] == ["172.16.4.9", "::1"]

    # A capture, its manifest, and the event log a replay left behind.
    relative = f"unstructured/pcap/source=ctu13/scenario=42/ingest_date={DATE}/a.pcap"
    lake_dir.put(relative, b"capture")
    entry = {"artifact_name": "a.pcap", "relative_landing_path": relative, "landing_path": relative, "scenario_number": 42,
             "sha256": "5f1c6b5f0a8f8e0e"}
    lake_dir.put(f"metadata/manifests/ingest_date={DATE}/{jobs.ARTIFACT_MANIFEST}.jsonl", json.dumps(entry) + "\n")
    built, size = jobs.catalog_captures(lake)
    assert rows(files.read_in_order(spark, jobs.list_captures(lake)), "position", "artifact_name") == [(0, "a.pcap")]
    assert size == 1 and rows(jobs.check_captures(lake), "integrity_fail") == [(True,)]
    flow = {**FLOW, "timestamp": "soon", "flow_id": 7}
    log = [ALERT, ALERT, flow, {"event_type": "flow", "timestamp": "t"}]
    log = [*[{**e, "src_ip": "172.16.4.9"} for e in log[:3]], log[3]]  # the indicator that was landed; the last has no source
    log[0] = {**log[0], "alert": {**ALERT["alert"], "signature": "ET CVE-2021-0001"}}
    log[1] = log[0]
    eve = f"unstructured/pcap_replay/source=ctu13/scenario=42/artifact_sha256={entry['sha256']}/ingest_date={DATE}/eve.jsonl"
    lake_dir.put(eve, "\n".join(json.dumps(e) for e in log))
    attempts = catalog.replay_candidates(built, 5, False).withColumns(
        {
            "replay_run_id": F.lit("run-1"), "status": F.lit(SUCCEEDED), "error": F.lit(None).cast("string"),
            "started_at": F.lit("2026-03-12 08:00:00").cast("timestamp"), "completed_at": F.lit("2026-03-12 08:00:01.5").cast("timestamp"),
            "eve_landing_path": F.lit(eve),
        }
    )
    summary = jobs.record_replays(lake, attempts, "08", topic_path=lake.path("topics")).first()
    assert (summary["successful_replays"], summary["normalized_events"], summary["alert_events"]) == (1, 4, 2)
    run = lake.table("silver", "pcap_replay_runs").first()
    assert (run["event_counts_json"], run["duration_seconds"]) == ('{"alert":2,"flow":2}', 1.5)
    assert spark.read.json(lake.path("topics")).groupBy("topic").count().count() == 2
    assert lake.table("silver", "ids_alerts").count() == 2

    for feed in FEEDS:
        if feed != "shodan_seeded":
            jobs.clean_feed(lake, feed, "r1")
    jobs.clean_events(lake, "r1")
    assert rows(lake.table("trusted", "rejected/kev"), "cve_id") == [("CVE-2021-0009",)]
    assert lake.table("trusted", "suricata_events").count() == 2  # the repeated alert is gone, one row is rejected
    assert lake.table("trusted", "rejected/suricata_events").count() == 1

    assert jobs.build_gold(lake, "vuln_enriched", "r1") == 2
    assert jobs.build_gold(lake, "vuln_enriched", "r2") == 2
    top = lake.table("exploitation", "vuln_enriched").where("cve_id = 'CVE-2021-0001'").first()
    assert top["vuln_priority_score"] == 0.9 * 1.5 * 8.0 / 10 and top["cwe_ids"] == ["CWE-1"]
    assert jobs.build_gold(lake, "network_events", "r1") == 4
    assert jobs.build_gold(lake, "ioc_correlations", "r1") == 4
    assert jobs.build_gold(lake, "flow_features", "r1") == 2
    jobs.build_gold(lake, "anomaly_flags", "r1")
    for kpi in ("kpi/kpi_vuln_priority_top50", "kpi/kpi_daily_alert_counts", "kpi/kpi_kev_rolling7d"):
        jobs.build_gold(lake, kpi, "r1")
    assert rows(lake.table("exploitation", "kpi/kpi_kev_rolling7d")) == [(1,)]
    assert rows(lake.table("exploitation", "kpi/kpi_daily_alert_counts"), "signature", "alerts") == [("ET CVE-2021-0001", 2)]
    lineage = spark.read.parquet(lake.path("exploitation", "lineage"))
    assert rows(lineage.where("task_id = 'kev'"), "rows_read", "rows_written", "rows_rejected") == [(2, 1, 1)]
    assert lineage.where("task_id = 'vuln_enriched'").count() == 2


def test_plan_then_rerun(spark, lake, lake_dir):
    index = spark.createDataFrame([("https://h/sets/", '<a href="Set-42/">x</a>')], "page_url string, html string")
    listing = spark.createDataFrame(
        [("https://h/sets/Set-42/", '<a href="night-run-1.pcap">x</a><a href="a.pcap">x</a>')],
        "page_url string, html string",
    )
    rules = files.read_selection_rules(spark, lake_dir.put("cfg.json", json.dumps(CONFIG)))
    planned = jobs.plan_artifacts(lake, index, listing, rules, "subset").first()
    assert (planned["state"], planned["artifact_url"]) == ("to_land", "https://h/sets/Set-42/night-run-1.pcap")
    assert f"ingest_date={DATE}" in planned["relative_landing_path"]
    entry = json.dumps({"relative_landing_path": planned["relative_landing_path"]})
    lake_dir.put(f"metadata/manifests/ingest_date={DATE}/{jobs.ARTIFACT_MANIFEST}.jsonl", entry)
    assert jobs.plan_artifacts(lake, index, listing, rules, "subset").first()["state"] == "skipped"
    assert jobs.plan_artifacts(lake, index, listing, rules, "subset", force=True).first()["state"] == "to_land"


def test_replays_are_guarded_and_listed(spark, lake, lake_dir):
    relative = f"unstructured/pcap/source=ctu13/scenario=42/ingest_date={DATE}/{{}}.pcap"
    entries = []
    for name, body, told in (("a", b"good", hashlib.sha256(b"good").hexdigest()), ("b", b"changed", "00")):
        lake_dir.put(relative.format(name), body)
        entries.append({"artifact_name": f"{name}.pcap", "relative_landing_path": relative.format(name), "scenario_number": 42, "sha256": told})
    manifest = f"metadata/manifests/ingest_date={DATE}/{jobs.ARTIFACT_MANIFEST}.jsonl"
    lake_dir.put(manifest, json.dumps(entries[0]))
    jobs.catalog_captures(lake)
    assert [r["artifact_name"] for r in jobs.plan_replays(lake, 5).collect()] == ["a.pcap"]
    lake_dir.put(manifest, "\n".join(map(json.dumps, entries)))
    jobs.catalog_captures(lake)
    with pytest.raises(Exception, match="Checksum mismatch"):
        jobs.plan_replays(lake, 5).collect()

    when = F.lit("2027-05-04 08:00:00").cast("timestamp")
    chosen = lake.table("silver", "pcap_artifacts").where("artifact_name = 'a.pcap'")
    status = F.explode(F.array(F.lit(SUCCEEDED), F.lit("failed"))).alias("status")
    attempts = chosen.select("*", status, F.lit("boom").alias("error"), when.alias("started_at"), when.alias("completed_at"), F.lit("eve").alias("eve_landing_path"))
    summary = jobs.record_replays(lake, attempts.withColumn("replay_run_id", F.concat(F.lit("run-"), "status")), "08")
    listed = jobs.current_manifest(lake, "ctu13_pcap_replay", DATE)
    assert sorted(json.loads(r["line"])["replay_run_id"] for r in listed.collect()) == ["run-failed", "run-succeeded"]
    with pytest.raises(Exception, match="1 replay"):
        jobs.check_replays(lake, summary)
    jobs.check_replays(lake, summary.withColumn("failed_replays", F.lit(0)))

    alert = {"timestamp_utc": "t", "src_ip": "1.1.1.1", "signature": "s", "severity": 1}
    for folder, source in (("", "synthetic"), ("source=suricata/", "suricata")):
        lake_dir.put(f"stream/ids_alerts/{folder}ingest_date={DATE}/hour=08/a.jsonl", json.dumps({**alert, "source": source}))
    assert jobs.load_alert_logs(lake) == 1
    assert rows(lake.table("silver", "ids_alerts", DATE), "source") == [("synthetic",)]


def test_manifest_grows_by_appending(spark, lake):
    def add(*pairs):
        entries = [(json.dumps({"relative_landing_path": p, "n": n}), DATE) for p, n in pairs]
        writes.append_manifest(spark.createDataFrame(entries, "line string, ingest_date string").coalesce(1), lake.root, "src")

    add(("a", 1), ("b", 2))
    add(("a", 3), ("c", 4))
    merged = jobs.current_manifest(lake, "src", DATE).orderBy("pos").select("line").collect()
    assert [json.loads(r["line"])["n"] for r in merged] == [3, 2, 4]


def test_lookup_report(spark, lake):
    wanted = spark.createDataFrame([("CVE-2021-0001",), ("CVE-2021-0002",)], "cve_id string")
    report = jobs.lookup_report(lake, wanted, "circl_vulnlookup", "https://l")
    assert rows(report, "cve_id", "found", "error") == [("CVE-2021-0001", True, None), ("CVE-2021-0002", False, "no response")]


def test_lookup_failures_have_their_cause(spark, lake, lake_dir):
    failed = [
        {"cve_id": "CVE-2021-0002", "request_url": "https://l/CVE-2021-0002", "status_code": 404, "error": "HTTP Error 404: Not Found"},
        {"cve_id": "CVE-2021-0003", "request_url": "u", "status_code": None, "error": "Invalid JSON response: x"},
        {"cve_id": "CVE-2021-0004", "request_url": "u", "status_code": None, "error": "HTTP Error 503: Busy"},
        {"cve_id": "CVE-2021-0001", "request_url": "u", "status_code": 500, "error": "first try"},
        {"request_url": "u"}, 7,
    ]
    lake_dir.put(f"semi_structured/circl_vulnlookup/ingest_date={DATE}/circl_cve_details.jsonl.meta.json", json.dumps({"failed_requests": failed}, indent=1))
    wanted = spark.createDataFrame([(f"CVE-2021-000{i}",) for i in range(1, 6)], "cve_id string")
    report = jobs.lookup_report(lake, wanted, "circl_vulnlookup", "https://l")
    assert rows(report, "cve_id", "found", "status_code", "error") == [
        ("CVE-2021-0001", True, None, None), ("CVE-2021-0002", False, 404, "HTTP Error 404: Not Found"),
        ("CVE-2021-0003", False, None, "Invalid JSON response: x"), ("CVE-2021-0004", False, 503, "HTTP Error 503: Busy"),
        ("CVE-2021-0005", False, None, "no response"),
    ]
    assert jobs.load_feed(lake, "circl_vulnlookup") == 1


def test_metrics_tell_what_the_sidecars_tell(spark, lake, lake_dir):
    page = f"structured/epss/ingest_date={DATE}/epss_page=000.json"
    sidecar = {"source_id": "epss", "source_url": "https://s", "request_url": "https://s?offset=0", "retrieved_at_utc": "t1", "relative_landing_path": page, "sha256": "other", "page_index": 0, "offset": 0, "results_per_page": 1, "total_results": 2, "record_count": 1}
    lake_dir.put(f"{page}.meta.json", json.dumps(sidecar))
    lake_dir.put(f"structured/epss/ingest_date={DATE}/epss_page=001.json.meta.json", json.dumps({"source_id": "epss", "source_url": "https://s", "page_index": 1}))
    got = rows(jobs.feed_metrics(lake, "epss"), "relative_landing_path", "source", "url", "retrieved_at_utc", "page_index", "total_results", "record_count", "recorded_differently")
    assert got == [
        (page, "epss", "https://s?offset=0", "t1", 0, 2, 1, True),
        (page.replace("000", "001"), "epss", "https://s", None, 1, None, 1, False),
    ]
    assert jobs.load_feed(lake, "epss") == 2  # a sidecar beside the pages is no page


def test_a_list_landed_as_csv_is_measured_but_not_counted(spark, lake_dir):
    lake = jobs.Lake(spark, lake_dir.root, DATE, "now")
    lake_dir.put(f"structured/kev/ingest_date={DATE}/kev_latest.csv", "cveID,vendorProject\nCVE-1,x\n")
    lake_dir.put(f"semi_structured/urlhaus/ingest_date={DATE}/urlhaus_recent.csv", URLHAUS)
    assert jobs.load_feed(lake, "kev") == 0
    assert rows(jobs.feed_metrics(lake, "kev"), "artifact_name", "record_count") == [("kev_latest.csv", None)]
    assert rows(jobs.feed_metrics(lake, "urlhaus"), "artifact_name", "record_count") == [("urlhaus_recent.csv", 2)]
    lake_dir.put(f"structured/kev/ingest_date={DATE}/kev_latest.json", '{"vulnerabilities": []}')
    assert rows(jobs.feed_metrics(lake, "kev"), "artifact_name", "record_count") == [("kev_latest.csv", None), ("kev_latest.json", 0)]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """From another folder, with the package known to the driver only."""
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from threatloom.plans.table_queries import QUERIES
from threatloom.session import build_session
shared = {str(tmp_path / "shared")!r}
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": shared}})
assert QUERIES["q_links"](spark, {SMALL!r}).count() > 0
assert QUERIES["q_anomaly"](spark, {SMALL!r}).count() > 0
"""
    (tmp_path / "shared").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, check=True, timeout=300, capture_output=True)
    written = {p.name.split("-")[0] for p in (tmp_path / "shared").iterdir()}
    assert {"features", "model"} <= written  # work files go to the folder the session names


def test_stream_restarts_without_doubling(spark, lake_dir, tmp_path):
    alert = {"timestamp_utc": "2027-05-04T09:30:02Z", "signature": "ET CVE-2021-0001", "src_ip": "a"}
    lake_dir.put("in/1.json", json.dumps(alert))
    vulns = spark.createDataFrame([("CVE-2021-0001", 0.5, "HIGH")], "cve_id string, vuln_priority_score double, cvss_v3_severity string")
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = streams.warm_enrichment(streams.read_files(spark, f"{lake_dir.root}/in", ALERT_SCHEMA), vulns)
        streams.append_to(stream, sink, checkpoint, available_now=True).awaitTermination()
        return rows(spark.read.parquet(sink), "src_ip", "vuln_priority_score")

    assert run() == [("a", 0.5)]
    lake_dir.put("in/2.json", json.dumps({**alert, "signature": "none", "src_ip": "b"}))
    assert run() == [("a", 0.5), ("b", None)]
    assert run() == [("a", 0.5), ("b", None)]


def test_stream_windows_over_restarts(spark, lake_dir, tmp_path):
    sink, checkpoint = str(tmp_path / "w"), str(tmp_path / "wc")

    def run():
        alerts = streams.with_event_time(streams.read_files(spark, f"{lake_dir.root}/in", ALERT_SCHEMA), "timestamp_utc")
        streams.counts_to(alerts, "1 minute", ["signature"], sink, checkpoint, available_now=True).awaitTermination()
        state = streams.total_counts(spark, sink, ["window_start", "signature"])
        return rows(state.select(F.date_format("window_start", "HH:mm"), "signature", "alerts"))

    line = json.dumps({"timestamp_utc": "2027-05-04T09:30:02Z", "signature": "s"})
    lake_dir.put("in/1.json", f"{line}\n{line}")
    assert run() == [("09:30", "s", 2)]
    lake_dir.put("in/2.json", f"{line}\n{line.replace(':30:', ':31:')}")
    assert run() == [("09:30", "s", 3), ("09:31", "s", 1)]
    assert run() == [("09:30", "s", 3), ("09:31", "s", 1)]
    lake_dir.put("in/3.json", line.replace(":30:", ":31:"))
    assert run() == [("09:30", "s", 3), ("09:31", "s", 2)]
    lake = jobs.Lake(spark, f"{lake_dir.root}/lake", DATE, "now")
    jobs.clean_warm(lake, sink, "r1")
    assert rows(lake.table("trusted", "warm_aggregates"), "alerts") == [(2,), (3,)]


def test_streams_keep_captures_in_any_order(spark, lake_dir, tmp_path):
    def line(day, n):
        return json.dumps({"timestamp_utc": f"2011-08-{day}T08:15:0{n}Z", "signature": "s", "replay_run_id": f"r{day}", "src_ip": str(n)})

    def run():
        alerts = streams.with_event_time(streams.read_files(spark, f"{lake_dir.root}/in", ALERT_SCHEMA), "timestamp_utc")
        for start, sink in ((streams.counts_to, "w"), (streams.first_to, "d")):
            args = ("1 day", []) if sink == "w" else (["replay_run_id", "src_ip", "timestamp_utc"],)
            start(alerts, *args, path=str(tmp_path / sink), checkpoint=str(tmp_path / f"{sink}c"), available_now=True).awaitTermination()
        counts = streams.total_counts(spark, str(tmp_path / "w"), ["window_start"])
        return rows(counts.select(F.date_format("window_start", "MM-dd"), "alerts")), spark.read.parquet(str(tmp_path / "d")).count()

    lake_dir.put("in/1.json", "\n".join([*(line(17, n) for n in range(5)), "{broken", "not json"]))
    assert run() == ([("08-17", 5)], 5)
    unreadable = json.dumps({"timestamp_utc": "never", "signature": "s", "replay_run_id": "x"})
    lake_dir.put("in/2.json", "\n".join([*(line(10, n) for n in range(7)), unreadable, line(17, 0)]))
    assert run() == ([("01-01", 1), ("08-10", 7), ("08-17", 6)], 13)


def test_stream_dedup_keeps_its_state_in_spark(spark, tmp_path):
    """Repeats in one micro-batch, in a later one and with null keys; a micro-batch reads only what has arrived."""
    schema = "k string, n int, own string"

    def run(*new):
        spark.createDataFrame(new, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.read_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "parquet")
        query = streams.first_to(stream, ["k", "n"], str(tmp_path / "out"), str(tmp_path / "c"), available_now=True)
        query.awaitTermination()
        return query.recentProgress, rows(spark.read.parquet(str(tmp_path / "out")), "k", "n")

    assert run(("a", 1, "x"), ("a", 1, "x"), (None, 2, "y"))[1] == [("a", 1), (None, 2)]
    progress, stored = run(("a", 1, "z"), (None, 2, "y"), ("b", None, "y"))
    assert stored == [("a", 1), ("b", None), (None, 2)]
    assert sum(p["numInputRows"] for p in progress) == 3
    state = [s for p in progress for s in p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in state) == 3
    assert any("rocksdb" in m.lower() for s in state for m in s["customMetrics"])


def test_the_lake_starts_its_streams(spark, lake, lake_dir):
    alert = {"timestamp_utc": "2027-05-04T09:30:02Z", "src_ip": "1.1.1.1", "signature": "ET CVE-2021-0001", "severity": 1}
    lake_dir.put(f"stream/ids_alerts/ingest_date={DATE}/hour=08/a.jsonl", json.dumps({**alert, "source": "synthetic"}))
    lake_dir.put(f"stream/ids_alerts/source=suricata/ingest_date={DATE}/hour=08/b.jsonl", json.dumps({**alert, "source": "suricata"}) + "\n{broken")
    stored = [{"replay_run_id": "r1", "flow_id": "1", "timestamp_utc": "t", "event_type": "flow", "src_ip": "2.2.2.2"}] * 2
    spark.createDataFrame([tuple(r.get(f.name) for f in EVENT_SCHEMA) for r in stored], EVENT_SCHEMA).withColumn("ingest_date", F.lit(DATE)).write.partitionBy("ingest_date").parquet(lake.path("silver", "suricata_events"))
    vulns = spark.createDataFrame([("CVE-2021-0001", 0.5, "HIGH")], "cve_id string, vuln_priority_score double, cvss_v3_severity string")
    writes.write_snapshot(vulns, lake.path("exploitation", "vuln_enriched"))
    for _ in range(2):  # a restart goes on from the checkpoint
        for name in jobs.STREAMS:
            jobs.start_stream(lake, name, available_now=True).awaitTermination()
    enriched = spark.read.parquet(lake.path("exploitation", "warm_enriched"))
    assert rows(enriched, "source", "cve_id", "vuln_priority_score", "ingest_date") == [
        ("suricata", "CVE-2021-0001", 0.5, DATE), ("synthetic", "CVE-2021-0001", 0.5, DATE),
    ]
    assert spark.read.parquet(lake.path("hot", "suricata_events")).count() == 2
    assert rows(spark.read.parquet(lake.path("warm", "suricata_events")), "src_ip", "ingest_date") == [("2.2.2.2", DATE)]
    jobs.clean_warm(lake, lake.path("warm", "stream_aggregates"), "r1")
    assert rows(lake.table("trusted", "warm_aggregates"), "signature", "alerts") == [("ET CVE-2021-0001", 2)]


def test_forest_scores_agree_with_walking_the_trees(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(100, 5, (400, 5)), [[9000.0, 9.0, 60000.0, 1.0, 5000.0]]])
    table = pd.DataFrame(points, columns=anomaly.FEATURES).assign(flow_id=[str(i) for i in range(401)])
    matrix = spark.createDataFrame(table)
    model = anomaly.train(matrix, trees=20, sample=64).cache()
    nodes = model.toPandas()
    assert nodes["tree_id"].nunique() == 20 and nodes["sample"].eq(64).all()
    assert rows(model) == rows(anomaly.train(matrix, trees=20, sample=64))

    def walk(tree, point):
        at = tree.loc[0]
        while at["feature"] >= 0:
            at = tree.loc[at["left"] if point[int(at["feature"])] <= at["threshold"] else at["right"]]
        return at["path"]

    trees = [t.set_index("node_id") for _, t in nodes.groupby("tree_id")]
    scored = anomaly.score(matrix, model).toPandas().set_index("flow_id")["anomaly_score"]
    for i in (0, 17, 400):
        mean = np.mean([walk(t, points[i]) for t in trees])
        assert scored[str(i)] == pytest.approx(2 ** (-mean / anomaly.average_path(64)))
    assert scored.idxmax() == "400" and scored["400"] > 0.7
    assert anomaly.anomalies(anomaly.score(matrix, model), 0.7).count() >= 1


def test_average_path_and_tiny_samples():
    assert anomaly.average_path(1) == 0.0 and anomaly.average_path(2) == 1.0
    assert anomaly.average_path(256) == pytest.approx(10.244770920, abs=1e-6)
    same = anomaly.grow_tree(np.ones((5, 5)), 0, 1)
    assert len(same) == 1 and same["feature"].iloc[0] == -1


def test_daily_counts_only_count_the_alert_side(spark):
    log = spark.createDataFrame(
        [("suricata_events", "s", 1), ("ids_alerts", "s", 1)], "origin string, signature string, severity int"
    ).withColumn("ts", F.lit("2026-03-12 00:00:00").cast("timestamp"))
    assert rows(exploitation.daily_alert_counts(log), "alerts") == [(1,)]


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for name in entry.queries() if name.startswith("q_")}
    assert own - set(entry.oracle_sql()) == {"q_anomaly", "q_artifact_files"}
    assert SMALL
