import bz2
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threatloom.operators import enrichment, lineage, trusted
from threatloom.sources import feeds, files, lines


def test_kev(spark, lake_dir):
    record = {"cveID": "CVE-1", "vulnerabilityName": "n", "dateAdded": "2026-03-01", "cwes": ["CWE-1"], "new": {"x": 1}}
    path = lake_dir.put("k/kev_latest.json", json.dumps({"vulnerabilities": [record]}, indent=1))
    got = feeds.read_kev(spark, path).first()
    assert (got["cveID"], got["dateAdded"], got["cwes"], got["notes"]) == ("CVE-1", "2026-03-01", ["CWE-1"], None)
    assert json.loads(got["raw_json"]) == record
    assert feeds.read_kev(spark, lake_dir.put("k/none.json", "{}")).count() == 0


def test_broken_page_stops_the_job(spark, lake_dir):
    for body in ("[1]", "{broken", "text"):
        with pytest.raises(Exception, match="not a JSON object"):
            feeds.read_kev(spark, lake_dir.put(f"b{len(body)}/x.json", body)).count()


def test_nvd(spark, lake_dir):
    def cve(name, **rest):
        return {"cve": {"id": name, "published": "p", "lastModified": "m", "vulnStatus": "s", **rest}}

    two = [{"lang": "es", "value": "hola"}, {"lang": "en", "value": "first"}, {"lang": "en", "value": "second"}]
    data = {"baseScore": 9.8, "vectorString": "AV:N", "baseSeverity": "CRITICAL"}
    page = {
        "totalResults": 3,
        "vulnerabilities": [
            cve("CVE-1", descriptions=two, metrics={"cvssMetricV31": [{"cvssData": data}, {"cvssData": {}}]}),
            cve("CVE-2", descriptions=two[:1], metrics={"cvssMetricV31": []}),
            cve("CVE-3"),
        ],
    }
    lake_dir.put("n/nvd_cves_page=000.json", json.dumps(page))
    lake_dir.put("n/nvd_cves_page=001.json", json.dumps({"vulnerabilities": []}))
    df = trusted.flatten_cvss(feeds.read_nvd(spark, f"{lake_dir.root}/n"))
    assert rows(df, "cve_id", "last_modified", "description_en", "cvss_v3_score", "cvss_v3_severity", "page") == [
        ("CVE-1", "m", "first", 9.8, "CRITICAL", 0),
        ("CVE-2", "m", None, None, None, 0),
        ("CVE-3", "m", None, None, None, 0),
    ]


def test_epss_pages_scores_and_ties(spark, lake_dir):
    def page(n, data):
        lake_dir.put(f"e/epss_page={n:03d}.json", json.dumps({"total": 9, "data": data}))

    page(0, [{"cve": "CVE-A", "epss": "0.5"}, {"cve": "CVE-B", "epss": "abc"}, {"cve": "cve-x", "epss": "1"}, 7])
    page(1, [{"cve": "CVE-C", "epss": "0.975"}, {"cve": "CVE-D", "epss": 0.5}, {"cve": 5, "epss": "1"}])
    page(2, [{"cve": "CVE-A", "epss": "0.4"}, {"cve": "CVE-E", "epss": None}])
    page(3, {"not": "a list"})
    df = feeds.read_epss(spark, f"{lake_dir.root}/e")
    top = [(r["cve"], r["score"]) for r in enrichment.top_cves(df, 10).collect()]
    assert top == [("CVE-C", 0.975), ("CVE-A", 0.5), ("CVE-D", 0.5), ("CVE-B", 0.0), ("CVE-E", 0.0)]
    assert [r["cve"] for r in enrichment.top_cves(df, 2).collect()] == ["CVE-C", "CVE-A"]


URLHAUS = """# comment
# id,wrong,header
# id,dateadded,url,url_status
"1","2026-03-12 08:00:00","http://198.51.100.7/a""b","online"

  "2","2026-03-12 08:01:00","http://bad host/",""
"""


def test_commented_csv(spark, lake_dir):
    path = lake_dir.put("u/urlhaus_recent.csv", URLHAUS)
    df = trusted.warn_bad_url(feeds.read_commented_csv(spark, path))
    assert rows(df, "id", "url", "url_status", "_quality_warn") == [
        ("1", 'http://198.51.100.7/a"b', "online", False),
        ("2", "http://bad host/", "", True),
    ]
    assert feeds.csv_row_count(spark, path).first()["record_count"] == 2
    none = feeds.read_commented_csv(spark, lake_dir.put("u2/x.csv", '# no header\n"1","2"\n'))
    assert none.count() == 0


def test_commented_csv_of_many_formats(spark, lake_dir):
    for i in range(120):
        lake_dir.put(f"m/{i}.csv", f'# id, extra{i},url,url\n"{i}","x, ""{i}""",u{i},second,beyond\n')
    lake_dir.put("m/short.csv", "# id,url,note\n# id,note,url\n900,n\n")
    df = feeds.read_commented_csv(spark, f"{lake_dir.root}/m")
    assert df.columns[0] == "id" and len(df.columns) == 120 + 3 + 2
    found = {r["id"]: r for r in df.collect()}
    assert len(found) == 121
    assert all(found[str(i)]["url"] == f"u{i}" and found[str(i)][f"extra{i}"] == f'x, "{i}"' for i in range(120))
    assert found["900"]["note"] == "n" and found["900"]["url"] is None and found["900"]["extra3"] is None


def test_uris_of_s3_connectors_are_known_to_arrow():
    assert [files._uri(f"{s}://b/a b.pcap") for s in ("s3a", "s3n", "s3", "file")] == ["s3://b/a b.pcap"] * 3 + ["file://b/a b.pcap"]


def test_threatfox(spark, lake_dir):
    data = [
        {"id": 1, "ioc_type": " ip:port ", "tags": ["b", "a"]},
        {"id": 2, "ioc_type": None, "tags": None},
        {"id": 3, "ioc_type": ""},
        {"id": 4},
        "text",
    ]
    path = lake_dir.put("t/threatfox_iocs.json", json.dumps({"query_status": "ok", "data": data}))
    items = feeds.read_threatfox(spark, path)
    assert enrichment.type_breakdown(items).first().asDict() == {
        "ioc_type_breakdown": '{"None":1,"ip:port":1,"unknown":2}',
        "ioc_count": 5,
    }
    assert rows(feeds.threatfox_records(items), "id", "tags") == [("1", '["b","a"]'), ("2", None), ("3", None), ("4", None)]
    for n, data in enumerate(["none", {"a": 1}, None, []]):
        text = lake_dir.put(f"t2/{n}/x.json", json.dumps({"query_status": "no_result", "data": data}))
        empty = enrichment.type_breakdown(feeds.read_threatfox(spark, text)).first()
        assert (empty["ioc_type_breakdown"], empty["ioc_count"]) == ("{}", 0)
    refused = lake_dir.put("t3/x.json", json.dumps({"query_status": "Unauthorized", "data": [1]}))
    with pytest.raises(Exception, match="refused"):
        feeds.read_threatfox(spark, refused).count()


def test_enrichment_lines(spark, lake_dir):
    body = '{"cve_id":"CVE-1","source_id":"s","payload":{"b":1,"a":[2]}}\nbroken\n[1]\n\n'
    df = feeds.read_enrichment(spark, lake_dir.put("c/x.jsonl", body), "cve_id")
    assert rows(df.select("cve_id", "source_id", F.to_json("payload"))) == [("CVE-1", "s", '{"a":[2],"b":1}')]


def test_manifest_scan(spark, lake_dir):
    lake_dir.put("metadata/manifests/ingest_date=2026-03-11/src.jsonl", '{"n":1}\n\n{bad\n[1]\n  {"n":2}  \n')
    lake_dir.put("metadata/manifests/ingest_date=2026-03-12/src.jsonl", '{"n":3}\n')
    lake_dir.put("metadata/manifests/ingest_date=2026-03-12/other.jsonl", '{"n":9}\n')
    number = F.try_variant_get("entry", "$.n", "int").alias("n")
    all_dates = lines.read_manifest(spark, lake_dir.root, "src").orderBy("seq").select(number, "manifest_date")
    assert [tuple(r) for r in all_dates.collect()] == [(1, "2026-03-11"), (2, "2026-03-11"), (3, "2026-03-12")]
    assert rows(lines.read_manifest(spark, lake_dir.root, "src", "2026-03-12").select(number)) == [(3,)]


def test_eve_scan_prunes_dates_and_reads_bz2(spark, lake_dir):
    good = b'{"event_type":"alert","x":"\xff"}\n\n{bad\n[1]\n{"event_type":"stats"}\n{"event_type":"dns"}\n'
    base = "eve/scenario=42/artifact_sha256=0012"
    lake_dir.put(f"{base}/ingest_date=2026-03-12/eve.jsonl", good)
    lake_dir.put(f"{base}/ingest_date=2026-03-13/eve.jsonl.bz2", bz2.compress(good))
    root = f"{lake_dir.root}/eve"
    df = lines.read_eve(spark, root, ["alert", "dns"])
    assert rows(df.groupBy("artifact_sha256", "ingest_date").count()) == [("0012", "2026-03-12", 2), ("0012", "2026-03-13", 2)]
    text = df.where("ingest_date = '2026-03-12'").select(F.try_variant_get("event", "$.x", "string").alias("x"))
    assert ("�",) in rows(text)
    plan = lines.read_eve(spark, root, ["alert"], "2026-03-13")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert lines.event_type_list(" alert, ,dns ", ["x"]) == ["alert", "dns"]
    assert lines.event_type_list(" , ", ["x"]) == ["x"]


def test_artifacts_hash_on_one_path_whatever_their_size(spark, lake_dir):
    path = "pcap/source=ctu13/scenario=42/ingest_date=2026-03-12/{}"
    bodies = {"a.pcap": b"abc" * 341, "b.pcap": b"0123456" * 10_500_000}
    for name, body in bodies.items():
        lake_dir.put(path.format(name), body)
    df = files.read_artifacts(spark, f"{lake_dir.root}/pcap", "*.pcap")
    assert rows(df, "artifact_name", "size_bytes", "sha256", "scenario", "ingest_date") == [
        (n, len(b), hashlib.sha256(b).hexdigest(), "42", "2026-03-12") for n, b in bodies.items()
    ]
    counted = lineage.ingest_metrics(df, spark.createDataFrame([("nowhere",)], "file_path string"))
    assert rows(counted, "record_count") == [(0,)] * 2
    assert "FileScan binaryFile" in df._jdf.queryExecution().toString()


def test_alert_layouts(spark, lake_dir):
    alert = json.dumps({"timestamp_utc": "t", "src_ip": "1.1.1.1", "severity": 2, "source": "{}"})
    lake_dir.put("stream/ids_alerts/ingest_date=2026-03-12/hour=01/a.jsonl", alert.replace("{}", "synthetic"))
    lake_dir.put("stream/ids_alerts/source=suricata/ingest_date=2026-03-12/hour=02/a.jsonl", alert.replace("{}", "suricata"))
    df = lines.read_alert_logs(spark, lake_dir.root)
    assert rows(df, "source", "ingest_date", "hour", "severity") == [
        ("suricata", "2026-03-12", "02", 2),
        ("synthetic", "2026-03-12", "01", 2),
    ]


def test_nothing_landed_yet(spark, lake_dir):
    root = lake_dir.root
    assert lines.read_manifest(spark, root, "src").count() == 0
    assert lines.read_eve(spark, f"{root}/eve", ["alert"], "2026-03-12").count() == 0
    assert lines.read_alert_logs(spark, root).count() == 0


CONFIG = {
    "scenario_pattern": r"^Set-(\d+)/$",
    "scenario_range": {"start": 42, "end": 54},
    "profiles": {
        "subset": {
            "mode": "first_successful",
            "selection_rules": [
                {"label": "night", "pattern": r"^night-run-.*\.pcap$"},
                {"label": "generic", "pattern": r"^.*\.pcap$"},
            ],
        },
        "full": {"mode": "all", "selection_rules": [{"label": "head", "pattern": r"^.*\.head\.pcap\.bz2$"}]},
    },
}


def test_selection_rules(spark, lake_dir):
    df = files.read_selection_rules(spark, lake_dir.put("cfg/rules.json", json.dumps(CONFIG, indent=2)))
    assert rows(df, "profile", "mode", "rule_index", "label", "scenario_start", "scenario_end") == [
        ("full", "all", 0, "head", 42, 54),
        ("subset", "first_successful", 0, "night", 42, 54),
        ("subset", "first_successful", 1, "generic", 42, 54),
    ]
    assert [label for label, _ in files.profile_rules(df, "subset")] == ["night", "generic"]
    with pytest.raises(ValueError, match="unknown profile"):
        files.profile_rules(df, "nope")
