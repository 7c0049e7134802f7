"""Exploitation zone: joined, correlated, scored and counted tables for analysts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.functions import addresses as A
from threatloom.functions import scalars as S
from threatloom.operators.shaping import lookup, top_per_group

# Fixed value: the bonus of a confirmed exploit in the priority score.
EXPLOITED_BONUS = 1.5

KEV_COLUMNS = ["date_added", "due_date", "vulnerability_name"]
NVD_COLUMNS = ["cvss_v3_score", "cvss_v3_vector", "cvss_v3_severity", "description_en", "published"]
EPSS_COLUMNS = ["epss", "percentile", "date"]
CIRCL_COLUMNS = ["cwe_ids", "reference_count"]


def priority_score(epss: Column, kev_listed: Column, cvss: Column) -> Column:
    """Exploit probability × confirmed-exploit bonus × severity / 10; null when a factor is null."""
    return epss * F.when(kev_listed, EXPLOITED_BONUS).otherwise(1.0) * cvss / 10.0


def vuln_enriched(kev: DataFrame, nvd: DataFrame, epss: DataFrame, circl: DataFrame) -> DataFrame:
    """One wide row per CVE known to any of four feeds (column ``cve_id`` in each).

    The feeds are stacked with one struct column each and grouped once by CVE: a single shuffle gives the
    spine, the four left joins and the latest EPSS date per CVE. Grouping starts in the map tasks.
    """

    def known(df, wanted):
        return [c for c in wanted if c in df.columns]

    feeds = {"kev": (kev, KEV_COLUMNS), "nvd": (nvd, NVD_COLUMNS), "epss": (epss, EPSS_COLUMNS),
             "circl": (circl, CIRCL_COLUMNS)}
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            df.where(F.col("cve_id").isNotNull()).select("cve_id", F.struct(*known(df, cols)).alias(name))
            for name, (df, cols) in feeds.items()
        ],
    )
    latest = F.struct(*[F.col(f"epss.{c}") for c in ["date", *[c for c in known(epss, EPSS_COLUMNS) if c != "date"]]])
    grouped = stacked.groupBy("cve_id").agg(
        F.max("kev").alias("kev"),
        F.max("nvd").alias("nvd"),
        F.max(F.when(F.col("epss").isNotNull(), latest)).alias("epss"),
        F.max("circl").alias("circl"),
    )
    kev_listed = F.col("kev").isNotNull()
    score = priority_score(F.col("epss.epss"), kev_listed, F.col("nvd.cvss_v3_score"))
    return grouped.select(
        "cve_id",
        kev_listed.alias("kev_listed"),
        *[F.col(f"kev.{c}").alias(c) for c in known(kev, KEV_COLUMNS)],
        *[F.col(f"nvd.{c}").alias(c) for c in known(nvd, NVD_COLUMNS)],
        F.col("epss.epss").alias("epss_score"),
        *[F.col(f"epss.{c}").alias(f"epss_{c}") for c in known(epss, EPSS_COLUMNS) if c != "epss"],
        *[F.col(f"circl.{c}").alias(c) for c in known(circl, CIRCL_COLUMNS)],
        score.alias("vuln_priority_score"),
    )


def latest_epss(epss: DataFrame) -> DataFrame:
    """The newest row per CVE."""
    rest = [c for c in epss.columns if c not in ("cve", "date")]
    newest = epss.groupBy("cve").agg(F.max(F.struct("date", *rest)).alias("last"))
    return newest.select("cve", "last.*")


def top_priority(vulns: DataFrame, n: int = 50) -> DataFrame:
    """The first CVEs to patch, best score first, unscored ones last."""
    return vulns.orderBy(F.desc_nulls_last("vuln_priority_score"), "cve_id").limit(n)


# -- network events and indicators ------------------------------------------------------------------

EVENT_LOG = [
    "timestamp_utc", "event_type", "src_ip", "src_port", "dst_ip", "dst_port", "proto", "signature",
    "severity", "category", "scenario_number", "artifact_sha256", "replay_run_id", "flow_id",
    "event_payload_json", "ingest_date",
]


def network_events(events: DataFrame, alerts: DataFrame) -> DataFrame:
    """Events and alerts under one schema; ``origin`` tells them apart, since alerts occur in both."""
    renamed = {"dest_ip": "dst_ip", "dest_port": "dst_port"}
    parts = [
        events.withColumnsRenamed(renamed).withColumn("origin", F.lit("suricata_events")),
        alerts.withColumn("origin", F.lit("ids_alerts")),
    ]
    shaped = [p.select(*[c for c in EVENT_LOG if c in p.columns], "origin") for p in parts]
    return shaped[0].unionByName(shaped[1], allowMissingColumns=True)


def indicators(threatfox: DataFrame, urlhaus: DataFrame) -> DataFrame:
    """IP, domain, URL and file-hash indicators ``(ioc_type, value, source, malware)`` of both feeds."""
    ioc = F.coalesce("ioc", "ioc_value")
    address = A.normalize_ip(ioc)
    family = F.coalesce(S.non_empty(F.col("malware_printable")), F.col("malware"))
    kind = (
        F.when(address.isNotNull(), "ip")
        .when(S.looks_like_url(ioc), "url")
        .when(ioc.rlike("^[0-9a-fA-F]{32,64}$"), "hash")
        .otherwise("domain")
    )
    typed = threatfox.select(
        kind.alias("ioc_type"),
        F.coalesce(address, F.when(S.looks_like_url(ioc), ioc), F.lower(ioc)).alias("value"),
        F.lit("threatfox").alias("source"),
        family.alias("malware"),
    )
    host = S.url_host(F.col("url"))
    host_ip = A.normalize_ipv4(host)
    none = F.lit(None).cast("string")
    urls = urlhaus.where(S.looks_like_url(F.col("url"))).select(
        F.explode(
            F.array(
                F.struct(F.lit("url").alias("ioc_type"), F.col("url").alias("value")),
                F.struct(
                    F.when(host_ip.isNotNull(), "ip").otherwise("domain").alias("ioc_type"),
                    F.coalesce(host_ip, host).alias("value"),
                ),
            )
        ).alias("i"),
    )
    return typed.unionByName(
        urls.select("i.ioc_type", "i.value", F.lit("urlhaus").alias("source"), none.alias("malware"))
    ).where(F.col("value").isNotNull())


def one_per_indicator(iocs: DataFrame) -> DataFrame:
    """One row per indicator with its feeds and malware families, so matches never multiply."""
    return iocs.groupBy("ioc_type", "value").agg(
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("malware")).alias("malware"),
    )


def correlate_ip(events: DataFrame, iocs: DataFrame, src: str = "src_ip", dst: str = "dst_ip") -> DataFrame:
    """Events whose source or destination is an indicator address, one row per matching side.

    Each event is offered once per side and joined by equality, instead of an OR condition that no hash
    join can use.
    """
    addresses = iocs.where(F.col("ioc_type") == "ip").withColumnRenamed("value", "matched_value")
    sides = F.array(
        F.struct(F.lit("src").alias("side"), F.col(src).alias("v")),
        F.struct(F.lit("dst").alias("side"), F.col(dst).alias("v")),
    )
    offered = events.withColumn("_s", F.explode(sides)).select(
        *events.columns, F.col("_s.side").alias("matched_side"), F.col("_s.v").alias("matched_value")
    )
    return offered.join(addresses, "matched_value")


def _offers(src: str, dst: str, doc: Column) -> Column:
    """What an event can be matched by: its two addresses, and the hosts and URLs its payload mentions."""
    host, target = S.json_text(doc, "$.http.hostname"), S.json_text(doc, "$.http.url")
    url = F.when(target.rlike("^https?://"), target).when(
        host.isNotNull() & target.isNotNull(), F.concat(F.lit("http://"), host, target)
    )
    domains = [host, S.json_text(doc, "$.dns.rrname"), S.json_text(doc, "$.tls.sni")]
    offered = [("src", "ip", F.col(src)), ("dst", "ip", F.col(dst)), ("payload", "url", url)]
    offered += [("payload", "domain", F.lower(d)) for d in domains]
    return F.array_distinct(
        F.array(*[F.struct(F.lit(side).alias("side"), F.lit(kind).alias("t"), v.alias("v")) for side, kind, v in offered])
    )


def offered_values(
    events: DataFrame, key: list[str], src: str = "src_ip", dst: str = "dst_ip", payload: str = "event_payload_json"
) -> DataFrame:
    """``(*key, matched_side, ioc_type, matched_value)``: all that events offer, in one scan and one parse of the log.

    Only the key and the offered text leave the scan; the payload stays behind.
    """
    narrow = events.select(*key, F.col(src).alias("_src"), F.col(dst).alias("_dst"), F.col(payload).alias("_text"))
    opened = S.parsed(narrow, "_text", "_doc")
    each = opened.select(*key, F.explode(_offers("_src", "_dst", F.col("_doc"))).alias("o")).where(F.col("o.v").isNotNull())
    return each.select(*key, F.col("o.side").alias("matched_side"), F.col("o.t").alias("ioc_type"), F.col("o.v").alias("matched_value"))


def ioc_correlations(events: DataFrame, iocs: DataFrame, key: list[str]) -> DataFrame:
    """All matches of network events with indicators: by address on either side, by host, by URL.

    ``key`` names the columns that tell the rows of the log apart. Offers are matched without the rows they come from;
    the rows are then fetched by key for the matches only, so a log of large payloads is not shuffled to be searched.
    A value that very many events offer meets one indicator row, so its partition can be split.
    """
    unique = one_per_indicator(iocs).withColumnRenamed("value", "matched_value")
    matched = offered_values(events, key).join(unique, ["ioc_type", "matched_value"])
    return events.join(matched, key)


def resolve_entities(mentions: DataFrame) -> DataFrame:
    """One row per canonical indicator with the feeds that mention it."""
    return mentions.groupBy("ioc_type", "value").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def canonical_entity(kind: Column, value: Column) -> Column:
    """Addresses normalized, hosts lower-cased, CVE ids upper-cased; URLs as they are."""
    clean = S.strip(value)
    return (
        F.when(kind == "ip", A.normalize_ip(clean))
        .when(kind == "domain", F.lower(clean))
        .when(kind == "cve", F.upper(clean))
        .otherwise(clean)
    )


def trace_alerts(alerts: DataFrame, runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Alert → replay run → artifact → raw path; alerts without a run stay, spread by ``lookup``."""
    return lookup(lookup(alerts, runs, ["replay_run_id"]), artifacts, ["artifact_sha256"])


# -- counts -----------------------------------------------------------------------------------------


def alerts_per_window(alerts: DataFrame, width: str = "1 minute", ts: str = "ts") -> DataFrame:
    counted = alerts.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("alerts"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "alerts")


def top_talkers(alerts: DataFrame, address: str, k: int, width: str | None = None, ts: str = "ts") -> DataFrame:
    """The ``k`` busiest addresses, in all or per window; counted before ranked."""
    slot = F.window(ts, width)["start"] if width else F.lit(None).cast("timestamp")
    counted = alerts.groupBy(slot.alias("window_start"), address).agg(F.count("*").alias("alerts"))
    if width is None:
        return counted.orderBy(F.desc("alerts"), address).limit(k)
    return top_per_group(counted, ["window_start"], k, F.desc("alerts"), F.col(address))


def signature_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("signature", "severity").agg(F.count("*").alias("alerts"))


def daily_alert_counts(alerts: DataFrame, ts: str = "ts") -> DataFrame:
    """Alerts per date, severity and signature; of a unified log only the alert side counts."""
    rows = alerts.where(F.col("origin") == "ids_alerts") if "origin" in alerts.columns else alerts
    return rows.groupBy(F.to_date(ts).alias("date"), "severity", "signature").agg(F.count("*").alias("alerts"))


def kev_rolling(kev: DataFrame, as_of: Column, days: int = 7, key: str = "cve_id", added: str = "date_added") -> DataFrame:
    """CVEs added in the last ``days`` days, today included."""
    recent = kev.where(F.col(added).between(F.date_sub(as_of, days - 1), as_of))
    return recent.agg(F.count_distinct(key).alias("kev_added"))


def flow_features(events: DataFrame) -> DataFrame:
    """One feature row per flow: event count, and the fields of its most severe event.

    A flow id is unique inside one replay run, so rows that carry a ``replay_run_id`` are grouped by both.

    A severity of 0 means no alert, 1 is the gravest; all parts are partial aggregates, so a flow with most
    of the events is reduced before the shuffle.
    """
    graveness = F.when(F.col("severity") > 0, F.col("severity"))
    lead = F.min(F.struct(graveness.isNull().alias("calm"), "severity", "category", "src_port", "dst_port"))
    keys = [c for c in ("replay_run_id", "flow_id") if c in events.columns]
    grouped = events.groupBy(*keys).agg(F.count("*").alias("event_count"), lead.alias("lead"))
    return grouped.select(
        *keys, "event_count", "lead.category", "lead.severity", "lead.src_port", "lead.dst_port"
    )


def risk_summary(enriched_alerts: DataFrame) -> DataFrame:
    """Alerts per CVE with its priority score."""
    return (
        enriched_alerts.where(F.col("cve_id").isNotNull())
        .groupBy("cve_id")
        .agg(F.count("*").alias("alerts"), F.max("vuln_priority_score").alias("vuln_priority_score"))
    )


def enrich_alerts(alerts: DataFrame, vulns: DataFrame) -> DataFrame:
    """Alerts with the CVE named in their signature and that CVE's score and severity.

    Works on a batch or a stream of alerts. The vulnerability side is one row per CVE and narrow; Spark
    broadcasts it when its size is below the threshold.
    """
    context = vulns.select("cve_id", "vuln_priority_score", "cvss_v3_severity")
    return lookup(alerts.withColumn("cve_id", S.cve_in_signature(F.col("signature"))), context, ["cve_id"])
