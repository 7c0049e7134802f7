"""Landed files with their sidecars, envelopes, rule files and catalogs on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators import catalog, events, lineage, trusted, writes
from threatloom.plans import jobs
from threatloom.plans.registry import Tables, query
from threatloom.session import work_dir
from threatloom.sources import feeds, files

DATE, RETRIEVED = "2026-03-12", "2026-03-12T08:15:00+00:00"


def _lake(t: Tables) -> jobs.Lake:
    return jobs.Lake(t.spark, work_dir(t.spark, "lake"), DATE, RETRIEVED)


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _pages(rows: DataFrame, key: str, size: int, record: Column, field: str, **values: Column) -> DataFrame:
    """``(page, value)``: one JSON page per ``size`` keys, records in key order, so a page is bounded by its keys."""
    page = F.col(key).cast("bigint").alias("_key")
    each = rows.select(page, (F.col(key).cast("bigint") - F.pmod(F.col(key).cast("bigint"), F.lit(size))).alias("_first"), record.alias("r"))
    pages = each.groupBy((F.col("_first") / size).cast("bigint").alias("page")).agg(F.array_sort(F.collect_list(F.struct("_key", "r"))).alias("items"))
    body = F.struct(*[v.alias(k) for k, v in values.items()], F.transform("items", lambda i: i["r"]).alias(field))
    return pages.select("page", F.to_json(body).alias("value"))


# -- sidecars and metrics ---------------------------------------------------------------------------


@query("""
WITH lines AS (SELECT event_id, event_id // 1000 AS page, '{"event":' || event_id || ',"type":"' || event_type || '"}' || chr(10) AS line FROM events),
pages AS (SELECT page, count(*) AS n, CAST(sum(strlen(line)) AS BIGINT) AS size_bytes, sha256(string_agg(line, '' ORDER BY event_id)) AS sha256 FROM lines GROUP BY page),
total AS (SELECT count(*) AS n FROM events)
SELECT CASE WHEN page % 4 <> 3 THEN 'events_api' END AS source,
  CASE WHEN page % 4 = 0 THEN 'https://events.example' WHEN page % 4 <> 3 THEN 'https://events.example?offset=' || page * 1000 END AS url,
  CASE WHEN page % 4 <> 3 THEN '2026-03-12T08:15:00+00:00' END AS retrieved_at_utc, 'landed/page=' || page AS folder,
  CASE WHEN page % 4 <> 3 THEN page END AS page_index, CASE WHEN page % 4 <> 3 THEN page * 1000 END AS "offset",
  CASE WHEN page % 4 <> 3 THEN total.n END AS total_results, CASE WHEN page % 4 <> 3 THEN pages.n END AS record_count,
  size_bytes, sha256, page % 4 = 1 AS recorded_differently
FROM pages, total
""")
def q_ingest_sidecars(t: Tables) -> DataFrame:
    """Event pages landed with sidecars: some without, some without a request address, some with a wrong hash."""
    root = work_dir(t.spark, "landing")
    line = F.concat(F.lit('{"event":'), _text("event_id"), F.lit(',"type":"'), F.col("event_type"), F.lit('"}'))
    page = ((F.col("event_id") - F.pmod("event_id", F.lit(1000))) / 1000).cast("bigint")
    lines = t.events.select(line.alias("value"), "event_id", page.alias("page"))
    ordered = lines.repartition("page").sortWithinPartitions("page", "event_id")
    ordered.select("value", "page").write.partitionBy("page").text(f"{root}/landed")
    found = files.read_artifacts(t.spark, f"{root}/landed", "part-*")
    found = found.withColumn("relative_landing_path", files.relative_path(F.col("path"), root))
    number = S.path_part(F.col("path"), "page").cast("bigint")
    sizes = lines.groupBy("page").agg(F.count("*").alias("record_count"))
    total = t.events.agg(F.count("*").alias("total_results"))
    at = F.concat(F.lit("https://events.example?offset="), _text(number * 1000))
    told = found.withColumn("page", number).join(sizes, "page").join(total, F.lit(True)).where("page % 4 <> 3")
    sidecar = F.struct(
        F.lit("events_api").alias("source_id"), F.lit("https://events.example").alias("source_url"),
        F.when(F.col("page") % 4 != 0, at).alias("request_url"), F.lit(RETRIEVED).alias("retrieved_at_utc"),
        "relative_landing_path", F.when(F.col("page") % 4 == 1, "stale").otherwise(F.col("sha256")).alias("sha256"), "size_bytes",
        F.col("page").alias("page_index"), (F.col("page") * 1000).alias("offset"), F.lit(1000).alias("results_per_page"), "total_results", "record_count",
    )
    # One file per sidecar, as a landing has them.
    told.select(F.to_json(sidecar).alias("value"), "page").write.partitionBy("page").option("maxRecordsPerFile", 1).text(f"{root}/sidecars")
    metrics = lineage.sidecar_metrics(found, files.read_sidecars(t.spark, f"{root}/sidecars"))
    return metrics.select(
        "source", "url", "retrieved_at_utc", F.regexp_extract("relative_landing_path", "^(.*)/", 1).alias("folder"), "page_index", "offset",
        "total_results", "record_count", "size_bytes", "sha256", "recorded_differently",
    )


@query("""
WITH items AS (SELECT c_custkey // 500 AS page, count(*) AS n FROM customer GROUP BY ALL)
SELECT 'kev' AS feed, 'json' AS format, count(*) AS files, CAST(sum(n) AS BIGINT) AS record_count FROM items
UNION ALL SELECT 'kev', 'csv', 1, NULL
UNION ALL SELECT 'urlhaus', 'csv', count(DISTINCT o_orderkey % 3), count(*) FROM orders
""")
def q_landing_metrics(t: Tables) -> DataFrame:
    """One metrics table of JSON and CSV landings: rows of a CSV vulnerability list are not read, its count is null."""
    lake = _lake(t)
    kev = lake.landed("kev").rsplit("/", 1)[0]
    record = F.struct(F.concat(F.lit("CVE-"), _text("c_custkey")).alias("cveID"), F.col("c_name").alias("vulnerabilityName"))
    pages = _pages(t.customer, "c_custkey", 500, record, "vulnerabilities", count=F.lit(1))
    pages.select("value", "page").write.option("maxRecordsPerFile", 1).partitionBy("page").text(f"{kev}/pages.json")
    names = t.nation.select(F.concat_ws(",", _text("n_nationkey"), "n_name").alias("value"))
    names.coalesce(1).write.text(f"{kev}/list.csv")
    lines = t.orders.select(F.concat(F.lit("# generated\n# id,status\n\n "), _text("o_orderkey"), F.lit(","), F.col("o_orderstatus")).alias("value"), (F.col("o_orderkey") % 3).alias("part"))
    lines.repartition("part").write.partitionBy("part").text(lake.landed("urlhaus").rsplit("/", 1)[0] + "/recent.csv")
    csv = F.col("path").contains("/list.csv/")
    # Spark names its files itself, so the format is told by the folder.
    counted = feeds.explode_items(feeds.read_pages(t.spark, f"{kev}/pages.json/page=*", "vulnerabilities"), "vulnerabilities")
    measured = lineage.ingest_metrics(files.read_artifacts(t.spark, kev, "part-*"), counted, csv).select(F.lit("kev").alias("feed"), "path", "record_count")
    urls = lake.landed("urlhaus").rsplit("/", 1)[0] + "/recent.csv"
    url_files = lineage.ingest_metrics(files.read_artifacts(t.spark, urls, "part-*"), feeds.csv_rows(t.spark, f"{urls}/part=*"))
    both = measured.unionByName(url_files.select(F.lit("urlhaus").alias("feed"), "path", "record_count"))
    kind = F.when(F.col("path").contains(".csv/"), "csv").otherwise("json")
    return both.groupBy("feed", kind.alias("format")).agg(F.count("*").alias("files"), F.sum("record_count").alias("record_count"))


# -- feeds ------------------------------------------------------------------------------------------


@query("""
SELECT CASE c_custkey % 4 WHEN 0 THEN '10.' || c_custkey % 250 || '.' || (c_custkey // 250) % 250 || '.7'
    WHEN 1 THEN '2001:db8::' || format('{:x}', 1 + c_custkey % 65535) WHEN 2 THEN '192.0.2.' || c_custkey % 256 END AS ip
FROM customer WHERE c_custkey % 4 < 3 AND NOT (c_custkey % 4 = 1 AND c_custkey % 3 = 0)
GROUP BY ip ORDER BY min(c_custkey) LIMIT 50
""")
def q_threatfox_seeds(t: Tables) -> DataFrame:
    """Customers landed as indicator envelopes; the first 50 addresses in them, of both families, in landing order."""
    key = F.col("c_custkey")
    v4 = F.concat(F.lit("10."), _text(key % 250), F.lit("."), _text((key / 250).cast("bigint") % 250), F.lit(".7"))
    v6 = F.concat(F.lit("2001:0DB8:0::"), F.hex(F.lit(1) + key % 65535))
    kind = F.when(key % 4 == 0, "ip:port").when((key % 4 == 1) & (key % 3 != 0), "IP").otherwise("domain")
    ioc = F.when(key % 4 == 0, F.concat(v4, F.lit(":80"))).when(key % 4 == 1, v6).otherwise(F.col("c_name"))
    host = F.when(key % 4 == 2, F.concat(F.lit(" 192.0.2."), _text(key % 256)))
    pages = _pages(t.customer, "c_custkey", 500, F.struct(kind.alias("ioc_type"), ioc.alias("ioc"), host.alias("host")), "data", query_status=F.lit("ok"))
    lake = _lake(t)
    landed = lake.landed("threatfox").rsplit("/", 1)[0]
    pages.write.option("maxRecordsPerFile", 1).partitionBy("page").text(f"{landed}/envelopes.json")
    items = feeds.read_threatfox(t.spark, f"{landed}/envelopes.json/page=*")
    return jobs.seeds_of(lake, items, [], 50).select("ip")


@query("""
WITH wanted AS (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 200)
SELECT 'CVE-' || c_custkey AS cve_id, 'https://lookup.example/CVE-' || c_custkey AS request_url, c_custkey % 5 IN (0, 4) AS found,
  CASE WHEN c_custkey % 5 IN (0, 4) THEN '{"n":' || c_custkey || '}' END AS payload,
  CASE c_custkey % 5 WHEN 1 THEN '404' WHEN 2 THEN '503' END AS status_code,
  CASE c_custkey % 5 WHEN 1 THEN 'HTTP Error 404: Not Found' WHEN 2 THEN 'HTTP Error 503: Busy' WHEN 3 THEN 'Invalid JSON response: line 1' END AS error
FROM wanted
""")
def q_lookup_report(t: Tables) -> DataFrame:
    """Answers of lookups landed as JSON lines, failures in their sidecar; each failure with its status and cause."""
    lake = _lake(t)
    landed = lake.landed("circl_vulnlookup").rsplit("/", 1)[0]
    wanted = t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(200).select(F.col("c_custkey").alias("n"), F.concat(F.lit("CVE-"), _text("c_custkey")).alias("cve_id"))
    answer = F.to_json(F.struct("cve_id", F.lit("circl").alias("source_id"), F.struct("n").alias("payload")))
    wanted.where("n % 5 IN (0, 4)").select(answer.alias("value")).write.text(f"{landed}/details.jsonl")
    kind = F.col("n") % 5
    error = F.when(kind == 1, "HTTP Error 404: Not Found").when(kind == 2, "HTTP Error 503: Busy").when(kind == 3, "Invalid JSON response: line 1").otherwise("first try")
    failure = F.struct("cve_id", F.when(kind == 1, 404).alias("status_code"), error.alias("error"))
    failed = wanted.where("n % 5 <> 0").agg(F.collect_list(failure).alias("failed_requests"))  # of the 200 wanted
    failed.select(F.to_json(F.struct("failed_requests")).alias("value")).write.text(f"{landed}/details.jsonl.meta.json")
    report = jobs.lookup_report(lake, wanted.drop("n"), "circl_vulnlookup", "https://lookup.example")
    return report.withColumn("status_code", _text("status_code"))


@query("""
WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
SELECT 'CVE-' || o_custkey AS cve_id, o_orderpriority AS vendor_project, CAST(NULL AS VARCHAR) AS product, o_clerk AS vulnerability_name,
  CAST(NULL AS VARCHAR) AS notes, strftime(o_orderdate, '%Y-%m-%d') AS date_added, CAST(NULL AS VARCHAR) AS due_date, CAST(NULL AS VARCHAR) AS cwes,
  '{"order_key":' || o_orderkey || '}' AS _extra
FROM (SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus AS o_clerk FROM latest)
""")
def q_trusted_schema(t: Tables) -> DataFrame:
    """Orders as a vulnerability feed that lacks declared fields and has one nobody declared."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    seen = F.concat(day, F.lpad(_text("o_orderkey"), 20, "0"))
    raw = t.orders.select(
        F.concat(F.lit("CVE-"), _text("o_custkey")).alias("cveID"), F.col("o_orderpriority").alias("vendorProject"),
        F.col("o_orderstatus").alias("vulnerabilityName"), day.alias("dateAdded"), F.lit("soon").alias("dueDate"),
        F.col("o_orderkey").alias("orderKey"), seen.alias("retrieved_at_utc"),
    )
    clean = trusted.clean(raw, "kev").clean
    texts = {"date_added": F.date_format("date_added", "yyyy-MM-dd"), "due_date": F.date_format("due_date", "yyyy-MM-dd"), "cwes": F.to_json("cwes")}
    return clean.withColumns(texts).select(
        "cve_id", "vendor_project", "product", "vulnerability_name", "notes", "date_added", "due_date", "cwes", "_extra"
    )


# -- captures and runs ------------------------------------------------------------------------------


@query("""
WITH rows AS (SELECT source AS source_id, CASE WHEN doc_id % 9 > 0 THEN doc_id % 9 END AS scenario_number, 'capture-' || doc_id % 17 AS artifact_name,
  '2026-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS ingest_date, sha256(CAST(doc_id AS VARCHAR)) AS sha256 FROM documents)
SELECT row_number() OVER (ORDER BY source_id, coalesce(scenario_number, -1), artifact_name, ingest_date, sha256) - 1 AS position,
  source_id, CAST(scenario_number AS VARCHAR) AS scenario_number, artifact_name, ingest_date, sha256 FROM rows
""")
def q_catalog_order(t: Tables) -> DataFrame:
    """Documents as captures, stored in catalog order and read back with their places; no scenario comes first."""
    number = F.col("doc_id") % 9
    rows = t.documents.select(
        F.col("source").alias("source_id"), F.when(number > 0, number).alias("scenario_number"),
        F.concat(F.lit("capture-"), _text(F.col("doc_id") % 17)).alias("artifact_name"),
        F.concat(F.lit("2026-01-"), F.lpad(_text(1 + F.col("doc_id") % 28), 2, "0")).alias("ingest_date"),
        S.sha256(_text("doc_id")).alias("sha256"),
    )
    stored = writes.write_snapshot(catalog.in_catalog_order(rows), work_dir(t.spark, "catalog"))
    return files.read_in_order(t.spark, stored).withColumn("scenario_number", _text("scenario_number"))


@query(r"""
WITH docs AS (SELECT doc_id, doc_id % 3 AS k, text, n_chars, TIMESTAMP '2026-03-12 08:00:00' + to_seconds(doc_id) AS started FROM documents),
typed AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'alert' ELSE 'flow' END AS kind FROM events WHERE event_type IN ('click', 'view')),
per_type AS (SELECT user_id, kind, count(*) AS n FROM typed GROUP BY ALL),
counts AS (SELECT user_id, '{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}' AS event_counts_json, CAST(sum(n) AS BIGINT) AS total_events,
  CAST(coalesce(sum(n) FILTER (kind = 'alert'), 0) AS BIGINT) AS alert_events FROM per_type GROUP BY user_id)
SELECT doc_id, strftime(started, '%Y%m%dT%H%M%SZ-') || '12 hex' AS run_id, CASE k WHEN 0 THEN 'failed' ELSE 'succeeded' END AS status,
  CASE k WHEN 0 THEN right(text, 1000) ELSE '' END AS error_summary, CAST(round(CAST(n_chars AS DOUBLE) / CAST(1000 AS DOUBLE), 3) AS DOUBLE) AS duration_seconds,
  coalesce(nullif(trim(regexp_replace(left(text, 30), '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'adhoc') AS artifact_name,
  CASE k WHEN 0 THEN '{}' ELSE coalesce(event_counts_json, '{}') END AS event_counts_json,
  CASE k WHEN 0 THEN 0 ELSE coalesce(total_events, 0) END AS total_events, CASE k WHEN 0 THEN 0 ELSE coalesce(alert_events, 0) END AS alert_events
FROM docs LEFT JOIN counts ON user_id = doc_id
""")
def q_replay_runs(t: Tables) -> DataFrame:
    """Documents as replay attempts, one third failed: run ids, error ends, durations, names, counted events."""
    started = F.timestamp_seconds(F.lit(1773302400) + F.col("doc_id"))  # 2026-03-12 08:00:00
    failed = F.col("doc_id") % 3 == 0
    attempts = t.documents.select(
        "doc_id", S.replay_run_id(started).alias("replay_run_id"), F.when(failed, "failed").otherwise(events.SUCCEEDED).alias("status"),
        F.when(failed, F.col("text")).alias("error"), started.alias("started_at"), F.timestamp_millis(F.unix_millis(started) + F.col("n_chars")).alias("completed_at"),
        F.lit("eve").alias("eve_landing_path"), F.lit(1).cast("bigint").alias("scenario_number"), S.sanitize_segment(F.left("text", F.lit(30))).alias("artifact_name"),
        F.lit("h").alias("sha256"), F.col("n_chars").alias("size_bytes"), F.lit("r").alias("relative_landing_path"), F.lit("l").alias("landing_path"),
    )
    path = work_dir(t.spark, "attempts")
    attempts.write.parquet(path)  # run ids are made once
    stored = t.spark.read.schema(attempts.schema).parquet(path)
    kind = F.when(F.col("event_type") == "click", "alert").otherwise("flow")
    seen = t.events.where(F.col("event_type").isin("click", "view")).select(F.col("user_id").alias("doc_id"), kind.alias("event_type"))
    log = seen.join(stored.where(F.col("status") == events.SUCCEEDED).select("doc_id", "replay_run_id"), "doc_id")
    runs = events.run_rows(stored, log, events.DEFAULT_EVENT_TYPES, DATE, "suricata")
    named = runs.join(stored.select("doc_id", "replay_run_id"), "replay_run_id")
    shown = F.regexp_replace("replay_run_id", "-[0-9a-f]{12}$", "-12 hex")
    return named.select(
        "doc_id", shown.alias("run_id"), "status", "error_summary", "duration_seconds", "artifact_name", "event_counts_json", "total_events", "alert_events"
    )


@query("""
SELECT n_name AS name, CAST(count(*) AS BIGINT) AS suppliers, CAST(2 AS INTEGER) AS build FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name
""")
def q_gold_overwrite(t: Tables) -> DataFrame:
    """A gold table built twice: readers see the second build alone."""
    path = work_dir(t.spark, "gold")
    named = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    for build, rows in ((1, named.where("s_suppkey % 2 = 0")), (2, named)):
        counted = rows.groupBy(F.col("n_name").alias("name")).agg(F.count("*").alias("suppliers"))
        writes.write_snapshot(counted.withColumn("build", F.lit(build)), path)
    return files.read_table(t.spark, path)
