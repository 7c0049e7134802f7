"""Vulnerability side on the supplied tables: parts stand for CVEs, discounts for exploit probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators import enrichment, exploitation, trusted
from threatloom.plans.registry import Tables, query
from threatloom.session import work_dir
from threatloom.sources import feeds


def _cve(column: str):
    return F.concat(F.lit("CVE-"), F.col(column).cast("string"))


def part_vulns(t: Tables) -> DataFrame:
    """Parts as CVEs: promoted parts are exploited, the latest discount is the probability, size the severity."""
    cve = _cve("p_partkey").alias("cve_id")
    kev = t.part.where(F.col("p_type") == "PROMO").select(cve, F.col("p_brand").alias("vulnerability_name"))
    level = F.when(F.col("p_size") >= 45, "CRITICAL").when(F.col("p_size") >= 35, "HIGH").otherwise("LOW")
    nvd = t.part.select(
        cve, (F.col("p_size") / F.lit(5.0)).alias("cvss_v3_score"), level.alias("cvss_v3_severity")
    )
    moment = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    epss = t.lineitem.select(_cve("l_partkey").alias("cve_id"), F.col("l_discount").alias("epss"), moment.alias("date"))
    circl = t.part.select(cve, F.col("p_size").cast("bigint").alias("reference_count"))
    return exploitation.vuln_enriched(kev, nvd, epss, circl)


VULNS = """
WITH epss AS (
  SELECT l_partkey, l_discount AS epss FROM (
    SELECT l_partkey, l_discount, row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_discount DESC) AS rn FROM lineitem)
  WHERE rn = 1),
vulns AS (
  SELECT 'CVE-' || coalesce(p_partkey, l_partkey) AS cve_id,
    coalesce(p_type = 'PROMO', false) AS kev_listed,
    CASE WHEN p_type = 'PROMO' THEN p_brand END AS vulnerability_name,
    epss AS epss_score,
    p_size / CAST(5.0 AS DOUBLE) AS cvss_v3_score,
    CASE WHEN p_size >= 45 THEN 'CRITICAL' WHEN p_size >= 35 THEN 'HIGH' WHEN p_size IS NOT NULL THEN 'LOW' END
      AS cvss_v3_severity,
    CAST(p_size AS BIGINT) AS reference_count,
    epss * CASE WHEN p_type = 'PROMO' THEN CAST(1.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END
      * (p_size / CAST(5.0 AS DOUBLE)) / CAST(10.0 AS DOUBLE) AS score
  FROM part FULL JOIN epss ON l_partkey = p_partkey)
"""


@query(
    VULNS
    + """
SELECT cve_id, kev_listed, vulnerability_name, epss_score, cvss_v3_score, cvss_v3_severity, reference_count,
  round(score, 4) AS vuln_priority_score
FROM vulns ORDER BY score DESC NULLS LAST, cve_id LIMIT 50
"""
)
def q_priority_top50(t: Tables) -> DataFrame:
    top = exploitation.top_priority(part_vulns(t), 50)
    return top.select(
        "cve_id", "kev_listed", "vulnerability_name", "epss_score", "cvss_v3_score", "cvss_v3_severity",
        "reference_count", F.round("vuln_priority_score", 4).alias("vuln_priority_score"),
    )


@query(
    VULNS
    + """
SELECT cve_id, kev_listed, vulnerability_name, epss_score, cvss_v3_score, cvss_v3_severity, reference_count,
  round(score, 4) AS vuln_priority_score
FROM vulns
"""
)
def q_vuln_enriched(t: Tables) -> DataFrame:
    return part_vulns(t).select(
        "cve_id", "kev_listed", "vulnerability_name", "epss_score", "cvss_v3_score", "cvss_v3_severity",
        "reference_count", F.round("vuln_priority_score", 4).alias("vuln_priority_score"),
    )


@query(
    VULNS
    + """
SELECT count(*) AS rows, count(*) - count(cve_id) AS null_cve_id, count(cve_id) - count(DISTINCT cve_id) AS repeated_cve_id,
  count(*) FILTER (epss_score < 0 OR epss_score > 1) AS epss_out_of_range,
  count(*) FILTER (cvss_v3_score < 0 OR cvss_v3_score > 10) AS cvss_out_of_range,
  count(*) FILTER (score < 0) AS negative_score
FROM vulns
"""
)
def q_quality_report(t: Tables) -> DataFrame:
    return trusted.quality_report(part_vulns(t))


@query("""
SELECT l_partkey AS part_key, epss FROM (
  SELECT l_partkey, l_discount AS epss, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_discount DESC) AS rn FROM lineitem)
WHERE rn = 1
""")
def q_latest_epss(t: Tables) -> DataFrame:
    moment = F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("date")
    scores = t.lineitem.select(F.col("l_partkey").alias("cve"), moment, F.col("l_discount").alias("epss"))
    return exploitation.latest_epss(scores).select(F.col("cve").alias("part_key"), "epss")


@query("""
WITH scores AS (
  SELECT 'CVE-' || user_id AS cve, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS score, event_id FROM events
  WHERE event_type <> 'view')
SELECT cve, CAST(max(score) AS DOUBLE) AS score, CAST(min(event_id) AS BIGINT) AS first_event
FROM scores GROUP BY cve ORDER BY score DESC, first_event LIMIT 50
""")
def q_top_scores(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    prefix = F.when(F.col("event_type") == "view", "cve-").otherwise("CVE-")
    scores = t.events.select(
        F.concat(prefix, F.col("user_id").cast("string")).alias("cve"),
        text.alias("epss"),
        F.lit(0).alias("page"),
        F.col("event_id").alias("pos"),
    )
    return enrichment.top_cves(scores, 50).select("cve", "score", F.col("first_seen.pos").alias("first_event"))


@query("""
SELECT 'CVE-' || p_partkey AS cve, CAST(p_retailprice AS DOUBLE) AS epss, p_partkey // 500 AS page, p_partkey % 500 AS pos
FROM part
""")
def q_feed_pages(t: Tables) -> DataFrame:
    """Parts landed as pages of one JSON object each, then scanned back with page and position."""
    page = (F.col("p_partkey") / 500).cast("bigint")
    record = F.struct(
        F.col("p_partkey").alias("at"),
        F.struct(_cve("p_partkey").alias("cve"), F.col("p_retailprice").cast("string").alias("epss")).alias("r"),
    )
    pages = t.part.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(record)).alias("items"))
    landed = work_dir(t.spark, "pages")
    body = F.to_json(F.struct(F.lit(1).alias("total"), F.transform("items", lambda i: i["r"]).alias("data")))
    pages.select(body.alias("value"), "page").write.partitionBy("page").text(landed)
    return feeds.read_epss(t.spark, f"{landed}/page=*").select(
        "cve", S.probability(F.col("epss")).alias("epss"), "page", F.col("pos").cast("bigint").alias("pos")
    )


@query("""
SELECT 'CVE-' || p_partkey AS cve_id, p_name AS description_en,
  CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / 5.0 END AS cvss_v3_score,
  CASE WHEN p_size > 10 THEN p_type END AS cvss_v3_severity
FROM part
""")
def q_nvd_flatten(t: Tables) -> DataFrame:
    """Nested vulnerability records: first English description, CVSS block where there is one."""

    def described(lang, value):
        return F.struct(F.lit(lang).alias("lang"), value.alias("value"))

    data = F.struct((F.col("p_size") / 5.0).alias("baseScore"), F.col("p_type").alias("baseSeverity"))
    blocks = F.when(F.col("p_size") > 10, F.array(F.struct(data.alias("cvssData"))))
    cve = F.struct(
        _cve("p_partkey").alias("id"),
        F.array(
            described("es", F.col("p_brand")), described("en", F.col("p_name")), described("en", F.col("p_brand"))
        ).alias("descriptions"),
        F.struct(blocks.alias("cvssMetricV31")).alias("metrics"),
    )
    items = t.part.select(F.parse_json(F.to_json(F.struct(cve.alias("cve")))).alias("item"))
    return trusted.flatten_cvss(feeds.nvd_records(items)).select(
        "cve_id", "description_en", "cvss_v3_score", "cvss_v3_severity"
    )


@query("""
SELECT 'CVE-' || p_partkey AS cve_id,
  CASE WHEN p_size > 25 THEN least(p_type, p_brand) || ',' || greatest(p_type, p_brand) ELSE p_type END AS cwe_ids,
  CAST(CASE WHEN p_size > 25 THEN 3 ELSE 2 END AS BIGINT) AS reference_count
FROM part
""")
def q_circl_profile(t: Tables) -> DataFrame:
    """Both published payload layouts: weakness ids and number of references."""
    weakness = F.array(
        F.struct(F.array(F.struct(F.col("p_type").alias("cweId"))).alias("descriptions")),
        F.struct(F.array(F.struct(F.col("p_brand").alias("cweId"))).alias("descriptions")),
    )
    links = [F.col("p_name"), F.col("p_brand"), F.col("p_type")]
    cna = F.struct(weakness.alias("problemTypes"), F.array(*links).alias("references"))
    newer = F.to_json(F.struct(F.struct(cna.alias("cna")).alias("containers")))
    older = F.to_json(F.struct(F.col("p_type").alias("cwe"), F.array(*links[:2]).alias("references")))
    payload = F.when(F.col("p_size") > 25, newer).otherwise(older)
    rows = t.part.select(_cve("p_partkey").alias("cve_id"), payload.alias("payload"))
    return trusted.circl_profile(rows).withColumn("cwe_ids", F.array_join("cwe_ids", ","))


@query("""
WITH candidates AS (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 200),
latest AS (
  SELECT o_custkey, o_orderkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
answers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cve_id, 'https://lookup.example/' || c_custkey AS request_url,
    coalesce(o_orderstatus = 'O', false) AS found,
    CASE WHEN o_orderstatus = 'O' THEN '{"order":' || o_orderkey || '}' END AS payload,
    CASE WHEN o_orderstatus = 'F' THEN '404' END AS status_code,
    CASE WHEN o_orderstatus = 'F' THEN 'HTTP Error 404: Not Found' WHEN o_orderstatus = 'P' THEN 'Invalid JSON response'
      WHEN o_orderstatus IS NULL THEN 'no response' END AS error
  FROM candidates LEFT JOIN latest ON o_custkey = c_custkey)
SELECT cve_id, request_url, found, payload, status_code, error FROM answers
""")
def q_enrich_lookup(t: Tables) -> DataFrame:
    """The 200 best customers looked up among the landed answers (their latest orders)."""
    candidates = (
        t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(200).select(F.col("c_custkey").cast("string").alias("cve_id"))
    )
    latest = t.orders.groupBy("o_custkey").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("last")
    )
    order = F.concat(F.lit('{"order":'), F.col("last.o_orderkey").cast("string"), F.lit("}"))
    status = F.col("last.o_orderstatus")
    responses = latest.select(
        F.col("o_custkey").cast("string").alias("cve_id"),
        F.when(status == "O", order).when(status == "P", "{broken").alias("payload"),
        F.when(status == "F", "HTTP Error 404: Not Found").alias("error"),
    )
    found = enrichment.lookup_results(candidates, responses, "cve_id", "https://lookup.example")
    return found.withColumn("status_code", F.col("status_code").cast("string"))


@query("""
SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  '1998-05-02T00:00:00.000' AS window_from, '1998-06-01T00:00:00.000' AS window_to, '1998-06-01' AS ingest_date
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-05-02 00:00:00' AND TIMESTAMP '1998-06-01 00:00:00'
""")
def q_window_incremental(t: Tables) -> DataFrame:
    """Rows modified in the 720 hours up to the logical time of the run."""
    logical = S.logical_time(F.lit("not a time"), F.lit("1998-06-01T00:00:00Z"))
    orders = t.orders.withColumn("modified", F.col("o_orderdate").cast("timestamp"))
    return enrichment.in_window(orders, "modified", logical, 720).select(
        F.col("o_orderkey").alias("order_key"),
        F.date_format("modified", "yyyy-MM-dd").alias("order_date"),
        S.window_bound_text(S.window_start(logical, 720)).alias("window_from"),
        S.window_bound_text(logical).alias("window_to"),
        S.ingest_date(logical).alias("ingest_date"),
    )


@query("""
SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS kev_added FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1998-05-26' AND TIMESTAMP '1998-06-01'
""")
def q_rolling7d(t: Tables) -> DataFrame:
    kev = t.orders.select(F.col("o_custkey").alias("cve_id"), F.to_date("o_orderdate").alias("date_added"))
    return exploitation.kev_rolling(kev, F.lit("1998-06-01").cast("date"))


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS dateadded,
  CASE WHEN o_orderstatus = 'P' THEN 'not a url' ELSE 'http://h/' || o_orderkey || '?a="b",c' END AS url,
  o_orderpriority AS url_status, o_orderstatus = 'P' AS _quality_warn
FROM orders
""")
def q_commented_csv(t: Tables) -> DataFrame:
    """Orders landed as CSV with a commented header, scanned back and checked for valid URLs."""

    def quoted(column):
        return F.concat(F.lit('"'), F.replace(column.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))

    url = F.when(F.col("o_orderstatus") == "P", "not a url").otherwise(
        F.concat(F.lit("http://h/"), F.col("o_orderkey").cast("string"), F.lit('?a="b",c'))
    )
    row = F.concat_ws(
        ",", quoted(F.col("o_orderkey")), quoted(F.date_format("o_orderdate", "yyyy-MM-dd")), quoted(url),
        quoted(F.col("o_orderpriority")),
    )
    landed = work_dir(t.spark, "csv")
    text = F.concat(F.lit("# generated\n## id,dateadded,url,url_status\n\n  "), row)
    t.orders.select(text.alias("value")).write.text(landed)
    rows = trusted.warn_bad_url(feeds.read_commented_csv(t.spark, landed))
    return rows.select(F.col("id").cast("bigint").alias("id"), "dateadded", "url", "url_status", "_quality_warn")


@query("""
SELECT count(*) AS ioc_count,
  '{' || (SELECT string_agg('"' || label || '":' || n, ',' ORDER BY label) FROM (
    SELECT CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN 'unknown' WHEN 'signup' THEN 'unknown' ELSE event_type END
      AS label, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1)) || '}' AS ioc_type_breakdown
FROM events
""")
def q_ioc_breakdown(t: Tables) -> DataFrame:
    """Indicator types: JSON null, blank, missing and named ones, and elements that are no objects."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", '{"ioc_type":null}')
        .when(kind == "click", '{"ioc_type":"  "}')
        .when(kind == "signup", '{"id":1}')
        .when(kind == "purchase", '"purchase"')
        .otherwise(F.concat(F.lit('{"ioc_type":" '), kind, F.lit(' "}')))
    )
    return enrichment.type_breakdown(t.events.select(F.parse_json(text).alias("item")))


@query("""
SELECT event_type, count(*) AS records, count(DISTINCT CAST(ts AS DATE)) AS pages FROM events GROUP BY event_type
""")
def q_load_counts(t: Tables) -> DataFrame:
    from threatloom.operators.lineage import load_counts

    return load_counts(t.events.withColumn("page", F.to_date("ts")), ["event_type"])
