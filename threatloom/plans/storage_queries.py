"""Writes, manifests, artifacts and links on the supplied tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators import catalog, enrichment, lineage, shaping, upsert, writes
from threatloom.plans.registry import Tables, query
from threatloom.session import work_dir
from threatloom.sources.files import profile_rules, read_artifacts, read_selection_rules, read_table
from threatloom.sources.lines import read_manifest

IPV4_TOKEN = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# -- upsert, append, replace ------------------------------------------------------------------------


def order_history(t: Tables, key: Column | None = None) -> DataFrame:
    return t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
        (F.col("o_orderkey") if key is None else key).alias("order_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderpriority").alias("priority"),
    )


def order_changes(t: Tables, key: Column | None = None) -> DataFrame:
    """A later load that overlaps the history by half a year: new prices, some of them null, no priority."""
    price = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice") + 100.0)
    return t.orders.where(F.col("o_orderdate") >= F.lit("1999-07-01").cast("timestamp_ntz")).select(
        (F.col("o_orderkey") if key is None else key).alias("order_key"),
        F.when(F.col("o_orderstatus") == "O", "X").otherwise(F.col("o_orderstatus")).alias("status"),
        price.alias("total_price"),
    )


UPSERT_INPUT = """
WITH target AS (
  SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS total_price, o_orderpriority AS priority
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
source AS (
  SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderstatus <> 'F' THEN o_totalprice + CAST(100.0 AS DOUBLE) END AS total_price
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')
"""
UPSERTED = (
    UPSERT_INPUT
    + """
SELECT coalesce(s.order_key, t.order_key) AS order_key,
  CASE WHEN s.order_key IS NOT NULL THEN s.status ELSE t.status END AS status,
  CASE WHEN s.order_key IS NOT NULL THEN s.total_price ELSE t.total_price END AS total_price, priority
FROM target t FULL JOIN source s ON s.order_key = t.order_key
"""
)


@query(UPSERTED)
def q_upsert(t: Tables) -> DataFrame:
    return upsert.upsert(order_history(t), order_changes(t), ["order_key"])


@query(UPSERTED)
def q_upsert_table(t: Tables) -> DataFrame:
    """The same through a stored table: created, then merged; rows whose status changed move partition."""
    path = work_dir(t.spark, "orders")
    writes.write_or_merge(order_history(t), path, ["order_key"], ["status"])
    writes.write_or_merge(order_changes(t), path, ["order_key"], ["status"])
    return read_table(t.spark, path)


@query(
    UPSERT_INPUT
    + """, k AS (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT'),
tk AS (SELECT CASE WHEN order_key IN (FROM k) THEN order_key END AS order_key, status, total_price, priority FROM target),
sk AS (SELECT CASE WHEN order_key IN (FROM k) THEN order_key END AS order_key, status, total_price FROM source)
SELECT CAST(coalesce(s.order_key, t.order_key) AS VARCHAR) AS order_key,
  CASE WHEN s.status IS NOT NULL THEN s.status ELSE t.status END AS status,
  CASE WHEN s.status IS NOT NULL THEN s.total_price ELSE t.total_price END AS total_price, priority
FROM tk t FULL JOIN sk s ON s.order_key = t.order_key
"""
)
def q_upsert_null_keys(t: Tables) -> DataFrame:
    """Urgent orders have lost their key: they match nothing and stay on both sides."""
    key = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey"))
    merged = upsert.upsert(order_history(t, key), order_changes(t, key), ["order_key"])
    return merged.withColumn("order_key", F.col("order_key").cast("string"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_utc, event_type, 'synthetic' AS source,
  strftime(ts, '%Y-%m-%d') AS ingest_date
FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), event_type, 'suricata', strftime(ts, '%Y-%m-%d')
FROM events WHERE event_type NOT IN ('click', 'view')
""")
def q_append_two_producers(t: Tables) -> DataFrame:
    """Two producers append to one table partitioned by date."""
    path = work_dir(t.spark, "alerts")
    synthetic = F.col("event_type").isin("click", "view")
    for rows, source in ((t.events.where(synthetic), "synthetic"), (t.events.where(~synthetic), "suricata")):
        shaped = rows.select(
            "event_id",
            F.date_format("ts", MICROS).alias("timestamp_utc"),
            "event_type",
            F.lit(source).alias("source"),
            F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"),
        )
        writes.write_or_merge(shaped, path, None, ["ingest_date"])
    return read_table(t.spark, path)


@query("""
SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS ingest_date FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, event_type, value + 1.0, strftime(ts, '%Y-%m-%d') FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND event_type = 'purchase'
""")
def q_partition_replace(t: Tables) -> DataFrame:
    """All days written, then the second half replaced by its purchases."""
    path = work_dir(t.spark, "days")
    rows = t.events.select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"))
    writes.replace_partitions(rows, path, ["ingest_date"])
    later = rows.where((F.col("ingest_date") >= "2024-01-15") & (F.col("event_type") == "purchase"))
    writes.replace_partitions(later.withColumn("value", F.col("value") + 1.0), path, ["ingest_date"])
    return read_table(t.spark, path)


# -- manifests and metrics --------------------------------------------------------------------------


def manifest_entries(t: Tables) -> DataFrame:
    """Events as manifest entries: by relative path, by landing path, or by content only."""
    user = F.col("user_id").cast("string")
    head = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('"landing_path":" /raw/'), user, F.lit(' ",')))
        .when(F.col("event_type") == "signup", F.lit('"landing_path":"",'))
        .otherwise(F.concat(F.lit('"relative_landing_path":"raw/'), user, F.lit('",')))
    )
    text = F.concat(
        F.lit("{"), head, F.lit('"event_type":"'), F.col("event_type"), F.lit('","event_id":'),
        F.col("event_id").cast("string"), F.lit("}"),
    )
    return t.events.select(text.alias("line"), "event_id", F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"))


IDENTITY = """
WITH entries AS (
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS manifest_date,
    CASE WHEN event_type = 'view' THEN 'landing::/raw/' || user_id
      WHEN event_type = 'signup'
        THEN 'content::' || sha256('{"event_id":' || event_id || ',"event_type":"signup","landing_path":""}')
      ELSE 'relative::raw/' || user_id END AS identity
  FROM events)
"""


@query(
    IDENTITY
    + """
SELECT identity, min(event_id) AS pos, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
FROM entries GROUP BY identity
"""
)
def q_manifest_upsert(t: Tables) -> DataFrame:
    """The last entry per identity at the position of the first."""
    entry = F.col("entry")
    entries = S.parsed(manifest_entries(t), "line", "entry").select(
        S.manifest_identity(entry).alias("identity"),
        F.col("event_id").alias("seq"),
        S.safe_int(entry, "$.event_id").alias("event_id"),
        S.safe_str(entry, "$.event_type").alias("event_type"),
    )
    return upsert.merge_manifest(entries)


@query(IDENTITY + "SELECT identity, event_id, manifest_date FROM entries")
def q_manifest_scan(t: Tables) -> DataFrame:
    """Entries landed as JSON lines per date between blank, broken and non-object lines, scanned back."""
    root = work_dir(t.spark, "landing")
    noisy = F.concat(F.col("line"), F.lit("\n\n  \n{broken\n[1, 2]\n"))
    writes.append_manifest(manifest_entries(t).withColumn("line", noisy), root, "events")
    entries = read_manifest(t.spark, root, "events")
    return entries.select(
        S.manifest_identity(F.col("entry")).alias("identity"),
        S.safe_int(F.col("entry"), "$.event_id").alias("event_id"),
        "manifest_date",
    )


@query("""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size_bytes, sha256(text) AS sha256, lang = 'fr' AS integrity_fail
FROM documents
""")
def q_ingest_metrics(t: Tables) -> DataFrame:
    """Size and hash of each document; the recorded hash of the French ones is of other bytes."""
    path = F.concat(F.lit("raw/"), F.col("doc_id").cast("string")).alias("relative_landing_path")
    changed = F.when(F.col("lang") == "fr", F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    recorded = t.documents.select("doc_id", path, S.sha256(changed).alias("sha256"))
    actual = t.documents.select(
        path, S.sha256(F.col("text")).alias("sha256"), F.octet_length("text").cast("bigint").alias("size_bytes")
    )
    return catalog.integrity(recorded, actual).select(
        "doc_id", F.col("actual_size_bytes").alias("size_bytes"), F.col("actual_sha256").alias("sha256"), "integrity_fail"
    )


@query()
def q_artifact_files(t: Tables) -> DataFrame:
    """Size and hash of the supplied files themselves (their names are not visible to SQL)."""
    return lineage.ingest_metrics(read_artifacts(t.spark, t.folder, "*.parquet"))


@query("""
SELECT c_custkey AS custkey,
  '{"codes":[' || c_nationkey || ',' || c_custkey || '],"nation":{"name":"' || n_name || '","region":"' || r_name
    || '"},"segment":"' || c_mktsegment || '"}' AS profile,
  '2026-03-12' AS ingest_date, '2026-03-12T08:15:00+00:00' AS retrieved_at_utc
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def q_stamp_flatten(t: Tables) -> DataFrame:
    """Nested customer profiles become JSON text with sorted keys; load columns are added."""
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")
    )
    place = F.struct(F.col("r_name").alias("region"), F.col("n_name").alias("name"))
    codes = F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey"))
    profile = F.struct(F.col("c_mktsegment").alias("segment"), place.alias("nation"), codes.alias("codes"))
    nested = rows.select(F.col("c_custkey").alias("custkey"), profile.alias("profile"))
    return shaping.stamp(shaping.flatten(nested), "2026-03-12", "2026-03-12T08:15:00+00:00")


@query("""
SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: contains(l, '|'))[1] AS first_table_line FROM documents
""")
def q_first_match_array(t: Tables) -> DataFrame:
    """First line of each document that holds a bar, null when none does."""
    lines = F.transform(
        F.split("text", "\n"), lambda x: F.struct(F.when(x.contains("|"), "en").alias("lang"), x.alias("value"))
    )
    first = S.first_where(lines, lambda d: d["lang"] == "en")["value"]
    return t.documents.select("doc_id", first.alias("first_table_line"))


# -- artifacts --------------------------------------------------------------------------------------


@query(r"""
WITH passes AS (
  SELECT 1 AS pass, page_id, url, html FROM pages UNION ALL SELECT 2, page_id, url, html FROM pages WHERE url LIKE 'http:%'),
named AS (
  SELECT pass, page_id, url, regexp_extract(url, '([^/]*)$', 1) AS artifact_name, regexp_extract(url, '/(\d+)', 1) AS number,
    sha256(html) AS sha256, length(html) AS size_bytes FROM passes),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY number, artifact_name, sha256 ORDER BY pass DESC, page_id DESC) AS rn
  FROM named WHERE artifact_name <> '')
SELECT 'ctu13_remote_pcap' AS source_id, nullif(number, '') AS scenario_number, url AS scenario_url, artifact_name,
  CASE WHEN regexp_matches(artifact_name, '^.+\.[^.]+$') THEN regexp_extract(artifact_name, '\.([^.]+)$', 1)
    ELSE 'unknown' END AS artifact_format,
  '' AS compression, false AS is_compressed, 'pass-' || pass AS retrieved_at_utc,
  CAST(CASE WHEN url LIKE '%.html' THEN 0 ELSE size_bytes END AS BIGINT) AS size_bytes, sha256,
  'raw/scenario=' || number || '/ingest_date=2026-03-11/' || artifact_name AS relative_landing_path,
  '2026-03-11' AS ingest_date
FROM ranked WHERE rn = 1
""")
def q_artifact_catalog(t: Tables) -> DataFrame:
    """Pages as landed artifacts, retrieved once or twice; the last entry per artifact stays."""
    url = F.col("url")
    name = F.regexp_extract(url, r"([^/]*)$", 1)
    number = F.regexp_extract(url, r"/(\d+)", 1)
    path = F.concat(F.lit("raw/scenario="), number, F.lit("/ingest_date=2026-03-11/"), name)

    def entries(pages: DataFrame, number_of_pass: int) -> DataFrame:
        entry = F.struct(
            number.alias("scenario_number"),
            url.alias("page_url"),
            name.alias("artifact_name"),
            path.alias("relative_landing_path"),
            S.sha256(F.col("html")).alias("sha256"),
            F.when(url.endswith(".html"), "n/a").otherwise(F.length("html").cast("string")).alias("size_bytes"),
            F.lit(f"pass-{number_of_pass}").alias("retrieved_at_utc"),
        )
        seq = F.struct(F.lit(number_of_pass).alias("pass"), F.col("page_id"))
        return pages.select(F.parse_json(F.to_json(entry)).alias("entry"), seq.alias("seq"))

    both = entries(t.pages, 1).unionByName(entries(t.pages.where(url.startswith("http:")), 2))
    rows = catalog.build_catalog(catalog.artifact_records(both, "2026-03-12T08:15:00+00:00"))
    return rows.select(
        "source_id", F.col("scenario_number").cast("string").alias("scenario_number"), "scenario_url", "artifact_name",
        "artifact_format", "compression", "is_compressed", "retrieved_at_utc", "size_bytes", "sha256",
        "relative_landing_path", "ingest_date",
    )


@query("""
WITH files AS (
  SELECT sha256(lang) AS sha256, n_chars, CAST(replace(source, 'src', '') AS BIGINT) AS number,
    source || CASE WHEN lang = 'fr' THEN '.pcap.bz2' WHEN lang = 'es' THEN '.txt' ELSE '.pcap' END AS artifact_name,
    '2026-01-' || lpad(CAST(1 + n_chars % 28 AS VARCHAR), 2, '0') AS ingest_date FROM documents),
latest AS (
  SELECT sha256, artifact_name, CASE WHEN number >= 5 THEN number END AS scenario, max(ingest_date) AS ingest_date
  FROM files WHERE n_chars <= 4000 AND (artifact_name LIKE '%.pcap' OR artifact_name LIKE '%.pcap.bz2') GROUP BY ALL)
SELECT sha256, artifact_name, CAST(scenario AS VARCHAR) AS scenario_number, ingest_date FROM latest
ORDER BY artifact_name LIKE '%.bz2', coalesce(scenario, 999999), ingest_date DESC, artifact_name, sha256 LIMIT 50
""")
def q_replay_candidates(t: Tables) -> DataFrame:
    """Documents as captures: compressed and plain ones up to a size, the latest per file, 50 to replay."""
    number = F.replace("source", F.lit("src")).cast("bigint")
    suffix = F.when(F.col("lang") == "fr", ".pcap.bz2").when(F.col("lang") == "es", ".txt").otherwise(".pcap")
    day = F.lpad((1 + F.col("n_chars") % 28).cast("string"), 2, "0")
    rows = t.documents.select(
        F.lit("docs").alias("source_id"),
        F.when(number >= 5, number).alias("scenario_number"),
        F.concat("source", suffix).alias("artifact_name"),
        S.sha256(F.col("lang")).alias("sha256"),
        F.col("n_chars").alias("size_bytes"),
        F.concat(F.lit("2026-01-"), day).alias("ingest_date"),
    )
    chosen = catalog.replay_candidates(rows, 50, allow_decompress=True, max_bytes=4000)
    return chosen.select("sha256", "artifact_name", F.col("scenario_number").cast("string"), "ingest_date")


RULES = [("hot_gear", r"hot gear\.pcap$"), ("red", "^red "), ("any_widget", r".*widget\.pcap$")]


@query("""
WITH files AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS scenario_number, p_name || '.pcap' AS artifact_name,
    CASE WHEN p_name = 'hot gear' THEN 0 WHEN p_name LIKE 'red %' THEN 1 WHEN p_name LIKE '%widget' THEN 2 END AS rule
  FROM part),
best AS (
  SELECT scenario_number, min((rule, artifact_name)) AS b FROM files WHERE rule IS NOT NULL GROUP BY scenario_number),
chosen AS (
  SELECT scenario_number, b[2] AS artifact_name, ['hot_gear', 'red', 'any_widget'][b[1] + 1] AS selection_rule FROM best)
SELECT 'all' AS mode, * FROM chosen
UNION ALL (SELECT 'first_successful', * FROM chosen ORDER BY scenario_number LIMIT 1)
""")
def q_rule_selection(t: Tables) -> DataFrame:
    """Per brand the file chosen by the first rule that matches, in both profile modes."""
    files = t.part.select(
        F.replace("p_brand", F.lit("Brand#")).cast("bigint").alias("scenario_number"),
        F.concat("p_name", F.lit(".pcap")).alias("artifact_name"),
    )
    listed = ", ".join(json.dumps({"label": label, "pattern": pattern}) for label, pattern in RULES)
    config = f'{{"profiles": {{"other": {{"mode": "all", "selection_rules": []}}, "main": {{"mode": "all", "selection_rules": [{listed}]}}}}}}'
    folder = work_dir(t.spark, "rules")
    t.region.limit(1).select(F.lit(config).alias("value")).write.text(folder)
    rules = profile_rules(read_selection_rules(t.spark, folder), "main")
    selected = catalog.select_artifacts(files, rules, ["scenario_number"])
    modes = [
        catalog.apply_mode(selected, mode).select(F.lit(mode).alias("mode"), "*") for mode in ("all", "first_successful")
    ]
    return modes[0].unionByName(modes[1])


LINKS = r"""
WITH tags AS (
  SELECT page_id, regexp_extract_all(
    regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
    '(?i)<a\s((?:[^>"'']+|"[^"]*"|''[^'']*'')*)>', 1) AS tags FROM pages),
hrefs AS (
  SELECT page_id, list_filter(list_transform(tags, lambda t: list_filter(list_transform(
    list_filter(regexp_extract_all(t, '([^\s=>/"'']+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+))?)', 1),
      lambda a: regexp_matches(a, '(?is)^href\s*=\s*')),
    lambda a: regexp_replace(regexp_replace(a, '(?is)^href\s*=\s*', ''), '^["'']|["'']$', '', 'g')),
    lambda v: v <> '')[1]), lambda h: h IS NOT NULL) AS hrefs FROM tags),
links AS (
  SELECT page_id, unnest(hrefs) AS href, CAST(generate_subscripts(hrefs, 1) - 1 AS BIGINT) AS pos FROM hrefs)
"""


@query(LINKS + "SELECT page_id, pos, href FROM links")
def q_links(t: Tables) -> DataFrame:
    links = catalog.extract_links(t.pages.select("page_id", "html"))
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    LINKS
    + r"""
SELECT DISTINCT page_id, regexp_extract(regexp_replace(trim(href), '(/\.)+$', ''), '([^/]*)$', 1) AS artifact_name FROM links
WHERE trim(href) <> '' AND trim(href) NOT LIKE '%/'
  AND regexp_extract(regexp_replace(trim(href), '(/\.)+$', ''), '([^/]*)$', 1) NOT IN ('', '.', '..')
"""
)
def q_listing(t: Tables) -> DataFrame:
    """Distinct file names linked from each page."""
    return catalog.list_files(catalog.extract_links(t.pages.select("page_id", "html")), ["page_id"])


@query(r"""
WITH found AS (
  SELECT CAST(regexp_extract(url, '^https?://[^/]+/[a-z]{2}/(\d+)', 1) AS BIGINT) AS scenario_number, url, page_id
  FROM pages WHERE regexp_matches(url, '^https?://[^/]+/[a-z]{2}/(\d+)'))
SELECT scenario_number, rtrim(arg_min(url, page_id), '/') AS scenario_directory, arg_min(url, page_id) AS scenario_url
FROM found WHERE scenario_number BETWEEN 100 AND 500 GROUP BY scenario_number
""")
def q_scenarios(t: Tables) -> DataFrame:
    """Page addresses as the links of one index: numbers in range, first link per number."""
    links = t.pages.select(
        F.col("url").alias("href"), F.col("page_id").alias("pos"), F.lit("https://index.example/").alias("page_url")
    )
    return catalog.discover_scenarios(links, r"https?://[^/]+/[a-z]{2}/(\d+)", 100, 500)


@query("""
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'skipped' ELSE 'to_land' END
  AS state FROM orders
""")
def q_skip_existing(t: Tables) -> DataFrame:
    """Orders with line items are landed already."""
    selected = t.orders.select(F.col("o_orderkey").alias("order_key"))
    return upsert.split_existing(selected, t.lineitem.select(F.col("l_orderkey").alias("order_key")), ["order_key"])


# -- seeds ------------------------------------------------------------------------------------------

SEED_SQL = r"""
WITH tokens AS (
  SELECT 0 AS origin, doc_id AS place, unnest(l) AS ip, generate_subscripts(l, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') AS l FROM documents)
  UNION ALL
  SELECT 1, page_id, unnest(l), generate_subscripts(l, 1) FROM (
    SELECT page_id, regexp_extract_all(html, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') AS l FROM pages)),
valid AS (
  SELECT * FROM tokens WHERE regexp_full_match(ip,
    '((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])'))
"""


def ip_tokens(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Valid IPv4 tokens of whole texts with the position they occur at."""
    from threatloom.functions.addresses import normalize_ipv4

    tokens = texts.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(IPV4_TOKEN), F.lit(0))).alias("pos", "token"))
    return tokens.select(
        normalize_ipv4(F.col("token")).alias("ip"), F.struct(F.col(key).alias("at"), F.col("pos")).alias("ord")
    )


@query(SEED_SQL + "SELECT ip FROM valid GROUP BY ip ORDER BY min((origin, place, pos)) LIMIT 50")
def q_seed_ips(t: Tables) -> DataFrame:
    """First 50 distinct addresses: those of the documents in order, then those of the pages."""
    feed, configured = ip_tokens(t.documents, "doc_id", "text"), ip_tokens(t.pages, "page_id", "html")
    return enrichment.seeds(feed, configured, 50).select("ip")


@query("""
SELECT count(*) AS rows_read, count(*) FILTER (l_discount > 0) AS rows_written,
  count(*) FILTER (l_discount = 0) AS rows_rejected, 'clean_lines' AS transformation_name, 'run-1' AS run_id
FROM lineitem
""")
def q_lineage(t: Tables) -> DataFrame:
    """Row counts observed while one job wrote its clean and its rejected rows."""
    job = lineage.Job(t.spark, "run-1", "trusted_zone", "lines", "clean_lines")
    target, log = work_dir(t.spark, "lines"), work_dir(t.spark, "lineage")
    rate = F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("rate")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", rate)
    split = writes.split_rejects(lines, ["rate"])
    job.told(read=split.read, rejected=split.refused)
    job.count("written", split.clean).write.parquet(f"{target}/clean")
    split.rejected.write.parquet(f"{target}/rejected")
    job.finish([f"{t.folder}/lineitem.parquet"], target, log)
    return t.spark.read.parquet(log).select(
        "rows_read", "rows_written", "rows_rejected", "transformation_name", "run_id"
    )
