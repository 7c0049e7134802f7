"""Capture artifacts: discovery from index pages, selection by rules, catalog rows, replay candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.functions.links import decode_entities, raw_hrefs
from threatloom.operators.shaping import keep_one
from threatloom.schemas import ARTIFACT, ARTIFACT_KEYS

# Defaults that appear in stored rows.
DEFAULT_SOURCE_ID = "ctu13_remote_pcap"
LAST_SCENARIO = 999999
FIRST_SCENARIO = -1


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(…, pos, href)``: the links of each page in document order."""
    rest = [c for c in pages.columns if c != html]
    links = pages.select(*rest, F.posexplode(raw_hrefs(F.col(html))).alias("pos", "href"))
    return links.withColumn("href", decode_entities(F.col("href")))


def discover_scenarios(links: DataFrame, pattern: str, start: int, end: int, root: str = "page_url") -> DataFrame:
    """Scenario folders named by links: number in range, first link per number in document order."""
    found = links.select(
        F.regexp_extract("href", rf"^(?:{pattern})", 1).try_cast("bigint").alias("scenario_number"),
        "href",
        "pos",
        F.col(root).alias("page_url"),
    ).where(F.col("scenario_number").between(start, end))
    first = found.groupBy("scenario_number").agg(
        F.min_by(F.struct("href", "page_url"), F.struct("pos", "page_url")).alias("first")
    )
    return first.select(
        "scenario_number",
        F.rtrim(F.col("first.href"), F.lit("/")).alias("scenario_directory"),
        S.url_join(F.col("first.page_url"), F.col("first.href")).alias("scenario_url"),
    )


def list_files(links: DataFrame, group: list[str]) -> DataFrame:
    """Distinct file names linked from each page; folders and dot names are left out."""
    href = S.strip(F.col("href"))
    name = F.regexp_extract(F.regexp_replace(href, r"(?:/\.)+$", ""), r"([^/]*)$", 1)
    return (
        links.where((href != "") & ~href.endswith("/"))
        .select(*group, name.alias("artifact_name"))
        .where(~F.col("artifact_name").isin("", ".", ".."))
        .distinct()
    )


def select_artifacts(files: DataFrame, rules: list[tuple[str, str]], group: list[str]) -> DataFrame:
    """Per group the smallest file name of the first rule that matches anything; no match, no row.

    The ordered rules become one expression giving the first rule each name matches. The least
    ``(rule, name)`` per group is then the answer, found by a partial aggregate: the first rule with any
    match in a group is also the least first-match among its files.
    """
    first_rule = F.coalesce(
        *[
            F.when(F.col("artifact_name").rlike(rf"^(?:{pattern})"), F.lit(i))
            for i, (_, pattern) in enumerate(rules)
        ]
    )
    labels = F.element_at(F.array(*[F.lit(label) for label, _ in rules]), F.col("best.rule") + 1)
    return (
        files.select(*group, "artifact_name", first_rule.alias("rule"))
        .where(F.col("rule").isNotNull())
        .groupBy(*group)
        .agg(F.min(F.struct("rule", "artifact_name")).alias("best"))
        .select(*group, F.col("best.artifact_name").alias("artifact_name"), labels.alias("selection_rule"))
    )


def apply_mode(selected: DataFrame, mode: str) -> DataFrame:
    """``first_successful`` keeps the lowest scenario only; ``all`` keeps every scenario."""
    return selected.orderBy("scenario_number").limit(1) if mode == "first_successful" else selected


def artifact_records(entries: DataFrame, cataloged_at_utc: str) -> DataFrame:
    """Catalog rows of manifest entries (VARIANT ``entry``); entries without name, path or hash are dropped."""
    entry = F.col("entry")

    def text(name):
        return S.safe_str(entry, f"$.{name}")

    name, path = text("artifact_name"), text("relative_landing_path")
    columns = {
        "source_id": F.coalesce(S.non_empty(text("source_id")), F.lit(DEFAULT_SOURCE_ID)),
        "scenario_number": S.safe_int(entry, "$.scenario_number"),
        "scenario_url": F.coalesce(S.non_empty(text("scenario_url")), text("page_url")),
        "artifact_format": S.artifact_format(name),
        "compression": S.compression(name),
        "is_compressed": S.is_compressed(name),
        "cataloged_at_utc": F.lit(cataloged_at_utc),
        "size_bytes": S.safe_int(entry, "$.size_bytes", 0),
        "ingest_date": F.coalesce(S.non_empty(text("ingest_date")), S.path_part(path, "ingest_date")),
    }
    rows = entries.select(
        *[columns.get(c, text(c)).alias(c) for c in ARTIFACT.names],
        *[c for c in entries.columns if c == "seq"],
    )
    complete = (F.col("artifact_name") != "") & (F.col("relative_landing_path") != "") & (F.col("sha256") != "")
    return rows.where(complete)


def build_catalog(records: DataFrame) -> DataFrame:
    """One row per artifact key; of several entries the last one in manifest order."""
    return keep_one(records, ARTIFACT_KEYS, F.col("seq").desc()).drop("seq")


def catalog_order():
    scenario = F.coalesce("scenario_number", F.lit(FIRST_SCENARIO))
    return [F.col("source_id"), scenario, F.col("artifact_name"), F.col("ingest_date")]


def in_catalog_order(catalog: DataFrame) -> DataFrame:
    """The catalog dealt and sorted by source, scenario (none first), name and date: written, its files are in order."""
    order = [*catalog_order(), F.col("sha256")]
    return catalog.repartitionByRange(*order).sortWithinPartitions(*order)


def replay_candidates(
    catalog: DataFrame, max_artifacts: int, allow_decompress: bool, max_bytes: int | None = None
) -> DataFrame:
    """The artifacts to replay: latest row per file, plain captures first, at most ``max_artifacts``.

    Name and size are tested before the latest row is picked, so an oversized latest copy does not hide an
    older one that fits.
    """
    name = F.col("artifact_name")
    plain = name.endswith(".pcap")
    wanted = plain | name.endswith(".pcap.bz2") if allow_decompress else plain
    if max_bytes is not None:
        wanted = wanted & (F.coalesce("size_bytes", F.lit(0)) <= max_bytes)
    newest = S.sort_date_value(F.col("ingest_date")).desc()
    latest = keep_one(catalog.where(wanted), ["sha256", "artifact_name"], newest, *catalog_order())
    return latest.orderBy(
        F.when(plain, 0).otherwise(1),
        F.coalesce("scenario_number", F.lit(LAST_SCENARIO)),
        newest,
        name,
        F.col("sha256"),
    ).limit(max_artifacts)


def integrity(catalog: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Catalog rows with ``integrity_fail`` where the recomputed hash differs from the recorded one."""
    measured = {"sha256": "actual_sha256", "size_bytes": "actual_size_bytes"}
    actual = recomputed.select(
        "relative_landing_path", *[F.col(c).alias(name) for c, name in measured.items() if c in recomputed.columns]
    )
    return catalog.join(actual, "relative_landing_path", "left").withColumn(
        "integrity_fail", F.coalesce(F.col("actual_sha256") != F.col("sha256"), F.lit(False))
    )


def assert_integrity(checked: DataFrame) -> DataFrame:
    """Stop the job on the first artifact whose hash differs (before a replay)."""
    broken = F.raise_error(F.concat(F.lit("Checksum mismatch: "), F.col("relative_landing_path")))
    return checked.withColumn("sha256", F.when(F.col("integrity_fail"), broken).otherwise(F.col("sha256")))
