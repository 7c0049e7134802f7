"""Load metrics of landed files and one lineage row per job."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threatloom.operators.shaping import keep_one, row_hash
from threatloom.schemas import LINEAGE


def ingest_metrics(artifacts: DataFrame, records: DataFrame | None = None, uncounted: Column | None = None) -> DataFrame:
    """Landed files with their record counts: 0 for a file that gave none, null for one whose rows are not read."""
    if records is None:
        return artifacts.withColumn("record_count", F.lit(None).cast("bigint"))
    counts = records.groupBy(_bare(F.col("file_path")).alias("_bare")).agg(F.count("*").alias("_n"))
    joined = artifacts.withColumn("_bare", _bare(F.col("path"))).join(counts, "_bare", "left").drop("_bare")
    count = F.coalesce("_n", F.lit(0).cast("bigint"))
    if uncounted is not None:
        count = F.when(~uncounted, count)
    return joined.withColumn("record_count", count).drop("_n")


def _bare(path: Column) -> Column:
    """A path without its scheme: local files are listed as ``file:/`` by one reader and as ``file:///`` by another."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def sidecar_metrics(artifacts: DataFrame, sidecars: DataFrame) -> DataFrame:
    """One row per landed file: what was measured, and what its sidecar tells of source, request, time, pages and records.

    ``artifacts`` have ``relative_landing_path``, measured size and hash; the sidecar is found by that path. A file
    without a sidecar stays, with nulls; ``recorded_differently`` says that recorded and measured hash differ. Of
    several sidecars for one path the last retrieved counts.
    """
    fields = ["source_id", "retrieved_at_utc", "page_index", "offset", "results_per_page", "total_results", "record_count"]
    told = sidecars.select(
        "relative_landing_path", *fields, F.coalesce("request_url", "source_url").alias("url"), F.col("sha256").alias("recorded_sha256")
    )
    one = keep_one(told, ["relative_landing_path"], F.col("retrieved_at_utc").desc_nulls_last(), row_hash(told))
    joined = artifacts.drop("record_count", "source").join(one, "relative_landing_path", "left")
    differs = F.coalesce(F.col("recorded_sha256") != F.col("sha256"), F.lit(False))
    return joined.withColumnRenamed("source_id", "source").withColumn("recorded_differently", differs)


def load_counts(records: DataFrame, group: list[str]) -> DataFrame:
    """Records and pages per run."""
    return records.groupBy(*group).agg(
        F.count("*").alias("records"), F.count_distinct("page").alias("pages")
    )


class Job:
    """Counts rows on their way through one job and appends its lineage row."""

    def __init__(self, spark: SparkSession, run_id: str, dag_id: str, task_id: str, name: str):
        self.spark, self.ids, self.name = spark, (run_id, dag_id, task_id), name
        self.started = datetime.now(UTC)
        self.seen = {role: Observation() for role in ("read", "written", "rejected")}
        self.used: set[str] = set()
        self.known: dict[str, int] = {}

    def count(self, role: str, df: DataFrame) -> DataFrame:
        """Pass ``df`` through, counting its rows as ``read``, ``written`` or ``rejected``."""
        self.used.add(role)
        return df.observe(self.seen[role], F.count(F.lit(1)).alias("rows"))

    def told(self, **rows: int) -> None:
        """Counts that an earlier step of the job has made, by role."""
        self.known |= rows

    def rows(self, role: str) -> int:
        return self.seen[role].get["rows"] if role in self.used else self.known.get(role, 0)

    def record(self, source_paths: list[str], target_path: str) -> DataFrame:
        row = (
            *self.ids,
            source_paths,
            target_path,
            self.name,
            *[self.rows(role) for role in ("read", "written", "rejected")],
            self.started,
            datetime.now(UTC),
        )
        return self.spark.createDataFrame([row], LINEAGE)

    def finish(self, source_paths: list[str], target_path: str, lineage_path: str) -> None:
        self.record(source_paths, target_path).coalesce(1).write.mode("append").parquet(lineage_path)
