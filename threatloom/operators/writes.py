"""Sinks: snapshot tables, append tables, partition replacement, JSON logs, message envelopes."""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threatloom.functions import scalars as S
from threatloom.operators.upsert import upsert, upsert_known
from threatloom.session import work_dir
from threatloom.sources.lines import MANIFEST_PATH

SNAPSHOT = "snapshot="
# Fixed value: how Spark names the folder of a null or empty partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Merged partitions wait in such a folder of the table, which readers do not see; the marker says that they are in force.
MERGE, IN_FORCE = "_merge-", "_IN_FORCE"
# Moving takes renames only; a merge that is not over so long after its marker was set has lost its driver.
LOST_AFTER_SECONDS = 600


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where, hadoop


def complete_folders(spark: SparkSession, path: str, prefix: str = SNAPSHOT) -> list[str]:
    """Complete snapshots of a table, oldest first. A snapshot without its success marker does not exist."""
    files, where, hadoop = _filesystem(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(
        n for n in names if n.startswith(prefix) and files.exists(hadoop.Path(f"{path}/{n}/_SUCCESS"))
    )


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    found = complete_folders(spark, path)
    return f"{path}/{found[-1]}" if found else None


def table_exists(spark: SparkSession, path: str) -> bool:
    files, where, _ = _filesystem(spark, path)
    return bool(files.exists(where) and len(files.listStatus(where)))


def balanced(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows arranged by partition columns into files of even size.

    A date that holds most rows is split over many tasks, small dates share one.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a whole table as the next snapshot. Readers move to it once it is complete."""
    spark = df.sparkSession
    found = complete_folders(spark, path)
    number = int(found[-1].split("=")[1].split("-")[0]) + 1 if found else 0
    target = f"{path}/{SNAPSHOT}{number:08d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return target


def table_root(spark: SparkSession, path: str) -> str:
    """Where the files of a table lie: its newest complete snapshot, or the folder itself."""
    return current_snapshot(spark, path) or path


class ChangedTable(RuntimeError):
    """Another job has changed the partitions of a merge while it ran; the merge has changed nothing."""


def _partition_folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders ``a=1/b=2`` below ``root``, ``depth`` levels deep."""
    files, _, hadoop = _filesystem(spark, root)
    found = [""]
    for _ in range(depth):
        below = []
        for folder in found:
            names = [s.getPath().getName() for s in files.listStatus(hadoop.Path(f"{root}/{folder}")) if s.isDirectory()]
            below += [f"{folder}/{n}".strip("/") for n in names if "=" in n and not n.startswith(("_", "."))]
        found = below
    return found


def _content(spark: SparkSession, root: str, folders: list[str]) -> list[tuple]:
    """What tells whether partitions have changed: their files with sizes and times."""
    files, _, hadoop = _filesystem(spark, root)
    found = []
    for folder in folders:
        where = hadoop.Path(f"{root}/{folder}")
        if files.exists(where):
            found += [(folder, s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(where)]
    return sorted(found)


def _values_of(folder: str) -> tuple[str | None, ...]:
    values = [unquote(part.split("=", 1)[1]) for part in folder.split("/")]
    return tuple(None if v == NO_VALUE else v for v in values)


def _put_in_force(spark: SparkSession, root: str, waiting: str) -> None:
    """Move the partitions of a finished merge to their places. Whatever is left of them is moved by the next call."""
    files, _, hadoop = _filesystem(spark, root)
    depth = int(waiting.split("-")[1])
    for folder in _partition_folders(spark, f"{root}/{waiting}", depth):
        place = hadoop.Path(f"{root}/{folder}")
        files.delete(place, True)
        files.mkdirs(place.getParent())
        if not files.rename(hadoop.Path(f"{root}/{waiting}/{folder}"), place):
            raise RuntimeError(f"cannot move {waiting}/{folder} to its place in {root}")
    files.delete(hadoop.Path(f"{root}/{waiting}"), True)


def finish_merges(spark: SparkSession, root: str, writing: bool = False) -> None:
    """Complete a merge whose driver was lost while its partitions were moved.

    One that may still be moving is left to its own driver; a writer stops then.
    """
    files, where, hadoop = _filesystem(spark, root)
    if not files.exists(where):
        return
    for name in [s.getPath().getName() for s in files.listStatus(where)]:
        marker = hadoop.Path(f"{root}/{name}/{IN_FORCE}")
        if name.startswith(MERGE) and files.exists(marker):
            if time.time() - files.getFileStatus(marker).getModificationTime() / 1000 >= LOST_AFTER_SECONDS:
                _put_in_force(spark, root, name)
            elif writing:
                raise ChangedTable(f"another merge into {root} is being put in force; run the merge again")


def _merge_partitions(source: DataFrame, root: str, keys: list[str], partition_by: list[str]) -> None:
    """Merge a stored batch into the partitions that it touches: those of its rows and those of the rows it updates.

    The target is read twice: its key columns, to find matches and their partitions, and then the touched partitions.
    Spark joins the keys by broadcast of a small batch, or else by shuffle with a Bloom filter of the batch on the scan.
    New partitions are written beside the old ones and moved when all are complete; if the old ones have changed in
    the meantime, nothing is moved. A batch that brings new columns or types touches every partition, so all files of
    a table keep one schema. On the driver are folder names only, as in Spark's own listing.
    """
    spark = source.sparkSession
    finish_merges(spark, root, writing=True)
    depth = len(partition_by)
    existing = _partition_folders(spark, root, depth)
    target = spark.read.option("basePath", root).parquet(root)
    casts = {name: F.col(name).cast(source.schema[name].dataType) for name in partition_by}
    key_columns = {k: F.col(k).cast(target.schema[k].dataType) for k in keys if k not in partition_by}
    folder = F.array_join(F.slice(F.split("_metadata.file_path", "/"), -1 - depth, depth), "/")
    placed = target.select(*[casts.get(k, F.col(k)).alias(k) for k in keys], folder.alias("_folder"))
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    batch_keys = source.withColumns(key_columns).where(present).select(*keys).distinct()
    stored = work_dir(spark, "matched")
    placed.join(batch_keys, keys, "left_semi").write.parquet(stored)
    matched = spark.read.schema(placed.schema).parquet(stored)
    touched = {unquote(r["_folder"]) for r in matched.select("_folder").distinct().collect()}
    own = source.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()
    values = {tuple(v or None for v in r) for r in own}
    touched |= {f for f in existing if _values_of(f) in values}
    empty = spark.createDataFrame([], target.schema)
    plain = [c for c in target.columns if c not in partition_by]
    kinds = upsert_known(empty.withColumns(casts), source, batch_keys.limit(0), keys).schema
    if {(f.name, f.dataType.simpleString()) for f in kinds if f.name not in partition_by} != {(c, target.schema[c].dataType.simpleString()) for c in plain}:
        touched = set(existing)
    before = _content(spark, root, sorted(touched))
    base = spark.read.schema(target.schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in sorted(touched)]) if touched else empty
    merged = upsert_known(base.withColumns(casts), source, matched, keys)
    waiting = f"{MERGE}{depth}-{uuid.uuid4().hex}"
    balanced(merged, partition_by).write.partitionBy(*partition_by).parquet(f"{root}/{waiting}")
    files, _, hadoop = _filesystem(spark, root)
    for name in touched - set(_partition_folders(spark, f"{root}/{waiting}", depth)):
        files.mkdirs(hadoop.Path(f"{root}/{waiting}/{name}"))  # all its rows have moved
    if _content(spark, root, sorted(touched)) != before:
        files.delete(hadoop.Path(f"{root}/{waiting}"), True)
        raise ChangedTable(f"{root} was changed while a batch was merged into it; run the merge again")
    files.create(hadoop.Path(f"{root}/{waiting}/{IN_FORCE}")).close()
    _put_in_force(spark, root, waiting)


def write_or_merge(
    source: DataFrame, path: str, merge_keys: list[str] | None, partition_by: list[str] | None = None
) -> int:
    """Upsert (keys given) or append (``None``) one batch; creates the table on first use.

    Returns the batch size. An empty batch writes nothing. The first write keeps duplicate keys. A partitioned table
    has only the partitions rewritten that the batch touches; one without partitions is one, so it is rewritten whole.

    A batch to merge is stored in the shared work folder first: the merge reads it several times, and must
    neither scan and parse the landing again nor see other values (ids made by ``uuid``) when it does.
    """
    if merge_keys is not None and not merge_keys:
        raise ValueError("merge_keys must be None or name at least one column")
    spark = source.sparkSession
    if merge_keys is None:
        return 0 if source.isEmpty() else append(source, path, partition_by)
    batch = work_dir(spark, "batch")
    size = append(source, batch)
    if not size:
        return 0
    source = spark.read.schema(source.schema).parquet(batch)
    if not table_exists(spark, path):
        if partition_by:
            balanced(source, partition_by).write.partitionBy(*partition_by).parquet(path)
        else:
            write_snapshot(source, path)
    elif partition_by:
        _merge_partitions(source, table_root(spark, path), merge_keys, partition_by)
    else:
        write_snapshot(upsert(spark.read.parquet(table_root(spark, path)), source, merge_keys), path)
    return size


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Append rows and return how many, counted by the write itself."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["rows"]


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; the others stay."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Write one partition anew, also when there is nothing to write.

    The new files are complete before the old ones go: Spark writes them beside the partition and swaps at the commit.
    """
    seen = Observation()
    rows = df.drop(column).observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(column, F.lit(value))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    if not seen.get["rows"]:
        df.drop(column).limit(0).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def _marked(df: DataFrame, mandatory: list[str]) -> DataFrame:
    missing = F.concat_ws(
        ",", *[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in mandatory]
    )
    return df.withColumn("_reject_reason", missing)


class Split(NamedTuple):
    """Rows with all mandatory fields, the others with the names of the missing ones, and how many there are."""

    clean: DataFrame
    rejected: DataFrame
    read: int
    refused: int


def split_rejects(df: DataFrame, mandatory: list[str]) -> Split:
    """Set rows without a mandatory field aside, in one pass over ``df``.

    One write to the shared work folder, partitioned by a reject flag, counts the rows and stores them; each side is
    then a scan of its own rows alone, however often it is read, and the source is not read or parsed again.
    """
    spark, seen = df.sparkSession, Observation()
    refused = F.col("_reject_reason") != ""
    marked = _marked(df, mandatory).withColumn("_refused", refused)
    counts = [F.count(F.lit(1)).alias("read"), F.count_if("_refused").alias("refused")]
    folder = work_dir(spark, "split")
    marked.observe(seen, *counts).write.partitionBy("_refused").parquet(folder)
    stored = spark.read.schema(marked.schema).parquet(folder)
    clean = stored.where(~F.col("_refused")).drop("_refused", "_reject_reason")
    return Split(clean, stored.where("_refused").drop("_refused"), seen.get["read"], seen.get["refused"])


def sorted_json(df: DataFrame, names: list[str] | None = None) -> Column:
    """A row as JSON text with its columns in name order; nulls are written."""
    columns = sorted(names or df.columns)
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def write_json_log(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """JSON lines with sorted keys under hive folders, replacing the folders that occur."""
    ordered = df.select(*sorted(c for c in df.columns if c not in partition_by), *partition_by)
    (
        balanced(ordered, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy(*partition_by)
        .json(path)
    )


def append_manifest(entries: DataFrame, root: str, source_id: str) -> None:
    """Append entries (JSON text ``line``, ``ingest_date``) to the manifest of their date.

    Nothing is rewritten: the manifest of a source and date is a folder of line files in writing order, and
    ``merge_manifest`` gives the last entry per identity at its first position when it is read.
    """
    folder = MANIFEST_PATH.split("/ingest_date=")[0]
    lines = entries.select(F.col("line").alias("value"), "ingest_date", F.lit(f"{source_id}.jsonl").alias("of"))
    lines.write.mode("append").partitionBy("ingest_date", "of").text(f"{root}/{folder}")


def envelope(df: DataFrame, topic: str) -> DataFrame:
    """``(key, value, topic)`` messages: key by run, artifact or flow; value is the record as sorted JSON."""
    parts = [F.col(c).cast("string") for c in ("replay_run_id", "artifact_sha256", "flow_id") if c in df.columns]
    key = S.message_key(*parts) if parts else F.lit(None).cast("string")
    return df.select(key.alias("key"), sorted_json(df).alias("value"), F.lit(topic).alias("topic"))


def publish(df: DataFrame, topic: str, servers: str | None = None, path: str | None = None, strict: bool = True) -> int:
    """Send envelopes to Kafka, or to JSON files under ``path``; returns the count.

    With ``strict`` off a failed send counts 0 instead of stopping the job.
    """
    seen = Observation()
    messages = envelope(df, topic).observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        if servers:
            messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        else:
            messages.write.mode("append").partitionBy("topic").json(path)
    except Exception:
        if strict:
            raise
        return 0
    return seen.get["rows"]
