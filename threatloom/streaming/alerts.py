"""Alert and event streams: enrichment, windowed counts, deduplication, pass-through."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threatloom.functions import scalars as S
from threatloom.operators.exploitation import enrich_alerts
from threatloom.operators.shaping import told
from threatloom.operators.writes import complete_folders, envelope
from threatloom.schemas import ALERT

# Fixed value: the interval of the warm path. The folder names and the bounds of a trigger are our choice.
MICRO_BATCH = "10 seconds"
BATCH = "batch="
OFFSETS_PER_TRIGGER, FILES_PER_TRIGGER = 5_000_000, 1_000
# How long after its arrival an event is remembered, and where: on the executors' disks, not in their heaps.
REMEMBERED = "7 days"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_topic(spark: SparkSession, servers: str, topic: str, schema: T.StructType = ALERT) -> DataFrame:
    """Records of a Kafka topic; needs the Kafka connector on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", OFFSETS_PER_TRIGGER)
        .load()
    )
    return told(messages.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*"))


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json", files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """The same records from files landed anywhere below ``path``, as they arrive; broken lines are skipped.

    Producers use different folder layouts, so of folder names only a load date is taken, where the record has none.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    rows = told(reader.option("recursiveFileLookup", True).format(file_format).load(path))
    if "ingest_date" not in schema.names:
        return rows
    of_path = S.non_empty(S.path_part(F.col("_metadata.file_path"), "ingest_date"))
    return rows.withColumn("ingest_date", F.coalesce("ingest_date", of_path))


def with_event_time(stream: DataFrame, column: str) -> DataFrame:
    """Add ``ts`` from a text or zone-less time column.

    Captures are replayed in any order, so no lateness is assumed: nothing here or below drops a late row. A row
    without a readable time gets the sentinel time and the flag ``ts_malformed``.
    """
    ts = F.col(column).try_cast("timestamp")
    sentinel = F.lit(S.SENTINEL_TIMESTAMP).cast("timestamp")
    return stream.withColumns({"ts_malformed": ts.isNull(), "ts": F.coalesce(ts, sentinel)})


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": MICRO_BATCH}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger)


def append_to(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append rows to a Parquet table; the checkpoint makes every row appear once."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    return _start(writer, checkpoint, available_now).start(path)


def counts_to(
    stream: DataFrame, width: str, dimensions: list[str], path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write each micro-batch's partial counts per window and dimension to ``batch=<id>``; they are summed on read.

    No state is held between micro-batches, so a window may receive rows at any time. A replayed micro-batch
    overwrites its own folder, so a restart never doubles anything.
    """

    def write(rows: DataFrame, batch: int) -> None:
        window_counts(rows, width, dimensions).write.mode("overwrite").parquet(f"{path}/{BATCH}{batch}")

    return _start(stream.writeStream.foreachBatch(write), checkpoint, available_now).start()


def total_counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Counts per window and dimension over all completely written micro-batches of ``counts_to``."""
    newest = max((int(name.removeprefix(BATCH)) for name in complete_folders(spark, path, BATCH)), default=-1)
    if newest < 0:
        raise ValueError(f"no counts under {path}")
    rows = spark.read.option("basePath", path).parquet(f"{path}/{BATCH}*").where(F.col("batch") <= newest)
    return rows.groupBy(*keys).agg(F.sum("alerts").alias("alerts"))


def first_to(
    stream: DataFrame, keys: list[str], path: str, checkpoint: str, within: str = REMEMBERED, available_now: bool = False
) -> StreamingQuery:
    """Append each event once: the first row per key that arrives, whatever its event time.

    Spark's keyed state remembers the keys. It is bounded by arrival, not by event time: a key is forgotten ``within``
    after its row arrived, so captures may be replayed in any order and no row is late. A repeat that arrives later
    still is stored again; the trusted zone drops it (``dedup_events``). A micro-batch reads its own rows and the state,
    never what was written before; state and rows are committed together. Null keys equal each other.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    arriving = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return append_to(arriving.dropDuplicatesWithinWatermark(keys).drop("_arrived"), path, checkpoint, available_now)


def warm_enrichment(alerts: DataFrame, vulns: DataFrame) -> DataFrame:
    """Alerts joined to the static vulnerability table by the CVE in their signature."""
    return enrich_alerts(alerts, vulns)


def window_counts(rows: DataFrame, width: str, dimensions: list[str]) -> DataFrame:
    """Rows per tumbling window and dimension; with no dimension, alerts per window."""
    window = F.window("ts", width).alias("w")
    counted = rows.groupBy(window, *dimensions).agg(F.count("*").alias("alerts"))
    return counted.select(F.col("w.start").alias("window_start"), *dimensions, "alerts")


def pass_through(stream: DataFrame, topic: str) -> DataFrame:
    """Events as unchanged messages."""
    return envelope(stream, topic)
