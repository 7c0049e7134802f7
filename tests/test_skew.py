"""A third of all rows under one key: results stay whole, and no task gets the whole group."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threatloom.operators import events, exploitation, upsert

N = 120_000


@pytest.fixture
def small_tasks(spark):
    """Thresholds scaled down so that these rows count as large: no broadcast, small partitions."""
    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in scaled}
    for key, value in scaled.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, name):
    """``N`` rows in several map tasks, a third of them with key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select(key.alias(name), F.sha2(F.col("id").cast("string"), 256).alias("body"))


def was_split(df):
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_upsert_splits_a_hot_target_key(spark, small_tasks):
    source = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("new").alias("body"))
    merged = upsert.upsert(hot(spark, "k"), source, ["k"])
    counts = merged.groupBy("k").count()
    got = merged.collect()
    assert was_split(merged)
    # 334 of the 1000 batch keys (0, 3, 6, …) are only in the batch, except 0 itself.
    assert len(got) == N + 333
    assert counts.where("k = 0").first()["count"] == N // 3
    assert merged.where("k = 0 and body <> 'new'").count() == 0


def test_correlation_splits_a_hot_address(spark, small_tasks):
    log = hot(spark, "n").select(F.col("n").cast("string").alias("src_ip"), F.lit("x").alias("dst_ip"), "body")
    iocs = spark.range(0, 5000).select(
        F.lit("ip").alias("ioc_type"), F.col("id").cast("string").alias("value"), F.array(F.lit("f")).alias("sources"),
        F.array(F.lit("m")).alias("malware"),
    )
    matched = exploitation.correlate_ip(log, iocs)
    total = len(matched.collect())
    assert was_split(matched)
    assert total == N // 3 + len([i for i in range(5000) if i % 3])


def test_events_of_one_capture_are_split(spark, small_tasks):
    log = hot(spark, "k").select(F.col("k").cast("string").alias("artifact_sha256"), "body")
    artifacts = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("sha256"), F.lit("a.pcap").alias("artifact_name"), F.lit("2026-03-12").alias("ingest_date"),
        F.col("id").alias("scenario_number"), F.lit("p").alias("relative_landing_path"),
    )
    stamped = events.stamp_artifact(log, artifacts)
    assert len(stamped.collect()) == N
    assert was_split(stamped)


def test_hot_groups_are_reduced_before_the_shuffle(spark, small_tasks):
    log = hot(spark, "k").select(
        F.col("k").cast("string").alias("flow_id"), F.lit(1).cast("bigint").alias("severity"), F.col("body").alias("category"),
        F.lit(1).cast("bigint").alias("src_port"), F.lit(2).cast("bigint").alias("dst_port"),
    )
    features = exploitation.flow_features(log)
    assert features.where("flow_id = '0'").first()["event_count"] == N // 3
    kinds = hot(spark, "k").select(
        F.when(F.col("k") == 0, "hot").otherwise("cold").alias("replay_run_id"), F.lit("alert").alias("event_type")
    )
    assert rows(events.counts_per_run(kinds), "replay_run_id", "alert_events") == [("cold", 2 * N // 3), ("hot", N // 3)]
