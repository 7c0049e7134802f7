import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from threatloom.operators import catalog, enrichment, events, exploitation, shaping, trusted, upsert, writes
from threatloom.schemas import TRUSTED_COLUMNS
from threatloom.sources.files import read_in_order, read_table


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# -- upsert -----------------------------------------------------------------------------------------


def test_upsert_fixture(spark):
    target = frame(spark, "k int, a string, b string", (1, "x", "p"), (2, "y", "q"), (None, "m", "r"))
    source = frame(spark, "k int, a string", (1, None), (3, "z"), (None, "n"))
    assert rows(upsert.upsert(target, source, ["k"])) == [
        (1, None, "p"),
        (2, "y", "q"),
        (3, "z", None),
        (None, "m", "r"),
        (None, "n", None),
    ]


def test_upsert_updates_every_duplicate_target_row(spark):
    target = frame(spark, "k int, a string", (1, "x"), (1, "y"), (2, "z"))
    assert rows(upsert.upsert(target, frame(spark, "k int, a string", (1, "n")), ["k"])) == [(1, "n"), (1, "n"), (2, "z")]


def test_upsert_rejects_bad_input(spark):
    target = frame(spark, "k int, a string", (1, "x"))
    with pytest.raises(ValueError, match="key"):
        upsert.upsert(target, target, [])
    with pytest.raises(Exception, match="duplicate source key"):
        upsert.upsert(target, frame(spark, "k int, a string", (1, "a"), (1, "b")), ["k"]).collect()


KEYED = st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.sampled_from("abc")), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYED, KEYED)
def test_upsert_laws(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, a string")
    s = spark.createDataFrame(list(source.items()), "k int, a string")
    once = upsert.upsert(t, s, ["k"])
    assert rows(upsert.upsert_known(t, s, t.join(s, "k", "left_semi"), ["k"])) == rows(once)
    assert dict(rows(once)) == {**target, **source}
    assert rows(upsert.upsert(once, s, ["k"])) == rows(once)


def test_upsert_does_not_shuffle_the_target_for_a_small_batch(spark):
    target = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    source = frame(spark, "k bigint, a string", (1, "y"))
    merged = upsert.upsert(target, source, ["k"])
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]


def test_write_or_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, "k int, v string, ingest_date string", (1, "a", "2026-01-01"), (1, "b", "2026-01-01"))
    assert writes.write_or_merge(first.limit(0), path, ["k"], ["ingest_date"]) == 0
    assert not writes.table_exists(spark, path)
    assert writes.write_or_merge(first, path, ["k"], ["ingest_date"]) == 2
    assert rows(read_table(spark, path), "k", "v") == [(1, "a"), (1, "b")]
    second = frame(spark, "k int, v string, ingest_date string", (1, "c", "2026-01-02"), (2, "d", "2026-01-02"))
    assert writes.write_or_merge(second, path, ["k"], ["ingest_date"]) == 2
    assert rows(read_table(spark, path), "k", "v", "ingest_date") == [
        (1, "c", "2026-01-02"),
        (1, "c", "2026-01-02"),
        (2, "d", "2026-01-02"),
    ]
    assert read_table(spark, path, "2026-01-01").count() == 0
    with pytest.raises(ValueError):
        writes.write_or_merge(first, path, [])


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_merge_rewrites_the_touched_partitions_only(spark, tmp_path):
    path = tmp_path / "t"
    schema = "k int, v string, own string, ingest_date string"
    whole = frame(spark, schema, *[(i, "a", "x", f"2026-01-0{1 + i % 5}") for i in range(50)])
    assert writes.write_or_merge(whole, str(path), ["k"], ["ingest_date"]) == 50
    before = files_of(path)
    writes.write_or_merge(frame(spark, "k int, v string, ingest_date string", (7, "b", "2026-01-03")), str(path), ["k"], ["ingest_date"])
    after = files_of(path)
    assert {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)} == {f for f in before.keys() | after.keys() if "01-03" in f}
    got = {r["k"]: (r["v"], r["own"], r["ingest_date"]) for r in read_table(spark, str(path)).collect()}
    assert len(got) == 50 and got[7] == ("b", "x", "2026-01-03") and got[8] == ("a", "x", "2026-01-04")
    # A row that moves touches the partition it leaves and the one it goes to; a new key touches its own alone.
    before = files_of(path)
    moved = frame(spark, "k int, v string, ingest_date string", (0, "c", "2026-02-01"), (99, "d", None))
    writes.write_or_merge(moved, str(path), ["k"], ["ingest_date"])
    after = files_of(path)
    changed = {f.split("/")[0] for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed == {"ingest_date=2026-01-01", "ingest_date=2026-02-01", "ingest_date=__HIVE_DEFAULT_PARTITION__"}
    got = {r["k"]: (r["v"], r["own"], r["ingest_date"]) for r in read_table(spark, str(path)).collect()}
    assert len(got) == 51 and got[0] == ("c", "x", "2026-02-01") and got[99] == ("d", None, None)


def test_a_partition_whose_rows_all_move_is_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, ingest_date string"
    writes.write_or_merge(frame(spark, schema, (1, "a", "2026-01-01"), (2, "b", "2026-01-02")), path, ["k"], ["ingest_date"])
    writes.write_or_merge(frame(spark, schema, (1, "c", "2026-01-02")), path, ["k"], ["ingest_date"])
    assert rows(read_table(spark, path), "k", "v", "ingest_date") == [(1, "c", "2026-01-02"), (2, "b", "2026-01-02")]
    writes.write_or_merge(frame(spark, schema, (1, "d", "2026-01-01")), path, ["k"], ["ingest_date"])
    assert rows(read_table(spark, path), "k", "v", "ingest_date") == [(1, "d", "2026-01-01"), (2, "b", "2026-01-02")]


def test_new_columns_reach_every_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    writes.write_or_merge(frame(spark, "k int, v int, ingest_date string", (1, 1, "2026-01-01"), (2, 2, "2026-01-02")), path, ["k"], ["ingest_date"])
    writes.write_or_merge(frame(spark, "k int, v long, w string, ingest_date string", (2, 1 << 40, "n", "2026-01-02")), path, ["k"], ["ingest_date"])
    assert rows(read_table(spark, path), "k", "v", "w") == [(1, 1, None), (2, 1 << 40, "n")]


def test_two_partition_columns_with_odd_values(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, kind string, ingest_date string"
    first = [("a", 1, "x/y", "2026-01-01"), ("b", 2, "p q=%", "2026-01-01"), (None, 3, "", "2026-01-02"), ("d", 4, "07", "2026-01-02")]
    writes.write_or_merge(frame(spark, schema, *first), path, ["k"], ["kind", "ingest_date"])
    writes.write_or_merge(frame(spark, schema, ("b", 5, "p q=%", "2026-01-01"), (None, 6, None, "2026-01-02"), ("d", 7, "x/y", "2026-01-01")), path, ["k"], ["kind", "ingest_date"])
    assert sorted(r["v"] for r in read_table(spark, path).collect()) == [1, 3, 5, 6, 7]


def test_a_changed_base_stops_the_merge(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = "k int, v string, ingest_date string"
    writes.write_or_merge(frame(spark, schema, (1, "a", "2026-01-01"), (2, "b", "2026-01-02")), path, ["k"], ["ingest_date"])
    true_hint = writes.balanced

    def meanwhile(df, partition_by):
        monkeypatch.setattr(writes, "balanced", true_hint)
        writes.append(frame(spark, schema, (3, "other", "2026-01-01")), path, ["ingest_date"])
        return true_hint(df, partition_by)

    monkeypatch.setattr(writes, "balanced", meanwhile)
    with pytest.raises(writes.ChangedTable):
        writes.write_or_merge(frame(spark, schema, (1, "mine", "2026-01-01")), path, ["k"], ["ingest_date"])
    assert rows(read_table(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "other")]
    writes.write_or_merge(frame(spark, schema, (1, "mine", "2026-01-01")), path, ["k"], ["ingest_date"])
    assert rows(read_table(spark, path), "k", "v") == [(1, "mine"), (2, "b"), (3, "other")]


def test_a_merge_is_completed_after_its_driver_was_lost(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = "k int, v string, ingest_date string"
    writes.write_or_merge(frame(spark, schema, (1, "a", "2026-01-01"), (2, "b", "2026-01-02")), path, ["k"], ["ingest_date"])

    def lost(*_):
        raise SystemError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(writes, "_put_in_force", lost)
        with pytest.raises(SystemError):
            writes.write_or_merge(frame(spark, schema, (1, "c", "2026-01-02")), path, ["k"], ["ingest_date"])
    # While it may still be moving, readers see what is in place and writers stop.
    assert rows(read_table(spark, path), "k", "v") == [(1, "a"), (2, "b")]
    with pytest.raises(writes.ChangedTable):
        writes.write_or_merge(frame(spark, schema, (1, "d", "2026-01-02")), path, ["k"], ["ingest_date"])
    monkeypatch.setattr(writes, "LOST_AFTER_SECONDS", 0)
    assert rows(read_table(spark, path), "k", "v", "ingest_date") == [(1, "c", "2026-01-02"), (2, "b", "2026-01-02")]
    assert not list((tmp_path / "t").glob("_merge-*"))


def test_a_merge_reads_keys_first_and_then_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, ingest_date string"
    writes.write_or_merge(frame(spark, schema, *[(i, "a", f"2026-01-0{1 + i % 3}") for i in range(30)]), path, ["k"], ["ingest_date"])
    target = spark.read.parquet(path)
    known = upsert.upsert_known(target, frame(spark, schema, (1, "b", "2026-01-01")), frame(spark, "k int", (1,)), ["k"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


def test_rejects_are_split_in_one_pass(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = frame(spark, "k int, v string", (1, "a"), (2, None), (3, ""), (4, "b")).mapInPandas(counted, "k int, v string")
    split = writes.split_rejects(source, ["v"])
    assert (split.read, split.refused) == (4, 2)
    for _ in range(2):
        assert rows(split.clean) == [(1, "a"), (4, "b")] and rows(split.rejected) == [(2, None, "v"), (3, "", "v")]
    assert reads.value == 4
    none = writes.split_rejects(frame(spark, "k int, v string"), ["k", "v"])
    assert none[2:] == (0, 0) and none.clean.count() == none.rejected.count() == 0


def test_a_failed_replacement_leaves_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    day = frame(spark, "v int, ingest_date string", (1, "2026-01-01"), (2, "2026-01-02"))
    writes.append(day, path, ["ingest_date"])
    broken = day.withColumn("v", F.when(F.col("v") > 0, F.raise_error(F.lit("no"))).cast("int"))
    with pytest.raises(Exception, match="no"):
        writes.replace_partition(broken, path, "ingest_date", "2026-01-01")
    assert rows(read_table(spark, path), "v") == [(1,), (2,)]


def test_unfinished_snapshot_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    writes.write_snapshot(frame(spark, "k int", (1,)), path)
    newest = tmp_path / "t" / "snapshot=00000009-dead"
    newest.mkdir()
    (newest / "part.parquet").write_bytes(b"broken")
    assert rows(read_table(spark, path)) == [(1,)]


def test_append_and_partition_replace(spark, tmp_path):
    path = str(tmp_path / "a")
    day = frame(spark, "v int, ingest_date string", (1, "2026-01-01"), (2, "2026-01-02"))
    assert writes.append(day, path, ["ingest_date"]) == 2
    assert writes.append(day, path, ["ingest_date"]) == 2
    assert read_table(spark, path).count() == 4
    writes.replace_partitions(frame(spark, "v int, ingest_date string", (9, "2026-01-02")), path, ["ingest_date"])
    assert rows(read_table(spark, path), "v") == [(1,), (1,), (9,)]
    writes.replace_partition(day.limit(0), path, "ingest_date", "2026-01-01")
    assert rows(read_table(spark, path), "v") == [(9,)]


def test_manifest_merge_keeps_the_first_position(spark):
    entries = frame(spark, "identity string, seq int, v string", ("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"))
    assert [tuple(r) for r in upsert.merge_manifest(entries).orderBy("pos").collect()] == [("a", 1, "z"), ("b", 2, "y")]


def test_envelope(spark):
    records = frame(
        spark,
        "replay_run_id string, artifact_sha256 string, flow_id string, event_type string",
        ("run-1", "sha", "f", "alert"), ("", "sha", "f", "dns"), (None, "", "f", "tls"), ("", None, "", "flow"),
    )
    got = {r["key"]: json.loads(r["value"]) for r in writes.envelope(records, "t").collect()}
    assert set(got) == {"run-1", "sha", "f", None}
    assert got["run-1"] == {"replay_run_id": "run-1", "artifact_sha256": "sha", "flow_id": "f", "event_type": "alert"}
    assert list(got["run-1"]) == sorted(got["run-1"])


def test_publish(spark, tmp_path):
    record = frame(spark, "replay_run_id string, event_type string", ("run-1", "alert"))
    assert writes.publish(record, "topic", path=str(tmp_path / "k")) == 1
    sent = spark.read.json(str(tmp_path / "k")).first()
    assert (sent["key"], json.loads(sent["value"])) == ("run-1", {"replay_run_id": "run-1", "event_type": "alert"})
    assert writes.publish(record, "topic", servers="localhost:1", strict=False) == 0
    with pytest.raises(Exception, match="kafka"):
        writes.publish(record, "topic", servers="localhost:1")


def test_flatten_and_stamp(spark):
    df = spark.createDataFrame([(1, {"b": 1}, [3], (5, "x"))], "i int, m map<string,int>, a array<int>, s struct<z:int,c:string>")
    df = df.withColumn("v", F.parse_json(F.lit('{"b":[1],"a":null}'))).withColumn("n", F.parse_json(F.lit('"text"')))
    got = shaping.stamp(shaping.flatten(df), "2026-03-12", "now").first().asDict()
    assert got == {
        "i": 1, "m": '{"b":1}', "a": "[3]", "s": '{"c":"x","z":5}', "v": '{"a":null,"b":[1]}', "n": "text",
        "ingest_date": "2026-03-12", "retrieved_at_utc": "now",
    }


# -- skew -------------------------------------------------------------------------------------------


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    hot = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    one = shaping.keep_one(hot, ["k"], F.col("id").desc())
    before = one._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]
    assert "WindowGroupLimit" in before
    assert one.where("k = 0").first()["id"] == 49_998


def test_empty_keys_are_spread_over_lanes(spark):
    left = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    right = spark.range(40_000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("twice"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = shaping.lookup(left, right, ["k"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 8_000
        assert joined.where("twice is null").count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# -- captures ---------------------------------------------------------------------------------------

INDEX = "".join(f'<a href="{h}">x</a>' for h in ["?C=N", "Set-7/", "Set-19/", "Set-3/", "Set-7/", "Set-x/"])


def test_scenarios(spark):
    pages = frame(spark, "page_url string, html string", ("https://h/sets/", INDEX))
    found = catalog.discover_scenarios(catalog.extract_links(pages), r"^Set-(\d+)/$", 4, 19)
    assert rows(found) == [(19, "Set-19", "https://h/sets/Set-19/"), (7, "Set-7", "https://h/sets/Set-7/")]


def test_listing(spark):
    html = "".join(f'<a href="{h}">x</a>' for h in ["../", "b.pcap", " /x/a.pcap ", "b.pcap", "..", "d/", "x/."])
    links = catalog.extract_links(frame(spark, "page_url string, html string", ("u", html)))
    assert rows(catalog.list_files(links, ["page_url"]), "artifact_name") == [("a.pcap",), ("b.pcap",), ("x",)]


def test_rule_order_beats_name_order(spark):
    names = ["zone-b.cap", "alpha.cap.gz", "alpha.cap", "notes.md"]
    files = frame(spark, "scenario_number int, artifact_name string", *[(5, n) for n in names], (6, "notes.md"))
    late_name_first = [("zone", r"zone-.*\.cap$"), ("any", r".*\.cap$")]
    packed_first = [("packed", r".*\.gz$"), ("any", r".*\.cap$")]
    assert rows(catalog.select_artifacts(files, late_name_first, ["scenario_number"])) == [(5, "zone-b.cap", "zone")]
    assert rows(catalog.select_artifacts(files, packed_first, ["scenario_number"])) == [(5, "alpha.cap.gz", "packed")]
    assert rows(catalog.select_artifacts(files, [("g", "nope|alpha")], ["scenario_number"])) == [(5, "alpha.cap", "g")]


def entry(**fields):
    return json.dumps(fields)


def test_catalog(spark):
    path = "unstructured/pcap/source=x/scenario=42/ingest_date=2026-03-12/a.pcap"
    base = {"artifact_name": "a.pcap", "relative_landing_path": path, "sha256": "s", "scenario_number": 42}
    lines = [
        (1, entry(**base, retrieved_at_utc="old", size_bytes="7")),
        (2, entry(**base, retrieved_at_utc="new", page_url="u", size_bytes=None)),
        (3, entry(**{**base, "sha256": ""})),
        (4, entry(**{**base, "scenario_number": "x", "artifact_name": "a.pcap.bz2", "ingest_date": "2026-03-01"})),
    ]
    entries = frame(spark, "seq int, line string", *lines).select("seq", F.parse_json("line").alias("entry"))
    built = catalog.build_catalog(catalog.artifact_records(entries, "now"))
    assert len(built.columns) == 19
    assert rows(
        built, "artifact_name", "retrieved_at_utc", "scenario_url", "size_bytes", "ingest_date", "artifact_format",
        "is_compressed", "scenario_number", "source_id",
    ) == [
        ("a.pcap", "new", "u", 0, "2026-03-12", "pcap", False, 42, "ctu13_remote_pcap"),
        ("a.pcap.bz2", "", "", 0, "2026-03-01", "pcap_bz2", True, None, "ctu13_remote_pcap"),
    ]


def test_candidates(spark):
    schema = "source_id string, scenario_number bigint, artifact_name string, sha256 string, size_bytes bigint, ingest_date string"
    df = frame(
        spark, schema,
        ("s", 43, "plain.pcap", "1", 640, "2026-03-11"),
        ("s", 43, "plain.pcap", "1", 2048, "2026-03-12"),
        ("s", 42, "packed.pcap.bz2", "2", 77, "2026-03-12"),
        ("s", 42, "huge.pcap", "3", 31_000, "2026-03-12"),
        ("s", None, "last.pcap", "4", None, "2026-03-12"),
        ("s", 1, "notes.txt", "5", 1, "2026-03-12"),
    )

    def names(limit, packed):
        return [r["artifact_name"] for r in catalog.replay_candidates(df, limit, packed, 1000).collect()]

    assert names(9, False) == ["plain.pcap", "last.pcap"]
    assert names(9, True) == ["plain.pcap", "last.pcap", "packed.pcap.bz2"]
    assert names(1, True) == ["plain.pcap"]
    first = catalog.replay_candidates(df, 1, True, 1000).first()
    assert first["ingest_date"] == "2026-03-11"  # the newer copy is too large
    assert catalog.replay_candidates(df, 9, False, 640).first()["artifact_name"] == "plain.pcap"


def test_skip_existing(spark):
    selected, landed = frame(spark, "p string", ("a",), ("b",)), frame(spark, "p string", ("a",), ("a",))
    assert rows(upsert.split_existing(selected, landed, ["p"]), "p", "state") == [("a", "skipped"), ("b", "to_land")]
    assert rows(upsert.split_existing(selected, landed, ["p"], force=True), "state") == [("to_land",)] * 2


def test_integrity(spark):
    recorded = frame(spark, "relative_landing_path string, sha256 string", ("a", "1"), ("b", "2"), ("c", "3"))
    actual = frame(spark, "relative_landing_path string, sha256 string", ("a", "1"), ("b", "x"))
    checked = catalog.integrity(recorded, actual)
    assert rows(checked, "relative_landing_path", "integrity_fail") == [("a", False), ("b", True), ("c", False)]
    with pytest.raises(Exception, match="Checksum mismatch: b"):
        catalog.assert_integrity(checked).collect()


# -- events -----------------------------------------------------------------------------------------

ALERT = {
    "timestamp": "2025-11-02T23:59:58.250000+0000", "event_type": "alert", "src_ip": "198.51.100.7", "src_port": 50123,
    "dest_ip": "203.0.113.9", "dest_port": 8443, "proto": "UDP", "app_proto": "tls", "flow_id": 987, "pcap_cnt": 31,
    "alert": {"signature": "LOCAL beacon", "severity": 3, "category": "Odd traffic"},
}
FLOW = {"event_type": "flow", "src_ip": "198.51.100.7", "alert": "none", "src_port": "3.7", "dest_port": 3.7, "pcap_cnt": " 42 "}


@pytest.fixture
def normalized(spark):
    raw = frame(spark, "line string, artifact_sha256 string", *[(json.dumps(e), "sha") for e in (ALERT, FLOW)])
    artifacts = frame(
        spark,
        "sha256 string, artifact_name string, scenario_number bigint, relative_landing_path string, ingest_date string, replay_run_id string",
        ("sha", "a.pcap", 42, "raw/a.pcap", "2026-03-11", "old"),
        ("sha", "a.pcap", 42, "raw/a.pcap", "2026-03-12", "run-1"),
    )
    stamped = events.stamp_artifact(raw.select(F.parse_json("line").alias("event"), "artifact_sha256"), artifacts)
    return events.normalize_events(stamped, "2026-03-12")


def test_normalize(normalized):
    assert len(normalized.columns) == 22 and normalized.count() == 2
    alert = normalized.where("event_type = 'alert'").first()
    assert (alert["signature"], alert["severity"], alert["src_port"], alert["flow_id"]) == ("LOCAL beacon", 3, 50123, "987")
    assert (alert["replay_run_id"], alert["scenario_number"], alert["pcap_filename"]) == ("run-1", 42, "a.pcap")
    assert json.loads(alert["event_payload_json"]) == ALERT
    flow = normalized.where("event_type = 'flow'").first()
    assert (flow["src_port"], flow["dest_port"], flow["pcap_cnt"], flow["severity"]) == (0, 3, 42, 0)
    assert (flow["signature"], flow["timestamp_utc"]) == ("", "")


def test_alerts(normalized):
    alerts = events.alerts(normalized)
    assert len(alerts.columns) == 14
    assert rows(alerts, "src_ip", "dst_ip", "dst_port", "source") == [("198.51.100.7", "203.0.113.9", 8443, "suricata")]


def test_counts_and_summary(spark, normalized):
    counted = events.counts_per_run(normalized).first()
    assert (counted["event_counts_json"], counted["total_events"], counted["alert_events"]) == ('{"alert":1,"flow":1}', 2, 1)
    runs = frame(spark, "status string, total_events bigint, alert_events bigint", ("succeeded", 2, 1), ("failed", 0, 0))
    summary = events.replay_summary(runs)
    assert summary.first().asDict() == {
        "candidate_artifacts": 2, "successful_replays": 1, "failed_replays": 1, "normalized_events": 2, "alert_events": 1,
    }
    with pytest.raises(Exception, match="failed"):
        events.assert_replayed(summary).collect()


# -- enrichment, trusted, exploitation --------------------------------------------------------------


def test_lookups(spark):
    candidates = frame(spark, "cve_id string", ("A",), ("B",), ("C",), ("D",))
    responses = frame(
        spark, "cve_id string, payload string, error string",
        ("A", '{"x":1}', None), ("B", None, "HTTP Error 503: busy"), ("C", "{bad", None),
    )
    found = enrichment.lookup_results(candidates, responses, "cve_id", "https://l")
    assert rows(found, "cve_id", "request_url", "found", "status_code", "error") == [
        ("A", "https://l/A", True, None, None),
        ("B", "https://l/B", False, 503, "HTTP Error 503: busy"),
        ("C", "https://l/C", False, None, "Invalid JSON response"),
        ("D", "https://l/D", False, None, "no response"),
    ]
    assert tuple(enrichment.lookup_summary(found).first()) == (4, 1, 3)


def test_seeds(spark):
    feed = frame(spark, "ip string, ord int", ("b", 1), (None, 2), ("a", 3), ("b", 4))
    listed = frame(spark, "ip string, ord int", ("c", 0), ("a", 1))
    assert [r["ip"] for r in enrichment.seeds(feed, listed, 9).collect()] == ["b", "a", "c"]
    assert [r["ip"] for r in enrichment.seeds(feed, listed, 2).collect()] == ["b", "a"]


def test_clean_kev(spark):
    raw = frame(
        spark, "cveID string, vulnerabilityName string, dateAdded string, dueDate string, retrieved_at_utc string",
        ("CVE-1", "old", "2026-03-01", "bad", "1"), ("CVE-1", "new", "2026-03-02", "2026-04-01", "2"), ("CVE-2", None, "x", "y", "1"),
    )
    good, bad, _, _ = trusted.clean(raw.withColumnRenamed("cveID", "cve_id"), "kev")
    assert [(r["vulnerability_name"], str(r["date_added"]), str(r["due_date"])) for r in good.collect()] == [("new", "2026-03-02", "2026-04-01")]
    assert rows(bad, "cve_id", "_reject_reason") == [("CVE-2", "vulnerability_name")]


def test_clean_epss(spark):
    raw = frame(
        spark, "cve string, epss string, percentile string, date string, retrieved_at_utc string",
        ("A", "0.5", "1", "d1", "1"), ("B", "1.5", "x", "d1", "1"), ("C", "n/a", None, "d1", "1"), ("D", "0.1", None, "", "1"),
    )
    good, bad, _, _ = trusted.clean(raw, "epss")
    assert rows(good, "cve", "epss", "percentile", "_quality_warn") == [
        ("A", 0.5, 1.0, False), ("B", 1.5, None, True), ("C", None, None, False),
    ]
    assert rows(bad, "cve", "_reject_reason") == [("D", "date")]


def test_align(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("cve_id", T.StringType()), T.StructField("last_modified", T.DateType())])
    schema.add("score", T.DoubleType())
    got = trusted.align(frame(spark, "cveId string, lastModified string", ("A", "2026-03-12")), schema)
    assert got.schema == schema and got.first()["score"] is None


def test_event_checks(spark):
    schema = "replay_run_id string, flow_id string, timestamp_utc string, event_type string, src_ip string"
    raw = frame(
        spark, schema,
        ("r1", "1", "2027-05-04T09:30:02.000000+0000", "alert", "a"), ("r1", "1", "2027-05-04T09:30:02.000000+0000", "alert", "a"),
        ("r2", "1", "2027-05-04T09:30:02.000000+0000", "alert", "a"), ("r1", "2", "soon", "alert", "a"), ("r1", "3", "", "alert", "a"),
    )
    good, bad, _, _ = trusted.check_events(raw)
    kept = trusted.dedup_events(good)
    assert rows(kept.select("replay_run_id", "flow_id", "_ts_malformed", F.col("event_ts").cast("string"))) == [
        ("r1", "1", False, "2027-05-04 09:30:02"), ("r1", "2", True, "1970-01-01 00:00:00"), ("r2", "1", False, "2027-05-04 09:30:02"),
    ]
    assert rows(bad, "flow_id", "_reject_reason") == [("3", "timestamp_utc")]


def test_circl_layouts(spark):
    new = {"containers": {"cna": {"problemTypes": [{"descriptions": [{"cweId": "CWE-2"}, {"x": 1}]}, {"descriptions": [{"cweId": "CWE-1"}]}], "references": [1, 2]}}}
    old = {"cwe": "CWE-9", "references": ["a"]}
    df = frame(spark, "cve_id string, payload string", ("A", json.dumps(new)), ("B", json.dumps(old)), ("C", "{}"))
    assert rows(trusted.circl_profile(df)) == [("A", ["CWE-1", "CWE-2"], 2), ("B", ["CWE-9"], 1), ("C", [], 0)]


def test_vuln_enriched(spark):
    kev = frame(spark, "cve_id string, date_added string", ("A", "d"), ("K", "d"))
    nvd = frame(spark, "cve_id string, cvss_v3_score double, cvss_v3_severity string", ("A", 8.0, "HIGH"), ("B", None, None))
    epss = frame(spark, "cve_id string, epss double, date string", ("A", 0.9, "1"), ("A", 0.5, "2"), ("B", 0.9, "1"), ("E", 0.1, "1"))
    circl = frame(spark, "cve_id string, cwe_ids array<string>, reference_count bigint", ("B", ["CWE-1"], 3))
    wide = exploitation.vuln_enriched(kev, nvd, epss, circl)
    assert rows(wide, "cve_id", "kev_listed", "epss_score", "cvss_v3_score", "reference_count", "vuln_priority_score") == [
        ("A", True, 0.5, 8.0, None, 0.5 * 1.5 * 8.0 / 10), ("B", False, 0.9, None, 3, None),
        ("E", False, 0.1, None, None, None), ("K", True, None, None, None, None),
    ]
    assert [r["cve_id"] for r in exploitation.top_priority(wide, 2).collect()] == ["A", "B"]
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_correlations_of_all_kinds(spark):
    threatfox = frame(
        spark, "ioc string, ioc_value string, malware string, malware_printable string",
        ("172.16.4.9:80", None, "m", "Mal"), ("Evil.TEST", None, "m2", ""), ("d" * 64, None, "h", None),
    )
    urlhaus = frame(spark, "url string", ("http://evil.test/x",), ("http://172.16.4.9/y",), ("bad url",))
    iocs = exploitation.indicators(threatfox, urlhaus)
    assert ("hash", "d" * 64, "threatfox", "h") in rows(iocs)
    payloads = [
        {}, {"dns": {"rrname": "evil.test"}}, {"tls": {"sni": "EVIL.test"}}, {"http": {"hostname": "evil.test", "url": "/x"}},
    ]
    log = frame(
        spark, "n int, src_ip string, dst_ip string, event_payload_json string",
        *[(i, "172.16.4.9" if i == 0 else "9.9.9.9", "172.16.4.9" if i == 0 else "", json.dumps(p)) for i, p in enumerate(payloads)],
    )
    found = exploitation.ioc_correlations(log, iocs, ["n"])
    assert rows(found, "n", "matched_side", "ioc_type", "matched_value", "sources", "malware") == [
        (0, "dst", "ip", "172.16.4.9", ["threatfox", "urlhaus"], ["Mal"]),
        (0, "src", "ip", "172.16.4.9", ["threatfox", "urlhaus"], ["Mal"]),
        (1, "payload", "domain", "evil.test", ["threatfox", "urlhaus"], ["m2"]),
        (2, "payload", "domain", "evil.test", ["threatfox", "urlhaus"], ["m2"]),
        (3, "payload", "domain", "evil.test", ["threatfox", "urlhaus"], ["m2"]),
        (3, "payload", "url", "http://evil.test/x", ["urlhaus"], []),
    ]
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_correlation_leaves_the_payload_behind(spark, tmp_path):
    """Large sides on purpose: the offers are shuffled without the payload, and read it in one scan."""
    schema = "n int, src_ip string, dst_ip string, event_payload_json string"
    frame(spark, schema, (1, "a", "b", "{}"), (2, "c", "a", '{"tls":{"sni":"x"}}')).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    offers = exploitation.offered_values(log, ["n"])
    assert rows(offers) == [(1, "dst", "ip", "b"), (1, "src", "ip", "a"), (2, "dst", "ip", "a"), (2, "payload", "domain", "x"), (2, "src", "ip", "c")]
    plan = offers.repartition("matched_value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    exchanged = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "payload" not in exchanged and offers.columns == ["n", "matched_side", "ioc_type", "matched_value"]


def test_catalog_is_stored_in_order(spark, tmp_path):
    schema = "source_id string, scenario_number bigint, artifact_name string, ingest_date string, sha256 string"
    data = [("b", 1, "x", "2026-01-01", "h"), ("a", 2, "x", "2026-01-02", "h"), ("a", None, "z", "2026-01-01", "h"), ("a", 2, "x", "2026-01-01", "h"), ("a", 2, "b", "2026-01-03", "h")]
    data += [("c", i % 7 or None, f"n{i % 13}", f"2026-02-{1 + i % 28:02d}", str(i)) for i in range(500)]
    path = str(tmp_path / "t")
    catalog.in_catalog_order(frame(spark, schema, *data)).write.parquet(path)
    got = [tuple(r)[:5] for r in read_in_order(spark, path).orderBy("position").collect()]
    key = lambda r: (r[0], -1 if r[1] is None else r[1], r[2], r[3], r[4])
    assert got == sorted(data, key=key)
    assert sorted(r["position"] for r in read_in_order(spark, path).collect()) == list(range(505))


def test_declared_columns(spark):
    raw = frame(
        spark, "cveID string, vulnerabilityName string, dateAdded string, retrieved_at_utc string, surplus int, odd struct<a:int>",
        ("CVE-1", "n", "2026-03-01", "1", 5, (1,)), ("CVE-2", None, "2026-03-01", "1", None, None),
    )
    split = trusted.clean(raw, "kev")
    assert split.clean.columns == [f.name for f in TRUSTED_COLUMNS["kev"]] + ["_extra"]
    assert [(f.name, f.dataType) for f in split.clean.schema][:-1] == [(f.name, f.dataType) for f in TRUSTED_COLUMNS["kev"]]
    got = split.clean.first()
    assert (got["cve_id"], str(got["date_added"]), got["notes"], got["cwes"], json.loads(got["_extra"])) == ("CVE-1", "2026-03-01", None, None, {"odd": {"a": 1}, "surplus": 5})
    assert rows(split.rejected, "cve_id", "surplus") == [("CVE-2", None)]
    for table, columns in TRUSTED_COLUMNS.items():
        bare = frame(spark, "cve string, date string, cve_id string, id string, vulnerability_name string, retrieved_at_utc string, url string", ("c", "d", "i", "n", "v", "t", "http://u"))
        assert trusted.clean(bare, table).clean.select(*[f.name for f in columns]).count() == 1


def test_rolling_window_and_risk(spark):
    kev = frame(spark, "cve_id string, date_added string", ("A", "2026-03-06"), ("B", "2026-03-12"), ("C", "2026-03-05"), ("D", "2026-03-13"))
    kev = kev.withColumn("date_added", F.col("date_added").cast("date"))
    assert exploitation.kev_rolling(kev, F.lit("2026-03-12").cast("date")).first()[0] == 2
    alerts = frame(spark, "signature string", ("x CVE-2021-0001",), ("y cve_2021_0001",), ("none",))
    vulns = frame(spark, "cve_id string, vuln_priority_score double, cvss_v3_severity string", ("CVE-2021-0001", 0.5, "HIGH"))
    enriched = exploitation.enrich_alerts(alerts, vulns)
    assert enriched.count() == 3
    assert rows(exploitation.risk_summary(enriched)) == [("CVE-2021-0001", 2, 0.5)]


def test_features_take_the_gravest_event(spark):
    schema = "flow_id string, severity bigint, category string, src_port bigint, dst_port bigint"
    log = frame(spark, schema, ("f", 0, "", 1, 2), ("f", 3, "c3", 3, 4), ("f", 1, "c1", 5, 6), ("g", 0, "", 7, 8))
    assert rows(exploitation.flow_features(log)) == [("f", 3, "c1", 1, 5, 6), ("g", 1, "", 0, 7, 8)]
