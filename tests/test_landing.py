"""Files to raw tables: formats, row numbers, repeated and failing loads."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from funnelry.functions import documents
from funnelry.plans import bronze, gold, silver
from funnelry.schema import RAW
from funnelry.sources import landing, seeds
from funnelry.sources import versions
from funnelry.streaming import incremental
from tests.conftest import plan_of
from tests.test_layers import activity

NOW = dt.datetime(2026, 5, 17, 8, 0)


def write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    body = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    if name.endswith(".gz"):
        (folder / name).write_bytes(gzip.compress(body.encode()))
    else:
        (folder / name).write_text(body)


def test_wrapped_direct_compressed_and_stamped_rows(spark, tmp_path):
    write(tmp_path, "a.jsonl", [{"raw_data": {"id": "1"}, "insert_date": "2026-05-16 07:30:00"}, {"id": "2"}])
    write(tmp_path, "b.jsonl.gz", [{"raw_data": {"id": "3"}, "insert_date": "soon"}, "", {"raw_data": None, "id": "4"}])
    raw = landing.read_landed(spark, str(tmp_path), NOW)
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in RAW]
    rows = raw.select(
        documents.text("raw_data", "id").alias("id"),
        F.regexp_extract("source_file_name", "([^/]+)$", 1).alias("file"),
        "source_row_number",
        "insert_date",
        "load_date",
    ).collect()
    found = {(r.file, r.source_row_number): (r.id, r.insert_date) for r in rows}
    assert found[("a.jsonl", 1)] == ("1", dt.datetime(2026, 5, 16, 7, 30))
    assert found[("a.jsonl", 2)] == ("2", NOW)
    assert found[("b.jsonl.gz", 1)] == ("3", NOW)
    # Blank lines are no records, but they keep their line number.
    assert found[("b.jsonl.gz", 3)][1] == NOW and len(found) == 4
    assert {r.load_date for r in rows} == {NOW.date()}


def test_row_numbers_of_split_files(spark, tmp_path):
    for n, size in enumerate((5000, 1, 3000)):
        write(tmp_path, f"f{n}.jsonl", [{"line": i} for i in range(1, size + 1)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        lines = landing.file_lines(spark.read.text(str(tmp_path)))
        assert lines.select("split_start").distinct().count() > 5
        raw = landing.read_landed(spark, str(tmp_path), NOW)
        wrong = raw.where(documents.text("raw_data", "line").cast("bigint") != F.col("source_row_number"))
        assert raw.count() == 8001 and wrong.isEmpty()
        # The lines are never shuffled: the only join is a broadcast of one row per split.
        plan = plan_of(raw)
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_line_is_lost_when_splits_change_before_the_run(spark, tmp_path):
    write(tmp_path, "a.jsonl", [{"id": str(i), "pad": "x" * 100} for i in range(60_000)])
    setting = "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(setting, "2")
        raw = landing.read_landed(spark, str(tmp_path), NOW)
        spark.conf.set(setting, "8")
        rows = raw.select(documents.text("raw_data", "id").cast("long").alias("id"), "source_row_number")
        assert rows.filter("source_row_number = id + 1").count() == 60_000
        assert rows.count() == 60_000
    finally:
        spark.conf.unset(setting)


def test_malformed_line_aborts_the_load(spark, tmp_path):
    write(tmp_path / "in", "a.jsonl", [{"id": "1"}, "{broken"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_landed(spark, str(tmp_path / "in"), NOW).collect()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        incremental.land_new_files(
            spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "cp"), NOW
        )
    # Nothing was committed; the repaired file is loaded by the next run.
    write(tmp_path / "in", "a.jsonl", [{"id": "1"}, {"id": "2"}])
    incremental.land_new_files(spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "cp"), NOW)
    assert incremental.read_raw_table(spark, str(tmp_path / "raw")).count() == 2


def test_bad_bytes_are_tolerated(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"id": "caf\xe9"}\n{"id": "ok"}\n')
    raw = landing.read_landed(spark, str(tmp_path), NOW)
    ids = [r[0] for r in raw.select(documents.text("raw_data", "id")).collect()]
    assert sorted(ids) == ["caf�", "ok"]


def test_partition_filter_skips_folders(spark, tmp_path):
    for day in ("2026-05-16", "2026-05-17"):
        write(tmp_path / f"load_date={day}", "a.jsonl", [{"d": day}])
    lines = landing.read_partitioned(spark, str(tmp_path))
    day = lines.where(F.col("load_date") == F.lit(dt.date(2026, 5, 17)))
    assert [json.loads(r.value)["d"] for r in day.collect()] == ["2026-05-17"]
    assert "PartitionFilters: [isnotnull(load_date" in plan_of(day)


def test_archive_moves_processed_files(spark, tmp_path):
    for n in range(3):
        write(tmp_path / "in", f"f{n}.jsonl", [{"n": n}])
        incremental.land_new_files(
            spark,
            str(tmp_path / "in"),
            str(tmp_path / "raw"),
            str(tmp_path / "cp"),
            NOW,
            archive=str(tmp_path / "archive"),
        )
    assert incremental.read_raw_table(spark, str(tmp_path / "raw")).count() == 3
    manifest = incremental.file_manifest(incremental.read_raw_table(spark, str(tmp_path / "raw")))
    assert {r.batch_id for r in manifest.collect()} == {0, 1, 2}
    # Spark archives the files of a batch once a later batch starts.
    assert list((tmp_path / "archive").rglob("f0.jsonl"))


def test_export_and_listing(spark, tmp_path):
    table = spark.range(3).select(F.struct("id").alias("raw_data"), F.lit(NOW).cast("timestamp_ntz").alias("insert_date"))
    landing.export_files(table, str(tmp_path), dt.date(2026, 5, 16))
    assert landing.list_files(spark, str(tmp_path)).count() >= 1
    raw = landing.read_landed(spark, str(tmp_path), dt.datetime(2027, 1, 1))
    assert {r.insert_date for r in raw.collect()} == {NOW}


def _daily_load(day):
    """Each day repeats the earlier activities; some come in a newer version."""
    items = [
        activity(
            f"a{n}",
            lead=f"lead_{n % 4}",
            type_id=["t1", "t2", "t3"][n % 3],
            at=f"2026-01-01 {n:02d}:00:00",
            updated=f"2026-02-{(day if n % 2 else 1):02d} 00:00:00",
            cf_v=str(day if n % 2 else 1),
        )
        for n in range(min(20, 6 + 2 * day))
    ]
    return [{"raw_data": {"data": items[:7]}}, {"raw_data": {"data": items[7:]}}]


def test_seven_daily_loads_equal_the_last_one(spark, tmp_path):
    """Replayed daily deliveries give the same funnel as the final state alone."""
    types = spark.createDataFrame(
        [("t1", "i", "inbound", "initial_contact", False, True), ("t2", "s", None, "strategy", False, True), ("t3", "n", None, "sale", True, True)],
        seeds.SEEDS["custom_activity_type_map"],
    )
    known = spark.createDataFrame([("cf_v", "v", "number", "contract_value", "revenue", True)], seeds.SEEDS["custom_field_map"])

    def funnel(raw):
        activities = silver.silver_activities(bronze.stage_lead_activities(raw))
        return sorted(map(str, gold.fact_lead_funnel(activities, types, known).collect()))

    raw_dir, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    for day in range(1, 8):
        write(tmp_path / "in" / f"load_date=2026-02-{day:02d}", "x.jsonl", _daily_load(day))
        incremental.land_new_files(spark, str(tmp_path / "in"), raw_dir, checkpoint, NOW)
    write(tmp_path / "last", "x.jsonl", _daily_load(7))
    replayed = incremental.read_raw_table(spark, raw_dir)
    assert replayed.count() == 14
    assert funnel(replayed) == funnel(landing.read_landed(spark, str(tmp_path / "last"), NOW))


def test_streaming_latest_keeps_one_version_per_key(spark, tmp_path):
    schema = "k string, v int, at int"
    deliveries = [[("a", 1, 1), ("b", 1, 5)], [("a", 2, 2), ("c", 3, None)], [("b", 9, 4), ("c", 4, 1)]]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        incremental.keep_latest(
            spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["at"], buckets=3
        )
    found = {r.k: r.v for r in incremental.read_latest(spark, str(tmp_path / "out")).collect()}
    assert found == {"a": 2, "b": 1, "c": 4}


def test_backlog_in_several_batches(spark, tmp_path):
    for n in range(5):
        write(tmp_path / "in", f"f{n}.jsonl", [{"n": n}, {"n": n}])
    incremental.land_new_files(
        spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "cp"), NOW, files_per_batch=2
    )
    raw = incremental.read_raw_table(spark, str(tmp_path / "raw"))
    assert raw.count() == 10 and raw.select("batch_id").distinct().count() == 3
    assert {r.source_row_number for r in raw.collect()} == {1, 2}


def test_a_batch_killed_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / x) for x in ("in", "raw", "cp")]
    write(tmp_path / "in", "a.jsonl", [{"n": 1}])
    incremental.land_new_files(spark, *paths, NOW)
    write(tmp_path / "in", "b.jsonl", [{"n": 2}, {"n": 3}])
    monkeypatch.setattr(versions.Change, "commit", lambda *x: 1 / 0)
    with pytest.raises(Exception):
        incremental.land_new_files(spark, *paths, NOW)
    assert incremental.read_raw_table(spark, paths[1]).count() == 1
    monkeypatch.undo()
    incremental.land_new_files(spark, *paths, NOW)
    assert incremental.read_raw_table(spark, paths[1]).count() == 3


def test_small_files_are_gathered(spark, tmp_path):
    paths = [str(tmp_path / x) for x in ("in", "raw", "cp")]
    for n in range(4):
        write(tmp_path / "in", f"f{n}.jsonl", [{"n": n}] * (n + 1))
        incremental.land_new_files(spark, *paths, NOW)
    raw = incremental.read_raw_table(spark, paths[1])
    before = sorted(map(str, raw.collect()))
    assert incremental.compact_raw_table(spark, paths[1]) == len(raw.inputFiles()) == 4
    after = incremental.read_raw_table(spark, paths[1])
    assert len(after.inputFiles()) < 4 and sorted(map(str, after.collect())) == before
    assert incremental.compact_raw_table(spark, paths[1]) == 0
    # The files of the version before go with the next commit but one.
    assert sorted(map(str, raw.collect())) == before


def test_upserted_batches_keep_stamps_and_come_once(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path / "s"))
    schema = "k string, at int, v string"
    loads = [[("a", 1, "x"), (None, 1, "n")], [("a", 1, "y"), ("b", 5, "z")], [("b", 4, "old"), (None, 2, "m")]]
    for batch, rows in enumerate(loads):
        for _ in range(2):
            incremental.upsert_batch(
                store, spark.createDataFrame(rows, schema), "feed", batch, ["k"], ["at"],
                NOW + dt.timedelta(days=batch), buckets=3,
            )
    found = {r.k: (r.at, r.v, r.insert_date.day, r.update_date.day) for r in store.read("latest").collect()}
    day = NOW.day
    assert found == {"a": (1, "y", day, day + 1), "b": (5, "z", day + 1, day + 2), None: (2, "m", day, day + 2)}
