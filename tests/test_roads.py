"""Reload, replacement, fill and sweep over a registry: reports, reasons, dry runs, repeats."""

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rivulet import model
from rivulet.plans.roads import Roads
from rivulet.session import scratch
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import OUTPUTS, ControlStore
from rivulet.sources.source_db import ParquetSource
from tests.helpers import rows

PERSON = model.shape("tenant_id int, Id string, Name string, Photo string, batch_id bigint, _op string")
REGISTRY = [("s", "person", "person", "ID", True), ("s", "nokey", "nokey", None, True), ("s", "absent", "absent", "id", True), ("s", "off", "person", "ID", False)]
HELD = [(1, "a", "old", None, 1, "c"), (1, "b", "old", None, 5, "c"), (1, "gone", "old", None, 1, "c"), (2, "a", "other", None, 1, "c")]


@pytest.fixture
def made(spark):
    base = scratch(spark, "roads-test")
    people = spark.createDataFrame([("A", "new", "img"), ("B", "new", "img"), ("C", "new", "img"), ("C", "twice", "img")], "ID string, NAME string, PHOTO string")
    people.write.parquet(f"{base}/source/person.parquet")
    people.drop("ID").write.parquet(f"{base}/source/nokey.parquet")
    tables = BucketStore(spark, f"{base}/bronze", dict.fromkeys(["person", "nokey", "absent"], PERSON), {"person": ["Id"], "absent": ["Id"]}, 4)
    tables.load("person", spark.createDataFrame(HELD, PERSON))
    return Roads(
        ParquetSource(spark, f"{base}/source"), tables, ControlStore(spark, f"{base}/control"), tenant_id=1, batch_id=7, run_id="r1",
        as_of=F.lit("2024-01-02").cast("timestamp"),
    )


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(REGISTRY, model.REGISTRY)


def files(made):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{made.tables.path('person').removeprefix('file:')}/**/*.parquet", recursive=True)}


def outcome(made, output):
    return rows(made.kept.read(output), *[c for c in OUTPUTS[output].names if c not in ("start_ts", "end_ts", "duration_secs", "duration_mins")])


def test_reload_reports_every_table_and_merges_by_key(made, registry):
    detail = made.reload(registry)
    assert rows(detail, "source_table", "status", "inserted_rows") == [("absent", "FAILED", 0), ("nokey", "SKIPPED", 0), ("person", "SUCCESS", 3)]
    got = rows(made.tables.read("person").filter("tenant_id = 1"), "Id", "Name", "_op", "batch_id")
    assert got == [("a", "new", "r", 7), ("b", "new", "r", 7), ("c", "new", "r", 7), ("gone", "old", "c", 1)]
    assert rows(made.kept.read("header"), "status", "total_tables", "failed_tables") == [("FAILED", 3, 1)]
    assert rows(made.kept.marks(), "source_table", "last_batch_id") == [("person", 7)] and made.kept.gate().count() == 0


def test_a_clean_reload_opens_the_gate_once(made, registry):
    clean = registry.filter("source_table = 'person'")
    made.reload(clean)
    once = outcome(made, "gate")
    made.reload(clean)
    assert outcome(made, "gate") == once and [r[0] for r in once] == [7]
    replace(made, run_id="r2", batch_id=6).reload(clean)
    assert rows(made.kept.gate(), "batch_id") == [(7,)]  # an older batch opens nothing


def test_stream_tables_are_left_alone_and_slices_swapped(made, registry):
    before = files(made)
    detail = made.reload(registry.filter("source_table = 'person'"), streamed=[("S", "Person")])
    assert rows(detail, "status", "error_message") == [("SKIPPED", "the stream owns it")] and files(made) == before
    made.reload(registry.filter("source_table = 'person'"), overwrite_tenant=True)
    assert rows(made.tables.read("person"), "tenant_id", "Id") == [(1, "a"), (1, "b"), (1, "c"), (2, "a")]


@pytest.mark.parametrize("road", ["reload", "replace", "fill", "sweep"])
def test_a_dry_run_reports_and_changes_nothing(made, registry, road):
    dry, before = replace(made, dry_run=True), files(made)
    report = dry.fill(registry, {("s", "person"): ["photo"]}) if road == "fill" else getattr(dry, road)(registry)
    assert report.count() == 3 and files(made) == before
    assert made.kept.marks().count() == made.kept.gate().count() == 0


def test_replacement_syncs_by_key_and_swaps_without(made, registry, spark):
    columns = spark.createDataFrame(
        [("s", t, c, k, n) for t in ("person", "nokey", "absent") for c, k, n in (("ID", "int", None), ("NAME", "varchar", 50), ("PHOTO", "image", None))],
        "table_schema string, table_name string, column_name string, data_type string, char_len int",
    )
    columns = columns.filter("NOT (table_name = 'nokey' AND column_name = 'ID')")
    report = replace(made, columns=columns).replace(registry)
    assert rows(report, "source_table", "method", "src_rows", "bronze_before", "status") == [
        ("absent", None, 0, 0, "ERROR"), ("nokey", "overwrite_tenant", 4, 0, "OK"), ("person", "merge_sync", 3, 3, "OK"),
    ]
    assert rows(made.tables.read("person"), "tenant_id", "Id", "Name", "Photo") == [
        (1, "a", "new", None), (1, "b", "new", None), (1, "c", "new", None), (2, "a", "other", None),
    ]
    assert made.tables.read("nokey").count() == 4
    wide = columns.withColumn("data_type", F.lit("xml"))
    assert rows(replace(made, columns=wide).replace(registry.filter("source_table = 'person'")), "status", "error") == [
        ("SKIPPED", "the target has none of its narrow columns"),
    ]


def test_fill_sets_only_holes_of_the_batch(made, registry):
    report = replace(made, batch_id=1).fill(registry, {("s", "person"): ["PHOTO"], ("s", "absent"): ["nope"]})
    assert rows(report, "source_table", "status", "candidate_rows", "filled_rows", "cols_filled") == [
        ("absent", "SKIPPED", 0, 0, ""), ("nokey", "SKIPPED", 0, 0, ""), ("person", "OK", 2, 1, "Photo"),
    ]
    assert rows(made.tables.read("person").filter("Photo IS NOT NULL"), "tenant_id", "Id", "Name") == [(1, "a", "old")]


def test_sweep_logs_deletes_and_trips_the_fuse(made, registry):
    tripped = made.sweep(registry)
    assert rows(tripped.filter("source_table = 'person'"), "status", "ghost_rows") == [("ABORTED_PCT_FUSE", 1)]
    assert made.tables.read("person").count() == 4 and outcome(made, "doomed") == []
    report = made.sweep(registry, max_pct=50, buckets=2)
    assert rows(report, "source_table", "status") == [("absent", "FAILED"), ("nokey", "SKIPPED"), ("person", "DELETED")]
    assert rows(made.kept.read("doomed"), "pk_json") == [('{"Id":"gone"}',)]
    assert rows(made.tables.read("person"), "tenant_id", "Id") == [(1, "a"), (1, "b"), (2, "a")]


def test_a_road_done_twice_leaves_its_rows_once(made, registry):
    made.reload(registry)
    once = {o: outcome(made, o) for o in OUTPUTS}
    state = rows(made.tables.read("person"))
    made.reload(registry)
    assert {o: outcome(made, o) for o in OUTPUTS} == once and rows(made.tables.read("person")) == state
