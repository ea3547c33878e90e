"""The stage's ledger, acknowledged ranges, and cycles that keep their outcome."""

import datetime
import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet import model
from rivulet.session import scratch
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import OUTPUTS, ControlStore
from rivulet.streaming import ledger
from rivulet.streaming.cycle import run_cycle
from rivulet.streaming.ledger import RANGES, LostPlace, Stage, merged_ranges, outside, segment_ranges
from rivulet.streaming.stage import StageRun
from tests.helpers import rows
from tests.test_stream import MESSAGES, PERSON, REGISTRY, at, message, people, placed
from workload import cycles
from workload.inputs import Inputs

EARLY = datetime.datetime(2024, 1, 1, 12)


def run_of(path, stream="s1", when=EARLY, tenant=1):
    return StageRun(tenant_id=tenant, default_schema="app", expected_db="shop", batch_id=20240101000000, run_id="r", stage_path=path,
                    stream_id=stream, ingest_ts=F.lit(when))


def filled(spark, *batches, when=EARLY):
    stage = Stage(spark, scratch(spark, "ledger-test") + "/stage")
    for n, messages in enumerate(batches):
        run_of(stage.path, when=when).append_batch(placed(spark, messages), n)
    return stage


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)}


def test_records_say_what_was_staged(spark):
    stage = filled(spark, MESSAGES[:3], MESSAGES[3:])
    first, second = stage.records().orderBy("micro_batch_id").collect()
    assert (first.base, first.high_water, second.base) == (0, 3, 3) and second.high_water == 5
    assert [tuple(p) for p in first.places] == [("0", 1, 3, 0)]
    assert rows(stage.segments(), "source_table", "low", "high", "rows") == [
        ("Person", 3, 3, 1), ("nokey", 4, 4, 1), ("person", 1, 2, 2), ("unknown", 5, 5, 1),
    ]
    assert rows(stage.depth()) == [("app", 4, 5)]


def test_the_ledger_alone_gives_sequences_claims_and_depth(spark, monkeypatch):
    stage = filled(spark, MESSAGES[:2])

    def no_rows(*_):
        raise AssertionError("staged rows were read")

    monkeypatch.setattr(Stage, "rows", no_rows)
    run_of(stage.path).append_batch(placed(spark, MESSAGES[2:]), 1)
    claim = stage.claim(1, at())
    assert (claim.boundary, claim.rows, claim.ranges) == (5, 5, [(1, 5)])
    assert stage.depth().count() == 1 and stage.standing("s1", 0)[0] == 5


def test_a_retry_and_a_new_checkpoint_agree_with_the_ledger(spark):
    stage = filled(spark, MESSAGES[:3])
    before = rows(stage.rows(), "stage_seq", "commit_lsn", "ingest_ts")
    run_of(stage.path, when=datetime.datetime(2024, 1, 9)).append_batch(placed(spark, MESSAGES[:3]).orderBy(F.rand(1)), 0)
    assert rows(stage.rows(), "stage_seq", "commit_lsn", "ingest_ts") == before and stage.records().count() == 1
    run_of(stage.path, "s2").append_batch(placed(spark, MESSAGES[:3]), 0)
    # the first stream comes again although the second went on: its sequences stay
    run_of(stage.path).append_batch(placed(spark, MESSAGES[:3]), 0)
    got = stage.rows().groupBy("stream_id").agg(F.min("stage_seq"), F.max("stage_seq"))
    assert rows(got) == [("s1", 1, 3), ("s2", 4, 6)]


def test_rows_that_were_written_without_a_record_do_not_count(spark):
    stage = filled(spark, MESSAGES[:2])
    left_over = stage.folder(1, EARLY.date(), "s1", 1)
    stage.rows().limit(1).drop(*ledger.FOLDER).write.parquet(left_over)  # the job broke off here
    assert stage.claim(1, at()).rows == 2
    run_of(stage.path).append_batch(placed(spark, MESSAGES[2:3]), 1)
    assert stage.claim(1, at()).rows == stage.rows().count() == 3


def test_micro_batches_without_rows_take_no_sequence(spark):
    stage = filled(spark, [MESSAGES[5]], MESSAGES[:2], [MESSAGES[5]])  # only for another database
    assert rows(stage.records(), "micro_batch_id", "base", "high_water") == [(0, 0, 0), (1, 0, 2), (2, 2, 2)]
    claim = stage.claim(1, at())
    assert (claim.boundary, claim.rows, claim.ranges) == (2, 2, [(1, 2)])


@pytest.mark.parametrize("column", ["source_partition", "source_offset"])
def test_messages_without_a_place_are_refused(spark, column):
    stage = Stage(spark, scratch(spark, "ledger-test") + "/stage")
    lost = placed(spark, MESSAGES).withColumn(column, F.when(F.col("source_offset") != 2, F.col(column)))
    with pytest.raises(LostPlace, match="1 messages"):
        run_of(stage.path).append_batch(lost, 0)
    assert stage.rows().count() == 0 and stage.records().count() == 0


def test_folding_the_ledger_changes_nothing(spark):
    stage = filled(spark, MESSAGES[:1], MESSAGES[1:2], MESSAGES[2:3])
    run_of(stage.path, when=datetime.datetime(2024, 1, 2)).append_batch(placed(spark, MESSAGES[3:]), 3)
    before, old = rows(stage.segments()), len(files(f"{stage.path}.ledger"))
    stage.fold(datetime.date(2024, 1, 2))
    assert rows(stage.segments()) == before and len(files(f"{stage.path}.ledger")) == old - 2


def test_micro_batches_settle_as_a_whole(spark):
    stage = filled(spark, MESSAGES[:2])
    run_of(stage.path, when=datetime.datetime(2024, 1, 2)).append_batch(placed(spark, MESSAGES[2:]), 1)
    claim = stage.claim(1, at(), grace_minutes=60)
    assert (claim.boundary, claim.ranges, claim.rows) == (2, [(1, 2)], 2)
    assert stage.claim(1, at()).ranges == [(1, 5)] and stage.claim(2, at()).boundary is None


small = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 6)), max_size=14)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(small)
def test_merged_ranges_cover_the_same_numbers(spark, given_ranges):
    df = spark.createDataFrame([(k, a, a + n) for k, a, n in given_ranges], "k int, low bigint, high bigint")
    got = merged_ranges(df, ["k"]).collect()
    cover = {(k, x) for k, a, n in given_ranges for x in range(a, a + n + 1)}
    assert {(r.k, x) for r in got for x in range(r.low, r.high + 1)} == cover
    assert len(got) == sum((k, x - 1) not in cover for k, x in cover)  # none touch


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "A", "b"]), st.booleans()), max_size=25))
def test_ranges_cover_just_the_rows_asked_for(spark, given_rows):
    df = spark.createDataFrame([(1, " App", t, n, m) for n, (t, m) in enumerate(given_rows)], "tenant_id int, source_schema string, source_table string, stage_seq bigint, m boolean")
    ranges = segment_ranges(df, F.col("m"))
    left = outside(df, ranges, F.col("stage_seq"), F.col("stage_seq"))
    assert rows(left) == rows(df.filter("NOT m"))
    assert ranges.count() <= sum(m for _, m in given_rows)


def store(spark, base):
    return BucketStore(spark, f"{base}/bronze", {"app_person": PERSON, "app_nokey": PERSON}, {"app_person": ["Id"], "app_nokey": ["Id"]}, 8)


def prepared(spark, *batches):
    stage = filled(spark, *batches)
    base = scratch(spark, "cycle-test")
    tables = store(spark, base)
    for tenant in (1, 2):
        tables.replace("app_person", tenant, people(spark))
    return stage, tables, ControlStore(spark, f"{base}/control"), spark.createDataFrame(REGISTRY, model.REGISTRY)


def outputs(kept):
    times = {"start_ts", "end_ts", "duration_secs", "duration_mins", "lag_sketch"}
    return {o: rows(kept.read(o), *[c for c in s.names if c not in times]) for o, s in OUTPUTS.items()}


def test_a_cycle_done_twice_leaves_its_outcome_once(spark):
    stage, tables, kept, registry = prepared(spark, MESSAGES)
    options = dict(tenant_id=1, run_id="r1", as_of=at())
    cycle = run_cycle(stage, registry, tables, kept, **options)
    assert cycle.status == "FAILED" and rows(cycle.stage, "source_table") == [("unknown",)]
    assert rows(tables.read("app_person"), "tenant_id", "Id", "Name") == [(1, "a1", "second"), (1, "keep", "k"), (2, "a1", "other tenant")]
    once, state = outputs(kept), rows(tables.read("app_person"))
    assert [len(once[o]) for o in ("header", "detail", "dead_letter", "mark", "cursor", "gate")] == [1, 3, 1, 1, 1, 0]
    assert rows(kept.read("header"), "status", "total_tables", "failed_tables") == [("FAILED", 3, 1)]
    again = run_cycle(stage, registry, tables, kept, **options)
    assert outputs(kept) == once and rows(tables.read("app_person")) == state
    assert rows(again.stage, "source_table") == [("unknown",)]
    assert stage.acknowledged().count() == 2
    # another run finds what nobody took, and nothing else
    assert run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r2", as_of=at()).results.count() == 1


def test_acknowledging_rewrites_no_staged_row_and_closes_folders(spark):
    stage, tables, kept, registry = prepared(spark, MESSAGES[:3], MESSAGES[4:])
    before = files(stage.path)
    run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r1", as_of=at())
    assert files(stage.path) == before
    run_of(stage.path).append_batch(placed(spark, [message(9, "person", "c", {"Id": "n", "Name": "new"})]), 2)
    claim = stage.claim(1, at(), besides="r2")
    tables_ = spark.createDataFrame([("app", "person")], "_schema string, _table string")
    opened = {f.split("micro_batch_id=")[1].split("/")[0] for f in stage.claimed_rows(claim, tables_, "r2").inputFiles() if "micro_batch_id=" in f}
    assert opened == {"2"}
    # the unregistered table's folder stays open for whoever wants it, the other is closed
    assert {r[0] for r in stage.open_segments().select("micro_batch_id").collect()} == {1, 2}
    done = run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r2", as_of=at())
    assert rows(done.results, "source_table", "status", "inserted_rows") == [("person", "SUCCESS", 1), ("unknown", "SKIPPED", 0)]
    # what both runs acknowledged is one range
    assert rows(stage.acknowledged(), "source_table", "low", "high") == [("person", 1, claim.boundary)]


def test_a_cycle_rewrites_the_touched_folders_only(spark):
    stage, tables, kept, registry = prepared(spark, [message(1, "person", "u", {"Id": "keep", "Name": "new"})])
    before = files(tables.path("app_person"))
    run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r1", as_of=at())
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(files(tables.path("app_person")).items())}
    assert len(changed) == 1
    assert rows(tables.read("app_person"), "tenant_id", "Id", "Name") == [(1, "keep", "new"), (1, "old", "gone soon"), (2, "a1", "other tenant")]


def test_a_run_that_broke_off_before_acknowledging_is_done_again(spark, monkeypatch):
    stage, tables, kept, registry = prepared(spark, MESSAGES[:3])

    def broken(*_):
        raise OSError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Stage, "acknowledge", broken)
        with pytest.raises(OSError):
            run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r1", as_of=at())
    half = outputs(kept)
    run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r1", as_of=at())
    assert outputs(kept) == half and stage.unacknowledged().count() == 0
    assert rows(kept.gate(), "batch_id", "execution_id") == [(20240101000000, "r1")]


def test_marks_and_gate_over_runs(spark):
    kept = ControlStore(spark, scratch(spark, "control"))
    assert kept.marks().count() == 0 and kept.gate().count() == 0
    for run, batch, when in (("a", 9, 1), ("b", 5, 2)):
        ts = datetime.datetime(2024, 1, when)
        kept.write("mark", run, spark.createDataFrame([(1, "s", "t", batch, ts)], model.WATERMARK))
        kept.write("gate", run, spark.createDataFrame([(7, ts, run)], model.GATE))
        kept.write("cursor", run, spark.createDataFrame([(1, "s", "t", batch, batch, ts)], model.CURSOR))
    assert rows(kept.marks(), "last_batch_id") == [(9,)] and rows(kept.gate(), "execution_id") == [("a",)]
    assert rows(kept.cursors(), "last_stage_seq") == [(5,)] and rows(kept.marks("a"), "last_batch_id") == [(5,)]


def test_an_empty_stage_is_an_empty_cycle(spark):
    stage = Stage(spark, scratch(spark, "ledger-test") + "/stage")
    assert stage.rows().count() == stage.unacknowledged().count() == stage.depth().count() == 0
    _, tables, kept, registry = prepared(spark, MESSAGES[:1])
    assert run_cycle(stage, registry, tables, kept, tenant_id=1, run_id="r1", as_of=at()).status == "EMPTY"
    stage.acknowledge("r0", spark.createDataFrame([], RANGES))
    assert stage.acknowledged().count() == 0


def test_events_are_read_once_for_all_micro_batches(spark, tmp_path, monkeypatch):
    days = [1, 10, 11, 20, 25, 26, 31, None]
    times = [None if d is None else datetime.datetime(2024, 1, d, 12) for d in days]
    events = [(n, t, n % 3, "signup", 10.0 if n < 8 else 70.0) for n, t in enumerate(times * 2)] * 2
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    i, got = Inputs(spark, str(tmp_path)), {}
    monkeypatch.setattr(Stage, "put", lambda _, df, **to: got.setdefault((to["tenant_id"], to["micro_batch_id"]), (df, to["ingest_ts"])))
    cycles.staged(i, f"{tmp_path}/stage")
    assert sorted(got) == [(t, n) for t in (1, 2) for n in range(4)]
    staged = cycles.event_stage(i)
    for (tenant, number), (df, at_) in got.items():
        assert not [f for f in df.inputFiles() if "events.parquet" in f]
        first = 1 if number == 0 else cycles.DAYS[number - 1] + 1
        during = staged.filter(F.dayofmonth("ingest_ts").between(first, cycles.DAYS[number]))
        assert at_ == during.agg(F.max("ingest_ts")).first()[0]
        want = during.filter(F.col("tenant_id") == tenant).withColumnRenamed("stage_seq", "source_offset")
        assert rows(df, *want.columns) == rows(want) != []
