import datetime
import json

import pytest
from pyspark.sql import functions as F

from rivulet import model
from rivulet.operators import checks, control
from rivulet.operators.payload import stage_envelope, tenant_cross_check
from rivulet.session import scratch
from rivulet.sources.sinks import BronzeStore
from rivulet.streaming.compaction import CycleFailed, compaction_cycle
from rivulet.streaming.stage import MESSAGE, StageRun, read_changes, read_stage, start_staging
from tests.helpers import rows

AT = datetime.datetime(2024, 1, 2)


def at():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def message(n, table, op, image, schema="app", db="shop"):
    body = {**image, "__op": op, "__source_table": table, "__source_schema": schema, "__source_db": db,
            "__source_ts_ms": 1704067200000 + n * 1000, "__source_commit_lsn": f"{n:08}"}
    return bytearray(json.dumps(body).encode()), datetime.datetime(2024, 1, 1, 0, 0, n), 0, n


MESSAGES = [
    message(1, "person", "c", {"Id": "A1", "Name": "first", "ModifiedOn": None}),
    message(2, "person", "u", {"Id": "a1", "Name": "second", "ModifiedOn": None}),
    message(3, "Person", "d", {"Id": "OLD", "Name": "x", "ModifiedOn": None}),
    message(4, "nokey", "u", {"Name": "no key here"}),
    message(5, "unknown", "u", {"Id": "1"}),
    message(6, "person", "u", {"Id": "z"}, db="otherdb"),
]
REGISTRY = [("App", "Person", "app_person", "Id", True), ("app", "nokey", "app_nokey", "Id", True), ("app", "unknown", "x", "Id", False)]


def placed(spark, messages):
    df = spark.createDataFrame(messages, MESSAGE)
    return df.withColumnsRenamed({"partition": "source_partition", "offset": "source_offset"}).withColumn(
        "source_partition", F.col("source_partition").cast("string")
    )


def ingest(spark, messages, **options):
    base = scratch(spark, "stream-test")
    df = spark.createDataFrame(messages, MESSAGE)
    df.repartition(3).write.parquet(f"{base}/in")
    run = StageRun(tenant_id=1, default_schema="app", expected_db="SHOP", batch_id=20240101000000, run_id="r",
                   stage_path=f"{base}/stage", stream_id="s1", ingest_ts=at())
    changes = read_changes(spark, "parquet", path=f"{base}/in", **options)
    start_staging(changes, run.append_batch, f"{base}/checkpoint").awaitTermination()
    return base, run


def test_stream_equals_batch(spark):
    _, run = ingest(spark, MESSAGES, maxFilesPerTrigger="1")
    staged = read_stage(spark, run.stage_path)
    df = placed(spark, MESSAGES)
    whole = tenant_cross_check(
        stage_envelope(df, tenant_id=1, default_schema="app", batch_id=20240101000000, micro_batch_id=0, run_id="r",
                       ingest_ts=at()), "shop")
    names = [c for c in whole.columns if c != "micro_batch_id"]
    assert rows(staged, *names) == rows(whole, *names)
    assert staged.select("stage_seq").distinct().count() == staged.count() == 5
    assert staged.select("micro_batch_id").distinct().count() > 1


def test_retried_micro_batch_lands_once_with_the_same_sequence(spark):
    _, run = ingest(spark, MESSAGES)
    before = rows(read_stage(spark, run.stage_path), "stage_seq", "commit_lsn")
    run.append_batch(placed(spark, MESSAGES).orderBy(F.rand(3)), 0)
    assert rows(read_stage(spark, run.stage_path), "stage_seq", "commit_lsn") == before


def test_changes_of_one_commit_keep_the_order_of_their_source(spark):
    """A delete and a new insert of one key share log position and time; only the offset tells them apart."""
    at_once = [
        message(1, "person", "c", {"Id": "7", "Name": "zoe"}), message(2, "person", "d", {"Id": "7", "Name": "zoe"}),
        message(3, "person", "c", {"Id": "7", "Name": "amy"}),
    ]
    same = json.loads(at_once[0][0])["__source_commit_lsn"]
    messages = []
    for value, _, partition, offset in at_once:
        body = json.loads(value) | {"__source_commit_lsn": same}
        messages.append((bytearray(json.dumps(body).encode()), AT, partition, offset))
    _, run = ingest(spark, messages[::-1])
    staged = read_stage(spark, run.stage_path)
    assert [r.op for r in staged.orderBy("stage_seq").collect()] == ["c", "d", "c"]
    cycle = cycle_over(spark, staged, {"app_person": people(spark)})
    assert rows(cycle.states["app", "person"].filter("Id = '7'"), "Name", "_op") == [("amy", "c")]


def test_sequence_goes_on_with_a_new_checkpoint(spark):
    base, run = ingest(spark, MESSAGES[:3])
    top = read_stage(spark, run.stage_path).agg(F.max("stage_seq")).first()[0]
    later = StageRun(**{**vars(run), "stream_id": "s2"})
    start_staging(read_changes(spark, "parquet", path=f"{base}/in"), later.append_batch, f"{base}/checkpoint2").awaitTermination()
    again = read_stage(spark, run.stage_path).filter("stream_id = 's2'")
    assert again.count() == 3 and again.agg(F.min("stage_seq")).first()[0] > top


def test_parquet_rows_without_offsets_stand_at_their_place(spark):
    base = scratch(spark, "stream-test")
    spark.createDataFrame([m[:2] for m in MESSAGES], "value binary, timestamp timestamp").coalesce(1).write.parquet(f"{base}/in")
    run = StageRun(tenant_id=1, default_schema="app", expected_db="SHOP", batch_id=1, run_id="r", stage_path=f"{base}/stage",
                   stream_id="s1", ingest_ts=at())
    start_staging(read_changes(spark, "parquet", path=f"{base}/in"), run.append_batch, f"{base}/checkpoint").awaitTermination()
    staged = read_stage(spark, run.stage_path).orderBy("stage_seq").collect()
    assert [r.commit_lsn for r in staged] == sorted(r.commit_lsn for r in staged)


def test_drained_stream_does_nothing_when_started_again(spark):
    base, run = ingest(spark, MESSAGES)
    before = read_stage(spark, run.stage_path).count()
    changes = read_changes(spark, "parquet", path=f"{base}/in")
    start_staging(changes, run.append_batch, f"{base}/checkpoint").awaitTermination()
    assert read_stage(spark, run.stage_path).count() == before


PERSON = model.shape(
    "tenant_id int, Id string, Name string, ModifiedOn timestamp, CreatedOn timestamp, Note string, _ingest_date date, "
    "_op string, batch_id bigint"
)


def cycle_over(spark, stage, targets, **options):
    registry = spark.createDataFrame(REGISTRY, model.REGISTRY)
    return compaction_cycle(
        stage, registry, targets.get, tenant_id=1, run_id="r1", as_of=at(),
        watermarks=model.empty(spark, model.WATERMARK), cursors=model.empty(spark, model.CURSOR),
        gate=model.empty(spark, model.GATE), **options,
    )


def people(spark):
    old = datetime.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [(1, "old", "gone soon", old, old, "note", old.date(), "r", 1), (1, "keep", "k", old, old, "note", old.date(), "r", 1),
         (2, "a1", "other tenant", old, old, "note", old.date(), "r", 1)], PERSON)


def test_cycle_end_to_end(spark):
    _, run = ingest(spark, MESSAGES)
    stage = read_stage(spark, run.stage_path)
    targets = {"app_person": people(spark), "app_nokey": people(spark)}
    cycle = cycle_over(spark, stage, targets)

    state = cycle.states["app", "person"]
    assert rows(state, "tenant_id", "Id", "Name", "Note") == [
        (1, "a1", "second", None), (1, "keep", "k", "note"), (2, "a1", "other tenant", "note"),
    ]
    new = state.filter("tenant_id = 1 AND Id = 'a1'").first()
    assert new["ModifiedOn"] == new["CreatedOn"] == datetime.datetime(2024, 1, 1, 0, 0, 2)

    assert cycle.status == "FAILED"
    assert rows(cycle.results, "source_table", "status", "inserted_rows", "deleted_rows") == [
        ("nokey", "FAILED", 0, 0), ("person", "SUCCESS", 1, 1), ("unknown", "SKIPPED", 0, 0),
    ]
    assert rows(cycle.dead_letters, "source_table", "error") == [("nokey", "key columns not captured: ['Id']")]
    assert rows(cycle.stage, "source_table") == [("unknown",)]
    assert rows(cycle.watermarks, "source_table", "last_batch_id") == [("person", 20240101000000)]
    assert rows(cycle.cursors, "last_stage_seq") == [(cycle.boundary,)]
    assert cycle.gate.count() == 0  # a table failed, so the batch is not promoted
    assert cycle.lag.count() >= 3

    # the same rows staged again change nothing
    again = cycle_over(spark, stage, {"app_person": state, "app_nokey": state})
    assert rows(again.states["app", "person"]) == rows(state)
    # what is left belongs to nobody
    rest = cycle_over(spark, cycle.stage, targets)
    assert rows(rest.results, "status") == [("SKIPPED",)] and not rest.states


def test_cycle_on_files(spark):
    """Tables live as folders; a second cycle reads what the first one wrote."""
    store = BronzeStore(spark, scratch(spark, "bronze-test"), {"app_person": PERSON})
    assert store.read("nope") is None and store.read("app_person").count() == 0
    _, run = ingest(spark, MESSAGES[:2])
    registry = spark.createDataFrame(REGISTRY, model.REGISTRY)

    def drain(stage, run_id):
        return compaction_cycle(
            stage, registry, store.read, tenant_id=1, run_id=run_id, as_of=at(),
            store=lambda key, state: store.write("app_person", state, 1, ["Id"]),
        )

    first = drain(read_stage(spark, run.stage_path), "r1")
    assert first.status == "SUCCESS" and first.states["app", "person"].count() == 1
    assert rows(store.read("app_person"), "tenant_id", "Id", "Name") == [(1, "a1", "second")]
    _, later = ingest(spark, [message(9, "person", "d", {"Id": "A1", "Name": ""})])
    assert drain(read_stage(spark, later.stage_path), "r2").status == "SUCCESS"
    assert store.read("app_person").count() == 0


def test_cycle_checks_pass_on_a_clean_run(spark):
    clean = [m for m in MESSAGES if b'"nokey"' not in bytes(m[0])]
    _, run = ingest(spark, clean)
    cycle = cycle_over(spark, read_stage(spark, run.stage_path), {"app_person": people(spark)}, schemas="APP")
    assert cycle.status == "SUCCESS" and rows(cycle.gate, "batch_id") == [(20240101000000,)]
    detail = control.run_detail(cycle.results, "r1", at())
    headers = control.run_summary(detail, "v", at())
    assert headers.dtypes == [(f.name, f.dataType.simpleString()) for f in model.RUN_HEADER.fields]
    assert detail.dtypes == [(f.name, f.dataType.simpleString()) for f in model.RUN_DETAIL.fields]
    result = checks.all_checks(
        detail=detail, headers=headers, marks=cycle.watermarks, gate=cycle.gate, cursors=cycle.cursors, stage=cycle.stage,
        registry=spark.createDataFrame(REGISTRY, model.REGISTRY),
        targets={"person": (cycle.states["app", "person"], ["tenant_id", "Id"])}, schemas=["app"], tenant_id=1,
        stage_before=read_stage(spark, run.stage_path),
    )
    bad = [r for r in result.collect() if r["status"] != "PASS"]
    assert not bad and result.count() >= 8


def test_lost_rows_of_unregistered_tables_are_seen(spark):
    _, run = ingest(spark, MESSAGES)
    stage = read_stage(spark, run.stage_path)
    registry = spark.createDataFrame(REGISTRY, model.REGISTRY)
    after = stage.filter("source_table <> 'unknown'")
    assert rows(checks.unregistered_kept(stage, stage, registry, 1), "measured", "status") == [(0, "PASS")]
    assert rows(checks.unregistered_kept(stage, after, registry, 1), "measured", "status") == [(1, "FAIL")]


def test_out_of_scope_and_unsettled(spark):
    _, run = ingest(spark, MESSAGES)
    stage = read_stage(spark, run.stage_path)
    skipped = cycle_over(spark, stage, {}, schemas="other")
    assert {r[0] for r in rows(skipped.results, "status")} == {"SKIPPED"}
    assert skipped.stage.count() == stage.count()
    assert cycle_over(spark, stage, {}, grace_minutes=5).status == "EMPTY"


def test_guard_rows_staged_later_survive(spark):
    """A row that settles later is neither read nor acknowledged, even with a lower sequence."""
    _, run = ingest(spark, MESSAGES)
    stage = read_stage(spark, run.stage_path)
    late = stage.filter("commit_lsn = '00000001'").withColumns(
        {"ingest_ts": F.lit("2024-01-03 00:00:00").cast("timestamp"), "stage_seq": F.lit(-1).cast("bigint")}
    )
    cycle = cycle_over(spark, stage.unionByName(late), {"app_person": people(spark)})
    assert (-1,) in rows(cycle.stage, "stage_seq")


def test_promotion_rules(spark):
    gate = spark.createDataFrame([(5, None, "x")], model.GATE)
    detail = spark.createDataFrame([(4, "SUCCESS"), (6, "SUCCESS"), (7, "FAILED"), (7, "SUCCESS")], "batch_id bigint, status string")
    good = detail.filter("batch_id < 6")
    assert rows(control.promotable_batches(detail, gate)) == [(6,)]
    assert rows(control.promotable_batches(detail, gate, "run_if_clean")) == []
    assert rows(control.promotable_batches(good, gate, "run_if_clean")) == [(4,)]
    assert rows(control.promotable_batches(good, gate, "run_if_newer")) == []
    assert rows(control.resolve_batch(None, detail.withColumn("tenant_id", F.lit(1)), 1)) == [(7,)]
    assert rows(control.resolve_batch(3, detail.withColumn("tenant_id", F.lit(1)), 1)) == [(3,)]


def test_whole_errors_are_kept_and_failed_writes_are_fatal(spark):
    _, run = ingest(spark, MESSAGES[:3])
    stage = read_stage(spark, run.stage_path)
    long = "e" * 1000

    def broken(name):
        raise ValueError(long)

    options = dict(tenant_id=1, run_id="r1", as_of=at())
    registry = spark.createDataFrame(REGISTRY, model.REGISTRY)
    cycle = compaction_cycle(stage, registry, broken, **options)
    assert cycle.results.first().error_message == long and cycle.status == "FAILED"
    assert {r.error for r in cycle.dead_letters.collect()} == {long}
    assert cycle.require_whole() is cycle

    def full_disk(key, state):
        raise OSError("disk full")

    cycle = compaction_cycle(stage, registry, {"app_person": people(spark)}.get, store=full_disk, **options)
    assert cycle.fatal and cycle.dead_letters.count() == 0
    assert cycle.stage.count() == stage.count()  # nothing is acknowledged
    with pytest.raises(CycleFailed, match="disk full"):
        cycle.require_whole()


def test_fatal_tables_hold_their_batch_back(spark):
    gate = model.empty(spark, model.GATE)
    detail = spark.createDataFrame([(1, "SUCCESS"), (1, "FATAL"), (2, "SUCCESS")], "batch_id bigint, status string")
    assert rows(control.promotable_batches(detail, gate)) == [(2,)]
