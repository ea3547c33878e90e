"""Types that grow: the lattice, landing batches of different types, tables that widen, and batches that come late."""

import decimal
import glob
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import model
from rivulet.functions.widening import joined, wider
from rivulet.plans.landing_run import loaded_batches, run_landing
from rivulet.session import scratch
from rivulet.sources import landing
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.streaming.landing_watch import LandingWatch, batch_states
from tests.helpers import rows

SIMPLE = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType(),
    T.BinaryType(), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.NullType(),
]
kinds = st.one_of(st.sampled_from(SIMPLE), st.builds(lambda p, s: T.DecimalType(p, min(s, p)), st.integers(1, 38), st.integers(0, 38)))


@given(kinds, kinds, kinds)
@settings(max_examples=500, deadline=None)
def test_the_order_of_types_does_not_matter(a, b, c):
    assert wider(a, b) == wider(b, a) and wider(a, a) == a
    assert wider(wider(a, b), c) == wider(a, wider(b, c))
    assert wider(wider(a, b), b) == wider(a, b)


@pytest.mark.parametrize(("a", "b", "want"), [
    ("int", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(38,30)", "double"), ("decimal(4,1)", "double", "double"),
    ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("boolean", "int", "string"), ("float", "bigint", "double"),
])
def test_common_types(spark, a, b, want):
    one, two = (T.StructType.fromDDL(f"x {k}")["x"].dataType for k in (a, b))
    assert wider(one, two).simpleString() == want


def test_nested_types_have_no_common_one(spark):
    with pytest.raises(TypeError, match="no common type"):
        wider(T.ArrayType(T.IntegerType()), T.StringType())
    both = joined([model.shape("a int, B string"), model.shape("b string, A bigint, c date")])
    assert both.simpleString() == "struct<a:bigint,B:string,c:date>"


SHAPE = model.shape("tenant_id int, id int, v int, note string, batch_id bigint, _op string")
REGISTRY = [("s", "t", "t", "id", True)]


def land(spark, base, batch, ddl, data, tenant=1, table="t"):
    spark.createDataFrame(data, ddl).coalesce(1).write.parquet(f"{base}/tenant_id={tenant}/schema_name=s/table_name={table}/batch_id={batch}")


def made(spark, base):
    tables = BucketStore(spark, f"{base}-bronze", {"t": SHAPE}, {"t": ["id"]}, 4)
    return tables, ControlStore(spark, f"{base}-control"), spark.createDataFrame(REGISTRY, model.REGISTRY)


def run(base, parts, run_id="r1", **options):
    tables, kept, registry = parts
    return run_landing(base, registry, tables, run_id=run_id, as_of=F.lit("2024-01-01").cast("timestamp"), kept=kept, **options)


def test_a_batch_that_turns_int_into_decimal_loads(spark):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int, note string", [(1, 5, "a"), (2, 6, "b")])
    land(spark, base, 1, "id int, v int, note string", [(1, 50, "a")], tenant=2)
    parts = made(spark, base)
    assert rows(run(base, parts).results, "status") == [("SUCCESS",)] * 2
    old = parts[0].path("t")
    land(spark, base, 2, "id int, v decimal(6,2)", [(2, decimal.Decimal("7.25")), (3, decimal.Decimal("1.5"))])
    run(base, parts, "r2")
    D = decimal.Decimal
    assert rows(parts[0].read("t"), "tenant_id", "id", "v", "note") == sorted(
        [(1, 1, D("5.00"), "a"), (1, 2, D("7.25"), "b"), (1, 3, D("1.50"), None), (2, 1, D("50.00"), "a")], key=repr)
    assert parts[0].schema("t")["v"].dataType == wider(T.IntegerType(), T.DecimalType(6, 2))
    # a store opened anew knows the grown table; the old one still lies in its folder
    again = BucketStore(spark, f"{base}-bronze", {"t": SHAPE}, {"t": ["id"]}, 4)
    assert rows(again.read("t")) == rows(parts[0].read("t")) and again.path("t") != old
    assert spark.read.parquet(old).count() == 3


def test_batches_of_many_types_are_one_scan_each_and_columns_may_come(spark):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int", [(1, 1)])
    land(spark, base, 2, "id int, v bigint, extra date", [(2, 2**40, None)])
    land(spark, base, 3, "id int, v int", [(3, 3)])
    listed = landing.landing_batches(spark, base).collect()
    brought = landing.batch_schemas(spark, base, listed)
    whole = landing.read_batches(spark, base, brought)
    assert dict(whole.dtypes)["v"] == "bigint" and whole.count() == 3
    assert whole._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert landing.schema_gaps(brought) == {"extra": [(1, "s", 1), (1, "s", 3)]}
    parts = made(spark, base)
    run(base, parts, add_columns=True)
    assert "extra" in parts[0].schema("t").names and rows(parts[0].read("t"), "id", "v") == [(1, 1), (2, 2**40), (3, 3)]


def test_a_new_column_rewrites_no_file(spark):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int", [(n, n) for n in range(40)])
    parts = made(spark, base)
    run(base, parts)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{parts[0].path('t').removeprefix('file:')}/**/*.parquet", recursive=True)}
    assert parts[0].widen("t", model.shape("id int, more double")) and not parts[0].widen("t", model.shape("more float"))
    assert before.items() <= {f: os.stat(f).st_mtime_ns for f in before}.items()
    assert parts[0].read("t").filter("more IS NULL").count() == 40
    with pytest.raises(TypeError, match="keys of t"):
        parts[0].widen("t", model.shape("id string"))


def test_landing_outcomes_are_kept_by_run(spark):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int", [(1, 1)])
    land(spark, base, 1, "id int", [(1,)], table="unknown")
    parts = made(spark, base)
    run(base, parts)
    kept = parts[1]
    assert rows(kept.read("detail"), "source_table", "status", "inserted_rows") == [("t", "SUCCESS", 1), ("unknown", "SKIPPED", 0)]
    assert rows(kept.read("header"), "status", "total_tables") == [("SUCCESS", 2)]
    assert rows(kept.marks(), "source_table", "last_batch_id") == [("t", 1)] and rows(kept.gate(), "batch_id") == [(1,)]
    run(base, parts)  # done again under its id: nothing is there twice
    assert rows(kept.read("detail"), "source_table", "status", "inserted_rows") == [("t", "SUCCESS", 1), ("unknown", "SKIPPED", 0)]
    assert run(base, parts, "r2").results.filter("source_table = 't'").count() == 0


def test_a_write_that_fails_is_told_apart_from_bad_data(spark, monkeypatch):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int", [(1, 1)])
    parts = made(spark, base)

    def full(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(BucketStore, "change", full)
        assert rows(run(base, parts).results, "status", "error_message") == [("FATAL", "not stored: disk full")]
    assert parts[1].marks().count() == parts[1].gate().count() == 0
    land(spark, base, 2, "v int", [(1,)])
    failed = run(base, parts, "r2").results
    assert {r[0] for r in rows(failed, "status")} == {"SUCCESS"}  # the key is there in the other batch; its row has none


def test_replay_into_folders(spark):
    base = scratch(spark, "widen")
    land(spark, base, 1, "id int, v int", [(1, 1), (2, 2)])
    parts = made(spark, base)
    run(base, parts)
    other = scratch(spark, "widen-again")
    land(spark, other, 1, "id int, v int", [(1, 10)])
    run(other, parts, "r2", replay=(1, 1))
    assert rows(parts[0].read("t"), "id", "v") == [(1, 10)]


def test_each_look_finds_new_folders_only(spark):
    base = scratch(spark, "watch")
    watch = LandingWatch(spark, f"{base}/tree", f"{base}/state")
    land(spark, f"{base}/tree", 5, "id int, v int", [(1, 1)])
    land(spark, f"{base}/tree", 6, "id int, v int", [(1, 1)], tenant=2)
    assert rows(watch.look(), "tenant_id", "schema_name", "table_name", "batch_id", "files") == [(1, "s", "t", 5, 1), (2, "s", "t", 6, 1)]
    assert watch.look().count() == 0
    land(spark, f"{base}/tree", 4, "id int, v int", [(9, 9)])
    land(spark, f"{base}/tree", 7, "id int, v int", [(1, 7)])
    again = LandingWatch(spark, f"{base}/tree", f"{base}/state")
    assert rows(again.look(), "batch_id") == [(4,), (7,)]
    assert rows(again.found(), "batch_id") == [(4,), (5,), (6,), (7,)]


def test_late_batches_are_reported_not_skipped(spark):
    base = scratch(spark, "watch")
    watch, parts = LandingWatch(spark, f"{base}/tree", f"{base}/state"), made(spark, base)
    land(spark, f"{base}/tree", 5, "id int, v int", [(1, 1)])
    run(f"{base}/tree", parts, found=watch.look())
    land(spark, f"{base}/tree", 4, "id int, v int", [(9, 9)])
    land(spark, f"{base}/tree", 6, "id int, v int", [(1, 6)])
    watch.look()
    states = batch_states(watch.found(), loaded_batches(parts[1]), parts[1].marks())
    assert rows(states, "batch_id", "state") == [(4, "LATE"), (5, "LOADED"), (6, "PENDING")]
    run(f"{base}/tree", parts, "r2", found=states.filter("state = 'PENDING'"))
    run(f"{base}/tree", parts, "r3", found=states.filter("state = 'LATE'"), replay=(4, 4))
    assert rows(parts[0].read("t"), "id", "v") == [(1, 6), (9, 9)]
    assert rows(batch_states(watch.found(), loaded_batches(parts[1]), parts[1].marks()), "state") == [("LOADED",)] * 3
