import datetime

import pytest
from pyspark.sql import functions as F

from rivulet.operators import merge
from rivulet.plans.bronze import full_reload, full_replacement, ghost_sweep, interim_fill, landing_load
from rivulet.session import scratch
from rivulet.sources import landing, sinks
from rivulet.sources.source_db import ParquetSource, partition_bounds, split_options, split_ranges
from tests.helpers import plan, rows

AT = "2024-01-01 00:00:00"


def at():
    return F.lit(AT).cast("timestamp")


def write_tree(spark, batches):
    """``batches``: (batch id, schema, rows); one folder each, columns may differ."""
    base = scratch(spark, "landing-test")
    for batch, schema, data in batches:
        df = spark.createDataFrame(data, schema)
        df.write.parquet(f"{base}/tenant_id=1/schema_name=s/table_name=t/batch_id={batch}")
    return base


TARGET = "tenant_id int, id int, a string, b string, batch_id bigint, _op string"


def target(spark):
    return spark.createDataFrame([(1, 1, "a0", "b0", 0, "I"), (1, 9, "a9", "b9", 0, "I"), (2, 1, "x", "x", 0, "I")], TARGET)


def one_by_one(spark, base, state, batches):
    """What merging batch after batch gives."""
    for batch in batches:
        path = f"{base}/tenant_id=1/schema_name=s/table_name=t/batch_id={batch}"
        df = spark.read.parquet(path).withColumns(
            {"tenant_id": F.lit(1), "batch_id": F.lit(batch).cast("bigint"), "_op": F.lit("I")}
        )
        state = merge.upsert(state, df, ["tenant_id", "id"])
    return state


@pytest.mark.parametrize("drift", [False, True])
def test_one_plan_equals_batch_after_batch(spark, drift):
    both, only_a = "id int, a string, b string", "id int, a string"
    base = write_tree(
        spark,
        [
            (10, both, [(1, "a1", "b1"), (2, "a1", "b1"), (3, "a1", None)]),
            (20, only_a if drift else both, [(1, "a2"), (4, "a2"), (9, None)] if drift else [(1, "a2", None), (4, "a2", "b2")]),
            (30, both, [(2, None, "b3")]),
        ],
    )
    found = landing.landing_batches(spark, base)
    gaps = landing.batch_gaps(spark, base, "t", found)
    assert gaps == ({"b": [(1, "s", 20)]} if drift else {})
    pending = landing.read_landing(spark, base, table_name="t", widen=drift).drop("schema_name", "table_name")
    got = landing_load(target(spark), pending, ["id"], run_id="r", as_of=at(), gaps=gaps)
    assert rows(got) == rows(one_by_one(spark, base, target(spark), [10, 20, 30]))


def test_tables_of_a_tree_keep_their_own_columns(spark):
    base = scratch(spark, "landing-test")
    spark.createDataFrame([(1, "x")], "id int, a string").write.parquet(f"{base}/tenant_id=1/schema_name=s/table_name=alpha/batch_id=1")
    spark.createDataFrame([(2, "y", 3.5)], "id int, zed string, price double").write.parquet(
        f"{base}/tenant_id=1/schema_name=s/table_name=beta/batch_id=1")
    assert rows(landing.read_landing(spark, base, table_name="beta"), "id", "zed", "price") == [(2, "y", 3.5)]
    assert rows(landing.read_landing(spark, base, table_name="alpha", batches=[1]), "id", "a") == [(1, "x")]


def test_a_column_that_one_tenant_lacks_is_left_alone_there(spark):
    base = scratch(spark, "landing-test")
    spark.createDataFrame([(1, "a1", "b1")], "id int, a string, b string").write.parquet(
        f"{base}/tenant_id=1/schema_name=s/table_name=t/batch_id=5")
    spark.createDataFrame([(1, "a2")], "id int, a string").write.parquet(f"{base}/tenant_id=2/schema_name=s/table_name=t/batch_id=5")
    found = landing.landing_batches(spark, base)
    gaps = landing.batch_gaps(spark, base, "t", found)
    assert gaps == {"b": [(2, "s", 5)]}
    held = landing.read_landing(spark, base, table_name="t", widen=True)
    state = landing_load(target(spark), held, ["id"], run_id="r", as_of=at(), gaps=gaps)
    assert rows(state.filter("id = 1"), "tenant_id", "a", "b") == [(1, "a1", "b1"), (2, "a2", "x")]


def test_replay_without_a_tenant_is_refused(spark):
    with pytest.raises(ValueError, match="tenant"):
        landing_load(target(spark), target(spark), ["id"], run_id="r", as_of=at(), replay=(1, 2))


def test_only_asked_folders_are_read(spark):
    base = write_tree(spark, [(10, "id int", [(1,)]), (20, "id int", [(2,)])])
    df = landing.read_landing(spark, base, tenant_id=1, batches=[20])
    assert rows(df, "id", "batch_id") == [(2, 20)]
    assert df.inputFiles() and all("/batch_id=20/" in f for f in df.inputFiles())


def test_table_without_mark_is_all_pending(spark):
    batches = spark.createDataFrame([(1, "s", "t", 1), (1, "s", "t", 2), (1, "s", "u", 1)],
                                    "tenant_id int, schema_name string, table_name string, batch_id bigint")
    marks = spark.createDataFrame([(1, "s", "t", 1)], "tenant_id int, schema_name string, source_table string, last_batch_id bigint")
    assert rows(landing.pending_batches(batches, marks), "table_name", "batch_id") == [("t", 2), ("u", 1)]
    assert rows(landing.replay_range(batches, last=1), "table_name") == [("t",), ("u",)]


def test_replay_drops_rows_the_batch_no_longer_has(spark):
    state = spark.createDataFrame([(1, 1, "a", "b", 5, "I"), (1, 2, "a", "b", 5, "I"), (2, 2, "a", "b", 5, "I")], TARGET)
    again = spark.createDataFrame([(1, 1, "new", "new", 5)], "tenant_id int, id int, a string, b string, batch_id bigint")
    got = landing_load(state, again, ["id"], run_id="r", as_of=at(), replay=(5, 5), tenant_id=1)
    assert rows(got, "tenant_id", "id", "a") == [(1, 1, "new"), (2, 2, "a")]


def test_inventory_and_diff(spark):
    base = write_tree(spark, [(10, "id int", [(1,)]), (20, "id int", [(2,)])])
    here = landing.landing_inventory(spark, base)
    r = here.first()
    assert r["files"] >= 2 and r["bytes"] > 0
    gone = here.filter("files < 0")
    assert rows(landing.landing_diff(here, here), "status") == [("SKIPPED_SAME",)]
    assert rows(landing.landing_diff(here, gone), "status") == [("TO_COPY",)]
    assert rows(landing.landing_diff(gone, here), "status") == [("ONLY_DESTINATION",)]


def test_slice_swap_on_files(spark):
    path = scratch(spark, "slices")
    sinks.append(target(spark), path)
    state = spark.read.parquet(path).select(*target(spark).columns)
    new = merge.full_sync(state, spark.createDataFrame([(1, 5, "n")], "tenant_id int, id int, a string"), ["tenant_id", "id"], 1)
    sinks.replace_slices(new.filter("tenant_id = 1"), path, [1])
    assert rows(spark.read.parquet(path), "tenant_id", "id") == [(1, 5), (2, 1)]
    # a tenant left without rows must not keep its old ones
    sinks.replace_slices(spark.read.parquet(path).filter("tenant_id = 1 AND id < 0"), path, [1])
    assert rows(spark.read.parquet(path), "tenant_id", "id") == [(2, 1)]


def test_widened_files_are_read_back(spark):
    path = scratch(spark, "widen")
    sinks.append(spark.createDataFrame([(1, 1)], "tenant_id int, a int"), path)
    sinks.append(spark.createDataFrame([(1, 2, "x")], "tenant_id int, a int, extra string"), path)
    assert rows(sinks.read_widened(spark, path), "a", "extra") == [(1, None), (2, "x")]


def test_full_reload_modes(spark):
    source = spark.createDataFrame([(1, "r", "dropped"), (7, "r", "dropped")], "id int, a string, other string")
    args = dict(tenant_id=1, batch_id=3, run_id="r", as_of=at())
    merged = full_reload(target(spark), source, ["id"], **args)
    assert rows(merged, "tenant_id", "id", "a", "b", "_op") == [
        (1, 1, "r", "b0", "r"), (1, 7, "r", None, "r"), (1, 9, "a9", "b9", "I"), (2, 1, "x", "x", "I"),
    ]
    swapped = full_reload(target(spark), source, ["id"], overwrite_tenant=True, **args)
    assert rows(swapped, "tenant_id", "id") == [(1, 1), (1, 7), (2, 1)]
    with pytest.raises(ValueError, match="key columns missing"):
        full_reload(target(spark), source, ["nope"], **args)


def test_full_replacement_chooses_its_way(spark):
    source = spark.createDataFrame([(9, "s")], "id int, a string")
    args = dict(tenant_id=1, batch_id=3, run_id="r", as_of=at())
    state, method = full_replacement(target(spark), source, ["id"], **args)
    assert method == "merge_sync" and rows(state, "tenant_id", "id", "a", "b") == [(1, 9, "s", "b9"), (2, 1, "x", "x")]
    state, method = full_replacement(target(spark), source, [], **args)
    assert method == "overwrite_tenant" and rows(state, "tenant_id", "id", "a", "b") == [(1, 9, "s", None), (2, 1, "x", "x")]


def test_fill_counts_what_it_found(spark):
    state = spark.createDataFrame([(1, 1, None, "b", 3, "u"), (1, 2, None, "b", 3, "u"), (1, 3, None, "b", 3, "d")], TARGET)
    source = spark.createDataFrame([(1, "filled"), (3, "not asked")], "id int, a string")
    change = interim_fill(state, source, ["id"], ["a"], tenant_id=1, batch_id=3)
    assert rows(change.state, "id", "a") == [(1, "filled"), (2, None), (3, None)]
    assert rows(change.report) == [(2, 1, "a")]


def sweep(spark, ids, keys, batch=10, **options):
    state = spark.createDataFrame(
        [(1, k, f"v{k}", "b", 1, "I") for k in [*range(1, 21), None]] + [(1, 50, "late", "b", 99, "I"), (2, 1, "x", "x", 1, "I")],
        TARGET,
    )
    source = spark.createDataFrame([(k,) for k in ids], "id int")
    return ghost_sweep(
        state, source, keys, tenant_id=1, batch_id=batch, schema_name="s", source_table="t", bronze_table="b",
        as_of=at(), **options,
    )


def test_ghosts_go_and_are_logged(spark):
    state, log, report = sweep(spark, [k for k in range(1, 21) if k != 4], ["id"])
    left = [r[1] for r in rows(state, "tenant_id", "id")]
    assert 4 not in left[:-1] and None in left and 50 in left and len(left) == 22
    assert rows(log, "pk_json", "deleted_ts") == [('{"id":4}', datetime.datetime(2024, 1, 1))]
    assert rows(report, "status", "ghost_rows", "bronze_rows") == [("DELETED", 1, 22)]


def test_race_guard_spares_ids_above_the_source(spark):
    state, _, report = sweep(spark, range(1, 20), ["id"])
    assert rows(report, "status", "ghost_rows") == [("OK", 0)] and state.count() == 23


def test_fuse_and_dry_run_change_nothing(spark):
    half, log, report = sweep(spark, [*range(1, 11), 20], ["id"])
    assert rows(report, "status") == [("ABORTED_PCT_FUSE",)] and half.count() == 23 and log.count() == 0
    state, log, report = sweep(spark, [k for k in range(1, 21) if k != 4], ["id"], dry_run=True)
    assert rows(report, "status", "dry_run") == [("DRY", True)] and state.count() == 23 and log.count() == 0


def test_source_reader_prunes_and_pushes(spark):
    source = ParquetSource(spark, "/root/testdata/sf0.001")
    df = source.read("orders", ["o_orderkey"], F.col("o_totalprice") > 400000)
    text = plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "GreaterThan(o_totalprice,400000.0)" in text
    assert source.columns("nation").count() == 3


def test_split_reads(spark):
    df = spark.range(0, 100).toDF("id").withColumn("name", F.lit("x"))
    assert split_options(df, ["id"], 4) == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "99", "numPartitions": "4"}
    assert split_options(df, ["name"], 4) == {} and split_options(df, ["id"], 1) == {} and split_options(df.limit(0), ["id"], 4) == {}
    assert rows(split_ranges(partition_bounds(df, "id"), 4))[-1] == (3, 75, 99)
