import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.operators import merge
from rivulet.operators.dedupe import DuplicateKeys, drop_duplicate_keys, latest_op_wins, require_unique
from rivulet.session import settle
from tests.helpers import plan, rows

T = "tenant_id int, k string, a string, created_on string, b int"
KEYS = ["tenant_id", "k"]


def target(spark):
    return spark.createDataFrame(
        [(1, "x", "old", "c0", 1), (1, None, "null key", "c0", 2), (1, "z", "stay", "c0", 3), (2, "x", "other", "c0", 4)], T
    )


def test_null_key_matches_only_when_null_safe(spark):
    source = spark.createDataFrame([(1, None, "new")], "tenant_id int, k string, a string")
    safe = rows(merge.upsert(target(spark), source, KEYS), "k", "a", "b")
    assert (None, "new", 2) in safe and len(safe) == 4
    plain = rows(merge.upsert(target(spark), source, KEYS, null_safe=False), "k", "a", "b")
    assert (None, "null key", 2) in plain and (None, "new", None) in plain and len(plain) == 5


def test_keys_differing_in_case_are_one_row(spark):
    source = spark.createDataFrame([(1, "X", "new")], "tenant_id int, k string, a string")
    assert len(rows(merge.upsert(target(spark), source, KEYS))) == 4
    assert len(rows(merge.upsert(target(spark), source, KEYS, fold_case=False))) == 5


def test_cdc_delete_update_insert_and_create_once(spark):
    changes = spark.createDataFrame(
        [(1, "x", "new", "c1", "u"), (1, "z", None, None, "d"), (2, "n", "born", "c1", "c"), (2, "gone", "", "", "d")],
        "tenant_id int, k string, a string, created_on string, _op string",
    )
    got = rows(
        merge.cdc_apply(target(spark), changes, KEYS, create_once=["created_on"]),
        "tenant_id", "k", "a", "created_on", "b",
    )
    assert got == sorted(
        [(1, "x", "new", "c0", 1), (1, None, "null key", "c0", 2), (2, "x", "other", "c0", 4), (2, "n", "born", "c1", None)],
        key=repr,
    )


def test_column_not_carried_is_left_alone(spark):
    changes = spark.createDataFrame([(1, "x", None, "u")], "tenant_id int, k string, a string, _op string")
    kept = rows(merge.cdc_apply(target(spark), changes, KEYS, write_columns=KEYS), "k", "a")
    assert ("x", "old") in kept
    nulled = rows(merge.cdc_apply(target(spark), changes, KEYS), "tenant_id", "k", "a")
    assert (1, "x", None) in nulled


def test_presence_per_row(spark):
    changes = spark.createDataFrame(
        [(1, "x", None, "u", ["k"]), (1, "z", None, "u", ["k", "a"])],
        "tenant_id int, k string, a string, _op string, _carried array<string>",
    )
    got = rows(merge.cdc_apply(target(spark), changes, KEYS, carried="_carried"), "tenant_id", "k", "a")
    assert (1, "x", "old") in got and (1, "z", None) in got


def test_guard_ignores_changes_older_than_the_row(spark):
    state = spark.createDataFrame([(1, "x", "now", "0009")], "tenant_id int, k string, a string, pos string")
    late = spark.createDataFrame(
        [(1, "X", "back in time", "0005", "u"), (1, "y", "new", "0001", "c")],
        "tenant_id int, k string, a string, pos string, _op string",
    )
    got = rows(merge.cdc_apply(state, late, KEYS, guard_log_position="pos"), "k", "a")
    assert got == [("x", "now"), ("y", "new")]


def test_full_sync_touches_one_tenant(spark):
    source = spark.createDataFrame([(1, "x", "s"), (1, "q", "s")], "tenant_id int, k string, a string")
    got = rows(merge.full_sync(target(spark), source, KEYS, 1), "tenant_id", "k", "a")
    assert got == [(1, "q", "s"), (1, "x", "s"), (2, "x", "other")]


def test_fill_inserts_nothing(spark):
    source = spark.createDataFrame([(1, "x", "s", 9), (1, "q", "s", 9)], "tenant_id int, k string, a string, b int")
    got = rows(merge.fill(target(spark), source, KEYS, ["b"]), "tenant_id", "k", "a", "b")
    assert (1, "x", "old", 9) in got and len(got) == 4


def test_unknown_scope_rows_survive(spark):
    state = spark.createDataFrame([(None, "x"), (1, "y"), (1, "z")], "tenant_id int, k string")
    source = spark.createDataFrame([(1, "z")], "tenant_id int, k string")
    assert rows(merge.full_sync(state, source, KEYS, 1)) == [(1, "z"), (None, "x")]


def test_insert_if_absent_keeps_what_is_there(spark):
    gate = spark.createDataFrame([(1, "a")], "batch_id bigint, execution_id string")
    new = spark.createDataFrame([(1, "b"), (2, "b"), (2, "b")], "batch_id bigint, execution_id string")
    assert rows(merge.insert_if_absent(gate, new, ["batch_id"])) == [(1, "a"), (2, "b")]


def test_watermark_never_goes_back_unless_told(spark):
    schema = "tenant_id int, schema_name string, source_table string, last_batch_id bigint"
    marks = spark.createDataFrame([(1, "s", "t", 9)], schema)
    replayed = spark.createDataFrame([(1, "s", "t", 5)], schema)
    assert rows(merge.watermark_upsert(marks, replayed))[0][3] == 9
    assert rows(merge.watermark_upsert(marks, replayed, monotonic=False))[0][3] == 5


def test_two_source_rows_for_a_key_are_refused(spark):
    source = spark.createDataFrame([(1, "x"), (1, "X")], "tenant_id int, k string")
    with pytest.raises(ValueError, match="more than one source row"):
        require_unique(source, KEYS)


def test_merges_refuse_two_source_rows_for_a_key(spark):
    target = spark.createDataFrame([(1, 1, "old")], "tenant_id int, id int, v string")
    twice = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c")], "tenant_id int, id int, v string")
    with pytest.raises(DuplicateKeys) as refused:
        merge.upsert(target, twice, ["tenant_id", "id"])
    assert [k["cnt"] for k in refused.value.keys] == [2]


def test_a_missing_audit_time_does_not_erase_the_stored_one(spark):
    target = spark.createDataFrame([(1, "t0", "n0")], "id int, ModifiedOn string, Note string")
    source = spark.createDataFrame([(1, None, None)], "id int, ModifiedOn string, Note string")
    got = merge.merge_state(target, source, ["id"], keep_when_null={"modifiedon"})
    assert rows(got) == [(1, "t0", None)]


def test_latest_op_wins_ties_and_missing_positions(spark):
    log = spark.createDataFrame(
        [(1, "A", None, 9, "no position"), (1, "a", "0001", 1, "low"), (1, "a", "0002", 1, "first"), (1, "A", "0002", 2, "last")],
        "tenant_id int, k string, commit_lsn string, stage_seq bigint, v string",
    )
    assert rows(latest_op_wins(log, KEYS), "k", "v") == [("a", "last")]


def test_duplicate_choice_is_repeatable(spark):
    df = spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (1, "x", None)], "tenant_id int, k string, a string")
    for shuffled in (df, df.orderBy(F.rand(1)), df.repartition(3)):
        assert rows(drop_duplicate_keys(shuffled, KEYS), "a") == [("a",)]


def test_small_source_does_not_shuffle_the_target(spark):
    big = spark.range(200_000).select(
        F.lit(1).alias("tenant_id"), F.col("id").cast("string").alias("k"), F.lit("v").alias("a")
    )
    small = spark.createDataFrame([(1, "5", "new", "u")], "tenant_id int, k string, a string, _op string")
    steps = plan(merge.cdc_apply(big, settle(small), KEYS)).splitlines()
    for kind in ("LeftOuter", "LeftSemi"):
        joins = [s for s in steps if kind in s]
        assert joins and all("BroadcastHashJoin" in s for s in joins)


keys_of = st.integers(0, 6)
op_of = st.sampled_from(["c", "u", "d"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    held=st.dictionaries(st.tuples(st.integers(1, 2), keys_of), st.integers(0, 99)),
    log=st.lists(st.tuples(st.integers(1, 2), keys_of, op_of, st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99))),
)
def test_apply_equals_brute_force(spark, held, log):
    state = spark.createDataFrame([(t, k, v) for (t, k), v in held.items()], "tenant_id int, k int, v int")
    events = spark.createDataFrame(
        [(t, k, op, None if p is None else f"{p:04}", n, v) for n, (t, k, op, p, v) in enumerate(log)],
        "tenant_id int, k int, _op string, commit_lsn string, stage_seq bigint, v int",
    )
    want = dict(held)
    last = {}
    for n, (t, k, op, p, v) in enumerate(log):
        rank = (p is not None, p or 0, n)
        if (t, k) not in last or rank > last[t, k][0]:
            last[t, k] = (rank, op, v)
    for key, (_, op, v) in last.items():
        if op == "d":
            want.pop(key, None)
        else:
            want[key] = v
    got = merge.cdc_apply(state, latest_op_wins(events, KEYS), KEYS, write_columns=["tenant_id", "k", "v"])
    assert {(r[0], r[1]): r[2] for r in got.collect()} == want
