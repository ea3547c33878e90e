"""Plans that must keep their shape at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rivulet.operators import merge
from rivulet.session import settle, shared_dir, tune
from tests.helpers import plan

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """The adaptive plan after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_when_nothing_can_be_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    tune(spark)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        target = settle(
            spark.range(0, 60_000, 1, 8).select(
                F.lit(1).alias("tenant_id"),
                F.when(F.col("id") < 40_000, 7).otherwise(F.col("id")).alias("k"),
                F.sha2(F.col("id").cast("string"), 256).alias("v"),
            )
        )
        source = settle(
            spark.range(0, 60_000, 1, 8).select(F.lit(1).alias("tenant_id"), F.col("id").alias("k"), F.lit("new").alias("v"))
        )
        state = merge.upsert(target, source, ["tenant_id", "k"])
        text = final_plan(state)
        assert "skew=true" in text
        assert state.count() == 60_000 + 39_999 and state.filter("v = 'new'").count() == state.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["q_latest_op_wins", "q_drop_dup_keys", "q_primary_email"])
def test_survivors_are_cut_before_the_shuffle(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert text.count("WindowGroupLimit") >= 2


def test_scans_read_only_what_is_asked(spark):
    text = plan(entry.queries()["q_duplicate_keys"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_no_cartesian_product_of_tables(spark):
    for name in ("q_dim_base", "q_changed_keys", "q_landing_load", "q_ghost_delete", "q_cdc_apply"):
        assert "CartesianProduct" not in plan(entry.queries()[name](spark, SF))


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)
