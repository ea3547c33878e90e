"""Reading a source by key ranges and by quantiles; lag sketches over cycles."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import control
from rivulet.plans.bronze import interim_fill
from rivulet.session import scratch
from rivulet.sources.source_db import (
    ParquetSource, near_keys, quantile_ranges, range_key, range_predicates, read_near,
)
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def source(spark):
    root = scratch(spark, "source-test")
    spark.range(0, 40_000, 1, 8).select("id", F.concat(F.lit("T"), "id").alias("code"), (F.col("id") * 2).alias("v")).write.parquet(f"{root}/t.parquet")
    return ParquetSource(spark, root)


def test_ranges_around_the_keys_are_pushed_to_the_scan(spark, source):
    wanted = spark.createDataFrame([(k,) for k in [*range(100, 140), *range(30_000, 30_040), 39_000]], "id bigint")
    got = read_near(source, "t", wanted, ["id"], ["id", "v"], ranges=4)
    text = plan(got)
    pushed = text.split("PushedFilters: [")[1].split("\n")[0]
    assert "GreaterThanOrEqual(id" in pushed and "LessThanOrEqual(id" in pushed
    assert "ReadSchema: struct<id:bigint,v:bigint>" in text
    assert got.join(wanted, "id", "left_semi").count() == wanted.count()
    assert got.count() < 1000


def test_nothing_wanted_reads_nothing_and_text_keys_read_all(spark, source):
    none = spark.createDataFrame([], "id bigint")
    assert near_keys(none, "id") is None and read_near(source, "t", none, ["id"], ["id"]).count() == 0
    text = spark.createDataFrame([("t5",)], "code string")
    assert range_key(text, ["code"]) is None and read_near(source, "t", text, ["code"], ["code"]).count() == 40_000
    both = spark.createDataFrame([("t5", 5)], "code string, id bigint")
    assert range_key(both, ["code", "id"]) == "id" and read_near(source, "t", both, ["code", "id"], ["code"]).count() == 1


def test_a_fill_asks_for_ranges_only(spark, source):
    target = spark.createDataFrame([(1, k, None, 7, "u") for k in (5, 900, 35_000)] + [(1, 6, 1, 7, "u")], "tenant_id int, id bigint, v bigint, batch_id bigint, _op string")
    change = interim_fill(target, (source, "t"), ["id"], ["v"], tenant_id=1, batch_id=7, ranges=3)
    assert rows(change.state, "id", "v") == [(35_000, 70_000), (5, 10), (6, 1), (900, 1800)]
    assert rows(change.report, "candidate_rows", "filled_rows") == [(3, 3)]


def keys_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


@pytest.mark.parametrize("name", ["even", "squares", "clusters", "few", "one", "negative"])
def test_quantile_ranges_are_even_and_whole(spark, name):
    rng = random.Random(3)
    values = {
        "even": range(5000), "squares": [n * n for n in range(5000)], "few": [3, 9], "one": [4],
        "clusters": sorted({*range(2000), *(10**15 + n for n in range(2000)), *(rng.randrange(10**12) for _ in range(50))}),
        "negative": range(-9000, -4000),
    }[name]
    got = quantile_ranges(keys_of(spark, values), "k", 8).orderBy("part").collect()
    assert got[0].from_key == min(values) and got[-1].to_key == max(values)
    assert all(b.from_key == a.to_key + 1 for a, b in zip(got, got[1:]))
    sizes = sorted(sum(r.from_key <= v <= r.to_key for v in values) for r in got)
    assert sum(sizes) == len(values) and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_predicates_take_every_row_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, *range(-5, 60)]], "k bigint")
    conditions = range_predicates(quantile_ranges(df.filter("k BETWEEN 0 AND 50"), "k", 4), "k")
    assert len(conditions) == 4
    parts = [df.filter(c) for c in conditions]
    assert sum(p.count() for p in parts) == df.count()
    assert range_predicates(quantile_ranges(keys_of(spark, [1]), "k", 4), "k") == ["1 = 1"]
    assert range_predicates(quantile_ranges(keys_of(spark, []), "k", 4), "k") == []


def test_lag_over_ten_cycles_is_close_to_the_exact_one(spark):
    rng, cycles, every = random.Random(8), [], []
    as_of = F.lit("2024-02-01").cast("timestamp")
    for n in range(10):
        lags = [int(rng.paretovariate(0.4)) % 80_000 + 100 * n for _ in range(rng.randrange(50, 3000))]
        every += lags
        stage = spark.createDataFrame([(v,) for v in lags], "lag bigint").select(
            F.lit("s").alias("source_schema"), F.lit("t").alias("source_table"), (as_of - F.make_dt_interval(secs=F.col("lag"))).alias("source_commit_ts"))
        cycles.append(control.lag_sketches(stage, as_of).collect()[0])
    kept = spark.createDataFrame(cycles, "source_schema string, source_table string, lag_sketch binary")
    row = control.lag_over_cycles(kept).first()
    assert row.rows_processed == len(every)
    for rank, value in ((0.5, row.lag_p50_s), (0.95, row.lag_p95_s)):
        below, upto = sum(v < value for v in every), sum(v <= value for v in every)
        assert below - 0.01 * len(every) <= rank * len(every) <= upto + 0.01 * len(every)
