"""Tables in folders by tenant and bucket: what a change rewrites, and what it leaves alone."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet import model
from rivulet.operators import merge
from rivulet.session import scratch
from rivulet.sources.buckets import BucketStore, bucket_of
from tests.helpers import plan, rows

SHAPE = model.shape("tenant_id int, id string, v string, batch_id bigint")
KEYS = ["tenant_id", "id"]


def store(spark, buckets=8, root=None, keys=("id",)):
    return BucketStore(spark, root or scratch(spark, "buckets"), {"t": SHAPE}, {"t": keys}, buckets)


def filled(spark, n=200, **options):
    made = store(spark, **options)
    for tenant in (1, 2):
        df = spark.range(n).select(F.lit(tenant).alias("tenant_id"), F.concat(F.lit("k"), "id").alias("id"), F.lit("old").alias("v"), F.lit(1).cast("bigint").alias("batch_id"))
        made.replace("t", tenant, df)
    return made


def files(made):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{made.path('t').removeprefix('file:')}/**/*.parquet", recursive=True)}


def upsert(held, changes):
    return merge.upsert(held, changes, KEYS, settled=True, unique=True)


def test_a_change_of_one_row_rewrites_one_folder(spark):
    made = filled(spark)
    before = files(made)
    swap = made.change("t", spark.createDataFrame([(1, "K7", "new", 2)], SHAPE), upsert)
    after = files(made)
    assert swap.folders == 1
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert len(changed) == 1 and "/tenant_id=1/" in changed.pop()
    got = {(r[0], r[1].lower()): r[2] for r in made.read("t").collect()}
    assert len(got) == 400 and got[1, "k7"] == "new" and [k for k, v in got.items() if v == "new"] == [(1, "k7")]


def test_a_change_reads_the_touched_folders_only(spark):
    made = filled(spark)
    places = made.places("t", spark.createDataFrame([(2, "k9", "", 1)], SHAPE))
    held = made.slice("t", places)
    assert "PartitionFilters: [" in plan(held) and "_bucket" in plan(held).split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < held.count() < 100


def test_random_changes_equal_a_plain_dictionary(spark):
    rng, made, want = random.Random(1), filled(spark, 60, buckets=5), {}
    want = {(t, f"k{k}"): "old" for t in (1, 2) for k in range(60)}
    for step in range(4):
        batch = {}
        for _ in range(rng.choice([1, 12])):
            batch[rng.choice([1, 2, 3]), f"k{rng.randrange(90)}"] = rng.choice(["d", "u"])
        df = spark.createDataFrame([(t, k.upper(), f"s{step}", op) for (t, k), op in batch.items()], "tenant_id int, id string, v string, _op string")
        made.change("t", df, lambda held, new: merge.cdc_apply(held, new, KEYS, write_columns=["tenant_id", "id", "v"], settled=True, unique=True))
        for key, op in batch.items():
            want.pop(key, None) if op == "d" else want.update({key: f"s{step}"})
        assert {(r[0], r[1].lower()): r[2] for r in made.read("t").collect()} == want


def test_folders_that_lose_all_rows_are_emptied(spark):
    made = filled(spark, 3, buckets=64)
    swap = made.delete("t", spark.createDataFrame([(1, "k0"), (1, "K1"), (1, "nobody"), (2, "k2")], "tenant_id int, id string"))
    assert swap.rows == 0 or swap.folders >= 1
    assert rows(made.read("t"), "tenant_id", "id") == [(1, "k2"), (2, "k0"), (2, "k1")]


def test_replaced_slice_and_empty_slice(spark):
    made = filled(spark, 20)
    before = {f: t for f, t in files(made).items() if "tenant_id=2" in f}
    made.replace("t", 1, spark.createDataFrame([(1, "only", "x", 9), (2, "other tenant", "x", 9)], SHAPE))
    assert rows(made.read("t").filter("tenant_id = 1")) == [(1, "only", "x", 9)]
    made.replace("t", 1, model.empty(spark, SHAPE))
    assert made.read("t").filter("tenant_id = 1").count() == 0
    assert {f: t for f, t in files(made).items() if "tenant_id=2" in f} == before


def test_rows_of_other_folders_are_refused(spark):
    made = filled(spark, 20)
    places = made.places("t", spark.createDataFrame([(1, "k1")], "tenant_id int, id string"))
    count = made.read("t").count()
    with pytest.raises(Exception, match="belongs to another folder"):
        made.swap("t", made.read("t"), places)
    assert made.read("t").count() == count


def test_the_first_number_of_buckets_stays(spark):
    made = filled(spark, 30, buckets=4)
    again = store(spark, buckets=99, root=made.path("t").removesuffix("/t"))
    assert again.buckets("t") == 4
    again.change("t", spark.createDataFrame([(1, "k3", "new", 2)], SHAPE), upsert)
    assert again.read("t").count() == 60
    with pytest.raises(ValueError, match="bucketed by"):
        store(spark, root=made.path("t").removesuffix("/t"), keys=("v",)).buckets("t")


def test_a_key_has_one_bucket_in_any_type_and_case(spark):
    shape = model.shape("a bigint, b string, c double, d timestamp, e decimal(10,2)")
    df = spark.sql("SELECT 5 AS a, 'Ab' AS b, 0.0D AS c, timestamp'2024-01-01' AS d, 1.5BD AS e")
    other = spark.sql("SELECT 5L AS a, 'aB' AS b, -0.0D AS c, timestamp'2024-01-01' AS d, 1.50BD AS e")
    one, two = (x.select(bucket_of(x.columns, shape, 1000)).first()[0] for x in (df, other))
    assert one == two


def test_tables_without_keys_and_undeclared_tables(spark):
    made = store(spark, keys=())
    assert made.read("nope") is None and made.read("t").count() == 0
    made.append("t", spark.createDataFrame([(1, "a", "x", 1)], SHAPE))
    before = files(made)
    made.append("t", spark.createDataFrame([(1, "a", "x", 1)], SHAPE))
    assert made.read("t").count() == 2 and set(before) < set(files(made)) and made.buckets("t") == 1
    made.replace("t", 1, spark.createDataFrame([(1, "b", "y", 2)], SHAPE))
    assert rows(made.read("t"), "id") == [("b",)]
    with pytest.raises(ValueError, match="has keys"):
        store(spark).append("t", model.empty(spark, SHAPE))
