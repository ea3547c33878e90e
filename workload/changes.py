"""Table-change operators on the order change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import model
from rivulet.operators import merge
from rivulet.operators.dedupe import DuplicateKeys, drop_duplicate_keys, duplicate_keys, latest_op_wins
from rivulet.operators.payload import hole_candidates
from rivulet.plans import bronze
from rivulet.session import scratch, settle
from rivulet.sources import sinks
from rivulet.sources.buckets import BucketStore
from rivulet.sources.source_db import ParquetSource
from workload.catalog import query
from workload.inputs import Inputs

KEYS = ["tenant_id", "o_orderkey"]
RUN = "run-1"
AS_OF = "2024-02-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


_SURVIVORS = """
    SELECT tenant_id, o_orderkey, op, commit_lsn, stage_seq, status, price, modified FROM (
        SELECT *, row_number() OVER (PARTITION BY tenant_id, o_orderkey
            ORDER BY commit_lsn DESC NULLS LAST, stage_seq DESC, op, status, price, modified) AS rn
        FROM f_change_log) s
    WHERE rn = 1"""
EXTRA = {"d_survivors": _SURVIVORS}


def survivors(i: Inputs) -> DataFrame:
    return latest_op_wins(i.f_change_log, KEYS)


@query("q_latest_op_wins", "SELECT * FROM d_survivors", EXTRA)
def _(i: Inputs) -> DataFrame:
    return survivors(i)


_APPLIED = """
    SELECT t.tenant_id, t.o_orderkey, CASE WHEN s.op IS NULL THEN t.status ELSE s.status END AS status,
           CASE WHEN s.op IS NULL THEN t.price ELSE {price} END AS price,
           CASE WHEN s.op IS NULL THEN t.modified ELSE s.modified END AS modified
    FROM f_target t LEFT JOIN d_survivors s ON t.tenant_id = s.tenant_id AND t.o_orderkey = s.o_orderkey
    WHERE s.op IS NULL OR s.op <> 'd'
    UNION ALL
    SELECT s.tenant_id, s.o_orderkey, s.status, {new_price}, s.modified
    FROM d_survivors s LEFT JOIN f_target t ON t.tenant_id = s.tenant_id AND t.o_orderkey = s.o_orderkey
    WHERE t.o_orderkey IS NULL AND s.op <> 'd'"""


@query("q_cdc_apply", _APPLIED.replace("{price}", "s.price").replace("{new_price}", "s.price"), EXTRA)
def _(i: Inputs) -> DataFrame:
    changes = settle(survivors(i), "changes")
    return merge.cdc_apply(
        i.f_target, changes, KEYS, op="op", write_columns=[*KEYS, "status", "price", "modified"], settled=True, unique=True
    )


@query(
    "q_cdc_apply_partial_cols",
    _APPLIED.replace("{price}", "t.price").replace("{new_price}", "CAST(NULL AS DOUBLE)"), EXTRA,
)
def _(i: Inputs) -> DataFrame:
    """The capture does not carry the price: stored prices stay, new rows have none."""
    changes = settle(survivors(i), "changes")
    return merge.cdc_apply(
        i.f_target, changes, KEYS, op="op", write_columns=[*KEYS, "status", "modified"], settled=True, unique=True
    )


@query(
    "q_merge_null_safe",
    """WITH t AS (SELECT tenant_id, nullif(status, 'P') AS k, max(price) AS price, count(*) AS n
                  FROM f_bronze GROUP BY 1, 2),
            s AS (SELECT tenant_id, nullif(status, 'P') AS k, min(price) AS price
                  FROM f_bronze WHERE tenant_id <> 3 GROUP BY 1, 2)
       SELECT t.tenant_id, t.k, coalesce(s.price, t.price) AS price, t.n
       FROM t LEFT JOIN s ON t.tenant_id = s.tenant_id AND t.k IS NOT DISTINCT FROM s.k""",
)
def _(i: Inputs) -> DataFrame:
    keyed = i.f_bronze.withColumn("k", F.nullif("status", F.lit("P"))).groupBy("tenant_id", "k")
    target = keyed.agg(F.max("price").alias("price"), F.count(F.lit(1)).alias("n"))
    source = keyed.agg(F.min("price").alias("price")).filter("tenant_id <> 3")
    return merge.upsert(target, source, ["tenant_id", "k"])


_UPSERT = """
    SELECT coalesce(s.tenant_id, t.tenant_id) AS tenant_id, coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           coalesce(s.status, t.status) AS status, coalesce(s.price, t.price) AS price, t.modified
    FROM f_target t FULL JOIN f_source_ok s ON t.tenant_id = s.tenant_id AND t.o_orderkey = s.o_orderkey"""


@query("q_upsert", _UPSERT)
def _(i: Inputs) -> DataFrame:
    return merge.upsert(i.f_target, i.f_source_ok, KEYS)


@query(
    "q_full_sync",
    """SELECT tenant_id, o_orderkey, status, price, modified FROM f_target WHERE tenant_id <> 2
       UNION ALL
       SELECT s.tenant_id, s.o_orderkey, s.status, s.price, t.modified
       FROM f_source_ok s LEFT JOIN f_target t ON t.tenant_id = s.tenant_id AND t.o_orderkey = s.o_orderkey
       WHERE s.tenant_id = 2""",
)
def _(i: Inputs) -> DataFrame:
    return merge.full_sync(i.f_target, i.f_source_ok.filter("tenant_id = 2"), KEYS, 2)


_SLICE = """
    SELECT tenant_id, o_orderkey, status, price FROM f_bronze WHERE tenant_id <> 3
    UNION ALL SELECT tenant_id, o_orderkey, status, price FROM f_source_ok WHERE tenant_id = 3"""


ORDERS = model.shape("tenant_id int, o_orderkey bigint, status string, price double")


def _orders_store(i: Inputs, keys: list[str]) -> BucketStore:
    store = BucketStore(i.spark, scratch(i.spark, "bronze"), {"orders": ORDERS}, {"orders": keys}, 8)
    store.load("orders", i.f_bronze)
    return store


@query("q_replace_tenant_slice", _SLICE)
def _(i: Inputs) -> DataFrame:
    """On files: the table lies by tenant and key bucket, then one tenant's folders are swapped."""
    store = _orders_store(i, ["o_orderkey"])
    store.replace("orders", 3, i.f_source_ok)
    return store.read("orders")


@query("q_overwrite_no_pk", _SLICE)
def _(i: Inputs) -> DataFrame:
    """A table without keys: the tenant's only folder is swapped."""
    store = _orders_store(i, [])
    state, method = bronze.full_replacement(
        store.read("orders"), i.f_source_ok.filter("tenant_id = 3").drop("tenant_id"), [],
        tenant_id=3, batch_id=1, run_id=RUN, as_of=as_of(),
    )
    assert method == "overwrite_tenant"
    store.replace("orders", 3, state)
    return store.read("orders")


@query(
    "q_append_no_pk",
    """SELECT tenant_id, o_orderkey, status, price FROM f_bronze
       UNION ALL SELECT tenant_id, o_orderkey, status, price FROM f_source_ok""",
)
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "append")
    shape = ["tenant_id", "o_orderkey", "status", "price"]
    sinks.append(i.f_bronze.select(*shape), path)
    sinks.append(i.f_source_ok.select(*shape), path)
    return i.spark.read.parquet(path).select(*shape)


@query(
    "q_append_widen",
    """SELECT tenant_id, o_orderkey, status, price, batch_id, _op, CAST(NULL AS TIMESTAMP) AS modified FROM f_bronze
       UNION ALL
       SELECT tenant_id, o_orderkey, status, price, CAST(NULL AS BIGINT), CAST(NULL AS STRING), modified FROM f_target""",
)
def _(i: Inputs) -> DataFrame:
    return sinks.append_widen(i.f_bronze, i.f_target)


@query(
    "q_replay_batch",
    """WITH landed AS (SELECT tenant_id, o_orderkey, status, price + 1 AS price, batch_id, 'I' AS _op FROM f_bronze
                       WHERE tenant_id = 1 AND batch_id BETWEEN 19980101000000 AND 19981201000000 AND status <> 'P')
       SELECT tenant_id, o_orderkey, status, price, batch_id, _op FROM f_bronze
       WHERE NOT (tenant_id = 1 AND batch_id BETWEEN 19980101000000 AND 19981201000000)
       UNION ALL SELECT * FROM landed""",
)
def _(i: Inputs) -> DataFrame:
    """A year's batches of one tenant are loaded again; rows the replay no longer brings stay away."""
    first, last = 19980101000000, 19981201000000
    again = i.f_bronze.filter("tenant_id = 1 AND status <> 'P'").filter(F.col("batch_id").between(first, last))
    again = again.withColumns({"price": F.col("price") + 1, "_op": F.lit("I")})
    return merge.replay_batch(i.f_bronze, again, KEYS, 1, first, last)


_HOLEY = """
    SELECT tenant_id, o_orderkey, CASE WHEN price < 250000 THEN price END AS price,
           CASE WHEN status <> 'F' THEN status END AS status, batch_id, _op FROM f_bronze"""
_FILL_BATCH = 19980301000000


def holey(i: Inputs) -> DataFrame:
    return i.sql("SELECT * FROM d_holey", {"d_holey": _HOLEY})


@query(
    "q_hole_candidates",
    f"""SELECT DISTINCT tenant_id, o_orderkey FROM d_holey
        WHERE batch_id = {_FILL_BATCH} AND _op <> 'd' AND (price IS NULL OR status IS NULL)""",
    {"d_holey": _HOLEY},
)
def _(i: Inputs) -> DataFrame:
    return hole_candidates(holey(i), KEYS, ["price", "status"], batch_id=_FILL_BATCH)


@query(
    "q_interim_fill",
    f"""WITH holes AS (SELECT tenant_id, o_orderkey FROM d_holey WHERE tenant_id = 2 AND batch_id = {_FILL_BATCH}
                       AND _op <> 'd' AND (price IS NULL OR status IS NULL)),
             found AS (SELECT s.* FROM f_source_ok s JOIN holes h
                       ON s.tenant_id = h.tenant_id AND s.o_orderkey = h.o_orderkey)
        SELECT t.tenant_id, t.o_orderkey, CASE WHEN f.o_orderkey IS NOT NULL THEN f.price ELSE t.price END AS price,
               CASE WHEN f.o_orderkey IS NOT NULL THEN f.status ELSE t.status END AS status, t.batch_id, t._op
        FROM d_holey t LEFT JOIN found f ON t.tenant_id = f.tenant_id AND t.o_orderkey = f.o_orderkey""",
    {"d_holey": _HOLEY},
)
def _(i: Inputs) -> DataFrame:
    root = scratch(i.spark, "source")
    i.f_source_ok.filter("tenant_id = 2").drop("tenant_id").write.parquet(f"{root}/orders.parquet")
    return bronze.interim_fill(
        holey(i), (ParquetSource(i.spark, root), "orders"), ["o_orderkey"], ["price", "status"], tenant_id=2, batch_id=_FILL_BATCH
    ).state


@query(
    "q_merge_cardinality",
    """SELECT tenant_id, o_orderkey, count(*) AS cnt FROM f_change_log
       WHERE EXISTS (SELECT 1 FROM f_change_log GROUP BY tenant_id, o_orderkey HAVING count(*) > 1)
       GROUP BY tenant_id, o_orderkey HAVING count(*) > 1""",
)
def _(i: Inputs) -> DataFrame:
    """A merge of the raw log is refused; these are the keys that it meets more than once."""
    log = i.f_change_log
    try:
        merge.upsert(i.f_target, log, KEYS)
    except DuplicateKeys as refused:
        clashes = duplicate_keys(log, KEYS)
        named = i.spark.createDataFrame([(k["tenant_id"], k["o_orderkey"]) for k in refused.keys], "tenant_id int, o_orderkey bigint")
        assert named.join(clashes, KEYS, "left_anti").isEmpty()
        return clashes
    return duplicate_keys(log, KEYS).filter("false")


@query(
    "q_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM {lineitem}
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(i: Inputs) -> DataFrame:
    return duplicate_keys(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q_drop_dup_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (
           SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rn FROM {lineitem}) x
       WHERE rn = 1""",
)
def _(i: Inputs) -> DataFrame:
    rows = i.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return drop_duplicate_keys(rows, ["l_orderkey", "l_linenumber"])


@query(
    "q_union_by_name",
    """SELECT tenant_id, o_orderkey, price FROM f_source_ok
       UNION ALL SELECT tenant_id, o_orderkey, price FROM f_target""",
)
def _(i: Inputs) -> DataFrame:
    a = i.f_source_ok.select("price", "tenant_id", "o_orderkey")
    return a.unionByName(i.f_target.select("tenant_id", "o_orderkey", "price"))


@query(
    "q_create_like",
    """SELECT CAST(0 AS BIGINT) AS rows_before, count(*) AS rows_after FROM f_source_ok""",
)
def _(i: Inputs) -> DataFrame:
    """First load into a missing target: an empty table of the source's shape, then an upsert."""
    made = model.create_like(i.f_source_ok)
    before = made.agg(F.count(F.lit(1)).alias("rows_before"))
    after = merge.upsert(made, i.f_source_ok, KEYS).agg(F.count(F.lit(1)).alias("rows_after"))
    return before.join(F.broadcast(after))


@query(
    "q_soft_delete",
    """SELECT tenant_id, o_orderkey, status, price, batch_id, _op, nullif(_op, 'c') = 'd' AS "DeletedStatus"
       FROM f_bronze WHERE nullif(_op, 'c') = 'u'""",
)
def _(i: Inputs) -> DataFrame:
    from rivulet.plans.silver import live

    return live(i.f_bronze.withColumn("DeletedStatus", F.nullif("_op", F.lit("c")) == "d"))
