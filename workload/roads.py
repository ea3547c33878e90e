"""The roads beside the stream over a small registry: each run dry, then in earnest, on bucketed tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import model
from rivulet.plans.roads import Roads
from rivulet.session import scratch
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.sources.source_db import ParquetSource
from workload.catalog import query
from workload.changes import _FILL_BATCH, AS_OF, as_of, holey
from workload.inputs import Inputs
from workload.reconcile import BATCH

TENANT, RELOADED = 2, 20240201000000
ORDERS = model.shape("tenant_id int, o_orderkey bigint, status string, price double, batch_id bigint, _op string")
MARKS = model.shape("tenant_id int, status string, price double, batch_id bigint, _op string")
# orders can be taken; marks have no key, gone is not at the source, lost has no target, app.orders is the stream's
REGISTRY = [
    ("shop", "orders", "orders", "O_ORDERKEY", True), ("shop", "marks", "marks", "", True), ("shop", "gone", "gone", "o_orderkey", True),
    ("shop", "lost", "nowhere", "id", True), ("app", "orders", "orders", "o_orderkey", True), ("shop", "old", "orders", "x", False),
]
LACKING = ("shop", "lacking", "orders", "o_custkey, o_orderkey", True)


def roads(i: Inputs, orders: DataFrame, batch_id: int, run_id: str) -> tuple[Roads, DataFrame]:
    base = scratch(i.spark, "roads")
    source = i.f_source_ok.filter(F.col("tenant_id") == TENANT).drop("tenant_id").withColumnRenamed("o_orderkey", "O_OrderKey")
    source.write.parquet(f"{base}/source/orders.parquet")
    source.drop("O_OrderKey").write.parquet(f"{base}/source/marks.parquet")
    tables = BucketStore(i.spark, f"{base}/bronze", {"orders": ORDERS, "marks": MARKS, "gone": ORDERS}, {"orders": ["o_orderkey"], "gone": ["o_orderkey"]}, 8)
    tables.load("orders", orders)
    tables.load("marks", orders)
    made = Roads(
        ParquetSource(i.spark, f"{base}/source"), tables, ControlStore(i.spark, f"{base}/control"), tenant_id=TENANT,
        batch_id=batch_id, run_id=run_id, as_of=as_of(),
    )
    return made, i.spark.createDataFrame(REGISTRY, model.REGISTRY)


_RUNS: dict[tuple, Roads] = {}


def ran(i: Inputs, road: str) -> Roads:
    """One road's two runs; made once per session and scale."""
    at = (i.spark.sparkContext.applicationId, i.dir, road)
    if at not in _RUNS:
        orders, batch = (holey(i), _FILL_BATCH) if road == "fill" else (i.f_bronze, BATCH if road == "sweep" else RELOADED)
        made, registry = roads(i, orders, batch, "wet")
        for run in (replace(made, dry_run=True, run_id="dry"), made):
            if road == "reload":
                run.reload(registry.unionByName(i.spark.createDataFrame([LACKING], model.REGISTRY)), streamed=[("APP", "orders")])
            elif road == "replace":
                run.replace(registry.filter("source_schema = 'shop'"))
            elif road == "fill":
                run.fill(registry.filter("source_schema = 'shop'"), {("shop", "orders"): ["Price", "status"], ("shop", "gone"): ["price"]})
            else:
                run.sweep(registry.filter("source_schema = 'shop'"), max_pct=20.0, buckets=64)
        _RUNS[at] = made
    return _RUNS[at]


_SHOP = "(SELECT * FROM f_source_ok WHERE tenant_id = 2)"


@query(
    "q_reload_run",
    f"""SELECT run AS execution_id, schema_name, source_table, status, inserted_rows, reason FROM (
            SELECT 'dry' AS run, 'shop' AS schema_name, 'orders' AS source_table, 'SKIPPED' AS status, CAST(0 AS BIGINT) AS inserted_rows, 'dry run' AS reason
            UNION ALL SELECT 'wet', 'shop', 'orders', 'SUCCESS', (SELECT count(*) FROM {_SHOP} s), NULL
            UNION ALL SELECT run, s, t, st, 0, why FROM (VALUES ('dry'), ('wet')) r(run),
                (VALUES ('shop', 'marks', 'SKIPPED', 'it has no key'), ('shop', 'gone', 'FAILED', 'PATH_NOT_FOUND'),
                        ('shop', 'lacking', 'SKIPPED', 'the target lacks its key columns: [''o_custkey'']'),
                        ('shop', 'lost', 'SKIPPED', 'target nowhere is not declared'), ('app', 'orders', 'SKIPPED', 'the stream owns it')) o(s, t, st, why)) x""",
)
def _(i: Inputs) -> DataFrame:
    detail = ran(i, "reload").kept.read("detail")
    reason = F.when(F.col("error_message").contains("PATH_NOT_FOUND"), "PATH_NOT_FOUND").otherwise(F.col("error_message"))
    return detail.select("execution_id", "schema_name", "source_table", "status", "inserted_rows", reason.alias("reason"))


@query(
    "q_reload_state",
    f"""SELECT coalesce(s.tenant_id, b.tenant_id) AS tenant_id, coalesce(s.o_orderkey, b.o_orderkey) AS o_orderkey,
               coalesce(s.status, b.status) AS status, coalesce(s.price, b.price) AS price,
               CASE WHEN s.tenant_id IS NULL THEN b.batch_id ELSE {RELOADED} END AS batch_id,
               CASE WHEN s.tenant_id IS NULL THEN b._op ELSE 'r' END AS _op
        FROM f_bronze b FULL JOIN {_SHOP} s ON s.tenant_id = b.tenant_id AND s.o_orderkey = b.o_orderkey""",
)
def _(i: Inputs) -> DataFrame:
    return ran(i, "reload").tables.read("orders")


@query(
    "q_reload_header",
    f"""SELECT run AS execution_id, CAST(6 AS INT) AS total_tables, CAST(CASE run WHEN 'wet' THEN 1 ELSE 0 END AS INT) AS successful_tables,
               CAST(1 AS INT) AS failed_tables, 'FAILED' AS status,
               CASE run WHEN 'wet' THEN (SELECT count(*) FROM {_SHOP} s) ELSE 0 END AS total_inserted_rows
        FROM (VALUES ('dry'), ('wet')) r(run)""",
)
def _(i: Inputs) -> DataFrame:
    return ran(i, "reload").kept.read("header").select(
        "execution_id", "total_tables", "successful_tables", "failed_tables", "status", "total_inserted_rows"
    )


_MINE = f"(SELECT count(*) FROM f_bronze WHERE tenant_id = {TENANT})"
_ALL = f"(SELECT count(*) FROM {_SHOP} s)"


@query(
    "q_replacement_run",
    f"""SELECT run AS run_id, t AS source_table, m AS method, src AS src_rows, had AS bronze_before,
               CASE WHEN st = 'OK' AND run = 'dry' THEN 'DRY' ELSE st END AS status, why AS reason
        FROM (VALUES ('dry'), ('wet')) r(run), (
            SELECT 'orders' AS t, 'merge_sync' AS m, {_ALL} AS src, {_MINE} AS had, 'OK' AS st, NULL AS why
            UNION ALL SELECT 'marks', 'overwrite_tenant', {_ALL}, {_MINE}, 'OK', NULL
            UNION ALL SELECT 'gone', NULL, 0, 0, 'ERROR', 'PATH_NOT_FOUND'
            UNION ALL SELECT 'lost', NULL, 0, 0, 'SKIPPED', 'target nowhere is not declared') o""",
)
def _(i: Inputs) -> DataFrame:
    report = ran(i, "replace").kept.read("full_load_report")
    reason = F.when(F.col("error").contains("PATH_NOT_FOUND"), "PATH_NOT_FOUND").otherwise(F.col("error"))
    return report.select("run_id", "source_table", "method", "src_rows", "bronze_before", "status", reason.alias("reason"))


@query(
    "q_replacement_state",
    f"""SELECT 'orders' AS name, tenant_id, o_orderkey, status, price, batch_id, _op FROM f_bronze WHERE tenant_id <> {TENANT}
        UNION ALL
        SELECT 'orders', s.tenant_id, s.o_orderkey, s.status, s.price, {RELOADED}, b._op
        FROM {_SHOP} s LEFT JOIN f_bronze b ON b.tenant_id = s.tenant_id AND b.o_orderkey = s.o_orderkey
        UNION ALL SELECT 'marks', tenant_id, NULL, status, price, batch_id, _op FROM f_bronze WHERE tenant_id <> {TENANT}
        UNION ALL SELECT 'marks', s.tenant_id, NULL, s.status, s.price, {RELOADED}, NULL FROM {_SHOP} s""",
)
def _(i: Inputs) -> DataFrame:
    tables = ran(i, "replace").tables
    orders = tables.read("orders").select(F.lit("orders").alias("name"), "*")
    return orders.unionByName(tables.read("marks").select(F.lit("marks").alias("name"), "*"), allowMissingColumns=True)


_HOLES = f"""SELECT DISTINCT tenant_id, o_orderkey FROM d_holey
    WHERE tenant_id = {TENANT} AND batch_id = {_FILL_BATCH} AND _op <> 'd' AND (price IS NULL OR status IS NULL)"""
_FOUND = f"SELECT s.* FROM f_source_ok s JOIN d_holes h ON s.tenant_id = h.tenant_id AND s.o_orderkey = h.o_orderkey"


def _fill_extra() -> dict[str, str]:
    from workload.changes import _HOLEY

    return {"d_holey": _HOLEY, "d_holes": _HOLES, "d_found": _FOUND}


@query(
    "q_fill_run",
    """SELECT run AS run_id, t AS source_table, n AS candidate_rows, CASE run WHEN 'wet' THEN f ELSE 0 END AS filled_rows,
              c AS cols_filled, st AS status, why AS reason
       FROM (VALUES ('dry'), ('wet')) r(run), (
           SELECT 'orders' AS t, (SELECT count(*) FROM d_holes) AS n, (SELECT count(*) FROM d_found) AS f, 'price,status' AS c, 'OK' AS st, NULL AS why
           UNION ALL SELECT 'marks', 0, 0, '', 'SKIPPED', 'its capture lacks no column'
           UNION ALL SELECT 'lost', 0, 0, '', 'SKIPPED', 'its capture lacks no column'
           UNION ALL SELECT 'gone', 0, 0, 'price', 'ERROR', 'PATH_NOT_FOUND') o""",
    _fill_extra(),
)
def _(i: Inputs) -> DataFrame:
    report = ran(i, "fill").kept.read("fill_report")
    reason = F.when(F.col("error").contains("PATH_NOT_FOUND"), "PATH_NOT_FOUND").otherwise(F.col("error"))
    return report.select("run_id", "source_table", "candidate_rows", "filled_rows", "cols_filled", "status", reason.alias("reason"))


@query(
    "q_fill_state",
    """SELECT h.tenant_id, h.o_orderkey, coalesce(f.status, h.status) AS status, coalesce(f.price, h.price) AS price, h.batch_id, h._op
       FROM d_holey h LEFT JOIN d_found f ON f.tenant_id = h.tenant_id AND f.o_orderkey = h.o_orderkey""",
    _fill_extra(),
)
def _(i: Inputs) -> DataFrame:
    return ran(i, "fill").tables.read("orders")


_GHOSTS = f"""SELECT b.* FROM f_bronze b WHERE b.tenant_id = {TENANT} AND b.batch_id < {BATCH}
    AND NOT EXISTS (SELECT 1 FROM f_source_ok s WHERE s.tenant_id = b.tenant_id AND s.o_orderkey = b.o_orderkey)
    AND b.o_orderkey <= (SELECT max(o_orderkey) FROM f_source_ok WHERE tenant_id = {TENANT})"""


@query(
    "q_sweep_run",
    f"""SELECT run = 'dry' AS dry_run, t AS source_table, g AS ghost_rows, b AS bronze_rows,
               CASE WHEN st = 'DELETED' AND run = 'dry' THEN 'DRY' ELSE st END AS status, why AS reason
        FROM (VALUES ('dry'), ('wet')) r(run), (
            SELECT 'orders' AS t, (SELECT count(*) FROM d_ghosts) AS g, {_MINE} AS b, 'DELETED' AS st, NULL AS why
            UNION ALL SELECT 'marks', 0, 0, 'SKIPPED', 'it has no key'
            UNION ALL SELECT 'lost', 0, 0, 'SKIPPED', 'target nowhere is not declared'
            UNION ALL SELECT 'gone', 0, 0, 'FAILED', 'PATH_NOT_FOUND') o""",
    {"d_ghosts": _GHOSTS},
)
def _(i: Inputs) -> DataFrame:
    report = ran(i, "sweep").kept.read("ghost_report")
    reason = F.when(F.col("error").contains("PATH_NOT_FOUND"), "PATH_NOT_FOUND").otherwise(F.col("error"))
    return report.select("dry_run", "source_table", "ghost_rows", "bronze_rows", "status", reason.alias("reason"))


@query("q_sweep_state", "SELECT b.* FROM f_bronze b WHERE NOT EXISTS (SELECT 1 FROM d_ghosts g WHERE g.o_orderkey = b.o_orderkey)", {"d_ghosts": _GHOSTS})
def _(i: Inputs) -> DataFrame:
    return ran(i, "sweep").tables.read("orders").select(*i.f_bronze.columns)


@query(
    "q_sweep_log",
    f"""SELECT tenant_id, CAST({BATCH} AS VARCHAR) AS batch_id, TIMESTAMP '{AS_OF}' AS deleted_ts,
               '{{{{"o_orderkey":' || CAST(o_orderkey AS STRING) || '}}}}' AS pk_json FROM d_ghosts""".replace("{{", "{").replace("}}", "}"),
    {"d_ghosts": _GHOSTS},
)
def _(i: Inputs) -> DataFrame:
    return ran(i, "sweep").kept.read("doomed").select("tenant_id", "batch_id", "deleted_ts", "pk_json")
