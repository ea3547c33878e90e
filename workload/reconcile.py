"""Ghost detection and removal: the bronze orders against a source snapshot that lost rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import ghosts
from rivulet.plans.bronze import ghost_sweep
from rivulet.session import scratch
from rivulet.sources.sinks import overwrite_report
from workload.catalog import query
from workload.changes import AS_OF, KEYS, as_of
from workload.inputs import Inputs

BATCH = 20000601000000
_GHOST = f"""b.batch_id < {BATCH} AND NOT EXISTS (
        SELECT 1 FROM f_source_ok s WHERE s.tenant_id = b.tenant_id AND s.o_orderkey = b.o_orderkey)"""


@query("q_ghost_detect", f"SELECT b.* FROM f_bronze b WHERE {_GHOST}")
def _(i: Inputs) -> DataFrame:
    return ghosts.detect(i.f_bronze, i.f_source_ok, KEYS, BATCH)


@query("q_ghost_buckets", f"SELECT b.* FROM f_bronze b WHERE {_GHOST}")
def _(i: Inputs) -> DataFrame:
    """The same ghosts, looked for only in key buckets whose checksums differ."""
    return ghosts.detect_by_sums(i.f_bronze, i.f_source_ok, KEYS, BATCH)


_EVENTS = "SELECT event_id, CAST(year(ts) * 10000000000 + month(ts) * 100000000 + day(ts) * 1000000 AS BIGINT) AS batch_id, value FROM {events}"


@query(
    "q_ghost_race_guard",
    """SELECT event_id, batch_id, value FROM d_events
       WHERE batch_id < 20240125000000 AND NOT (value >= 5 AND batch_id < 20240120000000)
         AND event_id <= (SELECT max(event_id) FROM d_events WHERE value >= 5 AND batch_id < 20240120000000)""",
    {"d_events": _EVENTS},
)
def _(i: Inputs) -> DataFrame:
    """The snapshot ends before the run: rows above its highest id came later and are spared."""
    target = i.sql("SELECT * FROM d_events", {"d_events": _EVENTS})
    source = target.filter("value >= 5 AND batch_id < 20240120000000").select("event_id")
    return ghosts.race_guard(ghosts.detect(target, source, ["event_id"], 20240125000000), source, ["event_id"])


_FUSE = """
    SELECT '{0}' AS snapshot, tenant_id, count(*) AS bronze_rows, sum(gone) AS ghost_rows,
           CAST(100 AS DOUBLE) * sum(gone) / count(*) AS ghost_pct,
           CASE WHEN sum(gone) = 0 THEN 'OK' WHEN CAST(100 AS DOUBLE) * sum(gone) / count(*) > 10 THEN 'ABORTED_PCT_FUSE'
                ELSE 'DELETED' END AS status
    FROM (SELECT b.tenant_id, CAST(CASE WHEN s.o_orderkey IS NULL AND b.batch_id < {1}{2} THEN 1 ELSE 0 END AS BIGINT) AS gone
          FROM f_bronze b LEFT JOIN f_source_{0} s ON s.tenant_id = b.tenant_id AND s.o_orderkey = b.o_orderkey) x
    GROUP BY tenant_id"""
_COUNTS = f"""SELECT snapshot, tenant_id, bronze_rows, CAST(ghost_rows AS BIGINT) AS ghost_rows, ghost_pct, status
    FROM ({_FUSE.format("ok", BATCH, "")} UNION ALL {_FUSE.format("bad", BATCH, "")}) y"""
# a sweep of one table has a single numeric key, so rows above the source's highest key are spared
_SPARED = " AND b.o_orderkey <= (SELECT max(o_orderkey) FROM f_source_{0} WHERE tenant_id = {1})"


@query("q_ghost_fuse", _COUNTS)
def _(i: Inputs) -> DataFrame:
    def decided(name: str, source: DataFrame) -> DataFrame:
        counts = ghosts.sweep_counts(i.f_bronze, source, KEYS, BATCH)
        return ghosts.fuse(counts, 10.0).withColumn("snapshot", F.lit(name))

    return decided("ok", i.f_source_ok).unionByName(decided("bad", i.f_source_bad))


def _sweep(i: Inputs, tenant_id: int, source: DataFrame, dry_run: bool = False):
    return ghost_sweep(
        i.f_bronze, source.filter(F.col("tenant_id") == tenant_id), ["o_orderkey"], tenant_id=tenant_id, batch_id=BATCH,
        schema_name="shop", source_table="orders", bronze_table="shop_orders", as_of=as_of(), dry_run=dry_run,
    )


_TOP = "b.o_orderkey <= (SELECT max(o_orderkey) FROM f_source_ok WHERE tenant_id = b.tenant_id)"


@query("q_ghost_delete", f"SELECT b.* FROM f_bronze b WHERE NOT (b.tenant_id = 2 AND {_GHOST} AND {_TOP})")
def _(i: Inputs) -> DataFrame:
    return _sweep(i, 2, i.f_source_ok)[0]


@query(
    "q_doomed_pks",
    f"""SELECT 'shop' AS schema_name, 'orders' AS source_table, b.tenant_id, '{BATCH}' AS batch_id,
               TIMESTAMP '{AS_OF}' AS deleted_ts, '{{{{"o_orderkey":' || CAST(b.o_orderkey AS STRING) || '}}}}' AS pk_json
        FROM f_bronze b WHERE b.tenant_id = 2 AND {_GHOST} AND {_TOP}""".replace("{{", "{").replace("}}", "}"),
)
def _(i: Inputs) -> DataFrame:
    return _sweep(i, 2, i.f_source_ok)[1]


@query(
    "q_ghost_report",
    f"""SELECT 'shop' AS schema_name, 'orders' AS source_table, 'shop_orders' AS bronze_table,
               CAST(ghost_rows AS BIGINT) AS ghost_rows, bronze_rows,
               CASE status WHEN 'DELETED' THEN 'DRY' ELSE status END AS status,
               CASE WHEN status = 'ABORTED_PCT_FUSE' THEN 'nothing deleted: ' || CAST(round(ghost_pct, 2) AS STRING)
                    || ' percent missing at the source, limit 10' END AS error,
               tenant_id, CAST({BATCH} AS BIGINT) AS batch_id, TRUE AS dry_run, TIMESTAMP '{AS_OF}' AS run_ts
        FROM (SELECT * FROM ({_FUSE.format("ok", BATCH, _SPARED.format("ok", 1))}) a WHERE tenant_id = 1
              UNION ALL SELECT * FROM ({_FUSE.format("bad", BATCH, _SPARED.format("bad", 4))}) b WHERE tenant_id = 4) c""",
)
def _(i: Inputs) -> DataFrame:
    """Dry runs: one tenant would be cleaned, the other trips the fuse. Nothing is deleted."""
    return _sweep(i, 1, i.f_source_ok, True)[2].unionByName(_sweep(i, 4, i.f_source_bad, True)[2])


@query("q_report_overwrite", f"SELECT tenant_id, ghost_rows, status FROM ({_COUNTS}) y WHERE snapshot = 'bad'")
def _(i: Inputs) -> DataFrame:
    """A report replaced by one with other columns: nothing of the first is left."""
    path = scratch(i.spark, "report")
    overwrite_report(ghosts.sweep_counts(i.f_bronze, i.f_source_ok, KEYS, BATCH), path)
    counts = ghosts.fuse(ghosts.sweep_counts(i.f_bronze, i.f_source_bad, KEYS, BATCH), 10.0)
    overwrite_report(counts.select("tenant_id", "ghost_rows", "status"), path)
    return i.spark.read.parquet(path)
