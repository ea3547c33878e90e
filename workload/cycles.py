"""Two compaction runs over a stage with a ledger, into bucketed tables, each done twice under its id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import checks
from rivulet.session import scratch, settle
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.sources.sinks import balanced
from rivulet.streaming.cycle import run_cycle
from rivulet.streaming.ledger import Stage
from workload.catalog import query
from workload.changes import RUN
from workload.inputs import Inputs
from workload.payloads import EVENT_TARGET, event_stage
from workload.staging import GRACE, NOW, now

# micro-batches end at these days of the month; the last one has not settled when the runs begin
DAYS = [10, 20, 25, 31]
LATER = "run-2"
TABLES = ["app_signup", "app_error", "app_purchase"]


@dataclass
class Drained:
    stage: Stage
    tables: BucketStore
    kept: ControlStore


_DRAINED: dict[tuple[str, str], Drained] = {}


def staged(i: Inputs, path: str) -> Stage:
    """Events as two streams, one per tenant, four micro-batches each.

    The events are read and dealt to their micro-batches once, over as many tasks as their size asks for, however few
    parts their file can be read in; a micro-batch then reads its own folders.
    """
    stage = Stage(i.spark, path)
    rows = event_stage(i).withColumns(
        {"source_partition": F.lit("0"), "source_offset": F.col("stage_seq"), "eh_enqueued_ts": F.col("ingest_ts"), "run_id": F.lit("ingest")}
    ).drop("stage_seq")
    number_of = F.lit(None).cast("int")
    for number, last in reversed(list(enumerate(DAYS))):
        number_of = F.when(F.dayofmonth("ingest_ts") <= last, number).otherwise(number_of)
    dealt = settle(balanced(rows.withColumn("_batch", number_of), "_batch", "tenant_id"), "events", ["_batch", "tenant_id"])
    for number in range(len(DAYS)):
        during = dealt.filter(F.col("_batch") == number).drop("_batch")
        at = during.agg(F.max("ingest_ts")).first()[0]
        for tenant in (1, 2):
            stage.put(
                during.filter(F.col("tenant_id") == tenant), tenant_id=tenant, stream_id=f"tenant-{tenant}",
                micro_batch_id=number, ingest_ts=at,
            )
    return stage


def drained(i: Inputs) -> Drained:
    """What the two runs leave behind; made once per session and scale."""
    at = (i.spark.sparkContext.applicationId, i.dir)
    if at not in _DRAINED:
        base = scratch(i.spark, "cycles")
        tables = BucketStore(i.spark, f"{base}/bronze", dict.fromkeys(TABLES, EVENT_TARGET), dict.fromkeys(TABLES, ["user_id"]), 8)
        users = i.f_users.withColumn("happened", F.col("happened").cast("timestamp"))
        for name in ("app_signup", "app_error"):
            tables.load(name, users)
        done = Drained(staged(i, f"{base}/stage"), tables, ControlStore(i.spark, f"{base}/control"))
        without = i.f_registry.filter("source_table <> 'purchase'")
        for tenant, run_id, registry in ((1, RUN, i.f_registry), (2, LATER, without)) * 2:
            run_cycle(
                done.stage, registry, done.tables, done.kept, tenant_id=tenant, run_id=run_id, as_of=now(), grace_minutes=GRACE,
            )
        _DRAINED[at] = done
    return _DRAINED[at]


_SETTLED = f"""
    SELECT *, lower(trim(source_schema)) AS schema_name, lower(source_table) AS name,
           CASE WHEN lower(trim(source_schema)) <> 'app' THEN 'SKIPPED'
                WHEN lower(source_table) IN ('signup', 'error') THEN 'SUCCESS'
                WHEN lower(source_table) = 'purchase' AND tenant_id = 1 THEN 'FAILED' ELSE 'SKIPPED' END AS outcome
    FROM f_stage WHERE ingest_ts <= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"""
_LATEST = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, name, user_id ORDER BY commit_lsn DESC, stage_seq DESC) AS rn
                   FROM d_settled WHERE outcome = 'SUCCESS') x WHERE rn = 1"""
_TOPS = """
    SELECT tenant_id, schema_name, name, outcome, max(batch_id) AS top FROM d_settled
    GROUP BY tenant_id, schema_name, name, outcome"""
_RESULTS = f"""
    SELECT CASE t.tenant_id WHEN 1 THEN '{RUN}' ELSE '{LATER}' END AS execution_id, t.tenant_id, t.schema_name,
           t.name AS source_table, CASE WHEN t.outcome <> 'SKIPPED' THEN t.top END AS batch_id, t.outcome AS status,
           coalesce(n.written, 0) AS inserted_rows,
           CASE t.outcome WHEN 'SKIPPED' THEN 'not in the registry' WHEN 'FAILED' THEN 'key columns not captured: [''user_id'']' END AS error_message
    FROM d_tops t LEFT JOIN (SELECT tenant_id, name, count(*) AS written FROM d_latest WHERE op <> 'd' GROUP BY tenant_id, name) n
         ON n.tenant_id = t.tenant_id AND n.name = t.name AND t.outcome = 'SUCCESS'"""
EXTRA = {"d_settled": _SETTLED, "d_latest": _LATEST, "d_tops": _TOPS, "d_results": _RESULTS}


@query(
    "q_store_cycle",
    f"""SELECT 'app_signup' AS bronze, u.tenant_id, u.event_id, u.user_id, u.value, u.happened, u.day, u._ingest_date, u._op, u.batch_id
        FROM f_users u LEFT JOIN d_latest f ON f.name = 'signup' AND f.tenant_id = u.tenant_id AND f.user_id = u.user_id
        WHERE f.user_id IS NULL
        UNION ALL
        SELECT 'app_signup', f.tenant_id, f.event_id, f.user_id, f.value, f.source_commit_ts, CAST(f.source_commit_ts AS DATE),
               CAST(TIMESTAMP '{NOW}' AS DATE), f.op, t.top
        FROM d_latest f JOIN d_tops t ON t.tenant_id = f.tenant_id AND t.name = f.name AND t.outcome = 'SUCCESS' WHERE f.name = 'signup'
        UNION ALL
        SELECT 'app_error', u.tenant_id, u.event_id, u.user_id, u.value, u.happened, u.day, u._ingest_date, u._op, u.batch_id
        FROM f_users u LEFT JOIN d_latest f ON f.name = 'error' AND f.tenant_id = u.tenant_id AND f.user_id = u.user_id
        WHERE f.user_id IS NULL""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    """Tables in key buckets after the runs: only touched folders were rewritten."""
    tables = drained(i).tables
    parts = [tables.read(n).select(F.lit(n).alias("bronze"), "*") for n in ("app_signup", "app_error")]
    return parts[0].unionByName(parts[1])


_LEFT = """SELECT tenant_id, source_schema, source_table, stage_seq FROM f_stage
    WHERE stage_seq NOT IN (SELECT stage_seq FROM d_settled WHERE outcome <> 'SKIPPED')"""


@query("q_stage_ack", _LEFT, EXTRA)
def _(i: Inputs) -> DataFrame:
    """Rows that no acknowledged range covers; folders without any are not opened."""
    left = drained(i).stage.unacknowledged()
    return left.select("tenant_id", "source_schema", "source_table", F.col("source_offset").alias("stage_seq"))


@query(
    "q_stage_depth",
    f"""SELECT source_schema, count(DISTINCT source_table) AS tables, count(*) AS rows FROM d_left GROUP BY source_schema""",
    {**EXTRA, "d_left": _LEFT},
)
def _(i: Inputs) -> DataFrame:
    """From the ledger: no staged row is read."""
    return drained(i).stage.depth()


@query("q_cycle_detail", "SELECT * FROM d_results", EXTRA)
def _(i: Inputs) -> DataFrame:
    return drained(i).kept.read("detail").drop("start_ts", "end_ts", "duration_secs", "created_ts")


@query(
    "q_cycle_header",
    """SELECT execution_id, CAST(count(*) AS INT) AS total_tables, CAST(1 AS INT) AS total_tenants,
              CAST(count(*) FILTER (status = 'SUCCESS') AS INT) AS successful_tables,
              CAST(count(*) FILTER (status = 'FAILED') AS INT) AS failed_tables,
              CAST(count(*) FILTER (status = 'SKIPPED') AS INT) AS skipped_tables,
              CAST(sum(inserted_rows) AS BIGINT) AS total_inserted_rows,
              CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
       FROM d_results GROUP BY execution_id""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    counts = ["total_tables", "total_tenants", "successful_tables", "failed_tables", "skipped_tables"]
    return drained(i).kept.read("header").select("execution_id", *counts, "total_inserted_rows", "status")


@query(
    "q_cycle_dead_letters",
    f"""SELECT '{RUN}' AS run_id, batch_id, source_schema, 'purchase' AS source_table, source_db, op, commit_lsn,
               'key columns not captured: [''user_id'']' AS error FROM d_settled WHERE outcome = 'FAILED'""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    return drained(i).kept.read("dead_letter").drop("dead_lettered_at", "raw_value")


@query(
    "q_cycle_lag",
    f"""SELECT source_schema, source_table, count(*) AS rows_processed, max(source_commit_ts) AS newest_source_commit,
               min(source_commit_ts) AS oldest_source_commit,
               max(CAST(floor(epoch(TIMESTAMP '{NOW}')) - floor(epoch(source_commit_ts)) AS BIGINT)) AS max_lag_s
        FROM d_settled WHERE outcome <> 'SKIPPED' AND source_commit_ts IS NOT NULL GROUP BY tenant_id, source_schema, source_table""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    return drained(i).kept.read("lag").drop("median_lag_s", "lag_sketch")


@query(
    "q_cycle_marks",
    f"""SELECT tenant_id, schema_name, name AS source_table, top AS last_batch_id, TIMESTAMP '{NOW}' AS updated_on
        FROM d_tops WHERE outcome = 'SUCCESS'""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    return drained(i).kept.marks()


@query(
    "q_cycle_cursors",
    f"""SELECT tenant_id, schema_name AS source_schema, name AS source_table, top AS last_batch_id, TIMESTAMP '{NOW}' AS updated_on
        FROM d_tops WHERE outcome = 'SUCCESS'""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    return drained(i).kept.cursors().drop("last_stage_seq")


@query(
    "q_cycle_gate",
    f"""SELECT max(top) AS batch_id, TIMESTAMP '{NOW}' AS completed_ts, '{LATER}' AS execution_id FROM d_tops WHERE tenant_id = 2""",
    EXTRA,
)
def _(i: Inputs) -> DataFrame:
    """The run with a failed table opens nothing, the clean one its batch."""
    return drained(i).kept.gate()


@query(
    "q_unregistered_kept",
    """SELECT 'unregistered_kept' AS "check", CAST(0 AS BIGINT) AS measured, 'PASS' AS status""",
)
def _(i: Inputs) -> DataFrame:
    """The runs took no row of a table that nobody registered."""
    done = drained(i)
    return checks.unregistered_kept(done.stage.rows(), done.stage.unacknowledged(), i.f_registry, 1)
