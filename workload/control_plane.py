"""Audit, watermarks, promotion gate, and the post-run checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import checks, control, merge
from rivulet.operators.registry import touched_tables
from workload.catalog import query
from workload.changes import AS_OF, RUN, as_of
from workload.inputs import Inputs
from workload.staging import stage


def _times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def detail(i: Inputs) -> DataFrame:
    return _times(i.f_detail, "start_ts", "end_ts")


_UPDATES = f"""SELECT tenant_id, schema_name, source_table, max(batch_id) AS last_batch_id
    FROM f_detail WHERE status = 'SUCCESS' AND execution_id = 'run-P' GROUP BY tenant_id, schema_name, source_table"""


@query(
    "q_watermark_upsert",
    f"""SELECT coalesce(u.tenant_id, m.tenant_id) AS tenant_id, coalesce(u.schema_name, m.schema_name) AS schema_name,
               coalesce(u.source_table, m.source_table) AS source_table,
               greatest(u.last_batch_id, m.last_batch_id) AS last_batch_id,
               CASE WHEN u.tenant_id IS NULL THEN m.updated_on ELSE TIMESTAMP '{AS_OF}' END AS updated_on
        FROM f_marks m FULL JOIN d_updates u ON m.tenant_id = u.tenant_id AND m.schema_name = u.schema_name
             AND m.source_table = u.source_table""",
    {"d_updates": _UPDATES},
)
def _(i: Inputs) -> DataFrame:
    updates = i.sql("SELECT * FROM d_updates", {"d_updates": _UPDATES}).withColumn("updated_on", as_of())
    return merge.watermark_upsert(_times(i.f_marks, "updated_on"), updates)


_CURSORS = """SELECT tenant_id, lower(trim(source_schema)) AS source_schema, lower(source_table) AS source_table,
    max(stage_seq) AS last_stage_seq, max(batch_id) AS last_batch_id
    FROM f_stage WHERE {0} GROUP BY tenant_id, lower(trim(source_schema)), lower(source_table)"""
_CURSOR_PARTS = {
    "d_held": _CURSORS.format("batch_id < 20240110000000 AND value < 100"),
    "d_moved": _CURSORS.format("batch_id < 20240120000000 AND value > 30"),
}


@query(
    "q_cursor_upsert",
    """SELECT coalesce(u.tenant_id, m.tenant_id) AS tenant_id, coalesce(u.source_schema, m.source_schema) AS source_schema,
              coalesce(u.source_table, m.source_table) AS source_table,
              coalesce(u.last_stage_seq, m.last_stage_seq) AS last_stage_seq,
              coalesce(u.last_batch_id, m.last_batch_id) AS last_batch_id
       FROM d_held m FULL JOIN d_moved u ON m.tenant_id = u.tenant_id AND m.source_schema = u.source_schema
            AND m.source_table = u.source_table""",
    _CURSOR_PARTS,
)
def _(i: Inputs) -> DataFrame:
    return merge.cursor_upsert(
        i.sql("SELECT * FROM d_held", _CURSOR_PARTS), i.sql("SELECT * FROM d_moved", _CURSOR_PARTS)
    )


_CLEAN = """SELECT batch_id FROM f_detail WHERE batch_id IS NOT NULL GROUP BY batch_id
    HAVING sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) = 0"""


@query(
    "q_gate_insert",
    f"""SELECT batch_id, completed_ts, execution_id FROM f_gate
        UNION ALL SELECT c.batch_id, TIMESTAMP '{AS_OF}', '{RUN}' FROM d_clean c
        WHERE c.batch_id NOT IN (SELECT batch_id FROM f_gate)""",
    {"d_clean": _CLEAN},
)
def _(i: Inputs) -> DataFrame:
    clean = control.promotable_batches(detail(i), i.f_gate.filter("batch_id IS NULL"))
    return control.open_gate(_times(i.f_gate, "completed_ts"), clean, RUN, as_of())


@query(
    "q_promotable_batches",
    """SELECT 'clean_and_newer' AS rule, batch_id FROM d_clean WHERE batch_id > (SELECT max(batch_id) FROM f_gate)
       UNION ALL SELECT 'run_if_clean', max(batch_id) FROM f_detail WHERE schema_name = 'ops'
       UNION ALL SELECT 'run_if_newer', max(batch_id) FROM f_detail WHERE schema_name = 'ops'""",
    {"d_clean": _CLEAN},
)
def _(i: Inputs) -> DataFrame:
    """Per batch over everything; per run for the runs of one schema, which had no failure."""
    every, ops = detail(i), detail(i).filter("schema_name = 'ops'")
    rows = [
        control.promotable_batches(df, i.f_gate, rule).withColumn("rule", F.lit(rule))
        for rule, df in (("clean_and_newer", every), ("run_if_clean", ops), ("run_if_newer", ops))
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "q_run_detail",
    f"""SELECT execution_id, tenant_id, schema_name, source_table, CASE WHEN status <> 'SKIPPED' THEN batch_id END AS batch_id,
               status, inserted_rows, error_message, start_ts, end_ts, CAST(90 AS BIGINT) AS duration_secs,
               TIMESTAMP '{AS_OF}' AS created_ts
        FROM f_detail""",
)
def _(i: Inputs) -> DataFrame:
    return control.run_detail(detail(i), F.col("execution_id"), as_of())


_STATUS = """
    SELECT execution_id, tenant_id, schema_name, source_table,
           CASE WHEN count(*) FILTER (status = 'FAILED') > 0 AND count(*) FILTER (status = 'SUCCESS') > 0 THEN 'PARTIAL_SUCCESS'
                WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED'
                WHEN count(*) FILTER (status = 'SUCCESS') > 0 THEN 'SUCCESS' ELSE 'SKIPPED' END AS status
    FROM f_detail GROUP BY execution_id, tenant_id, schema_name, source_table"""
_HEADERS = f"""
    SELECT r.execution_id, r.start_ts, r.end_ts, r.secs AS duration_secs,
           CAST(round(r.secs / CAST(60 AS DOUBLE), 2) AS DECIMAL(18,2)) AS duration_mins,
           t.total_tables, r.total_tenants, t.successful_tables, t.failed_tables, t.skipped_tables,
           r.successful_batches, r.failed_batches, r.skipped_batches, t.successful_tables AS watermark_updates,
           r.total_inserted_rows, CASE WHEN t.failed_tables > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           'rivulet-1' AS pipeline_version, TIMESTAMP '{AS_OF}' AS created_ts
    FROM (SELECT execution_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts,
                 CAST(floor(epoch(max(end_ts))) - floor(epoch(min(start_ts))) AS BIGINT) AS secs,
                 CAST(count(DISTINCT tenant_id) AS INT) AS total_tenants,
                 CAST(count(*) FILTER (status = 'SUCCESS') AS INT) AS successful_batches,
                 CAST(count(*) FILTER (status = 'FAILED') AS INT) AS failed_batches,
                 CAST(count(*) FILTER (status = 'SKIPPED') AS INT) AS skipped_batches,
                 CAST(sum(inserted_rows) AS BIGINT) AS total_inserted_rows
          FROM f_detail GROUP BY execution_id) r
    JOIN (SELECT execution_id, CAST(count(*) AS INT) AS total_tables,
                 CAST(count(*) FILTER (status = 'SUCCESS') AS INT) AS successful_tables,
                 CAST(count(*) FILTER (status IN ('FAILED', 'PARTIAL_SUCCESS')) AS INT) AS failed_tables,
                 CAST(count(*) FILTER (status = 'SKIPPED') AS INT) AS skipped_tables
          FROM ({_STATUS}) s GROUP BY execution_id) t ON r.execution_id = t.execution_id"""


def headers(i: Inputs) -> DataFrame:
    return control.run_summary(detail(i), "rivulet-1", as_of())


@query("q_run_summary", _HEADERS)
def _(i: Inputs) -> DataFrame:
    return headers(i)


@query("q_table_status", _STATUS)
def _(i: Inputs) -> DataFrame:
    return control.table_status(detail(i))


@query(
    "q_latest_execution",
    "SELECT execution_id, start_ts, end_ts, status FROM d_headers ORDER BY start_ts DESC, execution_id DESC LIMIT 1",
    {"d_headers": _HEADERS},
)
def _(i: Inputs) -> DataFrame:
    return control.latest_execution(headers(i)).select("execution_id", "start_ts", "end_ts", "status")


@query(
    "q_status_counts",
    "SELECT schema_name, status, error_message, count(*) AS cnt FROM f_detail GROUP BY schema_name, status, error_message",
)
def _(i: Inputs) -> DataFrame:
    return control.status_counts(detail(i))


@query(
    "q_report_totals",
    """SELECT count(*) AS tables, CAST(coalesce(sum(inserted_rows), 0) AS BIGINT) AS rows,
              count(*) FILTER (status = 'FAILED') AS errors, count(*) FILTER (status = 'SKIPPED') AS skipped FROM f_detail""",
)
def _(i: Inputs) -> DataFrame:
    return control.report_totals(detail(i), "inserted_rows", "FAILED")


_SHOPS = """SELECT 'shop' AS source_schema, 'Customer_' || CAST(c_custkey AS STRING) AS source_table,
    'shop_' || lower(c_mktsegment) AS bronze_table, 'id' AS pk_columns, c_acctbal > 0 AS is_active FROM {customer}"""


@query(
    "q_touched_tables",
    """SELECT DISTINCT r.source_schema, r.source_table, r.bronze_table, r.pk_columns FROM f_detail d
       JOIN d_shops r ON r.source_schema = d.schema_name AND r.source_table = d.source_table AND r.is_active
       WHERE d.tenant_id = 2 AND d.batch_id = 19960301000000 AND d.status = 'SUCCESS' AND d.inserted_rows > 0""",
    {"d_shops": _SHOPS},
)
def _(i: Inputs) -> DataFrame:
    registry = i.sql("SELECT * FROM d_shops", {"d_shops": _SHOPS})
    return touched_tables(detail(i), registry, 19960301000000, 2)


_TOP = "(SELECT max(batch_id) FROM f_detail WHERE status = 'SUCCESS')"


@query(
    "q_chk_watermark",
    f"""SELECT 'watermark' AS "check", count(*) AS measured, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM f_marks WHERE last_batch_id = {_TOP}
        UNION ALL SELECT 'gate', count(*), CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END
        FROM f_gate WHERE batch_id = {_TOP}""",
)
def _(i: Inputs) -> DataFrame:
    return checks.watermark_advanced(detail(i), i.f_marks, i.f_gate)


@query(
    "q_chk_scope",
    """SELECT 'scope' AS "check", count(*) AS measured, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM f_detail WHERE status = 'SKIPPED' AND error_message LIKE '%not in run scope%' AND schema_name = 'shop'""",
)
def _(i: Inputs) -> DataFrame:
    return checks.scope_respected(detail(i), ["shop"])


@query(
    "q_chk_audit",
    """SELECT execution_id, CAST(total_tables AS BIGINT) AS header_tables, coalesce(n, 0) AS detail_tables,
              CASE WHEN total_tables = coalesce(n, 0) THEN 'PASS' ELSE 'FAIL' END AS status
       FROM d_headers LEFT JOIN (SELECT execution_id, count(DISTINCT (tenant_id, schema_name, source_table)) AS n
                                 FROM f_detail GROUP BY 1) USING (execution_id)""",
    {"d_headers": _HEADERS},
)
def _(i: Inputs) -> DataFrame:
    return checks.audit_complete(headers(i), detail(i))


@query(
    "q_chk_cursor",
    """SELECT 'cursor' AS "check", (SELECT max(last_batch_id) FROM d_held) AS cursor_batch,
              (SELECT max(last_batch_id) FROM d_moved) AS watermark_batch,
              CASE WHEN (SELECT max(last_batch_id) FROM d_held) IS NOT DISTINCT FROM (SELECT max(last_batch_id) FROM d_moved)
                   THEN 'PASS' ELSE 'FAIL' END AS status""",
    _CURSOR_PARTS,
)
def _(i: Inputs) -> DataFrame:
    return checks.cursor_matches(
        i.sql("SELECT * FROM d_held", _CURSOR_PARTS), i.sql("SELECT * FROM d_moved", _CURSOR_PARTS)
    )


@query(
    "q_chk_depths",
    """SELECT 'stage' AS "check", count(*) AS measured, CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'ROWS' END AS status FROM f_stage
       UNION ALL SELECT 'dead_letter', count(*), CASE WHEN count(*) = 0 THEN 'CLEAR' ELSE 'ROWS' END
       FROM f_detail WHERE status = 'FAILED'""",
)
def _(i: Inputs) -> DataFrame:
    return checks.depths(stage(i), detail(i).filter("status = 'FAILED'"))


@query(
    "q_chk_temporal",
    """SELECT 'temporal' AS "check", count(*) AS measured, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM f_stage WHERE source_commit_ts IS NULL AND op IN ('c', 'u')""",
)
def _(i: Inputs) -> DataFrame:
    target = stage(i).select(F.col("op").alias("_op"), F.col("source_commit_ts").alias("ModifiedOn"))
    return checks.modified_time_present(target)


@query(
    "q_ops_outcome",
    """SELECT _op, count(*) AS cnt, max(day) AS latest_ingest FROM
       (SELECT op AS _op, CAST(ingest_ts AS DATE) AS day FROM f_stage) x GROUP BY _op""",
)
def _(i: Inputs) -> DataFrame:
    rows = stage(i).select(F.col("op").alias("_op"), F.col("ingest_ts").cast("date").alias("_ingest_date"))
    return checks.ops_outcome(rows)


@query(
    "q_resolve_batch",
    """SELECT 'newest' AS how, max(batch_id) AS batch_id FROM f_detail WHERE tenant_id = 2
       UNION ALL SELECT 'given', CAST(19960301000000 AS BIGINT)""",
)
def _(i: Inputs) -> DataFrame:
    """The batch that a road works on: the one it was given, else the tenant's newest."""
    rows = [control.resolve_batch(g, detail(i), 2).select(F.lit(how).alias("how"), "batch_id") for how, g in (("newest", None), ("given", 19960301000000))]
    return rows[0].unionByName(rows[1])
