"""Inputs derived from the test tables by plain SQL that Spark and DuckDB both run.

Scenarios follow from what the rows say (status, dates, prices), over the whole tables:

* tenant            the order's priority class, 1 to 5
* full load         orders placed before 1999
* change events     a create per order placed from 1998, an update per open line item, a delete per order
                    under 50,000, and a new create for those under 10,000; lines not returned have no
                    log position and must lose
* source snapshots  orders from 30,000 (few rows gone) or from 100,000 (too many gone)
* landing batches   line items by year shipped, one tenant per return flag; later batches repeat keys
* staged events     the event stream, one batch per day
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from rivulet.session import tune

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_TENANT = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
_YMD = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS BIGINT)"
_MONTH_BATCH = "CAST(year({0}) * 10000000000 + month({0}) * 100000000 + 1000000 AS BIGINT)"
_DAY_BATCH = "CAST(year({0}) * 10000000000 + month({0}) * 100000000 + day({0}) * 1000000 AS BIGINT)"
_LANDING_TENANT = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END"
_LANDING_TABLE = "CASE l_linestatus WHEN 'O' THEN 'open_lines' ELSE 'filed_lines' END"

FIXTURES: dict[str, str] = {
    "f_change_log": f"""
        SELECT {_TENANT} AS tenant_id, o_orderkey, 'c' AS op,
               CAST({_YMD.format("o_orderdate")} AS STRING) || '00' AS commit_lsn, o_orderkey * 100 AS stage_seq,
               o_orderstatus AS status, o_totalprice AS price, o_orderdate AS modified
        FROM {{orders}} WHERE year(o_orderdate) >= 1998
        UNION ALL
        SELECT {_TENANT}, o_orderkey, 'u',
               CASE WHEN l_returnflag <> 'N'
                    THEN CAST({_YMD.format("l_shipdate")} AS STRING) || lpad(CAST(l_linenumber AS STRING), 2, '0') END,
               o_orderkey * 100 + l_linenumber, l_returnflag || l_linestatus, l_extendedprice, l_shipdate
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_linestatus = 'O'
        UNION ALL
        SELECT {_TENANT}, o_orderkey, 'd', '9999999800', o_orderkey * 100 + 50, o_orderstatus, o_totalprice, o_orderdate
        FROM {{orders}} WHERE o_totalprice < 50000
        UNION ALL
        SELECT {_TENANT}, o_orderkey, 'c', '9999999900', o_orderkey * 100 + 60, 'AGAIN', o_totalprice, o_orderdate
        FROM {{orders}} WHERE o_totalprice < 10000""",
    "f_target": f"""
        SELECT {_TENANT} AS tenant_id, o_orderkey, 'OLD' AS status, CAST(0.0 AS DOUBLE) AS price,
               o_orderdate AS modified
        FROM {{orders}} WHERE year(o_orderdate) < 1999""",
    "f_bronze": f"""
        SELECT {_TENANT} AS tenant_id, o_orderkey, o_orderstatus AS status, o_totalprice AS price,
               {_MONTH_BATCH.format("o_orderdate")} AS batch_id,
               CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS _op
        FROM {{orders}}""",
    "f_source_ok": f"""
        SELECT {_TENANT} AS tenant_id, o_orderkey, o_orderstatus AS status, o_totalprice + 5.0 AS price
        FROM {{orders}} WHERE o_totalprice >= 30000""",
    "f_source_bad": f"""
        SELECT {_TENANT} AS tenant_id, o_orderkey, o_orderstatus AS status, o_totalprice AS price
        FROM {{orders}} WHERE o_totalprice >= 100000""",
    "f_landing": f"""
        SELECT {_LANDING_TENANT} AS tenant_id, 'shop' AS schema_name, {_LANDING_TABLE} AS table_name,
               CAST(year(l_shipdate) * 10000000000 + 101000000 AS BIGINT) AS batch_id,
               l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity, l_shipdate AS shipped
        FROM {{lineitem}}""",
    "f_watermark": """
        SELECT tenant_id, schema_name, table_name AS source_table, max(batch_id) AS last_batch_id
        FROM f_landing WHERE tenant_id <> 2 AND year(shipped) < 1997 + tenant_id
        GROUP BY tenant_id, schema_name, table_name""",
    "f_stage": f"""
        SELECT CAST(CASE WHEN value < 60 THEN 1 ELSE 2 END AS INT) AS tenant_id,
               CASE WHEN value > 20 AND value < 30 THEN ' APP ' WHEN value > 30 AND value < 35 THEN 'ops'
                    ELSE 'app' END AS source_schema,
               CASE WHEN value > 10 AND value < 15 THEN upper(event_type) ELSE event_type END AS source_table,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               lpad(CAST(event_id AS STRING), 16, '0') AS commit_lsn,
               CASE WHEN event_type = 'click' THEN CAST(NULL AS STRING) ELSE 'shop' END AS source_db,
               CASE WHEN value > 300 THEN NULL ELSE ts END AS source_commit_ts,
               {_DAY_BATCH.format("ts")} AS batch_id, event_id AS stage_seq, ts + INTERVAL 2 MINUTE AS ingest_ts,
               event_id, user_id, value
        FROM {{events}}""",
    "f_raw_events": """
        SELECT event_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'u' END AS op,
               CASE WHEN value < 2 THEN NULL ELSE event_type END AS source_table,
               CASE WHEN value > 40 AND value < 60 THEN NULL ELSE 'sales' END AS source_schema,
               CASE WHEN value > 80 THEN 'OtherDb' WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN 'SHOP'
                    ELSE 'shop' END AS source_db,
               lpad(CAST(event_id AS STRING), 16, '0') AS commit_lsn, ts, user_id, value
        FROM {events}""",
    # what the event tables hold before a compaction run: one row per user seen with a small value
    "f_users": """
        SELECT tenant_id, min(event_id) AS event_id, user_id, max(value) AS value, min(source_commit_ts) AS happened,
               CAST(min(source_commit_ts) AS DATE) AS day, CAST(min(source_commit_ts) AS DATE) AS _ingest_date,
               'r' AS _op, min(batch_id) AS batch_id
        FROM f_stage GROUP BY tenant_id, user_id HAVING min(value) < 2 OR min(value) > 59""",
    "f_registry": """
        SELECT 'app' AS source_schema, event_type AS source_table, 'app_' || event_type AS bronze_table,
               CASE event_type WHEN 'purchase' THEN 'event_id, user_id' ELSE 'user_id' END AS pk_columns,
               event_type <> 'view' AS is_active
        FROM {events} WHERE event_type <> 'click' GROUP BY event_type
        UNION ALL
        SELECT p_brand, p_type, lower(p_brand) || '_' || lower(p_type),
               CASE WHEN p_type = 'PROMO' THEN '' WHEN p_type = 'LARGE' THEN 'id , version' ELSE 'id' END,
               p_type <> 'SMALL'
        FROM {part} GROUP BY p_brand, p_type""",
    # one row per column of a source table; brands 20 and up are missing at the source
    "f_columns": """
        SELECT p_brand AS table_schema, p_type AS table_name,
               CASE WHEN p_size = 7 THEN 'ModifiedOn' WHEN p_size = 8 THEN 'createdon'
                    ELSE 'Col_' || CAST(p_partkey AS STRING) END AS column_name,
               CASE WHEN p_size < 10 THEN 'int' WHEN p_size < 30 THEN 'varchar' WHEN p_size < 35 THEN 'image'
                    WHEN p_size < 40 THEN 'XML' WHEN p_size < 45 THEN 'varbinary' ELSE 'datetime2' END AS data_type,
               CASE WHEN p_size >= 25 AND p_size < 30 THEN -1 WHEN p_size < 30 THEN 50 END AS char_len
        FROM {part} WHERE p_brand NOT LIKE 'Brand#2_'""",
    "f_detail": f"""
        SELECT 'run-' || o_orderstatus AS execution_id, {_TENANT} AS tenant_id,
               CASE WHEN year(o_orderdate) < 1998 THEN 'shop' ELSE 'ops' END AS schema_name,
               'Customer_' || CAST(o_custkey AS STRING) AS source_table,
               {_MONTH_BATCH.format("o_orderdate")} AS batch_id,
               CASE WHEN o_totalprice < 20000 THEN 'SKIPPED'
                    WHEN year(o_orderdate) = 1997 AND o_totalprice > 450000 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS inserted_rows,
               CASE WHEN o_totalprice < 10000 THEN 'schema ops not in run scope'
                    WHEN o_totalprice < 20000 THEN 'unregistered or inactive'
                    WHEN year(o_orderdate) = 1997 AND o_totalprice > 450000 THEN 'key clash' END AS error_message,
               o_orderdate AS start_ts, o_orderdate + INTERVAL 90 SECOND AS end_ts
        FROM {{orders}}""",
    "f_gate": """
        SELECT max(batch_id) AS batch_id, max(end_ts) AS completed_ts, 'run-0' AS execution_id
        FROM f_detail WHERE year(start_ts) < 1997 GROUP BY year(start_ts)""",
    "f_marks": """
        SELECT tenant_id, schema_name, source_table, max(batch_id) AS last_batch_id, max(end_ts) AS updated_on
        FROM f_detail WHERE status = 'SUCCESS' AND execution_id <> 'run-P'
        GROUP BY tenant_id, schema_name, source_table""",
    "f_actions": """
        SELECT CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS INT) AS Sort1, l_shipdate AS Sort2,
               p_type AS Category, p_name AS DisplayMember, p_brand AS Code,
               CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS INT) AS tenant_id,
               l_orderkey AS ApparatusPersonnel_ID_Internal
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY ALL""",
    "f_temporal_text": """
        SELECT event_id,
               CASE WHEN event_type = 'click' THEN '1704067200' WHEN event_type = 'view' THEN '1704067200000'
                    WHEN event_type = 'error' THEN '1704067200000000' WHEN value < 20 THEN '1704067200000000000'
                    WHEN value < 60 THEN '2024-01-01T00:00:00Z' ELSE 'junk' END AS v,
               CASE WHEN event_type = 'click' THEN '19723' WHEN event_type = 'view' THEN '2024-01-01'
                    ELSE 'junk' END AS d
        FROM {events}""",
}

_NAMES = re.compile(r"\b[fd]_[a-z_]+\b")


def with_fixtures(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the fixtures it names, and those they name, in front as common table expressions."""
    known = {**FIXTURES, **(extra or {})}
    order: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name in known and name not in order:
                need(known[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    if re.match(r"\s*WITH\s", body, re.IGNORECASE):
        return f"WITH {head},\n" + re.sub(r"^\s*WITH\s", "", body, count=1, flags=re.IGNORECASE)
    return f"WITH {head}\n{body}"


def plain(text: str) -> str:
    """The text as DuckDB runs it, on views named like the tables."""
    return re.sub(r"\{(\w+)\}", r"\1", text)


class Inputs:
    """Test tables and fixtures of one scale as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        tune(spark)
        # naive times in the files are UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, body: str, extra: dict[str, str] | None = None) -> DataFrame:
        text = with_fixtures(body, extra)
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{n: self.table(n) for n in TABLES if n in used})

    def __getattr__(self, name: str) -> DataFrame:
        if name in FIXTURES:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)
