"""Messages, parsing, and everything decided from column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet import model
from rivulet.functions.keys import canonical_keys
from rivulet.functions.temporal import decode_temporals
from rivulet.operators import merge, payload
from rivulet.operators import registry as reg
from rivulet.sources.source_db import ParquetSource, partition_bounds, quantile_ranges, split_ranges
from rivulet.streaming.stage import StageRun, read_changes, read_stage, sequenced, start_staging
from rivulet.session import scratch
from workload.catalog import query
from workload.changes import AS_OF, RUN, as_of
from workload.inputs import Inputs

BATCH = 20240201000000


def messages(i: Inputs) -> DataFrame:
    """Raw change messages; ``to_json`` leaves NULL fields out, as a capture does."""
    image = F.struct(
        "event_id", "user_id", "value",
        F.col("op").alias("__op"), F.col("source_table").alias("__source_table"),
        F.col("source_schema").alias("__source_schema"), F.col("source_db").alias("__source_db"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("__source_ts_ms"),
        F.col("commit_lsn").alias("__commit_lsn"),
    )
    return i.f_raw_events.select(
        F.to_json(image).cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("event_id") % 8).cast("int").alias("partition"), F.col("event_id").alias("offset"),
    )


def _placed(i: Inputs) -> DataFrame:
    return messages(i).withColumnsRenamed({"partition": "source_partition", "offset": "source_offset"}).withColumn(
        "source_partition", F.col("source_partition").cast("string")
    )


def _envelope(i: Inputs) -> DataFrame:
    return payload.stage_envelope(
        _placed(i), tenant_id=1, default_schema="app", batch_id=BATCH, micro_batch_id=7, run_id=RUN,
        ingest_ts=as_of(),
    )


_ENVELOPE = f"""
    SELECT CAST(1 AS INT) AS tenant_id, coalesce(source_schema, 'app') AS source_schema, source_table,
           coalesce(op, 'u') AS op, commit_lsn, source_db, date_trunc('milliseconds', ts) AS source_commit_ts,
           ts AS eh_enqueued_ts, CAST({BATCH} AS BIGINT) AS batch_id, CAST(7 AS BIGINT) AS micro_batch_id,
           TIMESTAMP '{AS_OF}' AS ingest_ts, '{RUN}' AS run_id,
           CAST(event_id % 8 AS VARCHAR) AS source_partition, event_id AS source_offset
    FROM f_raw_events WHERE source_table IS NOT NULL"""
_CHECKED = f"SELECT * FROM d_envelope WHERE source_db IS NULL OR lower(source_db) = 'shop'"


@query("q_stage_envelope", _ENVELOPE)
def _(i: Inputs) -> DataFrame:
    return _envelope(i).drop("value_json")


@query("q_tenant_cross_check", _CHECKED, {"d_envelope": _ENVELOPE})
def _(i: Inputs) -> DataFrame:
    return payload.tenant_cross_check(_envelope(i), "Shop").drop("value_json")


@query(
    "q_stream_stage_append",
    """SELECT tenant_id, source_schema, source_table, op, commit_lsn, source_db, source_commit_ts, eh_enqueued_ts,
              batch_id, ingest_ts, run_id, CAST(ingest_ts AS DATE) AS ingest_date, source_partition, source_offset,
              row_number() OVER (PARTITION BY source_partition ORDER BY source_offset) AS place
       FROM (""" + _CHECKED + ") c",
    {"d_envelope": _ENVELOPE},
)
def _(i: Inputs) -> DataFrame:
    """The whole ingest job over message files: read stream, one write per micro-batch, drain and stop."""
    base = scratch(i.spark, "ingest")
    messages(i).repartition("partition").write.parquet(f"{base}/messages")
    run = StageRun(
        tenant_id=1, default_schema="app", expected_db="shop", batch_id=BATCH, run_id=RUN,
        stage_path=f"{base}/stage", stream_id="events", ingest_ts=as_of(),
    )
    changes = read_changes(i.spark, "parquet", path=f"{base}/messages", maxFilesPerTrigger="8")
    start_staging(changes, run.append_batch, f"{base}/checkpoint").awaitTermination()
    staged = read_stage(i.spark, run.stage_path)
    # which files share a micro-batch is left to the source: compare the order in each partition
    place = F.row_number().over(Window.partitionBy("source_partition").orderBy("stage_seq"))
    return staged.withColumn("place", place).drop("value_json", "stream_id", "micro_batch_id", "stage_seq")


@query(
    "q_stream_new_checkpoint",
    """SELECT source_partition, source_offset, place, first_copy, later FROM (
           SELECT source_partition, source_offset,
                  row_number() OVER (PARTITION BY source_partition, f ORDER BY source_offset) AS place, f AS first_copy, NOT f AS later
           FROM (""" + _CHECKED + """) c, (VALUES (TRUE), (FALSE)) v(f)) x""",
    {"d_envelope": _ENVELOPE},
)
def _(i: Inputs) -> DataFrame:
    """The same messages through two checkpoints: the second stream stages them again, above all sequences of the first."""
    base = scratch(i.spark, "ingest")
    messages(i).repartition("partition").write.parquet(f"{base}/messages")
    for stream in ("first", "second"):
        run = StageRun(
            tenant_id=1, default_schema="app", expected_db="shop", batch_id=BATCH, run_id=RUN,
            stage_path=f"{base}/stage", stream_id=stream, ingest_ts=as_of(),
        )
        changes = read_changes(i.spark, "parquet", path=f"{base}/messages", maxFilesPerTrigger="8")
        start_staging(changes, run.append_batch, f"{base}/checkpoint-{stream}").awaitTermination()
    staged = read_stage(i.spark, run.stage_path)
    top = staged.filter("stream_id = 'first'").agg(F.max("stage_seq").alias("top"))
    place = F.row_number().over(Window.partitionBy("stream_id", "source_partition").orderBy("stage_seq"))
    # the lower of a message's two sequences is the first stream's
    first = F.row_number().over(Window.partitionBy("source_partition", "source_offset").orderBy("stage_seq")) == 1
    return staged.join(F.broadcast(top)).select(
        "source_partition", "source_offset", place.alias("place"), first.alias("first_copy"), (F.col("stage_seq") > F.col("top")).alias("later"),
    )


@query(
    "q_stage_sequence",
    """SELECT commit_lsn, source_offset, CAST(1000 + start + source_offset - low + 1 AS BIGINT) AS stage_seq
       FROM d_envelope JOIN (
           SELECT source_partition, low,
                  coalesce(sum(high - low + 1) OVER (ORDER BY began, source_partition
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
           FROM (SELECT source_partition, min(eh_enqueued_ts) AS began, min(source_offset) AS low,
                        max(source_offset) AS high FROM d_envelope GROUP BY 1)
       ) USING (source_partition)""",
    {"d_envelope": _ENVELOPE},
)
def _(i: Inputs) -> DataFrame:
    return sequenced(_envelope(i), 1000).select("commit_lsn", "source_offset", "stage_seq")


@query(
    "q_stamp_meta",
    f"""SELECT CAST(4 AS INT) AS tenant_id, o_orderkey, op, commit_lsn, op AS "_op", CAST({BATCH} AS BIGINT) AS batch_id,
               '{RUN}' AS run_id, DATE '2024-02-01' AS "_ingest_date", TIMESTAMP '{AS_OF}' AS ingestion_time,
               commit_lsn AS source_log_position
        FROM f_change_log""",
)
def _(i: Inputs) -> DataFrame:
    rows = i.f_change_log.select("tenant_id", "o_orderkey", "op", "commit_lsn")
    return payload.stamp_meta(
        rows, batch_id=BATCH, run_id=RUN, as_of=as_of(), tenant_id=4, log_position="commit_lsn"
    )


def event_stage(i: Inputs) -> DataFrame:
    """Staged events with a row image: key spellings differ from the target's, purchases carry no user,
    times are epoch microseconds and day counts."""
    commit = F.col("source_commit_ts").cast("timestamp")
    image = F.struct(
        "event_id",
        F.when(F.lower("source_table") != "purchase", F.col("user_id")).alias("USER_ID"),
        "value",
        F.unix_micros(commit).alias("Happened"),
        F.unix_date(commit.cast("date")).alias("day"),
        F.col("op").alias("__op"),
    )
    return i.f_stage.withColumns(
        {
            "value_json": F.to_json(image),
            "source_commit_ts": commit,
            "ingest_ts": F.col("ingest_ts").cast("timestamp"),
        }
    ).drop("event_id", "user_id", "value")


EVENT_TARGET = model.shape(
    "tenant_id int, event_id bigint, user_id bigint, value double, happened timestamp, day date, "
    "_ingest_date date, _op string, batch_id bigint"
)


@query(
    "q_parse_payload",
    """SELECT tenant_id, op, commit_lsn, stage_seq, event_id,
              CASE WHEN lower(source_table) <> 'purchase' THEN user_id END AS user_id, value,
              source_commit_ts AS happened, CAST(source_commit_ts AS DATE) AS day
       FROM f_stage""",
)
def _(i: Inputs) -> DataFrame:
    return payload.parse_payload(event_stage(i), EVENT_TARGET, ["event_id", "USER_ID", "value", "Happened", "day"])


_PRESENT = """
    SELECT DISTINCT lower(trim(source_schema)) AS source_schema, lower(source_table) AS source_table, column_name
    FROM (SELECT source_schema, source_table, 'event_id' AS column_name FROM f_stage
          UNION ALL SELECT source_schema, source_table, 'value' FROM f_stage
          UNION ALL SELECT source_schema, source_table, '__op' FROM f_stage
          UNION ALL SELECT source_schema, source_table, 'user_id' FROM f_stage WHERE lower(source_table) <> 'purchase'
          UNION ALL SELECT source_schema, source_table, 'happened' FROM f_stage WHERE source_commit_ts IS NOT NULL
          UNION ALL SELECT source_schema, source_table, 'day' FROM f_stage WHERE source_commit_ts IS NOT NULL) x"""


def _present(i: Inputs) -> DataFrame:
    return payload.payload_columns(event_stage(i))


@query("q_payload_columns", _PRESENT)
def _(i: Inputs) -> DataFrame:
    return _present(i).withColumn("column_name", F.lower("column_name")).distinct()


@query(
    "q_key_guards",
    """SELECT k.source_schema, k.source_table, k.column_name
       FROM (SELECT source_schema, source_table, unnest(string_split(replace(pk_columns, ' ', ''), ',')) AS column_name
             FROM f_registry WHERE is_active AND pk_columns <> '') k
       WHERE EXISTS (SELECT 1 FROM d_present p
                     WHERE p.source_schema = lower(k.source_schema) AND p.source_table = lower(k.source_table))
         AND NOT EXISTS (SELECT 1 FROM d_present p
                         WHERE p.source_schema = lower(k.source_schema) AND p.source_table = lower(k.source_table)
                           AND p.column_name = lower(k.column_name))""",
    {"d_present": _PRESENT},
)
def _(i: Inputs) -> DataFrame:
    return payload.uncaptured_keys(reg.active_registry(i.f_registry), _present(i))


@query(
    "q_decode_temporals",
    """SELECT event_id,
              CASE WHEN NOT regexp_matches(v, '^-?[0-9]+$') THEN TRY_CAST(replace(replace(v, 'T', ' '), 'Z', '') AS TIMESTAMP)
                   WHEN abs(CAST(v AS HUGEINT)) < 100000000000 THEN make_timestamp(CAST(v AS BIGINT) * 1000000)
                   WHEN abs(CAST(v AS HUGEINT)) < 100000000000000 THEN make_timestamp(CAST(v AS BIGINT) * 1000)
                   WHEN abs(CAST(v AS HUGEINT)) < 100000000000000000 THEN make_timestamp(CAST(v AS BIGINT))
                   ELSE make_timestamp(CAST(v AS BIGINT) // 1000) END AS v,
              CASE WHEN regexp_matches(d, '^-?[0-9]+$') THEN DATE '1970-01-01' + CAST(d AS INT)
                   ELSE TRY_CAST(d AS DATE) END AS d
       FROM f_temporal_text""".replace("CAST(v AS HUGEINT)", "TRY_CAST(v AS HUGEINT)")
    .replace("CAST(v AS BIGINT)", "TRY_CAST(v AS BIGINT)").replace("CAST(d AS INT)", "TRY_CAST(d AS INT)"),
)
def _(i: Inputs) -> DataFrame:
    return decode_temporals(i.f_temporal_text, {"v": "timestamp", "d": "date"})


@query(
    "q_fill_audit_ts",
    """SELECT event_id, CASE WHEN value < 60 THEN coalesce(ts, ts) ELSE ts + INTERVAL 2 MINUTE END AS "ModifiedOn",
              CASE WHEN event_type = 'signup' THEN ts + INTERVAL 1 DAY ELSE ts END AS "CreatedOn"
       FROM {events}""",
)
def _(i: Inputs) -> DataFrame:
    """Modified is missing below 60, created on all but signups; both then take the commit time."""
    rows = i.sql(
        """SELECT event_id, CASE WHEN value >= 60 THEN ts + INTERVAL 2 MINUTE END AS ModifiedOn,
                  CASE WHEN event_type = 'signup' THEN ts + INTERVAL 1 DAY END AS CreatedOn, ts AS source_commit_ts
           FROM {events}"""
    )
    return payload.fill_audit_times(rows).drop("source_commit_ts")


@query(
    "q_drift_safe_select",
    """SELECT tenant_id, o_orderkey, status, CAST(1 AS INT) AS skipped_columns FROM f_source_ok""",
)
def _(i: Inputs) -> DataFrame:
    """The source has a column the target lacks and a price the capture does not carry: neither is written."""
    source = i.f_source_ok.withColumnRenamed("status", "STATUS").withColumn("extra", F.col("price") * 2)
    shaped = payload.shared_columns(source, i.f_target.columns)
    write, skipped = payload.writable_columns(shaped.columns, i.f_target.columns, ["o_orderkey", "Status"])
    return shaped.select(*write, F.lit(len(skipped)).alias("skipped_columns"))


@query(
    "q_canonical_keys",
    """SELECT lower(c_name) AS c_name, c_acctbal + 1 AS balance, CASE WHEN c_acctbal < 5000 THEN c_nationkey END AS c_nationkey
       FROM {customer}""",
)
def _(i: Inputs) -> DataFrame:
    """Stored keys are lower case, the source spells them in upper case: rows match, none doubles."""
    stored = i.sql(
        "SELECT lower(c_name) AS c_name, c_acctbal AS balance, c_nationkey FROM {customer} WHERE c_acctbal < 5000"
    )
    source = i.sql("SELECT upper(c_name) AS c_name, c_acctbal + 1 AS balance FROM {customer}")
    return merge.upsert(stored, canonical_keys(source, ["c_name"]), ["c_name"])


@query(
    "q_align_schema",
    """SELECT c_name AS "C_NAME", CAST(c_custkey AS INT) AS "C_CustKey", CAST(c_acctbal AS DECIMAL(12,2)) AS "c_acctbal",
              CAST(NULL AS DECIMAL(12,4)) AS "Rate", CAST(NULL AS DATE) AS "_ingest_date" FROM {customer}""",
)
def _(i: Inputs) -> DataFrame:
    shape = model.shape(
        "C_NAME string, C_CustKey int, c_acctbal decimal(12,2), Rate decimal(12,4), _ingest_date date"
    )
    return model.align_schema(i.table("customer"), shape)


_TEXT = """
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'n/a' WHEN value > 200 THEN '' ELSE CAST(value AS STRING) END AS v,
           event_type, CASE WHEN value < 20 THEN event_type END AS low, CASE WHEN value < 60 THEN 'mid' END AS mid, value
    FROM {events}"""


@query(
    "q_safe_casts",
    """SELECT event_id, CAST(TRY_CAST(v AS FLOAT) AS DOUBLE) AS as_float, TRY_CAST(v AS DECIMAL(18,2)) AS as_decimal,
              TRY_CAST(event_id || '' AS BIGINT) AS as_whole, CAST(NULL AS INTEGER) AS no_value
       FROM d_text""",
    {"d_text": _TEXT},
)
def _(i: Inputs) -> DataFrame:
    return i.sql("SELECT * FROM d_text", {"d_text": _TEXT}).select(
        "event_id",
        F.col("v").try_cast("float").cast("double").alias("as_float"),
        F.col("v").try_cast("decimal(18,2)").alias("as_decimal"),
        F.col("event_id").cast("string").try_cast("decimal(38,0)").cast("bigint").alias("as_whole"),
        F.lit(None).cast("int").alias("no_value"),
    )


@query(
    "q_null_funcs",
    """SELECT event_id, coalesce(low, mid, 'high') AS first_known, nullif(event_type, 'view') AS but_view,
              low || '-' || mid AS both_parts, nullif(trim(coalesce(low, '') || ' ' || coalesce(mid, '')), '') AS joined
       FROM d_text""",
    {"d_text": _TEXT},
)
def _(i: Inputs) -> DataFrame:
    none = F.lit("")
    return i.sql("SELECT * FROM d_text", {"d_text": _TEXT}).select(
        "event_id",
        F.coalesce("low", "mid", F.lit("high")).alias("first_known"),
        F.nullif("event_type", F.lit("view")).alias("but_view"),
        F.concat("low", F.lit("-"), "mid").alias("both_parts"),
        F.nullif(
            F.trim(F.concat(F.coalesce("low", none), F.lit(" "), F.coalesce("mid", none))), none
        ).alias("joined"),
    )


@query(
    "q_string_funcs",
    """SELECT p_partkey, lower(p_brand) AS low, upper(p_name) AS up, trim('  ' || p_type || ' ') AS cut,
              "left"(p_name, 5) AS head, CAST(length(p_name) AS INT) AS size, p_name LIKE '%ring%' AS has_ring,
              regexp_matches(p_brand, '^Brand#1[0-9]$') AS in_teens
       FROM {part}""",
)
def _(i: Inputs) -> DataFrame:
    return i.table("part").select(
        "p_partkey",
        F.lower("p_brand").alias("low"),
        F.upper("p_name").alias("up"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("cut"),
        F.left("p_name", F.lit(5)).alias("head"),
        F.length("p_name").alias("size"),
        F.col("p_name").like("%ring%").alias("has_ring"),
        F.col("p_brand").rlike("^Brand#1[0-9]$").alias("in_teens"),
    )


@query(
    "q_registry_list",
    """SELECT source_schema, source_table, bronze_table,
              array_to_string(list_filter(list_transform(string_split(pk_columns, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS pk
       FROM f_registry WHERE is_active AND pk_columns <> '' ORDER BY source_schema, source_table""",
)
def _(i: Inputs) -> DataFrame:
    return (
        reg.active_registry(i.f_registry)
        .select("source_schema", "source_table", "bronze_table", F.array_join("pk", "|").alias("pk"))
        .orderBy("source_schema", "source_table")
    )


@query(
    "q_scope_filter",
    """SELECT tenant_id, source_schema, source_table, stage_seq FROM f_stage
       WHERE lower(trim(source_schema)) IN ('app', 'web')""",
)
def _(i: Inputs) -> DataFrame:
    rows = i.f_stage.select("tenant_id", "source_schema", "source_table", "stage_seq")
    return reg.in_schemas(rows, " App, web,")


_TRACKABLE = """SELECT table_schema, table_name FROM f_columns
    GROUP BY table_schema, table_name
    HAVING max(CASE WHEN lower(column_name) IN ('modifiedon', 'createdon', 'cdc_insert_date') THEN 1 ELSE 0 END) = 1"""


@query("q_trackable_tables", _TRACKABLE)
def _(i: Inputs) -> DataFrame:
    return reg.trackable_tables(i.f_columns)


@query(
    "q_road_classify",
    """SELECT r.source_schema, r.source_table, r.bronze_table,
              CASE WHEN r.source_schema IN ('app', 'Brand#3') THEN 'stream' WHEN r.pk_columns = '' THEN 'no_pk'
                   WHEN c.table_name IS NULL THEN 'absent' WHEN t.table_name IS NOT NULL THEN 'timestamp'
                   ELSE 'full_load' END AS road
       FROM f_registry r
       LEFT JOIN (SELECT DISTINCT table_schema, table_name FROM f_columns) c
         ON c.table_schema = r.source_schema AND c.table_name = r.source_table
       LEFT JOIN d_trackable t ON t.table_schema = r.source_schema AND t.table_name = r.source_table
       WHERE r.is_active""",
    {"d_trackable": _TRACKABLE},
)
def _(i: Inputs) -> DataFrame:
    return reg.classify_roads(i.f_registry, i.f_columns, ["app", "Brand#3"])


@query(
    "q_road_explicit",
    """SELECT source_schema, source_table, bronze_table, 'explicit' AS road FROM f_registry
       WHERE is_active AND lower(source_table) IN ('promo', 'signup', 'view')""",
)
def _(i: Inputs) -> DataFrame:
    """Tables named by the caller: no other rule counts."""
    return reg.classify_roads(i.f_registry, i.f_columns, ["app", "Brand#3"], tables="PROMO, Signup,view")


_RECONCILE = """SELECT p_brand AS schema_name, p_type AS source_table, sum(p_size) - 25 * count(*) AS diff
    FROM {part} GROUP BY p_brand, p_type"""


@query(
    "q_targeted_scope",
    """SELECT r.source_schema, r.source_table, r.bronze_table FROM f_registry r
       WHERE EXISTS (SELECT 1 FROM d_reconcile d WHERE d.diff < 0 AND d.schema_name = r.source_schema
                     AND d.source_table = r.source_table)""",
    {"d_reconcile": _RECONCILE},
)
def _(i: Inputs) -> DataFrame:
    report = i.sql("SELECT * FROM d_reconcile", {"d_reconcile": _RECONCILE})
    return reg.heavier_than_source(i.f_registry, report).select("source_schema", "source_table", "bronze_table")


@query(
    "q_prune_blobs",
    """SELECT table_schema, table_name, column_name, data_type, CAST(char_len AS INT) AS char_len FROM f_columns
       WHERE NOT (lower(data_type) IN ('varbinary', 'image', 'binary', 'text', 'ntext', 'xml', 'timestamp')
                  OR (lower(data_type) IN ('varchar', 'nvarchar') AND coalesce(char_len, 0) = -1))""",
)
def _(i: Inputs) -> DataFrame:
    return reg.carried_columns(i.f_columns)


_CAPTURED = "SELECT table_schema, table_name, upper(column_name) AS column_name FROM f_columns WHERE data_type IN ('int', 'image')"


@query(
    "q_missing_columns",
    """SELECT table_schema, table_name, string_agg(column_name, ',' ORDER BY column_name) AS columns
       FROM (SELECT DISTINCT table_schema, table_name, column_name FROM f_columns
             WHERE data_type NOT IN ('int', 'image', 'XML', 'varbinary')) x
       GROUP BY table_schema, table_name""",
)
def _(i: Inputs) -> DataFrame:
    captured = i.sql("SELECT * FROM d_captured", {"d_captured": _CAPTURED})
    lacking = reg.missing_columns(captured, i.f_columns)
    return lacking.withColumn("columns", F.array_join("columns", ","))


@query(
    "q_include_exclude",
    """SELECT table_schema, table_name, column_name, data_type, CAST(char_len AS INT) AS char_len FROM f_columns c
       WHERE EXISTS (SELECT 1 FROM f_registry r WHERE r.is_active AND lower(r.source_schema) = lower(c.table_schema)
                     AND lower(r.source_table) = lower(c.table_name))
         AND NOT EXISTS (SELECT 1 FROM f_columns x WHERE x.data_type = 'image' AND x.table_schema = c.table_schema
                         AND x.table_name = c.table_name AND lower(x.column_name) = lower(c.column_name))""",
)
def _(i: Inputs) -> DataFrame:
    include = i.f_registry.filter("is_active").select(
        F.upper("source_schema").alias("table_schema"), F.lower("source_table").alias("table_name")
    )
    exclude = i.f_columns.filter("data_type = 'image'").select("table_schema", "table_name", "column_name")
    return reg.include_exclude(i.f_columns, include, exclude)


@query(
    "q_source_snapshot",
    "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus <> 'P'",
)
def _(i: Inputs) -> DataFrame:
    """Projection and predicate go down to the source."""
    source = ParquetSource(i.spark, i.dir)
    return source.read("orders", ["o_orderkey", "o_totalprice"], F.col("o_orderstatus") != "P")


@query(
    "q_partition_bounds",
    """WITH b AS (SELECT min(l_partkey) AS lo, max(l_partkey) AS hi FROM {lineitem}),
            p AS (SELECT lo, hi, CAST(unnest(range(8)) AS INT) AS part, (hi - lo + 1) // 8 AS step FROM b)
       SELECT part, lo + part * step AS from_key, CASE WHEN part = 7 THEN hi ELSE lo + (part + 1) * step - 1 END AS to_key
       FROM p""",
)
def _(i: Inputs) -> DataFrame:
    return split_ranges(partition_bounds(i.table("lineitem"), "l_partkey"), 8)


@query(
    "q_partition_quantiles",
    """SELECT CAST(8 AS BIGINT) AS ranges, count(*) AS rows, TRUE AS whole, TRUE AS even
       FROM (SELECT DISTINCT l_orderkey * l_orderkey AS k FROM {lineitem})""",
)
def _(i: Inputs) -> DataFrame:
    """Squared keys crowd at the lower end. Ranges cut by quantiles hold all rows once, none twice the median."""
    keys = i.table("lineitem").select((F.col("l_orderkey") * F.col("l_orderkey")).alias("k")).distinct()
    ranges = quantile_ranges(keys, "k", 8)
    held = keys.join(F.broadcast(ranges), F.col("k").between(F.col("from_key"), F.col("to_key")))
    each = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("d"))
    return each.agg(
        F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("rows"), (F.sum("n") == F.sum("d")).alias("whole"),
        (F.max("n") <= 2 * F.median("n")).alias("even"),
    )
