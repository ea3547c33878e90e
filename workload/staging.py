"""What a compaction run claims, changes and leaves behind, on the staged events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import checks, control
from rivulet.sources.sinks import dead_letters
from rivulet.streaming.compaction import compaction_cycle
from workload.catalog import query
from workload.changes import AS_OF, RUN, as_of
from workload.inputs import Inputs
from workload.payloads import event_stage

NOW = "2024-01-28 00:00:00"
GRACE = 2 * 24 * 60  # minutes
_MINE = f"tenant_id = 1 AND ingest_ts <= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"


def now():
    return F.lit(NOW).cast("timestamp")


def stage(i: Inputs) -> DataFrame:
    return i.f_stage.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("ingest_ts", "source_commit_ts")}
    )


@query(
    "q_claim_boundary",
    f"""SELECT max(stage_seq) AS boundary, max(batch_id) AS run_batch, count(*) AS claimed_rows
        FROM f_stage WHERE {_MINE}""",
)
def _(i: Inputs) -> DataFrame:
    return control.claim_boundary(stage(i), 1, now(), GRACE)


@query(
    "q_unified_batch",
    f"""SELECT stage_seq, batch_id, (SELECT max(batch_id) FROM f_stage WHERE {_MINE}) AS run_batch
        FROM f_stage WHERE {_MINE}""",
)
def _(i: Inputs) -> DataFrame:
    mine = stage(i).filter((F.col("tenant_id") == 1) & control.settled(now(), GRACE))
    return control.unify_batch(mine.select("stage_seq", "batch_id"))


@query("q_stage_groups", "SELECT DISTINCT source_schema, source_table FROM f_stage")
def _(i: Inputs) -> DataFrame:
    return control.stage_groups(stage(i))


@query(
    "q_lag_profile",
    f"""SELECT source_schema, source_table, count(*) AS rows_processed, max(source_commit_ts) AS newest_source_commit,
               min(source_commit_ts) AS oldest_source_commit, quantile_disc(lag, 0.5) AS median_lag_s,
               max(lag) AS max_lag_s
        FROM (SELECT *, CAST(floor(epoch(TIMESTAMP '{AS_OF}')) - floor(epoch(source_commit_ts)) AS BIGINT) AS lag
              FROM f_stage WHERE source_commit_ts IS NOT NULL) x
        GROUP BY source_schema, source_table""",
)
def _(i: Inputs) -> DataFrame:
    return control.lag_profile(stage(i), as_of(), accuracy=None)


@query(
    "q_lag_over_cycles",
    f"""SELECT source_schema, source_table, count(*) AS rows_processed, TRUE AS close FROM f_stage
        WHERE source_commit_ts IS NOT NULL GROUP BY source_schema, source_table""",
)
def _(i: Inputs) -> DataFrame:
    """A cycle a day, each leaving its sketches: the median over all of them against the lags themselves. A median is
    close if its rank is within two percent (and one row, for tables of a few rows)."""
    rows = stage(i)
    names = ["source_schema", "source_table"]
    # one pass gives the sketches that thirty cycles would leave
    day = F.concat_ws("|", "source_table", F.col("ingest_ts").cast("date").cast("string"))
    kept = control.lag_sketches(rows.withColumn("source_table", day), as_of())
    kept = kept.withColumn("source_table", F.substring_index("source_table", "|", 1))
    found = control.lag_over_cycles(kept)
    lags = rows.filter("source_commit_ts IS NOT NULL").select(*names, control.lag_seconds(as_of()).alias("lag"))
    ranked = lags.join(found, names).groupBy(*names, "rows_processed").agg(
        F.count_if(F.col("lag") < F.col("lag_p50_s")).alias("below"), F.count_if(F.col("lag") <= F.col("lag_p50_s")).alias("upto"),
    )
    half, slack = F.col("rows_processed") / 2, F.col("rows_processed") * 0.02 + 1
    return ranked.select(*names, "rows_processed", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("close"))


def _processed(i: Inputs) -> DataFrame:
    """Outcome per staged table: unregistered tables are skipped, the others end well."""
    return i.sql(_OUTCOME)


_OUTCOME = """
    SELECT DISTINCT 'App' AS schema_name, lower(source_table) AS source_table,
           CASE lower(source_table) WHEN 'signup' THEN 'SUCCESS' WHEN 'purchase' THEN 'FAILED'
                WHEN 'error' THEN 'SUCCESS' ELSE 'SKIPPED' END AS status
    FROM f_stage"""


@query(
    "q_stage_orphans",
    """SELECT source_schema, source_table, count(*) AS orphaned_rows FROM f_stage
       WHERE tenant_id = 1 AND lower(trim(source_schema)) = 'app' AND lower(source_table) IN ('signup', 'error')
       GROUP BY source_schema, source_table""",
)
def _(i: Inputs) -> DataFrame:
    return checks.stage_orphans(stage(i), _processed(i), 1)


@query(
    "q_unregistered_stage",
    """SELECT s.source_schema, s.source_table, count(*) AS rows FROM f_stage s
       LEFT JOIN f_registry r ON lower(trim(s.source_schema)) = lower(r.source_schema)
             AND lower(s.source_table) = lower(r.source_table) AND r.is_active
       WHERE r.source_table IS NULL AND s.tenant_id = 1 GROUP BY s.source_schema, s.source_table""",
)
def _(i: Inputs) -> DataFrame:
    return checks.unregistered_stage(stage(i), i.f_registry, 1)


@query(
    "q_dead_letter",
    f"""SELECT TIMESTAMP '{AS_OF}' AS dead_lettered_at, '{RUN}' AS run_id, batch_id, source_schema,
               'purchase' AS source_table, source_db, op, commit_lsn, 'key columns not captured' AS error,
               '{{{{"id":' || CAST(event_id AS STRING) || '}}}}' AS raw_value
        FROM f_stage WHERE lower(source_table) = 'purchase'""".replace("{{", "{").replace("}}", "}"),
)
def _(i: Inputs) -> DataFrame:
    raw = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit("}"))
    rows = stage(i).filter(F.lower("source_table") == "purchase").withColumn("value_json", raw)
    return dead_letters(
        rows, source_table="purchase", error="key columns not captured", run_id=RUN, dead_lettered_at=as_of()
    )


@query(
    "q_compaction_cycle",
    f"""WITH slice AS (SELECT * FROM f_stage WHERE {_MINE} AND lower(trim(source_schema)) = 'app'),
             latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(source_table), user_id
                                              ORDER BY commit_lsn DESC, stage_seq DESC) AS rn FROM slice) x WHERE rn = 1),
             fresh AS (SELECT * FROM latest WHERE lower(source_table) = 'signup'),
             top AS (SELECT max(batch_id) AS batch FROM slice WHERE lower(source_table) = 'signup')
        SELECT 'signup' AS bronze, u.tenant_id, u.event_id, u.user_id, u.value, u.happened, u.day, u._ingest_date, u._op, u.batch_id
        FROM f_users u LEFT JOIN fresh f ON u.tenant_id = 1 AND u.user_id = f.user_id WHERE f.user_id IS NULL
        UNION ALL
        SELECT 'signup', 1, f.event_id, f.user_id, f.value, f.source_commit_ts, CAST(f.source_commit_ts AS DATE),
               DATE '2024-01-28', f.op, t.batch FROM fresh f, top t
        UNION ALL
        SELECT 'error', u.tenant_id, u.event_id, u.user_id, u.value, u.happened, u.day, u._ingest_date, u._op, u.batch_id
        FROM f_users u WHERE NOT (u.tenant_id = 1 AND u.user_id IN (SELECT user_id FROM latest WHERE lower(source_table) = 'error'))""",
)
def _(i: Inputs) -> DataFrame:
    """Claim, change all tables, account. Signups update or insert, errors delete, purchases fail
    (their key is not captured) and are parked, views and clicks are left staged."""
    users = i.f_users.withColumn("happened", F.col("happened").cast("timestamp"))
    cycle = compaction_cycle(
        event_stage(i), i.f_registry, lambda name: users, tenant_id=1, run_id=RUN, as_of=now(), grace_minutes=GRACE,
    )
    states = [
        df.withColumn("bronze", F.lit(table)) for (_, table), df in sorted(cycle.states.items())
    ]
    return reduce(DataFrame.unionByName, states)
