"""Control plane: what a run may claim, which batches are safe to promote, and how the run went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.merge import insert_if_absent


def settled(as_of: Column, grace_minutes: int) -> Column:
    """True for rows staged at least ``grace_minutes`` before ``as_of``."""
    return F.col("ingest_ts") <= as_of - F.make_dt_interval(mins=F.lit(grace_minutes))


def claim_boundary(stage: DataFrame, tenant_id: int, as_of: Column, grace_minutes: int = 0) -> DataFrame:
    """One row: highest settled sequence, the run's unified batch id, and rows claimed.

    An empty stage, or one still settling, gives NULL ids and a count of 0.
    """
    mine = stage.filter((F.col("tenant_id") == tenant_id) & settled(as_of, grace_minutes))
    return mine.agg(
        F.max("stage_seq").alias("boundary"),
        F.max("batch_id").alias("run_batch"),
        F.count(F.lit(1)).alias("claimed_rows"),
    )


def claimed(tenant_id: int, boundary: int, as_of: Column, grace_minutes: int = 0) -> Column:
    """The rows a run owns. Reading and acknowledging use this same condition."""
    return (
        (F.col("tenant_id") == tenant_id)
        & (F.col("stage_seq") <= boundary)
        & settled(as_of, grace_minutes)
    )


def unify_batch(stage: DataFrame) -> DataFrame:
    """Give every row of a slice the slice's highest batch id, so related tables share one batch.

    The id is a one-row aggregate, which Spark broadcasts.
    """
    top = stage.agg(F.max("batch_id").alias("run_batch"))
    return stage.join(F.broadcast(top))


def stage_groups(stage: DataFrame) -> DataFrame:
    return stage.select("source_schema", "source_table").distinct()


def stage_depth(stage: DataFrame) -> DataFrame:
    """Tables and rows per schema. Counting goes by table first, so a hot schema is combined early."""
    per_table = stage.groupBy("source_schema", "source_table").agg(F.count(F.lit(1)).alias("n"))
    return per_table.groupBy("source_schema").agg(
        F.count("source_table").alias("tables"), F.sum("n").alias("rows")
    )


def lag_seconds(as_of: Column, commit_time: str = "source_commit_ts") -> Column:
    return F.unix_timestamp(as_of) - F.unix_timestamp(F.col(commit_time))


def lag_profile(stage: DataFrame, as_of: Column, accuracy: int | None = 10_000) -> DataFrame:
    """Rows, newest and oldest commit, median and largest lag per staged table.

    The median is a mergeable sketch by default; ``accuracy=None`` gives the exact middle value, whose
    buffer holds one counter per distinct lag second, merged map-side.
    """
    keys = ["source_schema", "source_table"]
    rows = stage.filter(F.col("source_commit_ts").isNotNull()).select(
        *keys, "source_commit_ts", lag_seconds(as_of).alias("lag")
    )
    median = (
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY lag)").cast("bigint")
        if accuracy is None
        else F.percentile_approx("lag", 0.5, accuracy)
    )
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.max("source_commit_ts").alias("newest_source_commit"),
        F.min("source_commit_ts").alias("oldest_source_commit"),
        median.alias("median_lag_s"),
        F.max("lag").alias("max_lag_s"),
    )


LAG_SKETCH = 800  # size of lag sketches: ranks are wrong by about half a percent


def lag_sketches(stage: DataFrame, as_of: Column, k: int = LAG_SKETCH) -> DataFrame:
    """A quantile sketch of the lag per staged table, small enough to keep for every cycle and mergeable with others."""
    rows = stage.filter(F.col("source_commit_ts").isNotNull()).select(
        "source_schema", "source_table", lag_seconds(as_of).cast("bigint").alias("lag")
    )
    return rows.groupBy("source_schema", "source_table").agg(F.kll_sketch_agg_bigint("lag", F.lit(k)).alias("lag_sketch"))


def lag_over_cycles(kept: DataFrame, ranks: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Rows and lag quantiles per staged table over all cycles of ``kept`` (source_schema, source_table, lag_sketch).

    Sketches merge without their rows, so a month of cycles costs a row per cycle and table.
    """
    merged = kept.filter("lag_sketch IS NOT NULL").groupBy("source_schema", "source_table").agg(
        F.kll_merge_agg_bigint("lag_sketch").alias("merged")
    )
    quantiles = [F.kll_sketch_get_quantile_bigint("merged", F.lit(r)).alias(f"lag_p{round(100 * r)}_s") for r in ranks]
    return merged.select("source_schema", "source_table", F.kll_sketch_get_n_bigint("merged").alias("rows_processed"), *quantiles)


def promotable_batches(
    detail: DataFrame, gate: DataFrame, rule: str = "clean_and_newer", run_batch: int | None = None
) -> DataFrame:
    """Batch ids that may go on to the silver layer.

    ``clean_and_newer``  per batch: no table failed or was fatal, and above the last promoted id
    ``run_if_clean``     the run's own id, if nothing in the run failed
    ``run_if_newer``     as before, and only above the last promoted id
    """
    last = gate.agg(F.coalesce(F.max("batch_id"), F.lit(-1)).alias("last"))
    if rule == "clean_and_newer":
        candidates = (
            detail.filter(F.col("batch_id").isNotNull())
            .groupBy("batch_id")
            .agg(F.count_if(F.col("status").isin("FAILED", "FATAL")).alias("failed"))
            .filter("failed = 0")
            .select("batch_id")
        )
    elif rule in ("run_if_clean", "run_if_newer"):
        candidates = detail.agg(
            (F.max("batch_id") if run_batch is None else F.lit(run_batch).cast("bigint")).alias("batch_id"),
            F.count_if(F.col("status").isin("FAILED", "FATAL")).alias("failed"),
            F.count_if(F.col("status") == "SUCCESS").alias("good"),
        ).filter("failed = 0 AND good > 0 AND batch_id IS NOT NULL").select("batch_id")
    else:
        raise ValueError(f"unknown promotion rule {rule!r}")
    if rule == "run_if_clean":
        return candidates
    return candidates.join(F.broadcast(last)).filter("batch_id > last").select("batch_id")


def open_gate(gate: DataFrame, batches: DataFrame, execution_id: str, completed_ts: Column | None = None) -> DataFrame:
    """Register batch ids once; an id already there stays as it is."""
    rows = batches.select(
        "batch_id",
        (F.current_timestamp() if completed_ts is None else completed_ts).alias("completed_ts"),
        F.lit(execution_id).alias("execution_id"),
    )
    return insert_if_absent(gate, rows, ["batch_id"])


def run_detail(results: DataFrame, execution_id: str | Column, created_ts: Column) -> DataFrame:
    """Audit rows from per-table results; a skipped table names no batch, times give the duration."""
    return results.select(
        (execution_id if isinstance(execution_id, Column) else F.lit(execution_id)).alias("execution_id"),
        F.col("tenant_id").cast("int").alias("tenant_id"),
        "schema_name",
        "source_table",
        F.when(F.col("status") != "SKIPPED", F.col("batch_id")).cast("bigint").alias("batch_id"),
        "status",
        F.coalesce(F.col("inserted_rows"), F.lit(0)).cast("bigint").alias("inserted_rows"),
        "error_message",
        "start_ts",
        "end_ts",
        (F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")).alias("duration_secs"),
        created_ts.alias("created_ts"),
    )


def table_status(detail: DataFrame) -> DataFrame:
    """One status per run and table: worst of its batches, where some good and some bad is partial."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    counts = detail.groupBy("execution_id", "tenant_id", "schema_name", "source_table").agg(
        n("SUCCESS").alias("good"), n("FAILED").alias("bad"), n("FATAL").alias("fatal")
    )
    status = (
        F.when(F.col("fatal") > 0, "FATAL")
        .when((F.col("good") > 0) & (F.col("bad") > 0), "PARTIAL_SUCCESS")
        .when(F.col("bad") > 0, "FAILED")
        .when(F.col("good") > 0, "SUCCESS")
        .otherwise("SKIPPED")
    )
    return counts.select(
        "execution_id", "tenant_id", "schema_name", "source_table", status.alias("status")
    )


def run_summary(detail: DataFrame, pipeline_version: str, created_ts: Column) -> DataFrame:
    """Run header from its detail rows: one row per execution.

    Counts per table come from the worst status of its rows, counts per batch from the rows themselves.
    """
    by_table = table_status(detail).groupBy("execution_id").agg(
        F.count(F.lit(1)).cast("int").alias("total_tables"),
        F.count_if(F.col("status") == "SUCCESS").cast("int").alias("successful_tables"),
        F.count_if(F.col("status").isin("FAILED", "FATAL", "PARTIAL_SUCCESS")).cast("int").alias("failed_tables"),
        F.count_if(F.col("status") == "SKIPPED").cast("int").alias("skipped_tables"),
    )
    bad = F.col("status").isin("FAILED", "FATAL")
    per_tenant = detail.groupBy("execution_id", "tenant_id").agg(
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.count_if(F.col("status") == "SUCCESS").alias("good"),
        F.count_if(bad).alias("bad"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
        F.sum("inserted_rows").alias("inserted"),
    )
    by_row = per_tenant.groupBy("execution_id").agg(
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.count("tenant_id").cast("int").alias("total_tenants"),
        F.sum("good").cast("int").alias("successful_batches"),
        F.sum("bad").cast("int").alias("failed_batches"),
        F.sum("skipped").cast("int").alias("skipped_batches"),
        F.sum("inserted").alias("total_inserted_rows"),
    )
    seconds = F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")
    return by_row.join(by_table, "execution_id").select(
        "execution_id",
        "start_ts",
        "end_ts",
        seconds.alias("duration_secs"),
        F.round(seconds / F.lit(60.0), 2).cast("decimal(18,2)").alias("duration_mins"),
        "total_tables",
        "total_tenants",
        "successful_tables",
        "failed_tables",
        "skipped_tables",
        "successful_batches",
        "failed_batches",
        "skipped_batches",
        F.col("successful_tables").alias("watermark_updates"),
        "total_inserted_rows",
        F.when(F.col("failed_tables") > 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit(pipeline_version).alias("pipeline_version"),
        created_ts.alias("created_ts"),
    )


def status_counts(detail: DataFrame, by: tuple[str, ...] = ("schema_name", "status", "error_message")) -> DataFrame:
    return detail.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"))


def report_totals(report: DataFrame, rows: str, bad: str = "ERROR") -> DataFrame:
    """Totals over a per-table report."""
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows"),
        F.count_if(F.col("status") == bad).alias("errors"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
    )


def latest_execution(headers: DataFrame, n: int = 1) -> DataFrame:
    """The newest runs. Plans as a top-n per task followed by one small merge."""
    return headers.orderBy(F.col("start_ts").desc(), F.col("execution_id").desc()).limit(n)


def resolve_batch(given: int | None, detail: DataFrame, tenant_id: int) -> DataFrame:
    """The batch to work on, as one row: the given id, else the tenant's newest."""
    newest = detail.filter(F.col("tenant_id") == tenant_id).agg(F.max("batch_id").alias("batch_id"))
    return newest if given is None else newest.select(F.lit(given).cast("bigint").alias("batch_id"))
