"""Post-run checks as data: one row per check, with what was measured and a PASS or FAIL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.model import OUT_OF_SCOPE
from rivulet.operators.dedupe import duplicate_keys


def _rows(name: str, measured: DataFrame, passed: Column) -> DataFrame:
    """``measured`` is one row with a ``measured`` column."""
    return measured.select(
        F.lit(name).alias("check"),
        F.col("measured").cast("bigint").alias("measured"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("measured"))


def watermark_advanced(detail: DataFrame, marks: DataFrame, gate: DataFrame) -> DataFrame:
    """The run's highest good batch is held by some watermark and by the gate."""
    top = detail.filter((F.col("status") == "SUCCESS") & F.col("batch_id").isNotNull()).agg(
        F.max("batch_id").alias("top")
    )
    at_mark = marks.join(F.broadcast(top), F.col("last_batch_id") == F.col("top"))
    at_gate = gate.join(F.broadcast(top), F.col("batch_id") == F.col("top"))
    some = F.col("measured") > 0
    return _rows("watermark", _count(at_mark), some).unionByName(_rows("gate", _count(at_gate), some))


def scope_respected(detail: DataFrame, schemas: list[str]) -> DataFrame:
    """No table of a configured schema was skipped as out of scope."""
    wrong = detail.filter(
        (F.col("status") == "SKIPPED")
        & F.col("error_message").contains(OUT_OF_SCOPE)
        & F.col("schema_name").isin(schemas)
    )
    return _rows("scope", _count(wrong), F.col("measured") == 0)


def stage_orphans(stage: DataFrame, detail: DataFrame, tenant_id: int) -> DataFrame:
    """Rows still staged for tables that ended SUCCESS, per table."""
    done = detail.filter("status = 'SUCCESS'").select(
        F.lower("schema_name").alias("_s"), F.lower("source_table").alias("_t")
    ).distinct()
    left = stage.filter(F.col("tenant_id") == tenant_id).withColumns(
        {"_s": F.lower(F.trim("source_schema")), "_t": F.lower("source_table")}
    )
    return left.join(done, ["_s", "_t"], "left_semi").groupBy("source_schema", "source_table").agg(
        F.count(F.lit(1)).alias("orphaned_rows")
    )


def unregistered_stage(stage: DataFrame, registry: DataFrame, tenant_id: int) -> DataFrame:
    """Rows staged for tables that no active registry entry names, per table."""
    known = registry.filter("is_active").select(
        F.lower("source_schema").alias("_s"), F.lower("source_table").alias("_t")
    ).distinct()
    rows = stage.filter(F.col("tenant_id") == tenant_id).withColumns(
        {"_s": F.lower(F.trim("source_schema")), "_t": F.lower("source_table")}
    )
    return rows.join(known, ["_s", "_t"], "left_anti").groupBy("source_schema", "source_table").agg(
        F.count(F.lit(1)).alias("rows")
    )


def ops_outcome(target: DataFrame) -> DataFrame:
    return target.groupBy("_op").agg(
        F.count(F.lit(1)).alias("cnt"), F.max("_ingest_date").alias("latest_ingest")
    )


def no_duplicate_keys(target: DataFrame, keys: list[str]) -> DataFrame:
    return _rows("duplicate_keys", _count(duplicate_keys(target, keys)), F.col("measured") == 0)


def unregistered_kept(before: DataFrame, after: DataFrame, registry: DataFrame, tenant_id: int) -> DataFrame:
    """A run takes no staged row of a table that is not registered; ``measured`` counts those it took."""
    tables = ["source_schema", "source_table"]
    had = unregistered_stage(before, registry, tenant_id)
    has = unregistered_stage(after, registry, tenant_id).withColumnRenamed("rows", "left")
    lost = had.join(has, tables, "left").agg(
        F.coalesce(F.sum(F.greatest(F.col("rows") - F.coalesce("left", F.lit(0)), F.lit(0))), F.lit(0)).alias("measured")
    )
    return _rows("unregistered_kept", lost, F.col("measured") == 0)


def audit_complete(headers: DataFrame, detail: DataFrame) -> DataFrame:
    """Per run: the header's table count equals the tables its detail rows name."""
    per_table = detail.select("execution_id", "tenant_id", "schema_name", "source_table").distinct()
    counted = per_table.groupBy("execution_id").agg(F.count(F.lit(1)).alias("detail_tables"))
    return headers.join(counted, "execution_id", "left").select(
        "execution_id",
        F.col("total_tables").cast("bigint").alias("header_tables"),
        F.coalesce("detail_tables", F.lit(0)).alias("detail_tables"),
        F.when(F.col("total_tables") == F.coalesce("detail_tables", F.lit(0)), "PASS")
        .otherwise("FAIL")
        .alias("status"),
    )


def cursor_matches(cursors: DataFrame, marks: DataFrame) -> DataFrame:
    """Cursor and watermark hold the same highest batch."""
    c = cursors.agg(F.max("last_batch_id").alias("cursor_batch"))
    m = marks.agg(F.max("last_batch_id").alias("watermark_batch"))
    return c.join(F.broadcast(m)).select(
        F.lit("cursor").alias("check"),
        "cursor_batch",
        "watermark_batch",
        F.when(F.col("cursor_batch").eqNullSafe(F.col("watermark_batch")), "PASS").otherwise("FAIL").alias("status"),
    )


def depths(stage: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """Row counts of stage and dead letters; an empty stage means the next run has nothing to do."""
    empty = F.col("measured") == 0

    def depth(name: str, df: DataFrame, none: str) -> DataFrame:
        return _count(df).select(
            F.lit(name).alias("check"),
            "measured",
            F.when(empty, none).otherwise("ROWS").alias("status"),
        )

    return depth("stage", stage, "EMPTY").unionByName(depth("dead_letter", dead_letters, "CLEAR"))


def modified_time_present(target: DataFrame, column: str = "ModifiedOn") -> DataFrame:
    """Created and updated rows all carry a modified time."""
    holes = target.filter(F.col(column).isNull() & F.col("_op").isin("c", "u"))
    return _rows("temporal", _count(holes), F.col("measured") == 0)


def all_checks(
    *, detail: DataFrame, headers: DataFrame, marks: DataFrame, gate: DataFrame, cursors: DataFrame,
    stage: DataFrame, registry: DataFrame, targets: dict[str, tuple[DataFrame, list[str]]],
    schemas: list[str], tenant_id: int, stage_before: DataFrame,
) -> DataFrame:
    """Every check of one run folded into ``(check, measured, status)``.

    ``stage_before`` is the stage as the run found it: rows of unregistered tables must all still be there.
    """
    audit = audit_complete(headers, detail).filter("status = 'FAIL'")
    cursor = cursor_matches(cursors, marks)
    parts = [
        watermark_advanced(detail, marks, gate),
        scope_respected(detail, schemas),
        _rows("stage_cleaned", _count(stage_orphans(stage, detail, tenant_id)), F.col("measured") == 0),
        _rows("audit", _count(audit), F.col("measured") == 0),
        cursor.select("check", F.col("cursor_batch").alias("measured"), "status"),
        unregistered_kept(stage_before, stage, registry, tenant_id),
    ]
    for name, (state, keys) in targets.items():
        parts.append(no_duplicate_keys(state, keys).withColumn("check", F.lit(f"duplicate_keys {name}")))
        if "ModifiedOn" in state.columns:
            parts.append(modified_time_present(state).withColumn("check", F.lit(f"temporal {name}")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
