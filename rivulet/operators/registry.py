"""The table registry and what can be read off it: scope, keys, road of each table, columns to carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet import model


def key_list(csv: Column) -> Column:
    """``"a, b"`` as an array of trimmed names; empty names are dropped, a missing list is empty."""
    parts = F.transform(F.split(F.coalesce(csv, F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def active_registry(registry: DataFrame, schemas: str = "*") -> DataFrame:
    """Active tables in scope that can be merged: a target name and at least one key column."""
    return (
        in_schemas(registry.filter("is_active"), schemas)
        .withColumn("pk", key_list(F.col("pk_columns")))
        .filter(F.col("bronze_table").isNotNull() & (F.size("pk") > 0))
    )


def in_schemas(df: DataFrame, schemas: str, column: str = "source_schema") -> DataFrame:
    """Keep rows of the schemas in a comma list, any case; ``*`` keeps all."""
    if schemas.strip() == "*":
        return df
    wanted = sorted({s.strip().lower() for s in schemas.split(",") if s.strip()})
    return df.filter(F.lower(F.trim(F.col(column))).isin(wanted))


def in_tables(df: DataFrame, tables: str, column: str = "source_table") -> DataFrame:
    """Keep exactly the named tables, any case."""
    wanted = sorted({t.strip().lower() for t in tables.split(",") if t.strip()})
    return df.filter(F.lower(F.col(column)).isin(wanted))


def source_tables(columns: DataFrame) -> DataFrame:
    """Per source table: does it carry a column by which changes can be followed."""
    tracks = F.lower("column_name").isin(sorted(model.TRACKING_COLUMNS))
    return columns.groupBy("table_schema", "table_name").agg(
        F.max(tracks).alias("trackable"), F.count(F.lit(1)).alias("n_columns")
    )


def trackable_tables(columns: DataFrame) -> DataFrame:
    return source_tables(columns).filter("trackable").select("table_schema", "table_name")


def is_blob(data_type: Column, char_len: Column) -> Column:
    kind = F.lower(F.coalesce(data_type, F.lit("")))
    unbounded = kind.isin(sorted(model.UNBOUNDED_TYPES)) & F.coalesce(char_len == -1, F.lit(False))
    return kind.isin(sorted(model.BLOB_TYPES)) | unbounded


def carried_columns(columns: DataFrame) -> DataFrame:
    """Source columns narrow enough to read."""
    return columns.filter(~is_blob(F.col("data_type"), F.col("char_len")))


def missing_columns(captured: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns a capture lacks, wide ones left out, as one list per table.

    ``captured`` holds ``(table_schema, table_name, column_name)`` of what the capture brings.
    """
    keys = ["table_schema", "table_name", F.lower("column_name").alias("_column")]
    lacking = (
        columns.filter(~F.lower("data_type").isin(sorted(model.BLOB_TYPES)))
        .withColumn("_column", F.lower("column_name"))
        .join(captured.select(*keys).distinct(), ["table_schema", "table_name", "_column"], "left_anti")
    )
    return lacking.groupBy("table_schema", "table_name").agg(
        F.sort_array(F.collect_set("column_name")).alias("columns")
    )


def classify_roads(
    registry: DataFrame, columns: DataFrame, stream_schemas: Column | list[str], tables: str | None = None
) -> DataFrame:
    """Which road feeds each active table.

    ``explicit``: named by the caller, all other rules off. ``stream``: its schema is captured.
    ``no_pk``: cannot be merged. ``timestamp``: has a column to follow. ``full_load``: everything else.
    A table the source does not list is ``absent``.
    """
    seen = source_tables(columns).select(
        F.col("table_schema").alias("source_schema"), F.col("table_name").alias("source_table"), "trackable"
    )
    active = registry.filter("is_active")
    if tables:
        return in_tables(active, tables).select(
            "source_schema", "source_table", "bronze_table", F.lit("explicit").alias("road")
        )
    streamed = F.col("source_schema").isin(stream_schemas)
    road = (
        F.when(streamed, "stream")
        .when(F.size(key_list(F.col("pk_columns"))) == 0, "no_pk")
        .when(F.col("trackable").isNull(), "absent")
        .when(F.col("trackable"), "timestamp")
        .otherwise("full_load")
    )
    return active.join(seen, ["source_schema", "source_table"], "left").select(
        "source_schema", "source_table", "bronze_table", road.alias("road")
    )


def heavier_than_source(registry: DataFrame, reconcile: DataFrame) -> DataFrame:
    """Registry tables that a reconcile report shows with more rows in the target than at the source."""
    flagged = reconcile.filter("diff < 0").select(
        F.col("schema_name").alias("source_schema"), "source_table"
    ).distinct()
    return registry.join(flagged, ["source_schema", "source_table"], "left_semi")


def include_exclude(columns: DataFrame, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """Published columns: those of listed tables, minus the listed columns. Names match in any case."""
    kept = (
        columns.withColumns(
            {
                "_s": F.lower("table_schema"), "_t": F.lower("table_name"), "_c": F.lower("column_name"),
            }
        )
        .join(
            include.select(F.lower("table_schema").alias("_s"), F.lower("table_name").alias("_t")).distinct(),
            ["_s", "_t"], "left_semi",
        )
        .join(
            exclude.select(
                F.lower("table_schema").alias("_s"), F.lower("table_name").alias("_t"),
                F.lower("column_name").alias("_c"),
            ).distinct(),
            ["_s", "_t", "_c"], "left_anti",
        )
    )
    return kept.drop("_s", "_t", "_c")


def touched_tables(detail: DataFrame, registry: DataFrame, batch_id: int | Column, tenant_id: int) -> DataFrame:
    """Tables a batch really wrote to, with their keys and target names."""
    wrote = detail.filter(
        (F.col("tenant_id") == tenant_id)
        & (F.col("batch_id") == batch_id)
        & (F.col("status") == "SUCCESS")
        & (F.col("inserted_rows") > 0)
    )
    return (
        wrote.select(F.col("schema_name").alias("source_schema"), "source_table").distinct()
        .join(registry.filter("is_active"), ["source_schema", "source_table"])
        .select("source_schema", "source_table", "bronze_table", "pk_columns")
    )
