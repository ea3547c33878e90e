"""From a raw message to typed rows: envelope, presence, parsing, stamping, fills, column choice."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import model
from rivulet.functions.temporal import decode_temporals

# Header fields of a change message; __table and __commit_lsn are older spellings.
_HEADER = [
    "__op", "__source_table", "__table", "__source_schema", "__source_db", "__source_ts_ms",
    "__source_commit_lsn", "__commit_lsn",
]


def stage_envelope(
    messages: DataFrame, *, tenant_id: int, default_schema: str, batch_id: int | Column,
    micro_batch_id: int, run_id: str, ingest_ts: Column | None = None,
) -> DataFrame:
    """Routing columns from ``(value, timestamp)`` messages; heartbeats, which name no table, are dropped.

    One generator reads all header fields in a single pass over the text. Unlike a parsed struct it is
    not copied into the filter below, so each message is parsed once. The row image stays raw text. Where
    messages say from which partition and offset of their source they come, rows keep it.
    """
    place = [c for c in model.SOURCE_PLACE if c in messages.columns]
    raw = messages.select(
        F.col("value").cast("string").alias("value_json"), F.col("timestamp").alias("eh_enqueued_ts"), *place
    )
    header = raw.select("*", F.json_tuple("value_json", *_HEADER).alias(*_HEADER))
    return header.select(
        F.lit(tenant_id).cast("int").alias("tenant_id"),
        F.coalesce("__source_schema", F.lit(default_schema)).alias("source_schema"),
        F.coalesce("__source_table", "__table").alias("source_table"),
        F.coalesce("__op", F.lit("u")).alias("op"),
        F.coalesce("__source_commit_lsn", "__commit_lsn").alias("commit_lsn"),
        F.col("__source_db").alias("source_db"),
        F.timestamp_millis(F.col("__source_ts_ms").try_cast("bigint")).alias("source_commit_ts"),
        "eh_enqueued_ts",
        "value_json",
        (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("bigint").alias("batch_id"),
        F.lit(micro_batch_id).cast("bigint").alias("micro_batch_id"),
        (F.current_timestamp() if ingest_ts is None else ingest_ts).alias("ingest_ts"),
        F.lit(run_id).alias("run_id"),
        *place,
    ).filter(F.col("source_table").isNotNull())


def tenant_cross_check(staged: DataFrame, expected_db: str) -> DataFrame:
    """Keep rows that name no database or the expected one, in any case."""
    return staged.filter(
        F.col("source_db").isNull() | (F.lower("source_db") == F.lit(expected_db.lower()))
    )


def _payload_keys(column: str = "value_json") -> Column:
    return F.json_object_keys(column)


def payload_columns(stage: DataFrame, by: Iterable[str] = ("source_schema", "source_table")) -> DataFrame:
    """The distinct payload keys each staged table carries, as ``(schema, table, column_name)``.

    Messages of one table share a few key lists, so whole lists are made distinct first (combined before
    the shuffle) and only those are unfolded. The result is bounded by the number of columns.
    """
    tables = [F.lower(F.trim(F.col(b))).alias(b) for b in by]
    lists = stage.select(*tables, _payload_keys().alias("keys")).distinct()
    return lists.select(*by, F.explode("keys").alias("column_name")).distinct()


def parse_schema(target: T.StructType) -> tuple[T.StructType, dict[str, str]]:
    """Parse types for a target's business columns; times are read as text and decoded later."""
    fields, kinds = [], {}
    for f in target.fields:
        if f.name.lower() in model.META_COLUMNS:
            continue
        kind = f.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz", "date"):
            kinds[f.name] = kind
            fields.append(T.StructField(f.name, T.StringType()))
        else:
            fields.append(f)
    return T.StructType(fields), kinds


def parse_payload(
    stage: DataFrame, target: T.StructType, spellings: Iterable[str] | None = None,
    keep: Iterable[str] = ("tenant_id", "op", "commit_lsn", "stage_seq"), carried: bool = False,
) -> DataFrame:
    """Typed business columns from the raw row image, plus ``keep`` from the envelope.

    ``spellings`` are the keys seen in the payload. JSON fields match by exact case, so a key that
    differs from the column only in case is read under its own spelling. With ``carried`` each row
    also lists its own payload keys in lower case.
    """
    schema, kinds = parse_schema(target)
    seen: dict[str, list[str]] = {}
    for key in sorted(spellings or []):
        seen.setdefault(key.lower(), []).append(key)
    wanted = [
        (f, spelling) for f in schema.fields for spelling in sorted({f.name, *seen.get(f.name.lower(), [])})
    ]
    read_as = T.StructType([T.StructField(spelling, f.dataType) for f, spelling in wanted])
    # a struct cast goes by position; plain names keep spellings of one column apart
    numbered = T.StructType([T.StructField(f"f{n}", f.dataType) for n, (f, _) in enumerate(wanted)])
    places = {f.name: [f"d.f{n}" for n, (g, _) in enumerate(wanted) if g is f] for f in schema.fields}
    rows = stage.select(*keep, F.from_json("value_json", read_as).cast(numbered).alias("d"), "value_json")
    typed = rows.select(
        *keep,
        *[F.coalesce(*[F.col(p) for p in places[f.name]]).alias(f.name) for f in schema.fields],
        *(
            [F.transform(_payload_keys(), lambda k: F.lower(k)).alias("_carried")] if carried else []
        ),
    )
    return decode_temporals(typed, kinds)


def stamp_meta(
    df: DataFrame, *, batch_id: int | Column, run_id: str, as_of: Column | None = None,
    op: Column | str | None = None, tenant_id: int | None = None, log_position: str | None = None,
) -> DataFrame:
    """Engine columns. ``as_of`` pins the run time so that a rerun gives the same rows."""
    now = F.current_timestamp() if as_of is None else as_of
    op = F.coalesce(F.col("op"), F.lit("u")) if op is None else (F.lit(op) if isinstance(op, str) else op)
    stamped = {
        "_op": op,
        "batch_id": (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("bigint"),
        "run_id": F.lit(run_id),
        "_ingest_date": now.cast("date"),
        "ingestion_time": now,
    }
    if tenant_id is not None:
        stamped["tenant_id"] = F.lit(tenant_id).cast("int")
    if log_position:
        stamped["source_log_position"] = F.col(log_position)
    return df.withColumns(stamped)


def fill_audit_times(df: DataFrame, commit_time: str = "source_commit_ts") -> DataFrame:
    """Missing modified/created times take the commit time of the change."""
    if commit_time not in df.columns:
        return df
    have = [c for c in df.columns if c.lower() in model.FILLED_COLUMNS]
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`"), F.col(commit_time).cast(df.schema[c].dataType)) for c in have}
    )


def writable_columns(
    columns: Iterable[str], target: Iterable[str], carried: Iterable[str], filled: bool = True
) -> tuple[list[str], list[str]]:
    """Split a frame's target columns into those to write and those the capture did not bring.

    A column is written when the payload carries it, the engine stamps it, or it is a filled audit time.
    """
    allowed = {c.lower() for c in carried} | model.STAMPED_COLUMNS
    if filled:
        allowed |= model.FILLED_COLUMNS
    in_target = set(target)
    both = [c for c in dict.fromkeys(columns) if c in in_target]
    return [c for c in both if c.lower() in allowed], [c for c in both if c.lower() not in allowed]


def shared_columns(df: DataFrame, target: Iterable[str]) -> DataFrame:
    """Drop columns the target does not have, without regard to case, and take its spelling."""
    names = model.by_lower_name(target)
    return df.select(
        *[F.col(f"`{c}`").alias(names[c.lower()]) for c in df.columns if c.lower() in names]
    )


def missing_keys(keys: Iterable[str], columns: Iterable[str], carried: Iterable[str] | None = None) -> list[str]:
    """Key columns that the frame lacks, or that the capture does not carry: such a table cannot merge."""
    have = {c.lower() for c in (columns if carried is None else carried)}
    return [k for k in keys if k.lower() not in have]


def hole_candidates(
    target: DataFrame, keys: list[str], wanted: list[str], *, batch_id: int | Column, tenant_id: int | None = None
) -> DataFrame:
    """Distinct keys of live rows of a batch with a NULL in any wanted column."""
    holes = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in wanted])
    rows = target.filter((F.col("batch_id") == batch_id) & (F.col("_op") != "d") & holes)
    if tenant_id is not None:
        rows = rows.filter(F.col("tenant_id") == tenant_id)
    return rows.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def uncaptured_keys(registry: DataFrame, present: DataFrame) -> DataFrame:
    """Key columns of staged tables that no message carries: such tables must be parked, not guessed at.

    ``registry`` has a ``pk`` list, ``present`` comes from :func:`payload_columns`.
    """
    names = {"_s": F.lower(F.trim("source_schema")), "_t": F.lower("source_table")}
    staged = present.withColumns(names)
    keys = registry.select("source_schema", "source_table", F.explode("pk").alias("column_name")).withColumns(
        {**names, "_c": F.lower("column_name")}
    )
    return (
        keys.join(staged.select("_s", "_t").distinct(), ["_s", "_t"], "left_semi")
        .join(staged.select("_s", "_t", F.lower("column_name").alias("_c")).distinct(), ["_s", "_t", "_c"], "left_anti")
        .select("source_schema", "source_table", "column_name")
    )
