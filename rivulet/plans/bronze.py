"""Roads into bronze other than the stream: landing load, full reload, full replacement, audit fill,
ghost sweep. Each returns the new table state, some with a report; no table is written here."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.keys import canonical_keys
from rivulet.model import align_schema
from rivulet.operators import ghosts, merge, payload
from rivulet.operators.dedupe import drop_duplicate_keys
from rivulet.session import settle
from rivulet.sources import landing
from rivulet.sources.source_db import SourceReader, read_near


@dataclass
class Change:
    """A table's next content, with what was done to get there."""

    state: DataFrame
    report: DataFrame


def landing_rows(
    rows: DataFrame, columns: list[str], keys: list[str], *, run_id: str, as_of: Column,
    gaps: Mapping[str, Iterable[landing.Batch]] | None = None,
) -> DataFrame:
    """Landing batches as rows to merge: stamped, cut to the target's columns, the newest batch of each key."""
    stamped = payload.stamp_meta(rows, batch_id=F.col("batch_id"), run_id=run_id, as_of=as_of, op="I")
    return landing.newest_per_key(payload.shared_columns(stamped, columns), ["tenant_id", *keys], gaps)


def landing_load(
    target: DataFrame, rows: DataFrame, keys: list[str] | None, *, run_id: str, as_of: Column,
    replay: tuple[int, int] | None = None, tenant_id: int | None = None,
    gaps: Mapping[str, Iterable[landing.Batch]] | None = None,
) -> DataFrame:
    """Load every pending landing batch in one plan.

    The newest batch of each key wins, which equals merging the batches one after the other. Keyless
    tables append. A replay first removes what the replayed batches had left behind. ``gaps`` names
    columns that came or went between batches.
    """
    if not keys:
        stamped = payload.stamp_meta(rows, batch_id=F.col("batch_id"), run_id=run_id, as_of=as_of, op="I")
        every = align_schema(stamped, target.schema)
        return merge.replay_batch(target, every, None, tenant_id, *replay) if replay else target.unionByName(every)
    merge_keys = ["tenant_id", *keys]
    newest = landing_rows(rows, target.columns, keys, run_id=run_id, as_of=as_of, gaps=gaps)
    carried = landing.CARRIED if gaps else None
    if replay:
        return merge.replay_batch(target, newest, merge_keys, tenant_id, *replay, carried=carried, unique=True)
    scope = None if tenant_id is None else F.col("tenant_id") == tenant_id
    return merge.upsert(target, newest, merge_keys, carried=carried, scope=scope, unique=True)


def reload_rows(
    source: DataFrame, columns: list[str], keys: list[str], *, tenant_id: int, batch_id: int, run_id: str, as_of: Column
) -> DataFrame:
    """A whole source table as rows to merge: stamped, cut to the target's columns, one per canonical key."""
    stamped = payload.stamp_meta(
        source, batch_id=batch_id, run_id=run_id, as_of=as_of, op="r", tenant_id=tenant_id
    )
    merge_keys = ["tenant_id", *keys]
    lost = payload.missing_keys(merge_keys, stamped.columns)
    if lost:
        raise ValueError(f"key columns missing: {lost}")
    # keys are canonical from here on, as on every road
    return drop_duplicate_keys(canonical_keys(payload.shared_columns(stamped, columns), merge_keys), merge_keys)


def full_reload(
    target: DataFrame, source: DataFrame, keys: list[str], *, tenant_id: int, batch_id: int, run_id: str,
    as_of: Column, overwrite_tenant: bool = False,
) -> DataFrame:
    """Reload a whole source table: upsert by key, or swap the tenant's slice for a first load."""
    once = reload_rows(source, target.columns, keys, tenant_id=tenant_id, batch_id=batch_id, run_id=run_id, as_of=as_of)
    mine = F.col("tenant_id") == tenant_id
    if overwrite_tenant:
        return merge.replace_slice(target, align_schema(once, target.schema), mine)
    return merge.upsert(target, once, ["tenant_id", *keys], scope=mine, unique=True)


def replacement_rows(
    source: DataFrame, columns: list[str], keys: list[str], *, tenant_id: int, batch_id: int, as_of: Column
) -> tuple[DataFrame, bool]:
    """The rows that are to be a tenant's whole slice, and whether they have a usable key."""
    stamped = source.withColumns(
        {
            "tenant_id": F.lit(tenant_id).cast("int"),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "_ingest_date": as_of.cast("date"),
            "ingestion_time": as_of,
        }
    )
    shaped = payload.shared_columns(stamped, columns)
    if not keys or payload.missing_keys(keys, shaped.columns):
        return shaped, False
    merge_keys = ["tenant_id", *keys]
    return drop_duplicate_keys(canonical_keys(shaped, merge_keys), merge_keys), True


def full_replacement(
    target: DataFrame, source: DataFrame, keys: list[str], *, tenant_id: int, batch_id: int, run_id: str,
    as_of: Column,
) -> tuple[DataFrame, str]:
    """For tables with nothing to track: sync by key, or swap the slice when there is no usable key."""
    rows, keyed = replacement_rows(source, target.columns, keys, tenant_id=tenant_id, batch_id=batch_id, as_of=as_of)
    if keyed:
        return merge.full_sync(target, rows, ["tenant_id", *keys], tenant_id, unique=True), "merge_sync"
    mine = F.col("tenant_id") == tenant_id
    return merge.replace_slice(target, align_schema(rows, target.schema), mine), "overwrite_tenant"


def fill_rows(
    target: DataFrame, source: DataFrame | tuple[SourceReader, str], keys: list[str], wanted: list[str], *, tenant_id: int,
    batch_id: int, ranges: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """``(keys with a hole, source rows for them)`` of one batch, both settled.

    The holes are joined to the source by key, so no key list passes through the driver. Of a source given as
    ``(reader, table)`` only key ranges around the holes are read.
    """
    holes = payload.hole_candidates(target, keys, wanted, batch_id=batch_id, tenant_id=tenant_id)
    holes = settle(canonical_keys(holes, keys), "holes")
    if isinstance(source, tuple):
        source = read_near(*source, holes, keys, [*keys, *wanted], ranges)
    found = (
        canonical_keys(source.select(*keys, *wanted), keys)
        .join(holes, keys, "left_semi")
        .withColumn("tenant_id", F.lit(tenant_id).cast("int"))
    )
    return holes, settle(drop_duplicate_keys(found, ["tenant_id", *keys]), "found")


def interim_fill(
    target: DataFrame, source: DataFrame | tuple[SourceReader, str], keys: list[str], wanted: list[str], *, tenant_id: int,
    batch_id: int, ranges: int = 32,
) -> Change:
    """Fill columns the capture does not carry, for rows of a batch that still have a hole.

    See :func:`fill_rows`. The report counts candidates and the rows really found at the source.
    """
    merge_keys = ["tenant_id", *keys]
    holes, found = fill_rows(target, source, keys, wanted, tenant_id=tenant_id, batch_id=batch_id, ranges=ranges)
    mine = F.col("tenant_id") == tenant_id
    state = merge.fill(target, found, merge_keys, wanted, scope=mine, settled=True, unique=True)
    counts = holes.agg(F.count(F.lit(1)).alias("candidate_rows")).join(
        F.broadcast(found.agg(F.count(F.lit(1)).alias("filled_rows")))
    )
    return Change(state, counts.withColumn("cols_filled", F.lit(",".join(wanted))))


@dataclass
class Sweep:
    """What a sweep found: the keys to delete, their log, and one report row."""

    doomed: DataFrame
    log: DataFrame
    report: DataFrame


def find_ghosts(
    target: DataFrame, source_keys: DataFrame, keys: list[str], *, tenant_id: int, batch_id: int,
    schema_name: str, source_table: str, bronze_table: str, as_of: Column, max_pct: float = 10.0,
    dry_run: bool = False, buckets: int | None = None,
) -> Sweep:
    """Ghost keys of one tenant of one table, found once and settled, as counts, log and delete all need them.

    The decision joins back as a one-row frame: when the fuse blows or the run is dry, no ghost is doomed. With
    ``buckets`` keys are compared only where checksums of that many key buckets differ; it pays for tables that are much
    larger than what differs.
    """
    mine = target.filter(F.col("tenant_id") == tenant_id)
    narrow = mine.select("tenant_id", *keys, "batch_id")
    gone = (
        ghosts.detect(narrow, source_keys, keys, batch_id) if buckets is None
        else ghosts.detect_by_sums(narrow, source_keys, keys, batch_id, buckets)
    )
    found = settle(ghosts.race_guard(gone, source_keys, keys), "ghosts")
    counts = mine.agg(F.count(F.lit(1)).alias("bronze_rows")).join(
        F.broadcast(found.agg(F.count(F.lit(1)).alias("ghost_rows")))
    ).withColumn("tenant_id", F.lit(tenant_id).cast("int"))
    decided = ghosts.fuse(counts, max_pct, dry_run)
    doomed = found.join(
        F.broadcast(decided.filter("status = 'DELETED'").select("tenant_id")), "tenant_id", "left_semi"
    )
    log = ghosts.doomed_keys(
        doomed, keys, schema_name=schema_name, source_table=source_table, batch_id=batch_id, deleted_ts=as_of
    )
    rows = ghosts.report(
        decided, schema_name=schema_name, source_table=source_table, bronze_table=bronze_table,
        batch_id=batch_id, dry_run=dry_run, max_pct=max_pct, run_ts=as_of,
    )
    return Sweep(doomed, log, rows)


def ghost_sweep(
    target: DataFrame, source_keys: DataFrame, keys: list[str], *, tenant_id: int, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(new state, doomed key log, report)`` for one tenant of one table; see :func:`find_ghosts`."""
    found = find_ghosts(target, source_keys, keys, tenant_id=tenant_id, **options)
    state = merge.delete_matched(target, found.doomed, ["tenant_id", *keys], F.col("tenant_id") == tenant_id)
    return state, found.log, found.report
