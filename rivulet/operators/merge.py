"""Table changes as state in, state out.

``merge_state`` is the one core; the named operators below are calls to it. The plan is

    kept and updated rows   target LEFT JOIN source
    inserted rows           source ANTI JOIN (target keys SEMI JOIN source keys)

so the large target is never shuffled while the source is below Spark's broadcast threshold, and the
second pass over the target reads only its key columns. Past the threshold both joins are sort-merge
joins with the target on the left, which adaptive execution can split when a key is hot (a full outer
join could be neither broadcast nor split).

The source is read by three branches, so it is settled first, and a source with two rows for one key is
refused in the same job. Callers that have done either say so.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.keys import fold, same_key
from rivulet.model import CREATE_ONCE_COLUMNS
from rivulet.operators.dedupe import drop_duplicate_keys, require_unique, settle_unique
from rivulet.session import settle

_HIT = "_s_hit"


def _keyed(df: DataFrame, keys: list[str], tag: str, fold_case: bool) -> list[Column]:
    return [(fold(df, k) if fold_case else F.col(f"`{k}`")).alias(f"_{tag}k{i}") for i, k in enumerate(keys)]


def merge_state(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    update: Iterable[str] | None = None,
    insert: Iterable[str] | None = None,
    delete_when: Column | None = None,
    update_when: Column | None = None,
    insert_when: Column | None = None,
    delete_unmatched: Column | None = None,
    scope: Column | None = None,
    carried: str | None = None,
    null_safe: bool = True,
    fold_case: bool = True,
    keep_when_null: Iterable[str] = (),
    settled: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The target after applying ``source``; its columns and their order are the target's.

    ``update`` / ``insert`` name the source columns written on match / no match (default: all shared).
    ``delete_when``, ``update_when`` and ``insert_when`` are conditions on source columns,
    ``delete_unmatched`` and ``scope`` conditions on target columns. Rows outside ``scope`` pass
    through without a join. ``carried`` names a source column listing, in lower case, the columns each
    row really brings; others keep the target's value. Columns of ``keep_when_null`` (lower case) keep the
    target's value where the source has none. ``settled`` says that the source is a written table,
    ``unique`` that it has one row per key.
    """
    if not settled and unique:
        source = settle(source, "merge-source")
    elif not settled:
        source = settle_unique(source, keys, "merge-source", null_safe=null_safe, fold_case=fold_case)
    elif not unique:
        require_unique(source, keys, null_safe=null_safe, fold_case=fold_case)
    keep_when_null = set(keep_when_null)
    shared = [c for c in target.columns if c in set(source.columns)]
    update = [c for c in (shared if update is None else update) if c in shared]
    insert = {c for c in (shared if insert is None else insert) if c in shared}

    outside = None
    if scope is not None:
        inside = F.coalesce(scope, F.lit(False))
        outside, target = target.filter(~inside), target.filter(inside)

    names = [f"_tk{i}" for i in range(len(keys))]
    others = [f"_sk{i}" for i in range(len(keys))]
    match = same_key([F.col(n) for n in names], [F.col(n) for n in others], null_safe)

    flags = {
        "_s_delete": delete_when if delete_when is not None else F.lit(False),
        "_s_update": update_when if update_when is not None else F.lit(True),
        "_s_insert": insert_when if insert_when is not None else F.lit(True),
    }
    right = source.select(
        *_keyed(source, keys, "s", fold_case),
        *[F.col(f"`{c}`").alias(f"_s_{i}") for i, c in enumerate(shared)],
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()],
        *([F.col(f"`{carried}`").alias("_s_carried")] if carried else []),
        F.lit(True).alias(_HIT),
    )
    place = {c: f"_s_{i}" for i, c in enumerate(shared)}

    left = target.select("*", *_keyed(target, keys, "t", fold_case))
    joined = left.join(right, match, "left")
    drop = F.col(_HIT).isNotNull() & F.col("_s_delete")
    if delete_unmatched is not None:
        drop = drop | (F.col(_HIT).isNull() & F.coalesce(delete_unmatched, F.lit(False)))

    def kept(name: str) -> Column:
        old = F.col(f"`{name}`")
        if name not in update:
            return old
        takes = F.col(_HIT).isNotNull() & F.col("_s_update")
        if carried:
            takes = takes & F.array_contains("_s_carried", name.lower())
        new = F.col(place[name])
        if name.lower() in keep_when_null:
            new = F.coalesce(new, old)
        return F.when(takes, new).otherwise(old).alias(name)

    state = joined.filter(~drop).select(*[kept(c) for c in target.columns])

    known = target.select(*_keyed(target, keys, "t", fold_case)).join(
        right.select(*others), match, "left_semi"
    )
    fresh = right.filter("_s_insert AND NOT _s_delete").join(known.distinct(), match, "left_anti")
    added = fresh.select(
        *[
            (F.col(place[c]) if c in insert else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    result = state.unionByName(added)
    return result if outside is None else outside.unionByName(result)


def cdc_apply(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    write_columns: Iterable[str] | None = None,
    create_once: Iterable[str] = CREATE_ONCE_COLUMNS,
    op: str = "_op",
    carried: str | None = None,
    guard_log_position: str | None = None,
    scope: Column | None = None,
    **options,
) -> DataFrame:
    """Apply one surviving change per key: delete on ``d``, otherwise update or insert.

    Create-once columns are written on insert only. With ``guard_log_position`` a change is ignored
    when the stored row already carries a higher position, so a replay cannot go back in time.
    """
    once = {c.lower() for c in create_once}
    columns = list(source.columns if write_columns is None else write_columns)
    gone = F.col(f"`{op}`") == "d"
    if guard_log_position:
        source = _drop_stale(target, source, keys, guard_log_position)
        options["settled"] = False
    return merge_state(
        target,
        source,
        keys,
        update=[c for c in columns if c.lower() not in once],
        insert=columns,
        delete_when=gone,
        carried=carried,
        scope=scope,
        **options,
    )


def _drop_stale(target: DataFrame, source: DataFrame, keys: list[str], position: str) -> DataFrame:
    newer = target.select(*_keyed(target, keys, "t", True), F.col(f"`{position}`").alias("_tpos"))
    match = same_key(
        [fold(source, k) for k in keys], [F.col(f"_tk{i}") for i in range(len(keys))]
    ) & (F.col("_tpos") > F.col(f"`{position}`"))
    return source.join(newer, match, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], **options) -> DataFrame:
    """Update every shared column of matched rows, insert the rest."""
    return merge_state(target, source, keys, **options)


def full_sync(target: DataFrame, source: DataFrame, keys: list[str], tenant_id: int, **options) -> DataFrame:
    """Make one tenant's rows equal the source: update, insert, and delete what the source lacks."""
    mine = F.col("tenant_id") == tenant_id
    return merge_state(target, source, keys, scope=mine, delete_unmatched=F.lit(True), **options)


def fill(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], **options) -> DataFrame:
    """Set only ``columns`` on rows the source knows; insert nothing."""
    return merge_state(target, source, keys, update=columns, insert_when=F.lit(False), **options)


def delete_matched(target: DataFrame, doomed: DataFrame, keys: list[str], scope: Column | None = None) -> DataFrame:
    """Drop target rows whose key is listed; rows outside ``scope`` are safe."""
    listed = doomed.select(*_keyed(doomed, keys, "s", True)).distinct()
    match = same_key(
        [fold(target, k) for k in keys], [F.col(f"_sk{i}") for i in range(len(keys))]
    )
    if scope is not None:
        match = match & scope
    return target.join(listed, match, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose key the target does not hold; change nothing else."""
    fresh = drop_duplicate_keys(source, keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def replace_slice(target: DataFrame, source: DataFrame, slice_of: Column) -> DataFrame:
    """Swap the rows in one slice for the source's; the other rows are only filtered, never joined."""
    return target.filter(~F.coalesce(slice_of, F.lit(False))).unionByName(
        source.select(*target.columns)
    )


def replay_batch(
    target: DataFrame,
    source: DataFrame,
    keys: list[str] | None,
    tenant_id: int,
    first_batch: int,
    last_batch: int,
    **options,
) -> DataFrame:
    """Remove what the replayed batches left behind, then load them again, in one plan."""
    if tenant_id is None:
        raise ValueError("a replay needs the tenant whose batches it replaces")
    old = (F.col("tenant_id") == tenant_id) & F.col("batch_id").between(first_batch, last_batch)
    cleared = target.filter(~F.coalesce(old, F.lit(False)))
    if not keys:
        return cleared.unionByName(source.select(*target.columns))
    return upsert(cleared, source, keys, scope=F.col("tenant_id") == tenant_id, **options)


def acknowledge(
    stage: DataFrame, processed: DataFrame, claimed: Column
) -> DataFrame:
    """Stage rows left after a run: claimed rows of processed tables go, everything else stays.

    ``processed`` holds ``(schema_name, source_table)`` of tables that ended SUCCESS or FAILED.
    """
    done = processed.select(
        F.lower(F.trim("schema_name")).alias("_schema"), F.lower("source_table").alias("_table")
    ).distinct()
    match = (
        (F.lower(F.trim(F.col("source_schema"))) == F.col("_schema"))
        & (F.lower(F.col("source_table")) == F.col("_table"))
        & claimed
    )
    return stage.join(done, match, "left_anti")


def watermark_upsert(
    marks: DataFrame, updates: DataFrame, monotonic: bool = True,
    keys: tuple[str, ...] = ("tenant_id", "schema_name", "source_table"),
) -> DataFrame:
    """Set the last batch per table. A monotonic mark never moves back, so a replay cannot hide data."""
    keys = list(keys)
    if monotonic:
        held = marks.select(*keys, F.col("last_batch_id").alias("_held"))
        updates = updates.join(held, keys, "left").select(
            *[
                F.greatest("last_batch_id", "_held").alias(c) if c == "last_batch_id" else F.col(c)
                for c in updates.columns
            ]
        )
    return merge_state(marks, updates, keys)


def cursor_upsert(cursors: DataFrame, updates: DataFrame) -> DataFrame:
    """Set last sequence and batch per staged table."""
    return merge_state(cursors, updates, ["tenant_id", "source_schema", "source_table"])
