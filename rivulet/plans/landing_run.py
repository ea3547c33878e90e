"""A whole landing run: pending batches, load of every table, audit per batch, marks and gate."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet import model
from rivulet.model import by_lower_name
from rivulet.operators import control, merge, payload, registry as reg
from rivulet.operators.merge import watermark_upsert
from rivulet.plans.bronze import landing_load, landing_rows
from rivulet.session import settle
from rivulet.sources import landing
from rivulet.sources.buckets import BucketStore, StoreFailed
from rivulet.sources.control_store import ControlStore

RESULT = (
    "tenant_id int, schema_name string, source_table string, batch_id bigint, status string, inserted_rows bigint, "
    "deleted_rows bigint, error_message string, start_ts timestamp, end_ts timestamp"
)


@dataclass
class LandingRun:
    """What a run produced. ``states`` holds the new content of every table it loaded."""

    results: DataFrame
    watermarks: DataFrame
    gate: DataFrame
    states: dict[tuple[str, str], DataFrame] = field(default_factory=dict)


def run_landing(
    base: str, registry: DataFrame, target_of: Callable[[str], DataFrame | None] | BucketStore,
    marks: DataFrame | None = None, gate: DataFrame | None = None, *,
    run_id: str, as_of: Column, schemas: str = "*", replay: tuple[int, int] | None = None, dry_run: bool = False,
    store: Callable[[tuple[str, str], DataFrame], None] | None = None, workers: int = 8, found: DataFrame | None = None,
    kept: ControlStore | None = None, add_columns: bool = False,
) -> LandingRun:
    """Load what the landing tree holds beyond the marks (or, for a replay, a range of batches).

    A table's pending batches load in one plan, whatever columns and types they brought; results name every batch with
    its rows. A table that is out of scope or not in the registry is SKIPPED, one whose load fails is FAILED, one whose
    write fails FATAL, all with the whole reason, and its mark stays. A dry run counts and loads nothing. The loop
    runs over tables and folders, never over rows.

    A :class:`BucketStore` as ``target_of`` swaps only touched folders and widens its tables as batches need it
    (``add_columns``: by new columns too). ``found`` has the batches there are, as a :class:`LandingWatch` finds them; without
    it the tree is listed. ``kept`` gives marks and gate, and takes detail, header, marks and gate of the run under its id.
    """
    spark = registry.sparkSession
    tables = target_of if isinstance(target_of, BucketStore) else None
    if kept is not None:
        marks, gate = kept.marks(besides=run_id), kept.gate(besides=run_id)
    found = landing.landing_batches(spark, base) if found is None else found.select(*landing.PARTS).distinct()
    todo = settle(landing.replay_range(found, *replay) if replay else landing.pending_batches(found, marks), "pending")
    pending: dict[tuple[str, str], list] = {}
    for r in todo.collect():  # a row per landing folder
        pending.setdefault((r["schema_name"], r["table_name"]), []).append(r)
    known = {
        (r["source_schema"].strip().lower(), r["source_table"].lower()): r for r in reg.active_registry(registry, "*").collect()
    }
    wanted = {s.strip().lower() for s in schemas.split(",")}
    states: dict[tuple[str, str], DataFrame] = {}

    def reason(schema: str, table: str) -> str | None:
        if "*" not in wanted and schema.strip().lower() not in wanted:
            return f"schema {schema} {model.OUT_OF_SCOPE}"
        return None if (schema.strip().lower(), table.lower()) in known else "not in the registry"

    def load(key: tuple[str, str], batches: list, counts: dict) -> None:
        """Rows by tenant and batch go into ``counts``, the table's new state into ``states``."""
        entry = known[key[0].strip().lower(), key[1].lower()]
        name, keys = entry["bronze_table"], list(entry["pk"])
        schema = tables.schema(name) if tables else None
        target = None if tables else target_of(name)
        if schema is None and target is None:
            raise ValueError(f"no target {name}")
        brought = landing.batch_schemas(spark, base, batches)
        rows, gaps = landing.read_batches(spark, base, brought).drop("schema_name", "table_name"), landing.schema_gaps(brought)
        lost = payload.missing_keys(keys, rows.columns)
        if lost:
            raise ValueError(f"key columns missing: {lost}")
        counts.update({(r["tenant_id"], r["batch_id"]): r["count"] for r in rows.groupBy("tenant_id", "batch_id").count().collect()})
        if dry_run:
            return
        stamp = {"run_id": run_id, "as_of": as_of}
        if tables:
            held = by_lower_name(schema.names)
            tables.widen(name, StructType([f for f in rows.schema.fields if add_columns or f.name.lower() in held]))
            columns = tables.schema(name).names
            newest = None if replay else settle(landing_rows(rows, columns, keys, gaps=gaps, **stamp), "landing")
            write = lambda: _into(tables, name, keys, rows, newest, batches, replay, gaps, stamp)
        else:
            state = target
            for tenant, slice_of in _slices(rows, batches, replay):
                state = landing_load(state, slice_of, keys, replay=replay, tenant_id=tenant, gaps=gaps, **stamp)
            states[key] = state
            write = (lambda: store(key, state)) if store else None
        if write:
            try:
                write()
            except Exception as e:
                raise StoreFailed(str(e)) from e
            states[key] = (tables.read if tables else target_of)(name)

    def one(item) -> list[tuple]:
        key, batches = item
        began, why, counts = _now(), reason(*key), {}
        status = "SKIPPED" if why else "DRY_RUN" if dry_run else "SUCCESS"
        if not why:
            try:
                load(key, batches, counts)
            except StoreFailed as e:
                status, why = "FATAL", f"not stored: {e}"
            except Exception as e:  # one table's failure must not stop the others
                status, why = "FAILED", str(e)
        ended, rows = _now(), counts if status in ("SUCCESS", "DRY_RUN") else {}
        return [
            (b["tenant_id"], *key, b["batch_id"], status, rows.get((b["tenant_id"], b["batch_id"]), 0), 0, why, began, ended)
            for b in batches
        ]

    with ThreadPoolExecutor(max_workers=workers) as pool:
        done = [row for rows in pool.map(one, sorted(pending.items())) for row in rows]
    results = settle(spark.createDataFrame(done, RESULT), "landing-results")
    loaded = results.filter("status = 'SUCCESS'").groupBy("tenant_id", "schema_name", "source_table").agg(
        F.max("batch_id").alias("last_batch_id")
    ).withColumn("updated_on", as_of)
    good = control.promotable_batches(results.filter("status <> 'SKIPPED'"), gate, "clean_and_newer")
    opened = control.open_gate(gate, good, run_id, as_of) if not dry_run else gate
    if kept is not None:
        detail = settle(control.run_detail(results.withColumn("status", F.when(F.col("status") == "DRY_RUN", "SKIPPED").otherwise(F.col("status"))), run_id, as_of), "detail")
        kept.write("detail", run_id, detail)
        kept.write("header", run_id, control.run_summary(detail, "rivulet-landing-1", as_of))
        if not dry_run:
            kept.write("mark", run_id, loaded)
            kept.write("gate", run_id, opened.filter(F.col("execution_id") == run_id))
    moved = watermark_upsert(marks, loaded) if not dry_run else marks
    return LandingRun(results, moved, opened, states)


def _into(tables: BucketStore, name: str, keys: list[str], rows, newest, batches, replay, gaps, stamp) -> None:
    """Merge into touched folders; a replay makes a tenant's slice anew, as rows that it no longer brings must go."""
    merge_keys, carried = ["tenant_id", *keys], landing.CARRIED if gaps else None
    if newest is not None:
        tables.change(name, newest, lambda held, new: merge.upsert(held, new, merge_keys, carried=carried, settled=True, unique=True), settled=True)
        return
    for tenant, slice_of in _slices(rows, batches, replay):
        mine = tables.read(name).filter(F.col("tenant_id") == tenant)
        tables.replace(name, tenant, landing_load(mine, slice_of, keys, replay=replay, tenant_id=tenant, gaps=gaps, **stamp))


def loaded_batches(kept: ControlStore) -> DataFrame:
    """The batches that landing runs have loaded, in the shape of a listing."""
    done = kept.read("detail").filter("status = 'SUCCESS' AND batch_id IS NOT NULL")
    return done.select("tenant_id", "schema_name", F.col("source_table").alias("table_name"), "batch_id").distinct()


def _slices(rows: DataFrame, batches: list, replay) -> list[tuple[int | None, DataFrame]]:
    """A replay replaces batches tenant by tenant; otherwise all tenants load at once."""
    if not replay:
        return [(None, rows)]
    return [(t, rows.filter(F.col("tenant_id") == t)) for t in sorted({b["tenant_id"] for b in batches})]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
