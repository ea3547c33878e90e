"""A compaction cycle that keeps what it decides: tables, control outputs and acknowledged ranges, run by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators import control
from rivulet.session import settle
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.streaming.compaction import Cycle, compaction_cycle
from rivulet.streaming.ledger import Stage

VERSION = "rivulet-1"


def run_cycle(
    stage: Stage, registry: DataFrame, tables: BucketStore, kept: ControlStore, *, tenant_id: int, run_id: str,
    as_of: Column, strict: bool = True, **options,
) -> Cycle:
    """Drain the stage into ``tables``, write every output under the run's id, acknowledge last.

    A run that broke off, or is done again under its id, claims the same rows once more: its own acknowledgements,
    marks and gate entries do not count for it, applying changes twice gives the same tables, and its outputs
    replace those it had written. With ``strict`` a cycle that left a table in an unknown state raises
    once its outcome is stored.
    """
    cycle = compaction_cycle(stage, registry, tables, tenant_id=tenant_id, run_id=run_id, as_of=as_of, **options)
    if cycle.status == "EMPTY":
        return cycle
    results = settle(cycle.results, "results")
    good = results.filter("status = 'SUCCESS'")
    detail = control.run_detail(results, run_id, as_of)
    kept.write("detail", run_id, detail)
    kept.write("header", run_id, control.run_summary(kept.read("detail").filter(F.col("execution_id") == run_id), VERSION, as_of))
    kept.write("dead_letter", run_id, cycle.dead_letters)
    kept.write("lag", run_id, cycle.lag)
    kept.write(
        "mark", run_id,
        good.select("tenant_id", "schema_name", "source_table", F.col("batch_id").alias("last_batch_id"), as_of.alias("updated_on")),
    )
    kept.write(
        "cursor", run_id,
        good.select(
            "tenant_id", F.col("schema_name").alias("source_schema"), "source_table",
            F.lit(cycle.boundary).alias("last_stage_seq"), F.col("batch_id").alias("last_batch_id"), as_of.alias("updated_on"),
        ),
    )
    before = kept.gate(besides=run_id)
    opened = control.open_gate(before, control.promotable_batches(results, before, "run_if_clean"), run_id, as_of)
    kept.write("gate", run_id, opened.filter(F.col("execution_id") == run_id))
    stage.acknowledge(run_id, cycle.acknowledged)
    cycle.stage = stage.unacknowledged()
    return cycle.require_whole() if strict else cycle
