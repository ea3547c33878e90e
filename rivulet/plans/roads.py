"""The roads into bronze beside the stream, over all their tables: full reload, replacement, fill, ghost sweep.

Each road takes the tables of a registry, changes the folders that are touched, and leaves a row for every table under
the run's id, whatever became of it. A table that a road cannot take is SKIPPED with the reason; one that fails does
not stop the others; a dry run counts and changes nothing. Loops run over tables, never over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rivulet import model
from rivulet.model import align_schema
from rivulet.operators import control, merge, registry as reg
from rivulet.plans.bronze import fill_rows, find_ghosts, reload_rows, replacement_rows
from rivulet.session import settle
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.sources.source_db import SourceReader

TableKey = tuple[str, str]


class Unfit(Exception):
    """Why a road does not take a table."""


@dataclass(frozen=True)
class Roads:
    """What all roads share: where rows come from and go to, and what a run stamps on them.

    ``read_as`` names a source table for the reader. ``columns`` (the source's column listing) leaves wide columns out.
    """

    source: SourceReader
    tables: BucketStore
    kept: ControlStore
    tenant_id: int
    batch_id: int
    run_id: str
    as_of: Column
    dry_run: bool = False
    workers: int = 8
    columns: DataFrame | None = None
    read_as: Callable[[str, str], str] = lambda schema, table: table

    def reload(self, registry: DataFrame, streamed: Iterable[TableKey] = (), overwrite_tenant: bool = False) -> DataFrame:
        """Read whole tables and merge them by key (or swap the tenant's slice). Tables the stream owns are left to it.

        Writes detail, header, marks and, if nothing failed and the batch is newer, the gate.
        """
        owned = {(s.lower(), t.lower()) for s, t in streamed}

        def one(entry: Row, row: dict) -> None:
            if (entry["source_schema"].lower(), entry["source_table"].lower()) in owned:
                raise Unfit("the stream owns it")
            name, keys = self._target(entry), self._keys(entry)
            source = self._read(entry, None)
            rows = settle(reload_rows(
                source, self.tables.schema(name).names, keys, tenant_id=self.tenant_id, batch_id=self.batch_id, run_id=self.run_id,
                as_of=self.as_of,
            ), "reload")
            row["rows"] = rows.count()
            if self.dry_run:
                row["status"] = "DRY"
            elif overwrite_tenant:
                self.tables.replace(name, self.tenant_id, align_schema(rows, self.tables.schema(name)))
            else:
                self._merge(name, rows, merge.upsert, keys)

        results = self._over(registry, one, "FAILED", "status string, error string, rows bigint", {"status": "SUCCESS", "error": None, "rows": 0})
        ran = results.select(
            F.lit(self.tenant_id).alias("tenant_id"), F.col("source_schema").alias("schema_name"), "source_table",
            F.lit(self.batch_id).alias("batch_id"), F.when(F.col("status") == "DRY", "SKIPPED").otherwise(F.col("status")).alias("status"),
            F.when(F.col("status") != "DRY", F.col("rows")).otherwise(0).alias("inserted_rows"),
            F.when(F.col("status") == "DRY", "dry run").otherwise(F.col("error")).alias("error_message"), "start_ts", "end_ts",
        )
        detail = settle(control.run_detail(ran, self.run_id, self.as_of), "detail")
        self.kept.write("detail", self.run_id, detail)
        self.kept.write("header", self.run_id, control.run_summary(detail, "rivulet-reload-1", self.as_of))
        if not self.dry_run:
            good = detail.filter("status = 'SUCCESS'").withColumns({"last_batch_id": F.col("batch_id"), "updated_on": self.as_of})
            self.kept.write("mark", self.run_id, good)
            before = self.kept.gate(besides=self.run_id)
            safe = control.promotable_batches(detail, before, "run_if_newer", self.batch_id)
            opened = control.open_gate(before, safe, self.run_id, self.as_of)
            self.kept.write("gate", self.run_id, opened.filter(F.col("execution_id") == self.run_id))
        return detail

    def replace(self, registry: DataFrame) -> DataFrame:
        """For tables with nothing to track: make the tenant's slice equal the source, by key where there is one."""

        def one(entry: Row, row: dict) -> None:
            name = self._target(entry)
            schema = self.tables.schema(name)
            row["bronze_before"] = self._slice(name).count()
            have = [c for c in self._carried(entry) if c.lower() in model.by_lower_name(schema.names)]
            if not have:
                raise Unfit("the target has none of its narrow columns")
            keys = [model.by_lower_name(schema.names).get(k.lower(), k) for k in entry["pk"]]
            rows, keyed = replacement_rows(
                self._read(entry, have), schema.names, keys, tenant_id=self.tenant_id, batch_id=self.batch_id, as_of=self.as_of,
            )
            rows = settle(rows, "replacement")
            row.update(src_rows=rows.count(), method="merge_sync" if keyed else "overwrite_tenant")
            if self.dry_run:
                row["status"] = "DRY"
                return
            state = align_schema(rows, schema)
            if keyed:
                state = merge.full_sync(self._slice(name), rows, ["tenant_id", *keys], self.tenant_id, settled=True, unique=True)
            self.tables.replace(name, self.tenant_id, state)

        empty = {"method": None, "src_rows": 0, "bronze_before": 0, "status": "OK", "error": None}
        results = self._over(registry, one, "ERROR", "method string, src_rows bigint, bronze_before bigint, status string, error string", empty)
        return self._report("full_load_report", results)

    def fill(self, touched: DataFrame, missing: Mapping[TableKey, list[str]]) -> DataFrame:
        """Fill what the capture left out in rows of the batch, for the tables it touched.

        ``missing`` names the columns per table, ``touched`` comes from :func:`registry.touched_tables`.
        """

        def one(entry: Row, row: dict) -> None:
            wanted = missing.get((entry["source_schema"], entry["source_table"]), [])
            if not wanted:
                raise Unfit("its capture lacks no column")
            name, keys = self._target(entry), self._keys(entry)
            spelled = model.by_lower_name(self.tables.schema(name).names)
            wanted = [spelled[c.lower()] for c in wanted if c.lower() in spelled]
            if not wanted:
                raise Unfit("the target has none of the columns")
            row["cols_filled"] = ",".join(wanted)
            reader = (_Spelled(self.source, spelled), self.read_as(entry["source_schema"], entry["source_table"]))
            holes, found = fill_rows(self._slice(name), reader, keys, wanted, tenant_id=self.tenant_id, batch_id=self.batch_id)
            row["candidate_rows"] = holes.count()
            if self.dry_run or not row["candidate_rows"]:
                return
            row["filled_rows"] = found.count()
            self._merge(name, found, lambda held, new, keys, **o: merge.fill(held, new, keys, wanted, **o), keys)

        empty = {"candidate_rows": 0, "filled_rows": 0, "cols_filled": "", "status": "OK", "error": None}
        results = self._over(touched, one, "ERROR", "candidate_rows bigint, filled_rows bigint, cols_filled string, status string, error string", empty)
        return self._report("fill_report", results)

    def sweep(self, registry: DataFrame, max_pct: float = 10.0, buckets: int | None = 4096) -> DataFrame:
        """Delete rows whose key is gone at the source, unless too many are; log every key before it goes."""
        logs, deletes = [], []

        def one(entry: Row, row: dict) -> None:
            name, keys = self._target(entry), self._keys(entry)
            spelled = {k: k for k in keys}
            known = _Spelled(self.source, model.by_lower_name(spelled)).read(self.read_as(entry["source_schema"], entry["source_table"]), keys)
            found = find_ghosts(
                self._slice(name), known, keys, tenant_id=self.tenant_id, batch_id=self.batch_id,
                schema_name=entry["source_schema"], source_table=entry["source_table"], bronze_table=entry["bronze_table"],
                as_of=self.as_of, max_pct=max_pct, dry_run=self.dry_run, buckets=buckets,
            )
            told = found.report.first()
            row.update({c: told[c] for c in ("ghost_rows", "bronze_rows", "status", "error")})
            if told["status"] == "DELETED":
                logs.append(settle(found.log, "doomed"))
                deletes.append((name, settle(found.doomed, "doomed-keys"), row))

        empty = {"ghost_rows": 0, "bronze_rows": 0, "status": "OK", "error": None}
        kinds = "ghost_rows bigint, bronze_rows bigint, status string, error string"

        def log_then_delete() -> None:
            # the log of all tables stands before the first row goes
            every = reduce(DataFrame.unionByName, logs) if logs else model.empty(self.kept.spark, model.DOOMED_KEYS)
            self.kept.write("doomed", self.run_id, every)
            with ThreadPoolExecutor(max_workers=self.workers) as pool:
                list(pool.map(delete, deletes))

        def delete(doomed: tuple) -> None:
            name, keys, row = doomed
            try:
                self.tables.delete(name, keys)
            except Exception as e:
                row.update(status="FAILED", error=str(e))

        results = self._over(registry, one, "FAILED", kinds, empty, after=log_then_delete)
        return self._report("ghost_report", results.withColumn("dry_run", F.lit(self.dry_run)))

    # what the roads share

    def _over(
        self, registry: DataFrame, one: Callable[[Row, dict], None], bad: str, kinds: str, empty: dict,
        after: Callable[[], None] | None = None,
    ) -> DataFrame:
        """A result row per active table, whatever happens to it."""
        active = registry if "is_active" not in registry.columns else registry.filter("is_active")
        listed = active.withColumn("pk", reg.key_list(F.col("pk_columns")))
        entries = listed.select("source_schema", "source_table", "bronze_table", "pk").orderBy("source_schema", "source_table").collect()

        def timed(entry: Row) -> tuple:
            row, began = dict(empty), _now()
            try:
                one(entry, row)
            except Unfit as e:
                row.update(status="SKIPPED", error=str(e))
            except Exception as e:  # one table's failure must not stop the others
                row.update(status=bad, error=str(e))
            return entry, row, began, _now()

        with ThreadPoolExecutor(max_workers=self.workers) as pool:
            done = list(pool.map(timed, entries))
        if after:
            after()
        rows = [(*entry[:3], *row.values(), began, ended) for entry, row, began, ended in done]
        shape = f"source_schema string, source_table string, bronze_table string, {kinds}, start_ts timestamp, end_ts timestamp"
        return self.kept.spark.createDataFrame(rows, shape)

    def _report(self, output: str, results: DataFrame) -> DataFrame:
        stamped = results.withColumnRenamed("source_schema", "schema_name").withColumns(
            {"tenant_id": F.lit(self.tenant_id), "batch_id": F.lit(self.batch_id), "run_id": F.lit(self.run_id), "run_ts": self.as_of}
        )
        self.kept.write(output, self.run_id, stamped)
        return align_schema(stamped, self.kept.schema(output))

    def _target(self, entry: Row) -> str:
        if not entry["bronze_table"]:
            raise Unfit("it has no target")
        if self.tables.schema(entry["bronze_table"]) is None:
            raise Unfit(f"target {entry['bronze_table']} is not declared")
        return entry["bronze_table"]

    def _keys(self, entry: Row) -> list[str]:
        """The table's keys as the target spells them."""
        spelled = model.by_lower_name(self.tables.schema(entry["bronze_table"]).names)
        if not entry["pk"]:
            raise Unfit("it has no key")
        lost = [k for k in entry["pk"] if k.lower() not in spelled]
        if lost:
            raise Unfit(f"the target lacks its key columns: {lost}")
        return [spelled[k.lower()] for k in entry["pk"]]

    def _slice(self, name: str) -> DataFrame:
        return self.tables.read(name).filter(F.col("tenant_id") == self.tenant_id)

    def _carried(self, entry: Row) -> list[str]:
        """The source's columns, without the wide ones where it lists types."""
        if self.columns is None:
            return self.source.read(self.read_as(entry["source_schema"], entry["source_table"])).columns
        mine = (F.lower("table_schema") == entry["source_schema"].lower()) & (F.lower("table_name") == entry["source_table"].lower())
        return [r[0] for r in reg.carried_columns(self.columns.filter(mine)).select("column_name").collect()]

    def _read(self, entry: Row, columns: list[str] | None) -> DataFrame:
        return self.source.read(self.read_as(entry["source_schema"], entry["source_table"]), columns)

    def _merge(self, name: str, rows: DataFrame, how: Callable[..., DataFrame], keys: list[str]) -> None:
        mine = F.col("tenant_id") == self.tenant_id
        self.tables.change(
            name, rows, lambda held, new: how(held, new, ["tenant_id", *keys], scope=mine, settled=True, unique=True), settled=True,
        )


class _Spelled:
    """A source whose columns go by the target's spelling."""

    def __init__(self, source: SourceReader, spelled: Mapping[str, str]):
        self._source, self._spelled = source, spelled

    def read(self, table: str, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame:
        df = self._source.read(table)
        named = df.select(*[F.col(f"`{c}`").alias(self._spelled.get(c.lower(), c)) for c in df.columns])
        named = named if predicate is None else named.filter(predicate)
        return named if columns is None else named.select(*columns)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
