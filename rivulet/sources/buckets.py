"""Bronze tables as folders by tenant and by bucket of the key, so that a change rewrites what it touches.

A table lies in ``tenant_id=/_bucket=/`` folders. A row's bucket is a hash of its key as the merges compare it, so a
key has one bucket whatever its spelling, and a change needs the buckets of its own keys only: they are read by
partition pruning, changed, and swapped by one dynamic overwrite. Old files stay until that job commits, so the
new state may read the folder that it replaces, and is written once.

How many buckets a table has, and its columns, are settled at its first write and kept beside the tables. Types may grow
(:mod:`rivulet.functions.widening`). Parquet folders have no
transactions: a swap is atomic per folder at best.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.widening import joined, widened
from rivulet.model import align_schema, empty
from rivulet.operators.merge import delete_matched
from rivulet.session import settle
from rivulet.sources.sinks import balanced

TENANT, BUCKET = "tenant_id", "_bucket"
LAYOUT = "version int, buckets int, keys array<string>, columns string"

Places = dict[int, list[int]]  # tenant -> buckets


class StoreFailed(RuntimeError):
    """A new table state was computed but could not be written."""


@dataclass(frozen=True)
class Swap:
    """Which folders a change has rewritten and what they hold now."""

    places: Places
    rows: int

    @property
    def folders(self) -> int:
        return sum(map(len, self.places.values()))


def _comparable(name: str, kind: T.DataType) -> Column:
    """A key column as text that is equal where merges call it equal."""
    column = F.col(f"`{name}`").cast(kind)
    if isinstance(kind, T.StringType):
        return F.upper(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = column + F.lit(0.0)  # one zero
    return column.cast("string")


def bucket_of(keys: Iterable[str], schema: T.StructType, buckets: int) -> Column:
    """The bucket of a row. Keys take the table's types first, so that ``1`` has one bucket as int and as long."""
    parts = [_comparable(k, schema[k].dataType) for k in keys]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int") if parts else F.lit(0)


class BucketStore:
    """Tables below ``root`` with declared schemas and keys (without the tenant). A table without keys has one bucket."""

    def __init__(
        self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType], keys: Mapping[str, Iterable[str]],
        buckets: int = 64,
    ):
        self._spark, self._root, self._buckets = spark, root.rstrip("/"), buckets
        self._schemas = dict(schemas)
        self._keys = {n: list(keys.get(n, ())) for n in schemas}
        self._settled: dict[str, Row] = {}

    def path(self, name: str) -> str:
        """The folder of the table's present version."""
        held = self._layout(name)
        return f"{self._root}/{name}" if held is None or not held["version"] else f"{self._root}/{name}.v{held['version']}"

    def schema(self, name: str) -> T.StructType | None:
        """The declared columns, as far as the table has been widened."""
        if name not in self._schemas:
            return None
        held = self._layout(name)
        return self._schemas[name] if held is None else T.StructType.fromJson(json.loads(held["columns"]))

    def keys(self, name: str) -> list[str]:
        return self._keys[name]

    def _load(self, path: str, schema) -> DataFrame | None:
        try:
            return self._spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _layout(self, name: str) -> Row | None:
        """What was settled when the table was first written or last widened."""
        if name not in self._settled:
            held = self._load(f"{self._root}.layouts/{name}", LAYOUT)
            if held is None:
                return None
            row = held.orderBy(F.col("version").desc(), F.length("columns").desc()).first()
            if row["keys"] != self._keys[name]:
                raise ValueError(f"{name} is bucketed by {row['keys']}, not by {self._keys[name]}")
            self._settled[name] = row
        return self._settled[name]

    def _settle_layout(self, name: str, version: int, schema: T.StructType) -> None:
        row = (version, self.buckets(name), self._keys[name], json.dumps(json.loads(schema.json())))
        self._spark.createDataFrame([row], LAYOUT).coalesce(1).write.mode("append").parquet(f"{self._root}.layouts/{name}")
        self._settled.pop(name, None)

    def buckets(self, name: str, settle_now: bool = False) -> int:
        """The table's number of buckets: the one it was first written with, else the one asked for."""
        held = self._layout(name)
        if held is not None:
            return held["buckets"]
        if settle_now:
            self._settle_layout(name, 0, self._schemas[name])
        return self._buckets if self._keys[name] else 1

    def widen(self, name: str, schema: T.StructType) -> bool:
        """Make room for columns and types of ``schema`` beside the table's own; whether anything changed.

        A new column is only noted: old files give NULL for it. A type that grows rewrites the table once, into a new folder;
        the layout then names that folder, so readers see the old table or the new one. The old folder stays until it is
        expired.
        """
        held = self.schema(name)
        grown = joined([held, T.StructType([f for f in schema.fields if f.name != BUCKET])])
        if grown == joined([held]):
            return False
        layout = self._layout(name)
        version = 0 if layout is None else layout["version"]
        same = all(grown[f.name].dataType == f.dataType for f in held.fields)
        if any(grown[k].dataType != held[k].dataType for k in [TENANT, *self._keys[name]]):
            raise TypeError(f"keys of {name} cannot change their type: {grown.simpleString()}")
        stored = self._stored(name)
        if not same:
            version += 1
            if stored is not None:
                rows = widened(stored.select(*held.names), grown)
                self.buckets(name, True)
                laid = balanced(rows.withColumn(BUCKET, bucket_of(self._keys[name], grown, self.buckets(name))), TENANT, BUCKET)
                laid.sortWithinPartitions(TENANT, BUCKET, *self._keys[name]).write.partitionBy(TENANT, BUCKET).parquet(f"{self._root}/{name}.v{version}")
        self._settle_layout(name, version, grown)
        return True

    def _stored(self, name: str) -> DataFrame | None:
        schema = self.schema(name)
        rest = [f for f in schema.fields if f.name != TENANT]
        parts = [T.StructField(TENANT, schema[TENANT].dataType), T.StructField(BUCKET, T.IntegerType())]
        return self._load(self.path(name), T.StructType(rest + parts))

    def read(self, name: str) -> DataFrame | None:
        """The whole table, empty before its first load; None when it is not declared."""
        schema = self.schema(name)
        if schema is None:
            return None
        stored = self._stored(name)
        return empty(self._spark, schema) if stored is None else stored.select(*schema.names)

    def slice(self, name: str, places: Places) -> DataFrame:
        """The rows of some folders; the others are neither listed for tasks nor opened."""
        schema, stored = self.schema(name), self._stored(name)
        if stored is None or not places:
            return empty(self._spark, schema)
        inside = F.lit(False)
        for tenant, buckets in sorted(places.items()):
            inside = inside | ((F.col(TENANT) == tenant) & F.col(BUCKET).isin(buckets))
        return stored.filter(inside).select(*schema.names)

    def _placed(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self._keys[name], self.schema(name), self.buckets(name, True)))

    def places(self, name: str, rows: DataFrame) -> Places:
        """The folders that the keys of ``rows`` belong to: at most tenants times buckets."""
        found: Places = {}
        for r in self._placed(name, rows).select(TENANT, BUCKET).distinct().orderBy(TENANT, BUCKET).collect():
            found.setdefault(r[TENANT], []).append(r[BUCKET])
        return found

    def change(self, name: str, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], settled: bool = False) -> Swap:
        """Apply ``merge(rows of the touched folders, changes)`` and swap those folders.

        ``changes`` carry tenant and keys; ``settled`` says that they are a written table.
        """
        changes = changes if settled else settle(changes, "store-changes")
        places = self.places(name, changes)
        return self.swap(name, merge(self.slice(name, places), changes), places) if places else Swap({}, 0)

    def delete(self, name: str, doomed: DataFrame) -> Swap:
        """Remove the rows whose tenant and key are listed."""
        keys = [TENANT, *self._keys[name]]
        return self.change(name, doomed.select(*keys), lambda held, gone: delete_matched(held, gone, keys))

    def replace(self, name: str, tenant_id: int, rows: DataFrame) -> Swap:
        """Swap a tenant's whole slice. Nothing old is read but folder names."""
        stored = self._stored(name)
        there = [] if stored is None else [
            r[0] for r in stored.filter(F.col(TENANT) == tenant_id).select(BUCKET).distinct().collect()
        ]
        every = {tenant_id: sorted({*there, *range(self.buckets(name, True))})}
        return self.swap(name, rows.filter(F.col(TENANT) == tenant_id), every, emptied={tenant_id: there})

    def load(self, name: str, rows: DataFrame) -> None:
        """The first rows of a table, of all tenants at once; keys must be unique."""
        if self._stored(name) is not None:
            raise ValueError(f"{name} has been loaded before")
        self._laid(name, align_schema(rows, self.schema(name))).write.partitionBy(TENANT, BUCKET).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows to a table without keys; no file is rewritten."""
        if self._keys[name]:
            raise ValueError(f"{name} has keys: rows must be merged")
        laid = self._laid(name, align_schema(rows, self.schema(name)))
        laid.write.mode("append").partitionBy(TENANT, BUCKET).parquet(self.path(name))

    def _laid(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows gathered by folder, a big one over several tasks, sorted by key within files."""
        return balanced(self._placed(name, rows), TENANT, BUCKET).sortWithinPartitions(TENANT, BUCKET, *self._keys[name])

    def swap(self, name: str, state: DataFrame, places: Places, emptied: Places | None = None) -> Swap:
        """Replace the folders ``places`` by the rows of ``state``, which must belong there.

        A dynamic overwrite leaves folders alone that get no row. Which ones got rows is observed as they are
        written; the rest of ``emptied`` (all of ``places`` unless told) get an empty file.
        """
        seen = Observation()
        laid = self._laid(name, align_schema(state, self.schema(name)))
        allowed = F.lit(False)
        for tenant, buckets in sorted(places.items()):
            allowed = allowed | ((F.col(TENANT) == tenant) & F.col(BUCKET).isin(buckets))
        stray = F.raise_error(F.concat(F.lit(f"a row of {name} belongs to another folder: "), F.concat_ws("/", TENANT, BUCKET)))
        laid = laid.withColumn(BUCKET, F.when(F.coalesce(allowed, F.lit(False)), F.col(BUCKET)).otherwise(stray.cast("int")))
        laid = laid.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(TENANT, BUCKET)).alias("kept"))
        laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TENANT, BUCKET).parquet(self.path(name))
        kept = {(r[TENANT], r[BUCKET]) for r in seen.get["kept"]}
        void = [(t, b) for t, buckets in (places if emptied is None else emptied).items() for b in buckets if (t, b) not in kept]
        none = empty(self._spark, T.StructType([f for f in self.schema(name).fields if f.name != TENANT]))

        def clear(place: tuple[int, int]) -> None:
            none.coalesce(1).write.mode("overwrite").parquet(f"{self.path(name)}/{TENANT}={place[0]}/{BUCKET}={place[1]}")

        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(clear, void))
        return Swap(places, seen.get["rows"])
