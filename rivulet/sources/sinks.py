"""Writing: appends, widening appends, slice replacement, and parked rows.

Parquet folders have no transactions. A slice is swapped partition by partition when the write job
commits; a state computed from the folder it replaces is settled elsewhere first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.model import DEAD_LETTER, align_schema, empty
from rivulet.session import settle


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by ``columns`` into few files, splitting any value too big for one task."""
    return df.hint("rebalance", *columns)


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ("tenant_id",)) -> None:
    parts = list(partition_by)
    balanced(df, *parts).write.mode("append").partitionBy(*parts).parquet(path)


def append_widen(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Append rows that may bring new columns or lack old ones; the gaps are NULL."""
    return existing.unionByName(added, allowMissingColumns=True)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder whose files gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_slices(
    state: DataFrame, path: str, tenants: Iterable[int], *, sort_by: Iterable[str] = (),
    reads_path: bool = True, partition: str = "tenant_id",
) -> None:
    """Swap the partitions of ``tenants`` for the rows of ``state``; others are not touched.

    ``state`` must hold rows of those tenants only. A tenant left without rows gets an empty file, as a
    dynamic overwrite alone would leave its old rows in place.
    """
    tenants = sorted(set(tenants))
    rows = state.filter(F.col(partition).isin(tenants))
    if reads_path:
        rows = settle(rows, "slice")
    left = {r[0] for r in rows.select(partition).distinct().collect()}
    laid = balanced(rows, partition)
    if sort_by:
        laid = laid.sortWithinPartitions(partition, *sort_by)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for tenant in tenants:
        if tenant not in left:
            rows.limit(0).drop(partition).write.mode("overwrite").parquet(f"{path}/{partition}={tenant}")


class BronzeStore:
    """Bronze tables as folders below ``root``, partitioned by tenant, with declared schemas."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self._spark, self._root, self._schemas = spark, root.rstrip("/"), dict(schemas)

    def path(self, name: str) -> str:
        return f"{self._root}/{name}"

    def _stored(self, name: str) -> DataFrame | None:
        try:
            return self._spark.read.schema(self._schemas[name]).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(self, name: str) -> DataFrame | None:
        """The table, empty before its first load; None when it is not declared."""
        schema = self._schemas.get(name)
        if schema is None:
            return None
        stored = self._stored(name)
        return empty(self._spark, schema) if stored is None else stored.select(*schema.names)

    def write(self, name: str, state: DataFrame, tenant_id: int, keys: Iterable[str] = ()) -> None:
        """Swap one tenant's slice for the state's rows of that tenant, sorted by key within files."""
        mine = state.filter(F.col("tenant_id") == tenant_id)
        replace_slices(
            mine, self.path(name), [tenant_id], sort_by=keys, reads_path=self._stored(name) is not None
        )


def overwrite_report(report: DataFrame, path: str) -> None:
    """Replace a small report, whatever columns it had before."""
    report.write.mode("overwrite").parquet(path)


def dead_letters(
    rows: DataFrame, *, source_table: str, error: str, run_id: str, dead_lettered_at: Column | None = None
) -> DataFrame:
    """The raw staged rows of a failed table, ready to be parked and replayed."""
    known = {
        "dead_lettered_at": F.current_timestamp() if dead_lettered_at is None else dead_lettered_at,
        "run_id": F.lit(run_id), "source_table": F.lit(source_table), "error": F.lit(error), "raw_value": F.col("value_json"),
    }
    return align_schema(rows.withColumns(known), DEAD_LETTER)
