"""The landing tree: ``tenant_id=/schema_name=/table_name=/batch_id=`` folders of parquet.

A read lists and opens only the folders of the tenant, table and batches asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.keys import canonical_keys
from rivulet.functions.widening import joined, widened
from rivulet.operators.dedupe import drop_duplicate_keys

Batch = tuple[int, str, int]  # tenant, schema, batch id
PARTS = ["tenant_id", "schema_name", "table_name", "batch_id"]
_PART_TYPES = {"tenant_id": "int", "schema_name": "string", "table_name": "string", "batch_id": "bigint"}


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in _PART_TYPES.items()})


def _folders(base: str, wanted: Mapping[str, object], batches: Iterable[int] | None) -> list[str]:
    """The folders to load as path patterns: fixed parts by name, open ones by wildcard."""
    fixed = [f"{p}={wanted[p]}" if wanted.get(p) is not None else f"{p}=*" for p in PARTS[:-1]]
    last = ["batch_id=*"] if batches is None else [f"batch_id={b}" for b in sorted(set(batches))]
    return ["/".join([base.rstrip("/"), *fixed, b]) for b in last]


def read_landing(
    spark: SparkSession, base: str, *, tenant_id: int | None = None, schema_name: str | None = None,
    table_name: str | None = None, batches: Iterable[int] | None = None, schema: T.StructType | None = None,
    widen: bool = False,
) -> DataFrame:
    """Rows of the asked-for folders. ``widen`` merges file schemas when batches brought new columns.

    Only those folders are listed and only their files give the schema, so the tables of a tree may have
    different columns.
    """
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    if widen:
        reader = reader.option("mergeSchema", "true")
    wanted = {"tenant_id": tenant_id, "schema_name": schema_name, "table_name": table_name}
    df = reader.parquet(*_folders(base, wanted, batches))
    return df if schema is not None else _typed(df)


def _files(spark: SparkSession, base: str) -> DataFrame:
    """One row per landing file with its size and folder; contents are not loaded."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", base).load(base)
    )
    return _typed(listing.select("length", *PARTS))


def landing_batches(spark: SparkSession, base: str) -> DataFrame:
    """Tenants, tables and batches present, from the file listing: work grows with files, not rows."""
    return _files(spark, base).select(*PARTS).distinct()


def landing_inventory(spark: SparkSession, base: str) -> DataFrame:
    """File count and bytes per table folder."""
    return _files(spark, base).groupBy("tenant_id", "schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def landing_diff(source: DataFrame, destination: DataFrame) -> DataFrame:
    """What a copy would have to move: the same number of files counts as already there."""
    keys = ["tenant_id", "schema_name", "table_name"]
    there = destination.select(*keys, F.col("files").alias("dest_files"))
    same = (F.col("files") == F.col("dest_files")) & (F.col("files") > 0)
    return source.join(there, keys, "full_outer").select(
        *keys,
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("dest_files", F.lit(0)).alias("dest_files"),
        F.when(same, "SKIPPED_SAME")
        .when(F.col("files").isNull(), "ONLY_DESTINATION")
        .otherwise("TO_COPY")
        .alias("status"),
    )


def pending_batches(batches: DataFrame, marks: DataFrame) -> DataFrame:
    """Batches above the last loaded one; a table without a mark has all its batches pending."""
    held = marks.select("tenant_id", "schema_name", F.col("source_table").alias("table_name"), "last_batch_id")
    return (
        batches.join(held, ["tenant_id", "schema_name", "table_name"], "left")
        .filter(F.col("last_batch_id").isNull() | (F.col("batch_id") > F.col("last_batch_id")))
        .select(*PARTS)
    )


def replay_range(batches: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Batches of a closed range; either end may be open."""
    inside: Column = F.lit(True)
    if first is not None:
        inside = inside & (F.col("batch_id") >= first)
    if last is not None:
        inside = inside & (F.col("batch_id") <= last)
    return batches.filter(inside)


def folder_of(base: str, row: Mapping[str, object]) -> str:
    return "/".join([base.rstrip("/"), *[f"{p}={row[p]}" for p in PARTS]])


def batch_schemas(spark: SparkSession, base: str, batches: Iterable[Row]) -> dict[Row, T.StructType]:
    """The columns of each landing folder, from footers, a few folders at a time.

    ``batches`` are rows of :data:`PARTS`. The driver holds names and types of columns, not rows. Files of one folder
    must agree in their types; folders need not.
    """

    def of(row: Row) -> T.StructType:
        folder = folder_of(base, row.asDict())
        try:
            return spark.read.option("mergeSchema", "true").parquet(folder).schema
        except PySparkException as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            raise MixedFolder(f"files of {folder} have columns of different types") from e

    rows = list(batches)
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(rows, pool.map(of, rows)))


class MixedFolder(ValueError):
    """One batch folder holds files whose columns have no common type in place."""


def read_batches(spark: SparkSession, base: str, schemas: Mapping[Row, T.StructType]) -> DataFrame:
    """The rows of some landing folders, whose columns may differ in number and type.

    Folders with equal columns are read together and cast to the types that hold all of them, so there is one scan for
    each set of columns, not for each folder. Columns that a folder lacks are NULL.
    """
    whole, groups = joined(schemas.values()), {}
    for row, schema in schemas.items():
        groups.setdefault(schema.json(), []).append(row)
    parts = T.StructType([T.StructField("tenant_id", T.IntegerType()), T.StructField("schema_name", T.StringType()),
                          T.StructField("table_name", T.StringType()), T.StructField("batch_id", T.LongType())])
    read = []
    for rows in groups.values():
        fields = [f for f in schemas[rows[0]].fields if f.name not in PARTS]
        df = spark.read.schema(T.StructType([*fields, *parts.fields])).option("basePath", base)
        read.append(widened(df.parquet(*[folder_of(base, r.asDict()) for r in rows]), whole))
    if not read:
        return spark.createDataFrame([], parts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def schema_gaps(schemas: Mapping[Row, T.StructType]) -> dict[str, list[Batch]]:
    """Columns that some batches of a table lack, with those batches as (tenant, schema, batch)."""
    brought = {(r["tenant_id"], r["schema_name"], r["batch_id"]): {c.lower() for c in s.names} for r, s in schemas.items()}
    names = [c for c in joined(schemas.values()).names if c not in PARTS]
    gaps = {c: sorted(b for b, have in brought.items() if c.lower() not in have) for c in sorted(names)}
    return {c: missing for c, missing in gaps.items() if missing}


def batch_gaps(spark: SparkSession, base: str, table_name: str, batches: DataFrame) -> dict[str, list[Batch]]:
    """:func:`schema_gaps` of one table's folders; ``batches`` comes from :func:`landing_batches`."""
    listed = batches.filter(F.col("table_name") == table_name).select(*PARTS).distinct().collect()
    return schema_gaps(batch_schemas(spark, base, listed))


CARRIED = "_carried"


def _is_batch(columns: Iterable[str], batch: Batch) -> Column:
    """Rows of one landing batch; a frame without the schema's name holds one schema only."""
    have = set(columns)
    parts = [F.col(c) == v for c, v in zip(("tenant_id", "schema_name", "batch_id"), batch) if c in have]
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def newest_per_key(
    rows: DataFrame, keys: list[str], gaps: Mapping[str, Iterable[Batch]] | None = None
) -> DataFrame:
    """All pending batches at once: the newest batch of each key stands for merging them in order.

    ``gaps`` tells which batches lack a column. Each such column then comes from the newest batch that
    has it, and every row lists in ``_carried`` the columns its batches brought, so that the merge
    leaves the others alone, as batch after batch would have done.
    """
    rows = canonical_keys(rows, keys)
    if not gaps:
        return drop_duplicate_keys(rows, keys, [F.col("batch_id").desc()])
    once = drop_duplicate_keys(rows, [*keys, "batch_id"])

    def held(name: str) -> Column:
        lacking = [_is_batch(rows.columns, b) for b in gaps.get(name, [])]
        return ~reduce(lambda a, b: a | b, lacking) if lacking else F.lit(True)

    def newest(name: str) -> Column:
        if name == "batch_id":
            return F.max("batch_id")
        return F.max_by(F.col(f"`{name}`"), F.when(held(name), F.col("batch_id")))

    names = [c for c in rows.columns if c not in keys]
    carried = [F.when(F.bool_or(held(c)), F.lit(c.lower())) for c in names]
    return once.groupBy(*keys).agg(
        *[newest(c).alias(c) for c in names],
        F.array_compact(F.array(*[F.lit(k.lower()) for k in keys], *carried)).alias(CARRIED),
    )
