"""Reading a source database: whole tables, key-only projections, and reads split over connections.

``SourceReader`` hides where the rows come from. ``JdbcSource`` asks the database, so projections and
predicates run there; ``ParquetSource`` reads a snapshot folder with the same calls.
"""

from __future__ import annotations

from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import settle


class SourceReader(Protocol):
    def read(self, table: str, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame: ...


class ParquetSource:
    """Snapshots kept as parquet, one path per table."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet"):
        self._spark, self._root, self._suffix = spark, root, suffix

    def read(self, table: str, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame:
        df = self._spark.read.parquet(f"{self._root}/{table}{self._suffix}")
        df = df if predicate is None else df.filter(predicate)
        return df if columns is None else df.select(*columns)

    def columns(self, table: str) -> DataFrame:
        """Column metadata in the shape of the database's own listing."""
        schema = self.read(table).schema
        return self._spark.createDataFrame(
            [("main", table, f.name, f.dataType.simpleString(), None) for f in schema.fields],
            "table_schema string, table_name string, column_name string, data_type string, char_len int",
        )


class JdbcSource:
    """Tables over JDBC. ``options`` carry url, driver and credentials."""

    def __init__(self, spark: SparkSession, options: dict[str, str], fetch_size: int = 10_000, partitions: int = 1):
        self._spark, self._options = spark, dict(options)
        self._fetch, self._partitions = fetch_size, partitions

    def _reader(self):
        return self._spark.read.format("jdbc").options(**self._options).option("fetchsize", str(self._fetch))

    def read(self, table: str, columns: list[str] | None = None, predicate: Column | None = None) -> DataFrame:
        """Selection and filter are pushed into the database by the JDBC scan."""
        df = self._reader().option("dbtable", table).load()
        df = df if predicate is None else df.filter(predicate)
        return df if columns is None else df.select(*columns)

    def read_split(self, table: str, keys: list[str], quantiles: bool = False) -> DataFrame:
        """Over several connections when the table has one whole-number key, else over one.

        ``quantiles`` reads the key first and cuts it where the rows are, for keys with holes or clusters.
        """
        whole = self.read(table)
        if quantiles and self._partitions > 1 and len(keys) == 1 and isinstance(whole.schema[keys[0]].dataType, T.IntegralType):
            ranges = range_predicates(quantile_ranges(whole, keys[0], self._partitions), keys[0])
            options = {k: v for k, v in self._options.items() if k not in ("url", "dbtable")}
            if len(ranges) > 1:
                return self._spark.read.jdbc(self._options["url"], table, predicates=ranges, properties={**options, "fetchsize": str(self._fetch)})
        options = split_options(whole, keys, self._partitions)
        if not options:
            return whole
        return self._reader().option("dbtable", table).options(**options).load()

    def columns(self) -> DataFrame:
        listing = self._reader().option("dbtable", "INFORMATION_SCHEMA.COLUMNS").load()
        return listing.select(
            F.col("TABLE_SCHEMA").alias("table_schema"),
            F.col("TABLE_NAME").alias("table_name"),
            F.col("COLUMN_NAME").alias("column_name"),
            F.col("DATA_TYPE").alias("data_type"),
            F.col("CHARACTER_MAXIMUM_LENGTH").alias("char_len"),
        )


def partition_bounds(df: DataFrame, key: str) -> DataFrame:
    """Lowest and highest key, as one row."""
    return df.agg(F.min(key).cast("bigint").alias("lo"), F.max(key).cast("bigint").alias("hi"))


def split_options(df: DataFrame, keys: list[str], partitions: int) -> dict[str, str]:
    """Options for a split read, empty when one connection is all that is possible."""
    if partitions < 2 or len(keys) != 1 or not isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        return {}
    bounds = partition_bounds(df, keys[0]).first()
    if bounds["lo"] is None or bounds["hi"] <= bounds["lo"]:
        return {}
    return {
        "partitionColumn": keys[0],
        "lowerBound": str(bounds["lo"]),
        "upperBound": str(bounds["hi"]),
        "numPartitions": str(partitions),
    }


KLL = 800  # size of quantile sketches: ranks are wrong by about half a percent


def quantile_ranges(df: DataFrame, key: str, partitions: int, k: int = KLL) -> DataFrame:
    """Key ranges that hold about the same number of rows each, however the keys are spread: one row per connection.

    Cuts come from a quantile sketch, which tasks fill apart and which is merged: one pass over the key alone. A cut
    that comes twice is taken once, so there may be fewer ranges than asked for; no key gives no range.
    """
    ranks = F.array(*[F.lit(i / partitions) for i in range(1, partitions)]) if partitions > 1 else F.array().cast("array<double>")
    column = F.col(f"`{key}`").cast("bigint")
    sketch = df.agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.kll_sketch_agg_bigint(column, F.lit(k)).alias("sketch")
    ).filter("lo IS NOT NULL")
    cuts = F.kll_sketch_get_quantile_bigint("sketch", ranks) if partitions > 1 else F.array().cast("array<bigint>")
    ends = F.array_distinct(F.concat(F.filter(cuts, lambda c: (c >= F.col("lo")) & (c < F.col("hi"))), F.array("hi")))
    parts = sketch.select("lo", F.posexplode(ends).alias("part", "to_key"), ends.alias("ends"))
    begin = F.when(F.col("part") == 0, F.col("lo")).otherwise(F.try_element_at("ends", F.col("part")) + 1)
    return parts.select("part", begin.alias("from_key"), "to_key")


def range_predicates(ranges: DataFrame, key: str) -> list[str]:
    """One condition per connection. The outer ranges are open, and the first takes keys without a value."""
    rows = ranges.orderBy("part").collect()  # a row per connection
    found = []
    for n, r in enumerate(rows):
        parts = [f"{key} >= {r['from_key']}"] * (n > 0) + [f"{key} <= {r['to_key']}"] * (n < len(rows) - 1)
        found.append(" AND ".join(parts) + (f" OR {key} IS NULL" if n == 0 and parts else ""))
    return [f or "1 = 1" for f in found]


def range_key(df: DataFrame, keys: list[str]) -> str | None:
    """The first key column whose values ranges can be asked for: text keys are matched without case, so not those."""
    kinds = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType)
    return next((k for k in keys if isinstance(df.schema[k].dataType, kinds)), None)


def near_keys(wanted: DataFrame, key: str, ranges: int = 32, gaps: int = 2) -> Column | None:
    """A condition that holds for every wanted key and few others: the sorted keys cut into ranges, one per task, and
    each of those again at its widest gaps.

    Only lowest and highest key of each range pass through the driver. None if nothing is wanted.
    """
    number = {T.DateType: F.unix_date, T.TimestampType: F.unix_micros}.get(type(wanted.schema[key].dataType), lambda c: c)
    cut = wanted.select(F.col(f"`{key}`").alias("k")).filter("k IS NOT NULL").distinct().repartitionByRange(ranges, "k")
    cut = settle(cut.withColumn("slice", F.spark_partition_id()), "near-keys")
    in_order = Window.partitionBy("slice").orderBy("k")
    gapped = cut.withColumn("gap", number(F.col("k")) - number(F.lag("k").over(in_order)))
    widest = Window.partitionBy("slice").orderBy(F.col("gap").desc_nulls_last(), "k")
    split = gapped.withColumn("cut", F.when((F.row_number().over(widest) <= gaps) & F.col("gap").isNotNull(), 1).otherwise(0))
    pieces = split.withColumn("piece", F.sum("cut").over(in_order)).groupBy("slice", "piece")
    found = pieces.agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    parts = [F.col(f"`{key}`").between(F.lit(r["low"]), F.lit(r["high"])) for r in found]
    return reduce(lambda a, b: a | b, parts) if parts else None


def read_near(
    source: SourceReader, table: str, wanted: DataFrame, keys: list[str], columns: list[str], ranges: int = 32
) -> DataFrame:
    """Source rows around the wanted keys: ranges of them are pushed to the source as predicates.

    Tables whose keys are all text are read whole. The caller still joins, as ranges hold other keys too.
    """
    key = range_key(wanted, keys)
    if key is None:
        return source.read(table, columns)
    near = near_keys(wanted, key, ranges)
    return source.read(table, columns, F.lit(False) if near is None else near)


def split_ranges(bounds: DataFrame, partitions: int) -> DataFrame:
    """The key ranges a split read would ask for, one row per connection."""
    step = F.floor((F.col("hi") - F.col("lo") + 1) / F.lit(partitions)).cast("bigint")
    parts = bounds.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))))
    return parts.select(
        "part",
        (F.col("lo") + F.col("part") * step).alias("from_key"),
        F.when(F.col("part") == partitions - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("part") + 1) * step - 1)
        .alias("to_key"),
    )
