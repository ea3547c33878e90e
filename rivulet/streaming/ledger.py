"""The stage and its ledger: what was staged when, what is acknowledged, and where the rest lies.

Every micro-batch leaves one record: the place it reached in each partition of its source, the range of sequences
that is its own, and per staged table the rows and sequences it brought (its segments). The record is written
after the rows and makes them count. The next micro-batch takes its sequences from the ledger, a claim takes its
boundary, its tables and its folders from there, and depth is counted there: none of them reads staged rows.

Acknowledging writes sequence ranges per table and rewrites no staged row. Micro-batches settle as a whole, so a table
that ended well has all sequences of settled micro-batches behind it; ranges that touch are one. A later claim opens
only the folders in which a table to be run has a segment that no range covers.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import model
from rivulet.functions.keys import same_key
from rivulet.operators import control
from rivulet.session import settle
from rivulet.sources.sinks import balanced

FOLDER = ["tenant_id", "ingest_date", "stream_id", "micro_batch_id"]
RECORD = (
    "stream_id string, micro_batch_id bigint, tenant_id int, ingest_ts timestamp, base bigint, high_water bigint, "
    "places array<struct<source_partition: string, first_offset: bigint, last_offset: bigint, shift: bigint>>, "
    "segments array<struct<source_schema: string, source_table: string, low: bigint, high: bigint, rows: bigint, "
    "batch_id: bigint>>, ingest_date date"
)
RANGES = "tenant_id int, source_schema string, source_table string, low bigint, high bigint"
TABLE = ["tenant_id", "source_schema", "source_table"]


class LostPlace(ValueError):
    """Messages came without partition or offset: they cannot be put in order."""


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A folder with a known schema, empty before its first file."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def merged_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Closed ranges (low, high) per group, those that overlap or touch made one."""
    by = [F.col(k) for k in keys]
    before = Window.partitionBy(*by).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    reached = ranges.select(*keys, "low", "high", F.max("high").over(before).alias("_reached"))
    begins = F.when(F.col("_reached").isNull() | (F.col("low") > F.col("_reached") + 1), 1).otherwise(0)
    islands = reached.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(upto))
    return islands.groupBy(*keys, "_island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_island")


def outside(rows: DataFrame, ranges: DataFrame, low: Column, high: Column) -> DataFrame:
    """The rows (or segments) of staged tables that no range covers from ``low`` to ``high``. Names match in any case."""
    held = ranges.select(
        F.col("tenant_id").alias("_t"), F.lower(F.trim("source_schema")).alias("_s"), F.lower("source_table").alias("_n"),
        F.col("low").alias("_low"), F.col("high").alias("_high"),
    )
    mine = [F.col("tenant_id"), F.lower(F.trim("source_schema")), F.lower("source_table")]
    match = same_key(mine, [F.col(c) for c in ("_t", "_s", "_n")], null_safe=False)
    return rows.join(held, match & (F.col("_low") <= low) & (F.col("_high") >= high), "left_anti")


def segment_ranges(rows: DataFrame, mine: Column) -> DataFrame:
    """Ranges that cover, table by table, just the staged rows that fulfil ``mine`` (columns of :data:`TABLE`).

    A table without foreign rows between its first and last own row needs no more than those two. Only tables that
    have some are cut: between two of their cuts lies one range.
    """
    names = [F.col("tenant_id"), F.lower(F.trim("source_schema")).alias("source_schema"), F.lower("source_table").alias("source_table")]
    named = rows.select(*names, "stage_seq", F.coalesce(mine, F.lit(False)).alias("mine"))
    spans = named.filter("mine").groupBy(*TABLE).agg(F.min("stage_seq").alias("low"), F.max("stage_seq").alias("high"))
    spans = settle(spans, "spans")
    cuts = named.filter("NOT mine").join(spans, TABLE).filter("stage_seq > low AND stage_seq < high")
    cuts = settle(cuts.select(*TABLE, F.col("stage_seq").alias("cut")).distinct(), "cuts")
    cut_tables = cuts.select(*TABLE).distinct()
    whole = spans.join(cut_tables, TABLE, "left_anti")
    # pieces between cuts, then the own rows in each
    over = Window.partitionBy(*TABLE).orderBy("cut")
    first = spans.join(cut_tables, TABLE, "left_semi").select(*TABLE, (F.col("low") - 1).alias("cut"))
    pieces = cuts.unionByName(first).withColumn("until", F.lead("cut").over(over)).withColumnsRenamed({c: f"_{c}" for c in TABLE})
    inside = same_key([F.col(c) for c in TABLE], [F.col(f"_{c}") for c in TABLE], null_safe=False)
    inside = inside & (F.col("stage_seq") > F.col("cut")) & (F.col("until").isNull() | (F.col("stage_seq") < F.col("until")))
    kept = named.filter("mine").join(pieces, inside).groupBy(*TABLE, "cut").agg(F.min("stage_seq").alias("low"), F.max("stage_seq").alias("high"))
    return whole.unionByName(kept.drop("cut"))


@dataclass
class Claim:
    """The settled part of a tenant's stage that is not acknowledged: its segments, and the ranges to acknowledge."""

    boundary: int | None
    run_batch: int | None
    rows: int
    segments: DataFrame
    ranges: list[tuple[int, int]]


class Stage:
    """Staged rows below ``path``, in folders by tenant, date, stream and micro-batch; the ledger lies beside it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")

    # what was staged

    def records(self) -> DataFrame:
        """One row per micro-batch."""
        return _read(self._spark, f"{self.path}.ledger", RECORD)

    def standing(self, stream_id: str, micro_batch_id: int) -> tuple[int, tuple[int, datetime] | None]:
        """The highest sequence given out, and base and time of a micro-batch that has its record already."""
        own = (F.col("stream_id") == stream_id) & (F.col("micro_batch_id") == micro_batch_id)
        row = self.records().agg(
            F.max("high_water").alias("top"), F.max(F.when(own, F.struct("base", "ingest_ts"))).alias("own")
        ).first()
        return row["top"] or 0, row["own"] and (row["own"]["base"], row["own"]["ingest_ts"])

    def folder(self, tenant_id: int, ingest_date: date, stream_id: str, micro_batch_id: int) -> str:
        values = (tenant_id, ingest_date.isoformat(), stream_id, micro_batch_id)
        return "/".join([self.path, *[f"{p}={v}" for p, v in zip(FOLDER, values)]])

    def put(self, rows: DataFrame, *, tenant_id: int, stream_id: str, micro_batch_id: int, ingest_ts: datetime | None = None) -> None:
        """Stage enveloped rows that know their place in the source.

        A micro-batch that comes again gets the sequences and the time it had, and replaces its own folder; its
        record stays. A new checkpoint (another stream) goes on above all sequences given out.
        """
        top, own = self.standing(stream_id, micro_batch_id)
        base, at = own or (top, ingest_ts or datetime.now())
        places = source_places(rows, base)
        day = self._spark.range(1).select(F.lit(at).cast("date")).first()[0]  # in the session's time zone
        folder = self.folder(tenant_id, day, stream_id, micro_batch_id)
        placed = in_sequence(rows.withColumn("ingest_ts", F.lit(at)), places).drop(*FOLDER)
        placed.write.mode("overwrite").parquet(folder)
        if own:
            return
        written = self._spark.read.schema(placed.schema).parquet(folder)
        segments = written.groupBy("source_schema", "source_table").agg(
            F.min("stage_seq").alias("low"), F.max("stage_seq").alias("high"), F.count(F.lit(1)).alias("rows"),
            F.max("batch_id").alias("batch_id"),
        ).collect()  # a row per staged table
        high = max([base, *(p[2] + p[3] for p in places)])
        record = (stream_id, micro_batch_id, tenant_id, at, base, high, places, [tuple(s) for s in segments], day)
        one = self._spark.createDataFrame([record], RECORD).coalesce(1)
        one.write.mode("append").partitionBy("ingest_date").parquet(f"{self.path}.ledger")

    def fold(self, before: date) -> None:
        """Put the records of past days into one file a day, so that the ledger does not grow by files.

        To be called once a day, while no cycle reads the ledger.
        """
        old = self.records().filter(F.col("ingest_date") < before)
        old = balanced(old.dropDuplicates(["stream_id", "micro_batch_id"]), "ingest_date")
        old.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(f"{self.path}.ledger")

    def segments(self) -> DataFrame:
        """One row per micro-batch and staged table."""
        return self.records().select(*FOLDER, "ingest_ts", F.inline("segments"))

    def rows(self, folders: Iterable | None = None) -> DataFrame:
        """Staged rows, of all folders or of some (rows of :data:`FOLDER`); others are not listed."""
        names = [f for f in model.STAGE.fields if f.name not in FOLDER]
        kinds = [(c, t) for c, t in zip(FOLDER, (T.IntegerType(), T.DateType(), T.StringType(), T.LongType()))]
        schema = T.StructType(names + [T.StructField(c, t) for c, t in kinds])
        if folders is None:
            return _read(self._spark, self.path, schema)
        paths = [self.folder(*f) for f in folders]
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    # what is acknowledged

    def acknowledged(self, besides: str | None = None) -> DataFrame:
        """Ranges per table from all runs, merged. ``besides`` leaves out a run that is about to be done again."""
        acks = _read(self._spark, f"{self.path}.acks", f"{RANGES}, _run string")
        acks = acks if besides is None else acks.filter(F.col("_run") != besides)
        return merged_ranges(acks, TABLE)

    def acknowledge(self, run_id: str, ranges: DataFrame) -> None:
        """Write a run's ranges; done again, it replaces them."""
        named = ranges.select("tenant_id", F.lower(F.trim("source_schema")).alias("source_schema"), F.lower("source_table").alias("source_table"), "low", "high")
        named.coalesce(1).write.mode("overwrite").parquet(f"{self.path}.acks/_run={run_id}")

    def open_segments(self, besides: str | None = None) -> DataFrame:
        return outside(self.segments(), self.acknowledged(besides), F.col("low"), F.col("high"))

    def unacknowledged(self, besides: str | None = None) -> DataFrame:
        """The rows that are left: those of open segments. Folders without any are not opened."""
        open_ = self.open_segments(besides).select(*FOLDER).distinct().collect()
        return outside(self.rows(open_), self.acknowledged(besides), F.col("stage_seq"), F.col("stage_seq"))

    def depth(self, besides: str | None = None) -> DataFrame:
        """Tables and rows left per schema."""
        left = self.open_segments(besides).groupBy("source_schema", "source_table").agg(F.sum("rows").alias("n"))
        return left.groupBy("source_schema").agg(F.count("source_table").alias("tables"), F.sum("n").alias("rows"))

    # what a run may take

    def claim(self, tenant_id: int, as_of: Column, grace_minutes: int = 0, besides: str | None = None) -> Claim:
        mine = (F.col("tenant_id") == tenant_id) & control.settled(as_of, grace_minutes)
        open_ = settle(self.open_segments(besides).filter(mine), "open-segments")
        top = open_.agg(
            F.max("high").alias("boundary"), F.max("batch_id").alias("batch"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
        ).first()
        reserved = self.records().filter(mine & (F.col("high_water") > F.col("base"))).select((F.col("base") + 1).alias("low"), F.col("high_water").alias("high"))
        ranges = [tuple(r) for r in merged_ranges(reserved, []).orderBy("low").collect()]
        return Claim(top["boundary"], top["batch"], top["rows"], open_, ranges)

    def claimed_rows(self, claim: Claim, tables: DataFrame, besides: str | None = None) -> DataFrame:
        """Rows of the claim that belong to ``tables`` (``_schema``, ``_table``, both folded)."""
        folded = {"_schema": F.lower(F.trim("source_schema")), "_table": F.lower("source_table")}
        wanted = claim.segments.withColumns(folded).join(tables, ["_schema", "_table"], "left_semi")
        # a row per open micro-batch
        rows = self.rows(wanted.select(*FOLDER).distinct().collect())
        left = outside(rows, self.acknowledged(besides), F.col("stage_seq"), F.col("stage_seq"))
        return left.withColumns(folded).join(tables, ["_schema", "_table"], "left_semi")


def source_places(rows: DataFrame, base: int) -> list[tuple[str, int, int, int]]:
    """(partition, first offset, last offset, shift) of each partition of the source; sequences are offset plus shift.

    Partition after partition, by the time their first message came. Rows without a place are refused.
    """
    ranges = (
        rows.groupBy("source_partition")
        .agg(
            F.min("eh_enqueued_ts").alias("began"), F.min("source_offset").alias("low"), F.max("source_offset").alias("high"),
            F.count(F.lit(1)).alias("n"), F.count("source_offset").alias("known"),
        )
        .orderBy("began", "source_partition").collect()
    )
    lost = sum(r["n"] if r["source_partition"] is None else r["n"] - r["known"] for r in ranges)
    if lost:
        raise LostPlace(f"{lost} messages without partition or offset")
    places, at = [], base + 1
    for r in ranges:
        places.append((r["source_partition"], r["low"], r["high"], at - r["low"]))
        at += r["high"] - r["low"] + 1
    return places


def in_sequence(rows: DataFrame, places: list[tuple[str, int, int, int]]) -> DataFrame:
    """Rows with their ``stage_seq``. No row is sorted or shuffled for it."""
    # a row for each partition of the source that the micro-batch reads
    shift = rows.sparkSession.createDataFrame([(p, s) for p, _, _, s in places], "_partition string, _shift bigint")
    placed = rows.join(F.broadcast(shift), F.col("source_partition") == F.col("_partition"))
    return placed.withColumn("stage_seq", F.col("source_offset") + F.col("_shift")).drop("_partition", "_shift")
