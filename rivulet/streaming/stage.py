"""Stream ingest: read change messages, add the envelope, append one slice per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.payload import stage_envelope, tenant_cross_check
from rivulet.streaming.ledger import Stage, in_sequence, source_places

MESSAGE = "value binary, timestamp timestamp, partition int, offset bigint"


def read_changes(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """Change messages as a stream of ``(value, timestamp, source_partition, source_offset)``.

    ``kafka`` takes the broker's options; data loss does not stop it unless asked to. Any other kind is
    a file format (``parquet``, ``json``) with a ``path``, whose writer put partition and offset into the
    rows; parquet rows without them stand at their place in their file.
    """
    if kind == "kafka":
        settings = {"failOnDataLoss": "false", "startingOffsets": "latest", **options}
        raw = spark.readStream.format("kafka").options(**settings).load()
        return raw.select("value", "timestamp", *_place(F.concat_ws("/", "topic", "partition"), F.col("offset")))
    path = options.pop("path")
    raw = spark.readStream.schema(MESSAGE).format(kind).options(**options).load(path)
    if kind != "parquet":
        return raw.select("value", "timestamp", *_place(F.col("partition"), F.col("offset")))
    told = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return raw.select(
        "value", "timestamp",
        *_place(
            F.when(told, F.col("partition").cast("string")).otherwise(F.col("_metadata.file_path")),
            F.when(told, F.col("offset")).otherwise(F.col("_metadata.row_index")),
        ),
    )


def _place(partition: Column, offset: Column) -> list[Column]:
    return [partition.cast("string").alias("source_partition"), offset.cast("bigint").alias("source_offset")]


@dataclass(frozen=True)
class StageRun:
    """What one ingest run stamps on its rows."""

    tenant_id: int
    default_schema: str
    expected_db: str
    batch_id: int
    run_id: str
    stage_path: str
    stream_id: str
    ingest_ts: Column | None = None

    def enveloped(self, messages: DataFrame, micro_batch_id: int) -> DataFrame:
        """Envelope and filters for one micro-batch."""
        return tenant_cross_check(
            stage_envelope(
                messages,
                tenant_id=self.tenant_id,
                default_schema=self.default_schema,
                batch_id=self.batch_id,
                micro_batch_id=micro_batch_id,
                run_id=self.run_id,
                ingest_ts=self.ingest_ts,
            ),
            self.expected_db,
        )

    def append_batch(self, messages: DataFrame, micro_batch_id: int) -> None:
        """Stage one micro-batch. A retry replaces its own folder, so rows land once and keep their sequences.

        The folder is named by the stream (one per checkpoint) and the micro-batch, because micro-batch
        numbers start over with a new checkpoint. Sequences go on from the highest one that the ledger knows, by
        whichever stream, so a stage has one writer at a time.
        """
        spark = messages.sparkSession
        # one instant for the whole micro-batch: it settles as a whole
        at = spark.range(1).select((F.current_timestamp() if self.ingest_ts is None else self.ingest_ts)).first()[0]
        Stage(spark, self.stage_path).put(
            self.enveloped(messages, micro_batch_id), tenant_id=self.tenant_id, stream_id=self.stream_id,
            micro_batch_id=micro_batch_id, ingest_ts=at,
        )


def sequenced(rows: DataFrame, base: int = 0) -> DataFrame:
    """Arrival sequence above ``base``: partition after partition, in each by the source's offsets.

    All changes of one key come through one partition, so offsets tell their order even where log position
    and time are equal. Only the offset range of each partition passes through the driver. Rows without partition or
    offset are refused.
    """
    return in_sequence(rows, source_places(rows, base))


def start_staging(
    changes: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Drain what is there and stop, or keep going with a trigger interval.

    The checkpoint owns the offsets. To start over, name a new checkpoint (and stream id).
    """
    writer = changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """All staged rows, whichever stream wrote them."""
    return Stage(spark, path).rows()
