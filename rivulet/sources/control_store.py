"""What runs decide, kept as one folder per output and run.

A run writes all its rows of an output at once into its own folder, so a run that is done again replaces them. What
holds now (marks, cursors, the gate) is read off all runs: marks never go back, the latest cursor counts, a batch
stays registered by the run that opened it first.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import model
from rivulet.model import align_schema

RUN = "_run"
LAG = model.shape(
    "source_schema string, source_table string, rows_processed bigint, newest_source_commit timestamp, "
    "oldest_source_commit timestamp, median_lag_s bigint, max_lag_s bigint, lag_sketch binary"
)
OUTPUTS: dict[str, T.StructType] = {
    "header": model.RUN_HEADER,
    "detail": model.RUN_DETAIL,
    "dead_letter": model.DEAD_LETTER,
    "lag": LAG,
    "mark": model.WATERMARK,
    "cursor": model.CURSOR,
    "gate": model.GATE,
    "ghost_report": model.GHOST_REPORT,
    "doomed": model.DOOMED_KEYS,
    "fill_report": model.FILL_REPORT,
    "full_load_report": model.FULL_LOAD_REPORT,
}


class ControlStore:
    """Control tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self._root = spark, root.rstrip("/")

    @staticmethod
    def schema(output: str) -> T.StructType:
        return OUTPUTS[output]

    def path(self, output: str) -> str:
        return f"{self._root}/{output}"

    def write(self, output: str, run_id: str, rows: DataFrame) -> None:
        """A run's rows of one output; they replace what the run had written."""
        laid = align_schema(rows, OUTPUTS[output])
        laid.write.mode("overwrite").parquet(f"{self.path(output)}/{RUN}={run_id}")

    def read(self, output: str, besides: str | None = None) -> DataFrame:
        """The rows of all runs, but for those of ``besides``."""
        schema = OUTPUTS[output]
        try:
            rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])).parquet(self.path(output))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return model.empty(self.spark, schema)
        rows = rows if besides is None else rows.filter(F.col(RUN) != besides)
        return rows.select(*schema.names)

    def marks(self, besides: str | None = None) -> DataFrame:
        """Per table the highest batch that any run has loaded, and when."""
        keys = ["tenant_id", "schema_name", "source_table"]
        rows = self.read("mark", besides).groupBy(*keys).agg(F.max(F.struct("last_batch_id", "updated_on")).alias("top"))
        return rows.select(*keys, "top.last_batch_id", "top.updated_on")

    def cursors(self, besides: str | None = None) -> DataFrame:
        """Per staged table the place that was written last."""
        keys = ["tenant_id", "source_schema", "source_table"]
        rows = self.read("cursor", besides).groupBy(*keys).agg(
            F.max(F.struct("updated_on", "last_stage_seq", "last_batch_id")).alias("top")
        )
        return rows.select(*keys, "top.last_stage_seq", "top.last_batch_id", "top.updated_on")

    def gate(self, besides: str | None = None) -> DataFrame:
        """Per batch the run that opened it first."""
        rows = self.read("gate", besides).groupBy("batch_id").agg(F.min(F.struct("completed_ts", "execution_id")).alias("first"))
        return rows.select("batch_id", "first.completed_ts", "first.execution_id")
