"""What is new in a landing tree, found by a file stream whose checkpoint remembers what was seen."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sources.landing import PARTS

FILES = "path string, modificationTime timestamp, length bigint, content binary"
FOUND = "tenant_id int, schema_name string, table_name string, batch_id bigint, files bigint, bytes bigint, look bigint"


class LandingWatch:
    """Looks at the tree ``base`` and keeps under ``state`` what it has found, look by look.

    A look drains the stream: it takes up the files that no look has seen and writes their folders as one partition,
    which a retry replaces. Only names and sizes are read. ``forget_after`` bounds how long the stream remembers a file; an
    older file that turns up later is not taken up.
    """

    def __init__(self, spark: SparkSession, base: str, state: str, forget_after: str = "3650d"):
        self._spark, self._base, self._state, self._forget = spark, base.rstrip("/"), state.rstrip("/"), forget_after

    def look(self) -> DataFrame:
        """Folders with files that were not there at any earlier look: :data:`FOUND`."""
        before = self._last()
        tree = "/".join([self._base, *[f"{p}=*" for p in PARTS]])
        files = (
            self._spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.parquet")
            .option("maxFileAge", self._forget).load(tree)
        )

        def keep(batch: DataFrame, look: int) -> None:
            part = lambda p: F.regexp_extract("path", f"/{p}=([^/]*)/", 1)
            names = [F.url_decode(part(p)).cast({"tenant_id": "int", "batch_id": "bigint"}.get(p, "string")).alias(p) for p in PARTS]
            folders = batch.select(*names, "length").groupBy(*PARTS).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            folders.coalesce(1).write.mode("overwrite").parquet(f"{self._state}/found/look={look}")

        writer = files.writeStream.foreachBatch(keep).option("checkpointLocation", f"{self._state}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
        return self.found().filter(F.col("look") > before)

    def found(self) -> DataFrame:
        """Every folder found so far, once for each look that found files in it."""
        try:
            return self._spark.read.schema(FOUND).parquet(f"{self._state}/found")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], FOUND)

    def _last(self) -> int:
        top = self.found().agg(F.max("look")).first()[0]
        return -1 if top is None else top


def batch_states(found: DataFrame, loaded: DataFrame, marks: DataFrame) -> DataFrame:
    """LOADED, PENDING or LATE for every batch that was found.

    ``loaded`` has the batches that runs have loaded (:data:`PARTS`). A batch that is not among them but not above its
    table's mark came late: a plain comparison with the mark would skip it for ever, and loading it would put old rows over
    newer ones. It is for a replay to decide.
    """
    every = found.select(*PARTS).distinct()
    done = loaded.select(*PARTS).distinct().withColumn("_done", F.lit(True))
    held = marks.select("tenant_id", "schema_name", F.col("source_table").alias("table_name"), "last_batch_id")
    state = (
        F.when(F.col("_done"), "LOADED").when(F.col("batch_id") <= F.col("last_batch_id"), "LATE").otherwise("PENDING")
    )
    return every.join(done, PARTS, "left").join(held, PARTS[:-1], "left").select(*PARTS, state.alias("state"))
