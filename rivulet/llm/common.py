"""What the operators share: the word pattern, input columns, folds, and sub-batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word: what ASCII white space leaves
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id belongs to fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on ``parts`` only: 52 bits of their hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 12) / F.lit(float(1 << 52))


def slices(batch, rows: int = 500) -> Iterator:
    """An Arrow batch in parts of a few hundred rows, so that a task never unpacks a whole batch.

    After each batch Arrow gives back what it holds unused: workers outlive their tasks, and would keep it.
    """
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)
    pa.default_memory_pool().release_unused()


def binaries(batch, column: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [v or b"" for v in batch.column(column).cast("binary").to_pylist()]
