"""Exact duplicates by a tree merge of sorted digest runs.

Every row gets a fingerprint of its text and falls into one of ``runs`` runs by its id. A run holds one
row per fingerprint, sorted: the id that stays and the number of copies. In each round ``radix``
neighbouring runs are exchanged by fingerprint and merged into one, until one run is left. No task
ever reads more than ``radix`` rows of one fingerprint, however many copies a text has. On the way back
the winners meet the first runs, so that the rows of a hot text are joined in as many parts as there
are runs.

A fingerprint is SHA-256, length in bytes and xxHash64 together: rows merge at any level only if all
three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import text_or_empty
from rivulet.session import settle

PRINT = ["sha", "n_bytes", "xx"]


def _print(text: Column) -> list[Column]:
    return [
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("xx"),
    ]


def merge_runs(rows: DataFrame, runs: int, radix: int, keep: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (run, fingerprint, best, n) as first runs, and as the single run at the root."""
    best = F.max("best") if keep == "max" else F.min("best")

    def merged(df: DataFrame, run: Column) -> DataFrame:
        return df.groupBy(run.alias("run"), *PRINT).agg(best.alias("best"), F.sum("n").alias("n"))

    first = settle(merged(rows, F.col("run")), "runs")
    root = first
    while runs > 1:
        root = merged(root, F.floor(F.col("run") / radix).cast("int"))
        runs = -(-runs // radix)
    return first, root.drop("run")


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "max",
    runs: int = 64,
    radix: int = 4,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null text counts as empty; empty texts are a group of their own. A null id loses to any other. Of
    rows that repeat text and id, exactly one is kept. An empty table gives an empty result; other
    columns are not read.
    """
    text = text_or_empty(text_column)
    rows = settle(
        docs.select(
            F.col(id_column).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.pmod(F.xxhash64(F.col(id_column)), F.lit(runs)).cast("int").alias("run"),
            *_print(text),
        ),
        "digests",
    )
    # nulls sort first: the flag keeps them last for either order
    known = F.col("id").isNotNull() if keep == "max" else F.col("id").isNull()
    single = rows.select("run", *PRINT, F.struct(known, "id", "row").alias("best"), F.lit(1).cast("bigint").alias("n"))
    first, root = merge_runs(single, runs, radix, keep)
    winners = first.select("run", *PRINT).join(root, PRINT)
    return rows.join(winners, ["run", *PRINT]).select(
        F.col("id").alias(id_column),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, one for each different text."""
    found = exact_dedup(docs, id_column, text_column, **options).where("kept").select(
        F.col(id_column).alias("id"), F.unhex("text_sha256").alias("sha")
    )
    text = text_or_empty(text_column)
    held = docs.select(
        F.struct("*").alias("doc"), F.col(id_column).alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha")
    )
    kept = held.join(found, held["id"].eqNullSafe(found["id"]) & (held["sha"] == found["sha"]), "left_semi")
    # rows that repeat id and text are still as many; there are few, so only they are made distinct
    again = settle(held.groupBy("id", "sha").count().where("count > 1").select("id", "sha"), "repeats")
    same = kept["id"].eqNullSafe(again["id"]) & (kept["sha"] == again["sha"])
    once = kept.join(again, same, "left_anti")
    repeats = kept.join(again, same, "left_semi").dropDuplicates(["id", "sha"])
    return once.unionByName(repeats).select("doc.*")
