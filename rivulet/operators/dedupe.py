"""One row per key: latest operation wins, repeatable removal of duplicates, and duplicate reports.

A key may hold a large share of all rows. ``row_number() = 1`` plans as a group limit on both sides of
the shuffle, so each map task sends at most one row per key and no task meets the whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.keys import canonical_keys, fold
from rivulet.session import settle

_RANK = "_rivulet_rank"


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _orderable(df: DataFrame, skip: set[str]) -> list[Column]:
    """All remaining columns as a last tie-break, so that a rerun keeps the same row."""
    return [
        F.col(f"`{f.name}`").asc_nulls_last()
        for f in df.schema.fields
        if f.name not in skip and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def latest_op_wins(
    df: DataFrame, keys: list[str], log_position: str = "commit_lsn", sequence: str = "stage_seq"
) -> DataFrame:
    """Keep the change with the highest log position (missing ones last), then the highest sequence.

    Keys are made canonical first: two spellings of one key are one row downstream.
    """
    order = [F.col(log_position).desc_nulls_last(), F.col(sequence).desc_nulls_last()]
    rest = _orderable(df, {*keys, log_position, sequence})
    return first_per_key(canonical_keys(df, keys), keys, order + rest)


def drop_duplicate_keys(
    df: DataFrame, keys: list[str], prefer: list[Column] | None = None
) -> DataFrame:
    """One row per key. Which one is fixed by ``prefer`` and then by all other columns."""
    return first_per_key(df, keys, (prefer or []) + _orderable(df, set(keys)))


def duplicate_keys(df: DataFrame, keys: list[str], fold_case: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count. Counting combines on the map side."""
    columns = [(fold(df, k) if fold_case else F.col(f"`{k}`")).alias(k) for k in keys]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


class DuplicateKeys(ValueError):
    """A source has several rows for one merge key; ``keys`` lists some of them."""

    def __init__(self, keys: list[dict]):
        super().__init__(f"more than one source row for keys {keys}")
        self.keys = keys


def require_unique(
    df: DataFrame, keys: list[str], null_safe: bool = True, fold_case: bool = True, named: int = 5
) -> DataFrame:
    """Fail when two rows share a merge key: a table change with two sources per row is ambiguous.

    Without ``null_safe`` rows with a NULL key match nothing, so they cannot clash.
    """
    rows = df if null_safe else df.dropna(subset=keys)
    clash = duplicate_keys(rows, keys, fold_case=fold_case).limit(named).collect()
    if clash:
        raise DuplicateKeys([r.asDict() for r in clash])
    return df


_TWICE = "more than one source row for a merge key"


def settle_unique(
    df: DataFrame, keys: list[str], label: str = "settled", null_safe: bool = True, fold_case: bool = True
) -> DataFrame:
    """Settle ``df`` and fail when two rows share a merge key, in the one job that writes it.

    Rows are numbered per key as they are written; the first second row ends the job. Only then are the keys
    counted, to name some of them.
    """
    by = [fold(df, k) if fold_case else F.col(f"`{k}`") for k in keys]
    # a running number: no task holds a group
    number = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))
    clash = number > 1
    if not null_safe:
        clash = clash & reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    checked = df.withColumn(_RANK, F.when(clash, F.raise_error(F.lit(_TWICE)).cast("int")).otherwise(1))
    try:
        return settle(checked, label).drop(_RANK)
    except PySparkException as e:
        if _TWICE not in str(e):
            raise
    require_unique(df, keys, null_safe, fold_case)
    raise DuplicateKeys([])
