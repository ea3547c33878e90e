"""Key spelling: string keys are stored in lower case and compared without regard to case."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def fold(df: DataFrame, name: str) -> Column:
    """The column as a comparable key: upper case for text, untouched for anything else."""
    column = F.col(f"`{name}`")
    return F.upper(column) if is_text(df, name) else column


def canonical_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Store text keys in lower case so two spellings of one key cannot both live in a table."""
    text = [k for k in keys if is_text(df, k)]
    return df.withColumns({k: F.lower(F.col(f"`{k}`")) for k in text}) if text else df


def same_key(left: list[Column], right: list[Column], null_safe: bool = True) -> Column:
    """Pairwise key match; ``<=>`` still plans as an equi join, so it hashes and sorts like ``=``."""
    pairs = [(a.eqNullSafe(b) if null_safe else a == b) for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x & y, pairs)
