"""Dates and times that arrive as text: epoch numbers of unknown unit, day counts, or ISO strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = "^-?[0-9]+$"
# Below each bound an epoch number counts in the unit named; above all, nanoseconds.
_SECONDS_BELOW = 10**11
_MILLIS_BELOW = 10**14
_MICROS_BELOW = 10**17


def decode_timestamp(text: Column, unit: str | None = None) -> Column:
    """Text to an instant. The unit follows from the size of the number unless ``unit`` names it.

    Junk gives NULL, never an error: one bad value must not fail a whole table.
    """
    number = text.try_cast("decimal(38,0)")
    whole = number.try_cast("bigint")
    forms = {
        "s": F.timestamp_seconds(whole),
        "ms": F.timestamp_millis(whole),
        "us": F.timestamp_micros(whole),
        "ns": F.timestamp_micros((number / F.lit(1000)).try_cast("bigint")),
    }
    size = F.abs(number)
    by_size = (
        F.when(size < _SECONDS_BELOW, forms["s"])
        .when(size < _MILLIS_BELOW, forms["ms"])
        .when(size < _MICROS_BELOW, forms["us"])
        .otherwise(forms["ns"])
    )
    return F.when(text.rlike(_DIGITS), forms[unit] if unit else by_size).otherwise(F.try_to_timestamp(text))


def decode_date(text: Column) -> Column:
    """Day count since 1970-01-01, or ISO text, to a date; junk gives NULL."""
    days = F.date_add(F.lit("1970-01-01").cast("date"), text.try_cast("int"))
    return F.when(text.rlike(_DIGITS), days).otherwise(F.try_to_timestamp(text).cast("date"))


def decode_temporals(
    df: DataFrame, kinds: dict[str, str], units: dict[str, str] | None = None
) -> DataFrame:
    """Decode the named text columns to ``date``, ``timestamp`` or ``timestamp_ntz`` in one projection."""
    units = units or {}

    def decoded(name: str, kind: str) -> Column:
        text = F.col(f"`{name}`")
        instant = decode_date(text) if kind == "date" else decode_timestamp(text, units.get(name))
        return instant.cast(kind)

    return df.withColumns({name: decoded(name, kind) for name, kind in kinds.items()}) if kinds else df
