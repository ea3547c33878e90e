"""A lattice of column types: the narrowest type that holds the values of two.

    byte < short < int < long < decimal < double < string
    float < double        date < timestamp without zone < timestamp < string        boolean, binary < string

Types of different lines meet in string; decimals that would need more than 38 digits meet in double. Joining is
associative and commutative, so the order in which batches come does not matter.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.model import by_lower_name

# How many digits a whole-number type may have.
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_WHOLE = list(DIGITS)
_TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _decimal(whole: int, scale: int) -> T.DataType:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for x in (a, b):
        if isinstance(x, _NESTED):
            raise TypeError(f"no common type for {a.simpleString()} and {b.simpleString()}")
    for line in (_WHOLE, _TIMES):
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        shapes = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (DIGITS[x], 0) for x in (a, b)]
        return _decimal(max(w for w, _ in shapes), max(s for _, s in shapes))
    return T.StringType()


def joined(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of all schemas, in the order in which they first come, each with the type that holds them all.

    Names match without regard to case; the first spelling stays.
    """

    def add(held: T.StructType, more: T.StructType) -> T.StructType:
        new = {f.name.lower(): f for f in more.fields}
        both = [T.StructField(f.name, wider(f.dataType, new[f.name.lower()].dataType) if f.name.lower() in new else f.dataType) for f in held.fields]
        known = by_lower_name(held.names)
        return T.StructType(both + [T.StructField(f.name, f.dataType) for f in more.fields if f.name.lower() not in known])

    return reduce(add, schemas, T.StructType())


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the types of ``schema`` for the columns it has; none is added."""
    kinds = {f.name.lower(): f for f in schema.fields}
    return df.select(
        *[F.col(f"`{c}`").cast(kinds[c.lower()].dataType).alias(kinds[c.lower()].name) if c.lower() in kinds else F.col(f"`{c}`") for c in df.columns]
    )
