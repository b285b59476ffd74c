"""The least type that holds mixed JSON numbers exactly.

Numbers form a lattice: whole numbers below decimals of more digits below doubles. How far up a field is follows from two
maxima over its values, the digits before and after the point, so parts of the data can be judged apart and joined.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimals with so many digits come back from a double as they were.
DOUBLE_DIGITS = 15
MOST_DIGITS = 38
_LONG_DIGITS = 18  # of which every number fits into a long


@dataclass(frozen=True)
class NumberShape:
    """What a field's numbers need: digits before and after the point, whether some were written with a fraction or
    exponent, and whether some fit no decimal."""

    whole: int = 0
    scale: int = 0
    fraction: bool = False
    huge: bool = False

    def join(self, other: NumberShape) -> NumberShape:
        """The least shape above both: associative, with the empty shape as its neutral element."""
        return NumberShape(max(self.whole, other.whole), max(self.scale, other.scale),
                           self.fraction or other.fraction, self.huge or other.huge)

    @property
    def dtype(self) -> T.DataType:
        """Long or a wide decimal for whole numbers; a double where it gives every value back; else an exact decimal, or a
        double where none has the digits."""
        if self.huge:
            return T.DoubleType()
        if not self.fraction:
            if self.whole <= _LONG_DIGITS:
                return T.LongType()
            return T.DecimalType(self.whole, 0) if self.whole <= MOST_DIGITS else T.DoubleType()
        if self.whole + self.scale <= DOUBLE_DIGITS or self.whole + self.scale > MOST_DIGITS:
            return T.DoubleType()
        return T.DecimalType(self.whole + self.scale, self.scale)


def number_shape(value: Column, schema: Column) -> dict[str, Column]:
    """Aggregates over a variant column for the parts of a :class:`NumberShape`; ``schema`` is each value's schema text.

    Other values than numbers count for nothing. A double counts as the decimal it is written as, if that has up to 18
    digits after the point and 20 before it.
    """
    is_double = schema.isin("DOUBLE", "FLOAT")
    double = F.try_variant_get(value, "$", "double")
    exact = F.when(is_double, double.cast("string").try_cast("decimal(38,18)"))
    text = F.when(is_double, exact.cast("string")).when(
        (schema == "BIGINT") | schema.startswith("DECIMAL"), F.try_variant_get(value, "$", "string"))
    whole = F.length(F.regexp_extract(text, r"^-?0*(\d*)", 1))
    scale = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1))
    # A decimal without digits after the point is a whole number only if it is too wide for a long.
    fraction = is_double | (schema.startswith("DECIMAL") & ~schema.rlike(r"^DECIMAL\((19|[23]\d),0\)$"))
    return {
        "whole": F.coalesce(F.max(whole), F.lit(0)), "scale": F.coalesce(F.max(scale), F.lit(0)),
        "fraction": F.coalesce(F.bool_or(fraction), F.lit(False)),
        "huge": F.coalesce(F.bool_or(is_double & ~F.coalesce(exact.cast("double") == double, F.lit(False))), F.lit(False)),
    }


def number_type(dtypes: Iterable[T.DataType]) -> T.DataType | None:
    """The least type above several number types; None if one is no number, or where no type holds them all exactly."""
    shapes = []
    for dtype in dtypes:
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            shapes.append(NumberShape(19))
        elif isinstance(dtype, T.DecimalType):
            shapes.append(NumberShape(dtype.precision - dtype.scale, dtype.scale, dtype.scale > 0))
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            shapes.append(NumberShape(20, 18, True))  # as number_shape() takes them
        else:
            return None
    joined = reduce(NumberShape.join, shapes, NumberShape()).dtype
    return joined if isinstance(joined, T.DecimalType) else None
