"""Type names used in table specs."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.nested import is_nested, losses, read_text

# The spelled-out type names a table spec may use.
NAMED_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def spark_type(name: str) -> T.DataType:
    """Resolve a spec's type name.

    Besides the names above any Spark DDL type is accepted (``decimal(18,2)``,
    ``array<int>``, ``struct<a:int>``, ``variant``), which is also how nested types get the
    element types they need. Unknown names raise instead of turning into string.
    """
    key = name.strip().lower()
    if key in NAMED_TYPES:
        return NAMED_TYPES[key]
    try:
        parsed = T.DataType.fromDDL(name)
    except ParseException as error:
        raise ValueError(f"unknown column type {name!r}") from error
    if isinstance(parsed, T.NullType) or parsed == T.StructType([]):
        raise ValueError(f"column type {name!r} holds no values")
    return parsed


# Texts a cast may accept; whatever these patterns refuse, Spark's casts refuse too.
_EDGE = r"[\x00-\x20\x7f]*"
INTEGRAL_TEXT = rf"^{_EDGE}[+-]?[0-9]+{_EDGE}$"
DECIMAL_TEXT = r"^[\p{Nd}.+\-eE\x00-\x20\x7f]+$"
FLOATING_TEXT = r"^[0-9a-fA-FxXpP.+\-itynITYN\x00-\x20\x7f]+$"
BOOLEAN_TEXT = rf"^{_EDGE}(?i:t|true|y|yes|1|f|false|n|no|0){_EDGE}$"
NARROW_BITS = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32}


def fitting_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast`` that stays fast on columns full of values that do not fit.

    A failed numeric or boolean ``try_cast`` raises and catches an exception
    per row, tens of microseconds each, so values that cannot fit are turned
    into NULL before the cast sees them. Text is read as JSON where the target
    is nested.
    """
    if isinstance(source, T.StringType) and is_nested(target):
        return read_text(value, target)
    guard = _may_fit(value, source, target)
    return (value if guard is None else F.when(guard, value)).try_cast(target)


def cast_losses(value: Column, source: T.DataType, target: T.DataType) -> dict[str, Column]:
    """Per row, how many values ``fitting_cast`` loses on each path; ``""`` is the whole value."""
    if isinstance(source, T.StringType) and is_nested(target):
        return losses(value, target)
    lost = value.isNotNull() & fitting_cast(value, source, target).isNull()
    return {"": lost.cast("long")}


def _may_fit(value: Column, source: T.DataType, target: T.DataType) -> Column | None:
    if isinstance(source, T.StringType):
        for kind, pattern in (
            (T.IntegralType, INTEGRAL_TEXT),
            (T.DecimalType, DECIMAL_TEXT),
            (T.FractionalType, FLOATING_TEXT),
            (T.BooleanType, BOOLEAN_TEXT),
        ):
            if isinstance(target, kind):
                return value.rlike(pattern)
    elif isinstance(source, T.IntegralType) and target in NARROW_BITS:
        limit = 1 << (NARROW_BITS[target] - 1)
        return (value >= F.lit(-limit)) & (value < F.lit(limit))
    return None
