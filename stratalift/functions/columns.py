"""Small column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESERVED_PREFIX = "Row_"
FIELD_SEPARATOR = "||"
BLANK_PATTERN = r"^\s*$"
NARROW_WIDTH = 64


def quoted(name: str) -> str:
    """Back-quote a column name, as audit and renamed columns hold hyphens and dots."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def is_reserved(name: str) -> bool:
    return name.startswith(RESERVED_PREFIX)


def regular_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if not is_reserved(c)]


def reserved_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if is_reserved(c)]


def regex_match(column: Column, pattern: str) -> Column:
    """True where the column's text contains a match of the (Java) pattern."""
    return column.cast("string").rlike(pattern)


def blank_match(column: Column) -> Column:
    """True for empty or whitespace-only text; NULL stays NULL."""
    return regex_match(column, BLANK_PATTERN)


def local_time_text(column: Column, hours: int = 8) -> Column:
    """Timestamp moved by a fixed zone offset, as ``yyyy-MM-dd hh:mm:ss AM/PM`` text."""
    shifted = column + F.make_dt_interval(hours=F.lit(hours))
    return F.date_format(shifted, "yyyy-MM-dd hh:mm:ss a")


def holds(kind: T.DataType, *wanted: type[T.DataType]) -> bool:
    """Whether a type is, or has inside, one of the wanted ones."""
    if isinstance(kind, wanted):
        return True
    if isinstance(kind, T.ArrayType):
        return holds(kind.elementType, *wanted)
    if isinstance(kind, T.MapType):
        return holds(kind.keyType, *wanted) or holds(kind.valueType, *wanted)
    return isinstance(kind, T.StructType) and any(holds(f.dataType, *wanted) for f in kind)


def sorted_maps(value: Column, kind: T.DataType) -> Column:
    """The value with the entries of all maps in it in the order of their keys.

    Equal maps can hold their entries in any order, so their texts differ without this.
    """
    if not holds(kind, T.MapType):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: sorted_maps(e, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [sorted_maps(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    keys = F.array_sort(F.map_keys(value))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: sorted_maps(value[k], kind.valueType)))


def comparable(value: Column, kind: T.DataType) -> Column:
    """A value that groups and sorts as the given one, also where that has maps or variants in it.

    Maps become lists of their entries in the order of the keys, variants their JSON text.
    """
    if not holds(kind, T.MapType, T.VariantType):
        return value
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [comparable(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    keys = F.array_sort(F.map_keys(value))
    return F.transform(keys, lambda k: F.struct(k.alias("key"), comparable(value[k], kind.valueType).alias("value")))


def narrow(df: DataFrame, name: str) -> Column:
    """A comparison key for the column that is never wider than a digest.

    Long strings are replaced by their SHA-256, short ones kept, so that a
    shuffle on the key carries at most 65 bytes for a document of any length.
    A value that looks like a digest is itself long enough to be digested, so
    the two kinds cannot meet.
    """
    kind = df.schema[name].dataType
    value = comparable(col(name), kind)
    if not isinstance(kind, T.StringType):
        return value
    return F.when(
        F.length(value) > NARROW_WIDTH, F.concat(F.lit("#"), F.sha2(value, 256))
    ).otherwise(value)


def row_text(df: DataFrame, strict: bool = False) -> Column:
    """The row's regular columns, in column order, joined with ``||``.

    The default skips NULLs, as ``concat_ws`` does, so ``(a, NULL, b)`` and
    ``(a, b)`` read the same. ``strict`` writes every field as its length and
    text, and NULL as ``~``, so that only equal rows have equal text. Maps are
    written in the order of their keys.
    """
    names = regular_columns(df.columns)
    texts = [sorted_maps(col(name), df.schema[name].dataType).cast("string") for name in names]
    if not strict:
        # concat_ws joins the elements of a string array itself
        texts = [
            col(name) if df.schema[name].dataType == T.ArrayType(T.StringType()) else text
            for name, text in zip(names, texts, strict=True)
        ]
    else:
        texts = [
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))
            for text in texts
        ]
    return F.concat_ws(FIELD_SEPARATOR, *texts)
