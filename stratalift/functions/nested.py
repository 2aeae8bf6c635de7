"""Arrays, maps, structs and variants out of landed JSON text, by the declared type.

The text is parsed once into a variant and then read by the type. What does not
fit is NULL at its own place, not in the whole value: ``[1, "x"]`` as ``array<int>``
is ``[1, NULL]``. Text that is no JSON, or of another shape than the type, is NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The brackets a text has to have; what parses beyond them is not worth the parser's exception.
BRACKETS = {T.ArrayType: r"(?s)^\s*\[.*\]\s*$", T.MapType: r"(?s)^\s*\{.*\}\s*$", T.StructType: r"(?s)^\s*\{.*\}\s*$"}


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (*BRACKETS, T.VariantType))


def check_readable(kind: T.DataType) -> None:
    """JSON objects have text keys, so no other map can be read from text."""
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError(f"a map read from text has text keys, not {kind.keyType.simpleString()}")
        check_readable(kind.valueType)
    elif isinstance(kind, T.ArrayType):
        check_readable(kind.elementType)
    elif isinstance(kind, T.StructType):
        for field in kind:
            check_readable(field.dataType)


def parsed(text: Column, kind: T.DataType) -> Column:
    """The text as a variant, NULL where it is no JSON of that shape."""
    for shape, pattern in BRACKETS.items():
        if isinstance(kind, shape):
            text = F.when(text.rlike(pattern), text)
    return F.try_parse_json(text)


def read_text(text: Column, kind: T.DataType) -> Column:
    """The value of a nested type in a JSON text."""
    check_readable(kind)
    return _read(parsed(text, kind), kind)


def _read(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        return value
    return F.try_variant_get(value, "$", kind.simpleString())


def losses(text: Column, kind: T.DataType) -> dict[str, Column]:
    """How many values each path of a text's value loses: ``""`` is the whole, ``.a`` a field,
    ``[]`` the elements, ``{}`` the values of a map. A value lost on one path is not counted below it."""
    check_readable(kind)
    value = parsed(text, kind)
    read = _read(value, kind)
    found = {"": (text.isNotNull() & read.isNull()).cast("long")}
    return found | _inside(value, read, kind, "")


def _inside(value: Column, read: Column, kind: T.DataType, path: str) -> dict[str, Column]:
    """The losses below a value, from its variant and from what was read of it."""
    found: dict[str, Column] = {}
    if isinstance(kind, T.StructType):
        fields = ",".join(f"`{f.name}`:variant" for f in kind)
        given = F.try_variant_get(value, "$", f"struct<{fields}>")
        for field in kind:
            found |= _at(given[field.name], read[field.name], field.dataType, f"{path}.{field.name}")
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        listed = isinstance(kind, T.ArrayType)
        given = F.try_variant_get(value, "$", "array<variant>" if listed else "map<string,variant>")
        each, got = (given, read) if listed else (F.map_values(given), F.map_values(read))
        inner = kind.elementType if listed else kind.valueType
        step = f"{path}[]" if listed else path + "{}"
        for name in _paths(inner, step):
            lost = F.zip_with(each, got, _lost_at(inner, step, name))
            found[name] = F.coalesce(F.aggregate(lost, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0))
    return found


def _lost_at(kind: T.DataType, path: str, name: str) -> Callable[[Column, Column], Column]:
    return lambda value, read: _at(value, read, kind, path)[name]


def _at(value: Column, read: Column, kind: T.DataType, path: str) -> dict[str, Column]:
    present = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))
    return {path: (present & read.isNull()).cast("long")} | _inside(value, read, kind, path)


def _paths(kind: T.DataType, path: str) -> list[str]:
    below: list[str] = []
    if isinstance(kind, T.StructType):
        below = [p for f in kind for p in _paths(f.dataType, f"{path}.{f.name}")]
    elif isinstance(kind, T.ArrayType):
        below = _paths(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.MapType):
        below = _paths(kind.valueType, path + "{}")
    return [path, *below]
