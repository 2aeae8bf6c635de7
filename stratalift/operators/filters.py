"""Filter trees: ``{"OR"|"AND": {comparator: {column: [values]}}}``.

The tree is read top to bottom and folded from the left without precedence:
every further condition is attached to everything before it with the word it
stands under, and the word of the first condition has no effect. With
``{"OR": {"==": {"a": [1, 2]}}, "AND": {">": {"b": [0]}}}`` that gives
``((a = 1 OR a = 2) AND b > 0)``.
"""

from __future__ import annotations

import decimal
import operator
from collections.abc import Iterable, Iterator, Mapping
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalift.functions.columns import col, quoted
from stratalift.functions.types import FLOATING_TEXT, fitting_cast

Tree = Mapping[str, Mapping[str, Mapping[str, Iterable[Any]]]]

CONNECT = {"OR": operator.or_, "AND": operator.and_}
COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}
NULL_WORD = "Null"
# Texts that read as a number, and those among them without an exponent.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
PLAIN_NUMBER = r"^\s*[+-]?[0-9]*\.?[0-9]*\s*$"
WHOLE_PART = r"^\s*([+-]?[0-9]*)"
LONG = 2**63
PARSED_VALUES = 2000


def filter_tree(df: DataFrame, tree: Tree) -> DataFrame:
    """Keep the rows for which the folded tree is true."""
    return df.where(filter_condition(df, tree))


def filter_condition(df: DataFrame, tree: Tree) -> Column:
    """Fold the tree into one Column, so a scan below gets one pushable predicate.

    Conditions on columns the frame lacks are skipped; a tree that is left with
    no condition raises, as do unknown words and comparators.
    """
    parts = list(_conditions(df, tree))
    if not parts:
        raise ValueError("filter tree has no condition on an existing column")
    first = parts[0][1]
    return reduce(lambda folded, part: CONNECT[part[0]](folded, part[1]), parts[1:], first)


def _conditions(df: DataFrame, tree: Tree) -> Iterator[tuple[str, Column]]:
    for word, comparisons in tree.items():
        if word not in CONNECT:
            raise ValueError(f"unknown logical word {word!r}, expected OR or AND")
        for comparator, columns in comparisons.items():
            if comparator not in COMPARE:
                raise ValueError(f"unknown comparator {comparator!r}")
            for name, values in columns.items():
                if name in df.columns:
                    for condition in _column_conditions(df, word, comparator, name, values):
                        yield word, condition


def _column_conditions(
    df: DataFrame, word: str, comparator: str, name: str, values: Iterable[Any]
) -> Iterator[Column]:
    if isinstance(values, str) or not isinstance(values, Iterable):
        values = [values]
    elif isinstance(values, (set, frozenset)):
        values = sorted(values, key=lambda v: (str(type(v)), str(v)))
    values = list(values)
    if (word, comparator) in (("OR", "=="), ("AND", "!=")):
        # A run of OR = or of AND <> on one column is a membership test: one In
        # predicate for the scan instead of a chain as deep as the list is long.
        tests, values = _memberships(df, name, values)
        for test in tests:
            yield test if comparator == "==" else ~test
    for value in values:
        yield _compare(df, comparator, name, value)


def _memberships(df: DataFrame, name: str, values: list[Any]) -> tuple[list[Column], list[Any]]:
    """Tests that the column is one of several values of a kind, and the values of no such test."""
    kind, column = df.schema[name].dataType, quoted(name)
    grouped: dict[str, list[Any]] = {"text": [], "whole": [], "number": [], "": []}
    for value in values:
        grouped[_group_of(value, kind)].append(value)
    tests = []
    for group, found in list(grouped.items())[:3]:
        if len(found) < 2:
            continue
        del grouped[group]
        if group == "number":
            tests.append(_one_of(f"cast({column} as double)", map(float, found)))
        elif group == "whole" and isinstance(kind, T.StringType):
            tests.append(_whole_number_in(column, found))
        elif isinstance(kind, T.DecimalType):
            tests.append(_one_of(column, map(decimal.Decimal, found)))
        else:
            tests.append(_one_of(column, found))
    return tests, [v for found in grouped.values() for v in found]


def _group_of(value: Any, kind: T.DataType) -> str:
    """Which of a list's values one is compared with, by the column's type."""
    if isinstance(kind, T.StringType) and isinstance(value, str) and value != NULL_WORD:
        return "text"
    exact = (T.StringType, T.IntegralType, T.DecimalType)
    if type(value) is int and abs(value) < LONG and isinstance(kind, exact):
        return "whole"
    return "number" if type(value) in (int, float) and isinstance(kind, T.FractionalType) else ""


def _one_of(expression: str, values: Iterable[Any]) -> Column:
    """``IN`` as a text, which reaches the JVM in one piece; literals made one by one take a call
    each, a minute for a hundred thousand. Texts are cut, as parsing takes far more memory than
    what comes out of it."""
    literals = list(map(_literal, values))
    cuts = (literals[at : at + PARSED_VALUES] for at in range(0, len(literals), PARSED_VALUES))
    return reduce(operator.or_, (F.expr(f"{expression} IN ({','.join(cut)})") for cut in cuts))


def _literal(value: Any) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}BD"
    if isinstance(value, float):
        return f"double('{value!r}')"
    return str(value) if abs(value) < 2**31 else f"{value}L"


def _whole_number_in(text: str, values: list[int]) -> Column:
    """Whether the text reads as one of the numbers; NULL for text that is no number."""
    number = f"try_cast(case when {text} rlike {_literal(FLOATING_TEXT)} then {text} end as double)"
    digits = f"regexp_extract({text}, {_literal(WHOLE_PART)}, 1)"
    whole = f"try_cast(case when {digits} in ('', '+', '-') then '0' else {digits} end as bigint)"
    column = F.expr(text)
    plain = _one_of(whole, values) & ~_has_fraction(column)
    exponent = _one_of(number, map(float, values))
    found = F.when(column.rlike(PLAIN_NUMBER), F.coalesce(plain, F.lit(False))).otherwise(exponent)
    return F.when(column.rlike(NUMBER), found)


def _whole_part(text: Column) -> Column:
    digits = F.regexp_extract(text, WHOLE_PART, 1)
    return F.when(digits.isin("", "+", "-"), "0").otherwise(digits)


def _has_fraction(text: Column) -> Column:
    return text.rlike(r"\.[0-9]*[1-9]")


def _against_whole(text: Column, value: int) -> Column:
    """-1, 0 or 1 as the number in the text is less than, equal to or more than the value.

    Doubles that differ are in the order of the numbers they were read from. Where they do
    not, the digits decide, of which no number is rounded away; a text with an
    exponent then counts as equal.
    """
    number = F.when(text.rlike(NUMBER), text).try_cast("double")
    whole = _whole_part(text).try_cast("decimal(38,0)")
    exact = F.lit(decimal.Decimal(value))
    beyond = F.when(text.rlike(r"^\s*-"), -1).otherwise(1)
    digits = (
        F.when(whole > exact, 1)
        .when(whole < exact, -1)
        .when(_has_fraction(text), beyond)
        .otherwise(0)
    )
    tie = F.when(text.rlike(PLAIN_NUMBER), digits).otherwise(0)
    near = F.lit(float(value))
    return F.when(number > near, 1).when(number < near, -1).when(number.isNotNull(), tie)


def _against_decimal(text: Column, value: decimal.Decimal) -> Column:
    """As ``_against_whole``, for a value with a fraction and of any number of digits."""
    number = F.when(text.rlike(NUMBER), text).try_cast("double")
    whole, _, fraction = format(value.copy_abs(), "f").partition(".")
    whole, fraction = whole.lstrip("0"), fraction.rstrip("0")
    own_whole = F.regexp_extract(text, r"^\s*[+-]?0*([0-9]*)", 1)
    own_fraction = F.regexp_extract(text, r"\.([0-9]*[1-9])", 1)
    own, other = F.concat(own_whole, F.lit("."), own_fraction), F.lit(f"{whole}.{fraction}")
    longer = F.length(own_whole) - len(whole)
    # numbers with as many digits before the point are in the order of their text
    size = (
        F.when(longer != 0, F.signum(longer).cast("int"))
        .when(own > other, 1)
        .when(own < other, -1)
        .otherwise(0)
    )
    below = -size if value <= 0 else F.lit(-1)
    above = size if value >= 0 else F.lit(1)
    digits = F.when(text.rlike(r"^\s*-"), below).otherwise(above)
    tie = F.when(text.rlike(PLAIN_NUMBER), digits).otherwise(0)
    near = F.lit(float(value))
    return F.when(number > near, 1).when(number < near, -1).when(number.isNotNull(), tie)


def _compare(df: DataFrame, comparator: str, name: str, value: Any) -> Column:
    column = col(name)
    kind = df.schema[name].dataType
    if comparator in ("==", "!="):
        if value is None or value == NULL_WORD:
            return column.isNull() if comparator == "==" else column.isNotNull()
    elif value == "":
        value = 0
    if value is None:
        return F.lit(None).cast("boolean")
    if isinstance(kind, T.StringType) and isinstance(value, decimal.Decimal) and value.is_finite():
        return COMPARE[comparator](_against_decimal(column, value), F.lit(0))
    literal = F.lit(value)
    is_number = isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool)
    if isinstance(kind, T.StringType):
        if type(value) is int:
            return COMPARE[comparator](_against_whole(column, value), F.lit(0))
        if is_number:
            number = T.DoubleType() if isinstance(value, float) else T.DecimalType(38, 18)
            column = fitting_cast(column, kind, number)
        elif not isinstance(value, str):
            column = column.try_cast(_type_of(value))
    elif isinstance(value, str):
        # Text that does not read as the column's type compares as NULL: no match.
        literal = literal.try_cast(kind)
    return COMPARE[comparator](column, literal)


def _type_of(value: Any) -> str:
    kinds = ((bool, "boolean"), (datetime, "timestamp"), (date, "date"), (bytes, "binary"))
    for python_type, name in kinds:
        if isinstance(value, python_type):
            return name
    raise ValueError(f"cannot compare text with {value!r}")
