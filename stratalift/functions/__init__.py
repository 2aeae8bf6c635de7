"""Column expressions and type names shared by the operators."""

from stratalift.functions.columns import (
    blank_match,
    is_reserved,
    local_time_text,
    narrow,
    regex_match,
    regular_columns,
    reserved_columns,
    row_text,
)
from stratalift.functions.types import fitting_cast, spark_type

__all__ = [
    "blank_match",
    "fitting_cast",
    "is_reserved",
    "local_time_text",
    "narrow",
    "regex_match",
    "regular_columns",
    "reserved_columns",
    "row_text",
    "spark_type",
]
