"""Lenient casts: what cannot be read becomes NULL and feeds the quality rules.

Spark 4 runs in ANSI mode, where a plain cast of bad text fails the job, so each cast
here is a ``try_`` form. The session flag is left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake.contract import Column as ColumnSpec


def clean_text(value: Column, blank_as_null: bool = False) -> Column:
    trimmed = F.trim(value)
    return F.nullif(trimmed, F.lit("")) if blank_as_null else trimmed


def to_int(value: Column) -> Column:
    """Whole number with the fraction cut off; exponents and overflow give NULL."""
    # Whole numbers take the short way; only what it cannot read is parsed as a decimal.
    plain = F.when(~value.contains("e") & ~value.contains("E"), value)
    return F.coalesce(value.try_cast("int"), plain.try_cast("decimal(38,6)").try_cast("int"))


def to_decimal(value: Column, precision: int = 12, scale: int = 2) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def to_flag(value: Column) -> Column:
    return value.try_cast("boolean")


def to_day(value: Column) -> Column:
    return F.trim(value).try_cast("date")


def to_moment(value: Column) -> Column:
    return F.trim(value).try_cast("timestamp")


def first_known(*values: Column) -> Column:
    return F.coalesce(*values)


_READERS: dict[str, Callable[[Column], Column]] = {
    "text": clean_text,
    "int": to_int,
    "money": lambda c: to_decimal(c, 12, 2),
    "percent": lambda c: to_decimal(c, 5, 2),
    "date": to_day,
    "timestamp": to_moment,
    "flag": to_flag,
}


def read_as(spec: ColumnSpec, value: Column | None = None, blank_as_null: bool = False) -> Column:
    """The typed reading of a landed text column, by its contract."""
    source = F.col(spec.name) if value is None else value
    if spec.kind == "text":
        return clean_text(source, blank_as_null)
    return _READERS[spec.kind](source)


def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)
