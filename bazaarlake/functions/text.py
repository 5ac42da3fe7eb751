"""Text expressions: e-mail check, labels, row documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake.contract import EMAIL_PATTERN


def is_email(value: Column) -> Column:
    return value.rlike(EMAIL_PATTERN)


def email_or_null(value: Column) -> Column:
    """The address if it is well formed as landed (spaces included), else NULL."""
    return F.when(is_email(value), F.trim(value))


def month_label(month_name: Column, year: Column) -> Column:
    return F.concat_ws(" ", month_name, year.cast("string"))


def quarter_label(quarter: Column) -> Column:
    return F.concat(F.lit("T"), quarter.cast("string"))


def without(value: Column, part: str) -> Column:
    """``value`` with every occurrence of ``part`` removed."""
    return F.replace(value, F.lit(part), F.lit(""))


def row_document(columns: list[str] | None = None, keep_nulls: bool = True) -> Column:
    """The row as one JSON text. NULL fields are written, so nothing of the row is lost."""
    fields = [F.col(c) for c in columns] if columns else [F.col("*")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": str(not keep_nulls).lower()})
