"""Top-N and arg-max rows with NULL measures last and a unique tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def descending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc(t) for t in ties])


def ascending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(measure), *[F.asc(t) for t in ties])


def top_n(df: DataFrame, measure: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` highest rows; each task keeps ``n`` rows, so nothing is sorted in full."""
    return descending(df, measure, *ties).limit(n)


def at_highest(column: Column | str, measure: str, tie: str) -> Column:
    """An aggregate: ``column`` of the row with the highest measure; NULL measures do not count."""
    value = F.col(measure)
    return F.min_by(column, F.when(value.isNotNull(), F.struct(-value, F.col(tie))))


def at_lowest(column: Column | str, measure: str, tie: str) -> Column:
    value = F.col(measure)
    return F.min_by(column, F.when(value.isNotNull(), F.struct(value, F.col(tie))))


def highest(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return top_n(df.where(F.col(measure).isNotNull()), measure, 1, *ties)


def lowest(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return ascending(df.where(F.col(measure).isNotNull()), measure, *ties).limit(1)
