"""Exact de-duplication on a business key with a fixed survivor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the lowest by ``order`` (default: all other columns, left to right).

    Rows that tie on every ordering column are copies, so the outcome does not depend on
    the arrival order. Spark drops all but one row per key inside each task before the
    shuffle (group limit on ``row_number() = 1``), so a key with very many copies moves
    at most one row per task.
    """
    ordering = order or [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*[F.asc(c) for c in (ordering or keys)])
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys carried by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_lignes")).where(F.col("nb_lignes") > 1)
