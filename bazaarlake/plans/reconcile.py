"""Volume reports between layers, from row counts (table_name, nb_lignes) such as the ledger's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _compare(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(table_name, a, b) with a TOTAL row."""
    zero = F.lit(0).cast("long")
    counts = left.select("table_name", F.col("nb_lignes").alias(a), zero.alias(b)).unionByName(
        right.select("table_name", zero.alias(a), F.col("nb_lignes").alias(b))
    )
    totals = counts.rollup("table_name").agg(F.sum(a).alias(a), F.sum(b).alias(b))
    return totals.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), a, b)


def layer_diff(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows per table in both layers and how many were dropped, with a TOTAL row."""
    both = _compare(bronze, silver, "nb_bronze", "nb_silver")
    return both.withColumn("nb_ecartes", F.col("nb_bronze") - F.col("nb_silver"))


def layer_match(silver: DataFrame, gold: DataFrame, skip: tuple[str, ...] = ("dim_temps",)) -> DataFrame:
    """Rows per table in both layers and whether they agree, with a TOTAL row.

    The gold calendar is generated on its own range, so it is left out of the comparison.
    """
    keep = ~F.col("table_name").isin(*skip)
    both = _compare(silver.where(keep), gold.where(keep), "nb_silver", "nb_gold")
    same = F.col("nb_silver") == F.col("nb_gold")
    return both.withColumn("statut", F.when(same, "MATCH").otherwise("MISMATCH"))
