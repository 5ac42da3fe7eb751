"""SQL over the warehouse: named views and bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.plans.views import VIEWS


def register_tables(gold: dict[str, DataFrame]) -> None:
    for name, df in gold.items():
        df.createOrReplaceTempView(name)


def register_views(gold: dict[str, DataFrame]) -> list[str]:
    """Registers the seven analytic views; returns their names."""
    for name, build in VIEWS.items():
        build(gold).createOrReplaceTempView(name)
    return list(VIEWS)


def run_query(spark: SparkSession, text: str, **params: object) -> DataFrame:
    """Runs SQL with ``:name`` parameters bound as values. Errors are raised."""
    return spark.sql(text, args=params or None)
