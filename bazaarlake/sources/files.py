"""CSV landing: read as text, keep the contract's columns, write all-text bronze."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import contract
from bazaarlake.sources.tables import Lake


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A headed UTF-8 CSV with every column as text.

    No schema inference: it costs a second read and turns the code ``007`` into 7.
    A missing path is an error.
    """
    return spark.read.option("header", True).option("encoding", "UTF-8").option("inferSchema", False).csv(path)


def select_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns``; an error names those that are absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df.select(*columns)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def land(df: DataFrame, table: contract.Table, audit: bool = True) -> DataFrame:
    """The bronze form of ``df``: contract columns as text, plus the landing time."""
    landed = as_text(select_required(df, table.landing_names))
    return landed.withColumn("ingested_at", F.current_timestamp()) if audit else landed


def ingest_csv(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    tables: tuple[contract.Table, ...] = contract.DIMENSIONS + contract.FACTS,
    mode: str = "append",
) -> DataFrame:
    """Lands ``<folder>/<table>.csv`` for each table; returns (table_name, nb_lignes, nb_colonnes)."""
    metrics = []
    for table in tables:
        landed = land(read_csv_text(spark, f"{folder}/{table.name}.csv"), table)
        rows = lake.write(landed, "bronze", table.name, mode=mode)
        metrics.append((table.name, rows, len(table.landing_names)))
    return metrics_frame(spark, metrics)


def metrics_frame(spark: SparkSession, metrics: list[tuple[str, int, int]]) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("nb_lignes", T.LongType()),
            T.StructField("nb_colonnes", T.IntegerType()),
        ]
    )
    return spark.createDataFrame(metrics, schema)


def volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, as one frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(name).alias("table_name"), "nb_lignes")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
