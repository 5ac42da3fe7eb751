"""JDBC tables, read and written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    table: str,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    splits: int | None = None,
    fetch_rows: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a scan; with ``split_column`` it is read through ``splits`` connections."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **properties}
    if split_column:
        if lower is None or upper is None or not splits:
            raise ValueError("a split scan needs lower, upper and splits")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(splits),
        }
    return options


def jdbc_write_options(url: str, table: str, batch_rows: int = 10_000, connections: int = 8, **properties: str):
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        "reWriteBatchedInserts": "true",
        **properties,
    }


def read_jdbc(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(**options).save()
