"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def key_bucket(columns: list[str], digits: int) -> Column:
    """The leading hex digits of the key's MD5: a spread fixed by the key alone."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.substring(F.md5(text), 1, digits)


def dense_keys(df: DataFrame, columns: list[str], name: str, digits: int = 3, start: int = 1) -> DataFrame:
    """Adds ``name``: the dense numbering start, start+1, ... over the unique ``columns``.

    Rows are numbered inside 16**digits buckets, then shifted by the size of the earlier
    buckets. The bucket depends on the key only, so a retried task numbers its rows the
    same way. The running total and the broadcast cover at most 16**digits rows (25 MB at 5 digits),
    whatever the data size. Facts take ``number_written``.
    """
    bucketed = df.withColumn("_bucket", key_bucket(columns, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_bucket").orderBy(*columns)
    numbered = bucketed.withColumn("_place", F.row_number().over(inside)).join(F.broadcast(shifts), "_bucket")
    key = (F.col("_place") + F.col("_shift") + F.lit(start - 1)).cast("long")
    return numbered.select(key.alias(name), *df.columns)


def number_written(
    spark: SparkSession, path: str, schema: StructType, name: str, start: int = 1, where: str | None = None
) -> DataFrame:
    """The rows of a written table (those of a partition filter ``where``) with ``name``: start, start+1, ... by file and place in the file.

    A row's number is its place plus the rows of the files before, so there is no shuffle and no sort of rows. Files do not
    change once written, hence a retried task gives the same numbers. The running total covers one row a file.
    """
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.where(where) if where else rows
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_file", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_shift"))
    key = (F.col("_row") + F.col("_shift") + F.lit(start)).cast("long")
    # Without the hint a plan starts as a sort-merge join, and the rows are shuffled by file before the shifts' size is known.
    return placed.join(F.broadcast(shifts), "_file").select(key.alias(name), *rows.columns)


def extend_keys(known: DataFrame, current: DataFrame, natural: str, name: str, digits: int = 3) -> DataFrame:
    """The key map ``(natural, name)`` kept across refreshes.

    Known keys keep their number, also when absent from ``current``; new ones follow the
    highest number in use.
    """
    fresh = (
        current.select(natural).where(F.col(natural).isNotNull()).distinct().join(known, natural, "left_anti")
    )
    numbered = dense_keys(fresh, [natural], "_place", digits)
    highest = known.agg(F.coalesce(F.max(name), F.lit(0)).alias("h"))
    added = numbered.select(natural, (F.col("_place") + highest.scalar()).cast("long").alias(name))
    return known.select(natural, F.col(name).cast("long").alias(name)).unionByName(added)
