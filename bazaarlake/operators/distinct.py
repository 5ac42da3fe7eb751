"""Exact distinct counts of dense keys by bitmaps, beside sums, in one pass.

A dense surrogate key is a bit: keys of one bucket (``bitmap_bucket_number``) fill one bitmap of 4 KB. Tasks build the bitmaps of the rows
they read, each key's on their own, so there are as many as the keys' buckets add up to; only bitmaps and partial sums are shuffled, never
rows or keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: dict[str, str], sums: dict[str, Column]) -> DataFrame:
    """One row: ``sums`` (name to the summed expression) and the distinct non-null values of each of ``keys`` (name to column)."""
    # A row gives one entry for each key, so a task holds one bitmap for each bucket of each key, never one for each combination.
    entries = [
        F.struct(
            F.lit(i).alias("kind"), F.bitmap_bucket_number(F.col(c)).alias("bucket"), F.bitmap_bit_position(F.col(c)).alias("bit"),
            *[(e if i == 0 else F.lit(None)).alias(s) for s, e in sums.items()],
        )
        for i, c in enumerate(keys.values())
    ]
    merged = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").groupBy("kind", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("map"), *[F.sum(s).alias(s) for s in sums]
    )
    bits = F.bitmap_count("map")
    return merged.agg(
        *[F.sum(s).alias(s) for s in sums],
        *[F.coalesce(F.sum(F.when(F.col("kind") == i, bits)), F.lit(0)).alias(n) for i, n in enumerate(keys)],
    )
