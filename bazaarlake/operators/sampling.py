"""A seeded sample of an exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fixed_size_sample(
    df: DataFrame, keys: list[str], seed: int, fraction: float | None = None, rows: int | None = None
) -> DataFrame:
    """Exactly ``rows`` rows (or the whole part of ``fraction`` of them), picked by key hash.

    ``keys`` must be unique. Rows are ordered by the MD5 of key and seed. A histogram over
    the first four hex digits (at most 65,536 rows) tells which buckets are taken whole
    and which single bucket is cut; only that one, about 1/65,536 of the rows, is ranked.
    The sample itself is never gathered in one task.
    """
    if (fraction is None) == (rows is None):
        raise ValueError("give either fraction or rows")
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    hashed = df.withColumn("_hash", F.md5(text)).withColumn("_bucket", F.substring("_hash", 1, 4))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    wanted = F.lit(rows) if rows is not None else F.floor(F.sum("_size").over(whole) * F.lit(fraction))
    plan = sizes.select(
        "_bucket",
        "_size",
        F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_before"),
        wanted.cast("long").alias("_wanted"),
    ).where(F.col("_before") < F.col("_wanted"))
    marked = hashed.join(F.broadcast(plan), "_bucket")
    complete = F.col("_before") + F.col("_size") <= F.col("_wanted")
    cut = marked.where(~complete)
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *keys))
    cut = cut.withColumn("_place", place).where(F.col("_place") <= F.col("_wanted") - F.col("_before"))
    return marked.where(complete).select(*df.columns).unionByName(cut.select(*df.columns))
