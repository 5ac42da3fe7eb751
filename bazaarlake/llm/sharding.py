"""Two-pass external shuffle into shards.

Pass one scatters rows into buckets by a seeded hash of all their columns; a bucket is small enough for one task's
memory. Pass two brings each bucket into a fixed order, shuffles it by Fisher-Yates with a seed of its own and writes it.
Buckets one after the other are the shuffled table; a shard is a stretch of it, so shards differ by one row at most.

Defined cases: null text has no bytes; a null id is a value; rows alike in all columns fall into one bucket, where any order of them
gives the same result; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import running_offsets, store

SHARDS = 40
BUCKET_BYTES = 16 << 20
#: Offsets of so many buckets (16 bytes each) may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_BUCKETS = 1 << 20


def size_of_row():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16


def _fisher_yates(seed: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        table = table.take(pa.array(np.argsort(table.column("hash").to_numpy(), kind="stable")))
        order = np.arange(table.num_rows)
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
        out = table.take(pa.array(order)).drop_columns(["hash"])
        return out.append_column("place", pa.array(np.arange(len(order)), pa.int64()))

    return run


def shuffled(docs: DataFrame, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row (all columns of ``docs``), bucket, place: both passes, written to the shared folder."""
    total = docs.agg(F.sum(size_of_row())).first()[0] or 0
    buckets = int(max(1, -(-total // bucket_bytes)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.select(
        F.struct(*columns).alias("row"), F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets)).alias("bucket"),
        F.xxhash64(F.lit(seed + 1), *columns).alias("hash"),
    )
    kind = T.StructType([hashed.schema["row"], hashed.schema["bucket"], T.StructField("place", T.LongType())])
    return store(hashed.groupBy("bucket").applyInArrow(_fisher_yates(seed), kind), "shuffled")


def into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row, shard, slot. Shard k holds places k*n//shards up to (k+1)*n//shards of the shuffled table."""
    done = shuffled(docs, seed, bucket_bytes)
    counts = done.groupBy("bucket").agg(F.count("*").alias("rows"))
    offsets = store(running_offsets(counts, "bucket", "rows").select("bucket", "offset"), "shuffle-offsets")
    if offsets.count() <= BROADCAST_BUCKETS:  # rows stay where they are
        offsets = F.broadcast(offsets)
    total = done.agg(F.count("*").alias("n"))
    placed = done.join(offsets, "bucket").crossJoin(F.broadcast(total)).withColumn("at", F.col("offset") + F.col("place"))
    shard = F.expr(f"(({shards} * (at + 1) + n - 1) div n) - 1")
    placed = placed.withColumn("shard", shard.cast("int"))
    return placed.select("row", "shard", F.expr(f"at - (shard * n) div {shards}").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows by slot within each file."""
    rows = sharded.select("shard", "slot", "row.*")
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
