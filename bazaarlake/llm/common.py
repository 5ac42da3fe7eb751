"""Helpers shared by the operators: tables, the shared folder, next keys, prefix sums."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.sources.tables import shuffles_dropped

#: White space of the contracts: blank and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bounds of what a Python worker gets at a time: rows, and bytes where texts are long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship(spark: SparkSession) -> None:
    """Gives the executors this package and sets ``BATCH`` where the user has not, once a session."""
    context = spark.sparkContext
    given = context.getConf()
    for name, value in BATCH.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    if getattr(context, "_bazaarlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    path = Path(tempfile.mkdtemp(prefix="bazaarlake-code-")) / "bazaarlake.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((root / "bazaarlake").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(str(path))
    context._bazaarlake_shipped = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of our own only in local mode where it is unset."""
    ship(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="bazaarlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once into the shared folder and reads it back: lineage ends there, and a lost executor costs nothing. What the
    write has shuffled goes at its end, so the shuffles of a chain of stored tables never pile up.

    The folder belongs to the job; ``release`` drops it, or the cluster's retention of ``spark.checkpoint.dir`` does.
    """
    path = f"{shared_folder(df.sparkSession)}/bazaarlake-{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


def release(*stored: DataFrame) -> None:
    """Drops the files of stored tables that all later steps have consumed and stored themselves."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_offsets(counts: DataFrame, key: str, value: str, block: int = 4096) -> DataFrame:
    """``counts`` (one row for each whole number ``key``) with ``offset``, the sum of ``value`` over all smaller keys.

    Two levels, so no task sees more than ``block`` keys at the lower level or 1/block of them at the upper.
    """
    blocks = counts.groupBy(F.floor(F.col(key) / block).alias("_block")).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("_block", F.floor(F.col(key) / block))
        .join(blocks, "_block")
        .withColumn("offset", F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_block", "_base")
    )


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``at``, the place (from 0) of each row in the global order, which is not asked to be total.

    The rows are range-sorted and written; a row's place is its place in its file, shifted by the rows of the files before. No task
    sees more than its range, and a retried one reads the same files.
    """
    path = f"{shared_folder(df.sparkSession)}/bazaarlake-{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.orderBy(*order).write.option("maxRecordsPerFile", 0).parquet(path)  # one file a task
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    file = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("long")
    rows = rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    offsets = running_offsets(files, "_file", "_rows").select("_file", "offset")
    return rows.join(offsets, "_file").withColumn("at", F.col("offset") + F.col("_row")).drop("_file", "_row", "offset")
