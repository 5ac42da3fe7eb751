"""The layered table store: parquet directories ``<root>/<layer>[/<version>]/<table>``, and a ledger of what was written.

A refresh writes a layer's next version beside the current one. One small file names the current version, so a job that dies
on the way leaves readers with the whole old layer, and the switch is a single write.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake import contract

LEDGER = "layer string, version string, table_name string, nb_lignes long, mode string, at long"
REJECT_ROWS = "record_data string, reason string, rule_id string, rejected_at timestamp, table_name string"
CURRENT = "_current"
# Bytes of files that one slice of a table has at most, if no file alone is larger.
SLICE_BYTES = 1 << 30
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside lose their shuffle files at their end, not when the driver's garbage collector finds them: what a
    table's write has shuffled is of no use once the table stands, and a layer run would pile up the shuffles of all its tables."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    rows_per_file: int | None = None,
    rebalance: bool = True,
) -> int:
    """Writes parquet and returns the row count, taken during the write itself.

    A partitioned write is first rebalanced on the partition column: AQE then joins small
    partitions and splits a partition that holds a large part of the rows, so neither many
    tiny files nor one giant task results. Without ``rebalance`` rows stay where they are.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by and rebalance:
        out = out.hint("rebalance", partition_by)
    # A full refresh also removes partitions that the new rows do not have.
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    rows = int(seen.get["rows"])
    if partition_by and not rows and mode == "overwrite":
        # A partitioned write of no rows leaves no file; one without partitions keeps the columns readable.
        out.write.mode(mode).option("compression", "zstd").parquet(path)
    return rows


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of our own only in local mode where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="bazaarlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed now, written to a folder of its own and read back: what it has shuffled goes before anything else runs."""
    path = f"{shared_folder(df.sparkSession)}/bazaarlake-parts-{uuid.uuid4().hex}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_turn(parts: Iterable[DataFrame]) -> DataFrame:
    """The union of ``parts``, each computed and stored before the next one begins. As branches of one plan the shuffles of all parts would lie
    on disk at once; in turn only those of one part do. For results that are small beside what they are computed from."""
    return reduce(DataFrame.unionByName, [stored(part) for part in parts])


@dataclass(frozen=True)
class Lake:
    """``writing`` names the versions of layers that are being written; other layers are read at their current version."""

    spark: SparkSession
    root: str
    writing: dict[str, str] = field(default_factory=dict)

    # --- versions -------------------------------------------------------------------

    def _file(self, path: str):
        file = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return file.getFileSystem(self.spark._jsc.hadoopConfiguration()), file

    def version(self, layer: str) -> str | None:
        """The version being written, else the current one; None for a layer without versions."""
        if layer in self.writing:
            return self.writing[layer]
        system, file = self._file(f"{self.root}/{layer}/{CURRENT}")
        if not system.exists(file):
            return None
        source = system.open(file)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def _put(self, path: str, text: str) -> None:
        system, file = self._file(path)
        sink = system.create(file, True)
        sink.write(bytearray(text.encode()))
        sink.close()

    @contextmanager
    def refresh(self, layer: str, keep: int | None = None) -> Iterator[Lake]:
        """A lake that writes the layer's next version, which becomes current when the block ends without an error.

        ``keep`` drops all but that many of the latest versions afterwards; without it all stay.
        """
        version = f"v{time.time_ns()}"
        yield replace(self, writing={**self.writing, layer: version})
        self._put(f"{self.root}/{layer}/{CURRENT}", version)
        if keep:
            self.trim(layer, keep)

    def versions(self, layer: str) -> list[str]:
        """The layer's versions up to the current one, oldest first; later ones are being written by someone."""
        system, file = self._file(f"{self.root}/{layer}")
        names = sorted(s.getPath().getName() for s in system.listStatus(file) if s.getPath().getName().startswith("v"))
        return [n for n in names if n <= (self.version(layer) or "")]

    def trim(self, layer: str, keep: int = 1) -> None:
        """Drops all but the latest ``keep`` versions."""
        system, done = self._file(self.root)[0], self.versions(layer)
        for name in done[: len(done) - keep]:
            system.delete(self._file(f"{self.root}/{layer}/{name}")[1], True)

    # --- tables ---------------------------------------------------------------------

    def path(self, layer: str, table: str) -> str:
        version = self.version(layer)
        return f"{self.root}/{layer}/{version}/{table}" if version else f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        system, file = self._file(self.path(layer, table))
        return bool(system.exists(file))

    def read_layer(self, layer: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
        return {t: self.read(layer, t) for t in tables or list(contract.TABLES)}

    def slices(self, layer: str, table: str, size: int | None = None) -> list[DataFrame]:
        """The table in slices of whole files with about ``size`` bytes together (``SLICE_BYTES``): each file is in one of them."""
        system, folder = self._file(self.path(layer, table))
        files = sorted((s.getPath().toString(), s.getLen()) for s in system.listStatus(folder) if s.getPath().getName().startswith("part-"))
        whole, groups, held = self.read(layer, table), [], 0
        for path, length in files:
            if not groups or held + length > (size or SLICE_BYTES):
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += length
        if len(groups) < 2 or any(s.isDirectory() and "=" in s.getPath().getName() for s in system.listStatus(folder)):
            return [whole]
        return [self.spark.read.schema(whole.schema).parquet(*group) for group in groups]

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", **options) -> int:
        rows = write_table(df, self.path(layer, table), mode=mode, **options)
        self.record(layer, table, rows, mode)
        return rows

    def hand_off(self, df: DataFrame, layer: str, table: str, **options) -> DataFrame:
        """Writes the table and returns it as read back: later steps start from files."""
        self.write(df, layer, table, **options)
        return self.read(layer, table)

    def drop(self, layer: str, table: str) -> None:
        """Removes the table's files; the ledger keeps its count."""
        system, file = self._file(self.path(layer, table))
        system.delete(file, True)

    def add_rejects(self, rejects: DataFrame, table: str, replace: bool = True, layer: str = "silver") -> int:
        """Adds reject records to the layer's quarantine, one directory per source table.

        ``replace`` swaps that table's earlier rejects, so a rerun does not double them.
        """
        records = rejects.withColumn("rejected_at", F.current_timestamp()).drop("table_name")
        path = f"{self.path(layer, contract.REJECTS)}/table_name={table}"
        return write_table(records, path, mode="overwrite" if replace else "append")

    def rejects(self, layer: str = "silver") -> DataFrame:
        return self.spark.read.schema(REJECT_ROWS).parquet(self.path(layer, contract.REJECTS))

    # --- ledger ---------------------------------------------------------------------

    def record(self, layer: str, table: str, rows: int, mode: str = "overwrite") -> None:
        """Notes a write. The counts come from the writes themselves, so no report has to read a table again."""
        values = {
            "layer": layer, "version": self.version(layer), "table_name": table, "nb_lignes": rows, "mode": mode, "at": time.time_ns(),
        }
        self._put(f"{self.root}/ledger/{values['at']}-{layer}-{table}.json", json.dumps(values))

    def counts(self, layer: str) -> DataFrame:
        """(table_name, nb_lignes) of the layer's version, from the ledger: the last overwrite and the appends after it."""
        entries = self.spark.read.schema(LEDGER).json(f"{self.root}/ledger")
        own = entries.where((F.col("layer") == layer) & F.col("version").eqNullSafe(F.lit(self.version(layer))))
        start = F.max(F.when(F.col("mode") == "overwrite", F.col("at"))).over(Window.partitionBy("table_name"))
        valid = own.withColumn("start", F.coalesce(start, F.lit(0))).where(F.col("at") >= F.col("start"))
        return valid.groupBy("table_name").agg(F.sum("nb_lignes").alias("nb_lignes"))
