"""Mixing sources to target weights by weighted fair queueing.

Every source deals its documents in a seeded order, up to ``cap`` rounds. A dealing has the virtual finish time
(words its source has dealt so far) / (target words of the source). All dealings are range-sorted by finish time, ties by
source and by words dealt, and truncated where the total budget would be passed: ranges are summed, and only the range that
crosses the budget is summed row by row.

Defined cases: null text has no words; sources sort by code point, null last and a source of its own; documents without
words are never taken; a table without words gets targets of 0; repeated rows are documents of their own; ties in the
seeded order are broken by id and text digest; other columns are carried along whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import WORD, running_offsets, shared_folder, store
from bazaarlake.sources.tables import shuffles_dropped

#: Documents of a source in one task of the running sum.
BUCKET_ROWS = 4096


def words_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and text digest of every document, stored: what a schedule needs of a text that it need not return."""
    return store(docs.select("doc_id", "source", words_of("text").alias("size"), F.crc32("text").alias("digest")), "mix-measured")


def _targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """One row a source: its words, rows and target. Shares are filled like water: sources are taken by the level at which
    they reach their cap, and the first level that fits is the level of all others."""
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("_words"), F.count("*").alias("_rows"))
    nth = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (nth % len(weights) + 1).cast("int"))
    full = F.col("_words") * cap
    order = Window.orderBy(full / F.col("_weight"), F.col("_source").asc_nulls_last())
    filled = by_source.withColumn("_nr", nth).withColumn("_weight", weight)
    filled = filled.withColumns(
        {
            "_capped": F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_open": F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
            "_total": F.sum("_words").over(Window.partitionBy()),
        }
    )
    level = (F.col("_total") * F.lit(share) - F.col("_capped")) / F.col("_open")
    fits = level * F.col("_weight") <= full
    filled = filled.withColumn("_level", F.max(F.when(fits, level)).over(Window.partitionBy()))
    target = F.when(F.col("_level").isNull(), full.cast("double")).otherwise(
        F.least(full.cast("double"), F.col("_level") * F.col("_weight"))
    )
    return filled.select("_source", "_nr", "_words", "_rows", target.alias("_target"), "_total")


def _dealing(done: int) -> Column:
    """The place of a row's dealing in round ``done``; null for rows that are never dealt."""
    time = _finish(done)
    return F.when(time.isNotNull(), F.struct(time.alias("time"), F.col("_nr").alias("nr"), (F.lit(done) * F.col("_words") + F.col("_dealt")).alias("dealt")))


def _first_beyond(placed: DataFrame, share: float, rounds: int) -> tuple[float, int, int] | None:
    """The first dealing that passes the budget; None if all fit. Dealings without rows are range-sorted and written; a file is a range."""
    path = f"{shared_folder(placed.sparkSession)}/bazaarlake-mix-order-{uuid.uuid4().hex}"
    dealt = placed.select("_size", F.explode(F.array(*[_dealing(k) for k in range(rounds)])).alias("at")).where("at is not null")
    with shuffles_dropped(placed.sparkSession):
        dealt.orderBy("at").write.option("maxRecordsPerFile", 0).parquet(path)
    rows = placed.sparkSession.read.schema(dealt.schema).parquet(path)
    rows = rows.withColumn("range", F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("long"))
    budget = (placed.agg(F.max("_total")).first()[0] or 0) * share
    ranges = running_offsets(rows.groupBy("range").agg(F.sum("_size").alias("words")), "range", "words")
    crossing = ranges.where(F.col("offset") + F.col("words") > budget).orderBy("range").select("range", "offset").first()
    if crossing is None:
        return None
    inside = rows.where(F.col("range") == crossing["range"])
    spent = F.sum("_size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) + crossing["offset"]
    return tuple(inside.select("at", spent.alias("spent")).where(F.col("spent") > budget).agg(F.min("at")).first()[0])


def _finish(done: int) -> Column:
    words = (F.lit(done) * F.col("_words") + F.col("_dealt")).cast("double")
    return F.when((F.col("_target") > 0) & (F.col("_size") > 0), words / F.col("_target"))


def schedule(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: str = "mix",
    measured: tuple[str, str] | None = None,
) -> DataFrame:
    """row (all columns of ``docs``), size, source_size, target, taken (words), copies, first_finish.

    ``measured`` names the columns of ``docs`` that hold size and text digest (``measure``), where the text itself need not travel.
    """
    size, digest = map(F.col, measured) if measured else (words_of("text"), F.crc32("text"))
    sized = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("_source"),
        size.alias("_size"),
        F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10)
        .cast("long").alias("_order"),
        F.col("doc_id").alias("_id"),
        digest.alias("_crc"),
    )
    targets = store(_targets(sized, weights, share, cap), "mix-targets")
    known = sized.join(targets, sized["_source"].eqNullSafe(targets["_source"])).drop(targets["_source"])
    buckets = F.ceil(F.col("_rows") / BUCKET_ROWS)
    known = known.withColumn("_bucket", F.floor(F.col("_order") / F.lit(float(1 << 60)) * buckets))
    # The source by its number, which is never null: the join below keeps the partitions of the window, text stays in place.
    sums = known.groupBy("_nr", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_nr").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("_nr").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("_nr", "_bucket").orderBy("_order", "_id", "_crc").rowsBetween(Window.unboundedPreceding, 0)
    placed = known.withColumn("_inside", F.sum("_size").over(inside)).join(
        sums, (F.col("_nr") == F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    )
    placed = placed.withColumn("_dealt", F.col("_base") + F.col("_inside"))
    placed = store(placed.select("row", "_nr", "_size", "_words", "_target", "_total", "_dealt"), "mix-placed")
    beyond = _first_beyond(placed, share, cap)
    if beyond is None:
        taken = [_dealing(k).isNotNull() for k in range(cap)]
    else:
        time, nr, dealt = beyond
        end = F.struct(F.lit(time).alias("time"), F.lit(nr).alias("nr"), F.lit(dealt).cast("long").alias("dealt"))
        taken = [F.coalesce(_dealing(k) < end, F.lit(False)) for k in range(cap)]
    copies = sum((t.cast("int") for t in taken), F.lit(0))
    return placed.select(
        "row", F.col("_size").alias("size"), F.col("_words").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * copies).alias("taken"), copies.alias("copies"), _finish(0).alias("first_finish"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as often as it is taken, in the columns of ``docs``."""
    taken = schedule(docs, **options).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
