"""Corpus preparation: quality, repeated lines, near copies, mixing and tokens, each stage over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import bpe, jaccard, lines, mixing, quality
from bazaarlake.llm.common import read, store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go. Null and empty texts are judged by the score of an empty one, repeated rows
    alike; labels of ids that do not occur are ignored. An empty table, or one without labels to learn from, loses nothing it should keep."""
    return quality.kept(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in the one with the largest id; documents stay, if only as empty ones. A null text stays null
    or becomes empty, repeated rows are cleaned alike, and an empty table gives an empty result."""
    return lines.cleaned(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id (rows without an id come last), and of rows of one
    id the first by a digest of all columns; rows alike in all columns are one. Documents without words are no copies, all stay.
    An empty table gives an empty result."""
    columns = docs.columns
    keyed = docs.withColumn("_digest", F.xxhash64(*columns))
    groups = jaccard.components(keyed.select(F.struct("doc_id", "_digest").alias("doc_id"), "text"))
    rows = groups.groupBy("component_id", "doc_id", (F.col("n_shingles") > 0).alias("words")).agg(F.count("*").alias("copies"))
    first = F.struct(F.col("doc_id.doc_id").isNull().alias("unnamed"), "doc_id", "copies")
    firsts = rows.where("words").groupBy("component_id").agg(F.min(first).alias("f")).select("f.doc_id", "f.copies")
    stay = store(firsts.unionByName(rows.where("not words").select("doc_id", F.lit(1).cast("long").alias("copies"))), "stay")
    stay = stay.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id._digest").alias("_d"), "copies")
    same = keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["_digest"] == F.col("_d"))
    once = keyed.join(stay.where("copies = 1"), same, "left_semi")
    repeated = keyed.join(stay.where("copies > 1"), same, "left_semi").dropDuplicates(["doc_id", "_digest"])
    return once.unionByName(repeated).select(*columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to target weights: a document appears as often as the mix takes it. Documents without words are never taken, a null
    source is a source, repeated rows are documents of their own, and an empty table gives an empty result."""
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document; null texts have no tokens, repeated rows repeat, and an empty
    table gives an empty result."""
    return bpe.digest(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", token_stage),
]

#: The first stage is a trained model, which SQL cannot express. Tests take its verdict as given and compare the rows of every stage with
#: brute force (the last one's token counts with the tokenizers library).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
