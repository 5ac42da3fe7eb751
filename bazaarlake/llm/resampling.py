"""Importance resampling of documents towards a target text, by bytes.

A table of 256 bytes lower-cases a text's UTF-8 and blanks what is no letter, digit or byte above 127; ``bytes.split`` yields the
words. The CRC-32 of a word is the seed for that of the word and the next, and that of the three, so an n-gram is never
put together. Counters of buckets are added up, first in each task, then over all tasks: their size is that of the bucket
table. A second pass over the texts sums the gains of their buckets. Drawing is Gumbel's trick: the largest scores win. The
scores near the cut and above are range-sorted in Spark and numbered by their place.

Defined cases: null texts have no words; documents without words weigh 0 and take part in the counts with nothing; repeated
rows are documents of their own; a null id is drawn like the empty string and counts as the largest; an empty target has
no counts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import numbered, store

BUCKETS = 10_000
LONGEST = 3
#: Lower case for A-Z; a blank for every other byte below 128 that is no letter or digit.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TABLE).split()


def features(words: list[bytes], longest: int = LONGEST):
    """CRC-32 of every run of 1 to ``longest`` words: lists by length, each seeded by the one before."""
    follow = [b" " + w for w in words]
    sums = list(map(zlib.crc32, words))
    yield sums
    for k in range(1, longest):
        sums = list(map(zlib.crc32, islice(follow, k, None), sums))
        yield sums


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        seen: Counter[int] = Counter()
        for batch in batches:
            for raw in batch.column(0):
                for sums in features(words_of(raw.as_py())):
                    seen.update(np.mod(sums, buckets).tolist() if sums else ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["bucket", "n"]
        )

    parts = texts.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's smoothed share over the corpus' own) of each bucket."""
    s, t = float(own.sum() + len(own)), float(target.sum() + len(own))
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(own.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: str) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: str = "42") -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""

    def run(batches):
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            ids = batch.column(0).to_pylist()
            for doc_id, raw in zip(ids, batch.column(1)):
                words = words_of(raw.as_py())
                n = weight = 0
                for sums in features(words):
                    n += len(sums)
                    if sums:
                        weight += int(gain[np.mod(sums, len(gain))].sum())
                for column, value in zip(out, (len(words), n, weight, weight + noise(doc_id, seed))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out)], ["doc_id", "n_words", "n_features", "weight", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: str = "42") -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row; ``rank`` counts the drawn ones from 1 and is null for the others.

    Drawn are ``percent`` of the documents of at least ``least_words`` words, the largest scores first, ties by smaller id.
    """
    own, wanted = bucket_counts(docs), bucket_counts(target)
    rows = store(scored(docs, gains(own, wanted), seed), "scored")
    fit = F.col("n_words") >= least_words
    some = rows.where(fit)
    n = some.count()
    drawn = percent * n // 100
    # An approximate quantile that is surely below the last drawn score keeps most rows out of the sort.
    error = 0.002
    at = max(0.0, 1 - percent / 100 - 2 * error)
    floor = some.approxQuantile("score", [at], error) if drawn else []
    near = fit & (F.col("score") >= F.lit(int(floor[0]) if floor and abs(floor[0]) < 1 << 53 else -(1 << 62))) if drawn else F.lit(False)
    ordered = numbered(rows.where(near), [F.desc("score"), F.asc_nulls_last("doc_id")], "drawn")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    rest = rows.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return ordered.withColumn("rank", rank).drop("at").unionByName(rest)
