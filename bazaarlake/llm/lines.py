"""Line dedup with two Bloom filters.

Each task marks the line keys of its documents in a filter of keys seen once and, where a key comes again, in a filter
of keys seen twice. Merged over all tasks the second filter covers every key of two or more documents. Only lines that it
suspects are shuffled, where exact counting confirms them and chooses the document that keeps them.

Keys are compared by a 128-bit digest. Filters have one size from the number of lines, at most ``bloom.MAX_BITS``; beyond it
more lines are suspected and shuffled, and the result is the same.

Defined cases: null text is one empty line; documents are told apart by id, so repeated rows and other rows of one id count once, and
rows without an id are one document; the row or rows with the largest id keep the line (null ids are smallest); rows of one id
drop the same keys; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.bloom import bits_for, build, holds, positions
from bazaarlake.llm.common import BLANKS, store

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3

_BLANK_BYTES = BLANKS.encode()


def line_keys(lines: list[bytes], least: int = LEAST_CHARS) -> list[bytes | None]:
    """The key of each line; None where it is too short to count."""
    keys = []
    for line in lines:
        key = line.strip(_BLANK_BYTES)
        if len(key) < least or (not key.isascii() and len(key.decode()) < least):
            keys.append(None)
        else:
            keys.append(key.lower())
    return keys


def digests(text: str | None, least: int = LEAST_CHARS) -> list[bytes | None]:
    lines = (text or "").encode().split(b"\n")
    return [None if k is None else xxhash.xxh3_128_digest(k) for k in line_keys(lines, least)]


def _as_numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


def _text_keys(least: int):
    """The distinct keys of each text, batch by batch."""

    def keys(batches):
        for batch in batches:
            yield _as_numbers([k for text in batch.column(0).to_pylist() for k in {k for k in digests(text, least) if k}])

    return keys


def twice_filter(docs: DataFrame, least: int = LEAST_CHARS, bits: int | None = None) -> np.ndarray:
    """The filter of keys in two or more documents: bits / 8 bytes, at most MAX_BITS / 8."""
    if bits is None:
        breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
        lines = docs.agg(F.sum(breaks)).first()[0] or 1
        bits = bits_for(lines)
    return build(docs.select("text"), _text_keys(least), bits)


def suspects(docs: DataFrame, seen_twice: np.ndarray, least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, key) of each row's distinct keys that the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(seen_twice)
    bits = len(seen_twice) * 8

    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                own = {k for k in digests(text, least) if k}
                keys += own
                ids += [doc] * len(own)
            if keys:
                keep = np.flatnonzero(holds(shared.value, positions(_as_numbers(keys), bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i].as_py() for i in keep], batch.schema.field(0).type), pa.array([keys[i] for i in keep], pa.binary())],
                    ["doc_id", "key"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key binary")


def rewriter(least: int):
    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def rewrite(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        rows = []
        for text, drop in zip(texts, drops):
            lines = (text or "").split("\n")
            if drop is None or len(drop) == 0:
                rows.append((text or "", len(lines), 0))
                continue
            gone = set(drop)
            kept = [x for x, key in zip(lines, digests(text, least)) if key is None or key not in gone]
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    return rewrite


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, bits: int | None = None
) -> DataFrame:
    """row (all columns of ``docs``) and result (kept text, n_lines, n_dropped)."""
    known = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    seen = store(suspects(docs, twice_filter(docs, least_chars, bits), least_chars), "line-suspects")
    repeated = (
        seen.groupBy("key").agg(F.count_distinct(F.struct("doc_id")).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= least_documents).select("key", "keeper")
    )
    repeated = store(repeated, "line-repeats")
    drops = (
        seen.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id").agg(F.collect_set("key").alias("drops"))
        .withColumnRenamed("doc_id", "drop_id")
    )
    joined = known.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
    return joined.select("row", rewriter(least_chars)("text", "drops").alias("result"))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines, in its own columns; n_chars, where there is one, follows the text."""
    out = drop_repeated_lines(docs)
    values = {"text": F.col("result.kept"), "n_chars": F.length("result.kept").cast("long")}
    return out.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
