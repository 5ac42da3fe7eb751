"""Fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; it depends on the last 32 bytes only. A chunk ends where the hash has
a run of zero bits at its top: many before the normal size, few after it (normalised chunking), never before the least size and
always at the most. An edit moves the boundaries near it and no others, so two texts share the chunks of what they have
in common. A fingerprint is the set of chunk digests with chunk lengths; likeness is the length of shared chunks as
a share of the longer text's chunks.

Defined cases: null text is empty; an empty text has an empty fingerprint, alike (1) to an empty one and unlike (0) any other; the
document after one is that with the next larger id, after the largest comes the smallest; rows of one id have one next
document, and where the next id has several rows the smallest text stands for it; a null id counts as the largest; a
single document is its own next one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import store

#: Fine enough that texts of a few hundred bytes have several chunks, and so stay alike to themselves after an edit.
LEAST, NORMAL, MOST = 24, 64, 256
HARD_BITS, EASY_BITS = 7, 4
DIGEST = 6  # bytes of a chunk's digest
WINDOW = 32
LAST_KEY = (1 << 63) - 1

#: Random numbers of the 256 bytes, from a fixed seed.
GEAR = np.random.Generator(np.random.PCG64(10)).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(raw: list[bytes]) -> np.ndarray:
    """The rolling hash at every byte of every text, with ``WINDOW`` zeros after each text, so none sees another."""
    gap = bytes(WINDOW)
    flat = np.frombuffer(gap.join(raw) + gap, np.uint8)
    h = GEAR[flat]
    at = np.cumsum([len(r) + WINDOW for r in raw]) - WINDOW
    for k in range(WINDOW):
        h[at + k] = 0
    for k in (1, 2, 4, 8, 16):  # doubles the number of bytes that each value covers
        h[k:] += h[:-k] << np.uint32(k)
    return h


def cut_points(length: int, hard: list[int], easy: list[int], base: int, h: int, e: int) -> list[int]:
    """Ends of the chunks of one text at ``base`` of the flat array; h and e are where its candidates begin."""
    ends, at = [], 0
    while length - at > LEAST:
        normal, most = min(at + NORMAL, length), min(at + MOST, length)
        h = bisect_left(hard, base + at + LEAST - 1, h)
        if h < len(hard) and hard[h] + 1 <= base + normal:
            end = hard[h] + 1 - base
        else:
            e = bisect_left(easy, base + normal - 1, e)
            end = easy[e] + 1 - base if e < len(easy) and easy[e] + 1 <= base + most else most
        ends.append(end)
        at = end
    if at < length:
        ends.append(length)
    return ends


def chunks(texts: list[str]) -> list[dict[bytes, int]]:
    """Of each text: chunk digest -> chunk length in bytes."""
    raw = [t.encode() for t in texts]
    if not raw:
        return []
    top = gear_hashes(raw) >> np.uint32(32 - HARD_BITS)
    hard = np.flatnonzero(top == 0).tolist()
    easy = np.flatnonzero(top >> np.uint32(HARD_BITS - EASY_BITS) == 0).tolist()
    out, base = [], 0
    for text in raw:
        at, own = 0, {}
        for end in cut_points(len(text), hard, easy, base, bisect_left(hard, base), bisect_left(easy, base)):
            own[xxhash.xxh3_64_digest(text[at:end])[:DIGEST]] = end - at
            at = end
        out.append(own)
        base += len(text) + WINDOW
    return out


def packed(own: dict[bytes, int]) -> bytes:
    """Digests, each with a byte for its length, which is 1 to ``MOST``."""
    return b"".join(d + (n - 1).to_bytes(1) for d, n in own.items())


def unpacked(raw: bytes) -> dict[bytes, int]:
    width = DIGEST + 1
    return {raw[k : k + DIGEST]: raw[k + DIGEST] + 1 for k in range(0, len(raw), width)}


def written(own: dict[bytes, int]) -> str:
    return ",".join(sorted(f"{d.hex()}:{n}" for d, n in own.items()))


def likeness(one: dict[bytes, int], other: dict[bytes, int]) -> float:
    longer = max(sum(one.values()), sum(other.values()))
    if not longer:
        return 1.0
    return sum(n for d, n in one.items() if d in other) / longer


def containment(one: dict[bytes, int], other: dict[bytes, int]) -> float:
    """Share of ``one`` that ``other`` holds."""
    total = sum(one.values())
    return sum(n for d, n in one.items() if d in other) / total if total else 1.0


def _groups(texts: list[str], chars: int = 1_000_000):
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size > chars or k + 1 == len(texts):
            yield start, k + 1
            start, size = k + 1, 0


def _packed_column(texts: pd.Series) -> pd.Series:
    texts = [t or "" for t in texts]
    return pd.Series([packed(c) for a, b in _groups(texts) for c in chunks(texts[a:b])], dtype=object)


def fingerprint_texts(texts: pd.Series) -> pd.Series:
    """The written fingerprint of each text."""
    texts = [t or "" for t in texts]
    return pd.Series([written(c) for a, b in _groups(texts) for c in chunks(texts[a:b])], dtype=object)


def _squeezed(texts: pd.Series) -> pd.Series:
    return pd.Series([zlib.compress((t or "").encode()) for t in texts], dtype=object)


def _head(plain: str | None, squeezed: bytes | None) -> str:
    return plain or "" if squeezed is None else zlib.decompress(squeezed).decode()


COMPARED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(texts: pd.Series, heads: pd.Series, squeezed: pd.Series, prints: pd.Series) -> pd.DataFrame:
    texts = [t or "" for t in texts]
    edited = [t[: len(t) - len(t) // 4] + _head(h, s)[: len(t) // 4] for t, h, s in zip(texts, heads, squeezed)]
    rows = []
    for a, b in _groups(texts):
        for text, edit, own, new, after in zip(texts[a:b], edited[a:b], chunks(texts[a:b]), chunks(edited[a:b]), prints[a:b]):
            digest = hashlib.sha256(edit.encode()).hexdigest()
            rows.append((len(text), digest, written(own), written(new), likeness(own, new), likeness(own, unpacked(after or b""))))
    return pd.DataFrame(rows, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids`` (one row for each ``key``, with ``n`` and ``single``) and next_key, prev_key and prev_n in a circle.

    Keys are dealt by range; within a range the window finds the neighbours, and only the first and last key of each
    range meet in one small window.
    """
    ranged = store(ids.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ids")
    order = Window.partitionBy("part").orderBy("key")
    ends = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("n", "key").alias("last_n"))
    row = Window.orderBy("first")
    whole = Window.partitionBy()
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first").over(row), F.min("first").over(whole)).alias("next_first"),
        F.coalesce(F.lag("last").over(row), F.max("last").over(whole)).alias("prev_last"),
        F.coalesce(F.lag("last_n").over(row), F.max_by("last_n", "last").over(whole)).alias("prev_last_n"),
    )
    inside = ranged.select(
        "part", "key", "single", F.lead("key").over(order).alias("next"), F.lag("key").over(order).alias("prev"), F.lag("n").over(order).alias("prev_n")
    )
    return inside.join(ends, "part").select(
        "key", "single", F.coalesce("next", "next_first").alias("next_key"), F.coalesce("prev", "prev_last").alias("prev_key"),
        F.when(F.col("prev").isNull(), F.col("prev_last_n")).otherwise(F.col("prev_n")).alias("prev_n"),
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id and, of each text: n_chars, digest of its edited text, both fingerprints, and likeness to the edited text and
    the next document. The text is shuffled once; the next document's part in it is its head, compressed unless its id has
    several rows, whose smallest text stands for it, and its packed fingerprint."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    ids = keyed.groupBy("key").agg(F.max(F.length("text")).alias("n"), (F.count("*") == 1).alias("single"))
    links = store(neighbours(ids).select(F.col("key").alias("link"), "prev_key", "prev_n", "single"), "links")
    known = keyed.join(links, F.col("key") == F.col("link")).select("key", "text", "prev_key", "prev_n", "single")
    head = F.expr("left(text, cast(prev_n div 4 as int))")
    heads = known.select(
        F.col("prev_key").alias("of"),
        F.struct(
            F.when(~F.col("single"), head).alias("head"),
            F.when(F.col("single"), F.pandas_udf(_squeezed, "binary")(head)).alias("squeezed"),
            F.pandas_udf(_packed_column, "binary")("text").alias("print"),
        ).alias("after"),
    )
    heads = heads.groupBy("of").agg(F.min("after").alias("after"))
    out = known.join(heads, F.col("key") == F.col("of"))
    doc_id = F.when(F.col("key") != LAST_KEY, F.col("key")).alias("doc_id")
    return out.select(doc_id, F.pandas_udf(_compare, COMPARED)("text", "after.head", "after.squeezed", "after.print").alias("r")).select("doc_id", "r.*")
