"""Bloom filters of 16-byte keys that tasks build and merge: of keys seen once and of keys seen twice.

The size of a filter is a power of two of bits, at most ``MAX_BITS``, so what is merged and broadcast is bounded. A
filter that is too full suspects more keys; callers confirm exactly, so results do not change.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from bazaarlake.sources.tables import shuffles_dropped

PROBES = 3
MAX_BITS = 1 << 30
CHUNK = 1 << 15  # bytes of a filter that are merged together


def bits_for(keys: int) -> int:
    return min(MAX_BITS, max(1 << 18, 1 << int(16 * keys - 1).bit_length()))


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions (keys x PROBES) of 16-byte digests, given as pairs of 64-bit numbers; bits is a power of two."""
    first, step = keys[:, 0], keys[:, 1] | np.uint64(1)
    probe = np.arange(PROBES, dtype=np.uint64)
    return ((first[:, None] + probe * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def holds(filter_bytes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def mark(filter_bytes: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(filter_bytes, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _packed(part: np.ndarray) -> bytes:
    return zlib.compress(part.tobytes(), 1)


def task_filters(key_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int):
    """A mapInArrow function: the chunks of the two filters of a task's keys (rows of two 64-bit numbers).

    ``key_batches`` gives the keys; a key that stands twice counts as seen twice.
    """

    def run(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for keys in key_batches(batches):
            if len(keys):
                order = np.lexsort((keys[:, 1], keys[:, 0]))
                keys = keys[order]
                new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
                again = np.r_[~new[1:], False][new]
                at = positions(keys[new], bits)
                mark(twice, at[again | holds(once, at)])
                mark(once, at)
        for k in range(0, len(once), CHUNK):
            if once[k : k + CHUNK].any():
                row = [pa.array([k], pa.int64()), *(pa.array([_packed(f[k : k + CHUNK])], pa.binary()) for f in (once, twice))]
                yield pa.RecordBatch.from_arrays(row, ["chunk", "once", "twice"])

    return run


def _merge(parts: pd.DataFrame) -> pd.DataFrame:
    """A bit is in the merged second filter if a task has it there, or two tasks have it in their first."""
    once, twice = np.zeros(CHUNK, np.uint8), np.zeros(CHUNK, np.uint8)
    for a, b in zip(parts["once"], parts["twice"]):
        own = np.frombuffer(zlib.decompress(a), np.uint8)
        twice |= np.frombuffer(zlib.decompress(b), np.uint8) | (once & own)
        once |= own
    return pd.DataFrame({"chunk": [parts["chunk"].iloc[0]], "once": [_packed(once)], "twice": [_packed(twice)]})


def build(rows: DataFrame, key_batches, bits: int, which: str = "twice") -> np.ndarray:
    """The merged filter (bits / 8 bytes) of the keys in ``rows``; its chunks come to the driver one by one, then their shuffle goes."""
    out = np.zeros(bits // 8, np.uint8)
    with shuffles_dropped(rows.sparkSession):
        parts = rows.mapInArrow(task_filters(key_batches, bits), "chunk long, once binary, twice binary")
        merged = parts.groupBy("chunk").applyInPandas(_merge, "chunk long, once binary, twice binary").select("chunk", which)
        for chunk, part in merged.collect():
            out[chunk : chunk + CHUNK] = np.frombuffer(zlib.decompress(part), np.uint8)
    return out
