"""Packing documents into token windows by minimum bin slack.

A document's full windows are sequences of their own; what remains of it has one of ``window - 1`` lengths. The plan is made on the
histogram of these lengths, so it does not grow with the documents: the largest remaining length opens a window, subset sums
over the other lengths (one bit a sum, lengths by number at hand) find the fill nearest to the window's end, and counts are
backtracked. The same fill is used as often as the histogram allows. Only where a fill leaves slack, the largest remaining
length is cut to close it. The tokens that fill no whole window at the end go into windows of powers of two, so nothing is padded.

Documents find their places without being brought together by length: each task numbers its rows of a length, and the numbers
are shifted by what the tasks before it hold. The tokens are written once with these numbers, so a retried task gives the
same places.

Defined cases: null and empty texts are one token, the end mark; repeated rows are documents of their own; an id may be null;
texts of any length are encoded whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm import bpe
from bazaarlake.llm.common import running_offsets, store

WINDOW = 2048
END = 1
CACHE_WORDS = 400_000


#: Lower-case texts of these characters alone are split by PLAIN as by SPLIT, several times as fast: ASCII without odd controls,
#: Latin letters, and marks that are no letter, number or white space.
SIMPLE = re.compile("[\t-\r -~¡-©«-±´¶-¸»¿ß-öø-ʯ‐-‧‰-⁞€]*")
PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ʯ]+|[0-9]|[^\t-\r 0-9a-zß-öø-ʯ]+")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds(dict):
    """The ids of words as bytes, encoded many at a time."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = bpe.tokenizer(path)
        self.plain = self.tokenizer.pattern.pattern == SPLIT

    def words(self, text: str) -> list[str]:
        if self.plain and "<|" not in text:
            low = (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()
            if SIMPLE.fullmatch(low):
                return PLAIN.findall(low)
        return self.tokenizer.pieces(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        words = list(map(self.words, texts))
        if len(self) > CACHE_WORDS:
            self.clear()
        new = set().union(*words).difference(self)
        if new:
            self.tokenizer.learn(new)
            self.update((w, self.tokenizer.cache[w][0]) for w in new)
        return [b"".join(map(self.__getitem__, own)) for own in words]


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The words known so far to this Python worker."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def _groups(texts: list[str | None], chars: int = 2_000_000):
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size > chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoded(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, n (tokens with the end mark), ids, part (the task), full_before (full windows of the task's earlier rows) and
    nth (the task's earlier rows whose last window holds as many tokens); written once."""
    mark = np.array([end], "<u4").tobytes()

    def run(batches):
        part, full, seen, known = TaskContext.get().partitionId(), 0, [0] * window, word_ids(path)
        for batch in batches:
            ids = [x + mark for group in _groups(batch.column(1).to_pylist()) for x in known.encode(group)]
            sizes = [len(x) // 4 for x in ids]
            before, nth = [], []
            for n in sizes:
                before.append(full)
                full += n // window
                nth.append(seen[n % window])
                seen[n % window] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in (sizes, before, nth, [part] * len(ids))), pa.array(ids, pa.binary())],
                ["doc_id", "n", "full_before", "nth", "part", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, full_before long, nth long, part long, ids binary")
    return store(rows, "tokens")


def least_slack(stock: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best: the largest length that fits, and the subset of the others (at most as
    many as there are) with the largest sum."""
    lengths = sorted((n for n, c in stock.items() if c and n <= room), reverse=True)
    if not lengths:
        return {}
    goal = room - lengths[0]
    mask = (1 << (goal + 1)) - 1
    sums, steps = 1, []
    for n in lengths:
        most = min(stock[n] - (n == lengths[0]), goal // n)
        if most <= 0:
            continue
        steps.append((n, most, sums))
        take = 1
        while most:
            take = min(take, most)
            sums |= (sums << (take * n)) & mask
            most -= take
            take *= 2
        if sums >> goal & 1:
            break
    at = sums.bit_length() - 1
    chosen = {lengths[0]: 1}
    for n, most, before in reversed(steps):
        count = next(k for k in range(most + 1) if at >= k * n and before >> (at - k * n) & 1)
        if count:
            chosen[n] = chosen.get(n, 0) + count
            at -= count * n
    return chosen


class Plan:
    """Places of all remainders, by length and number among the remainders of that length."""

    def __init__(self, histogram: dict[int, int], window: int = WINDOW, first: int = 0):
        self.sequences = first
        self._runs = {n: [(n, 0, 0, c)] for n, c in histogram.items() if n and c}
        self._stock = {n: c for n, c in histogram.items() if n and c}
        self._rows: dict[int, list[tuple]] = {n: [] for n in self._stock}
        tokens = sum(n * c for n, c in self._stock.items())
        while tokens:
            room = window if tokens >= window else 1 << (tokens.bit_length() - 1)
            tokens -= room * self._fill(room)
        self._places = {n: self._segments(rows) for n, rows in self._rows.items()}

    def _fill(self, room: int) -> int:
        """Fills as many windows of ``room`` alike as the stock allows; at least one."""
        chosen = least_slack(self._stock, room)
        slack = room - sum(n * c for n, c in chosen.items())
        need = dict(chosen)
        if slack:
            # Whatever is left is longer than the slack, else it would have been chosen.
            cut = max(n for n, c in self._stock.items() if c > chosen.get(n, 0))
            need[cut] = need.get(cut, 0) + 1
        times = min(self._stock[n] // c for n, c in need.items())
        offset = 0
        for n, c in chosen.items():
            self._place(self._take(n, c * times), n, c, offset)
            offset += n * c
        if slack:
            runs = self._take(cut, times)
            self._place(runs, slack, 1, offset)
            for origin, start, first, count in runs:
                self._runs.setdefault(cut - slack, []).append((origin, start + slack, first, count))
            self._stock[cut - slack] = self._stock.get(cut - slack, 0) + times
        self.sequences += times
        return times

    def _take(self, n: int, count: int) -> list[tuple]:
        self._stock[n] -= count
        if not self._stock[n]:
            del self._stock[n]
        out, runs = [], self._runs[n]
        while count:
            origin, start, first, held = runs.pop()
            own = min(held, count)
            if held > own:
                runs.append((origin, start, first + own, held - own))
            out.append((origin, start, first, own))
            count -= own
        return out

    def _place(self, runs: list[tuple], n: int, each: int, offset: int) -> None:
        """Pieces of length ``n`` in the given order, ``each`` of them in every window, from ``offset`` on."""
        done = 0
        for origin, start, first, count in runs:
            self._rows[origin].append((first, first + count, start, n, done, each, offset, self.sequences))
            done += count

    @staticmethod
    def _segments(rows: list[tuple]) -> tuple[list[int], list[list[tuple]]]:
        edges = sorted({r[0] for r in rows} | {r[1] for r in rows})
        held: list[list[tuple]] = [[] for _ in edges]
        for row in sorted(rows, key=lambda r: r[2]):
            for k in range(bisect_right(edges, row[0]) - 1, bisect_right(edges, row[1] - 1)):
                held[k].append(row)
        return edges, held

    def pieces(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """start (in the remainder), length, sequence and offset of the pieces of one remainder."""
        edges, held = self._places[length]
        out = []
        for first, _, start, n, done, each, offset, sequence in held[bisect_right(edges, number) - 1]:
            at = done + number - first
            out.append((start, n, sequence + at // each, offset + at % each * n))
        return out


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (its tokens as little-endian 32-bit numbers), doc_tokens, sequence_id, offset."""
    rows = encoded(docs, path or bpe.default_path(), window, end).withColumn("rest", F.col("n") % window)
    counts = rows.groupBy("part", "rest").agg(F.count("*").alias("rows"), F.sum(F.floor(F.col("n") / window)).alias("full"))
    counts = store(counts, "token-counts")
    sizes = counts.groupBy("rest").agg(F.sum("rows").alias("rows"), F.sum("full").alias("full")).collect()  # at most ``window`` rows
    plan = Plan({r["rest"]: r["rows"] for r in sizes}, window, sum(r["full"] for r in sizes))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "rest", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rest_base"))
    full = running_offsets(counts.groupBy("part").agg(F.sum("full").alias("full")), "part", "full")
    base = base.join(full.select("part", F.col("offset").alias("full_base")), "part")

    @F.pandas_udf("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    def places(rest: pd.Series, number: pd.Series) -> pd.Series:
        names = ("start", "length", "sequence_id", "offset")
        return pd.Series([[dict(zip(names, p)) for p in plan.pieces(n, k)] if n else [] for n, k in zip(rest, number)], dtype=object)

    placed = rows.join(base, ["part", "rest"]).withColumn("last", places("rest", F.col("rest_base") + F.col("nth")))
    whole = F.col("n") - F.col("rest")

    def piece(start, length, sequence, offset):
        return F.struct(
            start.cast("long").alias("start"), length.cast("long").alias("length"),
            F.col("ids").substr((start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"),
            sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"),
        )

    number = F.col("full_base") + F.col("full_before")
    starts = F.when(whole > 0, F.sequence(F.lit(0).cast("long"), F.floor(whole / window) - 1)).otherwise(F.array().cast("array<long>"))
    fulls = F.transform(starts, lambda k: piece(k * window, F.lit(window), number + k, F.lit(0)))
    lasts = F.transform("last", lambda p: piece(whole + p["start"], p["length"], p["sequence_id"], p["offset"]))
    return placed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.concat(fulls, lasts)).alias("p")).select(
        "doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset"
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length, ids of each window: its pieces one after the other."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate(F.col("pieces"), F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("pieces"), F.sum("length").alias("length"))
    return rows.select("sequence_id", "length", joined.alias("ids"))
