"""Hard negatives over Hilbert-ordered blocks with zone maps.

Vectors are whole numbers, floor(256 * x) of each component, and a score is their inner product, so results are exact.
Rows are sorted by label, place on a Hilbert curve through the most spread dimensions, and id; every ``BLOCK_ROWS`` rows are one
block of a Parquet table, with the least and greatest value of each dimension (its zone map) and its range of labels.

* Interval arithmetic over a zone map bounds the scores of an anchor with a block from both sides. A block is read for an
  anchor only if the bounds meet what the anchor asks for.
* Positives: the own block gives five scores at first; blocks of the same label whose bound reaches the fifth are read.
* Negatives: each positive opens a window of scores; blocks with other labels whose bounds meet a window are read.
* Zone maps come in pages of ``PAGE_BLOCKS``. Anchors are sent to pages, then to the blocks that they must read, in the groups in
  which they lie in the table. A task sorts what it gets by page or block and streams the anchors past it, so it holds
  one block and one group at a time.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part, nor do vectors
of another length than most, empty ones, or those with components so large that scores might leave 60 bits. Of several rows of one id the smallest by label,
then vector, stands. An anchor with fewer positives or negatives gets those there are; a table without anchors gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import numbered, store

BLOCK_ROWS = 4096
PAGE_BLOCKS = 4096
CURVE_DIMENSIONS, CURVE_BITS = 12, 5
NONE = -(1 << 62)


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``axes`` (whole numbers below 2**bits; columns * bits at most 63).

    Works through the bits from the top: each level undoes the rotation of the cell it lies in, then a Gray code orders the cells.
    """
    x = axes.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for row in x:
            upper = (row >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ row) & low)
            x[0] ^= np.where(upper, low, swap)
            row ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            out = out << 1 | (row >> bit & 1)
    return out


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers."""
    width = a.shape[1]
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with a vector inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return dot(up, low) + dot(down, high), dot(up, high) + dot(down, low)


def best(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k places among ``at`` with the largest scores, ties by smaller id."""
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").astype(np.int64).reshape(rows, -1)


def _longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id, label, q (floor(256 * x) of each component) of the rows that take part, one for each id."""
    v = rows.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and label is not null and v is not null and size(v) > 0")
    most = F.sqrt(F.lit(float(1 << 60)) / F.size("v")) / 256  # scores and their bounds stay below 2**62
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most))
    v = v.where(F.coalesce(fine, F.lit(False)))
    q = F.transform("v", lambda x: F.floor(x * 256).cast("int"))
    v = v.select(F.col("vec_id").cast("long"), "label", q.alias("q"))
    v = store(v.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("one")).select("vec_id", "one.label", "one.q"), "quantised")
    widths = v.groupBy(F.size("q").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    return v.where(F.size("q") == widths[0]["width"]) if widths else v


def on_curve(rows: DataFrame) -> DataFrame:
    """``rows`` with ``h``, the place on the Hilbert curve through the dimensions of the largest variance."""
    spread = rows.select(F.posexplode("q").alias("d", "x")).groupBy("d").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
    most = spread.orderBy(F.desc("sd"), "d").limit(CURVE_DIMENSIONS).collect()
    dims = [r["d"] for r in most]
    mean, sd = np.array([r["mean"] for r in most]), np.array([r["sd"] for r in most]) + 1e-9
    cells = 1 << CURVE_BITS

    @F.pandas_udf("long")
    def place(q: pd.Series) -> pd.Series:
        if not len(q):
            return pd.Series([], dtype="int64")
        x = (np.stack(q.to_numpy())[:, dims] - mean) / sd  # two deviations to either side fill the cells
        return pd.Series(hilbert_index(np.clip((x + 2) * cells / 4, 0, cells - 1).astype(np.int64), CURVE_BITS))

    return rows.withColumn("h", place("q")) if dims else rows.withColumn("h", F.lit(0).cast("long"))


_BLOCK = (
    "block long, ids binary, labels binary, vectors binary, low binary, high binary, first_label long, last_label long, "
    "a_ids binary, a_labels binary, a_vectors binary, a_floor binary"
)


def blocks_of(placed: DataFrame, every: int, positives: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each block: its rows, its zone map, and its anchors with the score of the last of ``positives`` rows of
    their label in the block."""

    def block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, labels = (table.column(c).to_numpy().astype("<i8") for c in ("vec_id", "label"))
        q = np.stack(table.column("q").to_numpy(zero_copy_only=False)).astype("<i4")
        order = np.argsort(ids)
        ids, labels, q = ids[order], labels[order], q[order]
        own = np.flatnonzero(ids % every == 0)
        scores = dot(q[own].astype(np.int64), q.astype(np.int64))
        floor = np.full(len(own), NONE, "<i8")
        for k, a in enumerate(own):
            found = best(scores[k], ids, np.flatnonzero((labels == labels[a]) & (ids != ids[a])), positives)
            if len(found) == positives:
                floor[k] = scores[k][found[-1]]
        blobs = (ids, labels, q, q.min(axis=0), q.max(axis=0))
        anchors = (ids[own], labels[own], q[own], floor)
        values = [key[0].as_py(), *(x.tobytes() for x in blobs), int(labels.min()), int(labels.max()), *(x.tobytes() for x in anchors)]
        names = [c.split(" ")[0] for c in _BLOCK.split(", ")]
        return pa.table({n: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for n, v in zip(names, values)})

    rows = placed.select(F.floor(F.col("at") / block_rows).alias("block"), "vec_id", "label", "q")
    return store(rows.groupBy("block").applyInArrow(block, _BLOCK), "blocks")


_PAGE = "page long, blocks binary, low binary, high binary, first_labels binary, last_labels binary"


def pages_of(blocks: DataFrame, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """The zone maps of up to ``page_blocks`` blocks a row."""

    def page(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        longs = {c: table.column(c).to_numpy().astype("<i8").tobytes() for c in ("block", "first_label", "last_label")}
        joined = {c: b"".join(table.column(c).to_pylist()) for c in ("low", "high")}
        values = [longs["block"], joined["low"], joined["high"], longs["first_label"], longs["last_label"]]
        names = [c.split(" ")[0] for c in _PAGE.split(", ")]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), *(pa.array([v], pa.binary()) for v in values)], names)

    rows = blocks.select(F.floor(F.col("block") / page_blocks).alias("page"), "block", "low", "high", "first_label", "last_label")
    return store(rows.groupBy("page").applyInArrow(page, _PAGE), "pages")


#: What stands still (kind 0) and the groups of anchors that pass it (kind 1), under one key.
_PARTS = ("ids", "labels", "vectors", "low", "high", "first", "last", "wanted")
_STREAM = ["key", "kind", "home", *_PARTS]


def _part(rows: DataFrame, key: str | Column, kind: int, home: str | Column, **given: str) -> DataFrame:
    parts = [F.col(given[p]).alias(p) if p in given else F.lit(None).cast("binary").alias(p) for p in _PARTS]
    key, home = (F.col(c) if isinstance(c, str) else c for c in (key, home))
    return rows.select(key.cast("long").alias("key"), F.lit(kind).alias("kind"), home.cast("long").alias("home"), *parts)


def _passing(held: DataFrame, asked: DataFrame, meet: Callable[[dict, dict], dict | None], kind: str) -> DataFrame:
    """Streams the rows of ``asked`` past the row of ``held`` with the same key; ``meet`` gives columns of results."""
    names = [c.split(" ")[0] for c in kind.split(", ")]
    types = [pa.binary() if c.endswith("binary") else pa.int64() for c in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        still = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    still = row
                elif still is not None and still["key"] == row["key"]:
                    out = meet(still, row)
                    if out is not None and len(out[names[0]]):
                        yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names)

    rows = held.unionByName(asked).repartition("key").sortWithinPartitions("key", "kind", "home")
    return rows.select(*_STREAM).mapInArrow(run, kind)


def _to_blocks(pages: DataFrame, anchors: DataFrame, needed: Callable[..., np.ndarray]) -> DataFrame:
    """The groups of anchors for each block they must read; ``anchors`` come with the pages they ask (column ``page``)."""
    held = _part(
        pages, "page", 0, F.lit(0), ids="blocks", low="low", high="high", first="first_labels", last="last_labels"
    )

    def meet(page: dict, group: dict) -> dict:
        names, ids = _longs(page["ids"]), _longs(group["ids"])
        labels, vectors = _longs(group["labels"]), _matrix(group["vectors"], len(ids))
        wanted = _longs(group["wanted"]).reshape(len(ids), -1)
        least, most = bounds(vectors, _matrix(page["low"], len(names)), _matrix(page["high"], len(names)))
        hit = needed(least, most, labels, wanted, _longs(page["first"]), _longs(page["last"]))
        out: dict[str, list] = {n: [] for n in ("key", "home", "ids", "labels", "vectors", "wanted")}
        for b in np.flatnonzero(hit.any(axis=0)).tolist():
            own = hit[:, b]
            values = (int(names[b]), group["home"], *(x[own].tobytes() for x in (ids, labels, vectors.astype("<i4"), wanted)))
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    asked = _part(anchors, "page", 1, "block", ids="a_ids", labels="a_labels", vectors="a_vectors", wanted="wanted")
    rows = _passing(held, asked, meet, "key long, home long, ids binary, labels binary, vectors binary, wanted binary")
    return store(rows, "asked-blocks")


def _in_blocks(blocks: DataFrame, asked: DataFrame, find: Callable[..., Iterator[tuple]], kind: str) -> DataFrame:
    """What ``find`` yields for each anchor in each block that it reads; no other block is read."""
    read = blocks.join(asked.select(F.col("key").alias("block")).distinct(), "block", "left_semi")
    held = _part(read, "block", 0, "block", ids="ids", labels="labels", vectors="vectors")
    given = _part(asked, "key", 1, "home", ids="ids", labels="labels", vectors="vectors", wanted="wanted")
    names = [c.split(" ")[0] for c in kind.split(", ")]

    def meet(block: dict, group: dict) -> dict:
        ids, labels, a_ids, a_labels = (_longs(r[c]) for r in (block, group) for c in ("ids", "labels"))
        wanted = _longs(group["wanted"]).reshape(len(a_ids), -1)
        scores = dot(_matrix(group["vectors"], len(a_ids)), _matrix(block["vectors"], len(ids)))
        rows = [
            (group["home"], *row) for k in range(len(a_ids)) for row in find(scores[k], ids, labels, a_ids[k], a_labels[k], wanted[k])
        ]
        return dict(zip(names, zip(*rows))) if rows else {names[0]: ()}

    return _passing(held, given, meet, kind)


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
    block_rows: int = BLOCK_ROWS, page_blocks: int = PAGE_BLOCKS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows whose id is divisible by ``every``.

    A negative has another label and a score of at least ``share`` of the positive's and at most the positive's.
    """
    placed = numbered(on_curve(quantised(rows)), [F.col("label"), F.col("h"), F.col("vec_id")], "curve")
    blocks = blocks_of(placed, every, positives, block_rows)
    pages = pages_of(blocks, page_blocks)
    anchors = blocks.where(F.length("a_ids") > 0)
    # The pages from the first row of a block's first label to the last row of its last.
    spans = placed.groupBy("label").agg(F.min("at").alias("from"), F.max("at").alias("to"))
    near = anchors.join(spans.select(F.col("label").alias("first_label"), "from"), "first_label")
    near = near.join(spans.select(F.col("label").alias("last_label"), "to"), "last_label")
    page_rows = block_rows * page_blocks
    pages_asked = F.sequence(F.floor(F.col("from") / page_rows), F.floor(F.col("to") / page_rows))
    near = near.select(F.explode(pages_asked).alias("page"), "block", "a_ids", "a_labels", "a_vectors", F.col("a_floor").alias("wanted"))

    def same_label(least, most, labels, wanted, first, last):
        return (most >= wanted[:, :1]) & (labels[:, None] >= first) & (labels[:, None] <= last)

    def find_positives(scores, ids, labels, own, label, wanted):
        at = np.flatnonzero((labels == label) & (ids != own) & (scores >= wanted[0]))
        return ((int(own), int(ids[k]), int(scores[k])) for k in best(scores, ids, at, positives))

    asked = _to_blocks(pages, near, same_label)
    found = _in_blocks(blocks, asked, find_positives, "home long, anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = store(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives), "positives")

    def windows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Each anchor's positives and their scores, padded to ``positives`` of each."""
        ids, pairs = {}, table.select(["anchor_id", "nth", "positive_id", "positive_score"]).to_pylist()
        for p in pairs:
            ids.setdefault(p["anchor_id"], np.full((2, positives), NONE, "<i8"))[:, p["nth"] - 1] = p["positive_id"], p["positive_score"]
        names = np.array(sorted(ids), "<i8")
        values = (names.tobytes(), b"".join(ids[a].tobytes() for a in names.tolist()))
        return pa.table([pa.array([key[0].as_py()], pa.int64()), *(pa.array([v], pa.binary()) for v in values)], ["home", "with_ids", "windows"])

    opened = found.groupBy("home").applyInArrow(windows, "home long, with_ids binary, windows binary")
    asking = anchors.join(opened, F.col("block") == F.col("home"))

    @F.pandas_udf("a_ids binary, a_labels binary, a_vectors binary")
    def chosen(a_ids: pd.Series, a_labels: pd.Series, a_vectors: pd.Series, with_ids: pd.Series) -> pd.DataFrame:
        """The anchors that have positives, in the order of ``with_ids``."""
        out = []
        for i, own, v, w in zip(a_ids, a_labels, a_vectors, with_ids):
            at = np.searchsorted(_longs(i), _longs(w))  # a block's rows stand by id
            out.append((w, _longs(own)[at].tobytes(), np.frombuffer(v, "<i4").reshape(len(i) // 8, -1)[at].tobytes()))
        return pd.DataFrame(out, columns=["a_ids", "a_labels", "a_vectors"])

    asking = asking.select("block", chosen("a_ids", "a_labels", "a_vectors", "with_ids").alias("a"), F.col("windows").alias("wanted"))
    last_page = (blocks.agg(F.max("block")).first()[0] or 0) // page_blocks
    asking = asking.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_page).cast("long"))).alias("page"), "block", "a.*", "wanted"
    )
    numerator, denominator = share

    def window(wanted):
        """Least and greatest score in the windows of anchors (rows of positive ids, then of scores)."""
        top = wanted[..., positives:]
        return top // denominator * numerator - (-(top % denominator) * numerator) // denominator, top

    def other_label(least, most, labels, wanted, first, last):
        low, top = window(wanted)
        other = (labels[:, None] != first) | (labels[:, None] != last)
        return other & sum((most >= low[:, [k]]) & (least <= top[:, [k]]) & (top[:, [k]] >= 0) for k in range(positives)).astype(bool)

    def find_negatives(scores, ids, labels, own, label, wanted):
        low, top = window(wanted)
        other = np.flatnonzero(labels != label)
        own_scores = scores[other]
        for k in np.flatnonzero(top >= 0).tolist():
            at = other[(own_scores >= low[k]) & (own_scores <= top[k])]
            for c in best(scores, ids, at, negatives):
                yield int(own), int(wanted[k]), int(ids[c]), int(top[k]), int(scores[c])

    asked = _to_blocks(pages, asking, other_label)
    kind = "home long, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = _in_blocks(blocks, asked, find_negatives, kind)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``rows`` in which every ``every``-th id has the next of ``labels`` labels."""
    label = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", label.alias("label"))
