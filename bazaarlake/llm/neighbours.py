"""Approximate nearest neighbours by learned partitions.

On a bounded sample: a graph of nearest neighbours is cut into balanced parts, and a softmax classifier learns a vector's
part. The classifier then gives every vector its part and sends each query to its most probable parts, whose vectors
are ranked by exact inner products. The number of parts to search is the least that reaches ``RECALL`` on the sample.

Equal vectors are one class with its smallest ids: they score alike, ties go to the smaller id, so no more of them can ever
be asked for. Parts are split into blocks of about ``BLOCK_ROWS`` classes and queries into blocks of about ``QUERY_ROWS``; a task
ranks one block of a part for one block of queries, so none grows with a part or with the number of queries.

Defined cases: vectors that are null, zero, of another length than most, or hold a null, NaN or infinity take no
part; repeated rows (equal id and vector) count once; a query with fewer other vectors gets all of them; a table without
queries or vectors gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from math import fsum, inf

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import store

SAMPLE = 6000
RECALL = 0.97
NEIGHBOURS = 20
BLOCK_ROWS = 4096
QUERY_ROWS = 8192
MOST_PARTS = 256


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ x.T
        near[np.arange(len(near)), a + np.arange(len(near))] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 2) -> np.ndarray:
    """Parts of almost equal size that cut few edges: halving along the main direction, then moves that gain edges."""
    random = np.random.default_rng(seed)
    part = np.zeros(len(x), np.int64)
    made = 1
    while made < parts:
        sizes = np.bincount(part, minlength=made)
        big = int(sizes.argmax())
        own = np.flatnonzero(part == big)
        centred = x[own] - x[own].mean(axis=0)
        direction = random.normal(size=x.shape[1])
        for _ in range(8):
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) + 1e-12
        part[own[np.argsort(centred @ direction)[len(own) // 2 :]]] = made
        made += 1
    most = int(np.ceil(1.15 * len(x) / parts))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(6):
        moved = 0
        for v in random.permutation(len(x)):
            votes = np.bincount(part[graph[v]], minlength=parts)
            best = int(votes.argmax())
            if votes[best] > votes[part[v]] and sizes[best] < most:
                sizes[part[v]] -= 1
                sizes[best] += 1
                part[v] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return part


class Router:
    """Softmax over parts, linear in the vector."""

    def __init__(self, x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 120):
        goal = 0.5 * np.eye(parts)[part]
        for column in part[graph].T:
            goal[np.arange(len(x)), column] += 0.5 / graph.shape[1]
        self.mean, self.spread = x.mean(axis=0), x.std() + 1e-9
        z = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        self.weights = np.zeros((z.shape[1], parts))
        mean, square = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for k in range(1, rounds + 1):
            g = z.T @ (goal - self._softmax(z @ self.weights)) / len(z) - 1e-4 * self.weights
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            self.weights += 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)

    @staticmethod
    def _softmax(a: np.ndarray) -> np.ndarray:
        e = np.exp(a - a.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        z = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        return np.argsort(-(z @ self.weights), axis=1, kind="stable")


def train(x: np.ndarray, parts: int) -> tuple[Router | None, int]:
    """The router and how many parts a query visits."""
    if parts < 2 or len(x) < 4 * parts:
        return None, 1
    k = min(10, len(x) - 1)
    graph = _graph(x, k)
    part = balanced_parts(x, graph, parts)
    router = Router(x, part, graph, parts)
    asked = np.random.default_rng(3).permutation(len(x))[:600]
    true = _graph(x, min(NEIGHBOURS, len(x) - 1))[asked]
    order = router.order(x)
    place = np.empty_like(order[asked])
    np.put_along_axis(place, order[asked], np.arange(parts)[None, :].repeat(len(asked), 0), 1)
    visit = np.take_along_axis(place, order[true, 0], axis=1)
    found = np.array([(visit <= m).mean() for m in range(parts)])
    return router, int(np.argmax(found >= RECALL)) + 1


def inner(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, summed exactly; where a product or the sum leaves the doubles on the way, in whole fractions."""
    with np.errstate(over="ignore"):
        products = a * b
    if np.isfinite(products).all():
        try:
            return fsum(products.tolist())
        except OverflowError:
            pass
    total = sum(Fraction(x) * Fraction(y) for x, y in zip(a.tolist(), b.tolist()))
    try:
        return float(total)
    except OverflowError:
        return inf if total > 0 else -inf


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where("vec_id is not null")
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda c: c != 0))
    widths = v.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), "width").limit(1).select("width")
    return v.join(F.broadcast(common), F.size("vector") == F.col("width"), "left_semi")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def in_blocks(asked: DataFrame, index: DataFrame, queries: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``block``: queries by a hash of their id, the index once for each block of queries."""
    blocks = max(1, -(-queries // QUERY_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks).cast("long")))
    return asked, index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))) if blocks > 1 else F.lit(0).cast("long"))


def search(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, sample: int = SAMPLE, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each row whose id is divisible by ``every``."""
    rows = store(usable(vectors).distinct(), "vectors")
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    classes = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = store(classes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    n = classes.count()
    if parts is None:
        parts = int(min(MOST_PARTS, round(n**0.5 / 4)))  # below 36 vectors there is one
    chosen = classes.select("vector").orderBy(F.xxhash64("vector")).limit(sample).toPandas() if n else None
    router, visits = train(_matrix(chosen["vector"]), parts) if n else (None, 1)

    @F.pandas_udf("int")
    def part_of(column: pd.Series) -> pd.Series:
        if router is None or not len(column):
            return pd.Series(np.zeros(len(column), np.int32))
        return pd.Series(router.order(_matrix(column))[:, 0].astype(np.int32))

    placed = classes.withColumn("part", part_of("vector"))
    placed = store(placed.withColumn("id", F.col("ids")[0]), "placed")
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # at most MOST_PARTS rows
    blocks = {p: -(-c // BLOCK_ROWS) for p, c in sizes.items()}

    def targets(vectors: np.ndarray) -> list[list[int]]:
        """Part and block, as one number, of each query: its first parts, and more until they hold k + 1 classes."""
        if router is None:
            order = np.zeros((len(vectors), 1), np.int64)
        else:
            order = router.order(vectors)
        out = []
        for row in order.tolist():
            own, held, used = [], 0, 0
            for p in row:
                if used >= visits and held > k:
                    break
                used += 1
                held += sizes.get(p, 0)
                own += [(p << 32) | b for b in range(blocks.get(p, 0))]
            out.append(own)
        return out

    @F.pandas_udf("array<long>")
    def targets_of(column: pd.Series) -> pd.Series:
        return pd.Series(targets(_matrix(column)) if len(column) else [], dtype=object)

    count = F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("part")) if blocks else F.lit(1)
    cell = F.shiftleft(F.col("part").cast("long"), 32).bitwiseOR(F.pmod(F.xxhash64("id"), count))
    index = placed.select(cell.alias("cell"), "vector", "ids")
    queries = rows.where(F.col("vec_id") % every == 0)
    asked = queries.select(F.explode(targets_of("vector")).alias("cell"), F.col("vec_id").alias("query_id"), "vector")
    asked, index = in_blocks(asked, index, queries.count())

    def rank(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(held):
            near, ids = _matrix(held["vector"]), held["ids"].tolist()
            scaled = near / np.abs(near).max()
            take = min(len(near), k + 1)
            names = queries["query_id"].tolist()
            for a in range(0, len(queries), 512):
                own = _matrix(queries["vector"][a : a + 512])
                # Scaled, so that no product overflows; the order within a query stays.
                scores = (own / np.abs(own).max(axis=1, keepdims=True)) @ scaled.T
                best = np.argpartition(-scores, take - 1, axis=1)[:, :take]
                for name, vector, row in zip(names[a : a + 512], own, best.tolist()):
                    found = []
                    for c in row:
                        score = inner(vector, near[c])
                        found += [(-score, i) for i in ids[c] if i != name]
                    found = sorted(found)[:k]
                    out["query_id"] += [name] * len(found)
                    out["vec_id"] += [i for _, i in found]
                    out["score"] += [-s for s, _ in found]
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = asked.groupBy("cell", "block").cogroup(index.groupBy("cell", "block")).applyInPandas(rank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
