from collections import Counter
from math import floor, isfinite

import duckdb
import numpy as np

from bazaarlake.llm import negatives, queries
from checks.verify import rows_of


def brute(rows, every=100, k=5):
    """rows: (vec_id, label, whole numbers)."""
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), b, m) for b, m, w in rows if b != a)
        for s, p, _ in [x for x in scores if x[2] == label][:k]:
            fit = [x for x in scores if x[2] != label and -80 * s <= -100 * x[0] <= -100 * s][:k]
            out += [(a, p, n + 1, b, -s, -t) for n, (t, b, _) in enumerate(fit)]
    return sorted(out)


def clustered(n, width=16, seed=5, noise=0.15):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, width))
    x = (centres[random.integers(0, 12, n)] + noise * random.normal(size=(n, width))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[n // 3 : n // 2] = x[0]  # one vector many times
    return [(k, x[k].tolist(), int(random.integers(0, 5)) if k % 3 else 1) for k in range(n)]


def test_curve_is_a_curve():
    """Every cell once, and each step goes to a neighbouring cell."""
    for width, bits in ((2, 3), (3, 2), (4, 1), (1, 4)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width), axis=-1).reshape(-1, width)
        place = negatives.hilbert_index(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold():
    random = np.random.default_rng(1)
    x, a = random.integers(-300, 300, (200, 8)), random.integers(-300, 300, (50, 8))
    least, most = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = a @ x.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    assert negatives.dot(np.array([[1 << 29]]), np.array([[(1 << 29) + 1]])).tolist() == [[(1 << 58) + (1 << 29)]]


def test_query_against_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        connection = duckdb.connect()
        connection.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
        frame = queries.op13_negatives(spark, folder)
        cursor = connection.execute(queries.OP13_SQL)
        assert rows_of(frame.columns, frame.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())
        assert Counter(t for _, t in frame.dtypes) == {"bigint": 5, "int": 1}


def test_many_blocks_and_pages(spark):
    rows = clustered(1200)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = negatives.mine(frame, every=20, block_rows=32, page_blocks=4)
    whole = [(i, m, [floor(256 * float(x)) for x in v]) for i, v, m in rows]
    assert sorted(map(tuple, got.collect())) == brute(whole, every=20)


def test_blocks_are_left_out(spark):
    """On clustered vectors most blocks are read for few anchors."""
    frame = spark.createDataFrame(clustered(2000, noise=0.02), "vec_id long, embedding array<float>, label int")
    placed = negatives.numbered(negatives.on_curve(negatives.quantised(frame)), [negatives.F.col("h")], "test")
    blocks = negatives.blocks_of(placed, 10, 5, 25).toPandas()
    q = np.concatenate([np.frombuffer(v, "<i4").reshape(-1, 16) for v in blocks["a_vectors"]]).astype(np.int64)
    low, high = (np.stack([np.frombuffer(v, "<i4") for v in blocks[c]]).astype(np.int64) for c in ("low", "high"))
    _, most = negatives.bounds(q, low, high)
    assert (most >= 0.8 * 256 * 256).mean() < 0.4


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.75], 1), (2, [0.9, 0.5], 2), (3, None, 2), (4, [nan, 1.0], 2),
        (5, [inf, 1.0], 2), (6, [None, 1.0], 2), (7, [1.0, 0.5], None), (8, [1.0], 2), (9, [], 2), (None, [1.0, 0.5], 2),
        (10, [0.0, 0.0], 2), (11, [0.9, 0.5], 2), (100, [1e30, 1.0], 1), (200, [-1.0, -1.0], 3), (2, [0.9, 0.5], 2),
    ]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "vec_id long, embedding array<double>, label int, at string")
    seen = {}
    for i, v, m in rows:
        if i is not None and m is not None and v and len(v) == 2 and all(x is not None and isfinite(x) and abs(x) < 1e9 for x in v):
            seen[i] = (i, m, [floor(256 * x) for x in v])
    want = brute(list(seen.values()))
    assert sorted(map(tuple, negatives.mine(frame).collect())) == want and len(want) == 2
    assert negatives.mine(frame.where("vec_id < -1")).count() == 0
    assert negatives.mine(frame.where("vec_id between 1 and 11")).count() == 0
