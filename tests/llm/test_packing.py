import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bazaarlake.llm import packing, queries
from bazaarlake.llm.common import read


def best_sum(stock, room):
    """By enumeration: the largest sum within ``room`` that has the largest length."""
    lengths = sorted((n for n, c in stock.items() for _ in range(c) if n <= room), reverse=True)
    sums = {lengths[0]} if lengths else {0}
    for n in lengths[1:]:
        sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_least_slack_is_least():
    random.seed(1)
    for _ in range(300):
        stock = dict(Counter(random.choices(range(1, 60), k=random.randint(0, 9))))
        room = random.randint(1, 120)
        chosen = packing.least_slack(stock, room)
        assert all(c <= stock[n] for n, c in chosen.items())
        assert sum(n * c for n, c in chosen.items()) == (best_sum(stock, room) if stock else 0)


@pytest.mark.parametrize("histogram", [
    {}, {1: 1}, {1500: 1000}, {2047: 3}, {1025: 7, 3: 2}, {n: n % 13 + 1 for n in range(1, 2048)}, {700: 33_333_333, 1: 1, 1999: 66_666_667},
])
def test_plan_places_every_token_once_without_padding(histogram):
    plan = packing.Plan(histogram)
    windows, some = defaultdict(list), sum(histogram.values()) < 20_000
    for n, count in histogram.items():
        for k in range(count) if some else {0, count // 2, count - 1}:
            pieces = plan.pieces(n, k)
            assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces[:-1]]).tolist() and sum(p[1] for p in pieces) == n
            for _, length, sequence, offset in pieces:
                windows[sequence].append((offset, length))
    if some:
        assert set(windows) == set(range(plan.sequences))
        for pieces in windows.values():
            pieces.sort()
            assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()
            total = sum(n for _, n in pieces)
            assert total <= 2048 and total & (total - 1) == 0
    assert sum(len(held) for _, held in plan._places.values()) < 30_000  # does not grow with the documents


def check(rows, texts, ids_of):
    """All tokens of all documents (id: text or null) in windows, once each."""
    ids, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        ids[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(ids) == set(texts)
    for doc_id, pieces in ids.items():
        want = [*ids_of(texts[doc_id] or ""), 1]
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            own = np.array(want[at : at + p["length"]], "<u4").tobytes()
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(want), zlib.crc32(own))
            at += p["length"]
        assert at == len(want)
    for pieces in windows.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()
        total = sum(n for _, n in pieces)
        assert total <= 2048 and total & (total - 1) == 0


def library_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own.no_truncation()
    own.no_padding()
    return lambda text: own.encode(text, add_special_tokens=False).ids


def test_plain_texts_are_split_as_the_tokenizer_splits():
    known = packing.WordIds(packing.bpe.default_path())
    letters = [chr(c) for c in range(0x2500) if chr(c).isprintable() or c < 160] + list("€'st 09aZßÀΣ<|")
    random.seed(2)
    for _ in range(20_000):
        text = "".join(random.choices(letters, k=12))
        low = text.lower()
        if packing.SIMPLE.fullmatch(low):
            assert packing.PLAIN.findall(low) == known.tokenizer.pattern.findall(low), text
    for char in letters:
        for text in (f"a{char}1{char}{char}b ", f"it's{char}"):
            assert known.words(text) == known.tokenizer.pieces(text), text


def test_query_against_the_library(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in read(spark, folder, "documents").select("doc_id", "text").collect()}
    frame = queries.op11_pack(spark, folder)
    assert frame.dtypes == [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    check(frame.collect(), texts, library_ids())


def test_odd_documents(spark, documents, no_documents):
    pieces = packing.pack(documents).collect()
    assert packing.pack(no_documents).count() == 0
    one = {(r["doc_id"], r["start"], r["doc_tokens"]) for r in pieces}
    assert {(0, 0, 1), (1, 0, 1)} <= one  # null and empty: the end mark
    assert sum(r["length"] for r in pieces if r["doc_id"] == 9) == 2 * next(r["doc_tokens"] for r in pieces if r["doc_id"] == 9)
    assert sum(r["length"] for r in pieces if r["doc_id"] == 8) == 40_001
    null = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert sorted(r["offset"] for r in packing.pack(null).collect()) in ([0, 0, 1], [0, 0, 1, 2], [0, 0, 3], [0, 1, 2], [0, 0, 2])


def test_sequences_hold_the_pieces(spark, documents):
    pieces = packing.pack(documents, window=64)
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    rows = pieces.collect()
    assert sum(r["length"] for r in whole.values()) == sum(r["length"] for r in rows)
    for r in rows:
        assert whole[r["sequence_id"]]["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
