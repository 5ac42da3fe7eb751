import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from bazaarlake.llm import queries, resampling
from bazaarlake.llm.common import read

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [zlib.crc32(" ".join(words[k : k + n]).encode()) % 10000 for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def brute(docs, target, percent=5, least=20):
    """By the contract's words: joined n-grams, one document after the other."""
    own, wanted = Counter(), Counter()
    for _, text in docs:
        own.update(grams(text)[1])
    for text in target:
        wanted.update(grams(text)[1])
    s, t = sum(own.values()), sum(wanted.values())
    rows = []
    for doc_id, text in docs:
        words, found = grams(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    fit = [k for k, r in enumerate(rows) if r[4] >= least]
    fit.sort(key=lambda k: (-rows[k][3], math.inf if rows[k][0] is None else rows[k][0]))
    rank = {k: n + 1 for n, k in enumerate(fit[: percent * len(fit) // 100])}
    return sorted([(*r[:4], rank.get(k)) for k, r in enumerate(rows)], key=repr)


def test_table_and_chained_sums():
    assert resampling.words_of("Ab_9 ÀÉ-x y\x85".encode()) == ["ab".encode(), b"9", "ÀÉ".encode(), "x y\x85".encode()]
    assert resampling.words_of(None) == []
    words = resampling.words_of(b"one two three four")
    assert [list(s) for s in resampling.features(words)][2] == [zlib.crc32(b"one two three"), zlib.crc32(b"two three four")]
    assert [list(s) for s in resampling.features([b"a"])] == [[zlib.crc32(b"a")], [], []]


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, name):
    folder = f"/root/testdata/{name}"
    docs = [tuple(r) for r in read(spark, folder, "documents").select("doc_id", "text").collect()]
    target = [r[0] for r in read(spark, folder, "benchmark").select("text").collect()]
    frame = queries.op12_resample(spark, folder)
    assert frame.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, frame.collect()), key=repr) == brute(docs, target)


def test_odd_documents(spark, documents, no_documents):
    target = spark.createDataFrame([("word1 word2 word3",), (None,), ("",)], "text string")
    rows = documents.unionByName(documents.where("doc_id = 14").selectExpr("cast(null as long) as doc_id", "text", "source", "n_lines", "row"))
    out = resampling.resample(rows, target, percent=50, least_words=4)
    got = sorted(map(tuple, out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    docs = [tuple(r) for r in rows.select("doc_id", "text").collect()]
    assert got == brute(docs, ["word1 word2 word3", None, ""], 50, 4)
    assert resampling.resample(no_documents, target).count() == 0
    assert resampling.resample(documents, target.where("false"), percent=100, least_words=0).where("rank is null").count() == 0
