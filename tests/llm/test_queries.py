import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from bazaarlake.llm import bpe, quality, queries
from bazaarlake.llm.common import BLANKS, read, store
from checks.verify import rows_of
from tests.llm.test_operators import contract_spans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, folder)
    cursor = connection.execute(queries.SQL[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(frame.columns, frame.collect()) == want


def test_pipeline_stages(spark, folder):
    docs = read(spark, folder, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == sizes[-1]


def brute_lines(rows):
    """The line rule on (id, text) rows: kept text of each."""
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    return {i: "\n".join(x for x in (text or "").split("\n") if gone.get(key(x), i) == i) for i, text in rows}


def brute_copies(rows):
    """The smallest id of each group of linked texts, and every id without words."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if sets[i]]
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= 80 * large and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                first, last = sorted((top(a), top(b)))
                root[last] = first
    return {i for i in sets if top(i) == i}


def brute_mix(rows):
    """How often each id is taken, from (id, source, text) rows with distinct ids."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, _, text in rows}
    sources = sorted({s for _, s, _ in rows if s is not None}) + [None] * any(s is None for _, s, _ in rows)
    words = {s: sum(size[i] for i, own, _ in rows if own == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    budget, target, free = 1.5 * sum(words.values()), {}, list(sources)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * words[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * words[s] for s in over}
        free = [s for s in free if s not in over]
    dealings = []
    for nr, s in enumerate(sources):
        order = sorted((i for i, own, _ in rows if own == s), key=lambda i: (hashlib.md5(f"mix:{i}".encode()).hexdigest()[:15], i))
        done = 0
        for i in 2 * order:
            done += size[i]
            if size[i] and target[s]:
                dealings.append((done / target[s], nr, done, i))
    taken, spent = defaultdict(int), 0
    for *_, i in sorted(dealings):
        spent += size[i]
        if spent > budget:
            break
        taken[i] += 1
    return taken


def test_pipeline_stages_are_brute_force(spark, folder):
    """Every stage on all that the one before kept; the verdict of the trained classifier is taken as the operator gives it."""
    tokenizers = pytest.importorskip("tokenizers")
    docs = read(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = store(stages["quality classifier"](spark, docs, folder), "test-quality")
    verdict = quality.score(docs.select("doc_id", "text"), read(spark, folder, "labels"))
    good = {r["doc_id"] for r in verdict.select("row.doc_id", "predicted").collect() if r["predicted"] == 1}
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == good and len(good) < docs.count()

    kept = store(stages["line dedup"](spark, kept, folder), "test-lines")
    want = brute_lines([(i, r["text"]) for i, r in rows.items()])
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert {i: r["text"] or "" for i, r in rows.items()} == want

    kept = store(stages["n-gram Jaccard join"](spark, kept, folder), "test-copies")
    want = brute_copies([(i, r["text"]) for i, r in rows.items()])
    assert {r["doc_id"]: r for r in kept.collect()} == {i: rows[i] for i in want}

    mixed = store(stages["mixing sources to target weights"](spark, kept, folder), "test-mix")
    taken = brute_mix([(i, rows[i]["source"], rows[i]["text"]) for i in want])
    got = defaultdict(int)
    for r in mixed.collect():
        assert r == rows[r["doc_id"]]
        got[r["doc_id"]] += 1
    assert got == taken

    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    library.no_padding()
    counts = {i: len(library.encode(rows[i]["text"] or "", add_special_tokens=False).ids) for i in taken}
    out = stages["BPE encoding and decoding"](spark, mixed, folder).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out) == sorted((i, counts[i]) for i in taken for _ in range(taken[i]))


def test_pipeline_stages_on_odd_rows(spark, folder, documents, no_documents):
    """Nulls, empty and long texts, repeated rows, extra columns and an empty table pass through every stage."""
    for docs in (documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = store(stage(spark, docs, folder), "test-odd")
            assert name.startswith("BPE") or out.columns == docs.columns
            docs = out
        assert (docs.count() > 0) == (out.count() > 0)


def test_near_copies_leave_one_row_of_a_group(spark, folder):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (None, text, "c"), (None, "", "c"), (5, None, "c"), (1, text, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.near_copy_stage(spark, docs, folder).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == [(0, ""), (1, text), (5, "")]


def test_registered_pii_is_the_contract(spark, folder):
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, folder, "documents").collect()}
    out = queries.op1_pii(spark, folder).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        base = contract_spans(texts[r["doc_id"]])
        names = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(names.split(",") if names else []) <= set(spans) and r["n_spans"] == len(spans)


def test_registered_shuffle_is_the_contract(spark, folder):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in read(spark, folder, "documents").collect()}
    out = queries.op3_shuffle(spark, folder).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in texts.items()}
    slots = defaultdict(list)
    for r in out:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(40)) and len(out) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
