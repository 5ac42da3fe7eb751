"""N-gram Jaccard join: light sets by fixed-size subsets, heavy sets by inverted lists, and the components of the links.

A document's set holds the 64-bit hashes of its word shingles, kept with 40 bits. Shingles have one order everywhere: rare before
frequent, by a table of counts of fixed size over all documents. Sets of s and t with a Jaccard index of at least 0.8 share 0.8 * max(s, t) or more,
so they share one of their first s - ceil(0.8 s) + 1 shingles, and two of one more.

* Light sets (at most ``boundary`` shingles) list all pairs of their prefix as keys; heavy sets list the single shingles
  of theirs, and so do light sets that are large enough to link to a heavy one. The boundary is the size at which the
  rows of both sides cost least, from a histogram of set sizes.
* All keys are shuffled once, and those of one set alone end there: no filter of keys, whose size would have to grow with the input.
* A key bounds what two sets share: if it is their first in common, what stands before it in either set is not shared. A pair
  whose every key has a bound too low is not a candidate; the first key in common of a link never has.
* A key with many sets is not spread into pairs. Its most central set leads: all others are compared with it. What links
  falls into one component and needs no more comparing, and what a set shares with the leader bounds what it shares with others.
  After two leaders only the pairs that are still open are listed, and parity bits, about one for each shingle, rule out most of those.
* Every candidate pair is verified on the whole sets. Components come from rounds of joins that end when nothing changes.

Equal sets are one node from the start, so copies cost nothing. Repeated rows are copies. Null ids: a component's id is the
smallest id that is not null (null if there is none). Null and empty texts have no shingles, link with nothing and are
their own component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.bloom import bits_for, build, holds, positions
from bazaarlake.llm.common import release, store
from bazaarlake.sources.tables import shuffles_dropped

SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5  # 0.8
BYTES = 5  # kept of a shingle's hash
SLOTS = 1 << 20  # of the table of counts
LEAST_PARITY = 512  # parity bits of a set
LISTED = 32  # sets of a key whose pairs are listed at once
LEADER_ROUNDS = 2  # for keys of more sets, before the pairs that are still open are listed
LARGEST_LIGHT = 64
SCAN_COST = 2.0  # of a list entry, in rows of subsets
CACHE_WORDS = 50_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    """Never more than ``CACHE_WORDS`` words, however many a batch has."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return (h ^ (h >> np.uint64(29))) * _M1


def shingle_hashes(text: str | None, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out * _M1) ^ _mixed(h[k : len(h) - width + 1 + k] + np.uint64(k))
    return np.unique(_mixed(out))


def pack(tokens: np.ndarray) -> bytes:
    """The first 40 bits of sorted hashes as gaps: their number, four bytes of each gap, then the fifth bytes compressed, which are
    nearly all 0 in large sets."""
    if not len(tokens):
        return b""
    gaps = np.diff(tokens >> np.uint64(64 - 8 * BYTES), prepend=np.uint64(0))
    high = (gaps >> np.uint64(32)).astype(np.uint8).tobytes()
    return len(gaps).to_bytes(4, "little") + (gaps & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + zlib.compress(high, 1)


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.empty(0, np.uint64)
    n = int.from_bytes(raw[:4], "little")
    high = np.frombuffer(zlib.decompress(raw[4 + 4 * n :]), np.uint8).astype(np.uint64)
    return np.cumsum(high << np.uint64(32) | np.frombuffer(raw, "<u4", n, 4), dtype=np.uint64)


def _batch(columns: dict[str, tuple[list | np.ndarray, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's shingles falls on each of as many places as the set has shingles, rounded up to a power of two:
    fewer would all be alike to chance in large sets. Two sets differ in at least as many shingles as their bits differ in places."""
    width = max(LEAST_PARITY, 1 << (len(tokens) - 1).bit_length())
    counts = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % width, minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many places the parity bits of two sets differ, the wider ones folded to the width of the others."""
    width = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0) for bits in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, n, node (64 bits of the set's digest; null for an empty set), sig (the whole digest), tokens, bits."""

    def run(batches):
        cache = _WordHashes()
        for batch in batches:
            own = [shingle_hashes(t, cache) for t in batch.column(1).to_pylist()]
            sigs = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in own], pa.int64()),
                 pa.array([None if s is None else int.from_bytes(s[:8], "little", signed=True) for s in sigs], pa.int64()),
                 pa.array(sigs, pa.binary()), pa.array([pack(s) for s in own], pa.binary()),
                 pa.array([parity_bits(s).tobytes() for s in own], pa.binary())],
                ["doc_id", "n", "node", "sig", "tokens", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, node long, sig binary, tokens binary, bits binary")


def frequency_classes(sets: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """log2 of the documents whose shingles fall into each slot: one byte a slot."""
    chunk = 1 << 14

    def count(batches):
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                np.add.at(counts, (unpack(raw) & np.uint64(slots - 1)).astype(np.int64), 1)
        for k in range(0, slots, chunk):
            part = counts[k : k + chunk]
            if part.any():  # byte by byte of the numbers, since most have but one
                planes = part.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                yield _batch({"chunk": ([k], pa.int64()), "n": ([zlib.compress(planes, 1)], pa.binary())})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(chunk, np.int64)
        for n in parts["n"]:
            total += np.frombuffer(zlib.decompress(n), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
        return pd.DataFrame({"chunk": [parts["chunk"].iloc[0]], "level": [np.log2(total + 1).astype(np.uint8).tobytes()]})

    out = np.zeros(slots, np.uint8)
    with shuffles_dropped(sets.sparkSession):
        parts = sets.where("n > 0").select("tokens").mapInArrow(count, "chunk long, n binary")
        for k, level in parts.groupBy("chunk").applyInPandas(add, "chunk long, level binary").collect():
            out[k : k + chunk] = np.frombuffer(level, np.uint8)
    return out


def prefix_length(n):
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


def light_boundary(sizes: dict[int, int], most: int = LARGEST_LIGHT) -> int:
    """The boundary with the fewest rows: pairs of prefixes of light sets, and lists of the sets that need them."""
    def lists(over: float) -> float:
        return sum(c * prefix_length(n) * SCAN_COST for n, c in sizes.items() if n > over)

    def pairs(upto: int) -> float:
        return sum(c * (p + 1) * p / 2 for n, c in sizes.items() if n <= upto for p in [prefix_length(n)])

    return min(range(most + 1), key=lambda b: (pairs(b) + lists(b * NUMERATOR / DENOMINATOR), b))


class Keys:
    """The keys of a set: 64-bit numbers made of one shingle or of two."""

    def __init__(self, levels: np.ndarray, boundary: int):
        self.levels, self.boundary = levels, boundary

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Keys, the most that the set shares with one whose first key in common each is, and how central the set is: the
        mean frequency of its shingles, in thousandths of a level."""
        n = len(tokens)
        level = self.levels[(tokens & np.uint64(len(self.levels) - 1)).astype(np.int64)]
        central = int(1000 * level.mean()) if n else 0
        if n < NUMERATOR:  # nothing but an equal set is near enough
            return np.empty(0, np.uint64), np.empty(0, np.int64), central
        p = prefix_length(n)
        first = tokens[np.argsort(level.astype(np.uint64) << np.uint64(8 * BYTES) | tokens)[: p + 1]]
        keys, room = [], []
        if n <= self.boundary:
            a, b = np.triu_indices(len(first), 1)
            keys.append(_mixed(first[a] * _M2 ^ _mixed(first[b] + first[a])))
            room.append(n + 1 - b)  # of the shingles before b only a is shared
        if n > self.boundary * NUMERATOR / DENOMINATOR:
            keys.append(_mixed(first[:p] + _M2))
            room.append(n - np.arange(p))
        return np.concatenate(keys), np.concatenate(room), central


def postings(sets: DataFrame, keys: Keys) -> DataFrame:
    """key, node, n, central, room of every key of two sets or more, stored, after which the broadcast order goes.

    All keys meet in one shuffle, and those of one set alone go no further. A task passes a set on once, so copies meet once for
    each task. ``room`` is the set's size without the shingles that stand before the key, so it bounds what the set shares with
    a set whose first key in common this is, and no other.
    """
    shared = sets.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        passed: set[bytes] = set()
        for batch in batches:
            out = [[], [], [], [], []]
            for raw, node, n, sig in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if sig in passed:
                    continue
                passed.add(sig)
                own, room, central = shared.value.of(unpack(raw))
                out[0].append(own.view(np.int64))
                out[1].append(room)
                for k, value in ((2, node), (3, n), (4, central)):
                    out[k].append(np.full(len(own), value, np.int64))
            if out[0]:
                yield _batch({c: (np.concatenate(v), pa.int64()) for c, v in zip(("key", "room", "node", "n", "central"), out)})

    source = sets.where("n >= 4").select("tokens", "node", "n", "sig")
    # What a set's rows have in common stands together, so that the shuffle's compression finds it.
    rows = source.mapInArrow(run, "key long, room long, node long, n long, central long")
    own = Window.partitionBy("key")
    rows = rows.withColumn("low", F.min("node").over(own)).withColumn("high", F.max("node").over(own)).where("low <> high")
    done = store(rows.groupBy("key", "node").agg(*[F.max(c).alias(c) for c in ("n", "central", "room")]), "postings")
    shared.destroy()  # every executor keeps a copy on its disk
    return done


def with_sets(sets: DataFrame, nodes: DataFrame, what: str = "tokens") -> DataFrame:
    """node, sig, n, tokens (or ``what`` else) of ``nodes`` (one column), once each, in partitions by node.

    A task passes a set on once, so copies meet in the shuffle once for each task.
    """
    spark = sets.sparkSession
    bits = bits_for(max(1, nodes.count()))

    def doubled(column) -> np.ndarray:
        k = column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        return np.column_stack([k, _mixed(k)])

    wanted = spark.sparkContext.broadcast(build(nodes, lambda batches: (doubled(b.column(0)) for b in batches), bits, "once"))

    def run(batches):
        passed: set[bytes] = set()
        for batch in batches:
            if batch.num_rows:
                hit = holds(wanted.value, positions(doubled(batch.column(0)), bits))
                for k in np.flatnonzero(hit).tolist():
                    sig = batch.column(1)[k].as_py()
                    hit[k] = sig not in passed
                    passed.add(sig)
                yield batch.filter(pa.array(hit))

    some = sets.where("n >= 4").select("node", "sig", "n", what).mapInArrow(run, f"node long, sig binary, n long, {what} binary")
    return some.repartition("node").dropDuplicates(["node", "sig"])


def _overlap(first: pd.Series, second: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(unpack(a), unpack(b), assume_unique=True)) for a, b in zip(first, second)], dtype="int64")


def verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, a_sig, b_sig, common, joint (sizes of intersection and union) of each of the stored ``pairs`` of nodes, which it releases.

    The sets of ``b`` come in partitions of the first join. Those of ``a``, few where they are leaders, are stored, so that
    Spark can split the pairs of a hot leader in the second.
    """
    firsts = store(with_sets(sets, pairs.select("a").distinct()), "candidate-sets")
    seconds = with_sets(sets, pairs.select("b").distinct())
    one = firsts.select(F.col("node").alias("a"), F.col("sig").alias("a_sig"), F.col("n").alias("a_n"), F.col("tokens").alias("a_tokens"))
    two = seconds.select(F.col("node").alias("b"), F.col("sig").alias("b_sig"), F.col("n").alias("b_n"), F.col("tokens").alias("b_tokens"))
    both = pairs.join(two, "b").join(one, "a")
    common = F.pandas_udf(_overlap, "long")("a_tokens", "b_tokens")
    out = both.select("a", "b", "a_sig", "b_sig", "a_n", "b_n", common.alias("common"))
    out = out.select("a", "b", "a_sig", "b_sig", "common", (F.col("a_n") + F.col("b_n") - F.col("common")).alias("joint"))
    done = store(out, "verified")
    release(firsts, pairs)
    return done


def _linked():
    return F.col("common") * DENOMINATOR >= F.col("joint") * NUMERATOR


def labelled(links: DataFrame) -> DataFrame:
    """node, label of all nodes of ``links`` (a, b): the smallest node of the component.

    In each round every node takes the smallest label among its neighbours', and then its label's label, until nothing changes.
    """
    edges = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = store(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("best"))
        jump = best.select(F.col("node").alias("to"), F.col("best").alias("next"))
        after = best.join(jump, best["best"] == jump["to"]).select("node", F.least("best", "next").alias("label"), F.col("label").alias("old"))
        after = store(after, "labels")
        release(labels)
        labels = after
        if not after.where("label <> old").limit(1).count():
            release(edges)
            return labels


def _can_link(room: str, n: str, other_room: str, other_n: str):
    """Sets whose first key in common this is share no more than the room of either; 0.8 of the union asks for 4/9 of both
    sizes. A link has such a key among those of both sets, so it is enough that one key of a pair passes."""
    least = F.least(F.col(room), F.col(other_room))
    return least * (NUMERATOR + DENOMINATOR) >= (F.col(n) + F.col(other_n)) * NUMERATOR


def _live(rows: DataFrame, *spent: DataFrame) -> DataFrame:
    """The postings of keys whose sets are not all of one part, with the number of sets and the most central one; releases what it is made of."""
    groups = rows.groupBy("key").agg(
        F.count("*").alias("many"), F.min("part").alias("low"), F.max("part").alias("high"),
        F.max(F.struct("central", "node"))["node"].alias("lead"),
    )
    live = store(rows.join(groups.where(F.col("low") != F.col("high")).select("key", "many", "lead"), "key"), "live")
    release(*spent)
    return live


def _after_leaders(live: DataFrame, found: list[DataFrame], shared: str) -> tuple[DataFrame, DataFrame]:
    """The postings after a round, and the stored labels that they are made of: sets that links so far join are of one part, and all sets of a key with a leader have what
    they share with it in the column ``shared``."""
    linked = found[0].where(_linked()).select("a", "b")
    for more in found[1:]:
        linked = linked.union(more.where(_linked()).select("a", "b"))
    labels = labelled(linked)
    parts = labels.select(F.col("node").alias("_node"), "label")
    met = found[-1].select(F.col("a").alias("_lead"), F.col("b").alias("_b"), F.col("common").alias(shared))
    led = F.col("many") > LISTED
    rest = live.where(~led | (F.col("node") != F.col("lead"))).withColumn("_by", F.when(led, F.col("lead")))
    rest = rest.join(parts, F.col("node") == F.col("_node"), "left").withColumn("part", F.coalesce("label", "node"))
    rest = rest.join(met, (F.col("_by") == F.col("_lead")) & (F.col("node") == F.col("_b")), "left")
    return rest.drop("many", "lead", "_by", "_node", "label", "_lead", "_b"), labels


def _differing(first: pd.Series, second: pd.Series) -> pd.Series:
    return pd.Series([differing(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(first, second)], dtype="int64")


def _close(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the stored pairs, which it releases, whose parity bits do not rule a link out: linked sets differ in at most a ninth of their sizes' sum."""
    known = store(with_sets(sets, pairs.select("a").union(pairs.select("b")).distinct(), "bits"), "bits")
    one, two = (known.select(F.col("node").alias(k), F.col("n").alias(f"{k}_n"), F.col("bits").alias(f"{k}_bits")) for k in ("a", "b"))
    places = F.pandas_udf(_differing, "long")("a_bits", "b_bits")
    both = pairs.join(two, "b").join(one, "a").withColumn("places", places)
    near = store(both.where(F.col("places") * (NUMERATOR + DENOMINATOR) <= F.col("a_n") + F.col("b_n")).select("a", "b").distinct(), "pairs")
    release(known, pairs)
    return near


def links(sets: DataFrame) -> DataFrame:
    """a, b (digests of sets), stored: links whose components are those of all links of the join."""
    small = sets.where((F.col("n") > 0) & (F.col("n") <= 2 * LARGEST_LIGHT)).groupBy("n").agg(F.count("*").alias("c"))
    keys = Keys(frequency_classes(sets), light_boundary({r["n"]: r["c"] for r in small.collect()}))
    rows = postings(sets, keys)
    many = store(rows.groupBy("key").agg(F.count("*").alias("sets")).where(F.col("sets") > LISTED).select("key"), "hot-keys")
    # Only keys of many sets go through the rounds; the rows of all others stay where they are until pairs are listed.
    live = _live(rows.join(many, "key", "left_semi").withColumn("part", F.col("node")))
    found, labels = [], None
    rounds = [f"shared_{k}" for k in range(LEADER_ROUNDS)]
    for shared in rounds:
        # All sets of the key meet its leader, also those that cannot link to it: what they share with it is used below.
        led = live.where((F.col("many") > LISTED) & (F.col("node") != F.col("lead")))
        pairs = led.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
        found.append(verified(sets, store(pairs, "pairs")))
        spent = [live] if labels is None else [live, labels]
        rest, labels = _after_leaders(live, found, shared)
        live = _live(rest, *spent)
    few = rows.join(many, "key", "left_anti").join(labels.select(F.col("node").alias("_node"), "label"), F.col("node") == F.col("_node"), "left")
    few = few.select("key", "node", "n", "room", F.coalesce("label", "node").alias("part"), *[F.lit(None).cast("long").alias(c) for c in rounds])
    listed = few.unionByName(live.select(few.columns))
    # Both sides alike, so that one exchange serves both.
    one, two = (listed.select(*[F.col(c).alias(f"{side}_{c}") for c in listed.columns]) for side in ("a", "b"))
    enough = F.lit(True)
    for own in rounds:
        # Both met the leader of this round: what they share lies within what each shares with the leader, or outside of
        # it within what each has besides.
        a, b = F.col(f"a_{own}"), F.col(f"b_{own}")
        within = F.least(a, b) + F.least(F.col("a_n") - a, F.col("b_n") - b)
        fits = within * (NUMERATOR + DENOMINATOR) >= (F.col("a_n") + F.col("b_n")) * NUMERATOR
        enough = enough & (a.isNull() | b.isNull() | fits)
    both = one.join(two, F.col("a_key") == F.col("b_key")).where(
        (F.col("a_node") < F.col("b_node")) & (F.col("a_part") != F.col("b_part")) & _can_link("a_room", "a_n", "b_room", "b_n") & enough
    )
    open_pairs = store(both.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "open-pairs")
    release(rows, many, live, labels)
    found.append(verified(sets, _close(sets, open_pairs)))
    linked = [f.where(_linked()).select("a_sig", "b_sig") for f in found]
    out = linked[0]
    for more in linked[1:]:
        out = out.union(more)
    links = store(out.distinct().select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b")), "links")
    release(*found)
    return links


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    sets = store(sets_of(docs), "sets")
    found = links(sets)
    labels = labelled(found)
    label = labels.select(F.col("node").alias("sig"), "label")
    firsts = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    grouped = firsts.join(label, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    grouped = store(grouped, "grouped")
    release(found, labels)
    smallest = grouped.groupBy("label").agg(F.min("first").alias("component"))
    named = grouped.join(smallest, "label").select("sig", "component")
    out = sets.select("doc_id", "n", "sig").join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
