"""Quality of documents from a linear-chain conditional random field over their lines.

Every line of a labelled document takes its document's label. The chain sees figures of each line and of the lines before
and after it, and forward-backward gives each line the probability of being good. A document's quality is their mean
weighted by line length, brought to a probability by a two-parameter logistic curve fitted on the same labelled rows.

The model is fitted on at most ``TRAIN_DOCUMENTS`` labelled documents of together at most ``TRAIN_CHARACTERS`` characters, taken
by a hash of their id: an id counts once, with its smallest text, and a document that no longer fits is passed over. Ids whose
crc32 leaves 1 when divided by 3 are held out. Only text is an input of a score, and every row is scored.

Defined cases: null or empty text is one empty line; a label other than 0 and 1, or null, is not used; documents labelled twice
use the smaller label; without usable labels of both kinds every score is 0.5; repeated rows score alike; an empty table
gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import store
from bazaarlake.llm.crf import CRF

TRAIN_DOCUMENTS = 3000
TRAIN_CHARACTERS = 64_000_000  # that go to the driver
CLASSES = 8  # of bytes
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _BAR, _ODD, _HIGH = range(CLASSES)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _ODD, np.uint8)
    table[128:] = _HIGH
    for name, kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER), ("0123456789", _DIGIT),
                       (" \t\r\x0b\x0c", _SPACE), (".,;:'\"-()?", _STOP), ("|", _BAR)):
        table[np.frombuffer(name.encode(), np.uint8)] = kind
    return table


_CLASS = _byte_classes()


def line_figures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Figures of all lines of all texts, lines of each text, and characters of each line."""
    lines: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    repeats: list[float] = []
    variety: list[float] = []
    doubled: list[float] = []
    for i, text in enumerate(texts):
        own = text.encode().split(b"\n")
        counts[i] = len(own)
        lines += own
        seen: set[bytes] = set()
        for line in own:
            repeats.append(float(line in seen and len(line) > 10))
            seen.add(line)
            words = line.split()
            variety.append(len(set(words)) / len(words) if words else 1.0)
            doubled.append(sum(map(bytes.__eq__, words, words[1:])) / len(words) if words else 0.0)
    size = np.array([len(x) for x in lines], np.int64)
    kinds = _CLASS[np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)]
    starts = np.cumsum(size + 1) - size - 1
    share = np.empty((len(lines), CLASSES))
    for k in range(CLASSES):
        summed = np.r_[0, np.cumsum(kinds == k, dtype=np.int32)]
        share[:, k] = summed[starts + size] - summed[starts]
    words = share[:, _SPACE] + 1
    letters = share[:, _UPPER] + share[:, _LOWER] + share[:, _HIGH]
    per = share / np.maximum(size, 1)[:, None]
    figures = np.column_stack([
        per[:, [_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _BAR, _ODD]],
        np.sqrt(per[:, [_UPPER, _BAR, _ODD, _DIGIT]]),
        np.minimum(letters / words, 20) / 10,
        np.log1p(size) / 5,
        np.array(repeats), np.array(variety), np.array(doubled),
        size == 0,
    ])
    return figures, counts, size


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own figures, those of the neighbouring lines, and a constant."""
    figures, counts, size = line_figures(texts)
    ends = np.cumsum(counts) - 1
    before, after = np.vstack([figures[:1] * 0, figures[:-1]]), np.vstack([figures[1:], figures[:1] * 0])
    before[ends + 1 - counts] = 0
    after[ends] = 0
    return np.column_stack([figures, before, after, np.ones(len(figures))]), counts, size


class QualityModel:
    def __init__(self, texts: list[str], labels: list[int]):
        self.crf = None
        labels = np.array(labels, np.int64)
        if len(set(labels.tolist())) < 2:
            return
        x, counts, size = features(texts)
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.mean[-1], self.spread[-1] = 0, 1
        self.crf = CRF(x.shape[1], 2).fit((x - self.mean) / self.spread, counts, np.repeat(labels, counts))
        raw = self._raw(texts)
        self.curve = np.array([4.0, 0.0])
        for _ in range(400):  # logistic curve by gradient steps
            miss = labels - 1 / (1 + np.exp(-(self.curve[0] * raw + self.curve[1])))
            self.curve += 0.5 * np.array([(miss * raw).mean() - 1e-4 * self.curve[0], miss.mean()])

    def _raw(self, texts: list[str]) -> np.ndarray:
        x, counts, size = features(texts)
        good = self.crf.probabilities((x - self.mean) / self.spread, counts)[:, 1]
        weight = size + 1.0
        starts = np.cumsum(counts) - counts
        mean = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
        return np.log(mean + 0.01) - np.log(1.01 - mean)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.crf is None or not texts:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-(self.curve[0] * self._raw(texts) + self.curve[1])))


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS, characters: int = TRAIN_CHARACTERS) -> QualityModel:
    """Fits on at most ``most`` labelled documents that are not held out, of at most ``characters`` characters together."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # One row an id before anything is collected, however often the id repeats.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
    found = store(found.agg(F.min("text").alias("text"), F.min("quality").alias("quality")), "training")
    sizes = found.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.xxhash64("doc_id").alias("place")).collect()
    taken, left = [], characters
    for row in sorted(sizes, key=lambda r: (r["place"], r["doc_id"])):
        if row["size"] <= left:
            taken.append(row["doc_id"])
            left -= row["size"]
    if len(taken) < len(sizes):
        found = found.where(F.col("doc_id").isin(taken))
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    return QualityModel([r["text"] or "" for r in rows], [r["quality"] for r in rows])


def scorer(model: QualityModel):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > 2_000_000:
                out.append(model.scores(group))
                group, size = [], 0
        return pd.Series(np.concatenate([*out, model.scores(group)]))

    return score


def score(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> DataFrame:
    """row (all columns of ``docs``), held_out, score, predicted."""
    scored = docs.select(F.struct("*").alias("row"), held_out().alias("held_out"), scorer(fit(docs, labels, most))("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, in their own columns."""
    return score(docs, labels).where("predicted = 1").select("row.*")
