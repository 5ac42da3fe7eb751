"""BPE encoding and decoding in batched merge rounds.

The symbols of many words lie in one flat array. In each round every neighbouring pair is looked up by binary search in the sorted
pair keys of the merge list, the lowest rank of each word is found, and its pairs are merged. Words without a pair left
leave the array. Distinct words are encoded once a batch, and a bounded cache keeps them between batches.

The vocabulary file's path is a parameter; every executor reads its own installed copy. The file's steps that are followed
here: special tokens first, NFC, runs of white space to a blank, lower case, a splitting pattern, bytes as printable
characters, a mark at the end of a word, and decoding as tokens joined by blanks.

Defined cases: null and empty texts have no tokens; an empty table gives an empty result; repeated rows are encoded
alike; other columns are carried along; words of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_RANK = np.iinfo(np.int64).max
CACHE_WORDS = 400_000


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordBPE:
    """The tokenizer of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        shown = byte_characters()
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.last = np.array([vocab[c + end] for c in shown], np.int64)
        self.base = len(vocab) + len(self.special)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(left * self.base + right, kind="stable")
        self.keys, self.ranks = (left * self.base + right)[order], order.astype(np.int64)
        self.made = made
        # A merge may be done at all its places in one round unless what it makes takes part in an earlier merge.
        first_use = np.full(self.base, NO_RANK)
        np.minimum.at(first_use, left, np.arange(len(made)))
        np.minimum.at(first_use, right, np.arange(len(made)))
        self.at_once = first_use[made] > np.arange(len(made))
        self.cache: dict[str, tuple[bytes, str]] = {}

    def split(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        # Lower case is taken character by character, so a final sigma is like any other.
        return self.pattern.findall(text.replace("Σ", "σ").lower())

    def rank_of(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, pairs)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word (no word is empty)."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            if len(symbols) > 1:
                inside = owner[1:] == owner[:-1]
                rank[:-1][inside] = self.rank_of(symbols[:-1][inside] * self.base + symbols[1:][inside])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(symbols)])
            finished = lowest == NO_RANK
            if finished.any():
                stops = starts + lengths
                for k in np.flatnonzero(finished):
                    done[owner[starts[k]]] = symbols[starts[k] : stops[k]]
                keep = np.repeat(~finished, lengths)
                symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
                lowest, lengths = lowest[~finished], lengths[~finished]
                if not len(symbols):
                    break
            least = np.repeat(lowest, lengths)
            here = np.flatnonzero(rank == least)
            # Of overlapping places every second one counts, from the left of its run.
            run_start = np.r_[True, np.diff(here) != 1]
            run = np.maximum.accumulate(np.where(run_start, np.arange(len(here)), 0))
            here = here[(np.arange(len(here)) - run) % 2 == 0]
            single = ~self.at_once[rank[here]]
            if single.any():
                first = np.r_[True, owner[here[1:]] != owner[here[:-1]]]
                here = here[~single | first]
            symbols[here] = self.made[rank[here]]
            keep = np.ones(len(symbols), bool)
            keep[here + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return done

    def learn(self, words: set[str]) -> None:
        """Puts the words that the cache lacks into it: ids as bytes, and decoded text."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        new = [w for w in words if w not in self.cache]
        # Long words last and apart, so their many rounds do not carry the short ones along.
        for part in ([w for w in new if len(w) <= 64], [w for w in new if len(w) > 64]):
            if part:
                for word, ids in zip(part, self.encode_words(part)):
                    self.cache[word] = (ids.astype("<u4").tobytes(), " ".join(self.tokens[i] for i in ids.tolist()))
        for text, i in self.special.items():
            self.cache[text] = (np.array([i], "<u4").tobytes(), text)

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        if "<|" not in text or not self.special_pattern.search(text):
            return self.split(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [*self.split(text[at : m.start()]), m.group()]
            at = m.end()
        return out + self.split(text[at:])

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Of each text: ids as little-endian unsigned 32-bit integers, and the decoded text."""
        split = [self.pieces(t) for t in texts]
        need: set[str] = set()
        need.update(*split)
        cached = len(self.cache)
        self.learn(need)
        if len(self.cache) < cached:  # it was emptied
            self.learn(need)
        out = []
        for words in split:
            known = [self.cache[w] for w in words]
            out.append((b"".join([k[0] for k in known]), " ".join([k[1] for k in known])))
        return out


_loaded: dict[str, WordBPE] = {}


def tokenizer(path: str) -> WordBPE:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _groups(texts: list[str], chars: int = 4_000_000):
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size > chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoder(path: str, whole: bool):
    """A column function of the text: token count and either ids and decoded text, or their digests."""
    kind = "n_tokens long, ids binary, decoded string" if whole else "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(kind)
    def encode(texts: pd.Series) -> pd.DataFrame:
        own, rows = tokenizer(path), []
        for group in _groups([t or "" for t in texts]):
            for ids, decoded in own.encode_batch(group):
                if not whole:
                    ids, decoded, n = hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), len(ids) // 4
                    rows.append((n, ids, decoded))
                else:
                    rows.append((len(ids) // 4, ids, decoded))
        names = [x.split(" ")[0] for x in kind.split(", ")]
        return pd.DataFrame(rows, columns=names)

    return encode


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """row (all columns of ``docs``) and result (n_tokens, ids as little-endian 32-bit numbers, decoded)."""
    return docs.select(F.struct("*").alias("row"), encoder(path or default_path(), True)("text").alias("result"))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    return docs.select("doc_id", encoder(path or default_path(), False)("text").alias("r")).select("doc_id", "r.*")
