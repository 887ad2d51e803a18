"""Encoding with a public byte-level BPE vocabulary, in batches of numpy merge rounds."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

#: Where the public vocabularies lie, unless a caller says otherwise.
FOLDER = "/opt/tokenizers"
#: The pattern of the vocabulary that splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of more bytes are merged with a heap, whose work grows with n log n.
LONG = 512
#: Words remembered by a worker between batches.
REMEMBERED = 400_000
RESULT = "doc_id long, ids array<int>"


class Vocabulary:
    """Ranks as arrays: the byte tokens, and all pairs that make a token, sorted by key."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.full(256, -1, dtype=np.int64)
        for b in range(256):
            self.byte[b] = ranks[bytes([b])]
        self.base = max(ranks.values()) + 1
        keys, merged = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a rank file: a line per token, base64 and rank."""
        pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        return cls({base64.b64decode(a): int(b) for a, b in pairs})

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair makes; self.base where it makes none."""
        key = a * self.base + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], self.base)


def merge_rounds(words: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Ids of many words at once.

    All words' symbols lie in one flat array. In each round every word merges
    its pair of lowest rank, the leftmost of equals; words without a pair that
    makes a token leave the array.
    """
    done: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(words)
    alive = np.array([i for i, w in enumerate(words) if w], dtype=np.int64)
    if not len(alive):
        return done
    symbols = v.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
    lengths = np.array([len(words[i]) for i in alive], dtype=np.int64)
    while len(alive):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rank = np.full(len(symbols), v.base, dtype=np.int64)
        if len(symbols) > 1:
            rank[:-1] = v.rank(symbols[:-1], symbols[1:])
        rank[ends - 1] = v.base  # the last symbol of a word has no right neighbour
        low = np.minimum.reduceat(rank, starts)
        stuck = low == v.base
        if stuck.any():
            for k in np.flatnonzero(stuck):
                done[alive[k]] = symbols[starts[k] : ends[k]]
            keep = np.repeat(~stuck, lengths)
            symbols, rank = symbols[keep], rank[keep]
            alive, lengths, low = alive[~stuck], lengths[~stuck], low[~stuck]
            if not len(alive):
                break
            ends = np.cumsum(lengths)
            starts = ends - lengths
        hits = np.flatnonzero(rank == np.repeat(low, lengths))
        word = np.searchsorted(ends, hits, side="right")
        first = hits[np.concatenate(([True], word[1:] != word[:-1]))]
        symbols[first] = low
        keep = np.ones(len(symbols), dtype=bool)
        keep[first + 1] = False
        symbols = symbols[keep]
        lengths = lengths - 1
    return done


def merge_long(word: bytes, v: Vocabulary) -> np.ndarray:
    """Ids of one long word, by a heap of its pairs."""
    s = v.byte[np.frombuffer(word, dtype=np.uint8)].tolist()
    n = len(s)
    after, before, here = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    ranks = v.rank(np.array(s[:-1]), np.array(s[1:])).tolist()
    heap = [(r, i, s[i], s[i + 1]) for i, r in enumerate(ranks) if r < v.base]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            r = int(v.rank(np.array([s[i]]), np.array([s[j]]))[0])
            if r < v.base:
                heapq.heappush(heap, (r, i, s[i], s[j]))

    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i] if here[i] else n
        if j >= n or s[i] != a or s[j] != b:
            continue
        s[i], here[j] = r, False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return np.array([x for x, h in zip(s, here, strict=True) if h], dtype=np.int64)


def encode_batch(texts: list[str | None], v: Vocabulary, known: dict[str, np.ndarray], split) -> list[np.ndarray]:
    """Ids of each text; words met before are looked up, the new ones merged together."""
    parts = [split(t) if t else [] for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    new = list({w for p in parts for w in p if w not in known})
    short = [w for w in new if len(w) <= LONG // 4]
    for w, ids in zip(short, merge_rounds([w.encode("utf-8", "replace") for w in short], v), strict=True):
        known[w] = ids.astype(np.int32)
    for w in new:
        if len(w) > LONG // 4:
            raw = w.encode("utf-8", "replace")
            known[w] = (merge_long(raw, v) if len(raw) > LONG else merge_rounds([raw], v)[0]).astype(np.int32)
    empty = np.empty(0, dtype=np.int32)
    return [np.concatenate([known[w] for w in p]) if p else empty for p in parts]


def _encode(vocabulary: Vocabulary):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = regex.compile(PATTERN).findall
        known: dict[str, np.ndarray] = {}
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                some = pdf.iloc[at : at + 1024]
                yield pd.DataFrame({"doc_id": some.doc_id, "ids": encode_batch(some.text.tolist(), vocabulary, known, split)})

    return encode


def encode_documents(documents: DataFrame, path: str = f"{FOLDER}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids): the ids of every document's whole text, without special tokens.

    documents(doc_id, text). Null and empty texts have an empty list, blank
    texts are encoded as they are, names of special tokens in a text are
    ordinary text. One pass without a shuffle; the vocabulary (a fixed file of
    known size) goes to the workers with the function. A null doc_id stays null,
    repeated rows are each encoded, further columns are ignored.
    """
    return documents.select("doc_id", "text").mapInPandas(_encode(Vocabulary.read(path)), RESULT)
