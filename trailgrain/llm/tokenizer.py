"""Corpus encoding with a public byte-level BPE vocabulary.

``encode_column`` yields one list of token ids per row.  Null and empty texts
both give an empty list; a null key stays null; repeated rows give repeated
results.  Each pretoken is merged with a segment tree over the ranks of its
adjacent pairs, so a pretoken of n bytes costs O(n log n) however long it is.
"""

from __future__ import annotations

import base64
import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trailgrain.functions.arrowkit import map_batches

#: Where the public vocabularies are; a parameter of every operator here.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the split pattern that belongs to the byte_bpe_50k vocabulary.
PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The memo of a worker starts afresh beyond so many pretokens, which bounds its memory; results don't depend on it.
MEMO_WORDS = 300_000
#: Pretokens of about so many characters are held at a time.
CHUNK_CHARS = 1_000_000


class SegmentTreeBPE:
    """Byte-pair encoding of single pretokens.

    Leaf i holds ``rank(pair i) * n + i`` or infinity, inner nodes the minimum
    of their children: the root is the leftmost pair of lowest rank.  A merge
    rewrites at most three leaves and their paths to the root.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(PRETOKEN).findall
        self.memo = Memo(self.merge)

    def merge(self, word: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(word)
        if n == 1:
            return (ranks[word],)
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        none = 1 << 62
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = ranks.get(word[i : i + 2])
            if r is not None:
                tree[size + i] = r * n + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        end = list(range(1, n + 1))  # end of the part that begins at i; it is also the next part's start
        before = list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                low = a if a < b else b
                if tree[i] == low:
                    break
                tree[i] = low
                i >>= 1

        while tree[1] < none:
            i = tree[1] % n
            gone = end[i]
            end[i] = end[gone]
            if end[i] < n:
                before[end[i]] = i
                r = ranks.get(word[i : end[end[i]]])
                put(i, none if r is None else r * n + i)
                put(gone, none)
            else:
                put(i, none)
                if gone < n - 1:
                    put(gone, none)
            if i:
                p = before[i]
                r = ranks.get(word[p : end[i]])
                put(p, none if r is None else r * n + p)
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the n + 1 offsets of the texts in it."""
        parts, ends, first, chars = [], [0], 0, 0
        for i, s in enumerate(texts, 1):
            chars += len(s or "")
            if chars > CHUNK_CHARS or i == len(texts):
                ids, offsets = self._encode_chunk(texts[first:i])
                parts.append(ids)
                ends.extend((offsets[1:] + ends[-1]).tolist())
                first, chars = i, 0
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(ends)

    def _encode_chunk(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self.memo = Memo(self.merge)
        split, words, ends = self.split, [], [0]
        for s in texts:
            if s:
                words += split(s)
            ends.append(len(words))
        memo = self.memo
        at = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        first, pool = np.array(memo.first), np.array(memo.pool)
        start, size = first[at], first[at + 1] - first[at]
        done = np.concatenate(([0], np.cumsum(size)))
        ids = pool[np.repeat(start - done[:-1], size) + np.arange(done[-1])]
        return ids.astype(np.int32), done[np.array(ends)]


class Memo(dict):
    """Pretoken to its place in ``first``; its ids are ``pool[first[i] : first[i + 1]]``."""

    def __init__(self, merge):
        super().__init__()
        self.merge, self.first, self.pool = merge, array("l", [0]), array("i")

    def __missing__(self, word: str) -> int:
        self.pool.extend(self.merge(word.encode("utf-8", "surrogatepass")))
        self.first.append(len(self.pool))
        self[word] = at = len(self.first) - 2
        return at


@lru_cache(maxsize=4)
def load(path: str) -> SegmentTreeBPE:
    """One encoder for each vocabulary and Python worker."""
    return SegmentTreeBPE(path)


def encode_column(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``key`` and the ids of ``text`` (array<int>); other columns are not read."""
    path = path or os.path.join(TOKENIZER_DIR, VOCABULARY)
    kind = df.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = load(path).encode_batch(batch.column(1).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "ids"])

    part = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return map_batches(part, run, f"key {kind}, ids array<int>").toDF(key, out)


def count_column(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``n_tokens`` (int, 0 for null and empty texts) of each row."""
    path = path or os.path.join(TOKENIZER_DIR, VOCABULARY)
    kind = df.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, ends = load(path).encode_batch(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int32))], ["key", "n_tokens"])

    part = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return map_batches(part, run, f"key {kind}, n_tokens int").toDF(key, "n_tokens")
