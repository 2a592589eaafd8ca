"""Filling containers of fixed capacity with texts, sized in tokens.

First-fit decreasing runs independently in randomised groups of documents.
Within a group the open containers are the leaves of a tournament tree that
holds the larger remaining capacity of each pair, so the leftmost container
with room is found in O(log n).  Only texts above the capacity are split: into
full containers, which need no packing, and one remainder.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.llm.tokenizer import count_column

CAPACITY = 2048
#: Documents of a group on average; the groups are random, so their loads hardly differ.
GROUP_SIZE = 8192


class TournamentTree:
    """Remaining capacities of containers in the order of their opening."""

    def __init__(self, containers: int):
        self.size = 1 << max(0, (containers - 1).bit_length())
        self.room = [0] * (2 * self.size)

    def set(self, at: int, room: int) -> None:
        i, tree = at + self.size, self.room
        tree[i] = room
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a > b else b

    def first_with(self, need: int) -> int:
        """The leftmost container with at least ``need`` left, or -1."""
        tree, i = self.room, 1
        if tree[1] < need:
            return -1
        while i < self.size:
            i *= 2
            if tree[i] < need:
                i += 1
        return i - self.size


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item; ``sizes`` must be in descending order and at most ``capacity``."""
    tree, opened, out = TournamentTree(max(1, len(sizes))), 0, []
    for size in sizes:
        at = tree.first_with(size)
        if at < 0:
            at, opened = opened, opened + 1
            tree.set(at, capacity)
        tree.set(at, tree.room[at + tree.size] - size)
        out.append(at)
    return out


def pack(sized: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, group_size: int = GROUP_SIZE, seed: int = 17, items: int | None = None) -> DataFrame:
    """One row a piece: ``container`` (string), ``key``, ``piece_no``, ``first_token``, ``n_tokens``.

    Rows of size null or below 1 are left out.  Equal sizes go in the order of
    their keys, repeated keys count as separate items, an empty input gives no
    rows.  Rows are dealt to groups by key and place, so a null or repeated key
    that holds many rows is shared out.  ``items`` is the number of items, which sets the number of groups;
    without it they are counted.
    """
    sized = sized.select(F.col(key).alias("key"), F.col(size).cast("long").alias("size")).where(F.col("size") > 0)
    groups = max(1, math.ceil((sized.count() if items is None else items) / group_size))
    grouped = sized.select(F.pmod(F.xxhash64("key", F.monotonically_increasing_id(), F.lit(seed)), F.lit(groups)).cast("int").alias("group"), "key", "size")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        size = np.asarray(table["size"], dtype=np.int64)
        whole, rest = size // capacity, size % capacity
        order = np.argsort(-rest, kind="stable")
        order = order[rest[order] > 0]
        group, keys = table["group"][0].as_py(), table["key"].combine_chunks()
        at = first_fit_decreasing(rest[order].tolist(), capacity)
        filled = np.repeat(np.arange(len(size)), whole)
        piece = np.arange(len(filled)) - np.repeat(np.cumsum(whole) - whole, whole)
        names = [f"{group}/{i}" for i in at] + [f"{group}/full/{i}" for i in range(len(filled))]
        pieces = np.concatenate((whole[order], piece))
        tokens = np.concatenate((rest[order], np.full(len(filled), capacity)))
        return pa.table(
            [pa.array(names, pa.string()), keys.take(pa.array(np.concatenate((order, filled)))), pa.array(pieces.astype(np.int32)), pa.array(pieces * capacity), pa.array(tokens.astype(np.int32))],
            names=["container", "key", "piece_no", "first_token", "n_tokens"],
        )

    schema = f"container string, key {sized.schema['key'].dataType.simpleString()}, piece_no int, first_token long, n_tokens int"
    return grouped.groupBy("group").applyInArrow(run, schema).withColumnRenamed("key", key)


def pack_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, group_size: int = GROUP_SIZE, path: str | None = None) -> DataFrame:
    """Containers of ``docs`` sized with the public tokenizer; null and empty texts are left out."""
    texts = docs.where(F.length(text) > 0)
    return pack(count_column(texts, key, text, path), key, "n_tokens", capacity, group_size, items=texts.count())
