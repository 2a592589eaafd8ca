"""Near-duplicate texts by MinHash banding.

A text is its set of word shingles.  Under each of ``TABLES`` random orders of
all shingles a set's band is its first ``BAND`` tokens, one under each of BAND
orders.  Sets meet if they share a band.  However many share it, each is compared
with each: bands that many sets share are found beforehand, and their sets are
dealt out in blocks, every two of them a piece of work of its own.  Sets that
meet are compared by a 256-bit sketch, what is left by their exact Jaccard
similarity.

The method asked for, adaptive multi-match prefixes, isn't used: at a similarity
of 0.5 a prefix is half a set, and counting the tokens that two prefixes share
takes more than the budget by far.  The README has the figures.

Texts with the same set are one class and are joined once, so a group of copies
of any size costs no more than one text.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import ensure_checkpoint_dir, map_batches

SHINGLE, MIN_WORDS, MIN_LETTERS, SIMILARITY = 3, 80, 3, 0.5
TABLES, BAND = 44, 3
#: Sets that are compared at a time with ROWS_AT_ONCE others.
COST = 1024
#: First tokens of which a sketch is made.
SKETCHED = 128
#: A sketch holds two bits of each of SKETCHED first tokens.  So many must agree: 80 are expected at a similarity of 0.5, with a deviation of 5.5.
AGREE = 66
#: Up to so many classes to verify are broadcast (16 bytes each), beyond that they are shuffled.
BROADCAST_CLASSES = 1_000_000
#: Groups of more than DEALT sets are dealt out in blocks of about so many, but at most BLOCKS of them.
DEALT, BLOCKS = 8192, 8
#: Bands that more than HOT sets may share are dealt out before they are gathered: their sets are copied BLOCKS times, so no task holds more than two blocks.
HOT = 200_000
#: Bytes of the rows of a task that gathers bands.
TASK_BYTES = 8 << 20
ROWS_AT_ONCE = 128
#: Pairs of a cell in which sets are compared.
CELL_PAIRS = 200_000
CHUNK_CHARS = 1_500_000
_BITS = np.uint64((1 << 52) - 1)
_ODD = np.random.default_rng(20250101).integers(1, 1 << 63, size=TABLES * BAND, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter or number (Unicode L and N)."""
    return np.frombuffer(bytes(unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)), dtype=bool)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of at least MIN_LETTERS letters, without a Python object for any of them."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = np.concatenate(([False], _letters()[points], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    long = end - start >= MIN_LETTERS
    start, end = start[long], end[long]
    up, down = _powers(max(1 << 21, 1 << int(len(points)).bit_length()))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], dtype=np.uint64)))
        return start, _mix((total[end] - total[start]) * down[start])


def shingle_sets(texts: list[str], size: int = SHINGLE, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts in one array, each sorted, and the offsets of the texts in it; texts of fewer words have none."""
    sets, counts = [], []
    first, chars = 0, 0
    for i, t in enumerate(texts, 1):
        chars += len(t) + 1
        if chars > CHUNK_CHARS or i - first >= 4000 or i == len(texts):
            own, n = _chunk_sets(texts[first:i], size, min_words)
            sets.append(own)
            counts.append(n)
            first, chars = i, 0
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)


def _chunk_sets(texts: list[str], size: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    lowered = [t.lower() for t in texts]
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in lowered])))
    start, word = word_hashes("\n".join(lowered))
    doc = np.searchsorted(begins, start, side="right") - 1
    words = np.bincount(doc, minlength=len(texts))
    if len(word) < size:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    last = len(word) - size + 1
    with np.errstate(over="ignore"):
        mixed = np.zeros(last, np.uint64)
        for k in range(size):
            mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + word[k : k + last]
        mixed = _mix(mixed)
    whole = (doc[:last] == doc[size - 1 :]) & (words[doc[:last]] >= min_words)
    keyed = np.sort((doc[:last][whole].astype(np.uint64) << np.uint64(52)) | (mixed[whole] & _BITS))
    keyed = keyed[np.concatenate(([True], keyed[1:] != keyed[:-1]))] if len(keyed) else keyed
    return keyed & _BITS, np.bincount((keyed >> np.uint64(52)).astype(np.int64), minlength=len(texts))


def sketches(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set hash, the first token under each order) of each nonempty set; the tokens are 32 bits wide."""
    begin = offsets[:-1]
    with np.errstate(over="ignore"):
        tokens = _mix(flat)
        ids = np.add.reduceat(tokens, begin) * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor.reduceat(_mix(tokens), begin)
        first = np.empty((len(begin), len(_ODD)), np.uint32)
        for k, odd in enumerate(_ODD):
            least = np.minimum.reduceat(tokens * odd, begin)
            first[:, k] = (_mix(least) >> np.uint64(32)).astype(np.uint32)
    return ids.astype(np.int64), first


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [f"{a or ''} {b or ''}" for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]


def sketch_pages(pages: DataFrame, key: str, title: str, text: str) -> DataFrame:
    """``key``, ``class``, ``size`` and ``sketch`` of every text that has enough words."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        flat, offsets = shingle_sets(_texts(batch))
        sizes = np.diff(offsets)
        has = np.flatnonzero(sizes)
        if not len(has):
            return None
        ids, first = sketches(flat, np.concatenate((offsets[:-1][has], [len(flat)])))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(has)), pa.array(ids), pa.array(sizes[has].astype(np.int32)), pa.array([r.tobytes() for r in first], pa.binary())],
            names=["key", "class", "size", "sketch"],
        )

    part = pages.select(pages[key].alias("key"), pages[title].alias("title"), pages[text].alias("text"))
    return map_batches(part, run, f"key {kind}, class long, size int, sketch binary")


def _bands(first: np.ndarray) -> np.ndarray:
    """The hash of each set's band in each table."""
    keys = np.empty((TABLES, len(first)), np.int64)
    for t in range(TABLES):
        key = np.full(len(first), t + 1, np.uint64)
        with np.errstate(over="ignore"):
            for c in range(BAND * t, BAND * (t + 1)):
                key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + first[:, c])
        keys[t] = key.astype(np.int64)
    return keys


def _classes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, size, first tokens) of the distinct classes of a batch."""
    ids, at = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
    sizes = batch.column(1).to_numpy(zero_copy_only=False)[at].astype(np.int32)
    first = np.frombuffer(b"".join(batch.column(2).take(pa.array(at)).to_pylist()), np.uint32).reshape(len(ids), -1)
    return ids, sizes, first


def _slots(keys: np.ndarray, slots: int) -> np.ndarray:
    """Which of ``slots`` (a power of two) counters a band counts in."""
    return (keys.view(np.uint64) >> np.uint64(20)) & np.uint64(slots - 1)


def hot_slots(sketched: DataFrame, sets: int) -> list[int]:
    """The counters of bands that more than HOT sets may share; a band that falls in with others may be among them, which only costs copies.

    As many counters as keep the mean far below HOT; each task adds up its own,
    and only those above HOT are collected, at most one for each HOT rows.
    """
    slots = 1 << max(10, min(24, (8 * sets * TABLES // HOT).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(_slots(_bands(_classes(batch)[2]), slots).ravel().astype(np.int64), minlength=slots)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["slot", "n"])

    counted = sketched.select("class", "size", "sketch").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    return [slots, *(r["slot"] for r in counted.where(F.col("n") > HOT).collect())]


def _band_rows(batch: pa.RecordBatch, hot: list[int]) -> pa.RecordBatch:
    """A row for each set of the batch and table: its band, and what a comparison needs; of hot bands one for each pair of blocks that the set's block is in."""
    ids, sizes, first = _classes(batch)
    payload = np.empty((TABLES, len(ids)), dtype=_ROW)
    payload["id"], payload["size"], payload["pair"] = ids, sizes, _WHOLE
    payload["bits"] = np.concatenate([np.packbits((first[:, :SKETCHED] >> np.uint32(k)) & np.uint32(1), axis=1) for k in (7, 8)], axis=1)  # 32 bytes a set
    keys, payload = _bands(first).reshape(-1), payload.reshape(-1)
    if len(hot) > 1:
        split = np.isin(_slots(keys, hot[0]), np.array(hot[1:], np.uint64))
        own = _block_of(payload["id"][split])
        keys_of, rows_of = [keys[~split]], [payload[~split]]
        for other in range(BLOCKS):
            pair = np.minimum(own, other) * BLOCKS + np.maximum(own, other)
            rows = payload[split].copy()
            rows["pair"] = pair
            rows_of.append(rows)
            with np.errstate(over="ignore"):
                keys_of.append(_mix(keys[split].view(np.uint64) + pair.astype(np.uint64) + np.uint64(1)).view(np.int64))
        keys, payload = np.concatenate(keys_of), np.concatenate(rows_of)
    packed = pa.Array.from_buffers(pa.binary(_ROW.itemsize), len(payload), [None, pa.py_buffer(payload.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(keys), packed], names=["band", "row"])


_ROW = np.dtype([("id", "<i8"), ("size", "<i4"), ("pair", "u1"), ("bits", "u1", (32,))])
_WHOLE = 255


def _block_of(ids: np.ndarray) -> np.ndarray:
    return (_mix(ids.view(np.uint64)) % np.uint64(BLOCKS)).astype(np.int64)


def _differing(x: np.ndarray) -> np.ndarray:
    """How many tokens differ, from the exclusive or of two sketches (four words in the last axis)."""
    return np.bitwise_count(x[..., :2] | x[..., 2:]).sum(axis=-1)


def _words(rows: np.ndarray) -> np.ndarray:
    """The sketches as four columns of words."""
    return np.ascontiguousarray(rows["bits"].copy().view(np.uint64).T)


def _compare(rows: np.ndarray, others: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group, or of it and ``others``, whose sketches agree enough, by blocks of bounded size."""
    rows = rows[np.argsort(rows["size"], kind="stable")]
    own = others is None
    others = rows if own else others[np.argsort(others["size"], kind="stable")]
    x, y = _words(rows), _words(others)
    for i0 in range(0, len(rows), ROWS_AT_ONCE):
        a = slice(i0, i0 + ROWS_AT_ONCE)
        size = rows["size"][a].astype(np.int64)
        # Sizes ascend, so the others of fitting sizes are one range.
        first = max(int(np.searchsorted(others["size"], SIMILARITY * size[0])), i0 if own else 0)
        beyond = int(np.searchsorted(others["size"], size[-1] / SIMILARITY, side="right"))
        for j0 in range(first, beyond, COST):
            b = slice(j0, min(beyond, j0 + COST))
            differ = np.bitwise_count((x[0, a, None] ^ y[0, None, b]) | (x[2, a, None] ^ y[2, None, b]))
            differ += np.bitwise_count((x[1, a, None] ^ y[1, None, b]) | (x[3, a, None] ^ y[3, None, b]))
            i, j = np.nonzero(differ <= SKETCHED - AGREE)
            i, j = i + i0, j + j0
            m, n = rows["size"][i], others["size"][j]
            fits = (np.minimum(m, n) >= SIMILARITY * np.maximum(m, n)) & (rows["id"][i] != others["id"][j])
            if own:
                fits &= i < j
            yield rows["id"][i[fits]], others["id"][j[fits]]


def _dealt(key: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The comparisons of a large group: every two of its blocks, and every block with itself."""
    blocks = np.array_split(rows, min(BLOCKS, -(-len(rows) // DEALT)))
    for i in range(len(blocks)):
        for j in range(i, len(blocks)):
            yield _work([key], [i * BLOCKS + j], [blocks[i].tobytes()], [blocks[j].tobytes() if j > i else None])


def _work(a, b, block, other) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(block, pa.binary()), pa.array(other, pa.binary())], names=["a", "b", "block", "other"])


def _as_work(pairs: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(pairs.num_rows, pa.binary())
    return pa.RecordBatch.from_arrays([*pairs.columns, none, none], names=["a", "b", "block", "other"])


def _dealt_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes from the comparisons that were dealt out."""
    for batch in batches:
        for block, other in zip(batch.column(0), batch.column(1), strict=True):
            a, b = [], []
            for i, j in _compare(np.frombuffer(block.as_buffer(), _ROW), np.frombuffer(other.as_buffer(), _ROW) if other.is_valid else None):
                a.append(i)
                b.append(j)
                if sum(map(len, a)) > 200_000:
                    yield _distinct(a, b)
                    a, b = [], []
            if a:
                yield _distinct(a, b)


def _once(rows: np.ndarray) -> np.ndarray:
    return rows[np.unique(rows["id"], return_index=True)[1]]


def _group(key: int, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray] | pa.RecordBatch]:
    """The pairs of one band, or blocks to compare."""
    rows = _once(rows)
    pair = int(rows["pair"][0])
    if pair != _WHOLE:
        i, j = divmod(pair, BLOCKS)
        block = _block_of(rows["id"])
        one, other = rows[block == i], rows[block == j]
        yield from _compare(one, None if i == j else other)
    elif len(rows) > DEALT:
        yield from _dealt(key, rows)
    else:
        yield from _compare(rows)


def _meeting_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of their bands to pairs of classes, or blocks to compare; a band can span batches."""

    def pairs(keys: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        edges = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
        sizes = np.diff(edges)
        two = edges[:-1][sizes == 2]
        if len(two):  # most groups, so all of them at once
            x, y = rows[two], rows[two + 1]
            differ = _differing(x["bits"].copy().view(np.uint64) ^ y["bits"].copy().view(np.uint64))
            fits = (differ <= SKETCHED - AGREE) & (np.minimum(x["size"], y["size"]) >= SIMILARITY * np.maximum(x["size"], y["size"])) & (x["id"] != y["id"])
            a.append(x["id"][fits])
            b.append(y["id"][fits])
        for at in np.flatnonzero(sizes > 2):
            for met in _group(int(keys[edges[at]]), rows[edges[at] : edges[at + 1]]):
                if isinstance(met, pa.RecordBatch):
                    yield met
                    continue
                a.append(met[0])
                b.append(met[1])
                if sum(map(len, a)) > 200_000:
                    yield _as_work(_distinct(a, b))
                    a, b = [], []
        if a:
            yield _as_work(_distinct(a, b))

    # What may go on in the next batch: rows of one band, in pieces; copies are dropped each time they have doubled.
    key, kept, held, distinct = None, [], 0, 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), _ROW)
        if not len(keys):
            continue
        if key is not None and keys[-1] == key:  # all of it goes on with the same band
            kept.append(rows)
        else:
            last = int(np.searchsorted(keys, keys[-1]))
            before = np.concatenate([*kept, rows[:last]])
            if len(before):
                yield from pairs(np.concatenate([np.full(sum(map(len, kept)), key or 0, np.int64), keys[:last]]), before)
            key, kept, distinct = keys[-1], [rows[last:]], 0
        held = sum(map(len, kept))
        if held > max(4 * COST, 2 * distinct):
            kept = [_once(np.concatenate(kept))]
            distinct = len(kept[0])
    if kept:
        rows = np.concatenate(kept)
        yield from pairs(np.full(len(rows), key, np.int64), rows)


def _distinct(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = np.concatenate(a), np.concatenate(b)
    both = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def _jaccard(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """``a``, ``b`` and ``similarity`` of the similar ones of a cell's pairs, from the sets of the cell's classes (sorted tokens of 32 bits)."""
    known = pa.compute.unique(sets["class"]).to_numpy(zero_copy_only=False)
    held = dict(zip(sets["class"].to_pylist(), sets["tokens"].to_pylist(), strict=True))
    tokens = [np.frombuffer(held[c], np.uint32) for c in known.tolist()]
    order = np.argsort(known)
    a, b = (order[np.searchsorted(known[order], pairs[c].to_numpy())] for c in ("a", "b"))
    sizes = np.array([len(t) for t in tokens], np.int64)
    at = np.argsort(a, kind="stable")
    out_a, out_b, score = [], [], []
    for run in np.split(at, np.flatnonzero(np.diff(a[at])) + 1):
        own = tokens[a[run[0]]]
        for i in range(0, len(run), ROWS_AT_ONCE):
            others = b[run[i : i + ROWS_AT_ONCE]]
            theirs = np.concatenate([tokens[k] for k in others])
            place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            shared = np.add.reduceat(own[place] == theirs, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            union = len(own) + sizes[others] - shared
            fits = shared >= SIMILARITY * union
            out_a.append(np.full(fits.sum(), known[a[run[0]]]))
            out_b.append(known[others[fits]])
            score.append(shared[fits] / union[fits])
    return pa.table([np.concatenate(out_a), np.concatenate(out_b), np.concatenate(score)], names=["a", "b", "similarity"])


def join_classes(pages: DataFrame, key: str = "page_id", title: str = "title", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): ``key`` and ``class`` of every text with enough words; ``a`` < ``b`` and ``similarity`` of similar classes."""
    ensure_checkpoint_dir(pages.sparkSession)
    sketched = sketch_pages(pages, key, title, text).checkpoint()
    members = sketched.select("key", "class")
    sets = sketched.count()
    hot = hot_slots(sketched, sets)
    rows = map_batches(sketched.select("class", "size", "sketch"), lambda batch: _band_rows(batch, hot), "band long, row binary")
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, sets * TABLES * (_ROW.itemsize + 16) // TASK_BYTES)
    met = rows.repartition(tasks, "band").sortWithinPartitions("band").mapInArrow(_meeting_pairs, "a long, b long, block binary, other binary").checkpoint()
    dealt = met.where("block is not null").repartition("a", "b").select("block", "other").mapInArrow(_dealt_pairs, "a long, b long")
    meeting = met.where("block is null").select("a", "b").unionAll(dealt).distinct().checkpoint()
    wanted = meeting.select(F.col("a").alias("class")).union(meeting.select(F.col("b").alias("class"))).distinct()
    met_pairs = meeting.count()
    few = 2 * met_pairs <= BROADCAST_CLASSES
    chosen = members.join(F.broadcast(wanted) if few else wanted, "class").groupBy("class").agg(F.min("key").alias("key"))
    chosen = F.broadcast(chosen) if few else chosen
    kind = pages.schema[key].dataType.simpleString()

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = shingle_sets(_texts(batch))
        narrow = _mix(flat).astype(np.uint32)  # two of a pair's few hundred tokens hardly ever fall together in 32 bits
        own = [np.unique(narrow[i:j]).tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(own, pa.binary())], names=["key", "class", "tokens"])

    part = pages.select(pages[key].alias("key"), pages[title].alias("title"), pages[text].alias("text")).join(chosen, "key")
    tokens = map_batches(part.select("key", "title", "text", "class"), sets, f"key {kind}, class long, tokens binary").select("class", "tokens").dropDuplicates(["class"])
    # Pairs and sets meet in the cells of a grid, so a set is sent at most once for each of its cells, however many pairs it has.
    side = max(math.ceil(math.sqrt(pages.sparkSession.sparkContext.defaultParallelism)), math.ceil(math.sqrt(met_pairs / CELL_PAIRS)))
    row, column = (F.pmod(F.xxhash64(c), F.lit(side)) for c in ("a", "b"))
    cells = meeting.select((row * side + column).alias("cell"), "a", "b")
    needed = cells.select(F.col("cell").alias("place"), F.col("a").alias("class")).unionAll(cells.select("cell", "b")).distinct()
    placed = needed.join(tokens, "class").select("place", "class", "tokens")
    return members, cells.groupBy("cell").cogroup(placed.groupBy("place")).applyInArrow(lambda pairs, sets: _jaccard(pairs, sets), "a long, b long, similarity double")


def similar_pairs(pages: DataFrame, key: str = "page_id", title: str = "title", text: str = "text") -> DataFrame:
    """``page_a`` < ``page_b`` of every similar pair of texts, copies included.

    Null fields count as empty; texts of fewer than MIN_WORDS words have no
    pairs; an empty table gives none.  A key that stands on several rows pairs
    with others once and never with itself.
    """
    members, links = join_classes(pages, key, title, text)
    one = members.select(F.col("key").alias("page_a"), F.col("class").alias("a"))
    two = members.select(F.col("key").alias("page_b"), F.col("class").alias("b"))
    apart = links.select("a", "b").join(one, "a").join(two, "b").select(F.least("page_a", "page_b").alias("page_a"), F.greatest("page_a", "page_b").alias("page_b"))
    copied = members.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("class").alias("a"))
    copies = one.join(copied, "a").join(two, F.col("a") == F.col("b")).select("page_a", "page_b")
    return apart.unionByName(copies).where("page_a < page_b").distinct()


def clusters(links: DataFrame) -> DataFrame:
    """``class`` and ``cluster`` of every class that has a link: the least class that a chain of links leads to.

    Every class takes the least label among its own and its neighbours', then the
    label of its label, until none changes; a label's rows are added up before
    they are gathered, so classes of many links cost no more than others.  Each
    round is written, so a lost executor loses no more than its own part.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionAll(links.select(F.col("b").alias("class"), F.col("a").alias("other"))).distinct().checkpoint()
    labels = edges.groupBy("class").agg(F.min("other").alias("least")).select("class", F.least("class", "least").alias("cluster")).checkpoint()
    while True:
        near = edges.join(labels.select(F.col("class").alias("other"), "cluster"), "other").groupBy("class").agg(F.min("cluster").alias("near"))
        lower = labels.join(near, "class").select("class", F.col("cluster").alias("was"), F.least("cluster", "near").alias("low"))
        jump = labels.select(F.col("class").alias("low"), F.col("cluster").alias("further"))
        moved = lower.join(jump, "low", "left").select("class", "was", F.least("low", F.coalesce("further", "low")).alias("cluster")).checkpoint()
        if moved.where("cluster <> was").isEmpty():
            return moved.select("class", "cluster")
        labels = moved.select("class", "cluster")


def groups(pages: DataFrame, key: str = "page_id", title: str = "title", text: str = "text") -> DataFrame:
    """One row a key: its ``class`` of equal sets, how many other classes are similar to it (``links``), its ``cluster`` (what chains of links hold together) and the cluster's ``representative``, the least key in it.

    Texts of too few words have null classes and no links, and represent themselves.
    """
    members, links = join_classes(pages, key, title, text)
    links = links.select("a", "b").checkpoint()
    ends = links.select(F.col("a").alias("class")).unionAll(links.select(F.col("b").alias("class")))
    counted = ends.groupBy("class").agg(F.count(F.lit(1)).alias("links"))
    told = members.join(counted, "class", "left").join(clusters(links), "class", "left").select("key", "class", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("cluster", "class").alias("cluster"))
    least = told.groupBy("cluster").agg(F.min("key").alias("representative"))
    joined = told.join(least, "cluster").groupBy("key").agg(F.min(F.struct("class", "links", "cluster", "representative")).alias("own")).select(F.col("key").alias(key), "own.*")
    return pages.select(key).distinct().join(joined, key, "left").select(key, "class", F.coalesce("links", F.lit(0)).alias("links"), "cluster", F.coalesce("representative", key).alias("representative"))
