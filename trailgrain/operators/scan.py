"""Scans over each key's rows in order, without gathering a key in one task.

The rows are range-partitioned by key and order, so a key of many rows lies in
several partitions, one after the other.  Each partition is read once for what
its ends say, which is a row a partition, and once more with what the partitions
before or after it hand over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, LongType, StructType

from trailgrain.functions.arrowkit import ensure_checkpoint_dir

_APART = 1 << 45  # more than any two times in milliseconds differ


def in_order(df: DataFrame, key: str, at: str, order: str) -> DataFrame:
    """``df`` with rows of one key side by side and in order, written once, so that both passes see the same partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(F.col(key).asc_nulls_first(), F.col(at).asc(), F.col(order).asc()).sortWithinPartitions(F.col(key).asc_nulls_first(), F.col(at).asc(), F.col(order).asc()).checkpoint()


def _runs(keys: pa.Array) -> np.ndarray:
    """Where the runs of equal keys of a batch begin; nulls are equal."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1))


def _starts(at: np.ndarray, runs: np.ndarray, gap: int, carry: int | None) -> np.ndarray:
    """The start of each request of a batch; ``carry`` is the last start of the first run's key, if there was one before."""
    sizes = np.diff([*runs, len(at)])
    place = np.arange(len(at)) - np.repeat(runs, sizes)
    shift = np.repeat(np.arange(len(runs), dtype=np.int64), sizes) * _APART
    slack = np.maximum.accumulate(at - gap * place + shift) - shift
    if carry is not None:
        slack[: sizes[0]] = np.maximum(slack[: sizes[0]], carry + gap)
    return slack + gap * place


def _throttled(batches: Iterator[pa.RecordBatch], key: str, at: str, gap: int, carry: int | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, bool]]:
    """(batch, starts, its runs, whether its first run goes on) in order; ``carry`` belongs to the first key."""
    last, seen = carry, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, runs = batch.column(key), _runs(batch.column(key))
        goes_on = seen is None and carry is not None or seen is not None and keys[0].as_py() == seen[0]
        starts = _starts(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64), runs, gap, last if goes_on else None)
        yield batch, starts, runs, goes_on
        last, seen = int(starts[-1]), (keys[batch.num_rows - 1].as_py(),)


def throttle(requests: DataFrame, key: str, at: str, order: str, gap: int) -> DataFrame:
    """``requests`` with ``start_ms``: the first time that is neither before the arrival nor within ``gap`` of the key's last start.

    A key's rows in a partition take the last start before them, c, to the
    larger of their own last start and c plus ``gap`` a row, so what a
    partition hands on takes one row to tell.  Null times start at null and
    delay nobody; null keys are one key.
    """
    known = requests.where(F.col(at).isNotNull())
    placed = in_order(known, key, at, order)
    kind = placed.schema[key].dataType.simpleString()

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, start, count, single = None, None, None, 0, True
        for batch, starts, runs, goes_on in _throttled(batches, key, at, gap, None):
            keys = batch.column(key)
            first = first or (keys[0].as_py(),)
            own = batch.num_rows - int(runs[-1])
            count = count + own if len(runs) == 1 and goes_on else own
            last, start = (keys[batch.num_rows - 1].as_py(),), int(starts[-1])
            single = single and len(runs) == 1 and last == first
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "first": pa.array([first[0]], types), "last": pa.array([last[0]], types), "start": [start], "count": [count], "single": [single]})

    types = to_arrow_type(placed.schema[key].dataType)
    told = placed.select(key, at).mapInArrow(ends, f"part long, first {kind}, last {kind}, start long, count long, single boolean").collect()
    carries: dict[int, int] = {}
    before: tuple | None = None  # (key, its last start) at the end of the partitions so far
    for r in sorted(told):
        goes_on = before is not None and before[0] == r["first"]
        if goes_on:
            carries[r["part"]] = before[1]
        start = max(r["start"], before[1] + gap * r["count"]) if goes_on and r["single"] else r["start"]
        before = (r["last"], start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts, _, _ in _throttled(batches, key, at, gap, carries.get(TaskContext.get().partitionId())):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.int64())], names=[*batch.schema.names, "start_ms"])

    done = placed.mapInArrow(run, StructType([*placed.schema.fields]).add("start_ms", LongType()))
    return done.unionByName(requests.where(F.col(at).isNull()).withColumn("start_ms", F.lit(None).cast("long")))


def last_of_bursts(events: DataFrame, key: str, at: str, order: str, quiet: int) -> DataFrame:
    """The events that none of the same key follows within ``quiet``; those of null times are left out, null keys are one key."""
    placed = in_order(events.where(F.col(at).isNotNull()), key, at, order)
    kind = placed.schema[key].dataType.simpleString()

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), batch.column(0).slice(0, 1), batch.column(1).slice(0, 1).cast(pa.int64())], names=["part", "first", "at"])
                return

    told = sorted(placed.select(key, at).mapInArrow(heads, f"part int, first {kind}, at long").collect())
    parts = [r["part"] for r in told]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far, which the next batch or partition decides about

        def marked(batch: pa.RecordBatch, following: tuple | None) -> pa.RecordBatch:
            keys, times = batch.column(key), batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            quiet_after = np.ones(batch.num_rows, bool)
            same = np.ones(max(0, batch.num_rows - 1), bool)
            same[_runs(keys)[1:] - 1] = False
            quiet_after[:-1] = ~same | (np.diff(times) >= quiet)
            if following is not None:
                quiet_after[-1] = following[0] != keys[batch.num_rows - 1].as_py() or following[1] - times[-1] >= quiet
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(quiet_after)], names=[*batch.schema.names, "_quiet"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield marked(held, (batch.column(key)[0].as_py(), batch.column(at)[0].as_py()))
            held = batch
        if held is not None:
            own = TaskContext.get().partitionId()
            after = next((r for p, r in zip(parts, told, strict=True) if p > own), None)
            yield marked(held, (after["first"], after["at"]) if after is not None else None)

    return placed.mapInArrow(run, StructType([*placed.schema.fields]).add("_quiet", BooleanType())).where("_quiet").drop("_quiet")
