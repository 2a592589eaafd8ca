"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from trailgrain.functions.urls import canonical_url


def read_log(spark: SparkSession, path: str, schema: str | StructType, files_per_trigger: int = 1000) -> DataFrame:
    """An append-only folder of JSON lines as a stream; torn lines are left out."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(path)


def first_seen(stream: DataFrame, url: str = "url", time: str | None = None, late: str = "7 days") -> DataFrame:
    """The first row of every canonical URL, across runs through the checkpoint.

    Without ``time`` every key is remembered.  With it keys are remembered as
    long as ``late``, which bounds the state; later repeats pass again.
    """
    keyed = stream.withColumn("canonical", canonical_url(F.col(url)))
    if time is None:
        return keyed.dropDuplicates(["canonical"])
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["canonical"])


def throttled(stream: DataFrame, host: str, at_ms: str, order: str, gap_ms: int = 1500) -> DataFrame:
    """(host, order, at_ms, start_ms): the start of each request, at least ``gap_ms`` after the host's last; the last start is the state of a host."""
    out = f"host string, {order} long, at_ms long, start_ms long"

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["at_ms", order])
        starts = []
        for at in rows["at_ms"].tolist():
            last = at if last is None else max(at, last + gap_ms)
            starts.append(last)
        state.update((last,))
        yield pd.DataFrame({"host": key[0], order: rows[order].to_numpy(), "at_ms": rows["at_ms"].to_numpy(), "start_ms": starts})

    keyed = stream.select(F.col(host).cast("string").alias("host"), F.col(order).cast("long").alias(order), F.col(at_ms).cast("long").alias("at_ms"))
    return keyed.groupBy("host").applyInPandasWithState(step, out, "last long", "append", GroupStateTimeout.NoTimeout)


def bursts(stream: DataFrame, key: str, time: str, quiet: str = "120 milliseconds", late: str = "10 minutes") -> DataFrame:
    """``key``, the end of each burst and its number of events: a session that ends after a quiet time."""
    windows = stream.withWatermark(time, late).groupBy(F.session_window(time, quiet).alias("burst"), F.col(key))
    return windows.agg(F.count(F.lit(1)).alias("events"), F.max(time).alias("last_at")).select(key, "last_at", "events")


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write all that is there and stop; the next run goes on from the checkpoint."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
