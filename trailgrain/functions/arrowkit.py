"""Thin helpers around ``DataFrame.mapInArrow`` for the few operators Catalyst cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: A table of fewer files than there are cores is dealt out evenly, if it has at most so many bytes for each core.
SPREAD_BYTES = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df``, repartitioned if it is a scan of few files that would keep few cores busy.

    A small file is one row group, which no split divides, so Python would run
    in one task.  Larger tables are left to the splits of their scan, and plans
    that shuffle have their partitions already.
    """
    execution = df._jdf.queryExecution()
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(execution.optimizedPlan().stats().sizeInBytes()))
    if cores < 2 or size > SPREAD_BYTES * cores or "Exchange" in execution.executedPlan().toString():
        return df
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; batches for which it returns None or no rows are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return spread(df).mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``; on one machine, where it is unset, a folder of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder for checkpoints.  A session with ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes them when they are of no more use."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
