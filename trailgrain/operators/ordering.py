"""Sort modes with stable ties, and global positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.functions.arrowkit import ensure_checkpoint_dir


def sort_columns(mode: str, title: str = "title", key: str = "id") -> list[Column]:
    """The order of a mode (an unknown one is the default), ties by title in locale order, then by key; nulls last."""
    first = {
        "cal-oz": F.col("cal_oz").desc_nulls_last(),
        "weight": F.col("ouncesperserving").asc_nulls_last(),
        "time": F.col("total_minutes").asc_nulls_last(),
        "calories": F.col("caloriesperserving").desc_nulls_last(),
        "title": None,
    }.get(mode if mode in vocab.SORTS else vocab.DEFAULT_SORT)
    by_title = F.collate(F.lower(F.col(title)), "UNICODE").asc_nulls_last()
    return [c for c in (first, by_title, F.col(key).asc_nulls_last()) if c is not None]


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in a global order.

    A window without partitions would sort everything in one task.  Here the
    rows are range-partitioned and sorted, numbered within their partition, and
    shifted by the sizes of the partitions before it; the sorted rows are
    written once, so that both passes see the same partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    local = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}).checkpoint()
    sizes = {r["_part"]: r["n"] for r in local.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    shift = F.lit(0).cast("long")
    if before:
        shift = F.element_at(F.create_map(*[F.lit(x) for p, b in before.items() for x in (p, b)]), F.col("_part")).cast("long")
    return local.withColumn(name, F.col("_at") + shift).drop("_part", "_at")
