"""Rows from literals: work cells of several lists, and job parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cells(spark: SparkSession, lists: Mapping[str, tuple[str, Sequence[tuple[str, str]]]]) -> DataFrame:
    """``id``, ``sourcetype``, ``region``, ``lexicon``: an id is its list's prefix and the three-digit place in it, from 1.

    ``lists``: prefix to (source type, [(region, lexicon)]).
    """
    rows = [(prefix, kind, [{"region": r, "lexicon": x} for r, x in members]) for prefix, (kind, members) in lists.items()]
    df = spark.createDataFrame(rows, "prefix string, sourcetype string, members array<struct<region:string,lexicon:string>>")
    placed = df.select("prefix", "sourcetype", F.posexplode("members").alias("at", "m"))
    return placed.select(F.format_string("%s%03d", "prefix", F.col("at") + 1).alias("id"), "sourcetype", "m.region", "m.lexicon")


def parameters(arguments: Sequence[str], defaults: Mapping[str, int]) -> dict[str, int]:
    """``--name N`` pairs over ``defaults``; what isn't a number keeps its default."""
    out = dict(defaults)
    for name, value in zip(arguments, arguments[1:], strict=False):
        key = name.removeprefix("--")
        if name.startswith("--") and key in out and value.lstrip("-").isdigit():
            out[key] = int(value)
    return out
