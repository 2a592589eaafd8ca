"""Derived columns, facet arrays and faceted filters (OR within a facet, AND across facets)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.functions.vocab import Facet


def bucket(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """The first name whose edge is above ``value``, else the last; null for null.  Edges belong to the bucket above them."""
    if len(names) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} names, not {len(names)}")
    ladder = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(edges, names, strict=False):
        ladder = ladder.when(value < edge, F.lit(name))
    return ladder.otherwise(F.lit(names[-1]))


def half_up(value: Column) -> Column:
    """Rounded to the nearest integer, halves upwards."""
    return F.floor(value + F.lit(0.5)).cast("long")


def derive(dishes: DataFrame) -> DataFrame:
    """``dishes`` with ``cal_oz``, ``total_minutes`` and the four buckets; null where a part is null or ounces aren't positive."""
    ratio = F.when(F.col("ouncesperserving") > 0, F.col("caloriesperserving") / F.col("ouncesperserving"))
    with_numbers = dishes.withColumns({"cal_oz": half_up(ratio), "total_minutes": (F.col("prepminutes") + F.col("cookminutes")).cast("long")})
    return with_numbers.withColumns(
        {
            "time_bucket": bucket(F.col("total_minutes"), vocab.TIME_EDGES, vocab.TIME_NAMES),
            "cal_oz_bucket": bucket(F.col("cal_oz"), vocab.CAL_OZ_EDGES, vocab.CAL_OZ_NAMES),
            "calorie_bucket": bucket(F.col("caloriesperserving"), vocab.CALORIE_EDGES, vocab.CALORIE_NAMES),
            "protein_bucket": bucket(F.col("proteingrams"), vocab.PROTEIN_EDGES, vocab.PROTEIN_NAMES),
        }
    )


# The column behind each facet.
FACET_COLUMNS = {
    "style": "tripstyle", "slot": "slot", "heat": "heatsource", "time": "time_bucket", "caloz": "cal_oz_bucket", "cal": "calorie_bucket", "protein": "protein_bucket",
    "cleanup": "cleanup", "diet": "dietary", "prep": "homeprep", "shelf": "shelflife", "skill": "skill", "cost": "cost",
}


def facet_array(df: DataFrame, column: str) -> Column:
    """A facet is many-valued: arrays as they are, scalars as arrays of one, null as an empty array."""
    if df.schema[column].dataType.typeName() == "array":
        return F.coalesce(F.col(column), F.array().cast("array<string>"))
    return F.array_compact(F.array(F.col(column).cast("string")))


def facet_columns(df: DataFrame, columns: Mapping[str, str] = FACET_COLUMNS) -> dict[str, Column]:
    return {key: facet_array(df, column) for key, column in columns.items()}


def search_text(title: Column, blurb: Column, ingredients: Column) -> Column:
    """Lower-case title, blurb and item names; null parts count as absent."""
    return F.lower(F.concat_ws(" ", title, blurb, F.array_join(F.transform(ingredients, lambda i: i["item"]), " ")))


def matches(facets: Mapping[str, Column], selected: Mapping[str, Sequence[str]]) -> Column:
    """Every facet with a selection shares a value with it; an empty selection constrains nothing, an unknown facet matches nothing."""
    condition = F.lit(True)
    for key, values in selected.items():
        if values:
            own = facets.get(key)
            condition = condition & (F.lit(False) if own is None else F.coalesce(F.arrays_overlap(own, F.array(*map(F.lit, values))), F.lit(False)))
    return condition


def active(selected: Sequence[str] | None, everything: Sequence[str]) -> bool:
    """Whether a selection narrows its facet: some but not all options, by their number."""
    return 0 < len(selected or ()) < len(everything)


def active_count(selected: Mapping[str, Sequence[str]], everything: Mapping[str, Sequence[str]] = vocab.ALL_VALUES, keys: Sequence[str] = tuple(vocab.FACET_KEYS)) -> int:
    return sum(active(selected.get(k), everything.get(k, ())) for k in keys)


def narrowed(selected: Mapping[str, Sequence[str]], everything: Mapping[str, Sequence[str]] = vocab.ALL_VALUES) -> dict[str, list[str]]:
    """The selection without facets that constrain nothing: full ones and empty ones."""
    return {k: list(v) for k, v in selected.items() if active(v, everything.get(k, ()))}


def not_draft(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("draft"), F.lit(False)))


def facet_counts(df: DataFrame, facets: Sequence[Facet] = vocab.FACETS, columns: Mapping[str, str] = FACET_COLUMNS) -> DataFrame:
    """``key``, ``value``, ``value_label`` and ``n`` of every option, 0 for those that no row has.

    One scan: each row's options of all facets are exploded together and counted
    before the shuffle; rows count once an option, however often they repeat it.
    """

    def keyed(key: str) -> Column:
        return F.transform(F.array_distinct(facet_array(df, columns[key])), lambda v: F.struct(F.lit(key).alias("key"), v.alias("value")))

    pairs = F.flatten(F.array(*[keyed(f.key) for f in facets]))
    counted = df.select(F.explode(pairs).alias("p")).groupBy("p.key", "p.value").agg(F.count(F.lit(1)).alias("n"))
    dimension = vocab.dimension(df.sparkSession, tuple(facets))
    return dimension.join(counted, ["key", "value"], "left").select("key", "value", "value_label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def labelled(df: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``value_label``: the label of ``value`` under ``key``, or the value itself where the vocabulary lacks it."""
    dimension = vocab.dimension(df.sparkSession).select(F.col("key").alias("_k"), F.col("value").alias("_v"), "value_label")
    joined = df.join(F.broadcast(dimension), (F.col(key) == F.col("_k")) & (F.col(value) == F.col("_v")), "left").drop("_k", "_v")
    return joined.withColumn("value_label", F.coalesce("value_label", F.col(value)))
