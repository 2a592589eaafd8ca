"""Nutrition of records from their ingredients: lookup, sums, and reconciliation with the macronutrients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kcal for each gram of protein, carbohydrate and fat.
KCAL_PROTEIN, KCAL_CARB, KCAL_FAT = 4, 4, 9
#: Largest difference between energy and macronutrients, as a part of the energy.
TOLERANCE = 0.2
GRAMS_AN_OUNCE = 28.349523125


def item_key(item: Column) -> Column:
    """How items are looked up: lower case, without what stands in brackets or after a comma, single spaces."""
    plain = F.regexp_replace(F.lower(item), r"\s*[(\[].*$|\s*,.*$", "")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def matched(items: DataFrame, foods: DataFrame) -> DataFrame:
    """``items`` (item, grams, ...) with kcal, protein, carb, fat and ``matched``.

    ``foods``: food, kcal, protein, carb, fat for each 100 g, one row a food.  An
    item without food, or of unknown weight, has nulls and isn't matched: the
    caller's estimates can be put in their place, and it stays flagged.
    """
    held = foods.select(F.col("food").alias("_food"), *[F.col(c).alias(f"_{c}") for c in ("kcal", "protein", "carb", "fat")])
    met = items.join(held, item_key(F.col("item")) == F.col("_food"), "left")
    share = F.col("grams") / 100
    values = {c: F.col(f"_{c}") * share for c in ("kcal", "protein", "carb", "fat")}
    return met.withColumns(values | {"matched": F.col("_food").isNotNull() & F.col("grams").isNotNull()}).drop("_food", "_kcal", "_protein", "_carb", "_fat")


def rollup(items: DataFrame, key: list[str], servings: Column, fallback_kcal: float = 100.0) -> DataFrame:
    """One row a record: kcal, protein, carb and fat of a serving, dry ounces of a serving, ``unmatched`` items and whether energy and macronutrients agree.

    ``items``: ``key``, grams, kcal, protein, carb, fat, matched, ``at_camp``
    (water and the like that are added at camp and don't count as packed weight).
    An unmatched item counts ``fallback_kcal``, and is counted as such.  Records
    of no or null servings have null results.  Sums are partial before the
    shuffle, so a record of many items costs no more than its sums.
    """
    per = F.when(servings > 0, servings)
    dry = F.sum(F.when(~F.coalesce("at_camp", F.lit(False)), F.col("grams")))
    sums = items.withColumn("_servings", per).groupBy(*key).agg(
        F.max("_servings").alias("servings"),
        F.sum(F.when(F.col("matched"), F.col("kcal")).otherwise(F.lit(fallback_kcal))).alias("kcal"),
        *[F.coalesce(F.sum(F.when(F.col("matched"), F.col(c))), F.lit(0.0)).alias(c) for c in ("protein", "carb", "fat")],
        F.coalesce(dry, F.lit(0.0)).alias("grams"),
        F.count_if(~F.col("matched")).alias("unmatched"),
    )
    each = {c: F.col(c) / F.col("servings") for c in ("kcal", "protein", "carb", "fat")}
    return sums.withColumns(each | {"dry_ounces": F.col("grams") / GRAMS_AN_OUNCE / F.col("servings")}).drop("grams").withColumn("reconciled", reconciled(F.col("kcal"), F.col("protein"), F.col("carb"), F.col("fat")))


def reconciled(kcal: Column, protein: Column, carb: Column, fat: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether the energy is that of the macronutrients, give or take ``tolerance`` of it; null energy isn't, zero energy is if they are zero."""
    implied = protein * KCAL_PROTEIN + carb * KCAL_CARB + fat * KCAL_FAT
    return F.coalesce(F.abs(kcal - implied) <= kcal * tolerance, F.lit(False))
