"""Validation: rules over rows, with the names of those that a row breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.functions.columns import let


def _within(column: str, values) -> Column:
    return F.col(column).isin(*values)


def _all_within(column: str, values) -> Column:
    return F.forall(F.col(column), lambda v: v.isin(*values))


def record_rules() -> dict[str, Column]:
    """The rules of a record; each is true where it holds, and null counts as broken where the field is required."""
    v = vocab.ALL_VALUES
    rules = {"title": F.col("title").isNotNull(), "blurb": F.col("blurb").isNotNull()}
    for column, key in (("tripstyle", "style"), ("slot", "slot"), ("heatsource", "heat")):
        rules[column] = (F.size(column) >= 1) & _all_within(column, v[key])
    for column in ("prepminutes", "cookminutes", "proteingrams"):
        rules[column] = F.col(column) >= 0
    for column in ("caloriesperserving", "ouncesperserving", "servings"):
        rules[column] = F.col(column) > 0
    rules["waterml"] = F.coalesce("waterml", F.lit(0)) >= 0
    rules["dietary"] = _all_within("dietary", v["diet"]) | F.col("dietary").isNull()
    rules["water"] = _within("water", vocab.WATER)
    for column, key in (("cleanup", "cleanup"), ("homeprep", "prep"), ("shelflife", "shelf"), ("skill", "skill"), ("cost", "cost")):
        rules[column] = _within(column, v[key])
    rules["ingredients"], rules["steps"] = F.size("ingredients") >= 1, F.size("steps") >= 1
    return rules


# Words of animal items, which a vegan record can't have.
ANIMAL = "milk|cream|butter|ghee|cheese|cheddar|parmesan|gruyère|yogurt|yoghurt|egg|eggs|honey|beef|pork|bacon|ham|salami|chorizo|pepperoni|jerky|chicken|turkey|sausage|tuna|salmon|trout|sardines|anchovies|shrimp|gelatin"
#: Bounds of a plausible record.
CAL_OZ_BOUNDS, PROTEIN_MOST, SERVINGS_MOST = (40, 190), 60, 24
#: Bounds that a published collection keeps.
CAL_OZ_SANE = (30, 230)


def has_animal_items(ingredients: Column) -> Column:
    """Whether the name of any item has a word of ``ANIMAL``; plant milks, nut butters and cream of a plant have none."""
    plant = r"(?i)\b(?:coconut|oat|soy|soya|almond|rice|peanut|nut|cashew|cocoa|shea|vegan) (?:milk|cream|butter|cheese|yogurt|egg)"
    return F.exists(ingredients, lambda i: F.coalesce(F.regexp_replace(i["item"], plant, "").rlike(rf"(?i)(?<![\p{{L}}])(?:{ANIMAL})(?![\p{{L}}])"), F.lit(False)))


def consistency_rules() -> dict[str, Column]:
    """Rules between facets."""
    return {
        "cold-soak-unboiled": ~F.array_contains("heatsource", "cold-soak") | (F.col("water") != "boiled"),
        "no-cook-unboiled": ~F.array_contains("heatsource", "no-cook") | (F.col("water") != "boiled"),
        "no-cook-no-minutes": ~F.array_contains("heatsource", "no-cook") | (F.col("cookminutes") == 0),
        "vegan-vegetarian": ~F.array_contains("dietary", "vegan") | F.array_contains("dietary", "vegetarian"),
        "vegan-no-animal-items": ~F.array_contains("dietary", "vegan") | ~has_animal_items(F.col("ingredients")),
        "no-dutch-oven-thru-hike": ~(F.array_contains("heatsource", "dutch-oven") & F.array_contains("tripstyle", "thru-hike")),
        "no-cooler-thru-hike": ~((F.col("shelflife") == "cooler") & F.array_contains("tripstyle", "thru-hike")),
    }


def plausibility_rules() -> dict[str, Column]:
    """Bounds on the derived numbers (``derive`` adds them)."""
    return {
        "cal-oz-bounds": F.col("cal_oz").between(*CAL_OZ_BOUNDS),
        "protein-bound": F.col("proteingrams") <= PROTEIN_MOST,
        "servings-bounds": F.col("servings").between(1, SERVINGS_MOST),
        "minutes-unless-no-cook": (F.col("total_minutes") > 0) | F.array_contains("heatsource", "no-cook"),
    }


def violations(df: DataFrame, rules: Mapping[str, Column], name: str = "violations") -> DataFrame:
    """``df`` with the names of the rules that each row breaks; an unknown (null) rule counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(k)) for k, rule in rules.items()]))
    return df.withColumn(name, broken)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``violations``)."""
    checked = violations(df, rules)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def route(df: DataFrame, rules: Mapping[str, Column], slug: str = "id") -> DataFrame:
    """``df`` with ``reasons``, the rules it breaks, and ``place``: ``content/<first letter>`` if there are none, else ``quarantine``.

    The letter is the slug's first, in lower case; slugs that don't begin with a
    letter or digit, and null ones, go to ``content/other``.
    """
    letter = F.coalesce(F.nullif(F.regexp_extract(F.lower(F.col(slug)), r"^[a-z0-9]", 0), F.lit("")), F.lit("other"))
    judged = violations(df, rules, "reasons")
    return judged.withColumn("place", F.when(F.size("reasons") > 0, F.lit("quarantine")).otherwise(F.concat(F.lit("content/"), letter)))


def content_invariants(dishes: DataFrame, facet_options: DataFrame, minimums: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """``invariant``, ``n`` and ``holds`` of what a published collection keeps, in one scan besides the options' counts.

    Rows that break a rule are counted and there must be none; ``minimums`` gives
    conditions and how many rows must fulfil them; every option of a core facet
    (``key``, ``value``, ``n`` in ``facet_options``) must have a row.
    """
    low, high = CAL_OZ_SANE
    none = {
        "cal-oz-sane": ~F.coalesce((F.col("cal_oz") > low) & (F.col("cal_oz") < high), F.lit(False)),
        "no-cook-unboiled": F.array_contains("heatsource", "no-cook") & F.coalesce(F.col("water") == "boiled", F.lit(False)),
        "vegan-vegetarian": F.array_contains("dietary", "vegan") & ~F.array_contains("dietary", "vegetarian"),
    }
    counts = [F.count_if(c).alias(k) for k, c in none.items()] + [F.count_if(c).alias(k) for k, (c, _) in minimums.items()]
    least = {k: F.lit(n) for k, (_, n) in minimums.items()}
    row = F.array(*[F.struct(F.lit(k).alias("invariant"), F.col(k).alias("n"), (F.col(k) >= least[k] if k in least else F.col(k) == 0).alias("holds")) for k in (*none, *minimums)])
    counted = dishes.agg(*counts).select(F.inline(row))
    core = [f.key for f in vocab.FACETS if f.group == "core"]
    options = facet_options.where(F.col("key").isin(*core)).select(F.concat_ws("=", "key", "value").alias("invariant"), "n", (F.col("n") > 0).alias("holds"))
    return counted.unionByName(options)


#: Facts that a page shows and no facet may ask for.
EXCLUDED_KEYS = ("water", "serves", "season")


def vocabulary_errors(dimension: DataFrame, fields: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``key``, ``value`` and ``error``: options that stand more than once (repeated) or lack a label (unlabelled), keys that no facet may have (excluded), and, given each key's values in ``fields``, values that only one side has (missing, unknown)."""
    counted = dimension.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce(F.trim("value_label"), F.lit(""))).alias("label"))
    errors = [
        counted.where("n > 1").withColumn("error", F.lit("repeated")),
        counted.where("label = ''").withColumn("error", F.lit("unlabelled")),
        counted.where(F.col("key").isin(*EXCLUDED_KEYS)).withColumn("error", F.lit("excluded")),
    ]
    if fields is not None:
        wanted = dimension.sparkSession.createDataFrame([(k, v) for k, values in fields.items() for v in values], "key string, value string")
        known = counted.where(F.col("key").isin(*fields))
        errors.append(wanted.join(known, ["key", "value"], "left_anti").withColumn("error", F.lit("missing")))
        errors.append(known.join(wanted, ["key", "value"], "left_anti").withColumn("error", F.lit("unknown")))
    return reduce(DataFrame.unionByName, (e.select("key", "value", "error") for e in errors))


def representatives(members: DataFrame, cluster: str, key: str, *best: Column) -> DataFrame:
    """``members`` with ``representative``: the ``key`` of its cluster's best row, by ``best`` in descending order, ties by the least key.

    The best of each cluster is a partial aggregate, so a cluster of any size is
    never gathered; the other members keep their rows, as its variations.  Rows
    of a null cluster represent themselves.
    """
    order = F.struct(*[b.alias(f"b{i}") for i, b in enumerate(best)])
    top = members.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.max(order).alias("_top"))
    own = members.withColumn("_order", order).join(top, cluster, "left")
    chosen = own.where(F.col("_order").eqNullSafe(F.col("_top"))).groupBy(cluster).agg(F.min(key).alias("representative"))
    return members.join(chosen, cluster, "left").withColumn("representative", F.coalesce("representative", key))


def shingles(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` lower-case words (of letters and digits) of a text, as hashes of 64 bits; null and shorter texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def runs(own: Column) -> Column:
        joined = F.transform(F.sequence(F.lit(1), F.size(own) - size + 1), lambda i: F.xxhash64(F.array_join(F.slice(own, i, size), " ")))
        return F.when(F.size(own) >= size, F.array_distinct(joined)).otherwise(F.array().cast("array<long>"))

    return let(words, runs)


#: A draft shares at most this part of its runs of words with its source.
OVERLAP_MOST = 0.2


def originality(drafts: DataFrame, sources: DataFrame, link: str, text: str = "text", size: int = 5, most: float = OVERLAP_MOST) -> DataFrame:
    """``drafts`` with ``overlap``, the share of its runs of ``size`` words that its source (the row of ``sources`` with the same ``link``) has too, and ``original``.

    Each draft meets the one source it was written from, so nothing is compared
    but what belongs together.  A draft without source or runs has overlap 0.
    ``sources`` must hold one row a link; null links have no source.
    """
    held = sources.select(F.col(link).alias("_link"), shingles(F.col(text), size).alias("_theirs"))
    met = drafts.withColumn("_own", shingles(F.col(text), size)).join(held, F.col(link) == F.col("_link"), "left")
    shared = F.size(F.array_intersect("_own", F.coalesce("_theirs", F.array().cast("array<long>"))))
    overlap = F.when(F.size("_own") > 0, shared / F.size("_own")).otherwise(F.lit(0.0))
    return met.withColumn("overlap", overlap).withColumn("original", F.col("overlap") <= most).drop("_own", "_link", "_theirs")


def relevance(text: Column, weights: Mapping[str, int]) -> Column:
    """Sum of the weights of the words' occurrences in ``text``."""
    total = F.lit(0)
    for word, weight in weights.items():
        total = total + F.coalesce(F.regexp_count(F.lower(text), F.lit(rf"\b{word}")), F.lit(0)) * weight
    return total.cast("long")
