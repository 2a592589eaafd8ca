"""Facet and sort vocabularies.  Fixed values: keys, options, labels and their order are part of the query language."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Facet:
    key: str
    label: str
    group: str
    options: tuple[tuple[str, str], ...]

    @property
    def values(self) -> list[str]:
        return [v for v, _ in self.options]


FACETS = (
    Facet(
        "style",
        "Trip style",
        "core",
        (
            ("car-camping", "Car camping"),
            ("backpacking", "Backpacking"),
            ("thru-hike", "Thru-hike"),
            ("bikepacking", "Bikepacking"),
            ("basecamp", "Basecamp"),
            ("day-hike", "Day hike"),
            ("winter", "Winter / snow"),
            ("paddle", "Canoe / raft"),
        ),
    ),
    Facet(
        "slot",
        "Time of day",
        "core",
        (
            ("breakfast", "Breakfast"),
            ("lunch", "Lunch"),
            ("dinner", "Dinner"),
            ("snack", "Snack"),
            ("dessert", "Dessert"),
            ("drink", "Drink"),
        ),
    ),
    Facet(
        "heat",
        "What you cook on",
        "core",
        (
            ("no-cook", "No cook"),
            ("cold-soak", "Cold soak"),
            ("canister-stove", "Canister stove"),
            ("alcohol-esbit", "Alcohol / Esbit"),
            ("liquid-fuel", "Liquid fuel"),
            ("campfire", "Campfire coals"),
            ("grill-grate", "Grill grate"),
            ("dutch-oven", "Dutch oven"),
            ("cooler-only", "Cooler only"),
        ),
    ),
    Facet(
        "time",
        "Total time",
        "more",
        (
            ("lt5", "Under 5 min"),
            ("5-15", "5 to 15 min"),
            ("15-30", "15 to 30 min"),
            ("30plus", "30 min or more"),
        ),
    ),
    Facet(
        "caloz",
        "Calories per ounce",
        "more",
        (
            ("lt100", "Under 100"),
            ("100-125", "100 to 125"),
            ("125plus", "125 and up"),
        ),
    ),
    Facet(
        "cal",
        "Calories per serving",
        "more",
        (
            ("lt400", "Under 400"),
            ("400-700", "400 to 700"),
            ("700plus", "700 and up"),
        ),
    ),
    Facet(
        "protein",
        "Protein per serving",
        "more",
        (
            ("lt10", "Under 10 g"),
            ("10-20", "10 to 20 g"),
            ("20plus", "20 g and up"),
        ),
    ),
    Facet(
        "cleanup",
        "Cleanup",
        "more",
        (
            ("in-bag", "Eat in the bag"),
            ("one-pot", "One pot"),
            ("foil-packet", "Foil packet"),
            ("dishes", "Real dishes"),
        ),
    ),
    Facet(
        "diet",
        "Dietary",
        "more",
        (
            ("vegetarian", "Vegetarian"),
            ("vegan", "Vegan"),
            ("gluten-free", "Gluten free"),
            ("dairy-free", "Dairy free"),
            ("nut-free", "Nut free"),
        ),
    ),
    Facet(
        "prep",
        "Home prep",
        "more",
        (
            ("grab-and-go", "Grab and go"),
            ("premix", "Pre-mix at home"),
            ("dehydrate", "Dehydrate ahead"),
        ),
    ),
    Facet(
        "shelf",
        "Keeps for",
        "more",
        (
            ("shelf-stable", "Shelf stable"),
            ("cooler", "Needs a cooler"),
            ("day-one", "Day one only"),
        ),
    ),
    Facet(
        "skill",
        "Effort",
        "more",
        (
            ("dump-and-stir", "Dump and stir"),
            ("basic", "Basic"),
            ("cooking", "Actual cooking"),
        ),
    ),
    Facet(
        "cost",
        "Cost per serving",
        "more",
        (
            ("$", "$"),
            ("$$", "$$"),
            ("$$$", "$$$"),
        ),
    ),
)
FACET_KEYS = [f.key for f in FACETS]
ALL_VALUES = {f.key: f.values for f in FACETS}
WATER = ("none", "cold", "boiled")
SORTS = {"cal-oz": "Calories per ounce", "weight": "Lightest first", "time": "Fastest first", "calories": "Most calories", "title": "A to Z"}
DEFAULT_SORT = "cal-oz"

# Edges and names of the derived buckets.
TIME_EDGES, TIME_NAMES = [5, 15, 30], ["lt5", "5-15", "15-30", "30plus"]
CAL_OZ_EDGES, CAL_OZ_NAMES = [100, 125], ["lt100", "100-125", "125plus"]
CALORIE_EDGES, CALORIE_NAMES = [400, 700], ["lt400", "400-700", "700plus"]
PROTEIN_EDGES, PROTEIN_NAMES = [10, 20], ["lt10", "10-20", "20plus"]


def facet_label(key: str, value: str) -> str:
    """The label of an option, or the value itself."""
    return next((dict(f.options).get(value, value) for f in FACETS if f.key == key), value)


def dimension(spark: SparkSession, facets: tuple[Facet, ...] = FACETS) -> DataFrame:
    """One row an option: (key, key_pos, facet_label, facet_group, value, value_pos, value_label); as small as the vocabulary."""
    rows = [(f.key, i, f.label, f.group, v, j, label) for i, f in enumerate(facets) for j, (v, label) in enumerate(f.options)]
    return spark.createDataFrame(rows, "key string, key_pos int, facet_label string, facet_group string, value string, value_pos int, value_label string")
