import json
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from trailgrain.operators import nested, units

UNITS = units.EXTRA | {
    "gram": ("mass", Fraction(1000)), "kilogram": ("mass", Fraction(10**6)), "ounce": ("mass", Fraction(28350)), "pound": ("mass", Fraction(453600)), "german pound": ("mass", Fraction(500000)), "milliliter": ("volume", Fraction(1000)),
    "teaspoon": ("volume", Fraction(5000)), "tablespoon": ("volume", Fraction(15000)), "cup": ("volume", Fraction(240000)), "fluid ounce": ("volume", Fraction(30000)), "liter": ("volume", Fraction(10**6)), "kilocalorie": ("energy", Fraction(4184)),
    "kilojoule": ("energy", Fraction(1000)), "megajoule": ("energy", Fraction(10**6)), "second": ("duration", Fraction(1)), "minute": ("duration", Fraction(60)), "hour": ("duration", Fraction(3600)),
}


@pytest.mark.parametrize(
    "text, out",
    [
        ("3 x 4 oz chickpeas", ("mass", 340200)), ("3 (5 oz) packets", ("mass", 425250)), ("1 lb 2 oz bulgur", ("mass", 510300)), ("2 cups (= 263 g) tahini", ("volume", 480000)), ("1½ cups", ("volume", 360000)), ("干しぶどう小さじ1½", ("volume", 7500)),
        ("大さじ半", ("volume", 7500)), ("1-3 oz", ("mass", 56700)), ("1 to 3 fl oz", ("volume", 60000)), ("half a cup", ("volume", 120000)), ("a teaspoon split peas", ("volume", 5000)), ("~0,25 kg", ("mass", 250000)), ("½ Pfund Nüsse", ("mass", 250000)),
        ("3 Graham crackers", None), ("2 lait en poudre", None), ("a pinch of salt", None), ("", None), (None, None), ("x" * 100_000, None), ("0.25 oz", ("mass", 7088)),
    ],
)
def test_amounts(text, out):
    assert units.read_amount(text, UNITS) == out


@pytest.mark.parametrize("text, out", [("PT45M", 2700), ("P0DT1H5M", 3900), ("0:20 h", 1200), ("1 h 30 min", 5400), ("1.5 hours", 5400), ("90", None), (None, None), ({}, None)])
def test_durations(text, out):
    assert units.read_duration(text, UNITS) == (None if out is None else ("duration", out))


def test_neighbouring_units():
    assert units.read_amount("2", UNITS, unit_from=units.neighbour_unit("Red lentils, ml", None)) == ("volume", 2000)
    assert units.read_amount("2", UNITS, unit_from=units.neighbour_unit("Lentils", "amount in grams")) == ("mass", 2000)
    assert units.read_amount("2", UNITS, unit_from=units.neighbour_unit("Lentils", "the cheap kind")) is None
    assert units.read_quantity({"value": 487, "unitText": "kJ"}, UNITS, ("energy",)) == ("energy", 487000)


RECIPE = {
    "@type": "Recipe", "author": ["A", {"@type": "Person", "name": "B"}, None, " "], "recipeIngredient": "x\n\ny\r\nz", "review": {"author": "C", "reviewBody": "ok"},
    "recipeInstructions": ["first", {"@type": "HowToSection", "itemListElement": ["in", {"@type": "HowToSection", "itemListElement": {"@type": "HowToStep", "text": "deep"}}, None]}, "", {"@type": "HowToStep", "name": "last"}],
}


def test_children_and_links():
    rows = [r[:3] for r in nested.child_rows(RECIPE)]
    assert rows == [("author", -1, 0), ("author", -1, 1), ("ingredient", -1, 0), ("ingredient", -1, 1), ("ingredient", -1, 2), ("review", -1, 0), ("step", -1, 0), ("section", -1, 0), ("step", 0, 1), ("section", 0, 1), ("step", 1, 2), ("step", -1, 3)]


def test_labels_give_back_the_tree():
    labels = [r[3] for r in nested.child_rows(RECIPE)]
    assert labels == sorted(labels) and len(set(labels)) == len(labels)
    sections = [r[3] for r in nested.child_rows(RECIPE) if r[0] == "section"]
    assert sections[1][: len(sections[0])] == sections[0]


def test_flatten_odd_rows(spark):
    rows = [(1, [json.dumps(RECIPE), "{torn", None, "[]"], "x"), (2, None, "y"), (3, [], None), (1, [json.dumps(RECIPE)], "x")]
    df = spark.createDataFrame(rows, "page_id long, jsonld array<string>, child string")
    out = nested.flatten_recipes(df, text=True)
    assert out.count() == 24 and out.where("recipe_no <> 0").count() == 0
    assert out.where("child = 'step' and content = 'deep'").select("parent_no").distinct().collect()[0][0] == 1
    assert nested.flatten_recipes(df.where("false")).count() == 0


def test_page_and_dish_rows(spark, data):
    got = units.amounts(*(spark.read.parquet(f"{data}/{t}.parquet") for t in ("pages", "dishes", "units")))
    assert got.count() == got.distinct().count() > 0
    assert {r[0] for r in got.select("dimension").distinct().collect()} <= {"mass", "volume", "energy", "duration"}


def brute(values, penalty, least):
    n = len(values)
    best = [0.0] + [math.inf] * n
    for j in range(1, n + 1):
        for i in range(0, j - least + 1):
            part = values[i:j]
            best[j] = min(best[j], best[i] + float(((part - part.mean()) ** 2).sum()) + penalty * (i > 0))
    return best[n]


def test_changepoints_are_exact():
    rng = random.Random(3)
    for _ in range(30):
        values = np.array([rng.choice([5.0, 6.43]) + rng.gauss(0, 0.2) for _ in range(rng.randint(3, 40))])
        starts = units.changepoints(values, 0.5)
        parts = np.split(values, starts[1:])
        cost = sum(float(((p - p.mean()) ** 2).sum()) for p in parts) + 0.5 * (len(parts) - 1)
        assert cost == pytest.approx(brute(values, 0.5, 3), abs=1e-9)


def test_unit_shift_is_reversed(spark):
    rng = random.Random(1)
    rows = [(i, "s", i, (400 + rng.random() * 100) * (4.184 if 40 <= i < 80 else 1)) for i in range(120)] + [(200, "s", 200, None), (201, None, 201, 5.0), (202, "t", 0, 400.0)]
    out = units.unit_shifts(spark.createDataFrame(rows, "k int, src string, o int, v double"), "src", "o", "v", "k", 4.184).collect()
    shifted = {r["k"] for r in out if r["unit_factor"] > 1}
    assert shifted == set(range(40, 80)) and len(out) == 121 and all(300 < r["restored"] < 600 for r in out)


def test_changepoints_are_exact_at_the_shortest_lengths():
    rng = random.Random(8)
    for least in (2, 3, 5):
        for _ in range(60):
            values = np.array([rng.choice([0.0, 1.0, 3.0]) + rng.gauss(0, 0.3) for _ in range(rng.randint(least, 60))])
            starts = units.changepoints(values, 0.2, least)
            parts = np.split(values, starts[1:])
            assert starts[0] == 0 and min(map(len, parts)) >= least
            assert sum(float(((p - p.mean()) ** 2).sum()) for p in parts) + 0.2 * (len(parts) - 1) == pytest.approx(brute(values, 0.2, least), abs=1e-9)


def test_shifts_of_a_long_history_are_measured_against_its_lowest_level(spark):
    rng = random.Random(2)
    n = 7000  # the other unit lasts from 1500 to 6200, longer than any piece a history was once cut into
    rows = [(i, 0, "s", i, (400 + rng.random() * 100) * (4.184 if 1500 <= i < 6200 else 1)) for i in range(n)]
    out = units.unit_shifts(spark.createDataFrame(rows, "k int, no int, src string, o int, v double"), "src", "o", "v", ("k", "no"), 4.184).collect()
    assert len(out) == n and {r["k"] for r in out if r["unit_factor"] > 1} == set(range(1500, 6200))
    assert all(300 < r["restored"] < 600 for r in out) and len({r["segment"] for r in out}) == 3


def test_every_recipe_of_a_page_gives_its_energy(spark):
    pages = spark.createDataFrame([("p", "d", 1, ['{"nutrition":{"calories":"400"}}', "{", '{"nutrition":{"calories":500}}', '{"nutrition":{"calories":"9 kcal"}}'])], "page_id string, domain string, fetched_at int, jsonld array<string>")
    assert {(r["page_id"], r["recipe_no"], r["value"]) for r in units.bare_energies(pages).collect()} == {("p", 0, 400.0), ("p", 2, 500.0)}
