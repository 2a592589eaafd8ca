import pytest
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.operators import facets, ordering, quality, search
from trailgrain.plans.state import FilterState


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value, name", [(99, "low"), (100, "mid"), (124, "mid"), (125, "high"), (None, None)])
def test_bucket(spark, value, name):
    assert one(spark, lambda v: facets.bucket(v, [100, 125], ["low", "mid", "high"]), value, "int") == name


def test_bucket_arity():
    with pytest.raises(ValueError):
        facets.bucket(F.lit(1), [1], ["a", "b", "c"])


def dish(spark, **fields):
    row = {"id": "a", "title": "Test Meal", "blurb": "b", "tripstyle": ["backpacking"], "slot": ["dinner"], "heatsource": ["canister-stove"], "prepminutes": 2, "cookminutes": 8, "caloriesperserving": 700, "ouncesperserving": 6.0, "proteingrams": 20, "cleanup": "one-pot", "dietary": ["vegetarian"], "homeprep": "premix", "shelflife": "shelf-stable", "skill": "dump-and-stir", "cost": "$$", "draft": False, "ingredients": [("Ramen", "1 block", None)], "updated": None} | fields
    schema = "id string, title string, blurb string, tripstyle array<string>, slot array<string>, heatsource array<string>, prepminutes int, cookminutes int, caloriesperserving int, ouncesperserving double, proteingrams int, cleanup string, dietary array<string>, homeprep string, shelflife string, skill string, cost string, draft boolean, ingredients array<struct<item:string,amount:string,note:string>>, updated timestamp_ntz"
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize("cal, oz, ratio", [(700, 6.0, 117), (500, 4.0, 125), (249, 2.0, 125), (700, 0.0, None), (None, 4.0, None)])
def test_derive(spark, cal, oz, ratio):
    r = facets.derive(dish(spark, caloriesperserving=cal, ouncesperserving=oz)).first()
    assert (r["cal_oz"], r["total_minutes"]) == (ratio, 10)
    assert r["cal_oz_bucket"] == (None if ratio is None else "125plus" if ratio >= 125 else "100-125")


@pytest.mark.parametrize(
    "selected, expected",
    [({"slot": ["breakfast", "dinner"]}, True), ({"slot": ["lunch"]}, False), ({"slot": ["dinner"], "heat": ["no-cook"]}, False), ({"slot": [], "heat": []}, True), ({}, True), ({"unknown": ["x"]}, False)],
)
def test_matches(spark, selected, expected):
    df = facets.derive(dish(spark))
    assert df.where(facets.matches(facets.facet_columns(df), selected)).count() == int(expected)


def test_full_selection_constrains_only_literally(spark):
    df = facets.derive(dish(spark, dietary=None))
    full = {"diet": vocab.ALL_VALUES["diet"]}
    assert df.where(facets.matches(facets.facet_columns(df), full)).count() == 0
    assert FilterState(full).filtered(dish(spark, dietary=None)).count() == 1


@pytest.mark.parametrize("q, hit", [("tomato couscous", True), ("couscous salmon", False), ("  ", True), ("", True)])
def test_search(spark, q, hit):
    hay = "couscous bowl olive oil sun dried tomato"
    assert one(spark, lambda v: search.matches_search(v, q), hay, "string") is hit
    assert one(spark, lambda v: search.matches_search(F.lit(hay), v), q, "string") is hit


@pytest.mark.parametrize(
    "text, q, ranges",
    [("Cold Soak Couscous with Sun-Dried Tomato", "soak", [(5, 9)]), ("Cold Soak Couscous with Sun-Dried Tomato", "co", [(0, 2), (10, 12), (14, 16)]), ("couscous", "cous couscous", [(0, 8)]), ("ababa", "aba", [(0, 5)]), ("ab", "a b", [(0, 2)]), ("x", " ", []), ("x", "salmon", []), ("", "a", [])],
)
def test_ranges_and_highlight(spark, text, q, ranges):
    got = one(spark, lambda v: search.match_ranges(v, q), text, "string")
    assert [(r["start"], r["end"]) for r in got] == ranges
    segments = one(spark, lambda v: search.highlight(v, q), text, "string")
    assert "".join(s["text"] for s in segments) == text
    assert [s["text"] for s in segments if s["hit"]] == [text[a:b] for a, b in ranges]


def test_marks_escape_markup(spark):
    assert one(spark, lambda v: search.marked(v, "rice"), "rice <b>", "string") == "<mark>rice</mark> &lt;b&gt;"


def test_null_text_has_no_ranges(spark):
    assert one(spark, lambda v: search.match_ranges(v, "a"), None, "string") is None


def test_activity_and_codec():
    slots = vocab.ALL_VALUES["slot"]
    assert [facets.active(s, slots) for s in (slots, [], None, ["dinner"])] == [False, False, False, True]
    assert FilterState({"slot": slots, "heat": ["no-cook"]}).encode() == "?heat=no-cook"
    assert FilterState({"slot": []}).encode() == "" and FilterState({"slot": ["breakfast", "dinner"]}).encode() == "?slot=breakfast%2Cdinner"
    assert FilterState({"slot": ["lunch"]}).encode(everything={}) == ""
    state = FilterState({"slot": ["lunch"], "heat": ["no-cook"], "diet": ["vegan"]}, "weight", "ramen")
    back = FilterState.decode(state.encode())
    assert (back.sort, back.query) == ("weight", "ramen") and all(back.selected[k] == v for k, v in state.selected.items())
    assert FilterState.decode("?slot=nonsense").selected["slot"] == slots
    assert FilterState.all().is_empty() and FilterState.none().is_empty() and not FilterState({}, query="x").is_empty()


def test_sort_modes(spark):
    a, b, c = dish(spark, id="a", title="Alpha", caloriesperserving=600, cookminutes=18), dish(spark, id="b", title="Beta", caloriesperserving=800, ouncesperserving=5.0, cookminutes=3), dish(spark, id="c", title=None, caloriesperserving=None)
    df = facets.derive(a.union(b).union(c))
    for mode, first in {"cal-oz": "b", "weight": "b", "time": "b", "calories": "b", "title": "a", "bogus": "b"}.items():
        ids = [r["id"] for r in df.orderBy(*ordering.sort_columns(mode)).collect()]
        assert ids[0] == first and (mode == "weight" or mode == "time" or ids[-1] == "c")


def test_positions_are_global(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k").repartition(8)
    got = ordering.with_position(df, [F.col("k").asc(), F.col("id").asc()]).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["position"])] == sorted(range(1000), key=lambda i: (i % 7, i))
    assert ordering.with_position(df.where("id < 0"), [F.col("id").asc()]).count() == 0


def test_facet_counts_have_zeros_and_count_a_row_once(spark):
    df = facets.derive(dish(spark, slot=["dinner", "dinner", None]))
    counts = {(r["key"], r["value"]): r["n"] for r in facets.facet_counts(df).collect()}
    assert counts["slot", "dinner"] == 1 and counts["slot", "lunch"] == 0 and len(counts) == sum(len(f.options) for f in vocab.FACETS)


def test_validation_splits(spark):
    df = dish(spark).union(dish(spark, id="b", title=None))
    rules = {k: r for k, r in quality.record_rules().items() if k in ("title", "slot", "ingredients")}
    good, bad = quality.validate(df, rules)
    assert [r["id"] for r in good.collect()] == ["a"] and [r["violations"] for r in bad.collect()] == [["title"]]
