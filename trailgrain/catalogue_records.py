"""Queries of the faceted collection's records: labels, cards, pages, validation, routing, nutrition, originality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import urls, vocab
from trailgrain.operators import facets, nutrition, quality
from trailgrain.plans.state import FilterState
from trailgrain.registry import query, table, values
from trailgrain.sources import readers, writers
from trailgrain.sqltext import CANONICAL, DERIVED

_MANY = ("tripstyle", "slot", "heatsource", "dietary")
_OPTIONS = values([(f.key, v, label) for f in vocab.FACETS for v, label in f.options], "key, value, value_label")


def _quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# ---- labels, cards, pages


@query(
    f"WITH d AS ({DERIVED}), e AS ("
    + " UNION ALL ".join(f"SELECT id, updated, '{k}' AS key, {f'unnest({c})' if c in _MANY else c} AS value FROM d" for k, c in facets.FACET_COLUMNS.items())
    + f") SELECT e.id, e.updated, e.key, e.value, coalesce(t.value_label, e.value) AS value_label FROM e LEFT JOIN {_OPTIONS} USING (key, value) WHERE e.value IS NOT NULL"
)
def facet_label(spark, sf):
    """Every value of every facet of every record, and its label."""
    df = facets.derive(table(spark, sf, "dishes"))

    def keyed(key: str, own: Column) -> Column:
        return F.transform(own, lambda v: F.struct(F.lit(key).alias("key"), v.alias("value")))

    pairs = F.flatten(F.array(*[keyed(k, own) for k, own in facets.facet_columns(df).items()]))
    exploded = df.select("id", "updated", F.explode(pairs).alias("p")).select("id", "updated", "p.key", "p.value").where("value is not null")
    return facets.labelled(exploded.withColumnsRenamed({"key": "facet"}), "facet", "value").select("id", "updated", F.col("facet").alias("key"), "value", "value_label")


def _card_sql() -> str:
    parts = [f"array_to_string(coalesce({c}, []), '|') AS facet_{k}" if c in _MANY else f"coalesce({c}, '') AS facet_{k}" for k, c in facets.FACET_COLUMNS.items()]
    return ", ".join(parts)


@query(f"SELECT id, updated, {_card_sql()}, hay AS search_text, cal_oz, ouncesperserving, total_minutes, caloriesperserving, lower(title) AS title_key FROM ({DERIVED})")
def card_attributes(spark, sf):
    return writers.cards(table(spark, sf, "dishes"))


@query("SELECT id, updated, list_filter(coalesce(slot, []), lambda x: x <> '') AS facet_slot, list_filter(coalesce(dietary, []), lambda x: x <> '') AS facet_diet, list_filter([cost], lambda x: x IS NOT NULL AND x <> '') AS facet_cost, CAST(caloriesperserving AS DOUBLE) AS caloriesperserving, ouncesperserving FROM dishes")
def cards_to_rows(spark, sf):
    """Cards read back: arrays without empty values, numbers as doubles."""
    cards = writers.cards(table(spark, sf, "dishes")).withColumn("caloriesperserving", F.col("caloriesperserving").cast("string"))
    return readers.cards_to_rows(cards, ["facet_slot", "facet_diet", "facet_cost"], ["caloriesperserving"]).select("id", "updated", "facet_slot", "facet_diet", "facet_cost", "caloriesperserving", "ouncesperserving")


_OUNCES = "CASE WHEN ouncesperserving = floor(ouncesperserving) THEN CAST(CAST(ouncesperserving AS BIGINT) AS VARCHAR) ELSE format('{:.1f}', ouncesperserving) END"
_STATS = f"""CAST(caloriesperserving AS VARCHAR) AS calories, {_OUNCES} || ' oz' AS weight, CAST(cal_oz AS VARCHAR) AS cal_oz_text, proteingrams || ' g' AS protein, servings || CASE WHEN coalesce(scalable, true) THEN ', scales' ELSE '' END AS serves,
 prepminutes || ' min' AS prep, cookminutes || ' min' AS cook, total_minutes || ' min' AS total_time, CASE WHEN water IS NULL OR water = 'none' THEN 'none' ELSE coalesce(waterml, 0) || ' ml ' || water END AS water_text, cost AS cost_text"""


@query(f"SELECT id, updated, {_STATS} FROM ({DERIVED.replace('/ ouncesperserving', '/ ouncesperserving')})")
def stat_texts(spark, sf):
    return writers.stats(table(spark, sf, "dishes"))


def _pills_sql() -> str:
    out = []
    for key in writers.PILLS:
        column = facets.FACET_COLUMNS[key]
        own = f"coalesce({column}, [])" if column in _MANY else f"list_filter([{column}], lambda x: x IS NOT NULL)"
        names = "CASE x " + " ".join(f"WHEN '{v}' THEN '{label}'" for v, label in next(f.options for f in vocab.FACETS if f.key == key)) + " ELSE x END"
        out.append(f"CASE WHEN len({own}) > 0 THEN '{key}: ' || array_to_string(list_transform({own}, lambda x: {names}), ', ') END")
    return f"concat_ws('; ', {', '.join(out)})"


@query(f"SELECT id, updated, {_pills_sql()} AS pills, len(ingredients) AS n_ingredients, len(steps) AS n_steps, packing FROM ({DERIVED})")
def detail_groups(spark, sf):
    page = writers.detail(table(spark, sf, "dishes"))
    pills = F.array_join(F.transform("groups", lambda g: F.concat(g["name"], F.lit(": "), F.array_join(g["values"], ", "))), "; ")
    return page.select("id", "updated", pills.alias("pills"), F.size("ingredients").cast("long").alias("n_ingredients"), F.size("steps").cast("long").alias("n_steps"), "packing")


@query(f"SELECT count(*) AS n, count(*) || CASE WHEN count(*) = 1 THEN ' meal' ELSE ' meals' END AS label, count(*) = 0 AS is_empty, '2' AS badge, false AS badge_hidden FROM ({DERIVED}) WHERE NOT coalesce(draft, false) AND list_has_any(coalesce(slot, []), ['dinner']) AND skill = 'basic'")
def visible_summary(spark, sf):
    state = FilterState({"slot": ["dinner"], "skill": ["basic"]})
    return writers.summary(state.filtered(table(spark, sf, "dishes")), facets.active_count(state.selected))


@query("SELECT id AS slug, updated, title, len(steps) AS n_steps FROM dishes WHERE NOT coalesce(draft, false)")
def routes(spark, sf):
    return writers.routes(table(spark, sf, "dishes")).select("slug", "record.updated", "record.title", F.size("record.steps").cast("long").alias("n_steps"))


@query("SELECT id, title, slot, prepminutes, ouncesperserving, coalesce(scalable, true) AS scalable, coalesce(waterml, 0) AS waterml, list_transform(ingredients, lambda i: i.item) AS items FROM dishes WHERE title IS NOT NULL AND prepminutes IS NOT NULL AND ouncesperserving IS NOT NULL AND len(slot) > 0 AND len(ingredients) > 0")
def frontmatter_records(spark, sf):
    """Records written as markdown with frontmatter, read back."""
    dishes = table(spark, sf, "dishes").where("title is not null and prepminutes is not null and ouncesperserving is not null and size(slot) > 0 and size(ingredients) > 0")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\n")), F.lit(""))

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('\\"')), F.lit('"'))

    items = F.concat(F.lit("ingredients:\n"), F.array_join(F.transform("ingredients", lambda i: F.concat(F.lit("  - item: "), quoted(i["item"]), F.lit("\n    amount: "), quoted(F.coalesce(i["amount"], F.lit(""))))), "\n"), F.lit("\n"))
    body = [line("title", quoted(F.col("title"))), line("slot", F.concat(F.lit("["), F.array_join("slot", ", "), F.lit("]"))), line("prepMinutes", F.col("prepminutes")), F.lit("# a remark\n\n"), line("ouncesPerServing", F.col("ouncesperserving")), line("scalable", F.col("scalable")), line("waterMl", F.col("waterml")), items]
    raw = F.concat(F.lit("---\n"), *body, F.lit("---\nStir.\n"))
    parsed = readers.parse_records(dishes.select("id", raw.alias("raw")), "id", "raw")
    return parsed.select("id", "title", "slot", "prepminutes", "ouncesperserving", "scalable", "waterml", F.col("ingredients.item").alias("items"))


@query("SELECT position, CASE WHEN position = 0 THEN '[' ELSE '' END || line || CASE WHEN position = n - 1 THEN ']' ELSE ',' END AS line FROM (SELECT row_number() OVER (ORDER BY id) - 1 AS position, count(*) OVER () AS n, to_json({'id': id, 'sourcetype': sourcetype, 'region': region, 'lexicon': lexicon}) AS line FROM cells)")
def json_array(spark, sf):
    return writers.json_array(table(spark, sf, "cells").select("id", "sourcetype", "region", "lexicon"), [F.col("id").asc()])


# ---- validation and routing


def _all_in(column: str, key: str) -> str:
    return f"len({column}) >= 1 AND list_bool_and(list_transform({column}, lambda x: list_contains({_quoted(vocab.ALL_VALUES[key])}, x)))"


def _in(column: str, words) -> str:
    return f"list_contains({_quoted(words)}, {column})"


_RECORD_SQL = (
    {"title": "title IS NOT NULL", "blurb": "blurb IS NOT NULL", "tripstyle": _all_in("tripstyle", "style"), "slot": _all_in("slot", "slot"), "heatsource": _all_in("heatsource", "heat")}
    | {c: f"{c} >= 0" for c in ("prepminutes", "cookminutes", "proteingrams")}
    | {c: f"{c} > 0" for c in ("caloriesperserving", "ouncesperserving", "servings")}
    | {"waterml": "coalesce(waterml, 0) >= 0", "dietary": f"dietary IS NULL OR len(list_filter(dietary, lambda x: NOT list_contains({_quoted(vocab.ALL_VALUES['diet'])}, x))) = 0", "water": _in("water", vocab.WATER)}
    | {c: _in(c, vocab.ALL_VALUES[k]) for c, k in (("cleanup", "cleanup"), ("homeprep", "prep"), ("shelflife", "shelf"), ("skill", "skill"), ("cost", "cost"))}
    | {"ingredients": "len(ingredients) >= 1", "steps": "len(steps) >= 1"}
)
_PLANT = r"(?i)\b(?:coconut|oat|soy|soya|almond|rice|peanut|nut|cashew|cocoa|shea|vegan) (?:milk|cream|butter|cheese|yogurt|egg)"
_CONSISTENT_SQL = {
    "cold-soak-unboiled": "NOT list_contains(heatsource, 'cold-soak') OR water <> 'boiled'",
    "no-cook-unboiled": "NOT list_contains(heatsource, 'no-cook') OR water <> 'boiled'",
    "no-cook-no-minutes": "NOT list_contains(heatsource, 'no-cook') OR cookminutes = 0",
    "vegan-vegetarian": "NOT list_contains(dietary, 'vegan') OR list_contains(dietary, 'vegetarian')",
    "vegan-no-animal-items": rf"NOT list_contains(dietary, 'vegan') OR len(list_filter(ingredients, lambda i: coalesce(regexp_matches(regexp_replace(i.item, '{_PLANT}', '', 'g'), '(?i)(^|[^\p{{L}}])({quality.ANIMAL})($|[^\p{{L}}])'), false))) = 0",
    "no-dutch-oven-thru-hike": "NOT (list_contains(heatsource, 'dutch-oven') AND list_contains(tripstyle, 'thru-hike'))",
    "no-cooler-thru-hike": "NOT (shelflife = 'cooler' AND list_contains(tripstyle, 'thru-hike'))",
}
_PLAUSIBLE_SQL = {
    "cal-oz-bounds": "cal_oz BETWEEN 40 AND 190",
    "protein-bound": "proteingrams <= 60",
    "servings-bounds": "servings BETWEEN 1 AND 24",
    "minutes-unless-no-cook": "total_minutes > 0 OR list_contains(heatsource, 'no-cook')",
}


def _broken_sql(rules: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in rules.items()) + ")"


@query(f"SELECT id, updated, {_broken_sql(_RECORD_SQL)} AS broken FROM dishes")
def validate_rules(spark, sf):
    checked = quality.violations(table(spark, sf, "dishes"), quality.record_rules())
    return checked.select("id", "updated", F.array_join("violations", ",").alias("broken"))


@query(f"SELECT id, updated, reasons, CASE WHEN reasons <> '' THEN 'quarantine' ELSE 'content/' || coalesce(nullif(regexp_extract(lower(id), '^[a-z0-9]'), ''), 'other') END AS place FROM (SELECT id, updated, {_broken_sql(_RECORD_SQL | _CONSISTENT_SQL | _PLAUSIBLE_SQL)} AS reasons FROM ({DERIVED}))")
def qa_route(spark, sf):
    """The gate: schema, consistency and plausibility rules; what passes goes to its letter, what fails to quarantine with its reasons."""
    rules = quality.record_rules() | quality.consistency_rules() | quality.plausibility_rules()
    routed = quality.route(facets.derive(table(spark, sf, "dishes")), rules)
    return routed.select("id", "updated", F.array_join("reasons", ",").alias("reasons"), "place")


_FIELDS = {k: vocab.ALL_VALUES[k] for k in ("style", "slot", "heat", "cleanup", "diet", "prep", "shelf", "skill")} | {"cost": [*vocab.ALL_VALUES["cost"], "free"]}


@query(
    f"""WITH dim AS (SELECT key, value, value_label AS label FROM {_OPTIONS} UNION ALL SELECT CASE sourcetype WHEN 'forum' THEN 'season' ELSE 'skill' END, lexicon, CASE WHEN region LIKE '%a%' THEN ' ' ELSE region END FROM cells),
 g AS (SELECT key, value, count(*) AS n, min(coalesce(trim(label), '')) AS label FROM dim GROUP BY key, value), f AS (SELECT * FROM {values([(k, v) for k, own in _FIELDS.items() for v in own], 'key, value')})
 SELECT key, value, 'repeated' AS error FROM g WHERE n > 1 UNION ALL SELECT key, value, 'unlabelled' FROM g WHERE label = '' UNION ALL SELECT key, value, 'excluded' FROM g WHERE key IN ('water', 'serves', 'season')
 UNION ALL SELECT key, value, 'missing' FROM f WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.key = f.key AND g.value = f.value) UNION ALL SELECT key, value, 'unknown' FROM g WHERE key IN (SELECT key FROM f) AND NOT EXISTS (SELECT 1 FROM f WHERE f.key = g.key AND f.value = g.value)"""
)
def vocabulary_errors(spark, sf):
    """A vocabulary with the cells' words added, of which none belongs in it, held against the fields."""
    cells = table(spark, sf, "cells").select(F.when(F.col("sourcetype") == "forum", "season").otherwise("skill").alias("key"), F.col("lexicon").alias("value"), F.when(F.col("region").contains("a"), " ").otherwise(F.col("region")).alias("value_label"))
    return quality.vocabulary_errors(vocab.dimension(spark).select("key", "value", "value_label").unionByName(cells), _FIELDS)


# Conditions of a collection that covers what people ask for, and the least number of records.
_MINIMUMS = [
    ("no-cook", "heatsource", ["no-cook"], 3),
    ("cold-soak", "heatsource", ["cold-soak"], 2),
    ("vegetarian", "dietary", ["vegetarian"], 3),
    ("vegan", "dietary", ["vegan"], 2),
    ("breakfast", "slot", ["breakfast"], 3),
    ("dessert", "slot", ["dessert"], 2),
    ("drink", "slot", ["drink"], 2),
]
_FIRE = "list_contains(tripstyle, 'car-camping') AND list_has_any(coalesce(heatsource, []), ['dutch-oven', 'campfire'])"


@query(
    f"WITH d AS (SELECT * FROM ({DERIVED}) WHERE NOT coalesce(draft, false)), o AS (SELECT t.key, t.value FROM {_OPTIONS} WHERE t.key IN ('style', 'slot', 'heat')) "
    + " UNION ALL ".join(
        [
            "SELECT 'cal-oz-sane' AS invariant, count(*) FILTER (WHERE NOT coalesce(cal_oz > 30 AND cal_oz < 230, false)) AS n, count(*) FILTER (WHERE NOT coalesce(cal_oz > 30 AND cal_oz < 230, false)) = 0 AS holds FROM d",
            "SELECT 'no-cook-unboiled', count(*) FILTER (WHERE list_contains(heatsource, 'no-cook') AND coalesce(water = 'boiled', false)), count(*) FILTER (WHERE list_contains(heatsource, 'no-cook') AND coalesce(water = 'boiled', false)) = 0 FROM d",
            "SELECT 'vegan-vegetarian', count(*) FILTER (WHERE list_contains(dietary, 'vegan') AND NOT list_contains(dietary, 'vegetarian')), count(*) FILTER (WHERE list_contains(dietary, 'vegan') AND NOT list_contains(dietary, 'vegetarian')) = 0 FROM d",
            *[f"SELECT '{name}', count(*) FILTER (WHERE list_has_any(coalesce({c}, []), {_quoted(v)})), count(*) FILTER (WHERE list_has_any(coalesce({c}, []), {_quoted(v)})) >= {n} FROM d" for name, c, v, n in _MINIMUMS],
            f"SELECT 'car-camping-fire', count(*) FILTER (WHERE {_FIRE}), count(*) FILTER (WHERE {_FIRE}) >= 2 FROM d",
            "SELECT o.key || '=' || o.value, count(d.id), count(d.id) > 0 FROM o LEFT JOIN d ON list_contains(CASE o.key WHEN 'style' THEN d.tripstyle WHEN 'slot' THEN d.slot ELSE d.heatsource END, o.value) GROUP BY o.key, o.value",
        ]
    )
)
def content_invariants(spark, sf):
    live = facets.derive(facets.not_draft(table(spark, sf, "dishes")))
    own = facets.facet_columns(live)
    minimums = {name: (F.arrays_overlap(F.coalesce(c, F.array().cast("array<string>")), F.array(*map(F.lit, v))), n) for name, c, v, n in _MINIMUMS}
    minimums["car-camping-fire"] = (facets.matches(own, {"style": ["car-camping"], "heat": ["dutch-oven", "campfire"]}), 2)
    return quality.content_invariants(live, facets.facet_counts(live), minimums)


@query("SELECT id, updated, first(id || '/' || coalesce(CAST(epoch_us(updated) AS VARCHAR), '')) OVER (PARTITION BY id ORDER BY source IS NOT NULL DESC, updated DESC NULLS LAST, id || '/' || coalesce(CAST(epoch_us(updated) AS VARCHAR), '')) AS representative FROM dishes WHERE id IS NOT NULL")
def cluster_representatives(spark, sf):
    """Records of one id are a cluster; one with a source, then the latest, stands for it."""
    ref = F.concat("id", F.lit("/"), F.coalesce(F.unix_micros(F.col("updated").cast("timestamp")).cast("string"), F.lit("")))
    members = table(spark, sf, "dishes").where("id is not null").withColumn("ref", ref)
    return quality.representatives(members, "id", "ref", F.col("source").isNotNull(), F.coalesce(F.unix_micros(F.col("updated").cast("timestamp")), F.lit(-1))).select("id", "updated", "representative")


# ---- nutrition

# A table of foods by rule: from the length and first letter of an item's name.  Every seventh length is left out, so that some items have none.
_GRAMS = {"g": 1.0, "kg": 1000.0, "oz": 28.349523125, "ml": 1.0, "l": 1000.0}
_ITEM_SQL = r"trim(regexp_replace(regexp_replace(lower(item), '\s*[(\[].*$|\s*,.*$', ''), '\s+', ' ', 'g'))"


def _foods(items: DataFrame) -> DataFrame:
    food = items.select(nutrition.item_key(F.col("item")).alias("food")).distinct().where(F.length("food") % 7 != 0)
    n = F.length("food")
    protein, carb, fat = (n % 11).cast("double"), (n % 13 + 20).cast("double"), (n % 17).cast("double")
    return food.select("food", (protein * 4 + carb * 4 + fat * 9 + n * 3).alias("kcal"), protein.alias("protein"), carb.alias("carb"), fat.alias("fat"))


@query(
    rf"""WITH i AS (SELECT id, updated, servings, {_ITEM_SQL} AS food, CAST(nullif(regexp_extract(amount, '^(\d+(?:\.\d+)?) ?(g|kg|oz|ml|l)$', 1), '') AS DOUBLE) * CASE regexp_extract(amount, '^(\d+(?:\.\d+)?) ?(g|kg|oz|ml|l)$', 2) {" ".join(f"WHEN '{u}' THEN {f}" for u, f in _GRAMS.items())} END AS grams
 FROM (SELECT id, updated, servings, unnest(ingredients, recursive := true) FROM dishes WHERE updated IS NOT NULL)),
 f AS (SELECT *, length(food) % 7 <> 0 AND grams IS NOT NULL AS matched, length(food) % 11 AS p, length(food) % 13 + 20 AS c, length(food) % 17 AS t FROM i),
 s AS (SELECT id, updated, max(CASE WHEN servings > 0 THEN servings END) AS sv, sum(CASE WHEN matched THEN (p * 4 + c * 4 + t * 9 + length(food) * 3) * grams / 100 ELSE 100.0 END) AS kcal, coalesce(sum(CASE WHEN matched THEN p * grams / 100 END), 0.0) AS protein, coalesce(sum(CASE WHEN matched THEN c * grams / 100 END), 0.0) AS carb, coalesce(sum(CASE WHEN matched THEN t * grams / 100 END), 0.0) AS fat,
 coalesce(sum(CASE WHEN food <> 'coconut milk' THEN grams END), 0.0) AS g, count(*) FILTER (WHERE NOT coalesce(matched, false)) AS unmatched FROM f GROUP BY id, updated)
 SELECT id, updated, CAST(round(kcal / sv) AS BIGINT) AS kcal, CAST(round(protein / sv) AS BIGINT) AS protein, CAST(round(g / 28.349523125 / sv) AS BIGINT) AS dry_ounces, unmatched, coalesce(abs(kcal - (protein * 4 + carb * 4 + fat * 9)) <= kcal * 0.2, false) AND sv IS NOT NULL AS reconciled FROM s"""
)
def nutrition_rollup(spark, sf):
    """Energy, protein and dry weight of a serving; coconut milk stands for what is added at camp.  Amounts other than plain metric ones count as unknown here, so that SQL can read them too."""
    items = table(spark, sf, "dishes").where("updated is not null").select("id", "updated", "servings", F.explode("ingredients").alias("i")).select("id", "updated", "servings", "i.item", "i.amount")
    unit = F.regexp_extract("amount", r"^(\d+(?:\.\d+)?) ?(g|kg|oz|ml|l)$", 2)
    factor = reduce(lambda c, u: c.when(unit == u, _GRAMS[u]), _GRAMS, F.when(F.lit(False), 0.0))
    grams = F.nullif(F.regexp_extract("amount", r"^(\d+(?:\.\d+)?) ?(g|kg|oz|ml|l)$", 1), F.lit("")).cast("double") * factor
    weighed = items.withColumns({"grams": grams, "at_camp": nutrition.item_key(F.col("item")) == "coconut milk"})
    rolled = nutrition.rollup(nutrition.matched(weighed, _foods(items)), ["id", "updated"], F.col("servings"))
    return rolled.select("id", "updated", *[F.round(c).cast("long").alias(c) for c in ("kcal", "protein", "dry_ounces")], "unmatched", "reconciled")


# ---- originality

_RUNS = r"list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"


@query(
    rf"""WITH k AS (SELECT page_id, canonical, stored_at, text, first(page_id) OVER (PARTITION BY canonical ORDER BY page_id) AS source FROM ({CANONICAL})), t AS (SELECT page_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM pages),
 s AS (SELECT page_id, CASE WHEN len(w) >= 5 THEN {_RUNS} ELSE [] END AS runs FROM t)
 SELECT k.page_id, round(CASE WHEN len(a.runs) > 0 THEN coalesce(len(list_intersect(a.runs, b.runs)), 0) / len(a.runs) ELSE 0 END, 6) AS overlap, CASE WHEN len(a.runs) > 0 THEN coalesce(len(list_intersect(a.runs, b.runs)), 0) / len(a.runs) ELSE 0 END <= 0.2 AS original
 FROM k JOIN s a USING (page_id) LEFT JOIN s b ON b.page_id = k.source AND k.source <> k.page_id"""
)
def draft_originality(spark, sf):
    """Pages stored again under one canonical URL, held against the first of them."""
    keyed = table(spark, sf, "pages").select("page_id", "text", urls.canonical_url(F.col("url")).alias("canonical"))
    first = keyed.groupBy("canonical").agg(F.min("page_id").alias("link"))
    drafts = keyed.join(first, "canonical").withColumn("link", F.when(F.col("link") != F.col("page_id"), F.col("link")))
    sources = keyed.select(F.col("page_id").alias("link"), "text")
    checked = quality.originality(drafts, sources, "link")
    return checked.select("page_id", F.round("overlap", 6).alias("overlap"), "original")


@query("SELECT state, count(*) AS n FROM dishes, (SELECT unnest(['all', 'none']) AS state) WHERE NOT coalesce(draft, false) GROUP BY state")
def all_and_none(spark, sf):
    """Every option chosen, and none: neither narrows anything."""
    dishes = table(spark, sf, "dishes")
    counted = [FilterState.all().filtered(dishes).select(F.lit("all").alias("state")), FilterState.none().filtered(dishes).select(F.lit("none").alias("state"))]
    return reduce(DataFrame.unionByName, counted).groupBy("state").agg(F.count(F.lit(1)).alias("n"))
