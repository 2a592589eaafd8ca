"""The crawl as one plan, walks, nutrition, representatives, routing, and records of any depth."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailgrain.functions import html, urls
from trailgrain.operators import nested, nutrition, quality, robots, search, units
from trailgrain.plans import harvest
from trailgrain.sources import sitemap, writers

LEAD = "lead_id long, domain string, url string, est_recipe_count int"
ANSWER = "url string, status int, content_type string, body string"


def page(name, words=90):
    return f"<title>{name}</title><p>{'soup ' * words}</p>"


@pytest.fixture(scope="module")
def web(spark):
    rows = [
        ("https://a.example/robots.txt", 200, "text/plain", "User-agent: *\nDisallow: /secret\nSitemap: https://a.example/one.xml"),
        ("https://a.example/one.xml", 200, "text/xml", "<sitemapindex><loc>https://a.example/two.xml</loc><loc>https://a.example/gone.xml</loc></sitemapindex>"),
        ("https://a.example/two.xml", 200, "text/xml", "<urlset>" + "".join(f"<loc>https://a.example{p}</loc>" for p in ("/recipe/1", "/recipe/1?utm_x=1", "/secret/recipe", "/privacy", "/recipe/2", "/recipe/404", "/recipe/short", "/recipe/3")) + "<loc>https://b.example/recipe/9</loc></urlset>"),
        ("https://a.example/start", 200, None, page("Start")),
        *[(f"https://a.example/recipe/{i}", 200, "text/html", page(f"R{i} | A")) for i in (1, 2, 3)],
        ("https://a.example/recipe/404", 404, "text/html", page("no")),
        ("https://a.example/recipe/short", 200, "text/html", page("Short", 3)),
        ("https://b.example/", 200, "text/html", page("B")),
    ]
    return spark.createDataFrame(rows, ANSWER)


def crawl(spark, web, **options):
    leads = spark.createDataFrame([(1, "A.example", "https://a.example/start#x", 5), (2, "b.example", "https://b.example/", 9), (3, "c.example", "see notes", 90), (4, None, "https://d.example/", 1)], LEAD)
    return harvest.harvest(leads, web, **options)


def test_crawl(spark, web):
    got = {r["url"]: r for r in crawl(spark, web).collect()}
    assert set(got) == {"https://a.example/start", "https://b.example/"} | {f"https://a.example/recipe/{i}" for i in (1, 2, 3)}
    assert got["https://a.example/recipe/1"]["title"] == "R1" and got["https://b.example/"]["jsonld"] is None


def test_crawl_limits(spark, web):
    assert {r["url"] for r in crawl(spark, web, budget=2).collect()} == {"https://b.example/", "https://a.example/start"}
    assert {r["url"] for r in crawl(spark, web, domains=1).collect()} == {"https://b.example/"}
    # Three candidates, of which two are one page.
    assert {r["url"] for r in crawl(spark, web, cap=3).collect()} == {"https://b.example/", "https://a.example/start", "https://a.example/recipe/1"}
    shards = [{r["url"] for r in crawl(spark, web, shard=i, shards=2).collect()} for i in (0, 1)]
    assert not shards[0] & shards[1] and len(shards[0] | shards[1]) == 5


def test_crawl_resumes_and_bears_empty_tables(spark, web):
    seen = spark.createDataFrame([("https://a.example/recipe/1",), ("https://a.example/start",)], "canonical string")
    assert {r["url"] for r in crawl(spark, web, seen=seen).collect()} == {"https://b.example/", "https://a.example/recipe/2", "https://a.example/recipe/3"}
    assert crawl(spark, web.where("false")).count() == 0
    assert harvest.harvest(spark.createDataFrame([], LEAD), web).count() == 0


def test_walk_is_as_deep_as_the_limit(spark):
    chain = spark.createDataFrame([(f"m{i}", f"m{i + 1}", 0) for i in range(21)], "sitemap string, child string, child_ord int")
    roots = spark.createDataFrame([("a", "m0", 0), ("b", "m15", 0)], "domain string, sitemap string, ord int")
    got = sitemap.walk(roots, chain).collect()
    assert sum(r["domain"] == "a" for r in got) == 22 and sum(r["domain"] == "b" for r in got) == 7
    loop = spark.createDataFrame([("r", "r", 0), ("r", "s", 1)], "sitemap string, child string, child_ord int")
    walked = sorted((r["n"], r["sitemap"]) for r in sitemap.walk(roots.limit(1).select("domain", F.lit("r").alias("sitemap"), "ord"), loop).collect())
    assert len(walked) == 25 and [s for _, s in walked[:5]] == ["r", "r", "s", "r", "s"]
    assert sitemap.walk(roots, loop.where("false")).count() == 2


def test_plain_columns_need_no_python(spark):
    df = spark.createDataFrame([("https://A.example/x/../y?b=1",)], "u string")
    plan = df.select(urls.canonical_url(F.col("u")), html.page_text(F.col("u")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


URLS = ["https://A.example/x/../y/./z?b=2&a=1&utm_x=3#f", "http://a.example:80", "https://a.example:0443/", "https://a.example/a b/ü?q=a+b%20c&é=1", "see notes", None, "", "https://u@a.example//", "https://a.example/x/..", "https://a.example/%zz?x=%zz&y", "  https://a.example/x/ ", "https://a.example/..", "HTTP://a.example\\b\\c?~=*", "https:///x", "https://a.example/a?b=1=2&&c", "https://a.example/./", "https://a.example:8443/x?", "https://a.example/a?z=1&a=2&z=0"]
MARKUP = ["salt &amp; pepper &#39;s", "&#x20AC;5 &unknown; &#X20ac;", "&#38;lt;", "&#1114112; stays &#55296; &#x1F600; &#99999999999999999999999;", None, "", "&#38;#60; &#60;", "&#x26;#38;", "x&nbsp;y"]


def test_expressions_equal_their_models(spark):
    found = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", urls.canonical_url(F.col("u")).alias("c")).collect()
    assert [r["c"] for r in found] == [urls.canonical(u) for u in URLS]
    found = spark.createDataFrame([(m,) for m in MARKUP], "m string").select(html.decode_entities(F.col("m")).alias("d")).collect()
    assert [r["d"] for r in found] == [None if m is None else html.decode(m) for m in MARKUP]


def test_robots_fold_in_place(spark):
    rules = spark.createDataFrame([("a", "disallow", "^/x", 2), ("a", "allow", "^/x/y", 4), ("b", "disallow", "^/", 1)], "host string, kind string, regex string, length int")
    pages = spark.createDataFrame([(1, "a", "/x/y"), (2, "a", "/x"), (3, "a", "/"), (4, "b", "/q"), (5, "c", "/"), (6, "a", None), (6, None, "/")], "id int, host string, path string")
    assert sorted((r["id"], r["allowed"]) for r in robots.allowed(pages, rules, "id").collect()) == [(1, True), (2, False), (3, True), (4, False), (5, True), (6, True), (6, True)]


def test_hit_ranges_of_a_long_text():
    text = "ab" * 200_000
    assert search.hit_ranges(text, ["bab", "zz"]) == [(1, 400_000)]


def test_records_nested_however_deep(spark):
    deep = "[" * 3000 + '"stir"' + "]" * 3000
    rows = [(1, [f'{{"@type":"Recipe","recipeInstructions":{deep}}}', '{"author":"A"}', None, "{torn"]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "page_id long, jsonld array<string>")
    got = [tuple(r) for r in nested.flatten_recipes(df).collect()]
    assert (1, 1, "author", -1, 0) in got
    value: object = "stir"
    for _ in range(5000):
        value = [value]
    assert [t for t, *_ in nested.child_rows({"recipeInstructions": value})] == ["step"]


def test_tables_by_schema_path(spark):
    record = {"name": "Soup", "review": [{"author": {"name": "Ann"}, "stars": 5}, None, {"author": "Bo"}], "tags": ["a", "b"], "none": None}
    df = spark.createDataFrame([(7, [json.dumps(record), "[1]", None])], "page_id long, jsonld array<string>")
    shreds = nested.shred(df)
    got = {(r["table"], r["dewey"]): (r["parent"], dict(r["fields"])) for r in shreds.collect()}
    assert got == {
        ("", "0"): (None, {"name": "Soup"}), ("review", "0.1.0"): ("0", {"stars": "5"}), ("review.author", "0.1.0.0"): ("0.1.0", {"name": "Ann"}), ("review", "0.1.2"): ("0", {"author": "Bo"}),
        ("tags", "0.2.0"): ("0", {"value": "a"}), ("tags", "0.2.1"): ("0", {"value": "b"}),
    }
    flat = nested.tables(shreds, {"review": ["stars", "author"]})["review"]
    assert sorted((r["stars"] or "", r["author"] or "") for r in flat.collect()) == [("", "Bo"), ("5", "")]


def test_changepoints_equal_brute_force():
    rng = np.random.default_rng(3)

    def cost(part):
        return ((part - part.mean()) ** 2).sum()

    for _ in range(400):
        n = int(rng.integers(6, 13))
        values = np.round(rng.normal(0, 0.3, n) + rng.choice([0, 1.43], n // 3 + 1).repeat(3)[:n], 3)
        best = np.full(n + 1, np.inf)
        best[0] = -units.PENALTY
        for end in range(3, n + 1):
            best[end] = min([best[s] + cost(values[s:end]) + units.PENALTY for s in range(end - 2) if np.isfinite(best[s])] or [np.inf])
        starts = units.changepoints(values)
        own = sum(cost(p) for p in np.split(values, starts[1:])) + units.PENALTY * (len(starts) - 1)
        assert own <= best[n] + 1e-9 and all(len(p) >= 3 for p in np.split(values, starts[1:]))


def test_a_shift_far_into_a_history_is_reversed(spark):
    rows = [(i, "a", i, 400.0 * (4.184 if i >= 2048 else 1)) for i in range(4096)]
    df = spark.createDataFrame(rows, "id int, source string, at int, value double")
    got = units.unit_shifts(df, "source", "at", "value", "id", 4.184)
    assert got.where("unit_factor > 1").count() == 2048 and got.where("abs(restored - 400) > 0.01").count() == 0


def test_nutrition(spark):
    items = spark.createDataFrame([(1, "Oats (rolled)", 100.0, False, 2), (1, "Water, cold", 500.0, True, 2), (1, "Dust", 10.0, False, 2), (2, "Oats", None, False, 1), (3, "Oats", 50.0, None, 0), (4, None, 5.0, False, 1)], "id int, item string, grams double, at_camp boolean, servings int")
    foods = spark.createDataFrame([("oats", 380.0, 13.0, 60.0, 7.0), ("water", 0.0, 0.0, 0.0, 0.0)], "food string, kcal double, protein double, carb double, fat double")
    rolled = {r["id"]: r for r in nutrition.rollup(nutrition.matched(items, foods), ["id"], F.col("servings")).collect()}
    assert rolled[1]["kcal"] == 240 and rolled[1]["protein"] == 6.5 and rolled[1]["unmatched"] == 1 and round(rolled[1]["dry_ounces"] * 2 * nutrition.GRAMS_AN_OUNCE) == 110 and not rolled[1]["reconciled"]
    assert rolled[2]["kcal"] == 100 and rolled[2]["unmatched"] == 1 and rolled[3]["kcal"] is None and rolled[4]["unmatched"] == 1
    checks = spark.createDataFrame([(355.0, 13.0, 60.0, 7.0), (500.0, 13.0, 60.0, 7.0), (0.0, 0.0, 0.0, 0.0), (None, 1.0, 1.0, 1.0)], "k double, p double, c double, f double")
    assert [r[0] for r in checks.select(nutrition.reconciled(*[F.col(c) for c in "kpcf"])).collect()] == [True, False, True, False]


def test_representatives(spark):
    members = spark.createDataFrame([(1, "x", 1), (2, "x", 3), (3, "x", 3), (4, None, 9), (5, "y", None)], "id int, cluster string, rank int")
    assert sorted((r["id"], r["representative"]) for r in quality.representatives(members, "cluster", "id", F.col("rank")).collect()) == [(1, 2), (2, 2), (3, 2), (4, 4), (5, 5)]


def test_originality(spark):
    drafts = spark.createDataFrame([(1, "a b c d e f", "s"), (2, "q r s t u v", "s"), (3, "a b", "s"), (4, None, None)], "id int, text string, link string")
    sources = spark.createDataFrame([("s", "x a b c d e f y")], "link string, text string")
    assert {r["id"]: (r["overlap"], r["original"]) for r in quality.originality(drafts, sources, "link").collect()} == {1: (1.0, False), 2: (0.0, True), 3: (0.0, True), 4: (0.0, True)}


def test_json_array_is_json(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(11)], "id int, name string")
    writers.write_json_array(df, str(tmp_path / "a"), [F.col("id").asc()])
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    assert json.loads(text) == [{"id": i} if i % 2 else {"id": i, "name": "x"} for i in range(11)]
    assert [r["line"] for r in writers.json_array(df.where("false"), [F.col("id")]).collect()] == ["[]"]


def test_route(spark):
    df = spark.createDataFrame([("Apple", 1), ("9x", 1), ("Äpfel", 1), (None, 1), ("b", 0)], "id string, n int")
    got = [r["place"] for r in quality.route(df, {"n": F.col("n") > 0}).collect()]
    assert got == ["content/a", "content/9", "content/other", "content/other", "quarantine"]


def test_random_terms_rejoin():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(30))
        assert "".join(s for s, _ in search.segments(text, search.hit_ranges(text, ["ab", "a a", "bb"]))) == text
