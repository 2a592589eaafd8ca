import json

import pytest
from pyspark.sql import functions as F

from trailgrain.functions import html, urls
from trailgrain.operators import robots
from trailgrain.plans import crawl
from trailgrain.sources import generators, readers, sitemap, writers
from trailgrain.streaming import incremental


@pytest.mark.parametrize(
    "url, out",
    [
        ("https://WWW.Example.com/a/?utm_source=x&b=2&a=1#top", "https://www.example.com/a?a=1&b=2"),
        ("https://a.example/", "https://a.example/"), ("https://a.example", "https://a.example/"), ("https://a.example//", "https://a.example"), ("https://a.example/x//", "https://a.example/x"),
        ("http://a.example:80/x?fbclid=1", "http://a.example/x"), ("https://user:pw@a.example:8443/x?q", "https://a.example:8443/x?q="),
        ("https://a.example/ö?x=a b&y=~", "https://a.example/%C3%B6?x=a+b&y=%7E"), ("not a url", "not a url"), ("htps:/broken", "htps:/broken"),
        ("https://a.example/x?b=1&a=2&b=0&refer=1&ref=2", "https://a.example/x?a=2&b=1&b=0&refer=1"), (None, None), ("", ""),
    ],
)
def test_canonical_url(spark, url, out):
    assert urls.canonical(url) == out
    assert spark.createDataFrame([(url,)], "u string").select(urls.canonical_url(F.col("u")).alias("c")).first()["c"] == out


@pytest.mark.parametrize("url, ok", [("https://a.example/recipes/chili", True), ("https://a.example/", False), ("https://a.example/about", False), ("https://a.example/tag/soup", False), ("https://a.example/soup.jpg", False), ("https://a.example/TRAIL/Soup", True), ("x", False), (None, False)])
def test_url_shape(spark, url, ok):
    assert spark.createDataFrame([(url,)], "u string").select(urls.looks_like_recipe(F.col("u")).alias("c")).first()["c"] is ok


def test_same_site(spark):
    rows = [("https://www.a.example/x", "http://a.example", True), ("https://shop.a.example", "https://a.example", False), ("junk", "junk", False)]
    df = spark.createDataFrame(rows, "a string, b string, ok boolean")
    assert df.where(urls.same_site(F.col("a"), F.col("b")) != F.col("ok")).count() == 0


def test_robots_groups():
    text = "Sitemap: /s1\nDisallow: /early\nUser-agent: PotBot\nUser-agent: other # x\nDisallow: /admin\nDisallow:\nUser-agent: *\nDisallow: /\nCrawl-delay: 10\nSitemap: /s2"
    own = robots.parse(text, "potbot")
    assert own == {"allow": [], "disallow": ["/admin"], "sitemaps": ["/s1", "/s2"], "crawl_delay": None}
    assert robots.parse(text, "x")["disallow"] == ["/"] and robots.parse(text, "x")["crawl_delay"] == 10 and robots.parse(None, "x")["disallow"] == []


def test_robots_decision(spark):
    hosts = spark.createDataFrame([("h", "User-agent: *\nDisallow: /admin\nAllow: /admin/public\nDisallow: /*.pdf\nDisallow: /print$"), ("none", None)], "host string, body string").withColumn("rules", robots.parse_robots("bot")("body"))
    paths = [("h", "/admin/users", False), ("h", "/admin/public/x", True), ("h", "/a.pdf", False), ("h", "/print", False), ("h", "/print/page", True), ("none", "/x", True), ("unknown", "/x", True)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(paths)], "id int, host string, path string, ok boolean")
    got = robots.allowed(df, robots.rule_table(hosts), "id").join(df, "id")
    assert got.count() == len(paths) and got.where("allowed != ok").count() == 0


def test_html(spark):
    assert html.visible("<style>x</style>Boil<li>Stir</li> salt &amp; pepper &#39;s") == "Boil Stir salt & pepper 's"
    assert html.decode("&#38;lt; &#1114112;") == "< &#1114112;"
    df = spark.createDataFrame([("<title>Sour-dough - Tin Pot</title>",), ("<h1>Only</h1>",), (None,)], "h string")
    assert [r["t"] for r in df.select(html.page_title(F.col("h")).alias("t")).collect()] == ["Sour-dough", "Only", None]


def test_jsonld():
    nested = {"@graph": [{"@type": ["Thing", "Recipe"], "name": "A", "part": {"@type": "Recipe", "name": "B"}}]}
    page = f'<script type="application/ld+json">{json.dumps(nested)}</script><script type="application/ld+json">{{torn</script><script>{{"@type":"Recipe"}}</script>'
    assert [json.loads(r)["name"] for r in html.recipes(page)] == ["A", "B"]


def test_sitemap(spark):
    df = spark.createDataFrame([("<urlset><loc> a&amp;b </loc><loc/></urlset>",), ("<x:sitemapindex><x:loc>m</x:loc></x:sitemapindex>",), ("rss",), (None,)], "x string")
    got = [(r["m"]["urls"], r["m"]["sitemaps"]) for r in df.select(sitemap.parse_sitemap(F.col("x")).alias("m")).collect()]
    assert got == [(["a&b"], []), ([], ["m"]), ([], []), ([], [])]


def test_sitemap_walk_is_bounded(spark):
    roots = spark.createDataFrame([("d", "s0", 0)], "domain string, sitemap string, ord int")
    edges = spark.createDataFrame([(f"s{i}", f"s{i + k}", k) for i in range(60) for k in (1, 2)], "sitemap string, child string, child_ord int")
    assert sitemap.walk(roots, edges, limit=7).count() == 7


def test_plan(spark):
    leads = [(1, "www.A.example", "https://a.example/x?utm_a=1", 10), (2, "a.example", "https://a.example/x", 30), (3, "b.example", "junk", 9), (4, "c.example", "https://c.example/", None), (5, None, "https://d.example/", 1)]
    plan = crawl.plan_domains(spark.createDataFrame(leads, "lead_id long, domain string, url string, est_recipe_count int"))
    assert [(r["domain"], r["seeds"], r["estimate"]) for r in plan.orderBy(*crawl.plan_order()).collect()] == [("a.example", ["https://a.example/x"], 40), ("c.example", ["https://c.example/"], 0)]


def test_throttle_equals_loop(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").select("event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    last, expected = {}, {}
    for r in sorted(events.collect(), key=lambda r: (r["at"], r["event_id"])):
        start = max(r["at"], last.get(r["user_id"], -(10**18)) + 90_000)
        expected[r["event_id"]] = last[r["user_id"]] = start
    assert {r["event_id"]: r["start_ms"] for r in crawl.throttled(events, "user_id", "at", "event_id", 90_000).collect()} == expected


def test_frontmatter():
    raw = '---\ntitle: "A \\"b\\""\n# note\nslot: [dinner, lunch]\nprepMinutes: 5\nouncesPerServing: 4.5\nscalable: true\nsteps:\n  - Boil\n  - Stir\ningredients:\n  - item: Rice\n    amount: 1 cup\n---\nbody'
    r = readers.parse_frontmatter(raw)
    assert r["title"] == 'A "b"' and r["slot"] == ["dinner", "lunch"] and r["prepMinutes"] == 5 and r["ouncesPerServing"] == 4.5 and r["scalable"] is True
    assert r["steps"] == ["Boil", "Stir"] and r["ingredients"] == [{"item": "Rice", "amount": "1 cup"}]
    with pytest.raises(ValueError):
        readers.parse_frontmatter("no block")


def test_collection_reader(spark, tmp_path):
    (tmp_path / "rice.md").write_text("---\ntitle: Rice\nslot: [dinner]\ncost: $\n---\nx")
    r = readers.read_collection(spark, str(tmp_path)).first()
    assert (r["id"], r["title"], r["slot"], r["waterml"], r["scalable"], r["draft"]) == ("rice", "Rice", ["dinner"], 0, True, False)


def test_jsonl_round_trip_and_torn_tail(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "url string, n int"
    assert readers.read_jsonl(spark, path, schema).count() == 0
    for n in (1, 2):
        writers.append_jsonl(spark.createDataFrame([("u", n)], schema), path)
    (tmp_path / "log" / "torn.json").write_text('{"url": "v", "n": 3}\n\n{"url": "w", "n"')
    assert sorted(r["n"] for r in readers.read_jsonl(spark, path, schema).collect()) == [1, 2, 3]
    writers.append_keys(spark.createDataFrame([("k",), ("k",)], "canonical string"), str(tmp_path / "keys"))
    assert readers.read_keys(spark, str(tmp_path / "keys")).count() == 1 and readers.read_keys(spark, str(tmp_path / "gone")).count() == 0


def test_fetch_through_cache(spark):
    asked = spark.createDataFrame([("https://a.example/x?utm_x=1",), ("https://a.example/y",), ("https://a.example/bad",), ("https://a.example/img",)], "url string")
    cache = spark.createDataFrame([("https://a.example/x", "old")], "canonical string, body string")

    def fetch(batch):
        return [(500, "text/html", "no") if u.endswith("bad") else (200, "image/png", "no") if u.endswith("img") else (200, None, "new") for u in batch]

    pages, fresh = readers.fetch_pages(asked, cache, fetch)
    assert sorted((r["canonical"], r["body"], r["from_cache"]) for r in pages.collect()) == [("https://a.example/x", "old", True), ("https://a.example/y", "new", False)]
    assert [r["canonical"] for r in fresh.collect()] == ["https://a.example/y"]


def test_stream_dedup_across_runs(spark, tmp_path):
    log, out, at, schema = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "at"), "url string"
    for urls_ in (["https://a.example/x", "https://a.example/x?ref=1"], ["https://A.example/x", "https://a.example/y"]):
        writers.append_jsonl(spark.createDataFrame([(u,) for u in urls_], schema), log)
        incremental.drain(incremental.first_seen(incremental.read_log(spark, log, schema)), out, at)
    assert sorted(r["canonical"] for r in spark.read.parquet(out).collect()) == ["https://a.example/x", "https://a.example/y"]


def test_stream_throttle_keeps_state(spark, tmp_path):
    log, out, at, schema = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "at"), "host string, id long, ms long"
    for rows in ([("h", 1, 0), ("h", 2, 100), ("g", 3, 50)], [("h", 4, 200)]):
        writers.append_jsonl(spark.createDataFrame(rows, schema), log)
        incremental.drain(incremental.throttled(incremental.read_log(spark, log, schema), "host", "ms", "id", 1000), out, at)
    assert {r["id"]: r["start_ms"] for r in spark.read.parquet(out).collect()} == {1: 0, 2: 1000, 3: 50, 4: 2000}


def test_generated_cells_and_parameters(spark):
    rows = generators.cells(spark, {"w": ("blog", [("Alps", "en"), ("Andes", "es")]), "f": ("forum", [("Tatra", "pl")])}).collect()
    assert [tuple(r) for r in rows] == [("w001", "blog", "Alps", "en"), ("w002", "blog", "Andes", "es"), ("f001", "forum", "Tatra", "pl")]
    assert generators.parameters(["--budget", "7", "--shard", "x", "--other", "3"], {"budget": 4000, "shard": 0}) == {"budget": 7, "shard": 0}


def test_observed_counts(spark):
    df, seen = writers.observed(spark.range(5), "run", top=F.max("id"))
    df.collect()
    assert seen.get == {"rows": 5, "top": 4}
