"""Queries of the web harvest: markup, sitemaps, robots, state codec, fetching, logs, streams and the crawl as one plan."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trailgrain.functions import html, urls
from trailgrain.functions.arrowkit import shared_folder
from trailgrain.operators import robots
from trailgrain.plans import crawl, harvest
from trailgrain.plans.state import decode_column, encode_column
from trailgrain.registry import query, table, values
from trailgrain.sources import generators, readers, sitemap, writers
from trailgrain.sqltext import CANONICAL, LEADS, PLAN, SITE
from trailgrain.streaming import incremental

#: White space beyond ASCII, as a class of the SQL's expressions.
_WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _folder(spark) -> str:
    """A new folder in the place that all executors share."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# ---- markup: pages wrapped in HTML

_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("é", "&#233;"), ("–", "&#x2013;"), ("\n", "</p>\n<p>")]


def _escaped(column, escapes=tuple(_ESCAPES)):
    for plain, entity in escapes:
        column = F.replace(column, F.lit(plain), F.lit(entity))
    return column


def _escaped_sql(column: str) -> str:
    for plain, entity in _ESCAPES:
        column = f"replace({column}, {'chr(10)' if plain == chr(10) else repr(plain)}, {repr(entity) if chr(10) not in entity else chr(39) + entity.replace(chr(10), chr(39) + ' || chr(10) || ' + chr(39)) + chr(39)})"
    return column


def _documents(spark, sf):
    """``page_id`` and ``doc``: each page as HTML, with a title, scripts, styles and its recipes."""
    pages = table(spark, sf, "pages")
    recipes = F.array_join(F.transform(F.coalesce("jsonld", F.array().cast("array<string>")), lambda j: F.concat(F.lit('<script type="application/ld+json">'), j, F.lit("</script>"))), "")
    title, text = _escaped(F.coalesce("title", F.lit(""))), _escaped(F.coalesce("text", F.lit("")))
    doc = F.concat(F.lit("<html><head><title>"), title, F.lit(" | "), "domain", F.lit("</title><style>p{color:red}</style>"), recipes, F.lit("</head><body><h1>"), title, F.lit('</h1><script>var a = "<b>";</script><p>'), text, F.lit("</p></body></html>"))
    return pages.select("page_id", "url", "domain", doc.alias("doc"))


_DOC = f"'<html><head><title>' || {_escaped_sql("coalesce(title, '')")} || ' | ' || domain || '</title><style>p{{color:red}}</style></head><body><h1>' || {_escaped_sql("coalesce(title, '')")} || '</h1><script>var a = \"<b>\";</script><p>' || {_escaped_sql("coalesce(text, '')")} || '</p></body></html>'"


def _shown_sql(doc: str) -> str:
    bare = rf"regexp_replace(regexp_replace({doc}, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')"
    for plain, entity in [*reversed(_ESCAPES[1:-1]), _ESCAPES[0]]:
        bare = f"replace({bare}, '{entity}', '{plain}')"
    return f"trim(regexp_replace({bare}, '{_WS}+', ' ', 'g'))"


@query(f"SELECT page_id, {_shown_sql('doc')} AS shown FROM (SELECT page_id, {_DOC} AS doc FROM pages)")
def page_text(spark, sf):
    return _documents(spark, sf).select("page_id", html.page_text(F.col("doc")).alias("shown"))


@query(rf"SELECT page_id, trim(regexp_replace(shown, '{_WS}+[|•·»–—]{_WS}+.*$|{_WS}+-{_WS}+.*$', '')) AS page_title FROM (SELECT page_id, {_shown_sql('t')} AS shown FROM (SELECT page_id, {_escaped_sql('coalesce(title, ' + chr(39) * 2 + ')')} || ' | ' || domain AS t FROM pages))")
def page_title(spark, sf):
    return _documents(spark, sf).select("page_id", html.page_title(F.col("doc")).alias("page_title"))


_VALID = "list_filter(coalesce(jsonld, []), lambda j: coalesce(json_extract_string(CASE WHEN json_valid(j) THEN j END, '$.\"@type\"') = 'Recipe' OR json_contains(json_extract(CASE WHEN json_valid(j) THEN j END, '$.\"@type\"'), '\"Recipe\"'), false))"


@query(f"SELECT page_id, list_transform({_VALID}, lambda j: coalesce(json_extract_string(j, '$.name'), '')) AS names FROM pages")
def jsonld_extract(spark, sf):
    found = _documents(spark, sf).select("page_id", html.jsonld_recipes("doc").alias("recipes"))
    return found.select("page_id", F.transform("recipes", lambda r: F.coalesce(F.get_json_object(r, "$.name"), F.lit(""))).alias("names"))


@query("SELECT doc_id, text AS plain FROM documents")
def entity_decode(spark, sf):
    """Documents with characters as hexadecimal, decimal and named entities, decoded again."""
    coded = F.replace(F.replace(_escaped(F.col("text"), _ESCAPES[:-1]), F.lit("e"), F.lit("&#101;")), F.lit("o"), F.lit("&#x6F;"))
    safe = F.replace(F.replace(coded, F.lit("&qu&#x6F;t;"), F.lit("&quot;")), F.lit("\n"), F.lit("&#10;"))
    return table(spark, sf, "documents").select("doc_id", html.decode_entities(safe).alias("plain"))


@query(f"SELECT lead_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\\.', '') = {SITE} AND url SIMILAR TO 'https?://.*' AS on_site FROM leads WHERE url IS NOT NULL AND domain IS NOT NULL")
def same_site(spark, sf):
    leads = table(spark, sf, "leads").where("url is not null and domain is not null")
    return leads.select("lead_id", urls.same_site(F.col("url"), F.concat(F.lit("https://"), F.trim("domain"), F.lit("/"))).alias("on_site"))


# ---- sitemaps


@query("SELECT lead_id, CASE WHEN lead_id % 3 = 0 OR trim(url) = '' THEN '' ELSE trim(url) END AS found_urls, CASE WHEN lead_id % 3 = 0 THEN trim(url) ELSE '' END AS found_maps FROM leads WHERE url IS NOT NULL")
def sitemap_parse(spark, sf):
    """A URL set of each lead's URL; every third is an index instead, with a namespace."""
    location = F.concat(F.lit("loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </"))
    plain = F.concat(F.lit("<urlset><url><"), location, F.lit("loc></url><url><loc></loc></url></urlset>"))
    index = F.concat(F.lit('<sm:sitemapindex xmlns:sm="x"><sm:sitemap><sm:'), location, F.lit("sm:loc></sm:sitemap></sm:sitemapindex>"))
    leads = table(spark, sf, "leads").where("url is not null").select("lead_id", F.when(F.col("lead_id") % 3 == 0, index).otherwise(plain).alias("doc"))
    return leads.select("lead_id", sitemap.parse_sitemap(F.col("doc")).alias("m")).select("lead_id", F.array_join("m.urls", " ").alias("found_urls"), F.array_join("m.sitemaps", " ").alias("found_maps"))


_GRAPH = f"SELECT site, k, CASE WHEN length(site) % 2 = 0 THEN k - 1 ELSE k // 2 END AS parent FROM (SELECT {SITE} AS site, row_number() OVER (PARTITION BY {SITE} ORDER BY lead_id) AS k FROM leads WHERE domain IS NOT NULL)"


@query(f"""WITH RECURSIVE g AS ({_GRAPH}), w AS (SELECT site, k, 0 AS level, [k] AS way FROM g WHERE k = 1
 UNION ALL SELECT g.site, g.k, w.level + 1, list_append(w.way, g.k) FROM w JOIN g ON g.site = w.site AND g.parent = w.k AND g.k > 1 WHERE w.level < 25)
 SELECT site AS domain, site || '#' || k AS sitemap, n FROM (SELECT *, CAST(row_number() OVER (PARTITION BY site ORDER BY level, way) AS INT) AS n FROM w) WHERE n <= 25""")  # fmt: skip
def sitemap_walk(spark, sf):
    """Over a graph made of leads: a site's k-th lead is a sitemap that the one before it lists, or the one at half its place."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("site").orderBy("lead_id"))
    nodes = table(spark, sf, "leads").where("domain is not null").select(urls.site_key(F.col("domain")).alias("site"), "lead_id").withColumn("k", place)
    parent = F.when(F.length("site") % 2 == 0, F.col("k") - 1).otherwise(F.floor(F.col("k") / 2))
    named = nodes.select("site", "k", F.concat_ws("#", "site", F.col("k").cast("string")).alias("child"), F.concat_ws("#", "site", parent.cast("string")).alias("sitemap"))
    roots = named.where("k = 1").select(F.col("site").alias("domain"), F.col("child").alias("sitemap"), F.lit(0).alias("ord"))
    return sitemap.walk(roots, named.where("k > 1").select("sitemap", "child", F.col("k").alias("child_ord")))


# ---- robots

# What the sites' robots.txt say, by the length of the site's name modulo 4, and the rules that follow from it.
_ROBOTS = [
    "User-agent: *\nDisallow: /blog\nAllow: /blog/food\nCrawl-delay: 3",
    "User-agent: trailgrain\nUser-agent: other\nDisallow: /camp-cooking # kept\nDisallow: /index.php\n\nUser-agent: *\nDisallow: /",
    "User-agent: *\nDisallow: /*soup\nDisallow: /recipes$\nDisallow: /recipes/$",
    "Disallow: /\nUser-agent: nobody\nDisallow: /",
]
_RULES = [(0, "disallow", "^/blog", 5), (0, "allow", "^/blog/food", 10), (1, "disallow", "^/camp-cooking", 13), (1, "disallow", "^/index\\.php", 10), (2, "disallow", "^/.*soup", 6), (2, "disallow", "^/recipes$", 9), (2, "disallow", "^/recipes/$", 10)]
_PATH = "CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) END"


def _robots_body(site):
    kind = F.length(site) % 4
    return F.when(kind == 0, _ROBOTS[0]).when(kind == 1, _ROBOTS[1]).when(kind == 2, _ROBOTS[2]).otherwise(_ROBOTS[3])


def _allowed_sql(rows: str, key: str) -> str:
    """``key`` and ``allowed`` of the rows (key, site, path)."""
    return f"""SELECT {key}, d = -1 OR a >= d AS allowed FROM (SELECT {key}, coalesce(max(len) FILTER (WHERE kind = 'allow' AND regexp_matches(path, re)), -1) AS a, coalesce(max(len) FILTER (WHERE kind = 'disallow' AND regexp_matches(path, re)), -1) AS d
 FROM ({rows}) p LEFT JOIN {values(_RULES, 'm, kind, re, len')} ON length(p.site) % 4 = t.m GROUP BY {key})"""


@query(_allowed_sql(f"SELECT page_id, {SITE} AS site, {_PATH} AS path FROM pages", "page_id"))
def robots_allowed(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", urls.site_key(F.col("domain")).alias("host"), urls.url_path(F.col("url")).alias("path"))
    hosts = pages.select("host").distinct().withColumn("rules", robots.parse_robots("trailgrain")(_robots_body(F.col("host"))))
    return robots.allowed(pages, robots.rule_table(hosts), "page_id")


@query("SELECT lead_id, CAST(least(greatest(1500, coalesce(est_recipe_count / 10.0, 0) * 1000), 10000) AS BIGINT) AS delay_ms FROM leads")
def polite_delay(spark, sf):
    return table(spark, sf, "leads").select("lead_id", crawl.polite_delay(F.col("est_recipe_count") / 10).alias("delay_ms"))


# ---- query strings

_ENCODED = {"style": ("tripstyle", 8), "slot": ("slot", 6), "heat": ("heatsource", 9), "diet": ("dietary", 5)}


def _form_sql(x: str) -> str:
    return f"replace(replace(replace(url_encode({x}), '%20', '+'), '~', '%7E'), '%2A', '*')"


@query(
    "SELECT id, updated, CASE WHEN s = '' THEN '' ELSE '?' || s END AS encoded FROM (SELECT id, updated, concat_ws('&', "
    + ", ".join(f"CASE WHEN len({c}) > 0 AND len({c}) < {n} THEN '{k}=' || {_form_sql(f'array_to_string({c}, {chr(39)},{chr(39)})')} END" for k, (c, n) in _ENCODED.items())
    + f", CASE WHEN cost IS NOT NULL THEN 'cost=' || {_form_sql('cost')} END, CASE WHEN trim(blurb) <> '' THEN 'q=' || {_form_sql('trim(blurb)')} END, CASE WHEN servings % 2 = 1 THEN 'sort=time' END) AS s FROM dishes)"
)
def codec_encode(spark, sf):
    selected = {k: F.col(c) for k, (c, _) in _ENCODED.items()} | {"cost": F.when(F.col("cost").isNotNull(), F.array("cost"))}
    return table(spark, sf, "dishes").select("id", "updated", encode_column(selected, F.col("blurb"), F.when(F.col("servings") % 2 == 1, "time").otherwise("cal-oz")).alias("encoded"))


_SLOTS = "breakfast,lunch,dinner,snack,dessert,drink"


@query(f"SELECT lead_id, CASE lead_id % 3 WHEN 0 THEN 'lunch' WHEN 1 THEN '{_SLOTS}' ELSE 'dinner,drink' END AS slot, 9 AS heats, coalesce(why, '') AS q, CASE WHEN lead_id % 2 = 0 THEN 'weight' ELSE 'cal-oz' END AS sort FROM leads")
def codec_decode(spark, sf):
    chosen = F.when(F.col("lead_id") % 3 == 0, "lunch%2Cnonsense").when(F.col("lead_id") % 3 == 1, "nonsense").otherwise("+dinner+%2Cdrink&slot=lunch")
    text = F.concat(F.lit("?bogus=x&slot="), chosen, F.lit("&q="), F.url_encode(F.coalesce("why", F.lit(""))), F.when(F.col("lead_id") % 2 == 0, "&sort=weight").otherwise("&sort=fake"))
    state = table(spark, sf, "leads").select("lead_id", decode_column(text).alias("s"))
    return state.select("lead_id", F.array_join("s.slot", ",").alias("slot"), F.size("s.heat").alias("heats"), "s.q", "s.sort")


# ---- fetching and logs


def _stub(asked: list[str]) -> list[tuple[int, str | None, str | None] | None]:
    """Answers by the length of the URL: failures, statuses, types."""
    return [None if len(u) % 11 == 0 else (404 if len(u) % 5 == 0 else 200, "image/png" if len(u) % 7 == 0 else None if len(u) % 2 else "text/html; charset=utf-8", "<p>x</p>") for u in asked]


@query(f"WITH c AS (SELECT canonical, min(page_id) AS first, min(url) AS url FROM ({CANONICAL}) GROUP BY canonical) SELECT canonical, first % 3 = 0 AS from_cache FROM c WHERE first % 3 = 0 OR length(canonical) % 11 <> 0 AND length(canonical) % 5 <> 0 AND length(canonical) % 7 <> 0")
def fetch_cached(spark, sf):
    """Every third page is in the cache, the others are asked for."""
    keyed = table(spark, sf, "pages").groupBy(urls.canonical_url(F.col("url")).alias("url")).agg(F.min("page_id").alias("first"))
    cache = keyed.where(F.col("first") % 3 == 0).select(F.col("url").alias("canonical"), F.lit("held").alias("body"))
    pages, _ = readers.fetch_pages(keyed, cache, _stub)
    return pages.select("canonical", "from_cache").distinct()


@query(f"SELECT canonical FROM ({CANONICAL}) UNION SELECT seed FROM ({LEADS})")
def seen_keys(spark, sf):
    """Keys appended by two runs, read back."""
    folder = _folder(spark)
    writers.append_keys(table(spark, sf, "pages").select(urls.canonical_url(F.col("url")).alias("canonical")), folder)
    parsed = table(spark, sf, "leads").where(F.col("url").rlike("^https?://[^/?#]+") & F.col("domain").isNotNull())
    writers.append_keys(parsed.select(urls.canonical_url(F.col("url"), urls.SEED_TRACKING).alias("canonical")), folder)
    return readers.read_keys(spark, folder)


_LEAD = "lead_id long, domain string, url string, est_recipe_count int, type string, has_sitemap boolean, language string, cell string"


@query("SELECT lead_id, domain, url, est_recipe_count, type, has_sitemap, language, cell FROM leads")
def jsonl_files(spark, sf):
    """Leads appended to JSON lines in two folders, read back over both."""
    folder, leads = _folder(spark), table(spark, sf, "leads").drop("found_at", "why")
    mapped = F.coalesce("has_sitemap", F.lit(False))
    writers.append_jsonl(leads.where(mapped), f"{folder}/mapped")
    writers.append_jsonl(leads.where(~mapped), f"{folder}/other")
    return readers.read_jsonl(spark, f"{folder}/*", _LEAD)


@query(f"SELECT substring(h, 1, 2) AS first, substring(h, 3, 2) AS second, count(*) AS n FROM (SELECT DISTINCT sha256(canonical) AS h FROM ({CANONICAL})) GROUP BY ALL")
def cache_write(spark, sf):
    """The cache's two levels of folders, written and read back."""
    folder = _folder(spark)
    writers.write_cache(table(spark, sf, "pages").select(urls.canonical_url(F.col("url")).alias("canonical"), F.lit("x").alias("body")), folder)
    return spark.read.option("partitionColumnTypeInference.enabled", "false").schema("canonical string, body string, hash string, first string, second string").parquet(folder).groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, concat_ws(',', 'page_id', 'url', CASE WHEN title IS NOT NULL THEN 'title' END, CASE WHEN len(jsonld) > 0 THEN 'jsonld' END, CASE WHEN text IS NOT NULL THEN 'text' END, 'chars') AS fields FROM pages WHERE (len(coalesce(jsonld, [])) > 0 OR coalesce(chars, length(text), 0) >= 400) AND chars IS NOT NULL")
def absent_fields(spark, sf):
    """The fields of each kept page's JSON line: absent ones are left out."""
    kept = crawl.kept(table(spark, sf, "pages")).where("chars is not null").select("page_id", "url", "title", "jsonld", "text", "chars")
    return kept.select("page_id", F.array_join(F.json_object_keys(F.to_json(F.struct(*kept.columns))), ",").alias("fields"))


@query("SELECT count(*) AS rows, sum(chars) AS chars, count(*) FILTER (WHERE title IS NULL) AS untitled FROM pages WHERE len(coalesce(jsonld, [])) > 0 OR coalesce(chars, length(text), 0) >= 400")
def run_totals(spark, sf):
    """Totals that are observed while the kept pages pass through another action."""
    kept, seen = writers.observed(crawl.kept(table(spark, sf, "pages")), "totals", chars=F.sum("chars"), untitled=F.count_if(F.col("title").isNull()))
    kept.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], seen.get["chars"], seen.get["untitled"])], "rows long, chars long, untitled long")


@query("SELECT id FROM cells WHERE id NOT IN (SELECT cell FROM leads WHERE cell IS NOT NULL)")
def resumed_cells(spark, sf):
    """Cells without a lead yet."""
    return crawl.unseen(table(spark, sf, "cells"), table(spark, sf, "leads").select(F.col("cell").alias("id")), "id").select("id")


@query(f"SELECT DISTINCT {SITE} AS site FROM leads WHERE domain IS NOT NULL AND {SITE} NOT IN (SELECT {SITE} FROM pages WHERE domain IS NOT NULL)")
def new_domains(spark, sf):
    """Sites of leads that no page is of."""
    known = table(spark, sf, "pages").where("domain is not null").select(urls.site_key(F.col("domain")).alias("site"))
    return crawl.unseen(table(spark, sf, "leads").where("domain is not null").select(urls.site_key(F.col("domain")).alias("site")).distinct(), known, "site")


# ---- streams


def _streamed(spark, sf, name, *columns):
    """A table as a stream, be it one file or a folder of files."""
    # Spark takes no file as a stream's path, but a pattern; this one has one match, and a folder that matches is listed.
    return spark.readStream.schema(table(spark, sf, name).select(*columns or "*").schema).parquet(f"{sf}/{name}.parque[t]")


@query(f"SELECT canonical FROM ({CANONICAL}) GROUP BY canonical")
def stream_first_seen(spark, sf):
    """Pages as a stream, deduplicated across its batches and drained."""
    folder = _folder(spark)
    incremental.drain(incremental.first_seen(_streamed(spark, sf, "pages", "page_id", "url")), f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").select("canonical")


@query("""WITH e AS (SELECT event_id, user_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS at_ms FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms, event_id) - 1 AS k FROM e)
 SELECT event_id, CAST(max(at_ms - 60000 * k) OVER (PARTITION BY user_id ORDER BY at_ms, event_id ROWS UNBOUNDED PRECEDING) + 60000 * k AS BIGINT) AS start_ms FROM n""")  # fmt: skip
def stream_throttled(spark, sf):
    """Events as a stream, each user's at least a minute apart, the last start kept as state."""
    keyed = _streamed(spark, sf, "events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    folder = _folder(spark)
    incremental.drain(incremental.throttled(keyed, "user_id", "at_ms", "event_id", 60_000), f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").select("event_id", "start_ms")


@query("""WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), g AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 1 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM e)
 SELECT user_id, max(ts) AS last_at, count(*) AS events FROM g GROUP BY user_id, burst""")  # fmt: skip
def event_bursts(spark, sf):
    return incremental.bursts(table(spark, sf, "events"), "user_id", "ts", "1 hour")


# ---- the crawl


def _web(spark, sf):
    """Responses of a web made of the pages, a robots.txt and two levels of sitemaps for each site; some pages fail."""
    docs = _documents(spark, sf)
    status = F.when(F.length("url") % 13 == 0, 500).otherwise(200)
    pages = docs.select("url", status.alias("status"), F.lit("text/html").alias("content_type"), F.col("doc").alias("body"))
    sites = docs.select(urls.site_key(F.col("domain")).alias("site"), "url").distinct()
    leads = table(spark, sf, "leads").where("domain is not null").select(urls.site_key(F.col("domain")).alias("site"), urls.origin(F.lower("url")).alias("origin")).where("origin is not null").distinct()
    rules = leads.select(F.concat("origin", F.lit("/robots.txt")).alias("url"), F.lit(200).alias("status"), F.lit("text/plain").alias("content_type"), _robots_body(F.col("site")).alias("body"))
    index = leads.select(F.concat("origin", F.lit("/sitemap.xml")).alias("url"), F.lit(200).alias("status"), F.lit("text/xml").alias("content_type"), F.concat(F.lit("<sitemapindex><sitemap><loc>"), "origin", F.lit("/map-0.xml</loc></sitemap><sitemap><loc>"), "origin", F.lit("/map-1.xml</loc></sitemap></sitemapindex>")).alias("body"))
    # A site's list has every URL of it, so its size is the site's; it is sorted to be the same each time.
    half = sites.withColumn("half", F.length("url") % 2).groupBy("site", "half").agg(F.array_sort(F.collect_list("url")).alias("urls"))
    located = F.array_join(F.transform("urls", lambda u: F.concat(F.lit("<url><loc>"), F.replace(u, F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))), "")
    maps = leads.join(half, "site").select(F.concat("origin", F.lit("/map-"), F.col("half").cast("string"), F.lit(".xml")).alias("url"), F.lit(200).alias("status"), F.lit("text/xml").alias("content_type"), F.concat(F.lit("<urlset>"), located, F.lit("</urlset>")).alias("body"))
    return pages.unionByName(rules).unionByName(index).unionByName(maps)


_TARGETS = f"""{PLAN}, tg AS (SELECT domain, string_split(seeds, ' ') AS seeds, regexp_extract(seeds, '^https?://[^/?# ]+', 0) AS origin, row_number() OVER (ORDER BY estimate DESC, first_ord) AS position FROM p),
 sd AS (SELECT domain, unnest(seeds) AS url, 0 AS ls, unnest(range(len(seeds))) AS pos FROM tg),
 mp AS (SELECT domain, url, 2 + length(url) % 2 AS ls, row_number() OVER (PARTITION BY domain, length(url) % 2 ORDER BY url) AS pos FROM (SELECT DISTINCT {SITE} AS domain, url FROM pages) JOIN tg USING (domain)),
 cd AS (SELECT domain, url, min(row(ls, pos)) AS place FROM (SELECT domain, url, ls, pos FROM sd UNION ALL SELECT domain, url, ls, pos FROM mp) GROUP BY domain, url),
 cn AS (SELECT cd.*, c.canonical FROM cd JOIN (SELECT url, canonical FROM ({CANONICAL}) UNION SELECT url, canonical FROM ({CANONICAL.replace("FROM pages", "FROM sd")})) c USING (url))"""
_JUDGED = f"""{_TARGETS}, al AS ({_allowed_sql(f"SELECT url || ' ' || domain AS ref, domain AS site, {_PATH} AS path FROM cd", "ref")}),
 jd AS (SELECT cn.domain, cn.url, cn.canonical, cn.place, tg.position, regexp_replace(lower(regexp_extract(cn.url, '^https?://([^/?#]+)', 1)), '^www\\.', '') = regexp_replace(lower(regexp_extract(tg.origin, '^https?://(.*)$', 1)), '^www\\.', '') AS on_site,
 list_contains(tg.seeds, cn.canonical) AS is_seed, al.allowed, coalesce({' AND '.join(["pt <> '/'", *[f"{no}regexp_matches(pt, '{rule}')" for no, rule in (("NOT ", urls.ASSET), ("NOT ", urls.FURNITURE), ("", urls.FOOD))]])}, false) AS shaped
 FROM (SELECT *, {_PATH} AS pt FROM cn) cn JOIN tg USING (domain) JOIN al ON al.ref = cn.url || ' ' || cn.domain)"""


@query(f"{_JUDGED} SELECT domain, url, is_seed, on_site, allowed, shaped FROM jd")
def harvest_candidates(spark, sf):
    """What decides about each candidate of the crawl."""
    from trailgrain.functions.arrowkit import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    web = harvest.answers(_web(spark, sf)).checkpoint()
    plan = harvest.with_rules(harvest.targets(table(spark, sf, "leads")), web).checkpoint()
    return harvest.judged(harvest.candidates(plan, web), plan).select("domain", "url", "is_seed", "on_site", "allowed", "shaped")


@query(f"""{_JUDGED}, rk AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY place) AS r FROM jd WHERE on_site AND allowed AND (is_seed OR shaped)),
 rq AS (SELECT canonical, min(row(position, place, url, domain)) AS first FROM rk WHERE r <= {crawl.DOMAIN_CAP} GROUP BY canonical ORDER BY min(row(position, place, url)) LIMIT {crawl.BUDGET}),
 wb AS (SELECT canonical, min(row(doc, n)) AS d FROM (SELECT canonical, len({_VALID}) AS n, {_DOC.replace("</style></head>", "</style>' || array_to_string(list_transform(coalesce(jsonld, []), lambda j: '<script type=" + chr(34) + "application/ld+json" + chr(34) + ">' || j || '</script>'), '') || '</head>")} AS doc FROM ({CANONICAL}) WHERE length(url) % 13 <> 0) GROUP BY canonical),
 ex AS (SELECT rq.canonical AS url, {_shown_sql("d[1]")} AS shown, d[2] AS n FROM rq JOIN wb USING (canonical))
 SELECT url, substring(shown, 1, 12000) AS kept_text, CAST(length(shown) AS INT) AS chars FROM ex WHERE n > 0 OR length(shown) >= 400""")  # fmt: skip
def harvest_pages(spark, sf):
    """The whole crawl, from leads to kept pages, over the pages as the web."""
    return harvest.harvest(table(spark, sf, "leads"), _web(spark, sf)).select("url", F.col("text").alias("kept_text"), "chars")




# ---- generated rows, parameters


@query("SELECT 'u' || lpad(CAST(row_number() OVER (ORDER BY unit) AS VARCHAR), 3, '0') AS id, 'unit' AS sourcetype, dimension AS region, unit AS lexicon FROM units UNION ALL SELECT 'b' || lpad(CAST(row_number() OVER (ORDER BY b) AS VARCHAR), 3, '0'), 'base', b, b FROM (SELECT DISTINCT base_unit AS b FROM units)")
def generated_cells(spark, sf):
    """Cells from lists, here the units and base units, of which there is a fixed number."""
    rows = table(spark, sf, "units").select("unit", "dimension", "base_unit").collect()
    members = sorted((r["unit"], r["dimension"]) for r in rows)
    bases = sorted({r["base_unit"] for r in rows})
    return generators.cells(spark, {"u": ("unit", [(d, u) for u, d in members]), "b": ("base", [(b, b) for b in bases])})


@query(f"{PLAN} SELECT domain, position // 3 AS place FROM (SELECT domain, row_number() OVER (ORDER BY estimate DESC, first_ord) - 1 AS position FROM p) WHERE position % 3 = 1 AND position // 3 < 7")
def job_parameters(spark, sf):
    """The targets of the second of three shards, at most seven domains, as a job's arguments say."""
    job = generators.parameters(["--shard", "1", "--of", "3", "--domains", "7", "--budget", "many"], {"budget": crawl.BUDGET, "domains": 9999, "shard": 0, "of": 1})
    chosen = harvest.targets(table(spark, sf, "leads"), job["shard"], job["of"], job["domains"])
    return chosen.select("domain", F.floor(F.col("position") / job["of"]).cast("long").alias("place"))
