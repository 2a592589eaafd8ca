"""The crawl as one plan: leads to domains, robots rules, sitemaps, candidates, budget, pages.

What the network would answer is a table of responses (``url``, ``status``,
``content_type``, ``body``), looked up by canonical URL; a URL that isn't in it
is a failed request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import html, urls
from trailgrain.functions.arrowkit import ensure_checkpoint_dir
from trailgrain.operators import robots
from trailgrain.plans import crawl
from trailgrain.sources import sitemap
from trailgrain.sources.readers import text_like

AGENT = "trailgrain"


def answers(responses: DataFrame) -> DataFrame:
    """(canonical, body) of the responses that give a page: a status below 400, text, one row a canonical URL."""
    good = responses.where((F.col("status") < 400) & F.col("body").isNotNull() & text_like(F.col("content_type")))
    keyed = good.select(urls.canonical_url(F.col("url")).alias("canonical"), "body")
    return keyed.groupBy("canonical").agg(F.min("body").alias("body"))


def targets(leads: DataFrame, shard: int = 0, shards: int = 1, domains: int = 9999, cap: int = crawl.DOMAIN_CAP) -> DataFrame:
    """The planned domains of a shard, at most ``domains`` of them, with their ``position`` and the ``origin`` of their first seed; those without an origin are left out."""
    plan = crawl.sharded(crawl.plan_domains(leads, cap), shards).where((F.col("shard") == shard) & (F.floor(F.col("position") / shards) < domains))
    return plan.withColumn("origin", urls.origin(F.get("seeds", F.lit(0)))).where("origin is not null")


def with_rules(plan: DataFrame, web: DataFrame, agent: str = AGENT) -> DataFrame:
    """``plan`` with ``rules``: those of the origin's robots.txt; an origin without one forbids nothing."""
    asked = plan.withColumn("canonical", urls.canonical_url(F.concat("origin", F.lit("/robots.txt"))))
    return asked.join(web, "canonical", "left").withColumn("rules", robots.parse_robots(agent)("body")).drop("canonical", "body")


def sitemap_edges(web: DataFrame) -> DataFrame:
    """(canonical, urls, sitemaps) of every response that is a sitemap or an index of them."""
    parsed = web.where(F.col("body").rlike(r"(?i)<(?:[a-z0-9]+:)?(sitemapindex|urlset)\b")).select("canonical", sitemap.parse_sitemap(F.col("body")).alias("m"))
    return parsed.select("canonical", "m.urls", "m.sitemaps")


def candidates(plan: DataFrame, web: DataFrame) -> DataFrame:
    """(domain, url, place): seeds, then the URLs of the domain's sitemaps in the order of the walk, each raw URL once."""
    maps = sitemap_edges(web)
    named = F.when(F.size("rules.sitemaps") > 0, F.col("rules.sitemaps")).otherwise(F.array(F.concat("origin", F.lit("/sitemap.xml"))))
    roots = plan.select("domain", F.posexplode(named).alias("ord", "url")).select("domain", urls.canonical_url(F.col("url")).alias("sitemap"), "ord")
    edges = maps.select(F.col("canonical").alias("sitemap"), F.posexplode("sitemaps").alias("child_ord", "url")).select("sitemap", urls.canonical_url(F.col("url")).alias("child"), "child_ord")
    walked = sitemap.walk(roots, edges)
    listed = walked.join(maps.withColumnRenamed("canonical", "sitemap"), "sitemap").select("domain", F.col("n").cast("long").alias("list"), F.posexplode("urls").alias("at", "url"))
    seeds = plan.select("domain", F.lit(0).cast("long").alias("list"), F.posexplode("seeds").alias("at", "url"))
    return seeds.unionByName(listed).groupBy("domain", "url").agg(F.min(F.struct("list", "at")).alias("place"))


def judged(found: DataFrame, plan: DataFrame) -> DataFrame:
    """``found`` with what decides about a candidate: ``canonical``, ``on_site``, ``is_seed``, ``allowed`` and ``shaped``."""
    rules = robots.rule_table(plan.select("domain", "rules"), "domain").groupBy("domain").agg(F.collect_list(F.struct("kind", "regex", "length")).alias("folded"))
    known = plan.select("domain", "position", "seeds").join(rules, "domain", "left")
    joined = found.join(known, "domain").withColumn("canonical", urls.canonical_url(F.col("url")))
    flags = {
        "on_site": urls.same_site(F.get("seeds", F.lit(0)), F.col("url")),
        "is_seed": F.array_contains("seeds", F.col("canonical")),
        "allowed": robots.decide(F.col("folded"), urls.url_path(F.col("url"))),
        "shaped": urls.looks_like_recipe(F.col("url")),
    }
    return joined.withColumns(flags).drop("seeds", "folded")


def requests(judged_rows: DataFrame, seen: DataFrame | None = None, budget: int = crawl.BUDGET, cap: int = crawl.DOMAIN_CAP) -> DataFrame:
    """(domain, url, canonical, position, place) of the pages to ask for: on the site, not seen, allowed, seeds or shaped like recipes, capped by domain, once each, within the budget.

    Aliases of one URL count for the cap of their domain, as it is applied first.
    """
    worth = judged_rows.where("on_site and allowed and (is_seed or shaped)")
    worth = worth if seen is None else crawl.unseen(worth, seen)
    ranked = crawl.capped(worth, "domain", ["place"], cap)
    row = F.struct("position", "place", "url", "domain")
    once = ranked.groupBy("canonical").agg(F.min(row).alias("first")).select("canonical", "first.*")
    return crawl.within_budget(once, [F.col("position").asc(), F.col("place").asc(), F.col("url").asc()], budget)


def extracted(asked: DataFrame, web: DataFrame) -> DataFrame:
    """The pages that are kept: url, domain, title, jsonld (null if there is none), text and its full length."""
    pages = asked.join(web, "canonical").select(F.col("canonical").alias("url"), "domain", html.page_title(F.col("body")).alias("title"), html.jsonld_recipes("body").alias("jsonld"), html.page_text(F.col("body")).alias("text"))
    return crawl.kept(pages.withColumn("chars", F.length("text")))


def harvest(leads: DataFrame, responses: DataFrame, seen: DataFrame | None = None, shard: int = 0, shards: int = 1, domains: int = 9999, budget: int = crawl.BUDGET, cap: int = crawl.DOMAIN_CAP, agent: str = AGENT) -> DataFrame:
    """The pages of a crawl of ``leads`` over ``responses``; ``seen`` holds the canonical URLs of earlier runs.

    Leads without a parseable URL or domain give no target; an empty table of
    responses gives no pages.  Null bodies are failed requests.
    """
    ensure_checkpoint_dir(leads.sparkSession)
    web = answers(responses).checkpoint()  # once, shared out by URL as the lookups need it
    plan = with_rules(targets(leads, shard, shards, domains, cap), web, agent).checkpoint()
    return extracted(requests(judged(candidates(plan, web), plan), seen, budget, cap), web)
