"""Crawl planning: domains from leads, caps, shards, budgets, candidates, politeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailgrain.functions import urls
from trailgrain.operators import scan
from trailgrain.operators.ordering import with_position

DOMAIN_CAP, BUDGET, TEXT_LIMIT, KEEP_CHARS = 300, 4000, 12_000, 400
GAP_MS, GAP_MOST_MS = 1500, 10_000


def plan_domains(leads: DataFrame, cap: int = DOMAIN_CAP) -> DataFrame:
    """``domain``, ``seeds`` (distinct, in order of their first lead), ``estimate``, ``first_ord`` and ``cap`` of every domain with a parseable lead.

    Seeds are made distinct before they are gathered, so a domain's list grows
    with its seeds, not with its leads.
    """
    parsed = leads.where(F.col("url").rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+")).select(
        urls.site_key(F.col("domain")).alias("domain"), urls.canonical_url(F.col("url"), urls.SEED_TRACKING).alias("seed"), F.coalesce("est_recipe_count", F.lit(0)).cast("long").alias("estimate"), F.col("lead_id").alias("ord")
    ).where("domain is not null")
    by_seed = parsed.groupBy("domain", "seed").agg(F.sum("estimate").alias("estimate"), F.min("ord").alias("ord"))
    gathered = by_seed.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("ord", "seed"))).alias("ordered"), F.sum("estimate").alias("estimate"), F.min("ord").alias("first_ord"))
    return gathered.select("domain", F.transform("ordered", lambda s: s["seed"]).alias("seeds"), "estimate", "first_ord", F.lit(cap).alias("cap"))


def plan_order() -> list[Column]:
    """Largest estimate first, ties by the first lead."""
    return [F.col("estimate").desc(), F.col("first_ord").asc()]


def sharded(plan: DataFrame, shards: int) -> DataFrame:
    """The plan with ``position`` and ``shard``: round-robin over the order."""
    return with_position(plan, plan_order()).withColumn("shard", (F.col("position") % shards).cast("int"))


def batched(df: DataFrame, order: list[Column], size: int = 5) -> DataFrame:
    """``df`` with ``position`` and the number of its ``batch``."""
    return with_position(df, order).withColumn("batch", F.floor(F.col("position") / size).cast("long"))


def capped(df: DataFrame, key: str, order: list[str], cap: int) -> DataFrame:
    """At most ``cap`` rows a ``key``, the first in ``order``."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= cap).drop("_rank")


def within_budget(df: DataFrame, order: list[Column], budget: int = BUDGET) -> DataFrame:
    """The first ``budget`` rows in order."""
    return df.orderBy(*order).limit(budget)


def unseen(candidates: DataFrame, seen: DataFrame, key: str = "canonical") -> DataFrame:
    return candidates.join(seen.select(key).distinct(), key, "left_anti")


def kept(pages: DataFrame) -> DataFrame:
    """Pages with embedded recipes or enough text; the text is cut, its full length kept."""
    enough = (F.size(F.coalesce("jsonld", F.array().cast("array<string>"))) > 0) | (F.coalesce("chars", F.length("text"), F.lit(0)) >= KEEP_CHARS)
    return pages.where(enough).withColumns({"text": F.substring("text", 1, TEXT_LIMIT), "jsonld": F.when(F.size("jsonld") > 0, F.col("jsonld"))})


def polite_delay(crawl_delay: Column) -> Column:
    """Milliseconds between requests: the host's wish within bounds."""
    return F.least(F.greatest(F.lit(GAP_MS), F.coalesce(crawl_delay, F.lit(0)) * 1000), F.lit(GAP_MOST_MS)).cast("long")


def throttled(requests: DataFrame, host: str, at_ms: str, order: str, gap_ms: int = GAP_MS) -> DataFrame:
    """``requests`` with ``start_ms``: each host's requests in order, at least ``gap_ms`` apart, none before its arrival; a host of any size is shared out."""
    return scan.throttle(requests, host, at_ms, order, gap_ms)


def debounced(events: DataFrame, key: str, at_ms: str, order: str, quiet_ms: int = 120) -> DataFrame:
    """The last event of every burst: those that no event of the same key follows within ``quiet_ms``; a key of any size is shared out."""
    return scan.last_of_bursts(events, key, at_ms, order, quiet_ms)


def cache_key(canonical: Column) -> Column:
    """The place of a page in the cache: two levels of its hash."""
    digest = F.sha2(canonical, 256)
    return F.concat_ws("/", F.substring(digest, 1, 2), F.substring(digest, 3, 2), F.concat(digest, F.lit(".html")))
