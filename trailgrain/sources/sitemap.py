"""Sitemaps: parsing, and a bounded walk from the root of each domain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import ensure_checkpoint_dir
from trailgrain.functions.html import decode_entities

LIMIT = 25
_LOC = r"(?is)<(?:[a-z0-9]+:)?loc>(.*?)</(?:[a-z0-9]+:)?loc>"


def locations(xml: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(_LOC), 1)
    joined = decode_entities(F.array_join(F.transform(found, lambda u: F.regexp_replace(u, r"(?U)^\s+|\s+$", "")), "\n"))
    return F.filter(F.transform(F.split(joined, "\n"), lambda u: F.trim(u)), lambda u: u != "")


def parse_sitemap(xml: Column) -> Column:
    """struct<urls, sitemaps>: an index gives sitemaps, a URL set gives URLs, anything else neither."""
    none = F.array().cast("array<string>")
    index, urlset = xml.rlike(r"(?i)<(?:[a-z0-9]+:)?sitemapindex\b"), xml.rlike(r"(?i)<(?:[a-z0-9]+:)?urlset\b")
    found = locations(xml)
    return F.struct(F.when(~index & urlset, found).otherwise(none).alias("urls"), F.when(index, found).otherwise(none).alias("sitemaps"))


def walk(roots: DataFrame, edges: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(domain, sitemap, n): the first ``limit`` requests of each domain's walk, in the order of a queue, ``n`` from 1.

    ``roots``: domain, sitemap, ord.  ``edges``: sitemap, child, child_ord.  A
    sitemap that several others list is asked for each time, as in a plain
    queue, so cycles end at the limit.  A join a level: every level adds a
    request to each domain that still grows, so there are at most ``limit``, and
    the walk stops when none does.  Ties of the order go by the name.
    """
    ensure_checkpoint_dir(roots.sparkSession)
    whole = Window.partitionBy("domain")
    first = whole.orderBy("ord", "sitemap")
    level = roots.select("domain", "sitemap", F.row_number().over(first).alias("n"), F.count(F.lit(1)).over(whole).alias("queued")).where(F.col("n") <= limit).checkpoint()
    levels = [level.select("domain", "sitemap", "n")]
    for _ in range(limit - 1):
        growing = level.where(F.col("queued") < limit).select("domain", "sitemap", F.col("n").alias("parent"), "queued")
        step = growing.join(edges.select("sitemap", "child", "child_ord"), "sitemap")
        order = whole.orderBy("parent", "child_ord", "child")
        level = step.select("domain", F.col("child").alias("sitemap"), (F.col("queued") + F.row_number().over(order)).alias("n"), (F.col("queued") + F.count(F.lit(1)).over(whole)).alias("queued"))
        level = level.where(F.col("n") <= limit).checkpoint()
        if level.isEmpty():
            break
        levels.append(level.select("domain", "sitemap", "n"))
    return reduce(DataFrame.unionByName, levels)
