"""Queries of the core operators, each with the SQL of the same result where SQL can express it, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import urls, vocab
from trailgrain.operators import facets, nested, ordering, quality, search, units
from trailgrain.plans import crawl
from trailgrain.plans.state import FilterState
from trailgrain.registry import oracle_sql, queries, query
from trailgrain.registry import table as _table
from trailgrain.registry import values as _values
from trailgrain.sources import writers
from trailgrain.sqltext import CANONICAL, DERIVED, PLAN, SITE, ladder

# ---- faceted collection

_SELECTED = {"slot": ["dinner", "lunch"], "heat": ["canister-stove", "no-cook"], "diet": list(vocab.ALL_VALUES["diet"])}


@query(f"""SELECT id, title, cal_oz, total_minutes FROM ({DERIVED}) WHERE NOT coalesce(draft, false)
 AND list_has_any(coalesce(slot, []), ['dinner', 'lunch']) AND list_has_any(coalesce(heatsource, []), ['canister-stove', 'no-cook']) AND contains(hay, 'oats')""")  # fmt: skip
def faceted_query(spark, sf):
    state = FilterState(_SELECTED, query="  OATS ")
    return state.run(_table(spark, sf, "dishes")).select("id", "title", "cal_oz", "total_minutes")


@query(f"""SELECT id, title FROM ({DERIVED}) WHERE list_has_any(coalesce(slot, []), ['dinner', 'lunch']) AND list_has_any(coalesce(heatsource, []), ['canister-stove', 'no-cook'])
 AND list_has_any(coalesce(dietary, []), ['vegetarian', 'vegan', 'gluten-free', 'dairy-free', 'nut-free'])""")  # fmt: skip
def facet_match_literal(spark, sf):
    """A full selection constrains here: rows without any option of it don't match."""
    df = facets.derive(_table(spark, sf, "dishes"))
    return df.where(facets.matches(facets.facet_columns(df), _SELECTED)).select("id", "title")


@query(f"SELECT id, updated, cal_oz, total_minutes, time_bucket, cal_oz_bucket, calorie_bucket, protein_bucket FROM ({DERIVED})")
def derive_dish(spark, sf):
    return facets.derive(_table(spark, sf, "dishes")).select("id", "updated", "cal_oz", "total_minutes", "time_bucket", "cal_oz_bucket", "calorie_bucket", "protein_bucket")


@query("SELECT p_partkey, " + ladder("p_retailprice", [1000, 1500], ["low", "mid", "high"]) + " AS price_bucket FROM part")
def bucket_price(spark, sf):
    return _table(spark, sf, "part").select("p_partkey", facets.bucket(F.col("p_retailprice"), [1000, 1500], ["low", "mid", "high"]).alias("price_bucket"))


def _facet_counts_sql() -> str:
    rows = [(f.key, v, label) for f in vocab.FACETS for v, label in f.options]
    parts = []
    for key, column in facets.FACET_COLUMNS.items():
        listed = column if column in ("tripstyle", "slot", "heatsource", "dietary") else f"[{column}]"
        parts.append(f"SELECT '{key}' AS key, unnest(list_distinct({listed})) AS value FROM d")
    return f"WITH d AS ({DERIVED}), e AS ({' UNION ALL '.join(parts)}), c AS (SELECT key, value, count(*) AS n FROM e GROUP BY ALL) SELECT t.key, t.value, t.value_label, coalesce(c.n, 0) AS n FROM {_values(rows, 'key, value, value_label')} LEFT JOIN c USING (key, value)"


@query(_facet_counts_sql())
def facet_counts(spark, sf):
    return facets.facet_counts(facets.derive(_table(spark, sf, "dishes")))


@query(f"SELECT count(*) FILTER (WHERE list_contains(slot, 'dinner')) AS dinners, count(*) FILTER (WHERE list_contains(dietary, 'vegan')) AS vegan, count(*) FILTER (WHERE total_minutes < 15) AS quick, count(*) AS visible FROM ({DERIVED}) WHERE NOT coalesce(draft, false)")
def facet_multi_count(spark, sf):
    df = facets.derive(facets.not_draft(_table(spark, sf, "dishes")))
    return df.agg(F.count_if(F.array_contains("slot", "dinner")).alias("dinners"), F.count_if(F.array_contains("dietary", "vegan")).alias("vegan"), F.count_if(F.col("total_minutes") < 15).alias("quick"), F.count(F.lit(1)).alias("visible"))


@query(f"SELECT id, updated FROM ({DERIVED}) WHERE contains(hay, 'honey') AND contains(hay, 'rice')")
def search_all_terms(spark, sf):
    df = _table(spark, sf, "dishes")
    hay = facets.search_text(F.col("title"), F.col("blurb"), F.col("ingredients"))
    return df.where(search.matches_search(hay, " Rice  honey ")).select("id", "updated")


@query(f"SELECT q, count(*) AS n FROM ({DERIVED}), (SELECT unnest(['tortilla', 'Honey oats', 'nowhere rice']) AS q) WHERE list_bool_and(list_transform(string_split(lower(q), ' '), lambda t: contains(hay, t))) GROUP BY q")
def search_column_query(spark, sf):
    df = _table(spark, sf, "dishes").withColumn("hay", facets.search_text(F.col("title"), F.col("blurb"), F.col("ingredients")))
    asked = df.select("hay", F.explode(F.array(*map(F.lit, ["tortilla", "Honey oats", "nowhere rice"]))).alias("q"))
    return asked.where(search.matches_search(F.col("hay"), F.col("q"))).groupBy("q").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH h AS (SELECT p_partkey, i - 1 AS a, i - 1 + length(t) AS b FROM part, (SELECT unnest(['an', 'ea', 'e']) AS t), range(1, 80) r(i) WHERE substring(lower(p_name), i, length(t)) = t),
 m AS (SELECT *, max(b) OVER (PARTITION BY p_partkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM h),
 g AS (SELECT *, sum(CASE WHEN prev IS NULL OR a > prev THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m),
 s AS (SELECT p_partkey, min(a) AS a, max(b) AS b FROM g GROUP BY p_partkey, island)
 SELECT p.p_partkey, coalesce(string_agg(s.a || '-' || s.b, ';' ORDER BY s.a), '') AS ranges FROM part p LEFT JOIN s USING (p_partkey) GROUP BY p.p_partkey""")  # fmt: skip
def match_ranges(spark, sf):
    ranges = search.match_ranges(F.col("p_name"), "an ea e")
    return _table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ";").alias("ranges"))


@query("SELECT p_partkey, regexp_replace(p_name, '(?i)(st)', '<mark>\\1</mark>', 'g') AS painted FROM part")
def highlight_marked(spark, sf):
    return _table(spark, sf, "part").select("p_partkey", search.marked(F.col("p_name"), "st").alias("painted"))


_MODES = {"cal-oz": "cal_oz DESC", "weight": "ouncesperserving ASC", "time": "total_minutes ASC", "calories": "caloriesperserving DESC", "title": "lower(title) ASC"}


@query("WITH d AS (" + DERIVED + ") " + " UNION ALL ".join(f"SELECT '{m}' AS mode, homeprep, id, updated, rank FROM (SELECT *, row_number() OVER (PARTITION BY homeprep ORDER BY {o} NULLS LAST, lower(title) NULLS LAST, id NULLS LAST, updated NULLS LAST) AS rank FROM d) WHERE rank <= 3" for m, o in _MODES.items()))
def sort_modes_top3(spark, sf):
    """A top-k report: the first three of each sort mode by home preparation."""
    from functools import reduce

    from pyspark.sql import Window

    df = facets.derive(_table(spark, sf, "dishes"))
    binary = [F.lower("title").asc_nulls_last(), F.col("id").asc_nulls_last(), F.col("updated").asc_nulls_last()]

    def top(mode: str) -> DataFrame:
        order = [c for c in ordering.sort_columns(mode)[:1] if mode != "title"] + binary
        rank = F.row_number().over(Window.partitionBy("homeprep").orderBy(*order))
        return df.withColumn("rank", rank).where("rank <= 3").select(F.lit(mode).alias("mode"), "homeprep", "id", "updated", F.col("rank").cast("long").alias("rank"))

    return reduce(DataFrame.unionByName, map(top, vocab.SORTS))


@query("""WITH b AS (SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 5) AS BIGINT) AS batch FROM cells) SELECT batch, string_agg(id, '|' ORDER BY id) AS content FROM b GROUP BY batch""")
def job_files(spark, sf):
    batches = crawl.batched(_table(spark, sf, "cells"), [F.col("id").asc()])
    return writers.job_files(batches, "id").select("batch", F.replace("content", F.lit("\n"), F.lit("|")).alias("content"))


# ---- web harvest: scalars


@query(f"SELECT page_id, canonical FROM ({CANONICAL})")
def canonical_url(spark, sf):
    return _table(spark, sf, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(f"SELECT canonical, min(page_id) AS page_id, count(*) AS n FROM ({CANONICAL}) GROUP BY canonical")
def canonical_dedup(spark, sf):
    keyed = _table(spark, sf, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))
    return keyed.groupBy("canonical").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT {SITE} AS site, count(*) AS n FROM leads WHERE domain IS NOT NULL GROUP BY 1")
def site_key(spark, sf):
    return _table(spark, sf, "leads").where("domain is not null").groupBy(urls.site_key(F.col("domain")).alias("site")).agg(F.count(F.lit(1)).alias("n"))


_SHAPE = " AND ".join(["p <> '/'", *[f"{no}regexp_matches(p, '{rule}')" for no, rule in (("NOT ", urls.ASSET), ("NOT ", urls.FURNITURE), ("", urls.FOOD))]])


@query(f"SELECT page_id, {_SHAPE} AS worthy FROM (SELECT page_id, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS p FROM pages)")
def url_shape(spark, sf):
    return _table(spark, sf, "pages").select("page_id", urls.looks_like_recipe(F.col("url")).alias("worthy"))


@query("SELECT page_id, substring(text, 1, 12000) AS kept_text, chars FROM pages WHERE len(coalesce(jsonld, [])) > 0 OR coalesce(chars, length(text), 0) >= 400")
def page_keep(spark, sf):
    return crawl.kept(_table(spark, sf, "pages")).select("page_id", F.col("text").alias("kept_text"), "chars")


@query(f"SELECT page_id, substring(h, 1, 2) || '/' || substring(h, 3, 2) || '/' || h || '.html' AS place FROM (SELECT page_id, sha256(canonical) AS h FROM ({CANONICAL}))")
def cache_key(spark, sf):
    return _table(spark, sf, "pages").select("page_id", crawl.cache_key(urls.canonical_url(F.col("url"))).alias("place"))


# ---- web harvest: plans

@query(PLAN + " SELECT domain, seeds, estimate, first_ord FROM p")
def plan_domains(spark, sf):
    return crawl.plan_domains(_table(spark, sf, "leads")).select("domain", F.array_join("seeds", " ").alias("seeds"), "estimate", "first_ord").orderBy(*crawl.plan_order())


@query(PLAN + " SELECT domain, CAST((row_number() OVER (ORDER BY estimate DESC, first_ord) - 1) % 4 AS INT) AS shard FROM p")
def shard_round_robin(spark, sf):
    return crawl.sharded(crawl.plan_domains(_table(spark, sf, "leads")), 4).select("domain", "shard")


@query("SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 5) AS BIGINT) AS batch FROM cells")
def batch_of_five(spark, sf):
    return crawl.batched(_table(spark, sf, "cells"), [F.col("id").asc()]).select("id", "batch")


@query("SELECT substring(id, 1, 1) AS prefix, count(*) AS n FROM cells GROUP BY 1")
def cells_by_prefix(spark, sf):
    return _table(spark, sf, "cells").groupBy(F.substring("id", 1, 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, domain FROM (SELECT page_id, domain, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS r FROM pages) WHERE r <= 300")
def domain_cap(spark, sf):
    return crawl.capped(_table(spark, sf, "pages").select("page_id", "domain"), "domain", ["page_id"], crawl.DOMAIN_CAP)


@query("SELECT page_id FROM pages ORDER BY page_id LIMIT 4000")
def budget_cut(spark, sf):
    """A limit that is the feature: the first pages within a crawl's budget."""
    return crawl.within_budget(_table(spark, sf, "pages").select("page_id"), [F.col("page_id").asc()])


@query(f"WITH c AS ({CANONICAL}), s AS (SELECT DISTINCT canonical FROM c WHERE stored_at < TIMESTAMP '2025-01-10') SELECT page_id FROM c WHERE canonical NOT IN (SELECT canonical FROM s)")
def candidates_anti_seen(spark, sf):
    keyed = _table(spark, sf, "pages").select("page_id", "stored_at", urls.canonical_url(F.col("url")).alias("canonical"))
    return crawl.unseen(keyed, keyed.where(F.col("stored_at") < F.lit("2025-01-10").cast("timestamp_ntz"))).select("page_id")


@query(f"WITH l AS (SELECT DISTINCT {SITE} AS site FROM leads WHERE domain IS NOT NULL) SELECT page_id, {SITE} IN (SELECT site FROM l) AS is_target FROM pages")
def target_flag(spark, sf):
    """Whether a page's site is the target of a lead: a left join with distinct sites."""
    sites = _table(spark, sf, "leads").where("domain is not null").select(urls.site_key(F.col("domain")).alias("site")).distinct().withColumn("known", F.lit(True))
    pages = _table(spark, sf, "pages").select("page_id", urls.site_key(F.col("domain")).alias("site"))
    return pages.join(sites, "site", "left").select("page_id", F.coalesce("known", F.lit(False)).alias("is_target"))


@query("""WITH e AS (SELECT event_id, user_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS at_ms FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms, event_id) - 1 AS k FROM e)
 SELECT event_id, CAST(max(at_ms - 600000 * k) OVER (PARTITION BY user_id ORDER BY at_ms, event_id ROWS UNBOUNDED PRECEDING) + 600000 * k AS BIGINT) AS start_ms FROM n""")  # fmt: skip
def throttle_schedule(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    return crawl.throttled(events, "user_id", "at_ms", "event_id", 600_000).select("event_id", "start_ms")


@query("WITH e AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS at_ms FROM events), n AS (SELECT *, lead(at_ms) OVER (PARTITION BY user_id ORDER BY at_ms, event_id) AS nx FROM e) SELECT event_id FROM n WHERE nx IS NULL OR nx - at_ms >= 3600000")
def debounce_last(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    return crawl.debounced(events, "user_id", "at_ms", "event_id", 3_600_000).select("event_id")


@query("SELECT doc_id, CAST(len(regexp_extract_all(lower(coalesce(text, '')), '\\bhoney')) * 2 + len(regexp_extract_all(lower(coalesce(text, '')), '\\bstove')) AS BIGINT) AS score FROM documents")
def keyword_relevance(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", quality.relevance(F.col("text"), {"honey": 2, "stove": 1}).alias("score"))


# ---- nested records and units


@query()
def p5_found(spark, sf):
    return nested.flatten_recipes(_table(spark, sf, "pages"))


@query()
def p5_children(spark, sf):
    return nested.flatten_recipes(_table(spark, sf, "pages"), text=True)


@query()
def p5_tables(spark, sf):
    """Every object of the recipes in the table of its schema path."""
    return nested.shred(_table(spark, sf, "pages")).select("page_id", "recipe_no", "table", "dewey", "parent", F.array_sort(F.map_keys("fields")).alias("fields"))


@query()
def p7_found(spark, sf):
    return units.amounts(_table(spark, sf, "pages"), _table(spark, sf, "dishes"), _table(spark, sf, "units"))


@query()
def p7_unit_shifts(spark, sf):
    return units.unit_shifts(units.bare_energies(_table(spark, sf, "pages")), "domain", "fetched_at", "value", ("page_id", "recipe_no"), factor=4.184)


from trailgrain import catalogue_crawl, catalogue_records  # noqa: E402, F401  # they register their queries, with the SQL above
