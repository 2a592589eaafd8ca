"""SQL text that several queries' statements share."""

from __future__ import annotations

from trailgrain.functions import vocab

CAL_OZ = "CASE WHEN ouncesperserving > 0 THEN CAST(floor(caloriesperserving / ouncesperserving + 0.5) AS BIGINT) END"
MINUTES = "CAST(prepminutes + cookminutes AS BIGINT)"


def ladder(value: str, edges: list[int], names: list[str]) -> str:
    return f"CASE WHEN ({value}) IS NULL THEN NULL " + " ".join(f"WHEN ({value}) < {e} THEN '{n}'" for e, n in zip(edges, names, strict=False)) + f" ELSE '{names[-1]}' END"


DERIVED = f"""SELECT *, {CAL_OZ} AS cal_oz, {MINUTES} AS total_minutes,
 {ladder(MINUTES, vocab.TIME_EDGES, vocab.TIME_NAMES)} AS time_bucket, {ladder(CAL_OZ, vocab.CAL_OZ_EDGES, vocab.CAL_OZ_NAMES)} AS cal_oz_bucket,
 {ladder("caloriesperserving", vocab.CALORIE_EDGES, vocab.CALORIE_NAMES)} AS calorie_bucket, {ladder("proteingrams", vocab.PROTEIN_EDGES, vocab.PROTEIN_NAMES)} AS protein_bucket,
 lower(concat_ws(' ', title, blurb, array_to_string(list_transform(ingredients, lambda i: i.item), ' '))) AS hay FROM dishes"""
CANONICAL = r"""SELECT *, regexp_replace(regexp_extract(url, '^(https?)://', 1) || '://' || lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) ||
 CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) IN ('', '/') THEN '/' ELSE regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+$', '') END ||
 coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_|(fbclid|gclid|mc_cid|mc_eid|igshid|_ga|ref|source)(=|$))'))), '&'), ''), ''), ' ', '') AS canonical FROM pages"""
SITE = "regexp_replace(lower(trim(domain)), '^www\\.', '')"



LEADS = rf"""SELECT {SITE} AS domain, lead_id, coalesce(est_recipe_count, 0) AS est, regexp_replace(regexp_extract(url, '^(https?)://', 1) || '://' || lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) || CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) IN ('', '/') THEN '/' ELSE regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+$', '') END || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_|(fbclid|gclid|ref|source)(=|$))'))), '&'), ''), ''), ' ', '') AS seed FROM leads WHERE regexp_matches(url, '^https?://[^/?#]+') AND domain IS NOT NULL"""
PLAN = f"WITH s AS (SELECT domain, seed, sum(est) AS est, min(lead_id) AS ord FROM ({LEADS}) GROUP BY ALL), p AS (SELECT domain, string_agg(seed, ' ' ORDER BY ord, seed) AS seeds, CAST(sum(est) AS BIGINT) AS estimate, min(ord) AS first_ord FROM s GROUP BY domain)"
