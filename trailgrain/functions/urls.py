"""URL scalars: canonical form, site key, shape filter."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, quote, quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailgrain.functions.columns import let

# Parameters that identify a click or campaign; a seed's list is shorter.
TRACKING = r"(?i)^(utm_|fbclid$|gclid$|mc_(cid|eid)$|igshid$|_ga$|ref$|source$)"
SEED_TRACKING = r"(?i)^(utm_|fbclid$|gclid$|ref$|source$)"
# Vocabularies of the URL shape filter.
FOOD = r"(?i)(recipe|meal|food|cook|dinner|breakfast|lunch|supper|snack|dessert|menu|kitchen|eat|dish|bake|stew|chili|ramen|soup|coffee|dehydrat|freezer.?bag|cold.?soak|provision|galley|rations?)"
FURNITURE = r"(?i)/(tag|tags|category|categories|author|page|search|feed|rss|comments?|wp-json|wp-admin|login|signup|cart|checkout|privacy|terms|about|contact)(/|$)"
ASSET = r"(?i)\.(jpe?g|png|gif|webp|svg|pdf|zip|mp[34]|mov|css|js|xml|json|ico)$"
PORTS = {"http": "80", "https": "443"}

_PARTS = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):(?://|[\\/]{2})(?:[^/?#\\@]*@)?([^/?#\\]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?", re.DOTALL)


def without_dots(path: str) -> str:
    """A path without its ``.`` and ``..`` segments; ``..`` takes the segment before it along, and the root stays."""
    kept: list[str] = []
    segments = path.split("/")[1:]
    for i, segment in enumerate(segments):
        if segment == "..":
            kept = kept[:-1]
        elif segment != ".":
            kept.append(segment)
        if segment in (".", "..") and i == len(segments) - 1:
            kept.append("")
    return "/" + "/".join(kept) if segments else path


def canonical(url: str | None, tracking: str = TRACKING) -> str | None:
    """scheme://host[:port]path?query in lower-case host, without fragment, user, default port or tracking parameters, parameters sorted by name; what can't be parsed comes back as it is."""
    if url is None:
        return None
    m = _PARTS.fullmatch(url.strip())
    if not m or not m[2]:
        return url
    scheme, host = m[1].lower(), m[2].lower()
    name, _, port = host.partition(":")
    if not name or re.search(r"[\s<>^|%\[\]]", name) or port and not port.isdigit():
        return url
    port = port.lstrip("0") or port[:1]
    host = name if not port or port == PORTS.get(scheme) else f"{name}:{port}"
    path = without_dots(quote(m[3].replace("\\", "/"), safe="/%:@!$&'()*+,;=~-._[]|^")) or "/"
    path = path if path == "/" else path.rstrip("/")
    drop = re.compile(tracking)
    pairs = sorted(((k, v) for k, v in parse_qsl(m[4] or "", keep_blank_values=True) if not drop.search(k)), key=lambda kv: kv[0].encode("utf-16-be"))
    query = "&".join(f"{quote_plus(k, safe='*').replace('~', '%7E')}={quote_plus(v, safe='*').replace('~', '%7E')}" for k, v in pairs)
    return f"{scheme}://{host}{path}{'?' + query if query else ''}"


_WHOLE = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*):(?://|[\\/]{2})(?:[^/?#\\@]*@)?([^/?#\\]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_HOST = r"^[^\s<>^|%\[\]:]+(:[0-9]*)?$"
_UNSAFE = r"[^A-Za-z0-9/%:@!$&'()*+,;=~\-._\[\]|^]"


def _path(raw: Column) -> Column:
    """A path with unsafe characters encoded and dot segments resolved; most paths have neither and stay as they are."""
    none = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        return F.when(segment == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(segment == ".", kept).otherwise(F.concat(kept, F.array(segment)))

    def encoded(slashed: Column) -> Column:
        chars = F.transform(F.split(slashed, ""), lambda c: F.when(c.rlike(_UNSAFE), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c))
        return F.when(slashed.rlike(_UNSAFE), F.array_join(chars, "")).otherwise(slashed)

    def resolved(safe: Column) -> Column:
        segments = F.split(safe, "/")
        kept = F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), none, step)
        closed = F.when(safe.rlike(r"/\.\.?$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
        return F.when(safe.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(closed, "/"))).otherwise(safe)

    def trimmed(path: Column) -> Column:
        return F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))

    return let(let(let(F.replace(raw, F.lit("\\"), F.lit("/")), encoded), resolved), trimmed)


def _query(raw: Column, tracking: str) -> Column:
    """Form encoding of the parameters that don't track, sorted by name, equal names in their order."""

    def decoded(s: Column) -> Column:
        return F.coalesce(F.try_url_decode(s), F.replace(s, F.lit("+"), F.lit(" ")))

    parts = F.filter(F.split(raw, "&"), lambda p: p != "")
    named = F.transform(parts, lambda p, i: F.struct(decoded(F.regexp_replace(p, "(?s)=.*$", "")).alias("name"), i.alias("at"), decoded(F.regexp_extract(p, "(?s)=(.*)$", 1)).alias("value")))
    kept = F.array_sort(F.filter(named, lambda p: ~p["name"].rlike(tracking)))
    return F.array_join(F.transform(kept, lambda p: F.concat(F.url_encode(p["name"]), F.lit("="), F.url_encode(p["value"]))), "&")


def canonical_url(url: Column, tracking: str = TRACKING) -> Column:
    """The same as ``canonical``, in built-in expressions: no row goes to Python."""

    def parts(plain: Column) -> Column:
        host = F.lower(F.regexp_extract(plain, _WHOLE, 2))
        return F.struct(F.lower(F.regexp_extract(plain, _WHOLE, 1)).alias("scheme"), host.alias("host"), F.regexp_replace(F.regexp_extract(host, ":([0-9]*)$", 1), "^0+(?=[0-9])", "").alias("port"), F.regexp_extract(plain, _WHOLE, 3).alias("path"), _query(F.regexp_extract(plain, _WHOLE, 4), tracking).alias("query"))

    def joined(p: Column) -> Column:
        name = F.regexp_replace(p["host"], ":[0-9]*$", "")
        default = (p["port"] == "") | ((p["scheme"] == "http") & (p["port"] == PORTS["http"])) | ((p["scheme"] == "https") & (p["port"] == PORTS["https"]))
        shown = F.when(default, name).otherwise(F.concat(name, F.lit(":"), p["port"]))
        whole = F.concat(p["scheme"], F.lit("://"), shown, _path(p["path"]), F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))
        return F.when(p["host"].rlike(_HOST), whole)  # an empty host where the URL doesn't parse

    return F.coalesce(let(F.regexp_replace(url, r"(?U)^\s+|\s+$", ""), lambda plain: let(parts(plain), joined)), url)


def origin(url: Column) -> Column:
    """scheme://host[:port] of a canonical URL, null for what isn't one."""
    found = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)
    return F.when(found != "", found)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]+)", 1))


def url_path(url: Column) -> Column:
    """The path of an absolute URL, '/' if it has none; null if it isn't one."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+([^?#]*)", 1)
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"), F.when(path == "", F.lit("/")).otherwise(path))


def site_key(host: Column) -> Column:
    """A host without one leading ``www.``, in lower case."""
    return F.regexp_replace(F.lower(F.trim(host)), r"^www\.", "")


def same_site(a: Column, b: Column) -> Column:
    """Whether two URLs are of one site; unparseable ones never are."""
    x, y = site_key(url_host(a)), site_key(url_host(b))
    return F.coalesce((x != "") & (x == y), F.lit(False))


def looks_like_recipe(url: Column, food: str = FOOD, furniture: str = FURNITURE, asset: str = ASSET) -> Column:
    """Whether a URL's path has a word of food and isn't a listing, a file or the root; false for null and unparseable ones."""
    path = url_path(url)
    return F.coalesce((path != "/") & ~path.rlike(asset) & ~path.rlike(furniture) & path.rlike(food), F.lit(False))
