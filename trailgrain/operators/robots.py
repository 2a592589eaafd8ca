"""robots.txt: rules of a host for an agent, and the decision on paths as a join."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

_STRINGS = ArrayType(StringType())
RULES = StructType().add("allow", _STRINGS).add("disallow", _STRINGS).add("sitemaps", _STRINGS).add("crawl_delay", DoubleType())


def parse(text: str | None, agent: str) -> dict:
    """The rules of the first group that names ``agent`` (in any case), else of the first for all agents, else none; sitemaps are of the whole file."""
    groups: list[dict] = []
    sitemaps: list[str] = []
    heading = False  # agent lines in a row share a group until its first rule
    for line in re.split(r"\r?\n", text or ""):
        name, colon, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon or not name:
            continue
        if name == "sitemap":
            sitemaps += [value] if value else []
        elif name == "user-agent":
            if not heading:
                groups.append({"agents": [], "allow": [], "disallow": [], "crawl_delay": None})
            heading = True
            groups[-1]["agents"].append(value.lower())
        elif groups:
            heading = False
            if name in ("allow", "disallow") and value:
                groups[-1][name].append(value)
            elif name == "crawl-delay":
                try:
                    number = float(value or 0)
                    groups[-1]["crawl_delay"] = number if number - number == 0 else groups[-1]["crawl_delay"]
                except ValueError:
                    pass
    own = next((g for who in (agent.lower(), "*") for g in groups if who in g["agents"]), {})
    return {"allow": own.get("allow", []), "disallow": own.get("disallow", []), "sitemaps": sitemaps, "crawl_delay": own.get("crawl_delay")}


def parse_robots(agent: str):
    """A column function from robots.txt to its rules; null text has none."""

    @pandas_udf(RULES)
    def rules(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(t, agent) for t in text], columns=["allow", "disallow", "sitemaps", "crawl_delay"])

    return rules


def pattern_regex(pattern: str) -> str:
    """A path pattern as an anchored regular expression: ``*`` is any run, a final ``$`` the end, the rest literal."""
    end = pattern.endswith("$")
    body = ".*".join(re.escape(p) for p in (pattern[:-1] if end else pattern).split("*"))
    return "^" + body + ("$" if end else "")


@pandas_udf(StringType())
def _regex(patterns: pd.Series) -> pd.Series:
    return patterns.map(pattern_regex, na_action="ignore")


def rule_table(hosts: DataFrame, host: str = "host", rules: str = "rules") -> DataFrame:
    """(host, kind, pattern, regex, length) of every rule."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{rules}.{k}").alias("patterns")) for k in ("allow", "disallow")])
    flat = hosts.select(host, F.explode(kinds).alias("k")).select(host, "k.kind", F.explode("k.patterns").alias("pattern"))
    return flat.withColumns({"regex": _regex("pattern"), "length": F.length("pattern")})


def allowed(urls: DataFrame, rules: DataFrame, key: str, host: str = "host", path: str = "path") -> DataFrame:
    """``key`` and ``allowed``: the longest matching rule wins, a tie allows, and what no rule forbids is allowed.

    A host's rules, as many as its robots.txt has, are one array; each URL meets
    its host's array in one join and folds it in place, so no URL is grouped.
    """
    named = rules.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("kind", "regex", "length")).alias("_rules"))
    joined = urls.select(key, host, path).join(named, F.col(host) == F.col("_host"), "left")
    return joined.select(key, decide(F.col("_rules"), F.col(path)).alias("allowed"))


def decide(rules: Column, path: Column) -> Column:
    """Whether ``rules``, an array of kind, regex and length, allow a path; a null array forbids nothing."""

    def longest(kind: str) -> Column:
        hits = F.filter(rules, lambda r: (r["kind"] == kind) & F.rlike(path, r["regex"]))
        return F.coalesce(F.array_max(F.transform(hits, lambda r: r["length"])), F.lit(-1))

    forbids = longest("disallow")
    return (forbids == -1) | (longest("allow") >= forbids)
