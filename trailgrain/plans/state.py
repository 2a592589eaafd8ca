"""A faceted query: its selection, search text and sort mode, as an object, as a query string and as a plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.operators import facets, ordering, search


def encode_column(selected: Mapping[str, Column], query: Column, sort: Column) -> Column:
    """The query strings of many states: ``FilterState.encode`` in built-in expressions; null selections, texts and sorts count as absent."""
    parts = []
    for key in vocab.FACET_KEYS:
        if key in selected:
            own = selected[key]
            narrows = F.coalesce((F.size(own) > 0) & (F.size(own) < len(vocab.ALL_VALUES[key])), F.lit(False))
            parts.append(F.when(narrows, F.concat(F.lit(f"{key}="), F.url_encode(F.array_join(own, ",")))))
    asked = F.regexp_replace(query, r"(?U)^\s+|\s+$", "")
    parts.append(F.when(asked != "", F.concat(F.lit("q="), F.url_encode(asked))))
    parts.append(F.when(sort != vocab.DEFAULT_SORT, F.concat(F.lit("sort="), F.url_encode(sort))))
    joined = F.concat_ws("&", *parts)
    return F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit("?"), joined))


def decode_column(text: Column) -> Column:
    """struct<facet keys..., q, sort> of a query string: ``FilterState.decode`` in built-in expressions; a null text has no parameters."""
    pairs = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\?", ""), "&")

    def first(name: str) -> Column:
        values = F.transform(F.filter(pairs, lambda p: F.regexp_replace(p, "(?s)=.*$", "") == name), lambda p: F.regexp_replace(p, "(?s)^[^=]*=?", ""))
        raw = F.get(values, F.lit(0))
        return F.coalesce(F.try_url_decode(raw), raw, F.lit(""))

    def chosen(key: str) -> Column:
        everything = F.array(*map(F.lit, vocab.ALL_VALUES[key]))
        valid = F.filter(F.transform(F.split(first(key), ","), lambda v: F.regexp_replace(v, r"(?U)^\s+|\s+$", "")), lambda v: F.array_contains(everything, v))
        return F.when(F.size(valid) > 0, valid).otherwise(everything)

    sort = first("sort")
    known = F.when(sort.isin(*vocab.SORTS), sort).otherwise(F.lit(vocab.DEFAULT_SORT))
    return F.struct(*[chosen(k).alias(k) for k in vocab.FACET_KEYS], first("q").alias("q"), known.alias("sort"))


@dataclass
class FilterState:
    selected: dict[str, list[str]] = field(default_factory=dict)
    sort: str = vocab.DEFAULT_SORT
    query: str = ""

    @classmethod
    def all(cls) -> FilterState:
        return cls({k: list(v) for k, v in vocab.ALL_VALUES.items()})

    @classmethod
    def none(cls) -> FilterState:
        return cls({k: [] for k in vocab.FACET_KEYS})

    def is_empty(self) -> bool:
        return not self.query.strip() and facets.active_count(self.selected) == 0

    def encode(self, everything: dict[str, list[str]] | None = None) -> str:
        """A query string of the facets that narrow something, the search text and a sort that isn't the default; '' if there is none."""
        known = vocab.ALL_VALUES if everything is None else everything
        pairs = [(k, ",".join(self.selected[k])) for k in vocab.FACET_KEYS if facets.active(self.selected.get(k), known.get(k, ()))]
        if self.query.strip():
            pairs.append(("q", self.query.strip()))
        if self.sort != vocab.DEFAULT_SORT:
            pairs.append(("sort", self.sort))
        return "?" + urlencode(pairs, safe="*").replace("~", "%7E") if pairs else ""

    @classmethod
    def decode(cls, text: str, valid: dict[str, list[str]] | None = None) -> FilterState:
        """The state of a query string: unknown facets, values and sorts are ignored, a facet without a valid value has all of them."""
        valid = vocab.ALL_VALUES if valid is None else valid
        first: dict[str, str] = {}
        for k, v in parse_qsl(text.removeprefix("?"), keep_blank_values=True):
            first.setdefault(k, v)
        selected = {}
        for key in vocab.FACET_KEYS:
            kept = [v.strip() for v in first.get(key, "").split(",") if v.strip() in valid.get(key, ())]
            selected[key] = kept or list(valid.get(key, ()))
        sort = first.get("sort", vocab.DEFAULT_SORT)
        return cls(selected, sort if sort in vocab.SORTS else vocab.DEFAULT_SORT, first.get("q", ""))

    def filtered(self, dishes: DataFrame) -> DataFrame:
        """The rows of ``dishes`` that aren't drafts and match; full and empty facets constrain nothing."""
        df = facets.derive(facets.not_draft(dishes))
        hay = facets.search_text(F.col("title"), F.col("blurb"), F.col("ingredients"))
        return df.where(facets.matches(facets.facet_columns(df), facets.narrowed(self.selected)) & search.matches_search(hay, self.query))

    def run(self, dishes: DataFrame) -> DataFrame:
        """The matching rows in the order of the sort mode."""
        return self.filtered(dishes).orderBy(*ordering.sort_columns(self.sort), F.col("updated").asc_nulls_last())
